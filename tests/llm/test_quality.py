import random
import re
from collections import Counter

from spriteloom.llm.quality import quality_rules, text_stats, without_boilerplate


def brute_stats(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = text.split("\n")
    dup = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_stats_against_brute_force(small):
    random.seed(3)
    texts = [r["text"] for r in small.collect()]
    texts += ["".join(random.choices(["a", "b ", " c", "\n", "#", "\t", "\u00a0", "\u00e9"], k=60)) for _ in range(200)]
    for t in ["", " ", "\n\n", *texts]:
        assert text_stats(t) == brute_stats(t)


def test_edge_cases(edge):
    got = quality_rules(edge).collect()
    assert len(got) == edge.count()
    want = sorted((str(r["doc_id"]), *brute_stats(r["text"] or "")) for r in edge.collect())
    assert sorted((str(r["doc_id"]), *list(r)[1:6]) for r in got) == want
    assert not any(r["kept"] for r in got if r["base_failed"])


def test_empty(empty):
    assert quality_rules(empty).collect() == []


def test_depleted_documents_go_and_copies_stay(spark):
    prose = " ".join(f"word{i} of prose" for i in range(30))
    menu = "\n".join(f"Menu entry {i}: go" for i in "abcdefghijklmnop")
    rows = [(i, f"{menu}\nown text {i}", "h") for i in range(40)]  # nothing but the host's menu
    rows += [(100 + i, f"{menu}\n" + " ".join(f"w{i}x{k} own" for k in range(80)), "h") for i in range(5)]
    rows += [(200 + i, prose, "h") for i in range(60)] + [(300, menu + "\n" + menu.replace(":", " -"), "other")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"] for r in quality_rules(df).collect() if r["kept"]}
    assert not kept & set(range(40))
    assert {*range(100, 105), *range(200, 260)} <= kept
    clean = {r["doc_id"]: r["text"] for r in without_boilerplate(df).collect()}
    assert clean[3] == "own text 3"
    assert clean[300] == dict((r[0], r[1]) for r in rows)[300]
    assert clean[100].startswith("w0x0 own")


def test_long_lines_and_hot_hosts_count_without_the_limits(spark):
    notice = " ".join(f"notice{k}" for k in range(60))
    rows = [(i, f"{notice}\nown text {i}", "h") for i in range(11)] + [(100 + i, "text " + "".join("abcdefghij"[int(k)] for k in str(i)), "h") for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    every = {"max_line_words": None, "min_share": 0}
    lost = {r["doc_id"]: r["n_boilerplate_words"] for r in quality_rules(df, **every).collect()}
    assert all(lost[i] == (60 if i < 11 else 0) for i in lost)
    assert {r["doc_id"]: r["text"] for r in without_boilerplate(df, **every).collect()}[3] == "own text 3"
    limits = {"max_line_words": 20, "min_share": 0.01}
    assert not any(r["n_boilerplate_words"] for r in quality_rules(df, **limits).collect() if r["doc_id"] < 100)
    assert all(r["n_boilerplate_words"] for r in quality_rules(df).collect() if r["doc_id"] < 11)


def test_lines_go_everywhere_unless_too_little_stays(spark):
    menu = "\n".join(f"Menu entry {i}: go" for i in "abcdefghijklmnop")
    own = " ".join(f"own{k}" for k in range(80))
    rows = [(i, f"{menu}\n{own} {i}", "h") for i in range(20)] + [(100, f"{menu}\n{own} 3", "other"), (101, f"{menu}\nfew", "other"), (102, None, None), (None, f"{menu}\n{own} x", None)]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, source string, boilerplate int")
    got = {r["doc_id"]: r for r in without_boilerplate(df, everywhere=True).collect()}
    assert got[3]["text"] == got[100]["text"] == f"{own} 3" and got[None]["text"] == f"{own} x"
    assert got[101]["text"] == f"{menu}\nfew" and got[102]["text"] is None and got[3].__fields__ == df.columns and got[3]["boilerplate"] == 7
