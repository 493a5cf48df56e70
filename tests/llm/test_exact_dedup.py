import hashlib
import re

from spriteloom.llm.exact_dedup import digest_rows, exact_dedup, merge_runs


def brute(rows):
    groups = {}
    for i, (doc_id, text) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc_id is None, doc_id or 0, i, doc_id))
    out = []
    for plain, members in groups.items():
        best = min(members)
        sha = hashlib.sha256(plain.encode()).hexdigest()
        out += [(m[4], best[4], len(members), sha) for m in members]
    return sorted(out, key=str)


def check(df):
    got = exact_dedup(df).collect()
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=str) == brute(rows)
    kept = [r["text_sha256"] for r in got if r["kept"]]
    assert len(kept) == len(set(kept)) == len({r["text_sha256"] for r in got})


def test_edge_cases(edge):
    check(edge)


def test_documents(small):
    check(small)


def test_empty(empty):
    assert exact_dedup(empty).collect() == []


def test_rounds_over_many_runs(small):
    rows = digest_rows(small.union(small).repartition(23)).cache()
    got = merge_runs(rows, fan_in=2, range_rows=10).collect()
    assert sum(r["group_size"] for r in got) == rows.count()
    assert len(got) == len({bytes(r["digest"]) for r in got}) == rows.select("digest").distinct().count()
