import hashlib
import re
from fractions import Fraction

import duckdb
import pytest

from spriteloom.llm.mixing import OP11_SQL, mix_plan, mixed_documents, mixing


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_targets(sizes):
    """Clamp and reshare, one round after the other, in fractions."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, clamped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in clamped)
        share = {s: Fraction(weight[s] * left, sum(weight[o] for o in order if o not in clamped)) for s in order if s not in clamped}
        over = {s for s in share if share[s] > 3 * sizes[s]}
        if not over:
            return {s: share.get(s, 3 * sizes[s]) for s in order}
        clamped |= over


def brute(rows):
    by_source = {}
    for doc_id, text, source in rows:
        mark = f"mix-1:{'-' if doc_id is None else doc_id}:{hashlib.md5((text or '').encode()).hexdigest()}"
        by_source.setdefault(source, []).append((hashlib.md5(mark.encode()).hexdigest(), len(words(text)), doc_id))
    sizes = {s: sum(d[1] for d in docs) for s, docs in by_source.items()}
    out = []
    for source, target in brute_targets(sizes).items():
        epochs, rest = divmod(int(target), sizes[source]) if sizes[source] else (0, 0)
        for _, size, doc_id in sorted(by_source[source], key=lambda d: d[0]):
            more = min(rest, size)
            rest -= more
            out.append((doc_id, size, sizes[source], round(float(target), 6), epochs * size + more))
    return sorted(out, key=str)


def check(df, **options):
    plan = mix_plan(df, **options)
    got = [(r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["whole"] * r["size"] + r["part"]) for r in plan.collect()]
    assert sorted(got, key=str) == brute([(r["doc_id"], r["text"], r["source"]) for r in df.collect()])


def test_edge_cases(edge):
    check(edge)


def test_documents(small):
    check(small)
    check(small.repartition(13), broadcast_bytes=0)


def test_empty(empty):
    assert mixing(empty).collect() == []


def test_only_empty_texts(spark):
    rows = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert sorted((r["doc_id"], r["target"], r["taken"]) for r in mixing(rows).collect()) == [(1, 0.0, 0), (2, 0.0, 0)]


@pytest.mark.parametrize("copies", [1, 7, 2000])
def test_equal_rows_are_cut_at_the_target(spark, copies):
    rows = [(None, "two words", "hot")] * copies + [(i, "w " * i, s) for i, s in enumerate(["a", "b", None, "c", "a"])]
    check(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5))


def test_one_source_over_its_limit_passes_its_excess_on(spark):
    # a has weight 5 of 8 and a tenth of the words
    rows = [(1, "x " * 10, "a"), (2, "x " * 45, "b"), (3, "x " * 45, "c")]
    got = {r["doc_id"]: r for r in mixing(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert [got[i]["target"] for i in (1, 2, 3)] == [30.0, 2 * 70 / 3, 70 / 3]
    assert [got[i]["taken"] for i in (1, 2, 3)] == [30, 46, 23]


def test_the_mix_has_the_words_that_the_plan_says(edge):
    edge, planned = edge.where("doc_id IS NOT NULL"), {}
    for r in mix_plan(edge).collect():
        planned[r["doc_id"]] = planned.get(r["doc_id"], 0) + r["whole"] * r["size"] + r["part"]
    texts = {r["doc_id"]: r["text"] for r in edge.collect()}
    got = dict.fromkeys(planned, 0)
    for r in mixed_documents(edge).collect():
        assert words(texts[r["doc_id"]])[: len(words(r["text"]))] == words(r["text"])
        got[r["doc_id"]] += len(words(r["text"]))
    assert got == planned


def test_sql(small):
    documents = small.toArrow()  # noqa: F841  DuckDB finds it by its name
    wanted = duckdb.sql(OP11_SQL).fetchall()
    got = [tuple(r[c] for c in ("doc_id", "size", "source_size", "target", "taken")) for r in mixing(small).collect()]
    assert sorted(got) == sorted(wanted)
