import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from spriteloom.llm import common
from spriteloom.llm.merkle import OP12_SQL, merkle_manifest, merkle_proofs

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(hashes):
    """(root, for each leaf its siblings by level)."""
    paths, spans, level = [[] for _ in hashes], [[i] for i in range(len(hashes))], list(hashes)
    while len(level) > 1:
        up, up_spans = [], []
        for at in range(0, len(level), 16):
            run = level[at : at + 16]
            for i in range(len(run)):
                for one in spans[at + i]:
                    paths[one].append((run[:i], run[i + 1 :]))
            up.append(sha(*run))
            up_spans.append(sum(spans[at : at + 16], []))
        level, spans = up, up_spans
    return level[0], paths


def brute(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    done = {}
    for source in order:
        docs = sorted(by_source[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        done[source] = (docs, *tree([leaf(*r) for r in docs]))
    root, upper = tree([done[s][1] for s in order])
    out = []
    for k, source in enumerate(order):
        docs, subroot, paths = done[source]
        for row, path in zip(docs, paths):
            path = path + upper[k]
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None
            text = "".join(c.lower() if c.isascii() else c for c in row[4]) if tampered else row[4]
            now = leaf(*row[:4], text)
            for left, right in path:
                now = sha(*left, now, *right)
            out.append((row[0], leaf(*row), subroot, root, sha(*(h for left, right in path for h in [*left, *right])), now, now == root))
    return sorted(out, key=str)


def fields(df):
    return df.select("doc_id", "source", "lang", "n_chars", "text")


def check(df):
    got = [tuple(r[c] for c in COLUMNS) for r in merkle_manifest(df).collect()]
    assert sorted(got, key=str) == brute([tuple(r) for r in fields(df).collect()])


def with_columns(df):
    """The columns that a leaf has, beside names that the operator uses itself."""
    return df.withColumns({"lang": F.when(F.col("doc_id") % 2 == 0, "en"), "n_chars": F.length("text"), "tree": F.lit(1), "idx": F.lit("x"), "hash": F.lit(2), "n": F.lit(3), "suffix": F.lit(4), "top": F.lit(5)})


def test_edge_cases(edge):
    check(with_columns(edge))


def test_documents(small):
    check(small)


def test_empty(empty):
    assert merkle_manifest(with_columns(empty)).collect() == []


@pytest.mark.parametrize("n", [1, 16, 17, 273, 4100])
def test_heights(spark, n):
    """Trees that end in lone nodes, and many equal rows."""
    rows = [(i, "a", None, 1, f"Text {i}") for i in range(n)] + [(None, None, "en", None, "Same")] * n + [(1, "one", "en", 0, "")]
    check(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(6))


def test_many_sources(spark):
    rows = [(i, f"sé{i}", "en", 1, "AbC") for i in range(300)]
    check(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"))


def test_without_broadcast(small, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    check(small)


def test_the_manifest_does_not_depend_on_partitions(small):
    rows = [[tuple(r) for r in merkle_proofs(d).select("doc_id", "source", "idx", "leaf", "root").collect()] for d in (small, small.repartition(17))]
    assert sorted(rows[0]) == sorted(rows[1])


def test_sql(small):
    documents = small.unionByName(small.withColumns({"source": F.lit("all"), "lang": F.lit(None).cast("string")}))
    got = [tuple(r[c] for c in COLUMNS) for r in merkle_manifest(documents).collect()]
    documents = documents.toArrow()
    assert sorted(got) == sorted(duckdb.sql(OP12_SQL).fetchall())
