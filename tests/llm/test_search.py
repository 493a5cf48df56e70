import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from spriteloom.llm import common, search
from spriteloom.llm.bisection import features, fit
from spriteloom.llm.search import OP13_SQL, build_index, ranked_search, term_counts


def terms(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(docs, items):
    counted = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    counted = [(doc_id, c) for doc_id, c in counted if c]
    n, total, df = len(counted), sum(c.total() for _, c in counted), Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in items:
        asked = {t: k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t, k in Counter(terms(text)).items() if df[t]}
        scored = []
        for doc_id, c in counted:
            m = 25 + 75 * c.total() * n // total
            score = sum(w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, w in asked.items() if t in c)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank + 1, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:10])]
    return sorted(out, key=str)


def check(docs, items, **options):
    got = [tuple(r[c] for c in ("item_id", "rank", "doc_id", "score")) for r in ranked_search(docs, items, **options).collect()]
    assert sorted(got, key=str) == brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])


@pytest.fixture
def items(spark):
    rows = [(1, "Hello hello WORLD"), (2, "the same line"), (3, None), (4, "..."), (5, "unknownterm"), (None, "café word  x"), (6, "hello"), (6, "hello")]
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "item_id long, text string, shard int, score int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")


def test_edge_cases(edge, items):
    check(edge, items)
    check(edge.repartition(3), items, shard_docs=2)


def test_documents(small, benchmark):
    check(small, benchmark)
    check(small, benchmark, shard_docs=8)


def test_empty(empty, edge, items):
    assert ranked_search(empty, items).collect() == []
    assert ranked_search(edge, items.limit(0)).collect() == []


def test_without_broadcast_and_in_small_steps(small, benchmark, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(search, "ROUNDS", (1, 1))
    check(small, benchmark, shard_docs=16)


def test_many_copies_rank_by_id_and_fill_many_shards(spark, items, tmp_path):
    rows = [(i, "hello world") for i in range(900)] + [(None, "hello world")] * 100 + [(2000 + i, f"hello {i} other words {i % 7}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    check(docs, items, shard_docs=50)
    index = build_index(docs, str(tmp_path / "index"), shard_docs=50)
    sizes = [len(r["ids"]) // 8 for r in index.rows.where("term IS NULL").select("ids").collect()]
    assert sum(sizes) == 1200 and max(sizes) <= 100


def test_terms_of_a_long_text_are_counted_in_pieces(monkeypatch):
    text = ("Word é1 " * 5000 + "x" * 3000).encode()
    monkeypatch.setattr(search, "_PIECE", 1000)
    assert {t.decode(): n for t, n in term_counts(text).items()} == Counter(terms(text.decode()))


def test_bisection_brings_documents_with_common_terms_together():
    rng = np.random.default_rng(1)
    topics = [[f"{topic}-{k}".encode() for k in range(40)] for topic in range(4)]
    kinds = np.arange(400) % 4  # halves can be as large as topics
    docs = [np.unique(features(rng.choice(topics[k], 15))) for k in kinds]
    tree = fit(docs[:200], 2)
    leaf = tree.leaf(np.concatenate(docs), np.array([len(d) for d in docs]))
    for k in range(4):
        assert Counter(leaf[kinds == k].tolist()).most_common(1)[0][1] > 0.9 * (kinds == k).sum()


def test_a_good_order_spares_visits(spark, tmp_path):
    rows = [(i, " ".join(f"t{i % 16}w{(i * 7 + k * k) % 50}" for k in range(20))) for i in range(1600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    asked = spark.createDataFrame([(t, " ".join(f"t{t}w{k}" for k in range(12))) for t in range(16)], "item_id long, text string")
    visits = []
    search.search(build_index(docs, str(tmp_path / "index"), shard_docs=50), asked, rounds=(2, 4), visits=visits)
    assert sum(visits) < 16 * 32 / 2


def test_sql(small, benchmark):
    got = [tuple(r[c] for c in ("item_id", "rank", "doc_id", "score")) for r in ranked_search(small, benchmark).collect()]
    documents, benchmark = small.toArrow(), benchmark.toArrow()
    assert sorted(got) == sorted(duckdb.sql(OP13_SQL).fetchall())
