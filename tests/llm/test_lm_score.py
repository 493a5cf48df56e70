import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from spriteloom.llm import lm_score as module
from spriteloom.llm.lm_score import END, Network, Streams, Vocabulary, lm_score, score, train


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if w] + [None]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def check(df, **sizes):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    c = Counter(w for d, t in rows if not held(d) for w in words(t))
    n, v = sum(c.values()), len(c)
    want = sorted((str(d), held(d), len(words(t)), sum(c[w] > 0 for w in words(t)), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words(t))) for d, t in rows)
    got = lm_score(df, **sizes).collect()
    ours = sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got)
    assert [x[:5] for x in ours] == [x[:5] for x in want]
    np.testing.assert_allclose([x[5] for x in ours], [x[5] for x in want], rtol=1e-9)
    return got


def test_edge_cases(edge):
    got = check(edge, known=3, words=2, classes=2)
    assert all(r["score"] < 0 for r in got)


def test_held_out_texts_are_likelier_than_by_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = [r for r in check(docs, known=2000) if r["held_out"]]
    n = sum(r["n_tokens"] for r in got)
    net, base = sum(r["score"] for r in got) / n, sum(r["base_score"] for r in got) / n
    assert net > base + 0.05


def test_partitions_and_order_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    sizes = {"known": 500, "words": 100, "classes": 6, "copy_tokens": 20_000}
    runs = [{r["doc_id"]: r["score"] for r in lm_score(docs.repartition(n).orderBy(key) if key else docs.repartition(n), **sizes).collect()} for n, key in ((1, "doc_id"), (7, None), (3, "text"))]
    for other in runs[1:]:
        assert other.keys() == runs[0].keys()
        np.testing.assert_allclose([other[d] for d in runs[0]], list(runs[0].values()), rtol=1e-5)


def test_no_training_documents(spark, empty):
    only = spark.createDataFrame([(d, "a b") for d in range(60) if held(d)], "doc_id long, text string")
    assert {(r["n_known"], r["base_score"]) for r in lm_score(only).collect()} == {(0, 0.0)}
    assert lm_score(empty).collect() == []


def model(hidden=5):
    v = Vocabulary.of([b"a", b"b", b"c", b"d", END, b"rare"], [50, 30, 20, 10, 8, 2], 125, 9, 5, 3)
    return v, Network(v, hidden)


def test_probabilities_sum_to_one():
    _, net = model()
    state = np.random.default_rng(0).standard_normal((1, 5)).astype(np.float32)
    logs, _ = net.output(np.repeat(state, 6, axis=0).T, np.arange(6))
    assert abs(np.exp(logs).sum() - 1) < 1e-5


def test_gradients_against_differences():
    _, net = model()
    net.flat[:] = np.random.default_rng(2).standard_normal(len(net.flat)) * 0.5
    ((x, y, fresh, _),) = Streams([np.array([0, 1, 5, 4]), np.array([2, 4]), np.array([3, 3, 4])], 2, net.words).windows()
    real = y >= 0

    def value():
        states, _, kept = net.run(x, fresh, np.zeros((5, 2), np.float32), keep=True)
        return states, kept, net.output(states[:, real], y[real])[0].sum()

    grad = np.zeros_like(net.flat)
    grads = {k: grad[o : o + math.prod(net.shapes[k])].reshape(net.shapes[k]) for k, o in net.offsets.items()}
    states, kept, _ = value()
    d = np.zeros_like(states)
    d[:, real] = net.output(states[:, real], y[real], grads)[1]
    net.back(x, fresh, kept, d, grads)
    for i in np.random.default_rng(3).choice(len(net.flat), 60, replace=False):
        old = net.flat[i]
        net.flat[i] = old + 1e-2
        up = value()[2]
        net.flat[i] = old - 1e-2
        down = value()[2]
        net.flat[i] = old
        assert abs((up - down) / 2e-2 - grad[i]) < 2e-2 + 0.02 * abs(grad[i])


def test_layout_does_not_change_scores():
    _, net = model()
    rng = np.random.default_rng(4)
    docs = [rng.integers(0, 6, n).astype(np.int32) for n in (1, 40, 7, 300, 3, 90)]
    together = score(net, docs)
    np.testing.assert_allclose(together, [score(net, [d])[0] for d in docs], rtol=1e-4)


def test_memory_follows_tokens_with_one_long_text():
    v, net = model()
    docs = [np.arange(2_000_000, dtype=np.int32) % 5] + [np.arange(200, dtype=np.int32) % 5] * 100
    tracemalloc.start()
    streams = Streams(docs, 512, net.words)
    x, *_ = next(streams.windows())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6 and x.shape[1] <= 512


def test_a_text_of_two_million_words_is_scored_as_a_whole(spark, monkeypatch):
    monkeypatch.setattr(module, "WINDOW", 512)  # one stream is left: fewer, longer steps
    docs = spark.createDataFrame([(d, "one two three " * (666_667 if d == 1 else 20)) for d in range(20)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in lm_score(docs, known=10, words=4, classes=2, hidden=2).collect()}
    assert got[1]["n_tokens"] == 2_000_002 and got[1]["score"] < 0


def test_training_in_stretches_sees_every_token(monkeypatch):
    monkeypatch.setattr(module, "STRETCH", 50)
    _, net = model()
    docs = [np.arange(n, dtype=np.int32) % 5 for n in (1, 50, 51, 777)]
    assert train(net, docs, [np.zeros_like(net.flat), np.zeros_like(net.flat), np.zeros(1)]) == 879


def test_equal_rows_without_id_spread_over_copies(spark):
    docs = spark.createDataFrame([(None, "same text")] * 3000, "doc_id long, text string").repartition(4)
    got = lm_score(docs, known=10, words=3, classes=2, hidden=2, copy_tokens=500)
    assert len({round(r["score"], 4) for r in got.collect()}) == 1


def test_tokens_outside_the_words_have_contexts_too(spark):
    """None of the alternating words is among the network's; their endings say which one follows."""
    docs = spark.createDataFrame([(d, " ".join(f"w{(d * 37 + k * 11) % 997}{'ax' if k % 2 else 'by'}" for k in range(200))) for d in range(400)], "doc_id long, text string")
    sizes = {"known": 3000, "words": 1, "classes": 1, "hidden": 6, "copy_tokens": 10_000_000}
    got = {tails: sum(r["score"] for r in check(docs, tails=tails, **sizes)) / (400 * 201) for tails in (1, 8)}
    assert got[8] > got[1] + 0.2  # log10 of 2 is 0.30


def test_probabilities_of_tail_classes_sum_to_one():
    tokens, counts = [b"the", END, b"aing", b"bing", b"ed"], [50, 30, 9, 5, 4]
    endings = {b"he": (50, 1), b"": (30, 1), b"ng": (14, 2), b"ed": (4, 1), b"x": (1, 1)}
    v = Vocabulary.of(tokens, counts, 99, 6, 2, 2, endings, 3)
    assert v.endings == {b"ng": 0, b"ed": 1} and v.masses.tolist() == [14 + 1.5, 4 + 1, 1 + 1]
    assert v.tail_classes([b"zing", b"ed", b"x", b"", b"other"]).tolist() == [0, 1, 2, 2, 2]
    shares = [sum(c + 0.5 for c in cs) / m for cs, m in zip(((9, 5, 0), (4, 0), (1, 0)), v.masses)]
    np.testing.assert_allclose(shares, 1)
    net = Network(v, 4).start_at_counts(v)
    logs, _ = net.output(np.zeros((4, 5), np.float32), np.arange(5))
    assert abs(np.exp(logs).sum() - 1) < 1e-5
