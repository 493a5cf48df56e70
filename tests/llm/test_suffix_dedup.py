import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spriteloom.llm.suffix_dedup import PIECE_BYTES, LoserTree, common, pack_run, suffix_dedup, unpack_run, word_codes


def brute(rows, length):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for d, t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((d, len(t), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()))
    return sorted(out, key=str)


def check(df, length=400, **options):
    got = suffix_dedup(df, length=length, **options).collect()
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute(rows, length)


def test_documents(small):
    check(small)


def test_edge_cases(edge):
    check(edge)


def test_empty(empty):
    assert suffix_dedup(empty).collect() == []


def test_crossed_passages(spark):
    rng = random.Random(2)
    passages = ["".join(rng.choices("abcd ", k=rng.randint(20, 120))) for _ in range(8)]
    rows = []
    for i in range(120):
        parts = [rng.choice(passages)[rng.randint(0, 15) :] if rng.random() < 0.6 else "".join(rng.choices("abcdé ", k=rng.randint(1, 60))) for _ in range(6)]
        rows.append((i, "".join(parts)))
    rows += [(500, "a" * 300), (501, "a" * 41 + "b" + "a" * 39), (502, "ab" * 100)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), length=40, gram=8, chunk_bytes=1500, step=4)


def test_one_passage_in_very_many_texts(spark):
    rng = random.Random(4)
    word = lambda k: "".join(rng.choices("abcdefgh", k=k))
    hot = word(70)
    rows = [(i, word(rng.randint(0, 30)) + hot[rng.randint(0, 9) :] + word(rng.randint(0, 30))) for i in range(300)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), length=40, gram=8, chunk_bytes=5000, step=3)


def test_ranges_dealt_out_again(spark):
    rng = random.Random(6)
    lines = ["".join(rng.choices("abcdefg ", k=70)) for _ in range(40)]
    rows = [(i, "".join(rng.choices(lines, k=3))) for i in range(200)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), length=40, gram=8, chunk_bytes=800, step=4, max_ranges=3)


def test_ranges_of_suffixes_that_begin_alike(spark):
    """The first bytes of all lines are the same: splitters look further."""
    rng = random.Random(7)
    lines = ["\n" * 12 + "".join(rng.choices("abcdefg ", k=70)) for _ in range(40)]
    rows = [(i, "".join(rng.choices(lines, k=3))) for i in range(200)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), length=40, gram=8, chunk_bytes=800, step=4)


def test_long_runs_of_one_byte_or_a_few(spark):
    rows = [(1, "a" * 1_000_000), (2, "ab " * 300_000), (3, "b" * 399)]
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1_000_000, 1), 2: (900_000, 1), 3: (0, 0)}


def test_no_table_stays(spark, small):
    before = {d.name for d in spark.catalog.listDatabases()}
    assert suffix_dedup(small.limit(5)).count() == 5
    assert {d.name for d in spark.catalog.listDatabases()} == before


def test_no_table_stays_after_a_failure(spark, small):
    before = {d.name for d in spark.catalog.listDatabases()}
    with pytest.raises(Exception, match="ZeroDivisionError"):
        suffix_dedup(small.withColumn("text", F.udf(lambda t: 1 // 0)("text")))
    assert {d.name for d in spark.catalog.listDatabases()} == before


def test_text_of_several_pieces(spark):
    rng = random.Random(5)
    text = rng.randbytes(1_300_000).hex()
    df = spark.createDataFrame([(1, text), (2, text[999_700:1_000_300]), (3, text[:399])], "doc_id long, text string")
    assert {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in suffix_dedup(df).collect()} == {1: (600, 1), 2: (600, 1), 3: (0, 0)}


def test_loser_tree_and_front_coding():
    rng = random.Random(1)
    runs = []
    for r in range(7):
        words = sorted("".join(rng.choices("ab", k=rng.randint(1, 9))).encode() for _ in range(rng.randint(0, 30)))
        runs.append([(i, 1, r, 1, w) for i, w in enumerate(words)])
    merged = list(LoserTree([unpack_run(pack_run(r)) for r in runs]))
    assert [m[1] for m in merged] == sorted(w for r in runs for *_, w in r)
    assert all(m[0] == common(a[1], m[1], 0) for a, m in zip(merged, merged[1:]))


def brute_words(rows, words):
    texts = [(d, (t or "").encode().split()) for d, t in rows]
    seen = Counter(tuple(t[i : i + words]) for _, t in texts for i in range(len(t) - words + 1))
    return sorted(((d, len({i + k for i in range(len(t) - words + 1) if seen[tuple(t[i : i + words])] > 1 for k in range(words)})) for d, t in texts), key=str)


def check_words(df, words, **options):
    got = suffix_dedup(df, words=words, **options).collect()
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert sorted(((r["doc_id"], r["n_passage_words"]) for r in got), key=str) == brute_words(rows, words)
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute(rows, options.get("length", 400))


def test_passages_of_over_50_words_in_less_than_400_bytes(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(n)) for n in (51, 52, 60, 50)]
    assert all(len(p) < 400 for p in passages)
    rows = [(i, " \n".join([" ".join(word() for _ in range(rng.randint(0, 80))), passages[i % 4], word()])) for i in range(60)]
    rows += [(100, passages[0].replace(" ", "\t\x0b")), (101, " ".join(passages[1].split()[:50])), (102, "a " * 300), (103, None), (None, passages[2].upper())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check_words(df, 51)
    got = {r["doc_id"]: r["n_passage_words"] for r in suffix_dedup(df, words=51).collect()}
    assert [got[i] for i in (0, 1, 2, 3, 100, 101, 102)] == [51, 52, 60, 0, 51, 0, 300]


def test_crossed_passages_of_words(spark):
    rng = random.Random(9)
    words = ["x", "yy", "\u00e9", "zzz"]
    passages = [rng.choices(words, k=rng.randint(5, 30)) for _ in range(8)]
    rows = [(i, " ".join(w for _ in range(6) for w in (rng.choice(passages)[rng.randint(0, 4) :] if rng.random() < 0.6 else rng.choices(words, k=rng.randint(1, 15))))) for i in range(120)]
    check_words(spark.createDataFrame(rows, "doc_id long, text string"), 12, length=40, gram=8, chunk_bytes=1500, step=4)


def test_codes_of_words():
    text = b" one two\tone " + b"x" * (PIECE_BYTES - 3) + b" y " + b"z" * (PIECE_BYTES + 1) + b"\x0bone " + b"two " * 300_000 + b"z" * (PIECE_BYTES + 1)
    codes = word_codes(text)
    names = text.split()
    assert len(codes) == len(names) and len(set(codes.tolist())) == len(set(names)) == len(set(zip(codes.tolist(), names)))
    assert len(word_codes(b"")) == len(word_codes(b" \n")) == 0
