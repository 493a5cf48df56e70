import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spriteloom.llm import packing
from spriteloom.llm.common import cut
from spriteloom.llm.packing import ChunkEncoder, bin_patterns, cut_points, fullest, pack_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")

ENCODER, LIBRARY = ChunkEncoder(PATH, public_tokenizers.PATTERN), Tokenizer.from_file(PATH)


@pytest.fixture
def tokenizer():
    return LIBRARY


def check(df, tokenizer, capacity=1024):
    got = pack_documents(df, PATH, public_tokenizers.PATTERN, capacity=capacity).collect()
    want = Counter()
    for r in df.collect():
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        for k, (s, n) in enumerate(cut_points(len(ids), capacity)):
            want[r["doc_id"], k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    rows = defaultdict(list)
    for r in got:
        rows[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in rows.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    total = sum(r["length"] for r in got)
    assert len(rows) <= total / capacity * 1.02 + 2


def test_edge_cases(edge, tokenizer):
    check(edge, tokenizer)


def test_documents(small, tokenizer):
    check(small, tokenizer)


def test_ranks_are_summed_up_in_two_levels(spark, monkeypatch):
    monkeypatch.setattr(packing, "SPAN_BUCKETS", 2)
    rows = [(i, 0, 0, 3 + i % 4, i * 7919 % 1000) for i in range(400)] * 2
    got = packing.pack(spark.createDataFrame(rows, packing._PIECES), 16, bucket_rows=20).collect()
    assert Counter((r["doc_id"], r["length"], r["ids_crc32"]) for r in got) == Counter((d, n, c) for d, _, _, n, c in rows)
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in got)
    assert all(o == (0 if s != prev[0] else prev[1] + prev[2]) for prev, (s, o, _) in zip([(None, 0, 0), *places], places))
    assert len({s for s, _, _ in places}) <= sum(n for _, _, n in places) / 16 * 1.02 + 2


def test_empty(empty):
    assert pack_documents(empty, PATH, public_tokenizers.PATTERN).collect() == []


@pytest.mark.parametrize(("n", "want"), [(1, [(0, 1)]), (8, [(0, 8)]), (9, [(0, 1), (1, 8)]), (16, [(0, 8), (8, 8)]), (20, [(0, 4), (4, 8), (12, 8)])])
def test_only_the_first_piece_is_short(n, want):
    assert cut_points(n, 8) == want


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 3), max_size=4), st.integers(0, 25))
def test_fullest_against_brute_force(lengths, room):
    sums = {0}
    for n, c in lengths.items():
        sums = {s + n * k for s in sums for k in range(c + 1)}
    chosen = fullest(lengths, room)
    assert all(k <= lengths[n] for n, k in chosen.items())
    assert sum(n * k for n, k in chosen.items()) == max(s for s in sums if s <= room)


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30))
def test_patterns_use_every_piece_once(histogram):
    used = Counter()
    for pattern, times in bin_patterns(histogram, 64):
        assert sum(n * k for n, k in pattern.items()) <= 64
        for n, k in pattern.items():
            used[n] += k * times
    assert used == histogram


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"ab tH\n\t\u00a0'sll1\u00e92\u00b2!-\u3000\u0085\x1c\U0001f600", "<|endoftext|>"]), max_size=40).map("".join))
def test_chunks_keep_the_tokenizers_ids(text):
    assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_added_tokens_in_texts_are_one_id():
    library = Tokenizer.from_file(PATH)
    for text in ["<|endoftext|>", "a <|endoftext|> b", "x<|endoftext|><|endoftext|>\n y", "<|endoftext| >", "<|endoftext|", " <|endoftext|>  ", ""]:
        assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_equal_rows_without_an_id_spread_over_buckets(spark):
    rows = spark.range(100_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(5).cast("long").alias("length"), F.lit(7).cast("long").alias("ids_crc32"))
    got = packing.pack(cut(rows.repartition(4)), 16, bucket_rows=5_000)
    sizes = got.groupBy(F.col("sequence_id")).agg(F.count("*").alias("n"), F.sum("length").alias("used")).agg(F.max("n"), F.max("used"), F.count("*")).first()
    assert tuple(sizes) == (3, 15, 33_334)
    assert max(r[0] for r in packing.in_buckets(rows, 20).groupBy("bucket").agg(F.count("*")).select("count(1)").collect()) < 6_000
