import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from spriteloom.llm.bpe import Codec, Transducer, bpe_round_trip, decode_documents, encode_documents, merge_all

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
CODEC = Codec(PATH, PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=CODEC.ranks, special_tokens={})


def check(df):
    want = []
    for r in df.collect():
        ids = LIBRARY.encode_ordinary(r["text"] or "")
        want.append((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert sorted((tuple(r) for r in bpe_round_trip(df, PATH, PATTERN).collect()), key=str) == sorted(want, key=str)


def test_edge_cases(edge):
    check(edge)


def test_documents(small):
    check(small)


def test_empty(empty):
    assert bpe_round_trip(empty, PATH, PATTERN).collect() == []


def test_round_trip(edge):
    back = decode_documents(encode_documents(edge, PATH, PATTERN), PATH, PATTERN).collect()
    assert sorted(map(str, [(r["doc_id"], r["text"]) for r in back])) == sorted(map(str, [(r["doc_id"], r["text"] or "") for r in edge.collect()]))


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.text(st.sampled_from("abthe ing\n\t\u00a0'sll1\u00e92\u00b2!-\u3000\u65e5"), max_size=80))
def test_against_the_library(text):
    packed = CODEC.encode(text)
    assert np.frombuffer(packed, "<u4").tolist() == LIBRARY.encode_ordinary(text)
    assert CODEC.decimals(packed) == ",".join(map(str, LIBRARY.encode_ordinary(text)))
    assert "".join(CODEC.decode(packed, slice_ids=1)) == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"aa", b"ab", b"ba", b"aab", b"aba", b"bb", b"abab", b"baa"]), unique=True, max_size=6), st.text("ab", min_size=1, max_size=20))
def test_transducer_against_plain_merges(merges, text):
    ranks = {b"a": 0, b"b": 1}
    for m in merges:  # as merges: the two parts must be there before
        if any(m[:i] in ranks and m[i:] in ranks for i in range(1, len(m))):
            ranks[m] = len(ranks)
    ranks = {t: r for t, r in ranks.items() if merge_all(ranks, t) == [t]}
    data = text.encode()
    want = [ranks[data]] if data in ranks else [ranks[t] for t in merge_all(ranks, data)]
    assert Transducer(ranks).encode(data) == want


@pytest.mark.parametrize("n", [1, 2, 3])
def test_unfinished_character_is_held_back(n):
    packed = CODEC.encode("\u65e5\u672c\U0001f600\U0001d4b3")
    assert "\ufffd" not in "".join(CODEC.decode(packed, slice_ids=n))
