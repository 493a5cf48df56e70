"""Byte-level BPE by a lazily determinised finite-state transducer.

Byte by byte the transducer keeps every token boundary from which a longer
token could still start, with the one token that ends there.  That token is
fixed by the merges: of the tokens that end at a boundary, exactly one makes a
pair with the token before it that the merges leave alone.  What all kept
boundaries have in common can no longer change, and is emitted; the rest is the
state.  A boundary is kept for less than the longest token, so lookahead is
bounded.  States and transitions are made when a text first needs them and are
then table look-ups.

Decoding looks up each id's bytes and feeds them, in slices, to an incremental
UTF-8 state machine, which holds back an unfinished character until its
remaining bytes arrive.

Cases: a null text counts as empty and has no ids; texts of any length are
handled in chunks; extra columns are ignored; repeated rows give repeated rows;
an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunks
from .common import text_or_empty

_OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: States made by one transducer; beyond it they are forgotten and made anew.
#: A worker keeps some 500 MB of states, pairs, matches and chunks at most.
KEEP_STATES = 350_000
_tools: dict = {}


def load_ranks(path: str) -> dict[bytes, int]:
    """The merges, as ranks of the byte strings that they make."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def merge_all(ranks: dict[bytes, int], data: bytes) -> list[bytes]:
    """The merges applied one by one, lowest rank first: what defines the encoding."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while True:
        best = at = None
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if best is None:
            return parts
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


class State:
    """``before``: the last token emitted.  ``pending``: bytes since.  ``live``: the boundaries from which a
    longer token could still start, each as the tokens that lead to it."""

    __slots__ = ("before", "pending", "live", "next")

    def __init__(self, before: bytes | None, pending: bytes, live: tuple[tuple[bytes, ...], ...]):
        self.before, self.pending, self.live = before, pending, live
        self.next: dict[int, tuple[tuple[int, ...], State]] = {}


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longer = {t[:i] for t in ranks for i in range(1, len(t))}
        self._restart()

    def _restart(self) -> None:
        self.pairs: dict[tuple[bytes | None, bytes], bool] = {}
        self.paths: dict[tuple[bytes, ...], tuple[bytes, ...]] = {}
        self.states: dict[tuple, State] = {}
        self.start = self._state(None, b"", ((),))

    def _state(self, *key) -> State:
        state = self.states.get(key)
        if state is None:
            state = self.states[key] = State(*key)
        return state

    def _agree(self, before: bytes | None, token: bytes) -> bool:
        """Do the merges leave the two tokens as they are when they meet?"""
        known = self.pairs.get((before, token))
        if known is None:
            want = [token] if before is None else [before, token]
            known = self.pairs[before, token] = merge_all(self.ranks, b"".join(want)) == want
        return known

    def _step(self, state: State, byte: int) -> tuple[tuple[int, ...], State]:
        ranks, longer, pending = self.ranks, self.longer, state.pending + bytes((byte,))
        live, ended = [], None
        for path in state.live:
            token = pending[len(b"".join(path)) :]
            if ended is None and token in ranks and self._agree(path[-1] if path else state.before, token):
                ended = (*path, token)
            if token in longer:
                live.append(path)
        if ended:
            live.append(ended)
        first, rest, least, k = live[0], live[1:], min(map(len, live)), 0
        while k < least and all([p[k] == first[k] for p in rest]):
            k += 1
        before = state.before
        if k:  # all paths share these tokens, so they are final
            before, pending = first[k - 1], pending[sum(map(len, first[:k])) :]
            live = [p[k:] for p in live]
        # the token before the origin matters only while another can still start there
        same = self.paths.setdefault
        return tuple([ranks[t] for t in first[:k]]), self._state(b"" if live[0] else before, pending, tuple([same(p, p) for p in live]))

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.states) > KEEP_STATES:
            self._restart()
        state, ids = self.start, []
        for byte in piece:
            step = state.next.get(byte)
            if step is None:
                step = state.next[byte] = self._step(state, byte)
            out, state = step
            if out:
                ids += out
        ids += [self.ranks[t] for t in state.live[-1]]
        return ids


class Codec:
    """Whole texts to ids and back; ids are kept by chunk as packed words and as decimals."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.ranks = load_ranks(path)
        self.transducer = Transducer(self.ranks)
        self.split = regex.compile(pattern).findall
        self.bytes_of = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, i in self.ranks.items():
            self.bytes_of[i] = token
        self.digits = [str(i) for i in range(len(self.bytes_of))]
        self.by_piece = chunks.Memory(self._piece, 150_000)
        self.by_chunk = chunks.Memory(self._chunk, 150_000)

    def _piece(self, piece: str) -> bytes:
        return array("I", self.transducer.encode(piece.encode())).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        return b"".join([self.by_piece[p] for p in chunks.pieces(chunk, self.split)])

    def encode(self, text: str) -> bytes:
        """The ids, packed as 32-bit words."""
        self.by_chunk.turn()
        self.by_piece.turn()
        return b"".join(map(self.by_chunk.__getitem__, chunks.find_chunks(text)))

    def decimals(self, packed: bytes) -> str:
        return ",".join(map(self.digits.__getitem__, memoryview(packed).cast("I")))

    def decode(self, packed: bytes, slice_ids: int = 4096):
        """Yields the text of the ids; no slice ends within a character."""
        machine, bytes_of = codecs.getincrementaldecoder("utf-8")(errors="replace"), self.bytes_of
        ids = memoryview(packed).cast("I")
        for at in range(0, len(ids), slice_ids):
            yield machine.decode(b"".join(map(bytes_of.__getitem__, ids[at : at + slice_ids])))
        yield machine.decode(b"", final=True)


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _tools:
        _tools[path, pattern] = Codec(path, pattern)
    return _tools[path, pattern]


def bpe_round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.  No shuffle."""

    def rows(batches):
        tool = codec(ranks_path, pattern)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                packed = tool.encode(text)
                sha = hashlib.sha256()
                for part in tool.decode(packed):
                    sha.update(part.encode())
                out.append((doc_id, len(packed) // 4, hashlib.sha256(tool.decimals(packed).encode()).hexdigest(), sha.hexdigest()))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(rows, _OUT)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id and its ids, for users who want the ids themselves."""

    def rows(batches):
        tool = codec(ranks_path, pattern)
        for batch in batches:
            ids = [np.frombuffer(tool.encode(t), "<u4").astype(np.int32) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(rows, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """The inverse: doc_id and text from doc_id and ids (null ids: empty text)."""

    def rows(batches):
        tool = codec(ranks_path, pattern)
        for batch in batches:
            texts = ["".join(tool.decode(np.array(ids or [], "<u4").tobytes())) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(rows, "doc_id long, text string")
