"""Removal of repeated passages by sorted suffixes.

Every string of ``LENGTH`` bytes holds exactly one window of grams; the least
gram of it, by a hash, is the string's anchor.  Equal strings have equal
anchors at equal places, so only suffixes at anchors need to meet, one in some
hundred and eighty.

1. Each partition packs its rows into chunks, with their anchors, once.  The
   chunks become a table bucketed by chunk in the shared checkpoint folder, so
   that later steps send the chunks messages and never move texts again.
   Grams that are found once are done with.
2. For each other anchor a chunk takes the suffix that starts where the first
   of the anchor's strings starts and ends with the last of them.  It sorts
   these and cuts them at splitters, quantiles of a bounded sample of all suffixes
   (by their first HEAD bytes), into front-coded runs.  The runs of a range are merged by a loser tree that keeps
   every head's common prefix with the last output and so never compares a known
   prefix again; ranges one after the other are one sorted order of all
   suffixes.  The common prefix of neighbours says how many of a suffix's
   strings are repeated.
3. What this leaves open (after an edit inside a suffix) is counted by 128 bits
   of hashes, together with all distinct suffixes of the same gram: first the
   cores that some STEP neighbouring strings share.  A core found once settles
   its strings as unique; one that always stands in the same surroundings
   settles them as repeated.  The strings of the others, at the edges of
   passages, are then counted one by one.  Counts are partial before the
   shuffle, so a passage in a third of all documents is no hot spot.
4. Chunks mark the repeated strings and cut the bytes that these cover.

Passages of words, if asked for, are strings too, of 64-bit hashes of words.
They take steps 1, 3 and 4: all their anchors whose gram is found again are
counted by cores and strings, and nothing of them is sorted.

Equal suffixes, and more than two suffixes of a chunk that start with the same
string, collapse before the exchange; what they leave open is settled in
step 3.

Cases: a null text counts as empty; texts shorter than LENGTH keep all bytes;
rows that repeat id and text repeat each other's strings like any two rows; a
text of any length is handled in pieces, and a long run of one byte or of a few
costs one suffix for each turn of it, not one for each byte; extra columns are
ignored; an empty table gives an empty result; words are parted by ASCII blanks
and compared as they are written, and passages never cross documents.  The input must give a
partition's rows in the same order when it is read again, as files do.  The
tables are dropped in the end, after a failure too.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
import struct
import uuid
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, shared_folder, text_or_empty

LENGTH, GRAM = 400, 32
#: Words of a gram where passages of words are asked for.
WORD_GRAM = 8
#: Neighbouring strings of an anchor that are first counted together.
STEP = 20
#: Ranges of sorted suffixes at most (the driver sees their bounds); beyond it each is dealt out by a hash of a suffix's first string.
MAX_RANGES = 4_096
#: One gram in so many gives a suffix for the sample that bounds the ranges; of it the driver gets so many for each range, by their first bytes.
SAMPLED, SAMPLES, HEAD = 16, 20, 64
#: Bytes of text in a bucket of chunks, about, and the most buckets.
BUCKET_BYTES, MAX_BUCKETS = 100_000_000, 100_000
#: Bytes of text in a chunk, about, and in a piece of a text at most.
CHUNK_BYTES, PIECE_BYTES = 3_000_000, 1_000_000
_U = np.uint64
_LOW = _U((1 << 22) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, _U)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_BASE = 0x9E3779B97F4A7C15
_SIZE = PIECE_BYTES + (1 << 16)
_POW, _INV = _powers(_BASE, _SIZE), _powers(pow(_BASE, -1, 1 << 64), _SIZE)
_BYTE = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=_U)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


_BLANKS = b" ", b"\t", b"\n", b"\v", b"\f", b"\r"
_BLANK = re.compile(b"[" + b"".join(_BLANKS) + b"]")
_INK = np.ones(256, bool)
_INK[list(b"".join(_BLANKS))] = False


def word_codes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word.  About PIECE_BYTES of a text are looked at together; a longer word goes by its digest."""
    parts, at = [np.zeros(0, _U)], 0
    while at < len(text):
        stop = at + PIECE_BYTES
        if stop < len(text):
            last = max(text.rfind(b, at, stop + 1) for b in _BLANKS)
            if last < 0:
                end = found.start() if (found := _BLANK.search(text, stop)) else len(text)
                parts.append(np.frombuffer(hashlib.blake2b(text[at:end], digest_size=8).digest(), _U))
                at = end
                continue
            stop = last + 1
        part = text[at:stop]
        ink = np.concatenate([[False], _INK[np.frombuffer(part, np.uint8)], [False]])
        starts, ends = np.flatnonzero(ink[1:] & ~ink[:-1]), np.flatnonzero(ink[:-1] & ~ink[1:])
        sums = _sums(part)
        parts.append(_mixed((sums[ends] - sums[starts]) * _INV[starts]))
        at = stop
    return np.concatenate(parts)


def _anchors(data: bytes | np.ndarray, sums: np.ndarray, stops: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first string, last string, place, gram) of each anchor of some texts laid end to end."""
    size, width = len(data), length - gram + 1
    n = size - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, _U),)
    grams = _mixed(((sums[gram:] - sums[: size - gram + 1]) * _INV[: size - gram + 1]) ^ _U(length << 20 | gram))
    keys = (grams & ~_LOW) | np.arange(len(grams), dtype=_U)
    blocks = np.concatenate([keys, np.full(-len(keys) % width, ~_U(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    at = (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & _LOW).astype(np.int64)
    doc = np.repeat(np.arange(len(stops)), np.diff(stops, prepend=0))
    whole = doc[:n] == doc[length - 1 :]
    turn = (at[1:] != at[:-1]) | (doc[1:n] != doc[: n - 1])
    lo = np.flatnonzero(whole & np.concatenate([[True], turn | ~whole[:-1]]))
    hi = np.flatnonzero(whole & np.concatenate([turn | ~whole[1:], [True]]))
    return lo, hi, at[lo], grams[at[lo]]


class Piece:
    """Bytes (or codes of words) of one document or several end to end, with the anchors of its strings."""

    def __init__(self, data: bytes | np.ndarray, length: int, lo: np.ndarray, hi: np.ndarray, anchor: np.ndarray, gram: np.ndarray):
        self.data, self.length, self.lo, self.hi, self.anchor, self.gram = data, length, lo, hi, anchor, gram

    @cached_property
    def sums(self) -> np.ndarray:
        return _sums(self.data)

    def hashes(self, starts: np.ndarray, length) -> np.ndarray:
        """Hashes of the bytes from each start on."""
        return _mixed((self.sums[starts + length] - self.sums[starts]) * _INV[starts])


def _sums(data: bytes | np.ndarray) -> np.ndarray:
    values = _BYTE[np.frombuffer(data, np.uint8)] if isinstance(data, bytes) else data
    sums = np.zeros(len(values) + 1, _U)
    np.cumsum(values * _POW[: len(values)], out=sums[1:])
    return sums


def _layout(sizes: list[int], length: int) -> list[list[tuple[int, int, int]]]:
    """The pieces of a chunk: each a list of (document, offset, bytes).  No string is in two of them."""
    pieces, held, room = [], [], PIECE_BYTES
    for i, n in enumerate(sizes):
        for at in range(0, max(1, n - length + 1), PIECE_BYTES - length + 1):
            part = min(n - at, PIECE_BYTES)
            if part > room:
                pieces.append(held)
                held, room = [], PIECE_BYTES
            held.append((i, at, part))
            room -= part
    return [*pieces, held]


def _packed(found: list[tuple]) -> bytes:
    """The anchors of some pieces: how many each has, then their strings and places."""
    lo, hi, anchor, _ = (np.concatenate(x) for x in zip(*found))
    return np.concatenate([[len(x[0]) for x in found], lo, hi - lo, anchor - lo]).astype(np.int32).tobytes()


def _pieces(units: list, layout: list, length: int, spots: bytes, grams: np.ndarray) -> list[Piece]:
    spots = np.frombuffer(spots, np.int32).astype(np.int64)
    counts = spots[: len(layout)].tolist()
    lo, width, back = spots[len(counts) :].reshape(3, -1)
    pieces, at = [], 0
    for parts, n in zip(layout, counts):
        cut_ = slice(at, at := at + n)
        pieces.append(Piece(_joined(units, parts), length, lo[cut_], lo[cut_] + width[cut_], lo[cut_] + back[cut_], grams[cut_]))
    return pieces


def _joined(units: list, parts: list) -> bytes | np.ndarray:
    parts = [units[i][at : at + n] for i, at, n in parts]
    return b"".join(parts) if isinstance(parts[0], bytes) else np.concatenate(parts)


def pack_chunk(number: int, ids: list, texts: list[bytes], length: int, gram: int, words: int = 0) -> pa.RecordBatch:
    """The row of a chunk: its documents, the anchors of their strings, and a sample of its suffixes."""
    found, sample = [], ([], [])
    for piece in _layout([len(t) for t in texts], length):
        data = _joined(texts, piece)
        spots = _anchors(data, _sums(data), np.cumsum([n for _, _, n in piece]), length, gram)
        found.append(spots)
        some = np.flatnonzero(spots[3] % _U(SAMPLED) == 0)
        sample[0].extend(spots[3][some].view(np.int64).tolist())
        sample[1].extend(data[a : a + HEAD] for a in spots[0][some].tolist())
    codes, spoken = [word_codes(t) for t in texts] if words else [], []
    for piece in _layout([len(c) for c in codes], words) if words else ():
        data = _joined(codes, piece)
        spoken.append(_anchors(data, _sums(data), np.cumsum([n for _, _, n in piece]), words, min(WORD_GRAM, words)))
    grams = np.concatenate([x[3] for x in found + spoken])
    pack = zstandard.ZstdCompressor(level=3).compress
    row = [[number], [ids], [[len(t) for t in texts]], [pack(b"".join(texts))], [pack(_packed(found))], [[len(c) for c in codes]], [pack(_packed(spoken)) if words else None], [grams.view(np.int64)], [sample[0]], [sample[1]]]
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, _CHUNK)], schema=_CHUNK)


class Chunk:
    """Documents of a chunk in a fixed order, as pieces."""

    def __init__(self, table: pa.Table, length: int):
        row = {c: table.column(c)[0] for c in table.column_names}
        unpack = zstandard.ZstdDecompressor().decompress
        self.ids, sizes = row["ids"].as_py(), row["sizes"].as_py()
        body, ends = unpack(row["body"].as_py()), np.cumsum([0, *sizes]).tolist()
        self.texts = [body[a:b] for a, b in zip(ends, ends[1:])]
        self.layout = _layout(sizes, length)
        self.grams = np.asarray(row["grams"].values).view(_U)
        self.pieces = _pieces(self.texts, self.layout, length, unpack(row["spots"].as_py()), self.grams)
        self.n_words, self.word_spots = row["words"].as_py(), row["word_spots"].as_py()

    def spoken(self, words: int) -> tuple[list[Piece], list]:
        """The pieces of its words, and their layout."""
        layout = _layout(self.n_words, words)
        grams = self.grams[sum(len(p.gram) for p in self.pieces) :]
        return _pieces([word_codes(t) for t in self.texts], layout, words, zstandard.ZstdDecompressor().decompress(self.word_spots), grams), layout

    def suffixes(self, grams: np.ndarray) -> tuple[list[tuple[int, int, int, int, bytes]], list[np.ndarray], list[tuple[int, int]]]:
        """Of the anchors with these grams: the distinct suffixes in order, as (number, copies, gram, strings, suffix);
        for each piece its anchors and their suffixes' numbers; for each suffix the piece and number of one anchor."""
        index: dict[bytes, int] = {}
        own, firsts = [], []
        for k, p in enumerate(self.pieces):
            at = np.flatnonzero(np.isin(p.gram, grams))
            which = []
            for j, a, b in zip(at.tolist(), p.lo[at].tolist(), (p.hi[at] + p.length).tolist()):
                which.append(i := index.setdefault(p.data[a:b], len(index)))
                if i == len(firsts):
                    firsts.append((k, j))
            own.append((at, np.array(which, np.int64)))
        order = sorted(index)
        old = np.array([index[t] for t in order], np.int64)
        rank = np.empty(len(old), np.int64)
        rank[old] = np.arange(len(old))
        where = [(at, rank[which]) for at, which in own]
        copies = np.bincount(np.concatenate([w for _, w in where]), minlength=len(old)).tolist() if len(old) else []
        firsts = [firsts[i] for i in old.tolist()]
        entries = []
        for n, (text, (k, j)) in enumerate(zip(order, firsts)):
            p = self.pieces[k]
            entries.append((n, copies[n], int(p.gram[j]), int(p.hi[j] - p.lo[j]) + 1, text))
        return entries, where, firsts


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    low, high = known, n  # equal up to low, not up to high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class LoserTree:
    """Merges sorted runs of (common prefix with the one before, string, tag)."""

    def __init__(self, runs):
        self.runs = [iter(r) for r in runs]
        k = len(self.runs)
        self.heads, self.known = [None] * k, [0] * k
        for i in range(k):
            self._pull(i)
        self.size = 1 << max(0, k - 1).bit_length()
        self.losers = [-1] * self.size
        winners = [-1] * self.size + [i if i < k else -1 for i in range(self.size)]
        for node in range(self.size - 1, 0, -1):
            winners[node], self.losers[node] = self._play(winners[2 * node], winners[2 * node + 1])
        self.best = winners[1]

    def _pull(self, i: int) -> None:
        self.heads[i] = head = next(self.runs[i], None)
        if head is not None:
            self.known[i] = head[0]

    def _play(self, i: int, j: int) -> tuple[int, int]:
        """(winner, loser); the loser then knows its common prefix with the winner."""
        if j < 0 or self.heads[j] is None:
            return i, j
        if i < 0 or self.heads[i] is None:
            return j, i
        if self.known[i] != self.known[j]:
            return (i, j) if self.known[i] > self.known[j] else (j, i)
        a, b = self.heads[i][1], self.heads[j][1]
        n = common(a, b, self.known[i])
        win, lose = (i, j) if a[n : n + 1] <= b[n : n + 1] else (j, i)
        self.known[lose] = n
        return win, lose

    def __iter__(self):
        """(common prefix with the one before, string, run, tag) in order."""
        while self.best >= 0 and self.heads[self.best] is not None:
            i = self.best
            yield self.known[i], self.heads[i][1], i, self.heads[i][2]
            self._pull(i)
            node = (i + self.size) // 2
            while node:
                i, self.losers[node] = self._play(i, self.losers[node])
                node //= 2
            self.best = i


#: Of an entry in a run: its number, copies in the chunk (negative: others of its start are left out), gram, strings, common prefix with the one before, bytes that follow.
_ENTRY = struct.Struct("<iiQiHi")


def pack_run(entries: list[tuple[int, int, int, int, bytes]]) -> bytes:
    """Front-coded: of each string only what follows the common prefix with the one before."""
    out, last = [], b""
    for number, copies, gram, strings, text in entries:
        n = min(common(last, text, 0), 65_535)
        out += [_ENTRY.pack(number, copies, gram, strings, n, len(text) - n), text[n:]]
        last = text
    return b"".join(out)


def unpack_run(blob: bytes):
    at, last = 0, b""
    while at < len(blob):
        number, copies, gram, strings, n, rest = _ENTRY.unpack_from(blob, at)
        at += _ENTRY.size
        last = last[:n] + blob[at : at + rest]
        at += rest
        yield n, last, (number, copies, gram, strings)


def _signed(x) -> int:
    return int(x) - (1 << 64) if int(x) >= 1 << 63 else int(x)


def _of_gram(hashes: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Hashes that differ for different grams, so that a chunk needs no gram to know them again."""
    return _mixed(hashes ^ (gram * _U(0xD6E8FEB86659FD93)))


def _spread(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the range, value) of all values of ranges that start at ``first`` with ``n`` values each."""
    which = np.repeat(np.arange(len(n)), n)
    return which, first[which] + np.arange(len(which)) - (np.cumsum(n) - n)[which]


_CHUNK = pa.schema([("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("body", pa.binary()), ("spots", pa.binary()), ("words", pa.list_(pa.int32())), ("word_spots", pa.binary()), ("grams", pa.list_(pa.int64())), ("sample_grams", pa.list_(pa.int64())), ("sample_heads", pa.list_(pa.binary()))])
_RUNS = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("run", pa.binary())])
_ITEMS = pa.schema([("chunk", pa.int64()), ("number", pa.int32()), ("gram", pa.int64()), ("same", pa.int32()), ("speaks", pa.bool_()), ("open", pa.bool_())])
#: Of counted things: flag is how often (1 or 2 for more), and 4 more if the chunk asks for the answer; least and most are the bounds of the hashes of a core's surroundings.
_COUNTED = pa.schema([("chunk", pa.int64()), ("gram", pa.list_(pa.int64())), ("hash", pa.list_(pa.int64())), ("least", pa.list_(pa.int64())), ("most", pa.list_(pa.int64())), ("flag", pa.list_(pa.int8()))])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("n_passage_words", pa.int64()), ("kept", pa.binary())])
#: What a chunk is told: its repeated grams; what the merge says of a suffix, its gram in doubt or not; cores whose strings are all repeated, or open; repeated strings.
_GRAM, _DOUBT, _SETTLED, _WHOLE, _MIXED, _STRING = range(6)


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary", pa.bool_(): "boolean", pa.string(): "string", pa.int8(): "byte"}
    return ", ".join(f"`{f.name}` " + (f"array<{names[f.type.value_type]}>" if pa.types.is_list(f.type) else names[f.type]) for f in schema)


def _table(rows: list, schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)


class Findings:
    """A chunk with what it was told: its distinct suffixes, how much of each is repeated, and which are in doubt."""

    def __init__(self, table: pa.Table, messages: pa.Table, length: int, step: int, words: int = 0):
        self.chunk, self.step = Chunk(table, length), step
        kind, x, y, z = (messages.column(c).to_numpy() for c in ("kind", "x", "y", "z"))
        self.told = lambda k: x[kind == k].view(_U)
        entries, self.where, firsts = self.chunk.suffixes(self.told(_GRAM))
        texts = [e[4] for e in entries]
        near = [0, *(common(a, b, 0) for a, b in zip(texts, texts[1:])), 0]
        same = [len(t) if e[1] > 1 else max(near[k], near[k + 1]) for k, (t, e) in enumerate(zip(texts, entries))]
        counted = [True] * len(texts)
        says = kind <= _SETTLED
        for code, number, m, speaks in zip(kind[says].tolist(), x[says].tolist(), y[says].tolist(), z[says].tolist()):
            if code != _GRAM:
                same[number] = max(same[number], m)
                counted[number] = code == _DOUBT and (speaks or same[number] < len(texts[number]))
        self.sure = np.array([max(0, m - len(t) + e[3]) for m, t, e in zip(same, texts, entries)], np.int64)
        by_piece: list[list] = [[] for _ in self.chunk.pieces]
        for k, wanted in enumerate(counted):
            if wanted:
                piece, j = firsts[k]
                by_piece[piece].append((j, self.sure[k], same[k] == len(texts[k])))
        self.doubts = [(p, *np.array(d, np.int64).T) for p, d in zip(self.chunk.pieces, by_piece) if d]
        self.spoken, self.spoken_layout = self.chunk.spoken(words) if words else ([], [])
        for p in self.spoken:  # nothing is known of passages of words yet
            at = np.flatnonzero(np.isin(p.gram, self.told(_GRAM)))
            if len(at):
                self.doubts.append((p, at, np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)))

    def cores(self):
        """For each piece: gram, core, surroundings, first and last string of a core, strings sure, found more than once."""
        for p, j, sure, twice in self.doubts:
            lo, hi, at, step = p.lo[j], p.hi[j], p.anchor[j], min(self.step, p.length)
            first = (at - hi) // step
            e, turn = _spread(first, (at - lo) // step - first + 1)
            place = at[e] - step * turn
            a, b = np.maximum(lo[e], place - step + 1), np.minimum(hi[e], place)
            gram = p.gram[j][e]
            core = _of_gram(p.hashes(place, p.length - step + 1), gram)
            yield p, gram, core, p.hashes(a, b - a + p.length), a, b, (lo + sure)[e], twice[e]

    def strings(self, answer: int):
        """For each piece: gram, hash and start of the strings of cores that were answered so, strings sure, found more than once."""
        known = self.told(answer)
        for p, gram, core, _, a, b, sure, twice in self.cores():
            hit = np.flatnonzero(np.isin(core, known))
            e, start = _spread(a[hit], (b - a + 1)[hit])
            e = hit[e]
            yield p, gram[e], _of_gram(p.hashes(start, p.length), gram[e]), start, sure[e], twice[e]


def _collapsed(chunk: int, parts: list[tuple]) -> pa.Table:
    """One row for a chunk, from parts (gram, hash, surroundings, found more than once, asked for), each hash named once."""
    if not parts:
        return _table([], _COUNTED)
    gram, key, wide, twice, asks = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(key, kind="stable")
    ranked, own = key[order], wide[order].view(np.int64)
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])[: len(key)])
    if not len(first):
        return _table([], _COUNTED)
    n = np.diff(np.append(first, len(key)))
    least, most = np.minimum.reduceat(own, first), np.maximum.reduceat(own, first)
    times = 1 + ((n > 1) | np.logical_or.reduceat(twice[order].astype(bool), first))
    flag = times + 4 * np.logical_or.reduceat(asks[order], first)
    return _table([(chunk, gram[order[first]].view(np.int64), ranked[first].view(np.int64), least, most, flag.astype(np.int8))], _COUNTED)


def _covered(starts: list[np.ndarray], length: int, size: int) -> np.ndarray:
    """Which of ``size`` places lie in a string that starts at one of these."""
    change = np.zeros(size + 1, np.int32)
    for s in starts:
        change[s] += 1
        change[s + length] -= 1
    return np.cumsum(change[:-1]) > 0


def suffix_dedup(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    chunk_bytes: int = CHUNK_BYTES,
    step: int = STEP,
    max_ranges: int = MAX_RANGES,
    with_text: bool = False,
    words: int = 0,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes if asked for.

    With ``words``, n_passage_words too: how many of its words lie in passages of so many words that start anywhere
    else as well, whatever bytes they have.  They are counted only; what is removed goes by bytes.
    Its tables stand in a database of their own in the shared folder, so the session's catalog must take new ones.
    """
    spark = docs.sparkSession
    own_space = f"suffix_{uuid.uuid4().hex}"  # its tables go with it
    spark.sql(f"CREATE DATABASE {own_space} LOCATION '{shared_folder(spark)}/{own_space}'")
    try:
        return cut(_dedup(docs, own_space, length, gram, chunk_bytes, step, max_ranges, with_text, words))
    finally:
        spark.sql(f"DROP DATABASE {own_space} CASCADE")


def _dedup(docs: DataFrame, own_space: str, length: int, gram: int, chunk_bytes: int, step: int, max_ranges: int, with_text: bool, words: int) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    n_runs = max(8, math.ceil(total / chunk_bytes))
    n_ranges = min(n_runs, max_ranges)
    n_shares = math.ceil(n_runs / n_ranges)
    n_buckets = min(MAX_BUCKETS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / BUCKET_BYTES)))

    def pack(batches):
        number, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                texts.append(text.as_py())
                size += len(texts[-1])
                if size >= chunk_bytes:
                    yield pack_chunk(number, ids, texts, length, gram, words)
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield pack_chunk(number, ids, texts, length, gram, words)

    packed = rows.select("doc_id", F.col("text").cast("binary")).mapInArrow(pack, _ddl(_CHUNK))
    packed.repartition(n_buckets, "chunk").write.bucketBy(n_buckets, "chunk").option("compression", "none").saveAsTable(f"{own_space}.chunks")
    chunks = spark.table(f"{own_space}.chunks")

    def keep(df: DataFrame, name: str) -> DataFrame:
        """Cuts the lineage at a table, which takes less room than a checkpoint and goes at the end."""
        df.write.option("compression", "zstd").saveAsTable(f"{own_space}.{name}")
        return spark.table(f"{own_space}.{name}")

    def ask(told: DataFrame, answer, schema: pa.Schema) -> DataFrame:
        return chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(answer, _ddl(schema))

    often = keep(chunks.select(F.explode("grams").alias("found")).groupBy("found").count().where("count > 1").select("found"), "often")
    own = chunks.select("chunk", F.explode(F.array_distinct("grams")).alias("gram"))
    again = keep(own.join(often, F.col("gram") == F.col("found"), "left_semi"), "again")
    some = chunks.select(F.inline(F.arrays_zip(F.col("sample_grams").alias("gram"), F.col("sample_heads").alias("head"))))
    some = some.join(often, F.col("gram") == F.col("found"), "left_semi")
    n_heads = some.count()
    heads = sorted(bytes(r["head"]) for r in some.select("head").sample(min(1.0, SAMPLES * n_ranges / max(1, n_heads)), 5).limit(2 * SAMPLES * n_ranges).collect())
    splitters = sorted({heads[k * len(heads) // n_ranges] for k in range(1, n_ranges)}) if heads else []

    def sort_runs(key, table, messages):
        entries, _, _ = Chunk(table, length).suffixes(messages.column("gram").to_numpy().view(_U))
        buckets: dict[int, list] = {}
        alike, last, bucket = 0, None, 0
        for e in entries:
            k = bisect.bisect_right(splitters, e[4][:HEAD])
            start = e[4][: len(e[4]) - e[3] + 1]
            if start != last:
                alike, last = 0, start
                share = int.from_bytes(hashlib.blake2b(last, digest_size=4).digest()) % n_shares if n_shares > 1 else 0
                bucket = k * n_shares + share
            alike += 1
            if alike <= 2:
                buckets.setdefault(bucket, []).append(e)
            else:  # the last one kept with this start speaks for those left out: their gram is in doubt
                own = buckets[bucket]
                own[-1] = (own[-1][0], -abs(own[-1][1]), *own[-1][2:])
        pack_ = zstandard.ZstdCompressor(level=3).compress
        return _table([(key[0].as_py(), b, pack_(pack_run(es))) for b, es in buckets.items()], _RUNS)

    def merge_runs(key, table):
        unpack = zstandard.ZstdDecompressor().decompress
        runs = [unpack_run(unpack(r)) for r in table.column("run").to_pylist()]
        owners = table.column("chunk").to_pylist()
        merged = [(n, owners[i], len(text), tag) for n, text, i, tag in LoserTree(runs)]
        out = []
        for k, (n, owner, size, (number, copies, g, _)) in enumerate(merged):
            after = merged[k + 1][0] if k + 1 < len(merged) else 0
            same = size if abs(copies) > 1 else max(n if k else 0, after)
            first = not (k and n == size == merged[k - 1][2])
            out.append((owner, number, _signed(g), same, first, copies < 0 or same < size))
        return _table(out, _ITEMS)

    items = keep(ask(again, sort_runs, _RUNS).groupBy("bucket").applyInArrow(merge_runs, _ddl(_ITEMS)), "items")
    in_doubt = keep(items.where("open").select(F.col("gram").alias("doubt")).distinct(), "in_doubt")  # else a hot gram could not be split in the join
    joined = items.join(in_doubt, F.col("gram") == F.col("doubt"), "left")
    says = joined.select("chunk", F.when(F.col("doubt").isNull(), _SETTLED).otherwise(_DOUBT).alias("kind"), F.col("number").cast("long").alias("x"), F.col("same").alias("y"), F.col("speaks").alias("z"))

    def message(df: DataFrame, kind, x: str) -> DataFrame:
        return df.select("chunk", kind.alias("kind"), F.col(x).alias("x"), F.lit(0).alias("y"), F.lit(False).alias("z"))

    told = message(again, F.lit(_GRAM), "gram").unionByName(says)

    def spell_cores(key, table, messages):
        found = Findings(table, messages, length, step, words)
        return _collapsed(key[0].as_py(), [(g, core, wide, twice, b >= sure) for _, g, core, wide, _, b, sure, twice in found.cores()])

    def spell_strings(key, table, messages):
        found = Findings(table, messages, length, step, words)
        return _collapsed(key[0].as_py(), [(g, h, np.zeros(len(h), _U), twice, start >= sure) for _, g, h, start, sure, twice in found.strings(_MIXED)])

    def answers(spelled: DataFrame) -> DataFrame:
        """(chunk, hash, whole): the things found more than once, and whether always in the same surroundings; for those who asked, and where they weren't, for all who named them."""
        one = spelled.select("chunk", F.inline(F.arrays_zip("gram", "hash", "least", "most", "flag")))
        counts = one.groupBy(F.col("gram").alias("g"), F.col("hash").alias("h")).agg(F.sum(F.col("flag") % 4).alias("n"), (F.min("least") == F.max("most")).alias("whole"), F.max(F.col("flag") >= 4).alias("asked"))
        got = one.join(counts.where("n > 1 AND asked"), (F.col("gram") == F.col("g")) & (F.col("hash") == F.col("h")))
        return got.where("flag >= 4 OR NOT whole").select("chunk", "hash", "whole")

    cores = keep(answers(keep(ask(told, spell_cores, _COUNTED), "spelled_cores")), "cores")
    told = told.unionByName(message(cores, F.when(F.col("whole"), _WHOLE).otherwise(_MIXED), "hash"))
    strings = answers(keep(ask(told, spell_strings, _COUNTED), "spelled_strings"))
    told = told.unionByName(message(strings, F.lit(_STRING), "hash"))

    def remove(key, table, messages):
        found = Findings(table, messages, length, step, words)
        chunk = found.chunk
        marks = {id(p): np.zeros(len(p.data) + 1, bool) for p in chunk.pieces + found.spoken}
        for p, (at, number) in zip(chunk.pieces, found.where):
            sure = np.minimum(found.sure[number], p.hi[at] - p.lo[at] + 1)
            marks[id(p)][_spread(p.lo[at], sure)[1]] = True
        for p, _, _, start, *_ in found.strings(_WHOLE):
            marks[id(p)][start] = True
        known = found.told(_STRING)
        for p, _, h, start, *_ in found.strings(_MIXED):
            marks[id(p)][start[np.isin(h, known)]] = True

        def by_document(pieces, layout):
            starts: list[list] = [[] for _ in chunk.ids]
            for p, parts in zip(pieces, layout):
                hit, begin = np.flatnonzero(marks[id(p)]), 0
                for doc, offset, n in parts:
                    a, b = np.searchsorted(hit, (begin, begin + n))
                    if b > a:
                        starts[doc].append(hit[a:b] - begin + offset)
                    begin += n
            return starts

        out, spoken = [], by_document(found.spoken, found.spoken_layout)
        for k, (doc_id, text, own) in enumerate(zip(chunk.ids, chunk.texts, by_document(chunk.pieces, chunk.layout))):
            kept, n_removed, spans = text, 0, 0
            n_words = int(_covered(spoken[k], words, chunk.n_words[k]).sum()) if spoken[k] else 0
            if own:
                gone = _covered(own, length, len(text))
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                n_removed, spans = int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            out.append((doc_id, len(text), n_removed, spans, hashlib.sha256(kept).hexdigest(), n_words, kept if with_text else None))
        return _table(out, _OUT)

    done = ask(told, remove, _OUT)
    return done.drop(*[c for c, asked in (("kept", with_text), ("n_passage_words", words)) if not asked])
