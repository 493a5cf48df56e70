"""Packing tokenised documents into training sequences by minimum bin slack.

Lengths are whole numbers up to the capacity, so the histogram of piece lengths
says all that the packing needs and has a fixed size.  For one bin at a time a
subset-sum dynamic program over a bitset finds, around the longest piece left,
the fullest feasible combination of available lengths; that combination is
removed as often as the histogram allows.  The result is a short list of bin
patterns.  Pieces then look up their places in parallel: a piece is known by
its length and its rank among the pieces of that length, and ranks come from
counts per (length, bucket), summed up in two levels, so no length gathers in
one task.

Cases: a null text counts as empty and still yields its end token; documents
longer than the capacity are cut into full pieces, the first of which may be
shorter; repeated rows are packed once each; extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import chunks
from .common import cut, text_or_empty

#: Buckets that one task sums up; sums of spans of so many are summed up after them.
SPAN_BUCKETS = 1_000
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_tools: dict = {}


class ChunkEncoder:
    """Ids by the tokenizers library, packed as little-endian 32-bit words.

    They are kept by chunk and by match of the tokenizer's pattern, so the
    library's merges run once for a match that comes again.  As in the library's
    ``encode(text, add_special_tokens=False)``, an added token that stands in the
    text is one id and splits the text.
    """

    def __init__(self, path: str, pattern: str):
        import regex
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.merge = tokenizer.model.tokenize
        tokens = tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word for t in tokens.values()):
            raise ValueError("added tokens that depend on what stands around them are not supported")
        self.added = {t.content: array("I", [i]).tobytes() for i, t in tokens.items()}
        longest_first = sorted(map(re.escape, self.added), key=len, reverse=True)
        self.split_added = re.compile(f"({'|'.join(longest_first)})").split if self.added else None
        self.split = regex.compile(pattern).findall
        self.letters = _byte_letters()
        self.by_piece = chunks.Memory(self._piece, chunks.KEEP_CHUNKS)
        self.by_chunk = chunks.Memory(self._chunk, chunks.KEEP_CHUNKS)

    def _piece(self, piece: str) -> bytes:
        tokens = self.merge(piece.encode().decode("latin-1").translate(self.letters))
        return array("I", [t.id for t in tokens]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """A chunk that is one piece is remembered as a chunk only; so are the words in others, which are chunks themselves."""
        parts = chunks.pieces(chunk, self.split)
        if len(parts) == 1:
            return self._piece(chunk)
        return b"".join([self.by_chunk[p] if p.removeprefix(" ").isalpha() else self.by_piece[p] for p in parts])

    def encode(self, text: str) -> bytes:
        self.by_chunk.turn()
        self.by_piece.turn()
        if any(token in text for token in self.added):
            return b"".join([self.added[part] if k % 2 else self._plain(part) for k, part in enumerate(self.split_added(text))])
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.by_chunk.__getitem__, chunks.find_chunks(text)))


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself where it prints."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def _encoder(path: str, pattern: str) -> ChunkEncoder:
    if (path, pattern) not in _tools:
        _tools[path, pattern] = ChunkEncoder(path, pattern)
    return _tools[path, pattern]


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be short."""
    first = n if n <= capacity else n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def tokenized_pieces(docs: DataFrame, tokenizer: str, pattern: str, end_id: int, capacity: int) -> DataFrame:
    end = int(end_id).to_bytes(4, "little")

    def pieces(batches):
        encoder = _encoder(tokenizer, pattern)
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for block in chunks.blocks(rows, lambda r: len(r[1])):
                out = []
                for doc_id, text in block:
                    ids = encoder.encode(text) + end
                    for k, (start, n) in enumerate(cut_points(len(ids) // 4, capacity)):
                        out.append((doc_id, k, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)])))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"]
                )

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(pieces, _PIECES)


def fullest(lengths: dict[int, int], room: int) -> dict[int, int]:
    """Of the available lengths (and how many of each), those that fill ``room`` best."""
    mask, sums, steps = (1 << (room + 1)) - 1, 1, []
    for n in sorted(lengths, reverse=True):
        left = min(lengths[n], room // n) if n <= room else 0
        k = 1
        while left > 0 and not sums >> room & 1:
            k = min(k, left)
            steps.append((n, k, sums))
            sums |= (sums << n * k) & mask
            left -= k
            k *= 2
        if sums >> room & 1:
            break
    at, chosen = sums.bit_length() - 1, {}
    for n, k, before in reversed(steps):
        if not before >> at & 1:
            at -= n * k
            chosen[n] = chosen.get(n, 0) + k
    return chosen


def bin_patterns(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(lengths in the bin and how many of each, number of such bins), until nothing is left."""
    left, patterns = {n: c for n, c in histogram.items() if c > 0}, []
    while left:
        longest = max(left)
        rest = left | {longest: left[longest] - 1}
        pattern = fullest({n: c for n, c in rest.items() if c > 0}, capacity - longest)
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(left[n] // k for n, k in pattern.items())
        patterns.append((pattern, times))
        for n, k in pattern.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return patterns


def places(patterns: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Sorted rows (length, first rank, copies in a bin, first sequence, first offset)."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for n in sorted(pattern, reverse=True):
            rows.append((n, used.get(n, 0), pattern[n], sequence, offset))
            used[n] = used.get(n, 0) + pattern[n] * times
            offset += n * pattern[n]
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def _before(counts: DataFrame, group: list[str], order: str) -> DataFrame:
    """Adds ``before``: the sum of ``n`` over what comes earlier in the group."""
    earlier = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def in_buckets(pieces: DataFrame, n_buckets: int) -> DataFrame:
    """Adds ``bucket`` by a hash of the piece and of its place among the rows, so that equal pieces spread too."""
    return pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(n_buckets)))


def pack(pieces: DataFrame, capacity: int, bucket_rows: int = 10_000) -> DataFrame:
    """Adds sequence_id and offset to rows with doc_id, piece and length (cut from lineage before)."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    n_buckets = max(1, math.ceil(sum(counts.values()) / bucket_rows))
    plan = places(bin_patterns(counts, capacity))
    order = plan[:, 0] << 44 | plan[:, 1] if len(plan) else np.zeros(0, np.int64)

    rows = in_buckets(pieces, n_buckets)
    per_bucket = rows.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    per_bucket = per_bucket.withColumn("span", F.floor(F.col("bucket") / SPAN_BUCKETS))
    per_span = per_bucket.groupBy("length", "span").agg(F.sum("n").alias("n"))
    in_span = _before(per_bucket, ["length", "span"], "bucket").withColumnRenamed("before", "in_span")
    firsts = in_span.join(_before(per_span, ["length"], "span").drop("n"), ["length", "span"])
    firsts = firsts.select("length", "bucket", (F.col("in_span") + F.col("before")).alias("first_rank"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = rows.withColumn("nth", F.row_number().over(within)).join(firsts, ["length", "bucket"])
    ranked = ranked.withColumn("rank", F.col("first_rank") + F.col("nth") - 1)

    def look_up(batches):
        for batch in batches:
            n, rank = (np.asarray(batch.column(c), dtype=np.int64) for c in ("length", "rank"))
            hit = plan[np.searchsorted(order, n << 44 | rank, side="right") - 1]
            nth_bin, slot = np.divmod(rank - hit[:, 1], np.maximum(hit[:, 2], 1))
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, names), pa.array(hit[:, 3] + nth_bin), pa.array(hit[:, 4] + slot * n)], names=[*names, "sequence_id", "offset"]
            )

    wanted = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return wanted.mapInArrow(look_up, f"{_PIECES}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, pattern: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    The pieces (a few numbers each) are cut into the shared folder, so texts
    are tokenised once.  The driver sees the histogram only: at most
    ``capacity`` numbers at any size of input.
    """
    return pack(cut(tokenized_pieces(docs, tokenizer, pattern, end_id, capacity)), capacity)
