"""SimHash near-duplicates by tiled exact comparison.

Fingerprints collapse to distinct values first, so copies cost nothing more.
Distinct values are laid out in tiles of equal population count.  Two values
within the radius have population counts within the radius, so a tile meets
only tiles of its own count and of the next ``radius`` counts; all other tile
pairs are skipped.  A pair of tiles is compared in numpy by exclusive-or and
bit count, and yields a spanning forest of its links instead of all pairs, so
a group of thousands of near copies yields thousands of links.  The links'
components come from distributed star contraction.

Cases: a null text counts as empty; texts without words have fingerprint zero
and link like any other; a null ``doc_id`` takes part but is no smallest id
unless all ids of the component are null; repeated rows give repeated rows;
extra columns are ignored; an empty table gives an empty result; a text of any
length is read as a whole.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, text_or_empty
from .components import components

SEED, RADIUS, SHINGLE, TILE, BLOCK = 42, 4, 4, 4096, 16


def shingle_hashes(text: str, width: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of every shingle of ``width`` words, repeats included."""
    words = text.encode().lower().split()  # of bytes: A-Z and ASCII blanks only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-width].tolist()]
    h = xxhash.xxh64_intdigest
    return np.array([h(joined[a : b - 1], seed) for a, b in zip(starts, ends[width - 1 :].tolist())], np.uint64)


def fingerprint(text: str, width: int = SHINGLE, seed: int = SEED) -> int:
    """A bit is set where it is set in over half of the hashes; no words: zero."""
    hashes = shingle_hashes(text, width, seed)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        ones += np.unpackbits(hashes[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE, seed: int = SEED, key_col: str | None = None) -> DataFrame:
    """doc_id, fp (the unsigned value as a signed long) and key (the binary column ``key_col``, or null), one row per document."""

    def rows(batches):
        for batch in batches:
            values = np.array([fingerprint(t, width, seed) for t in batch.column(2).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values), batch.column(1)], names=["doc_id", "fp", "key"])

    key = F.col(key_col) if key_col else F.lit(None)
    return docs.select(F.col("doc_id").cast("long"), key.cast("binary").alias("key"), text_or_empty().alias("text")).mapInArrow(rows, "doc_id long, fp long, key binary")


def _tile(key, rows):
    """The values of one (count, part) as one row."""
    values = np.sort(np.asarray(rows.column("fp")).view(np.uint64))
    schema = pa.schema([("count", pa.int32()), ("part", pa.int32()), ("fps", pa.binary())])
    return pa.Table.from_pylist([{"count": key[0].as_py(), "part": key[1].as_py(), "fps": values.tobytes()}], schema=schema)


def make_tiles(values: DataFrame, tile: int) -> tuple[DataFrame, dict[int, int]]:
    """(count, part, fps): tiles of about ``tile`` values of one population count; and each count's number of tiles."""
    counted = values.select("fp", F.bit_count("fp").cast("int").alias("count"))
    sizes = {r["count"]: math.ceil(r["n"] / tile) for r in counted.groupBy("count").agg(F.count("*").alias("n")).collect()}  # 65 rows at most
    n_parts = F.element_at(F.create_map(*(F.lit(x) for item in sizes.items() for x in item)), F.col("count")) if sizes else F.lit(1)
    parts = counted.select("fp", "count", F.pmod(F.xxhash64("fp"), n_parts).cast("int").alias("part"))
    return parts.groupBy("count", "part").applyInArrow(_tile, "count int, part int, fps binary"), sizes


def tile_links(left: np.ndarray, right: np.ndarray, radius: int, step: int = 64) -> list[tuple[int, int]]:
    """Links that connect the two tiles' values as the pairs within the radius do, found block by block.

    A link is made only where it joins two groups, so there are fewer links than values.
    """
    values, index = np.unique(np.concatenate([left, right]), return_inverse=True)
    li, ri = index[: len(left)], index[len(left) :]
    alone = 1 if left is right or np.array_equal(left, right) else 0
    group, links = np.arange(len(values)), []
    for at in range(0, len(left), step):
        near = np.bitwise_count(left[at : at + step, None] ^ right[None, :]) <= radius
        for k in np.flatnonzero(near.sum(axis=1) > alone):
            mine = group[li[at + k]]
            met = np.unique(group[ri[near[k]]])
            if (others := met[met != mine]).size:
                links += [(int(values[mine]), int(values[o])) for o in others]
                group[np.isin(group, others) | (group == mine)] = min(mine, others[0])
    return links


def near_links(values: DataFrame, radius: int = RADIUS, tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """(a, b): links that connect the distinct values ``fp`` as the radius does.

    A task holds up to ``block`` tiles of one population count and meets the
    tiles of that count and of the ``radius`` counts below, which are copied
    once for each such block: the copies are fewer than the tile pairs by that
    factor, and the pairs themselves never move.
    """
    tiles, sizes = make_tiles(values, tile)
    tiles = cut(tiles)
    blocks = F.create_map(*(F.lit(x) for c, n in sizes.items() for x in (c, math.ceil(n / block)))) if sizes else F.create_map().cast("map<int,int>")
    left = tiles.select(F.col("count").alias("at"), F.floor(F.col("part") / block).cast("int").alias("blk"), F.col("part").alias("lp"), F.col("fps").alias("lf"))
    nearby = F.filter(F.sequence(F.col("count"), F.col("count") + radius), lambda c: F.map_contains_key(blocks, c))
    right = tiles.select(F.explode(nearby).alias("at"), F.col("count").alias("rc"), F.col("part").alias("rp"), F.col("fps").alias("rf"))
    right = right.select("*", F.explode(F.sequence(F.lit(0), F.element_at(blocks, F.col("at")) - 1)).alias("blk"))
    pairs = left.join(right, ["at", "blk"]).where((F.col("rc") < F.col("at")) | (F.col("rp") >= F.col("lp"))).select("lf", "rf")

    def compare(batches):
        for batch in batches:
            for lf, rf in zip(batch.column(0), batch.column(1)):
                links = tile_links(np.frombuffer(lf.as_py(), np.uint64), np.frombuffer(rf.as_py(), np.uint64), radius)
                if links:
                    ab = np.array(links, np.uint64).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(ab[:, 0]), pa.array(ab[:, 1])], names=["a", "b"])

    return pairs.mapInArrow(compare, "a long, b long")


def simhash_dedup(
    docs: DataFrame, radius: int = RADIUS, width: int = SHINGLE, seed: int = SEED, tile: int = TILE, key_col: str | None = None
) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id; with ``key_col`` also key (that column) and root.

    ``root`` tells components apart whose ids are the same or all null.
    """
    prints = cut(fingerprints(docs, width, seed, key_col))
    values = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(near_links(values.select("fp"), radius, tile))
    grouped = values.join(roots, values["fp"] == roots["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = grouped.groupBy(F.col("root").alias("of_root")).agg(F.min("first_id").alias("component_id"))
    named = grouped.join(smallest, F.col("root") == F.col("of_root")).select(F.col("fp").alias("of_fp"), "component_id", "root")
    return prints.join(named, prints["fp"] == named["of_fp"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", *(["key", "root"] if key_col else [])
    )
