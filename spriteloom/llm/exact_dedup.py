"""Exact deduplication by a tree-merge of sorted digest runs.

Each scan partition turns its rows into sorted runs of verified digests, one
run per digest range.  Partitions then exchange whole runs in rounds: in round
``r`` the runs whose numbers agree above the low bits meet in one group, where
a multiway merge joins them and keeps, for every digest, the best row and the
count.  After ``log(partitions)`` rounds one run per range is left.  Equal
digests collapse at every level, the first one included, so a text that a
third of all rows share costs one entry per run and never gathers in a task.
The ranges split the digest space evenly, which bounds every run.

Cases: a null text counts as empty, and all empty texts are equal; a null
``doc_id`` ranks after every other id; of rows that repeat id and text exactly
one is kept; a text of any length is compared as a whole, by digest and length;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
import struct

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, text_or_empty

#: The characters that do not count when texts are compared.
BLANKS = r"[\x20\x09-\x0D]+"
#: Stands for a null id inside the runs: larger than any other id.
NO_ID = (1 << 63) - 1
_RUN = "rng int, run int, keys binary, best binary"
_RUN_ARROW = pa.schema([("rng", pa.int32()), ("run", pa.int32()), ("keys", pa.binary()), ("best", pa.binary())])
#: Of an entry: code points, doc_id, row number, rows.
_ENTRY = struct.Struct("<qqqq")
#: SHA-256 of the normalised text, then its length in bytes.
_KEY = 40


def plain_text(text_col: str) -> Column:
    return F.regexp_replace(text_or_empty(text_col), BLANKS, "")


def plain_sha256(text_col: str) -> Column:
    """The digest by which texts are compared, as in ``text_sha256``."""
    return F.sha2(plain_text(text_col).cast("binary"), 256)


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per document: id, row number, code points and verified digest."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row_no"),
        F.length(text_or_empty(text_col)).cast("long").alias("n_points"),
        F.unhex(plain_sha256(text_col)).alias("digest"),
        F.octet_length(plain_text(text_col)).cast("long").alias("n_plain"),
    )


def _better(a: tuple, b: tuple) -> tuple:
    """Most code points, then smallest id, then smallest row number; counts add up."""
    x, y = (-a[0], a[1], a[2]), (-b[0], b[1], b[2])
    best = a if x <= y else b
    return best[0], best[1], best[2], a[3] + b[3]


def _pack(rng: int, run: int, entries) -> dict:
    keys, best = bytearray(), bytearray()
    for key, entry in entries:
        keys += key
        best += _ENTRY.pack(*entry)
    return {"rng": rng, "run": run, "keys": bytes(keys), "best": bytes(best)}


def _unpack(keys: bytes, best: bytes):
    return zip((keys[i : i + _KEY] for i in range(0, len(keys), _KEY)), _ENTRY.iter_unpack(best))


def _first_runs(n_ranges: int):
    def runs(batches):
        from pyspark import TaskContext

        seen: dict[bytes, tuple] = {}
        for batch in batches:
            for doc_id, row_no, points, digest, n_plain in zip(*(c.to_pylist() for c in batch.columns)):
                key = digest + n_plain.to_bytes(8, "big")
                entry = (points, NO_ID if doc_id is None else doc_id, row_no, 1)
                seen[key] = _better(seen[key], entry) if key in seen else entry
        by_range: dict[int, list] = {}
        for key in sorted(seen):
            by_range.setdefault(int.from_bytes(key[:4], "big") * n_ranges >> 32, []).append((key, seen[key]))
        run = TaskContext.get().partitionId()
        for rng, entries in by_range.items():
            yield pa.RecordBatch.from_pylist([_pack(rng, run, entries)], schema=_RUN_ARROW)

    return runs


def _merge(fan_in: int):
    def merge(key, runs):
        rows = runs.to_pylist()
        merged: list = []
        for k, entry in heapq.merge(*(_unpack(r["keys"], r["best"]) for r in rows), key=lambda x: x[0]):
            if merged and merged[-1][0] == k:
                merged[-1] = (k, _better(merged[-1][1], entry))
            else:
                merged.append((k, entry))
        return pa.Table.from_pylist([_pack(rows[0]["rng"], rows[0]["run"] // fan_in, merged)], schema=_RUN_ARROW)

    return merge


def _entries(batches):
    names = ["digest", "best_points", "keep_id", "keep_row", "group_size"]
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    for batch in batches:
        for r in batch.to_pylist():
            rows = [(k[:32], *e) for k, e in _unpack(r["keys"], r["best"])]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def merge_runs(rows: DataFrame, fan_in: int = 8, range_rows: int = 20_000) -> DataFrame:
    """The tree-merge: one row per distinct digest with its best row and row count."""
    n_ranges = max(64, math.ceil(rows.count() / range_rows))
    n_runs = max(1, rows.rdd.getNumPartitions())
    runs = rows.select("doc_id", "row_no", "n_points", "digest", "n_plain").mapInArrow(_first_runs(n_ranges), _RUN)
    while n_runs > 1:
        runs = runs.groupBy("rng", F.floor(F.col("run") / fan_in).alias("parent")).applyInArrow(_merge(fan_in), _RUN)
        n_runs = math.ceil(n_runs / fan_in)
    runs = cut(runs)  # else the last merge and what follows would keep two Python workers a task
    return runs.mapInArrow(_entries, "digest binary, best_points long, keep_id long, keep_row long, group_size long")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    The narrow digest rows are cut into the shared folder, so row numbers stay
    the same when an executor is lost; the text is read once.  The join back on
    the digest is a plain equi-join that adaptive execution splits when a
    digest is hot.
    """
    rows = cut(digest_rows(docs, id_col, text_col))
    groups = merge_runs(rows).withColumnRenamed("digest", "group_digest")
    joined = rows.join(groups, rows["digest"] == groups["group_digest"])
    return joined.select(
        "doc_id",
        F.when(F.col("keep_id") != NO_ID, F.col("keep_id")).alias("keep_id"),
        "group_size",
        (F.col("row_no") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


OP1_SQL = r"""
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(plain) AS text_sha256
FROM (
  SELECT doc_id, plain,
         first_value(doc_id) OVER (PARTITION BY plain ORDER BY length(body) DESC, doc_id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id,
         CAST(count(*) OVER (PARTITION BY plain) AS BIGINT) AS group_size
  FROM (SELECT doc_id, coalesce(text, '') AS body,
               regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain
        FROM documents))
"""
