"""Size-bounded shards: assignment in order, bucket by bucket.

A shard is left when it holds ``limit`` bytes or more, so where one starts
depends on all rows before it.  Still no task sees a whole bucket.  A bucket is
cut into slices of ids.  What a slice does to the bytes that it is entered with
is a step function: with more bytes held, the first shard ends at an earlier
row, and from that row on everything is settled.  Each slice works out this
function once.  The functions of neighbours are composed in a tree, FAN at a
time; a composition has no more steps than its first member where that fills a
shard, so nothing grows with the bucket.  Down the tree every slice is told what
it is entered with, and it assigns its own rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spriteloom.operators.ordering import PART_ROWS, slices
from spriteloom.operators.steps import cut

#: Neighbours whose step functions are composed in one task.
FAN = 8
_STEPS = "bucket string, slice int, needs long, begun long, held long, total long"
_ENTERED = "in_bucket string, in_slice int, entered long, first_shard long"


def slice_steps(sizes: np.ndarray, limit: int) -> list[tuple[int, int, int]]:
    """(needs, shards, held), by falling ``needs``: a slice entered with at least ``needs`` bytes, and less than the
    step before needs, begins ``shards`` shards and leaves ``held`` bytes.  Entered with less than every step needs,
    it begins none and adds its bytes."""
    n, upto = len(sizes), np.concatenate([[0], np.cumsum(sizes)])
    follow = np.searchsorted(upto[:n], upto[:n] + limit)  # the row that begins the next shard, if one began here
    begun, held = [0] * n, [0] * n
    for k in range(n - 1, -1, -1):
        j = follow[k]
        begun[k], held[k] = (begun[j] + 1, held[j]) if j < n else (0, int(upto[n] - upto[k]))
    steps: list[tuple[int, int, int]] = []
    for j in range(n):
        needs = max(0, limit - int(upto[j]))
        if steps and steps[-1][1:] == (begun[j] + 1, held[j]):
            steps[-1] = (needs, *steps[-1][1:])
        elif not steps or needs < steps[-1][0]:
            steps.append((needs, begun[j] + 1, held[j]))
        if not needs:
            break
    return steps


def entered_with(steps: pd.DataFrame, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shards begun, bytes left) of a slice, by falling ``needs``, for each number of bytes that it may be entered with."""
    needs, begun, left = (steps[c].to_numpy() for c in ("needs", "begun", "held"))
    at = np.searchsorted(-needs, -held)  # the first step that these bytes reach
    taken, at = at < len(needs), np.minimum(at, len(needs) - 1)
    return np.where(taken, begun[at], 0), np.where(taken, left[at], held + int(steps["total"].iloc[0]))


def composed(first: pd.DataFrame, second: pd.DataFrame) -> pd.DataFrame:
    """The steps of two neighbours as those of one slice."""
    begun, held = entered_with(second, first["held"].to_numpy())
    upper = pd.DataFrame({"needs": first["needs"].to_numpy(), "begun": first["begun"].to_numpy() + begun, "held": held})
    added = int(first["total"].iloc[0])  # entered with less than any step of the first needs
    lower = pd.DataFrame({"needs": np.maximum(0, second["needs"].to_numpy() - added), "begun": second["begun"].to_numpy(), "held": second["held"].to_numpy()})
    both = pd.concat([upper, lower[lower["needs"] < upper["needs"].iloc[-1]]], ignore_index=True).drop_duplicates("needs")
    same = (both[["begun", "held"]].shift(-1) == both[["begun", "held"]]).all(axis=1)  # the lower need says it all
    return both[~same].assign(total=added + int(second["total"].iloc[0]))


def _children(frame: pd.DataFrame):
    for part, own in frame.sort_values(["slice", "needs"], ascending=[True, False]).groupby("slice"):
        yield part, own


def assign_shards(rows: DataFrame, limit: int, part_rows: int | None = None) -> DataFrame:
    """(bucket, id, size, shard) for rows with a whole-number ``id``; only ids and sizes move, never the payload.

    By default a slice has the rows of some eight shards, and ``PART_ROWS`` at
    least; a task of the tree sees at most one shard's rows of each of FAN slices.
    A null bucket is a bucket of its own; a null size counts as 0.
    """
    sizes = rows.select("bucket", F.col("id").cast("long").alias("id"), F.coalesce("size", F.lit(0)).cast("long").alias("size"))
    if part_rows is None:
        mean = sizes.agg(F.avg("size")).first()[0] or 1
        part_rows = max(PART_ROWS, math.ceil(8 * limit / mean))
    sliced = slices(sizes, "id", part_rows)

    def steps(key, frame):
        got = slice_steps(frame.sort_values(["id", "size"])["size"].to_numpy(), limit)
        return pd.DataFrame([(key[0], key[1], *s, int(frame["size"].sum())) for s in got], columns=["bucket", "slice", "needs", "begun", "held", "total"])

    def compose(key, frame):
        one, *others = (own for _, own in _children(frame))
        for own in others:
            one = composed(one, own)
        return one.assign(bucket=key[0], slice=key[1])[["bucket", "slice", "needs", "begun", "held", "total"]]

    def enter(key, frame):
        shard, held, out = int(frame["first_shard"].iloc[0]), int(frame["entered"].iloc[0]), []
        for part, own in _children(frame):
            out.append((key[0], part, held, shard))
            begun, left = entered_with(own, np.array([held]))
            shard, held = shard + int(begun[0]), int(left[0])
        return pd.DataFrame(out, columns=["in_bucket", "in_slice", "entered", "first_shard"])

    def assign(frame):
        frame = frame.sort_values(["id", "size"], ignore_index=True)
        shard, held, out = int(frame["first_shard"].iloc[0]), int(frame["entered"].iloc[0]), np.empty(len(frame), np.int64)
        for k, size in enumerate(frame["size"].tolist()):
            if held >= limit:
                shard, held = shard + 1, 0
            held += size
            out[k] = shard
        return frame.assign(shard=out)[["bucket", "id", "size", "shard"]]

    top = sliced.agg(F.max("slice")).first()[0] or 0
    levels = [cut(sliced.groupBy("bucket", "slice").applyInPandas(steps, _STEPS))]
    parent = F.floor(F.col("slice") / FAN).cast("int")
    while top:
        levels.append(cut(levels[-1].groupBy("bucket", parent.alias("parent")).applyInPandas(compose, _STEPS)))
        top //= FAN
    entered = levels[-1].select(F.col("bucket").alias("in_bucket"), F.col("slice").alias("in_slice"), F.lit(0).alias("entered"), F.lit(0).alias("first_shard")).distinct()
    for level in reversed(levels[:-1]):
        told = level.join(entered, level["bucket"].eqNullSafe(entered["in_bucket"]) & (parent == F.col("in_slice")))
        entered = told.groupBy("bucket", "in_slice").applyInPandas(enter, _ENTERED)
    joined = sliced.join(entered, sliced["bucket"].eqNullSafe(entered["in_bucket"]) & (F.col("slice") == F.col("in_slice")))
    return joined.drop("in_bucket", "in_slice").groupBy("bucket", "slice").applyInPandas(assign, "bucket string, id long, size long, shard long")
