"""Positions in a global order, without one task that sees all rows."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one task orders.
PART_ROWS = 100_000


def slices(rows: DataFrame, key: str, part_rows: int = PART_ROWS) -> DataFrame:
    """Adds ``slice``: ascending ranges of the whole number ``key``, of about ``part_rows`` rows each.

    The bounds are approximate quantiles, one number a slice.  They are fixed
    before the rows move, so a task that runs again finds the same slices.
    Null keys are in the first slice; equal keys are in one slice.
    """
    k = max(1, math.ceil(rows.count() / part_rows))
    bounds = np.unique(np.array(rows.approxQuantile(key, [i / k for i in range(1, k)], 0.1 / k), np.float64)) if k > 1 else np.zeros(0)
    if not len(bounds):
        return rows.withColumn("slice", F.lit(0))
    shared = rows.sparkSession.sparkContext.broadcast(bounds)

    @F.pandas_udf("int")
    def slice_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(shared.value, keys.to_numpy(np.float64), side="right").astype(np.int32))

    return rows.withColumn("slice", F.when(F.col(key).isNull(), 0).otherwise(slice_of(F.coalesce(F.col(key), F.lit(0)))))


def numbered(rows: DataFrame, key: str, into: str = "position", part_rows: int = PART_ROWS, ties: tuple[str, ...] = ()) -> DataFrame:
    """Adds the row's position, from 0, in the order of the whole number ``key``; ties by the columns ``ties``, then in any order.

    Each slice is numbered by itself; the only thing ordered as a whole is one count a slice.
    """
    sliced = slices(rows, key, part_rows)
    ranked = sliced.withColumn("__nth", F.row_number().over(Window.partitionBy("slice").orderBy(key, *ties)))
    sizes = sliced.groupBy("slice").agg(F.count("*").alias("n"))
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    return ranked.join(firsts, "slice").withColumn(into, F.col("__before") + F.col("__nth") - 1).drop("slice", "__nth", "__before")
