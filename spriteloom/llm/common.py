"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; a session in one process (tests, a laptop) gets a local one, a cluster without that setting fails."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and cut its lineage there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only, so that lengths and other letters stay as they are."""
    return F.translate(text, UPPER, LOWER)


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality of the named columns, usable as a hash or sort-merge join key."""
    on = F.lit(True)
    for name in names:
        on = on & left[name].eqNullSafe(right[name])
    return on


#: Bytes of a table that is sent to all executors; the rows of a larger one are joined by a shuffle.
BROADCAST_BYTES = 8 << 20


def broadcast_if_small(rows: DataFrame, text_col: str, row_bytes: int = 200, most: int | None = None) -> DataFrame:
    """``rows`` marked for a broadcast if their bytes, those of ``text_col`` and ``row_bytes`` a row for the rest, are at most ``most``; they are counted, so cut ``rows`` before."""
    n, text = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.col(text_col).cast("string"))), F.lit(0))).first()
    return F.broadcast(rows) if text + n * row_bytes <= (BROADCAST_BYTES if most is None else most) else rows
