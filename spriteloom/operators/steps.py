"""Results that later steps read more than once."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the folder that the cluster names in ``spark.checkpoint.dir``, where it goes when nothing refers to it any more.

    A session in one process gets a folder of its own; a cluster without that setting fails.
    """
    spark, sc = df.sparkSession, df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint()
