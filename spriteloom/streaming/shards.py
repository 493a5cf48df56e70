"""Shards over a stream: each bucket's open shard and the bytes that it holds are state between micro-batches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

PLACED = "bucket string, id long, size long, shard long"


class Bucket(StatefulProcessor):
    """Puts rows into the open shard, and opens the next when it holds ``limit`` bytes or more; a row that was placed before is not placed again."""

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle) -> None:
        self.open = handle.getValueState("open", "shard long, held long, last long")

    def handleInputRows(self, key, rows, timerValues):
        shard, held, last = self.open.get() or (0, 0, None)
        frame = pd.concat([f[["id", "size"]] for f in rows], ignore_index=True).sort_values(["id", "size"], ignore_index=True)
        if last is not None and frame["id"].iloc[0] <= last:
            raise ValueError(f"bucket {key[0]}: id {frame['id'].iloc[0]} came after {last}, which is placed already")
        placed = []
        for size in frame["size"].tolist():
            if held >= self.limit:
                shard, held = shard + 1, 0
            held += size
            placed.append(shard)
        self.open.update((shard, held, int(frame["id"].iloc[-1])))
        yield frame.assign(bucket=key[0], shard=placed)[["bucket", "id", "size", "shard"]]

    def close(self) -> None:
        pass


def shard_stream(rows: DataFrame, limit: int) -> DataFrame:
    """(bucket, id, size, shard) of a stream of rows (bucket, id, size) whose ids rise from micro-batch to micro-batch in each bucket.

    The shards are those of all rows at once.  The state store must be RocksDB.
    """
    sizes = rows.select("bucket", F.col("id").cast("long").alias("id"), F.coalesce("size", F.lit(0)).cast("long").alias("size"))
    return sizes.groupBy("bucket").transformWithStateInPandas(Bucket(limit), PLACED, "Append", "none")
