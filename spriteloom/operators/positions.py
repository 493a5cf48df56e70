"""Rows by their position in a Parquet table, from a stored index.

The index says of every row group which positions it holds; it is made from the
files' footers alone, in tasks, and written once.  A point read joins positions
with it and opens only the row groups asked for, each in one task and by the
columns wanted: neither other files nor other columns are read, and nothing is
numbered again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from spriteloom.sources import storage

_GROUPS = "file string, row_group int, n long"
#: Positions of a block, by which positions meet row groups.
BLOCK = 1 << 16


def build_positions(spark: SparkSession, table: str, index: str) -> None:
    """Writes the index of a Parquet folder: rows stand in the order of file names, and in a file as they are."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(table).select(F.col("path").alias("file"))

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                system, path = storage.place(file)
                with system.open_input_file(path) as opened:
                    meta = pq.ParquetFile(opened).metadata
                sizes = [meta.row_group(k).num_rows for k in range(meta.num_row_groups)]
                yield pa.RecordBatch.from_arrays([pa.array([file] * len(sizes), pa.string()), pa.array(range(len(sizes)), pa.int32()), pa.array(sizes, pa.int64())], ["file", "row_group", "n"])

    groups = files.repartition(spark.sparkContext.defaultParallelism).mapInArrow(footers, _GROUPS)
    groups.write.mode("overwrite").parquet(f"{index}/groups")
    groups = spark.read.schema(_GROUPS).parquet(f"{index}/groups")
    # first positions: of a file among files, then of a group in its file; one row a file is ordered as a whole
    sizes = groups.groupBy("file").agg(F.sum("n").alias("rows"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("file").alias("of_file"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("file").orderBy("row_group").rowsBetween(Window.unboundedPreceding, -1)
    placed = groups.withColumn("earlier", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(sizes, F.col("file") == F.col("of_file"))
    placed.where("n > 0").select("file", "row_group", "n", (F.col("start") + F.col("earlier")).alias("first")).write.mode("overwrite").parquet(f"{index}/positions")


def count_rows(spark: SparkSession, index: str) -> int:
    """The table's length, from the index."""
    return spark.read.parquet(f"{index}/positions").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def rows_at(wanted: DataFrame, index: str, columns: DataFrame, key: str = "position") -> DataFrame:
    """(position, columns...) of the positions in ``wanted``, as often as they stand there; ``columns`` is the table, of which only the schema is used.

    Positions outside the table give no rows.
    """
    spark = wanted.sparkSession
    groups = spark.read.parquet(f"{index}/positions")
    blocks = groups.withColumn("block", F.explode(F.sequence(F.floor(F.col("first") / BLOCK), F.floor((F.col("first") + F.col("n") - 1) / BLOCK))))
    asked = wanted.select(F.col(key).cast("long").alias("position")).where("position >= 0").withColumn("in_block", F.floor(F.col("position") / BLOCK))
    found = asked.join(blocks, F.col("in_block") == F.col("block")).where("position >= first AND position < first + n")
    names = columns.columns
    schema = to_arrow_schema(columns.schema)

    def read(key, rows):
        positions = rows.column("position").to_numpy()
        system, path = storage.place(key[0].as_py())
        with system.open_input_file(path) as opened:
            group = pq.ParquetFile(opened).read_row_group(key[1].as_py(), columns=names)
        got = group.select(names).take(pa.array(positions - rows.column("first")[0].as_py())).cast(schema)
        return got.add_column(0, "position", pa.array(positions.astype(np.int64)))

    out = ", ".join(["position long", *(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.schema)])
    return found.select("file", "row_group", "first", "position").groupBy("file", "row_group").applyInArrow(read, out)
