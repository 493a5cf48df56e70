"""New files as a stream: clean, and write what is accepted, once each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spriteloom.operators.clean import clean_images
from spriteloom.sources.jpeg import jpegs_as_png


def image_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Image files that arrive in ``folder``; the query's checkpoint remembers which were seen."""
    shape = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(shape).option("pathGlobFilter", "*.{png,gif,jpg,jpeg,webp}").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content", F.lit(None).cast("string").alias("license_type"), F.col("path").alias("source_url"))


def clean_stream(spark: SparkSession, folder: str, out: str, checkpoint: str):
    """Starts a query that adds accepted sprites to ``out`` as Parquet, by micro-batch: one that runs again replaces what it had written."""

    def batch(files: DataFrame, number: int) -> None:
        cleaned = clean_images(jpegs_as_png(files, f"{checkpoint}/jpeg"))
        cleaned.where("verdict = 'accepted'").write.mode("overwrite").parquet(f"{out}/batch={number}")

    return image_stream(spark, folder).writeStream.foreachBatch(batch).option("checkpointLocation", f"{checkpoint}/query").trigger(availableNow=True).start()
