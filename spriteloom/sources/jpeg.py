"""JPEG files by Spark's own image source, which decodes in the JVM.

The image source reads files, not values of a column.  Contents therefore go to
a folder that all executors share, once each, under names made of their digests;
what the source decodes is joined back by that name as a PNG, so that all later
steps (measures, cleaner, annotator, tensors) know one format without loss.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from spriteloom.sources import storage
from spriteloom.sources.codec import encode_png


def is_jpeg(content: Column | str = "content") -> Column:
    """Whether a file begins as JPEG files do."""
    return F.coalesce(F.hex(F.substring(content, 1, 3)) == "FFD8FF", F.lit(False))


def rgba_of(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """RGBA pixels of the image source's rows of blue, green, red (and alpha), or of grey."""
    px = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    if channels == 1:
        px = np.repeat(px, 3, axis=2)
    rgba = np.full((height, width, 4), 255, np.uint8)
    rgba[..., :3] = px[..., 2::-1] if channels > 1 else px
    if channels == 4:
        rgba[..., 3] = px[..., 3]
    return rgba


@F.pandas_udf(BinaryType())
def _png(image: pd.DataFrame) -> pd.Series:
    return pd.Series([encode_png(rgba_of(*row)) for row in image[["data", "height", "width", "nChannels"]].itertuples(index=False)], dtype=object)


def decoded(spark: SparkSession, folder: str, pattern: str = "*.{jpg,jpeg}") -> DataFrame:
    """(path, content): the readable images under ``folder`` that match ``pattern``, as PNG."""
    images = spark.read.format("image").option("dropInvalid", "true").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return images.select(F.col("image.origin").alias("path"), _png("image").alias("content"))


def jpegs_as_png(images: DataFrame, work: str) -> DataFrame:
    """The rows with ``content`` as PNG where it is a JPEG; one that can't be decoded stays as it is.

    ``work`` is a folder that all executors reach; a new one under it holds the
    JPEG files.  Equal files are decoded once.
    """
    folder = f"{work}/jpeg-{uuid.uuid4().hex}"
    keyed = images.withColumn("__file", F.when(is_jpeg(), F.sha2("content", 256)))

    def spill(frames):
        for frame in frames:
            for name, content in zip(frame["__file"], frame["content"]):
                storage.put(f"{folder}/{name}.jpg", content)
            yield frame[["__file"]]

    once = keyed.where(F.col("__file").isNotNull()).groupBy("__file").agg(F.first("content").alias("content"))
    if not once.mapInPandas(spill, "__file string").count():
        return images
    known = decoded(images.sparkSession, folder).select(F.regexp_extract("path", "([0-9a-f]{64})[.]jpg$", 1).alias("__known"), F.col("content").alias("__png"))
    found = keyed.join(known, F.col("__file") == F.col("__known"), "left")
    return found.select(*[F.coalesce("__png", "content").alias("content") if c == "content" else F.col(f"`{c}`") for c in images.columns])
