"""Nearest-codeword quantization in bulk, by matrix product in Arrow batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Codewords times dimensions that may be broadcast.
MAX_CODEBOOK_VALUES = 1 << 24


def quantize(vectors: DataFrame, codebook: np.ndarray, column: str = "embedding") -> DataFrame:
    """Adds code and distance: the codeword of least squared distance, the lowest of equals."""
    if codebook.size > MAX_CODEBOOK_VALUES:
        raise ValueError("the codebook is too large to broadcast")
    shared = vectors.sparkSession.sparkContext.broadcast(codebook.astype(np.float64))

    @F.pandas_udf("code int, distance double")
    def nearest(batch: pd.Series) -> pd.DataFrame:
        x, c = np.stack(batch.to_numpy()).astype(np.float64), shared.value
        d = (x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * x @ c.T
        code = d.argmin(axis=1)
        return pd.DataFrame({"code": code.astype(np.int32), "distance": d[np.arange(len(x)), code]})

    return vectors.withColumn("nearest", nearest(column)).select("*", "nearest.*").drop("nearest")


def reconstructed(vectors: DataFrame, codebook: np.ndarray, column: str = "embedding") -> DataFrame:
    """Adds code, distance and quantized: the codeword itself, by a join with the codebook's rows."""
    rows = vectors.sparkSession.createDataFrame([(k, c) for k, c in enumerate(codebook.tolist())], "of_code int, quantized array<double>")
    found = quantize(vectors, codebook, column)
    return found.join(F.broadcast(rows), F.col("code") == F.col("of_code")).drop("of_code")  # as large as the codebook, which is bounded


def vq_loss(vectors: DataFrame, codebook: np.ndarray, beta: float = 0.25, column: str = "embedding") -> DataFrame:
    """(loss): mean squared error, once for the codebook and ``beta`` times for what is quantized."""
    return quantize(vectors, codebook, column).agg(((1 + beta) * F.sum("distance") / F.sum(F.size(column))).alias("loss"))
