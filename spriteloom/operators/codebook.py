"""Learning a codebook: rounds of assignment and averaging over all vectors.

A round is one pass: each partition sums up its vectors by nearest codeword, the
sums meet in one shuffle of as many rows as there are codewords and partitions, and
the codebook, which is bounded, moves a step towards the means.  Codewords that
no vector is nearest to can be set on the vectors that are quantized worst.
Each round's codebook is written, so a run that was stopped goes on from there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spriteloom.operators.vq import MAX_CODEBOOK_VALUES, quantize
from spriteloom.sources import storage

_SUMS = "code int, n long, loss double, total array<double>"


def nearest(x: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code, squared distance) of each vector; the lowest of equal codes."""
    d = (x * x).sum(axis=1)[:, None] + (codebook * codebook).sum(axis=1) - 2 * x @ codebook.T
    code = d.argmin(axis=1)
    return code, d[np.arange(len(x)), code]


def partial_sums(vectors: DataFrame, codebook: np.ndarray, column: str) -> DataFrame:
    """(code, n, loss, total): one row for each codeword that a partition has vectors of."""
    shared = vectors.sparkSession.sparkContext.broadcast(codebook)

    def sums(batches):
        book = shared.value
        n, loss, total = np.zeros(len(book), np.int64), np.zeros(len(book)), np.zeros(book.shape)
        for batch in batches:
            if not len(batch):
                continue
            x = np.asarray(batch.column(0).flatten(), np.float64).reshape(len(batch), -1)
            code, d = nearest(x, book)
            n += np.bincount(code, minlength=len(book))
            loss += np.bincount(code, d, len(book))
            order = np.argsort(code, kind="stable")
            first = np.flatnonzero(np.append(True, np.diff(code[order]) > 0))
            total[code[order][first]] += np.add.reduceat(x[order], first, axis=0)
        own = np.flatnonzero(n)
        columns = [pa.array(own.astype(np.int32)), pa.array(n[own]), pa.array(loss[own]), pa.array(list(total[own]), pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, ["code", "n", "loss", "total"])

    return vectors.select(column).where(F.col(column).isNotNull()).mapInArrow(sums, _SUMS)


def codeword_sums(vectors: DataFrame, codebook: np.ndarray, column: str) -> tuple[np.ndarray, np.ndarray, float]:
    """(vectors of each codeword, their sums, summed squared distance)."""
    parts = partial_sums(vectors, codebook, column)
    joined = parts.select("code", "n", "loss", F.posexplode("total").alias("at", "value")).groupBy("code", "at").agg(F.sum("value").alias("value"), F.sum("n").alias("n"), F.sum("loss").alias("loss"))
    whole = joined.groupBy("code").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("total"), F.first("n").alias("n"), F.first("loss").alias("loss"))
    n, total, loss = np.zeros(len(codebook), np.int64), np.zeros(codebook.shape), 0.0
    for r in whole.collect():  # as many rows as codewords
        n[r["code"]], total[r["code"]] = r["n"], [v["value"] for v in r["total"]]
        loss += r["loss"]
    return n, total, loss


def worst_quantized(vectors: DataFrame, codebook: np.ndarray, k: int, column: str) -> np.ndarray:
    """The ``k`` distinct vectors that are farthest from their codewords."""
    far = quantize(vectors.select(column).distinct(), codebook, column).orderBy(F.desc("distance"), column).limit(k)
    return np.array([r[column] for r in far.collect()], np.float64).reshape(-1, codebook.shape[1])


def learn_codebook(vectors: DataFrame, codebook: np.ndarray, rounds: int, decay: float = 0.5, reseed: bool = True, column: str = "embedding", folder: str | None = None) -> tuple[np.ndarray, list[float]]:
    """The codebook after ``rounds`` rounds, and the mean squared error (by value) before each of them.

    In a round a codeword keeps ``decay`` of itself and takes the rest from the
    mean of its vectors.  With ``folder``, rounds that are written there are not
    done again.
    """
    if codebook.size > MAX_CODEBOOK_VALUES:
        raise ValueError("the codebook is too large to broadcast")
    codebook, losses = codebook.astype(np.float64), []
    for k in range(rounds):
        file = f"{folder}/round-{k:04d}.bin"
        if folder and storage.names(folder, f"round-{k:04d}.bin"):
            system, path = storage.place(file)
            with system.open_input_stream(path) as stream:
                stored = np.frombuffer(stream.read(), np.float64)
            losses.append(float(stored[0]))
            codebook = stored[1:].reshape(codebook.shape).copy()
            continue
        n, total, loss = codeword_sums(vectors, codebook, column)
        losses.append(loss / max(1, n.sum() * codebook.shape[1]))
        used, new = n > 0, codebook.copy()
        new[used] = decay * codebook[used] + (1 - decay) * total[used] / n[used][:, None]
        if reseed and n.sum() and not used.all():
            seeds = worst_quantized(vectors, codebook, int((~used).sum()), column)
            new[np.flatnonzero(~used)[: len(seeds)]] = seeds
        codebook = new
        if folder:
            storage.put(file, np.concatenate([[losses[-1]], codebook.ravel()]).tobytes())
    return codebook, losses
