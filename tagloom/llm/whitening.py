"""Embedding whitening: shifted CholeskyQR of the centred rows, then a singular value decomposition of the composed R.

Components become whole numbers x (`vectors`). Their sums are exact, and rows are centred before anything is multiplied. A pass over all rows
gives the Gram matrix of the rows as far as they are orthogonal yet; its Cholesky factor (of the first pass, or where the factor
doesn't exist, with a small shift of the diagonal) joins the list of factors, and the next pass solves each row against all of them, one
triangular system after the other. Rows are never stored: each pass reads the table. It ends when the Gram matrix has only eigenvalues
of one, or of nothing for directions in which the rows don't vary. With A = Q R and Q'Q = W L W', the right singular vectors of sqrt(L) W' R are the
components, its singular values squared over n the variances. Passes keep one dim x dim matrix a task.

Rows take part as `vectors` says; a null key is kept. Each row that takes part gives one row a component, repeated rows too. A component with no variance has a null
whitened value and takes no part in the identity error; explained is null if nothing varies. A deviation beyond a long is null. No rows give no result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.vectors import commonest_length, doubles, gram, whole_numbers

SCALE, ADD, COMPONENTS = 1024, 100_000, 8
_UNIT = 2.0**-53


@dataclass
class Whitening:
    """n, the sums of each dimension, components as columns, variances of these, and the variance of all."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float
    scale: int
    add: int

    @property
    def dim(self) -> int:
        return len(self.sums)

    def factors(self) -> np.ndarray:
        """What centred rows are multiplied with; nothing for components without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.variances > 0, self.components / np.sqrt(self.variances), 0.0)


def exact_sums(rows: DataFrame, dim: int, scale: int, add: int) -> tuple[int, list[int]]:
    """How many rows take part, and each dimension's sum: halves of the numbers are summed in tasks, as decimals across them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, n = np.zeros(dim, np.int64), np.zeros(dim, np.int64), 0
        for batch in batches:
            x = whole_numbers(batch.column(1), dim, scale, add)[1]
            high, low, n = high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0), n + len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim)), pa.array(high), pa.array(low), pa.array(np.full(dim, n))], ["i", "high", "low", "n"])

    exact = lambda c: F.sum(F.col(c).cast("decimal(19,0)")).alias(c)
    found = rows.mapInArrow(run, "i long, high long, low long, n long").groupBy("i").agg(exact("high"), exact("low"), F.sum("n").alias("n")).orderBy("i").collect()
    return (int(found[0].n), [int(r.high) * (1 << 32) + int(r.low) for r in found]) if found else (0, [0] * dim)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n in double precision: the whole part of the mean is taken off before anything is rounded."""
    parts = [divmod(s, n) for s in sums]
    return (x - np.array([q for q, _ in parts], np.int64)).astype(np.float64) - np.array([r / n for _, r in parts])


def solved(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Q of Q R = rows, column by column."""
    q = np.empty_like(rows, order="F")
    for j in range(r.shape[1]):
        q[:, j] = (rows[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def fit(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE, add: int = ADD, most: int = COMPONENTS) -> Whitening | None:
    """Components of the rows that take part; None without any. scale is a power of two."""
    values = doubles(rows, key, vector)
    dim, _ = commonest_length(values)
    n, sums = exact_sums(values, dim, scale, add) if dim else (0, [])
    if not n:
        return None
    spark, factors = rows.sparkSession, []
    while True:
        sent = spark.sparkContext.broadcast(factors)

        def orthogonal(batch: pa.RecordBatch, sent=sent) -> np.ndarray:
            q = centred(whole_numbers(batch.column(1), dim, scale, add)[1], n, sums)
            for r in sent.value:
                q = solved(q, r)
            return q

        g = gram(values, orthogonal, dim)
        sent.unpersist()
        eigenvalues, w = np.linalg.eigh(g)
        largest = eigenvalues[-1]
        if largest <= 0 or (factors and ((np.abs(eigenvalues - 1) < 1e-10) | (eigenvalues < 1e-12)).all()):
            break
        shift = min(11 * (dim * n + dim * (dim + 1)) * _UNIT, 0.1) * largest
        try:
            factors.append(np.linalg.cholesky(g + (0 if factors else shift) * np.eye(dim)).T)
        except np.linalg.LinAlgError:
            factors.append(np.linalg.cholesky(g + 1e-12 * dim * largest * np.eye(dim)).T)
    r = np.eye(dim)
    for factor in factors:
        r = factor @ r
    _, sigma, vt = np.linalg.svd(np.sqrt(np.where(eigenvalues < 1e-12, 0, eigenvalues))[:, None] * w.T @ r)
    sigma[sigma <= sigma[0] * dim * _UNIT] = 0
    components = vt[:most].T
    components = components * np.where(components[np.abs(components).argmax(0), np.arange(components.shape[1])] < 0, -1.0, 1.0)
    return Whitening(n, sums, components, sigma[:most] ** 2 / n, float((sigma**2).sum() / n), scale, add)


def identity_error(rows: DataFrame, model: Whitening, key: str = "vec_id", vector: str = "embedding") -> float | None:
    """The largest absolute entry of the whitened rows' covariance less the identity, over components that vary."""
    live = np.flatnonzero(model.variances > 0)
    if not len(live):
        return None
    factors = model.factors()[:, live]
    z = lambda batch: centred(whole_numbers(batch.column(1), model.dim, model.scale, model.add)[1], model.n, model.sums) @ factors
    return float(np.abs(gram(doubles(rows, key, vector), z, len(live)) / model.n - np.eye(len(live))).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """The sum over dimensions of (n*x - S)**2, exactly."""
    parts = [divmod(s, n) for s in sums]
    x, rest = x - np.array([q for q, _ in parts], np.int64), np.array([r for _, r in parts], object)
    most = (int(np.abs(x).max()) + 1) * n if x.size else 0
    if most * most * max(len(sums), 1) < 1 << 63:
        return pa.array(((x * n - rest.astype(np.int64)) ** 2).sum(1))
    return pa.array([s if s < 1 << 63 else None for s in ((x.astype(object) * n - rest) ** 2).sum(1)], pa.int64())


def whiten(rows: DataFrame, model: Whitening, error: float | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row for each row that takes part and component."""
    factors, live = model.factors(), model.variances > 0
    explained = [float(v / model.trace) if model.trace > 0 else None for v in model.variances]
    k = len(explained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, x = whole_numbers(batch.column(1), model.dim, model.scale, model.add)
            of = pa.array(np.repeat(np.arange(len(place)), k))
            z = (centred(x, model.n, model.sums) @ factors).ravel()
            size = len(z)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(place)).take(of), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(place))), pa.array(np.full(size, model.n)), deviations(x, model.n, model.sums).take(of),
                pa.array(z, mask=~np.tile(live, len(place))), pa.array(explained * len(place), pa.float64()), pa.array([error] * size, pa.float64()),
            ], ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = rows.schema[key].dataType.simpleString()
    return doubles(rows, key, vector).mapInArrow(run, f"key {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double").withColumnRenamed("key", key)


def whitened(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """The rows' whitened components, with the model learned from all of them."""
    model = fit(rows, key, vector, most=most)
    if model is None:
        kind = rows.schema[key].dataType.simpleString()
        return rows.sparkSession.createDataFrame([], f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return whiten(rows, model, identity_error(rows, model, key, vector), key, vector)
