"""Vectors as whole numbers: components of an array column times a power of two, rounded down, in numpy, and sums over all of them.

A row takes part if its vector is not null, has the table's commonest length (of two equally common ones the shorter) and only finite
components whose whole number is below 2**62. Other rows are left out; without rows there is no length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def doubles(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """key and v (array of double) of the rows that have a vector."""
    return rows.filter(F.col(vector).isNotNull()).select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"))


def commonest_length(rows: DataFrame) -> tuple[int, int]:
    """The commonest length of vectors that are finite, and how many have it; 0, 0 without any."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sizes = rows.filter((F.size("v") > 0) & finite).groupBy(F.size("v").alias("n")).count()
    best = sizes.orderBy(F.desc("count"), "n").limit(1).collect()
    return (best[0]["n"], best[0]["count"]) if best else (0, 0)


def whole_numbers(column: pa.Array, dim: int, scale: int, add: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows that take part, and their whole numbers."""
    place = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(column), dim), False).to_numpy(zero_copy_only=False))
    flat = column.take(pa.array(place)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(place), dim)
    with np.errstate(over="ignore", invalid="ignore"):
        big = np.floor(flat * scale)
        good = (np.abs(big) < float(1 << 62)).all(1)  # false for what isn't finite too
    return place[good], big[good].astype(np.int64) + add


def gram(rows: DataFrame, matrix: Callable[[pa.RecordBatch], np.ndarray], dim: int) -> np.ndarray:
    """The sum over all rows of the outer product of a row with itself. Each task sums its rows and sends `dim` rows of partial sums, which
    are added by row, so what reaches the driver is one dim x dim matrix."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            x = matrix(batch)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim)), pa.array([r.tobytes() for r in total], pa.binary())], ["i", "row"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[i] = sums.get(i, 0) + np.frombuffer(row)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([r.tobytes() for r in sums.values()], pa.binary())], ["i", "row"])

    schema = "i long, row binary"
    out = np.zeros((dim, dim))
    for r in rows.mapInArrow(partial, schema).repartition("i").mapInArrow(add, schema).collect():
        out[r.i] = np.frombuffer(bytes(r.row))
    return (out + out.T) / 2
