"""Running counts and sums by key over a table of any size: a key may hold most of its rows, as keys are split between tasks.

Rows are range-partitioned and sorted by key and order; tasks sum within their part, and what a part's last key has reached is carried into the
parts that go on with it. Carries are one row a part. Sums wrap around at 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.scratch import Scratch


def _schema(df: DataFrame, extra: list[str]) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), *(f"`{c}` long" for c in extra)])


def running(rows: DataFrame, key: str, order: list[Column], sums: list[str], scratch: Scratch, name: str) -> DataFrame:
    """rows (key: a long, never null) with `count`, the place of a row within its key from 1 on, and for each summed column to_<c>, its sum as far as this row."""
    made = ["count", *(f"to_{c}" for c in sums)]
    parts = rows.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order).withColumn("part", F.spark_partition_id())

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = None, np.zeros(len(made), np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch.column(key).to_numpy()
            values = np.stack([np.ones(n, np.int64), *(batch.column(c).to_numpy() for c in sums)])
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            total = np.cumsum(values, axis=1)
            before = np.where(starts > 0, total[:, starts - 1], 0)
            if keys[0] == last:
                before[:, 0] -= carried
            out = total - np.repeat(before, np.diff(np.append(starts, n)), axis=1)
            last, carried = keys[-1], out[:, -1].copy()
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, out)], [*batch.schema.names, *made])

    saved = scratch.save(parts.mapInArrow(within, _schema(parts, made)), name)
    at_end = F.max_by(F.struct(*made), F.struct(key, "count"))
    ends = saved.groupBy("part").agg(F.min(key).alias("first"), F.max(key).alias("last"), at_end.alias("end")).orderBy("part").collect()
    carry: dict[int, tuple[int, np.ndarray]] = {}
    last, reached = None, np.zeros(len(made), np.int64)
    for r in ends:  # one row a part
        end = np.array(tuple(r.end), np.int64)
        if r.first == last:
            carry[r.part] = (last, reached)
            end = end + reached if r.last == last else end
        last, reached = r.last, end
    if not carry:
        return saved.drop("part")

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, keys = batch.column("part").to_numpy(), batch.column(key).to_numpy()
            out = np.stack([batch.column(c).to_numpy() for c in made]) if batch.num_rows else np.zeros((len(made), 0), np.int64)
            for p in np.unique(part).tolist():
                if p in carry:
                    out[:, (part == p) & (keys == carry[p][0])] += carry[p][1][:, None]
            rest = [i for i, c in enumerate(batch.schema.names) if c not in made and c != "part"]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in rest), *map(pa.array, out)], [*(batch.schema.names[i] for i in rest), *made])

    return saved.mapInArrow(across, _schema(rows, made))
