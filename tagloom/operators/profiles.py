"""Sums by place, as vectors: a task adds up the vectors of a key's rows before they are shuffled, so a key sends one row a task, however many reads and bases it has."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

HELD, ROWS, BYTES = 4_000_000, 1 << 17, 16 << 20

#: Of a batch: the row, the place in its key's vector, and the amount of each thing to add.
Amounts = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray]]
#: Or of a batch, the number of each row's key and how many keys there are, the summed vector of each key.
Vectors = Callable[[pa.RecordBatch, np.ndarray, int], list[np.ndarray]]


def coded(columns: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each distinct row of some columns (nulls are equal), and the first row that has it."""
    code = np.zeros(len(columns[0]), np.int64)
    for c in columns:
        part = c.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        code = np.unique(code * (int(part.max(initial=0)) + 1) + part, return_inverse=True)[1]
    return code, np.unique(code, return_index=True)[1]


def _ragged(code: np.ndarray, keys: int, row: np.ndarray, spot: np.ndarray, amount: np.ndarray) -> list[np.ndarray]:
    """A vector of whole numbers for each key, as long as its last place."""
    wide = np.zeros(keys, np.int64)
    np.maximum.at(wide, code[row], spot + 1)
    begin = np.cumsum(wide) - wide
    flat = np.bincount(begin[code[row]] + spot, amount, int(wide.sum())).astype(np.int64)  # sums below 2**53
    return np.split(flat, begin[1:]) if keys else []


def _added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = (a, b) if len(a) >= len(b) else (b, a)
    out = a.copy()
    out[: len(b)] += b
    return out


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches joined to some of about ROWS rows or BYTES bytes, so that a key's sums are added up less often."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= ROWS or sum(b.nbytes for b in held) >= BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def summed(rows: DataFrame, keys: list[str], amounts: Amounts | None, finished: Callable[[list[np.ndarray]], list[pa.Array]], schema: str, vectors: Vectors | None = None) -> DataFrame:
    """One row a key: the keys and what `finished` makes of the sums of its vectors. schema: of the columns after the keys. vectors, if given, stands for amounts."""
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keys)
    n = len(keys)

    def table(held: dict) -> pa.RecordBatch:
        columns = [pa.array([k[i] for k in held], rows_types[i]) for i in range(n)]
        return pa.RecordBatch.from_arrays([*columns, pa.array([v.tobytes() for v in held.values()], pa.binary())], [*keys, "vector"])

    rows_types: list = []

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        size = 0
        for batch in _gathered(batches) if vectors else batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c) for c in keys]
            rows_types[:] = [c.type for c in columns]
            code, first = coded(columns)
            names = list(zip(*(c.take(pa.array(first)).to_pylist() for c in columns), strict=True))
            sums = vectors(batch, code, len(first)) if vectors else _ragged(code, len(first), *amounts(batch))
            for key, vector in zip(names, sums, strict=True):
                old = held.get(key)
                held[key] = vector if old is None else _added(old, vector)
                size += len(held[key]) - (0 if old is None else len(old))
            if size > HELD:
                yield table(held)
                held, size = {}, 0
        if held:
            yield table(held)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by key: equal keys follow each other."""
        rest: tuple[tuple, np.ndarray] | None = None

        def made(done: list[tuple[tuple, np.ndarray]]) -> pa.RecordBatch:
            columns = [pa.array([k[i] for k, _ in done], rows_types[i]) for i in range(n)]
            out = finished([v for _, v in done])
            return pa.RecordBatch.from_arrays([*columns, *out], [*keys, *(f"o{i}" for i in range(len(out)))])

        for batch in batches:
            rows_types[:] = [batch.column(i).type for i in range(n)]
            done = []
            for *key, vector in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key, vector = tuple(key), np.frombuffer(vector, np.int64)
                if rest is not None and rest[0] == key:
                    rest = (key, _added(rest[1], vector))
                    continue
                if rest is not None:
                    done.append(rest)
                rest = (key, vector)
            if done:
                yield made(done)
        if rest is not None:
            yield made([rest])

    sums = rows.mapInArrow(partial, f"{kinds}, vector binary")
    return sums.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(whole, f"{kinds}, {schema}")


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a column of texts, one after the other, and how many each has; nulls have none."""
    texts = texts.cast(pa.binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] else np.zeros(0, np.uint8)), np.diff(at)


def letter_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of texts, one for each letter, and how many letters each has. Nulls have none."""
    data, size = flat_bytes(column)
    if not (data & 128).any():
        return data, size
    texts = [x or "" for x in column.to_pylist()]
    return np.frombuffer("".join(texts).encode("latin-1", "replace"), np.uint8), np.fromiter(map(len, texts), np.int64, len(texts))


def letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts: the row, the place and the byte of each letter. Nulls have none."""
    data, size = letter_bytes(column)
    return np.repeat(np.arange(len(size)), size), np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size), data


def by_place(column: pa.Array, code: np.ndarray, keys: int, zero: int = 33) -> list[np.ndarray]:
    """For each key, place by place, the sum of its texts' bytes (less `zero`) and how many texts have the place. Texts of one length are added up as a matrix."""
    data, size = letter_bytes(column)
    start, wide = np.cumsum(size) - size, np.zeros(keys, np.int64)
    np.maximum.at(wide, code, size)
    out = [np.zeros(2 * n, np.int64) for n in wide.tolist()]
    for n in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == n)
        rows = rows[np.argsort(code[rows], kind="stable")]
        own = code[rows]
        cut = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        sums = np.add.reduceat(data[start[rows][:, None] + np.arange(n)], cut, axis=0, dtype=np.int64)
        for k, total, m in zip(own[cut].tolist(), sums, np.diff(np.append(cut, len(rows))).tolist(), strict=True):
            out[k][: 2 * n : 2] += total - zero * m
            out[k][1 : 2 * n : 2] += m
    return out
