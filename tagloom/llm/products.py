"""Exact top-k search by inner product: vectors in order of falling length, partial sums along the singular vectors, Cauchy-Schwarz bounds for the rest.

Vectors become whole numbers (`vectors`) and are range-partitioned by falling length into runs, which hold blocks of up to BLOCK rows. A query's
first bound is its k-th best score in the block of the longest vectors. Blocks of queries then go to all runs whose longest vector can still
reach a bound; the run's task holds its blocks in order of length and takes one block of queries after the other. Within a block the products along
the first singular directions, plus the product of what is left of both lengths, bound each score from above, and what stays below a
query's k-th best is left; along more directions the bound gets tighter. What remains is multiplied in full, in whole numbers. So no row is left out that could
be among the best. A task holds one run (at most RUN rows, or a 65,536th of all) and one block of queries. Best of runs are ranked in Spark.

Rows take part as `vectors` says, if their key isn't null; zero vectors do. Rows that repeat a key are rows of their own: each is a query, and a candidate for the other. Ties go to smaller keys.
Scores beyond a long are held to its ends. No rows, or no queries, give no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagloom.llm.scratch import Scratch
from tagloom.llm.vectors import commonest_length, doubles, gram, whole_numbers

BLOCK, RUN, QUERIES, MOST_RUNS = 2048, 16_384, 256, 65_536
_EXACT = float(1 << 52)


def _table(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names.split())


def _longs(value: bytes, dim: int = 0) -> np.ndarray:
    x = np.frombuffer(value, np.int64)
    return x.reshape(-1, dim) if dim else x


def _lengths(y: np.ndarray) -> np.ndarray:
    return np.sqrt((y.astype(np.float64) ** 2).sum(1))


def _rows(dim: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, y = whole_numbers(batch.column(1), dim, scale)
            yield _table("id norm y", batch.column(0).take(pa.array(place)), _lengths(y), pa.array([r.tobytes() for r in y], pa.binary()))

    return run


def _blocks(size: int):
    """Rows of a run, sorted by length, as blocks: one row of ids and vectors each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, runs, block = np.zeros(0, np.int64), [], 0, 0

        def made(n: int) -> pa.RecordBatch:
            top = float(_lengths(_longs(vectors[0], len(vectors[0]) // 8))[0])
            return _table("run block top ids y", pa.array([runs], pa.int32()), pa.array([block], pa.int32()), [top], pa.array([ids[:n].tobytes()], pa.binary()), pa.array([b"".join(vectors[:n])], pa.binary()))

        for batch in batches:
            if batch.num_rows:
                runs = batch.column(2)[0].as_py()
                ids, vectors = np.concatenate([ids, batch.column(0).to_numpy()]), vectors + batch.column(1).to_pylist()
            while len(vectors) >= size:
                yield made(size)
                ids, vectors, block = ids[size:], vectors[size:], block + 1
        if vectors:
            yield made(len(vectors))

    return run


class _Rotation:
    """Vectors turned so that the first coordinates hold most of their length, and the lengths of what follows some of these."""

    def __init__(self, turn: np.ndarray):
        dim = len(turn)
        self.turn, self.cuts = turn, sorted({max(1, dim // 8), max(1, dim // 4), max(1, dim // 2)})

    def __call__(self, y: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        z = y.astype(np.float64) @ self.turn
        return z, [np.sqrt((z[:, c:] ** 2).sum(1)) for c in self.cuts]


class Best:
    """The k best of some queries so far."""

    def __init__(self, bound: np.ndarray, k: int):
        self.k, self.bound, self.q = k, bound.copy(), np.zeros(0, np.int64)
        self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, q: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(q):
            return
        q, score, ids = np.concatenate([self.q, q]), np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, ~score, q))  # ~ turns the order of longs round without overflow
        q, score, ids = q[order], score[order], ids[order]
        first = np.concatenate([[True], q[1:] != q[:-1]])
        rank = np.arange(len(q)) - np.flatnonzero(first)[np.cumsum(first) - 1]
        keep = rank < self.k
        self.q, self.score, self.id = q[keep], score[keep], ids[keep]
        last = rank == self.k - 1
        self.bound[q[last]] = np.maximum(self.bound[q[last]], score[last].astype(np.float64))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of a with all of b, in whole numbers: doubles are exact as long as no partial sum passes 2**52."""
    if len(a) and len(b) and _lengths(a).max() * _lengths(b).max() < _EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    exact = a.astype(object) @ b.T.astype(object)
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def search(best: Best, queries: tuple, block: tuple, rotation: _Rotation) -> None:
    """Take up what a block of candidates has for a block of queries. Both: places, lengths, vectors, turned vectors, lengths of rests; block: ids too."""
    q_place, q_norm, q_y, q_z, q_rest = queries
    c_place, c_norm, c_y, c_z, c_rest, c_id = block
    slack = 0.5 + 1e-9 * q_norm * (c_norm[0] if len(c_norm) else 0)
    floor = best.bound - slack
    rows, cols = np.flatnonzero(q_norm * c_norm[0] >= floor), np.arange(len(c_norm))
    part, done = np.zeros((len(rows), len(cols))), 0
    for cut, q_r, c_r in zip(rotation.cuts, q_rest, c_rest, strict=True):
        part += q_z[rows, done:cut] @ c_z[cols, done:cut].T
        open_ = part + q_r[rows][:, None] * c_r[cols][None] >= floor[rows][:, None]
        alive, wide = open_.any(1), open_.any(0)
        rows, cols, part, done = rows[alive], cols[wide], part[np.ix_(alive, wide)], cut
        if not len(rows):
            return
    score = _products(q_y[rows], c_y[cols])
    # bounds are scores of this kind, so they compare as doubles up to rounding, which only lets more rows through
    good = (score.astype(np.float64) >= best.bound[rows][:, None] - slack[rows][:, None] + 0.5) & (q_place[rows][:, None] != c_place[cols][None])
    i, j = np.nonzero(good)
    best.add(rows[i], score[i, j], c_id[cols[j]])


def _place(run: int, block: int, n: int) -> np.ndarray:
    return (np.int64(run) << 40) + (np.int64(block) << 12) + np.arange(n)


def top_products(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 50, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id and score of the k highest products for each row whose key is divisible by `every`."""
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession)
    values = doubles(rows.filter(F.col(key).isNotNull()).withColumn(key, F.col(key).cast("long")), key, vector)
    dim, count = commonest_length(values)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not dim:
        return empty
    packed = values.mapInArrow(_rows(dim, scale), "id long, norm double, y binary")
    runs = min(-(-count // RUN), MOST_RUNS)
    in_order = packed.repartitionByRange(runs, F.desc("norm"), "id").sortWithinPartitions(F.desc("norm"), "id").select("id", "y", F.spark_partition_id().alias("run"))
    blocks = scratch.save(in_order.mapInArrow(_blocks(BLOCK), "run int, block int, top double, ids binary, y binary"), "blocks")
    tops = [(r.run, r.top) for r in blocks.groupBy("run").agg(F.max("top").alias("top")).orderBy("run").collect()]  # at most MOST_RUNS
    if not tops:
        return empty
    turned = np.linalg.eigh(gram(blocks.select("y"), lambda b: _longs(b"".join(b.column(0).to_pylist()), dim).astype(np.float64), dim))[1][:, ::-1]
    rotation = _Rotation(np.ascontiguousarray(turned))
    longest = blocks.filter(F.col("run") == tops[0][0]).filter("block = 0").select("run", "block", "ids", "y").first()  # one block
    head = spark.sparkContext.broadcast((longest.run, longest.block, bytes(longest.ids), bytes(longest.y)))

    def opened(run: int, block: int, ids: bytes, y: bytes) -> tuple:
        y = _longs(y, dim)
        return _place(run, block, len(y)), _lengths(y), y, *rotation(y), _longs(ids)

    def queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries among the candidates, in blocks, each with a first bound and the length that a candidate needs."""
        first, held = opened(*head.value), []

        def made(rows: list) -> pa.RecordBatch:
            place, ids, y = (np.concatenate(c) for c in zip(*rows, strict=True))
            norm = _lengths(y)
            best = Best(np.full(len(ids), -np.inf), k)
            search(best, (place, norm, y, *rotation(y)), first, rotation)
            slack = 0.5 + 1e-9 * norm * first[1][0]
            with np.errstate(divide="ignore", invalid="ignore"):
                need = np.where((best.bound > 0) & (norm > 0), (best.bound - slack) / norm, -np.inf)
            return _table("q need place id bound y", [int(place[0])], [float(need.min())], *(pa.array([c.tobytes()], pa.binary()) for c in (place, ids, best.bound, y)))

        for batch in batches:
            for run, block, ids, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = _longs(ids)
                at = np.flatnonzero(ids % every == 0)
                for part in (at[i : i + QUERIES] for i in range(0, len(at), QUERIES)):
                    held.append((_place(run, block, len(ids))[part], ids[part], _longs(y, dim)[part]))
                    if sum(len(x[0]) for x in held) >= QUERIES:
                        yield made(held)
                        held = []
        if held:
            yield made(held)

    asked = scratch.save(blocks.select("run", "block", "ids", "y").mapInArrow(queries, "q long, need double, place binary, id binary, bound binary, y binary"), "asked")
    slices = max(1, min(asked.count(), -(-64 // len(tops))))
    sent_tops = spark.sparkContext.broadcast((np.array([r for r, _ in tops], np.int32), np.array([t for _, t in tops])))

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each block of queries for each run that may hold something for it."""
        number, top = sent_tops.value
        for batch in batches:
            for q, need, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for run in number[top >= need].tolist():
                    yield _table("run slice kind seq place id bound y", pa.array([run], pa.int32()), pa.array([hash(q) % slices], pa.int32()), pa.array([1], pa.int32()), [q], *(pa.array([x], pa.binary()) for x in rest))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            for run, slice_, kind, seq, place, ids, bound, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != (run, slice_):
                    at, held = (run, slice_), []
                if kind == 0:
                    held.append(opened(run, seq, ids, y))
                    continue
                y, best = _longs(y, dim), Best(np.frombuffer(bound), k)
                asked_ = (_longs(place), _lengths(y), y, *rotation(y))
                for block in held:
                    search(best, asked_, block, rotation)
                yield _table("place query_id vec_id score", _longs(place)[best.q], _longs(ids)[best.q], best.id, best.score)

    schema = "run int, slice int, kind int, seq long, place binary, id binary, bound binary, y binary"
    nothing = F.lit(None).cast("binary")
    candidates = blocks.select("run", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), F.lit(0).alias("kind"), F.col("block").cast("long").alias("seq"), nothing.alias("place"), F.col("ids").alias("id"), nothing.alias("bound"), "y")
    both = candidates.unionByName(asked.mapInArrow(sent, schema)).repartition("run", "slice").sortWithinPartitions("run", "slice", "kind", "seq")
    found = both.mapInArrow(searched, "place long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("place").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
