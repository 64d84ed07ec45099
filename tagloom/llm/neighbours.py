"""Approximate nearest neighbours: NN-descent builds a neighbour graph, queries walk it greedily.

Equal vectors are one node. A first graph comes from blocks of nodes that are adjacent on random projections. Then, again and again, each
node brings the nodes that list it or that it lists together, and those that are nearer to each other than what they have so far take
each other on (neighbours of neighbours, joined in Spark, distances in numpy). It ends when few entries change. A query begins at its own node and
its list, and expands the best unexpanded nodes of its beam until there is none. A query that ends with too few rows, as its part of the graph is small,
is held against all nodes instead, in blocks of queries. Nodes found are turned into rows (of equal vectors the smallest ids)
and measured in double precision on the original vectors; a column that isn't of floats is kept as doubles all the way.

Vectors that are null, all zero, hold a null or a value that isn't finite, or have another length than most, take no part, neither as query nor as
candidate; neither do rows with a null id. Rows that repeat an id with an equal vector count once. No rows give no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagloom.llm.scratch import saved

DEGREE, PROJECTIONS, BLOCK, CHANGED, BEAM, AT_ONCE = 32, 8, 256, 0.02, 160, 1024


def kind_of(rows: DataFrame, vector: str) -> str:
    """How a column's numbers are kept: float as they are, any others as double."""
    return "<f4" if rows.schema[vector].dataType.elementType.typeName() == "float" else "<f8"


def _vectors(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1) if len(column) else np.zeros((0, 1), kind)


def _table(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names.split())


def _nearest(ids: np.ndarray, others: np.ndarray, d: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest others of each id, ties to smaller ones, each once."""
    order = np.lexsort((others, d, ids))
    ids, others, d = ids[order], others[order], d[order]
    keep = np.ones(len(ids), bool)
    keep[1:] = (ids[1:] != ids[:-1]) | (others[1:] != others[:-1])  # equal pairs have equal distances
    ids, others, d = ids[keep], others[keep], d[keep]
    first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else np.zeros(0, np.int64)
    rank = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
    return ids[rank < most], others[rank < most], d[rank < most]


def _distances(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x -= x.mean(0)  # a common offset would drown small distances
    s = (x * x).sum(1)
    return np.maximum(s[:, None] + s[None] - 2 * x @ x.T, 0)


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """id and vec (bytes, see kind_of) of the rows that take part."""
    kind = kind_of(rows, vector)
    ok = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(vector, lambda v: v != 0)
    rows = rows.filter(F.col(key).isNotNull() & F.col(vector).isNotNull()).filter(ok).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<float>" if kind == "<f4" else "array<double>").alias("v"))
    dim = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    n = dim[0].n if dim else 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy().astype(kind).reshape(batch.num_rows, -1)
            yield _table("id vec", batch.column(0), pa.array([x.tobytes() for x in flat], pa.binary()))

    return saved(rows.filter(F.size("v") == n).mapInArrow(pack, "id long, vec binary").distinct(), "vectors")


def _project(seed: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _vectors(batch.column(1), kind).astype(np.float64)
            way = np.random.Generator(np.random.PCG64(seed)).standard_normal(x.shape[1])
            yield _table("id vec p", batch.column(0), batch.column(1), x @ way)

    return run


def _block(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), _vectors(batch.column(1), kind)
            out = []
            for at in range(0, len(ids), BLOCK):
                i, d = ids[at : at + BLOCK], _distances(x[at : at + BLOCK])
                np.fill_diagonal(d, np.inf)
                k = min(DEGREE, len(i) - 1)
                near = np.argpartition(d, k - 1, 1)[:, :k] if k > 0 else np.zeros((len(i), 0), np.int64)
                out.append((np.repeat(i, k), i[near].ravel(), np.take_along_axis(d, near, 1).ravel()))
            yield _table("id nbr d", *(np.concatenate(c) for c in zip(*out, strict=True)))

    return run


def _keep(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n, settled = 0, 0
        for batch in batches:
            held.append(tuple(c.to_numpy() for c in batch.columns))
            n += batch.num_rows
            if n > max(1 << 20, 2 * settled):
                held = [_nearest(*(np.concatenate(c) for c in zip(*held, strict=True)), most)]
                n = settled = len(held[0][0])
        if held:
            i, o, d = _nearest(*(np.concatenate(c) for c in zip(*held, strict=True)), most)
            yield _table("id nbr d", i, o, d)

    return run


def _merge(edges: DataFrame, most: int) -> DataFrame:
    return edges.select("id", "nbr", "d").repartition("id").mapInArrow(_keep(most), "id long, nbr long, d double")


def _join_around(kind: str):
    """Members of each centre, sorted by centre: pairs nearer than what a member has, if one of the two is new there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None

        def pairs(centre: np.ndarray, ids: np.ndarray, worst: np.ndarray, new: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
            cut = np.flatnonzero(np.concatenate([[True], centre[1:] != centre[:-1], [True]]))
            out = [(ids[:0], ids[:0], worst[:0])]
            for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                i, w, f = ids[a:b], worst[a:b], new[a:b]
                d = _distances(x[a:b])
                p, q = np.nonzero((d < w[:, None]) & (f[:, None] | f[None]) & (i[:, None] != i[None]))
                out.append((i[p], i[q], d[p, q]))
            return _table("id nbr d", *_nearest(*(np.concatenate(c) for c in zip(*out, strict=True)), DEGREE))

        for batch in batches:
            got = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)] + [_vectors(batch.column(4), kind)]
            got = got if rest is None else [np.concatenate(c) for c in zip(rest, got, strict=True)]
            if len(got[0]):
                whole = int(np.searchsorted(got[0], got[0][-1]))
                rest = [c[whole:] for c in got]
                if whole:
                    yield pairs(*(c[:whole] for c in got))
        if rest is not None and len(rest[0]):
            yield pairs(*rest)

    return run


def build(nodes: DataFrame, kind: str) -> DataFrame:
    """The neighbour graph: id, nbr, d (squared) of at most DEGREE neighbours of each node."""
    first = None
    for seed in range(PROJECTIONS):
        part = nodes.mapInArrow(_project(seed, kind), "id long, vec binary, p double").repartitionByRange("p").sortWithinPartitions("p", "id").select("id", "vec").mapInArrow(_block(kind), "id long, nbr long, d double")
        first = part if first is None else first.union(part)
    graph = saved(_merge(first, DEGREE).withColumn("new", F.lit(True)), "graph")
    n = nodes.count()
    while True:
        sides = graph.select("id", "nbr", "new", "d").union(graph.select(F.col("nbr").alias("id"), F.col("id").alias("nbr"), "new", "d").withColumn("r", F.row_number().over(Window.partitionBy("id").orderBy("d", "nbr"))).filter(F.col("r") <= DEGREE).drop("r"))
        worst = graph.groupBy(F.col("id").alias("nbr")).agg(F.when(F.count("*") >= DEGREE, F.max("d")).otherwise(float("inf")).alias("worst"))
        members = sides.groupBy("id", "nbr").agg(F.max("new").alias("new")).join(nodes.withColumnRenamed("id", "nbr").join(worst, "nbr"), "nbr")
        found = members.select("id", "nbr", "worst", "new", "vec").repartition("id").sortWithinPartitions("id").mapInArrow(_join_around(kind), "id long, nbr long, d double")
        old = graph.select("id", "nbr", F.lit(False).alias("known"))
        merged = _merge(graph.select("id", "nbr", "d").union(found), DEGREE).join(old, ["id", "nbr"], "left")
        graph = saved(merged.select("id", "nbr", "d", F.coalesce("known", F.lit(True)).alias("new")), "graph")
        if graph.filter("new").count() <= CHANGED * n * DEGREE:
            break
    return graph.select("id", "nbr", "d")


def _measure(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (_vectors(batch.column(c), kind).astype(np.float64) for c in (2, 3))
            yield _table("id nbr d", batch.column(0), batch.column(1), ((x - y) ** 2).sum(1))

    return run


def walk(queries: DataFrame, nodes: DataFrame, graph: DataFrame, kind: str) -> DataFrame:
    """id (of the query), nbr (a node) and d of the beam that a greedy walk from each query's own node ends with. queries: id, node, vec."""
    asked = queries.select("id", F.col("vec").alias("q"))
    of = nodes.select(F.col("id").alias("nbr"), F.col("vec").alias("v"))
    beam = saved(queries.select("id", F.col("node").alias("nbr"), F.lit(0.0).alias("d"), F.lit(False).alias("done")), "beam")
    while True:  # a node that fell out of the beam can't come back, so this ends
        steps = beam.filter("NOT done").join(graph.select(F.col("id").alias("nbr"), F.col("nbr").alias("to")), "nbr").select("id", F.col("to").alias("nbr")).distinct()
        fresh = steps.join(beam.select("id", "nbr"), ["id", "nbr"], "left_anti")
        found = fresh.join(of, "nbr").join(asked, "id").select("id", "nbr", "q", "v").mapInArrow(_measure(kind), "id long, nbr long, d double")
        best = _merge(beam.select("id", "nbr", "d").union(found), BEAM)
        beam = saved(best.join(beam.select("id", "nbr", F.lit(True).alias("done")), ["id", "nbr"], "left").withColumn("done", F.coalesce("done", F.lit(False))), "beam")
        if not beam.filter("NOT done").limit(1).count():
            break
    return beam.select("id", "nbr", "d")


def nearest(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 100, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found, for each row whose id is divisible by `every`."""
    kind, vectors = kind_of(rows, vector), usable(rows, key, vector)
    nodes = saved(vectors.groupBy("vec").agg(F.min("id").alias("id")).select("id", "vec"), "nodes")
    copies = vectors.join(nodes.withColumnRenamed("id", "node"), "vec")
    first = Window.partitionBy("node").orderBy("id")
    members = saved(copies.select("node", "id").withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k + 1).select("node", "id"), "members")
    queries = saved(copies.filter(F.col("id") % every == 0).select("id", "node", "vec"), "queries")
    found = saved(_ranked(walk(queries, nodes, build(nodes, kind), kind), members, k), "found")
    full = found.groupBy("query_id").count().filter(F.col("count") >= k).select(F.col("query_id").alias("id"))
    short = saved(queries.join(full, "id", "left_anti"), "short")
    few = short.count()
    if few:
        found = found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(_ranked(scanned(short, few, nodes, k + 1, kind), members, k))
    return found


def _ranked(beam: DataFrame, members: DataFrame, k: int) -> DataFrame:
    found = beam.withColumnRenamed("nbr", "node").join(members.withColumnRenamed("id", "vec_id"), "node").filter(F.col("vec_id") != F.col("id"))
    rank = Window.partitionBy("id").orderBy("score", "vec_id")
    return found.withColumn("score", F.sqrt("d")).withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k).select(F.col("id").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def scanned(queries: DataFrame, count: int, nodes: DataFrame, k: int, kind: str) -> DataFrame:
    """id, nbr, d of the k nearest nodes of some queries: AT_ONCE queries at a time go to every task, which sends its own best."""
    spark, blocks, parts = nodes.sparkSession, -(-count // AT_ONCE) * 2, []
    for b in range(blocks):
        got = queries.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).select("id", "vec").toArrow().combine_chunks()
        if not got.num_rows:
            continue
        sent = spark.sparkContext.broadcast((got["id"].to_numpy(), _vectors(got["vec"].combine_chunks(), kind)))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, q = sent.value
            for batch in batches:
                nbr, x = batch.column(0).to_numpy(), _vectors(batch.column(1), kind).astype(np.float64)
                for i, v in zip(ids.tolist(), q.astype(np.float64), strict=True):
                    d = ((x - v) ** 2).sum(1)
                    best = np.argsort(d, kind="stable")[:k]
                    yield _table("id nbr d", np.full(len(best), i), nbr[best], d[best])

        parts.append(saved(_merge(nodes.select("id", "vec").mapInArrow(run, "id long, nbr long, d double"), k), "scanned"))
        sent.destroy()
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out
