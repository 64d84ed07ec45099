"""Packing documents into training sequences by lexical retrieval over sharded BM25 inverted indexes.

1. A bounded sample of documents (`sample_docs`) gives a routing tree: documents become token vectors weighted by idf, hashed to `DIMS`
   dimensions, and each node splits its sample at the median of its main direction. Below the leaves further bits come from fixed random
   directions around the leaf's mean, so that the order goes on to any depth, whatever the number of documents.
2. One reading of all texts gives token ids, the place in that order, and document frequencies; number of documents, mean length and
   document frequency of BM25 are those of the whole table (a table of one number for each id of the vocabulary).
3. Documents are sorted by place over the cluster, so that alike ones lie together, wherever they come from; equal places are parted by a
   hash, so that many copies make many shards. A shard is the next `shard_docs` documents or `shard_tokens` tokens of that order. Its
   inverted index takes each seed's query with all the seed's terms and gives its unused neighbours, best first; they fill the seed's window. What a
   full window cuts off is the next seed; without neighbours the next unused document of the order is. A shard's last window goes on with the
   first documents of the next shard. Only the last window of a task can fall short; it is cut into lengths that are powers of two,
   which need no padding.

Every document is indexed and every seed asks its own shard, so the work grows with the number of documents. Neighbours in other shards
aren't found; the README has figures for what that costs against a search of all documents.

A null text is empty; an empty text is the end id alone. Rows with equal ids are packed each on its own. No documents give no rows. Other columns
are not read. A text of any length is packed whole; one longer than a shard is a shard. Equal scores go by the order in the shard, sequences are
numbered by task and count.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.scratch import Scratch
from tagloom.llm.tokens import WordEncoder
from tagloom.llm.wordhash import blocks, mix

SHARD_TOKENS, SHARD_DOCS, SAMPLE_DOCS, LEAF_DOCS, IDS, DIMS, PATH_BITS, K1, B = 2_000_000, 4_000, 4_096, 32, 1 << 16, 64, 40, 1.2, 0.75
COLUMNS = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
_encoders: dict[str, WordEncoder] = {}


def idf(df: np.ndarray, docs: int) -> np.ndarray:
    return np.log(1 + (docs - df + 0.5) / (df + 0.5))


def saturation(tf: np.ndarray, length, mean: float) -> np.ndarray:
    """What a term's count in a document of some length is worth; BM25 is its sum over shared terms, each times the term's idf."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / max(1.0, mean)))


def counts(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """document, term and count of the distinct ids of some documents that lie one after the other."""
    pair, tf = np.unique(np.repeat(np.arange(len(sizes), dtype=np.uint32) << np.uint32(16), sizes) | ids, return_counts=True)
    return (pair >> np.uint32(16)).astype(np.int64), (pair & np.uint32(IDS - 1)).astype(np.int64), tf


@dataclass
class Router:
    """A tree of splits: node i goes on to 2i + 1 below or at its median along its direction, else to 2i + 2; leaves have no direction."""

    idf: np.ndarray
    direction: np.ndarray
    median: np.ndarray
    mean: np.ndarray
    inner: np.ndarray

    @staticmethod
    def fit(doc: np.ndarray, term: np.ndarray, tf: np.ndarray, docs: int) -> Router:
        r = Router(idf(np.bincount(term, minlength=IDS), max(1, docs)).astype(np.float32), np.zeros((0, DIMS)), np.zeros(0), np.zeros((0, DIMS)), np.zeros(0, bool))
        x = r.vectors(doc, term, tf, docs)
        rows: dict[int, np.ndarray] = {0: np.arange(docs)}
        nodes: dict[int, tuple] = {}
        while rows:
            i, own = rows.popitem()
            mean = x[own].mean(0) if len(own) else np.zeros(DIMS)
            if len(own) < 2 * LEAF_DOCS:
                nodes[i] = (np.zeros(DIMS), 0.0, mean, False)
                continue
            way = np.linalg.svd(x[own] - mean, full_matrices=False)[2][0]
            along = x[own] @ way
            cut = float(np.median(along))
            if not (along > cut).any():
                nodes[i] = (np.zeros(DIMS), 0.0, mean, False)
                continue
            nodes[i] = (way, cut, mean, True)
            rows[2 * i + 1], rows[2 * i + 2] = own[along <= cut], own[along > cut]
        size = max(nodes) + 1
        r.direction, r.median, r.mean, r.inner = np.zeros((size, DIMS)), np.zeros(size), np.zeros((size, DIMS)), np.zeros(size, bool)
        for i, (way, cut, mean, inner) in nodes.items():
            r.direction[i], r.median[i], r.mean[i], r.inner[i] = way, cut, mean, inner
        return r

    def vectors(self, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, docs: int) -> np.ndarray:
        h = mix(term.astype(np.uint64) + np.uint64(1))
        weight = (1 + np.log(tf)) * self.idf[term] * np.where(h >> np.uint64(63) > 0, 1.0, -1.0)
        x = np.bincount(doc * DIMS + (h % np.uint64(DIMS)).astype(np.int64), weight, docs * DIMS).reshape(docs, DIMS)
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def places(self, x: np.ndarray) -> np.ndarray:
        """Places in the order: the leaf's, from left to right, then bits of directions around its mean."""
        node, path, depth = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        while (on := np.flatnonzero(self.inner[node])).size:
            right = (x[on] * self.direction[node[on]]).sum(1) > self.median[node[on]]
            path[on] = path[on] << 1 | right
            depth[on] += 1
            node[on] = 2 * node[on] + 1 + right
        ways = np.random.Generator(np.random.PCG64(5)).standard_normal((DIMS, PATH_BITS))
        bits = ((x - self.mean[node]) @ ways > 0).astype(np.int64)
        return (path << (62 - PATH_BITS - depth) << PATH_BITS) | (bits << np.arange(PATH_BITS - 1, -1, -1)).sum(1)


def _tokens(path: str, end_id: int, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows lo:hi, their ids (each text's with the end id) and sizes."""
    encoder = _encoders[path] if path in _encoders else _encoders.setdefault(path, WordEncoder(path))
    for lo, hi in blocks(texts, 1 << 18):
        flat, at, _, _ = encoder(texts.slice(lo, hi - lo))
        at = at[: hi - lo + 1]
        yield lo, hi, np.insert(flat[: at[-1]], at[1:], np.uint16(end_id)), np.diff(at) + 1


def _sampled(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, ids, sizes in _tokens(path, end_id, batch.column(0)):
                doc, term, tf = counts(ids, sizes)
                at = np.searchsorted(doc, np.arange(len(sizes) + 1))
                yield pa.RecordBatch.from_arrays([pa.array([x[at[i] : at[i + 1]].astype(t).tobytes() for i in range(len(sizes))], pa.binary()) for x, t in ((term, "<u2"), (tf, "<u4"))], ["term", "tf"])

    return run


def learn_router(texts: DataFrame, tokenizer_path: str, end_id: int, sample_docs: int) -> Router:
    """From about sample_docs documents, chosen by a hash of the text and of a row number."""
    rows = texts.count()
    keep = F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(1 << 30)) < int(min(1.0, sample_docs / max(1, rows)) * (1 << 30))
    got = texts.filter(keep).mapInArrow(_sampled(tokenizer_path, end_id), "term binary, tf binary").limit(2 * sample_docs).toArrow()
    term, tf = ([np.frombuffer(x.as_py(), t) for x in got[c]] for c, t in (("term", "<u2"), ("tf", "<u4")))
    doc = np.repeat(np.arange(len(term)), [len(x) for x in term])
    none = [np.zeros(0, np.int64)]
    return Router.fit(doc, np.concatenate([*none, *term]), np.concatenate([*none, *tf]), len(term))


def _read(path: str, end_id: int, router):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, df, docs, total = router.value, np.zeros(IDS, np.int64), 0, 0
        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for lo, hi, ids, sizes in _tokens(path, end_id, batch.column(1)):
                doc, term, tf = counts(ids, sizes)
                df += np.bincount(term, minlength=IDS)
                docs, total = docs + hi - lo, total + len(ids)
                at = np.concatenate([[0], np.cumsum(sizes)])
                data = ids.astype("<u2").tobytes()
                place = tree.places(tree.vectors(doc, term, tf, hi - lo))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(place), pa.array([data[2 * a : 2 * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.binary()), *[pa.nulls(hi - lo, pa.int64())] * 2], ["key", "place", "ids", "term", "df"])
        if docs:
            term = np.flatnonzero(df)
            term, df = np.append(term, [-1, -2]), np.append(df[term], [docs, total])  # and the number of documents and of tokens
            yield pa.RecordBatch.from_arrays([pa.nulls(len(term), kind), pa.nulls(len(term), pa.int64()), pa.nulls(len(term), pa.binary()), pa.array(term), pa.array(df)], ["key", "place", "ids", "term", "df"])

    return run


class Index:
    """Inverted index of a shard: postings of rare terms, and a matrix of what the terms that many of its documents have are worth in each."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, weights: np.ndarray, mean: float):
        self.docs = len(sizes)
        doc, term, tf = counts(ids, sizes)
        worth = (saturation(tf, sizes[doc], mean) * weights[term]).astype(np.float32)
        known, term = np.unique(term, return_inverse=True)
        self.term, self.of = term, np.searchsorted(doc, np.arange(self.docs + 1))
        df = np.bincount(term, minlength=len(known))
        self.hot = df > max(16, self.docs >> 5)
        self.column = np.cumsum(self.hot) - 1
        own = self.hot[term]
        self.matrix = np.zeros((self.docs, int(self.hot.sum())), np.float32)
        self.matrix[doc[own], self.column[term[own]]] = worth[own]
        order = np.argsort(term[~own], kind="stable")
        self.doc, self.worth = doc[~own][order], worth[~own][order]
        self.n = np.where(self.hot, 0, df)
        self.first = np.cumsum(self.n) - self.n

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of all documents of the shard for all terms of a seed."""
        term = self.term[self.of[seed] : self.of[seed + 1]]
        asked = np.zeros(self.matrix.shape[1], np.float32)
        asked[self.column[term[self.hot[term]]]] = 1
        n = self.n[term]
        place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[term], n)
        return self.matrix @ asked + np.bincount(self.doc[place], self.worth[place], self.docs)


def in_order(sizes: np.ndarray, index: Index, window: int, left: int) -> Iterator[int]:
    """Documents of a shard in the order in which they fill windows; the first window has room for left tokens."""
    free, fresh, found = np.ones(len(sizes), bool), 0, iter(())

    def near(seed: int) -> Iterator[int]:
        score = index.scores(seed) * free
        return iter(np.argsort(-score, kind="stable")[: int((score > 0).sum())].tolist())

    for _ in range(len(sizes)):
        d = next((x for x in found if free[x]), None)
        if d is None:
            while not free[fresh]:
                fresh += 1
            d, found = fresh, None
        yield d
        free[d] = False
        if sizes[d] >= left:  # full; the rest of this document, if any, is the next seed
            left = window - (int(sizes[d]) - left) % window
            found = near(d) if left < window else iter(())
        else:
            found = near(d) if found is None else found
            left -= int(sizes[d])


def _pack(model, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, mean, shard_docs, shard_tokens = model.value
        made = (context.partitionId() if (context := TaskContext.get()) else 0) << 33
        held: list[tuple] = []  # key and ids of the shard's documents
        window_pieces: list[tuple] = []  # of the open window: key, start, ids, tokens of the document
        filled = total = 0

        def rows(pieces: list[tuple]) -> Iterator[tuple]:
            nonlocal made
            offset = 0
            for key, start, ids, n in pieces:
                yield key, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), n, made, offset
                offset += len(ids)
            made += 1

        def batch_of(out: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) or [()] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i else kind) for i, c in enumerate(cols)], ["key", *COLUMNS])

        def flush() -> list[tuple]:
            nonlocal filled, window_pieces
            keys, ids = zip(*held, strict=True)
            held.clear()
            sizes, out = np.array([len(x) for x in ids]), []
            for d in in_order(sizes, Index(np.concatenate(ids), sizes, weights, mean), window, window - filled):
                start, n = 0, len(ids[d])
                while start < n:
                    more = min(window - filled, n - start)
                    window_pieces.append((keys[d], start, ids[d][start : start + more], n))
                    start, filled = start + more, filled + more
                    if filled == window:
                        out += rows(window_pieces)
                        window_pieces, filled = [], 0
            return out

        kind = pa.null()
        for batch in batches:
            kind = batch.column(0).type
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.append((key, np.frombuffer(ids.as_py(), "<u2")))
                total += len(held[-1][1])
                if total >= shard_tokens or len(held) >= shard_docs:
                    yield batch_of(flush(), kind)
                    total = 0
        last = flush() if held else []
        while window_pieces:  # the largest power of two that is left
            room, part = 1 << filled.bit_length() - 1, []
            filled -= room
            while room:
                key, start, ids, n = window_pieces.pop(0)
                part.append((key, start, ids[:room], n))
                if len(ids) > room:
                    window_pieces.insert(0, (key, start + room, ids[room:], n))
                room -= len(part[-1][2])
            last += rows(part)
        if last:
            yield batch_of(last, kind)

    return run


def tokenized(docs: DataFrame, tokenizer_path: str, key: str, text: str, end_id: int, sample_docs: int, scratch: Scratch) -> tuple[DataFrame, np.ndarray, int, float]:
    """key, place, row (a number of its own), ids of each document, saved; document frequencies, number and mean length of documents."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    router = docs.sparkSession.sparkContext.broadcast(learn_router(rows.select("text"), tokenizer_path, end_id, sample_docs))
    kind = docs.schema[key].dataType.simpleString()
    made = rows.mapInArrow(_read(tokenizer_path, end_id, router), f"key {kind}, place long, ids binary, term long, df long")
    table = scratch.save(made.withColumn("row", F.monotonically_increasing_id()), "tokens")
    router.destroy()
    sums = dict(table.filter("term IS NOT NULL").groupBy("term").agg(F.sum("df")).collect())  # at most one row for each id of the vocabulary
    count, total = sums.pop(-1, 0), sums.pop(-2, 0)
    df = np.zeros(IDS, np.int64)
    df[list(sums)] = list(sums.values())
    return table.filter("ids IS NOT NULL").select("key", "place", "row", "ids"), df, count, total / max(1, count)


def pack(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", window: int = 4096, end_id: int = 2, shard_docs: int = SHARD_DOCS, shard_tokens: int = SHARD_TOKENS, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """A row for each piece: the key, start, length, ids_crc32, doc_tokens, sequence_id and offset."""
    scratch = Scratch(docs.sparkSession)
    table, df, count, mean = tokenized(docs, tokenizer_path, key, text, end_id, sample_docs, scratch)
    weights = idf(df, count)
    weights[end_id] = 0  # which all documents share
    model = docs.sparkSession.sparkContext.broadcast((weights, mean, shard_docs, shard_tokens))
    ordered = table.withColumn("tie", F.xxhash64("row")).repartitionByRange("place", "tie").sortWithinPartitions("place", "tie", "row")
    kind = docs.schema[key].dataType.simpleString()
    return ordered.select("key", "ids").mapInArrow(_pack(model, window), f"key {kind}, " + ", ".join(f"{c} long" for c in COLUMNS)).withColumnRenamed("key", key)
