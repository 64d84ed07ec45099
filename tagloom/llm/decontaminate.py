"""Benchmark decontamination: n-grams of test items, looked up in every window of the training texts.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A window is `size` consecutive words of an item; an
item with fewer words, but not none, is one window. The test n-grams' hashes are broadcast as one sorted array when there
are at most `broadcast_windows` of them; beyond that, texts keep the windows that a bitmap of fixed size lets through, and these
are joined with the test n-grams. Either way a hit is verified word by word.

Nulls and empty texts have no words, so they are clean; an item without words matches nothing; rows that share an id are judged one by
one; an empty benchmark leaves all documents clean; extra columns pass through `remove_contaminated` and are ignored by
`contamination`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.scratch import saved
from tagloom.llm.wordhash import NOT_ALNUM, blocks, flat, shingles, words

BITS = 1 << 24


def _item_windows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = words(*flat(batch.column(1)), NOT_ALNUM)
            out: dict[str, list] = {"item": [], "k": [], "hash": [], "words": []}
            for i, item in enumerate(batch.column(0).to_pylist()):
                a, b = int(w.first[i]), int(w.first[i + 1])
                k = min(size, b - a)
                if k and item is not None:
                    for j, h in enumerate(shingles(w.hash[a:b], k).view(np.int64).tolist()):
                        out["item"].append(item)
                        out["k"].append(k)
                        out["hash"].append(h)
                        out["words"].append(b" ".join(w.text(x) for x in range(a + j, a + j + k)))
            yield pa.RecordBatch.from_arrays([pa.array(out["item"], pa.string()), pa.array(out["k"], pa.int32()), pa.array(out["hash"], pa.int64()), pa.array(out["words"], pa.binary())], list(out))

    return run


def benchmark_windows(benchmark: DataFrame, size: int, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item, k, hash, words) windows of the test items."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
    return saved(items.mapInArrow(_item_windows(size), "item string, k int, hash long, words binary").distinct(), "windows")


def _candidates(w, first: int, end: int, by_length) -> Iterator[tuple[int, int, int]]:
    """(position, k, hash) of the words' windows that `by_length` lets through."""
    for k, lets in by_length:
        h = shingles(w.hash[first:end], k)
        for j in np.flatnonzero(lets(h)).tolist():
            yield j, k, int(h.view(np.int64)[j])


def _digest(n_words: int, found: dict[str, list[tuple[int, int]]] | set, spans: list[tuple[int, int]]) -> tuple:
    hit = np.zeros(n_words + 1, np.int64)
    for at, k in spans:
        hit[at] += 1
        hit[at + k] -= 1
    items = sorted(found)
    n_hit = int((np.cumsum(hit[:-1]) > 0).sum())
    return n_words, n_hit, len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), n_hit > 0


_COLUMNS = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]


def _scan(table, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, ks = table.value
        tests = []
        for k in ks:
            all_k = np.sort(np.array([h for (n, h) in known if n == k], np.int64).view(np.uint64))
            bits = np.zeros(1 << 20, bool)
            bits[(all_k >> np.uint64(44)).astype(np.int64)] = True

            def lets(h, all_k=all_k, bits=bits):
                maybe = bits[(h >> np.uint64(44)).astype(np.int64)]
                maybe[maybe] = np.isin(h[maybe], all_k)
                return maybe

            tests.append((k, lets))
        for batch in batches:
            texts, rows = batch.column(batch.schema.get_field_index(text)), []
            for lo, hi in blocks(texts, 1 << 18):
                w = words(*flat(texts.slice(lo, hi - lo)), NOT_ALNUM)
                hits: dict[int, list] = {}
                doc = w.doc()
                for k, lets in tests:
                    h = shingles(w.hash, k)
                    for j in np.flatnonzero(lets(h)).tolist():
                        if j + k <= w.first[doc[j] + 1]:
                            exact = known[(k, int(h.view(np.int64)[j]))].get(b" ".join(w.text(x) for x in range(j, j + k)))
                            if exact:
                                hits.setdefault(int(doc[j]), []).append((j - int(w.first[doc[j]]), k, exact))
                for i, n in enumerate(np.diff(w.first).tolist()):
                    own = hits.get(i, [])
                    rows.append(_digest(n, {x for _, _, items in own for x in items}, [(a, k) for a, k, _ in own]))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True))], [*batch.schema.names, *(x.split()[0] for x in _COLUMNS.split(", "))])

    return run


def _let_through(bitmap, ks: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(bitmap.value, np.uint8))
        lets = lambda h: bits[(h % np.uint64(BITS)).astype(np.int64)] > 0
        for batch in batches:
            row, texts = batch.column(0), batch.column(1)
            out: list[list] = [[], [], [], [], []]
            for lo, hi in blocks(texts, 1 << 18):
                w = words(*flat(texts.slice(lo, hi - lo)), NOT_ALNUM)
                for i in range(hi - lo):
                    a, b = int(w.first[i]), int(w.first[i + 1])
                    for j, k, h in _candidates(w, a, b, [(k, lets) for k in ks]):
                        for c, v in zip(out, (row[lo + i].as_py(), j, k, h, b" ".join(w.text(a + x) for x in range(j, j + k))), strict=True):
                            c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()), strict=True)], ["row", "at", "k", "hash", "words"])

    return run


def _marked(text: str, row: str, hits: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {n: batch.schema.get_field_index(n) for n in batch.schema.names}
            rows = []
            for value, found in zip(batch.column(at[text]), batch.column(at[hits]).to_pylist(), strict=True):
                w = words(*flat(pa.array([value.as_py()], pa.large_string())), NOT_ALNUM)
                rows.append(_digest(len(w.hash), {x["item"] for x in found or ()}, [(x["at"], x["k"]) for x in found or ()]))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kept = [n for n in batch.schema.names if n not in (row, hits)]
            yield pa.RecordBatch.from_arrays([*(batch.column(at[n]) for n in kept), *(pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True))], [*kept, *(x.split()[0] for x in _COLUMNS.split(", "))])

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", size: int = 10, broadcast_windows: int = 500_000) -> DataFrame:
    """Add n_words, n_hit, n_items, items_sha256 and contaminated to documents; columns of these names that documents have give way."""
    spark, docs = docs.sparkSession, docs.drop(*(x.split()[0] for x in _COLUMNS.split(", ")))
    windows = benchmark_windows(benchmark, size)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), _COLUMNS])
    if windows.count() <= broadcast_windows:
        known: dict[tuple[int, int], dict[bytes, list[str]]] = {}
        for r in windows.toLocalIterator():
            known.setdefault((r.k, r.hash), {}).setdefault(bytes(r.words), []).append(r.item)
        return docs.mapInArrow(_scan(spark.sparkContext.broadcast((known, sorted({k for k, _ in known}))), text), schema)
    bits = np.zeros(BITS, bool)
    for r in windows.select((F.pmod(F.expr("shiftrightunsigned(hash, 1)"), F.lit(BITS >> 1)) * 2 + F.col("hash").bitwiseAND(F.lit(1))).alias("bit")).distinct().toLocalIterator():
        bits[r.bit] = True
    ks = [r.k for r in windows.select("k").distinct().collect()]
    row, hits = _free("_row", docs.columns), _free("_found", docs.columns)
    rows = saved(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    maybe = rows.select(row, text).mapInArrow(_let_through(spark.sparkContext.broadcast(np.packbits(bits).tobytes()), ks), "row long, at long, k int, hash long, words binary")
    found = maybe.join(windows, ["k", "hash", "words"]).groupBy(F.col("row").alias(row)).agg(F.collect_list(F.struct("at", "k", "item")).alias(hits))
    joined = rows.join(found, row, "left")
    return joined.select(row, *docs.columns, hits).mapInArrow(_marked(text, row, hits), schema)


def _free(name: str, taken: list[str]) -> str:
    """The name, with something behind it if it is taken."""
    while name in {x.lower() for x in taken}:
        name += "_"
    return name


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", most_hit: float = 0.0) -> DataFrame:
    """Documents of whose words at most this share lies in a test window; all columns stay."""
    kept = contamination(docs.select(F.struct(*docs.columns).alias("_doc"), F.col(text).alias("_text")), benchmark, "_text")
    return kept.filter(F.col("n_hit") <= most_hit * F.col("n_words")).select("_doc.*")
