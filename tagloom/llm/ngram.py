"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted hash arrays, memory-mapped by scoring workers.

Tokens are the words of a text, A-Z lower-cased, then one end; the first is seen after a begin mark. Tasks count the bigrams of
some million tokens at a time and send them, as arrays sorted by hash, to one of S shards; a shard's task adds them up and writes them to
the shared folder. A bigram's shard follows from its first word, unless that word may hold more than a fraction of a shard's share of all
tokens: first words are counted by `BUCKETS` places of their hash, over all texts, and the bigrams of words in a full place are spread over all
shards. What the shards know of such a word meets in the word's own shard, by a second exchange, as does the number of distinct first
words of each second word. Discounts come from counts of counts over all shards. A scoring task maps the arrays and looks up the distinct
tokens and bigrams of a block of texts; it keeps the `MAPS` arrays used last mapped, without file handles.

Every text counts whole. A null text is empty, so its only token is the end. Repeated rows are scored one by one, and count as often as they
come. Without training rows every token has probability 1. A very long text is a block of its own. Other columns pass through; those named like the
new ones give way. Files of a model stay in the shared folder until `LanguageModel.drop`; a task that runs again writes the same files. From a
store that can't be mapped a worker reads the arrays that a block needs, and keeps those used last, up to `KEPT_BYTES`; blocks are eight times as
large there.
"""

from __future__ import annotations

import math
import mmap
import os
import sys
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.scratch import new_folder
from tagloom.llm.wordhash import SPACE, blocks, flat, mix, words

END, BEGIN, _PAIR = np.uint64(0x517CC1B727220A95), np.uint64(0x2545F4914F6CDD1D), np.uint64(0xA0761D6478BD642F)
FLUSH_TOKENS, SHARD_TOKENS, BUCKETS, SLICE, KEPT_BYTES = 1 << 20, 1 << 21, 1 << 20, 1 << 10, 256 << 20
#: From Python 3.13 on a map needs no file handle; a process may have 65,530 maps as a rule. Earlier each takes one of some 1,024 handles.
_NO_HANDLE = {"trackfd": False} if sys.version_info >= (3, 13) else {}
MAPS = 1 << 15 if _NO_HANDLE else 256


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens, of the token before each, and where each text's begin."""
    w = words(*flat(texts), SPACE)
    n = len(w.first) - 1
    first = w.first + np.arange(n + 1)
    now = np.empty(first[-1], np.uint64)
    now[first[1:] - 1] = END
    inner = np.ones(len(now), bool)
    inner[first[1:] - 1] = False
    now[inner] = w.hash
    before = np.empty_like(now)
    before[1:] = now[:-1]
    before[first[:-1]] = BEGIN
    return now, before, first


def pair(before: np.ndarray, now: np.ndarray) -> np.ndarray:
    return mix(before * _PAIR + now)


def _shard(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _bytes(a: np.ndarray, kind: str) -> bytes:
    return a.astype(kind).tobytes()


def _table(**columns: tuple[list, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], list(columns))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    now, before, n = [], [], 0
    for batch in batches:
        for lo, hi in blocks(batch.column(0), 1 << 20):
            a, b, _ = tokens(batch.column(0).slice(lo, hi - lo))
            now.append(a)
            before.append(b)
            n += len(a)
            if n >= FLUSH_TOKENS:
                yield np.concatenate(now), np.concatenate(before)
                now, before, n = [], [], 0
    if n:
        yield np.concatenate(now), np.concatenate(before)


def bucket(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(BUCKETS - 1)).astype(np.int64)


def _loads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many tokens of a task follow the words of each place, in slices of places."""
    load = np.zeros(BUCKETS, np.int64)
    for _, before in _chunks(batches):
        load += np.bincount(bucket(before), minlength=BUCKETS)
    used = np.flatnonzero(load)
    cuts = np.searchsorted(used, np.arange(BUCKETS // SLICE + 1) * SLICE)
    full = np.flatnonzero(np.diff(cuts)).tolist()
    yield _table(part=(full, pa.int32()), at=([_bytes(used[cuts[i] : cuts[i + 1]] - i * SLICE, "<u2") for i in full], pa.binary()), n=([_bytes(load[used[cuts[i] : cuts[i + 1]]], "<i8") for i in full], pa.binary()))


def _add_loads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, at, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            sums.setdefault(i, np.zeros(SLICE, np.int64))[np.frombuffer(at, "<u2")] += np.frombuffer(n, "<i8")
    yield _table(part=(list(sums), pa.int32()), n=([_bytes(x, "<i8") for x in sums.values()], pa.binary()))


def loads(rows: DataFrame) -> np.ndarray:
    """Tokens after the words of each place, over all texts: BUCKETS numbers, whatever the input."""
    out = np.zeros(BUCKETS, np.int64)
    for r in rows.mapInArrow(_loads, "part int, at binary, n binary").repartition("part").mapInArrow(_add_loads, "part int, n binary").collect():
        out[r.part * SLICE : (r.part + 1) * SLICE] = np.frombuffer(r.n, "<i8")
    return out


def _count(spread, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for now, before in _chunks(batches):
            g, at, c = np.unique(pair(before, now), return_index=True, return_counts=True)
            b = before[at]
            shard = np.where(spread.value[bucket(b)], _shard(g, shards), _shard(b, shards))
            order = np.lexsort((b, shard))
            shard, b, w, c = shard[order], b[order], now[at][order], c[order]
            cuts = np.searchsorted(shard, np.arange(shards + 1))
            rows: list[tuple] = []
            for s in np.flatnonzero(np.diff(cuts)).tolist():
                x = slice(cuts[s], cuts[s + 1])
                u, n = np.unique(b[x], return_counts=True)
                rows.append((s, _bytes(u, "<u8"), _bytes(n, "<u4"), _bytes(w[x], "<u8"), _bytes(c[x], "<u4")))
            cols = list(zip(*rows, strict=True))
            for i in range(0, len(rows), 64):
                yield _table(shard=(cols[0][i : i + 64], pa.int32()), first=(cols[1][i : i + 64], pa.binary()), runs=(cols[2][i : i + 64], pa.binary()), second=(cols[3][i : i + 64], pa.binary()), n=(cols[4][i : i + 64], pa.binary()))

    return run


def _read(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.concatenate([np.frombuffer(x.as_py(), kind) for x in column])


def _write(folder: str, name: str, array: np.ndarray) -> None:
    """One whole file, under its name only when complete; made again, it is the same."""
    where, path = fs.FileSystem.from_uri(folder)
    where.create_dir(path, recursive=True)
    part = f"{path}/.{name}-{uuid.uuid4().hex}"
    with where.open_output_stream(part) as out:
        np.lib.format.write_array(out, np.ascontiguousarray(array), version=(1, 0))
    where.move(part, f"{path}/{name}.npy")


def _group_sums(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct sorted keys and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    cut = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[cut], *(np.add.reduceat(v[order], cut) if len(cut) else v[:0] for v in values)


def _tally(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def _add_up(folder: str, spread, shards: int):
    def run(table: pa.Table) -> pa.Table:
        s = table["shard"][0].as_py()
        b = np.repeat(_read(table["first"], "<u8"), _read(table["runs"], "<u4"))
        w, c = _read(table["second"], "<u8"), _read(table["n"], "<u4").astype(np.int64)
        g = pair(b, w)
        order = np.argsort(g)
        g = g[order]
        cut = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        g, b, w, c = g[cut], b[order][cut], w[order][cut], np.add.reduceat(c[order], cut)
        _write(folder, f"pair-{s}", g)
        _write(folder, f"count-{s}", np.minimum(c, 255).astype(np.uint8))
        big = c >= 255
        _write(folder, f"big-{s}", np.stack([g[big].view(np.int64), c[big]]))
        first, total, one, two, more = _group_sums(b, c, *((c == 1).astype(np.int64), (c == 2).astype(np.int64), (c > 2).astype(np.int64)))
        apart = spread.value[bucket(first)]
        sums = np.stack([total, one, two, more])
        _write(folder, f"first-{s}", first[~apart])
        _write(folder, f"totals-{s}", sums[:, ~apart])
        stats = np.array([*_tally(c), len(c), int(c.sum())], np.int64)
        w, n = np.unique(w, return_counts=True)
        u, sums = first[apart], sums[:, apart]
        to = _shard(u, shards)
        cuts, ends = (np.searchsorted(x, np.arange(shards + 1)) for x in (_shard(w, shards), to))
        rows = [(-1, stats.tobytes(), b"", b"", b"")]
        for t in np.flatnonzero(np.diff(cuts) + np.diff(ends)).tolist():
            x, y = slice(cuts[t], cuts[t + 1]), slice(ends[t], ends[t + 1])
            rows.append((t, _bytes(w[x], "<u8"), _bytes(n[x], "<u4"), _bytes(u[y], "<u8"), _bytes(sums[:, y].T, "<i8")))
        return pa.Table.from_batches([_table(**{name: ([r[i] for r in rows], pa.binary() if i else pa.int32()) for i, name in enumerate(("shard", "a", "b", "first", "sums"))})])

    return run


def _followers(folder: str):
    def run(table: pa.Table) -> pa.Table:
        s = table["shard"][0].as_py()
        if s < 0:  # six numbers of each shard
            row = (s, sum(np.frombuffer(x.as_py(), np.int64) for x in table["a"]).tobytes())
        else:
            w, n = _group_sums(_read(table["a"], "<u8"), _read(table["b"], "<u4").astype(np.int64))
            _write(folder, f"word-{s}", w)
            _write(folder, f"before-{s}", n)
            first, *sums = _group_sums(_read(table["first"], "<u8"), *_read(table["sums"], "<i8").reshape(-1, 4).T)
            if len(first):
                _write(folder, f"spread-{s}", first)
                _write(folder, f"spreadtotals-{s}", np.stack(sums))
            row = (s, np.array([*_tally(n), int((n > 2).sum()), len(n)], np.int64).tobytes())
        return pa.Table.from_batches([_table(shard=([row[0]], pa.int32()), a=([row[1]], pa.binary()))])

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """What is taken off a count of 0, 1, 2, and 3 or more."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    d = [0.0, 1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 0.5, 3 - 4 * y * n4 / n3 if n3 else 0.5]
    return np.array([0.0, *(min(max(x, 0.05), k) for k, x in enumerate(d[1:], 1))])


@dataclass
class LanguageModel:
    """Where a model's arrays are, and its sums: training tokens, distinct tokens, discounts, places of hashes whose words are spread."""

    folder: str
    shards: int
    tokens: int = 0
    distinct: int = 0
    texts: int = 0
    pair_discounts: np.ndarray = field(default_factory=lambda: np.zeros(4))
    word_discounts: np.ndarray = field(default_factory=lambda: np.zeros(4))
    pairs: int = 0
    left: float = 1.0
    spread: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, bool))

    def drop(self) -> None:
        where, path = fs.FileSystem.from_uri(self.folder)
        where.delete_dir(path)


def _uri(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"


def count(docs: DataFrame, text: str = "text") -> LanguageModel:
    """Count a model over all texts of a table."""
    spark = docs.sparkSession
    rows = docs.select(F.col(text).alias("text"))
    folder = _uri(new_folder(spark, "ngrams"))
    folder = folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else folder
    load = loads(rows)
    total = int(load.sum())
    shards = 1 << max(3, math.ceil(math.log2(max(1, total / SHARD_TOKENS))))
    model = LanguageModel(folder, shards)
    if not total:
        return model
    model.spread = load > max(total / (8 * shards), 4 * total / BUCKETS)
    spread = spark.sparkContext.broadcast(model.spread)
    counted = rows.mapInArrow(_count(spread, shards), "shard int, first binary, runs binary, second binary, n binary")
    added = counted.groupBy("shard").applyInArrow(_add_up(folder, spread, shards), "shard int, a binary, b binary, first binary, sums binary")
    got = added.groupBy("shard").applyInArrow(_followers(folder), "shard int, a binary").collect()
    tallies = np.zeros(6, np.int64)
    for r in got:
        s = np.frombuffer(r.a, np.int64)
        if r.shard < 0:
            model.pair_discounts, model.pairs, model.tokens = discounts(*s[:4].tolist()), int(s[4]), int(s[5])
        else:
            tallies += s
    spread.destroy()
    model.distinct = int(tallies[5])
    model.texts = int(Arrays(model).firsts(np.array([BEGIN]))[0][0])  # a text begins and ends once
    model.word_discounts = discounts(*tallies[:4].tolist())
    model.left = float(model.word_discounts[1:] @ np.array([tallies[0], tallies[1], tallies[4]])) / model.pairs
    return model


def _mapped(path: str) -> np.ndarray:
    with open(path, "rb") as file:
        np.lib.format.read_magic(file)
        shape, _, kind = np.lib.format.read_array_header_1_0(file)
        at = file.tell()
        data = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ, **_NO_HANDLE)
    return np.frombuffer(data, kind, math.prod(shape), at).reshape(shape)


class Arrays:
    """A model's arrays in a worker: mapped, or read where the store can't be mapped."""

    def __init__(self, model: LanguageModel):
        self.model, self.maps, self.bytes = model, OrderedDict(), 0
        self.where, self.path = fs.FileSystem.from_uri(model.folder)
        self.local = isinstance(self.where, fs.LocalFileSystem)

    def _map(self, name: str) -> np.ndarray | None:
        if name in self.maps:
            self.maps.move_to_end(name)
            return self.maps[name]
        path = f"{self.path}/{name}.npy"
        array = None
        if self.local:
            array = _mapped(path) if os.path.exists(path) else None
        elif self.where.get_file_info(path).type == fs.FileType.File:
            with self.where.open_input_stream(path) as file:
                array = np.lib.format.read_array(file)
            self.bytes += array.nbytes
        self.maps[name] = array
        while len(self.maps) > (MAPS if self.local else 1) and (self.local or self.bytes > KEPT_BYTES):
            _, old = self.maps.popitem(last=False)  # a map that nothing holds is closed
            self.bytes -= 0 if old is None or self.local else old.nbytes
        return array

    def _look(self, keys: np.ndarray, shard: np.ndarray, names: str, values: str, rows: int) -> np.ndarray:
        """Values of sorted keys, 0 where there are none."""
        out = np.zeros((rows, len(keys)), np.int64)
        for s in np.unique(shard).tolist():
            table = self._map(f"{names}-{s}")
            if table is None or not len(table):
                continue
            mine = np.flatnonzero(shard == s)
            at = np.minimum(np.searchsorted(table, keys[mine]), len(table) - 1)
            hit = table[at] == keys[mine]
            out[:, mine[hit]] = self._map(f"{values}-{s}").reshape(rows, -1)[:, at[hit]]
        return out

    def firsts(self, w: np.ndarray) -> np.ndarray:
        """Total, and number of followers seen once, twice and more often, of sorted first words."""
        out, shard, apart = np.zeros((4, len(w)), np.int64), _shard(w, self.model.shards), self.model.spread[bucket(w)]
        for own, names in ((~apart, ("first", "totals")), (apart, ("spread", "spreadtotals"))):
            out[:, own] = self._look(w[own], shard[own], *names, 4)
        return out

    def pairs(self, g: np.ndarray, before: np.ndarray) -> np.ndarray:
        shard = np.where(self.model.spread[bucket(before)], _shard(g, self.model.shards), _shard(before, self.model.shards))
        c = self._look(g, shard, "pair", "count", 1)[0]
        for i in np.flatnonzero(c == 255).tolist():
            big = self._map(f"big-{shard[i]}")
            at = int(np.searchsorted(big[0].view(np.uint64), g[i]))
            c[i] = big[1, at]
        return c

    def before(self, w: np.ndarray) -> np.ndarray:
        return self._look(w, _shard(w, self.model.shards), "word", "before", 1)[0]


def _score(model, text: str, names: list[str]):
    opened: list[Arrays] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: LanguageModel = model.value
        if not opened:
            opened.append(Arrays(m))
        arrays = opened[0]
        d, e = m.pair_discounts, m.word_discounts
        for batch in batches:
            texts, cols = batch.column(batch.schema.get_field_index(text)), [[], [], [], []]
            for lo, hi in blocks(texts, 1 << 20 if arrays.local else 1 << 23):
                now, before, first = tokens(texts.slice(lo, hi - lo))
                w, inv = np.unique(now, return_inverse=True)
                b, back = np.unique(before, return_inverse=True)
                total, one, two, more = arrays.firsts(b)
                seen = arrays.firsts(w)[0]
                seen[w == END] = m.texts
                follow = arrays.before(w)
                low = np.maximum(follow - e[np.minimum(follow, 3)], 0) / max(1, m.pairs) + m.left / (m.distinct + 1)
                g, at, same = np.unique(pair(before, now), return_index=True, return_inverse=True)
                c = arrays.pairs(g, before[at])[same]
                own = np.maximum(total, 1)
                rest = np.where(total > 0, (d[1] * one + d[2] * two + d[3] * more) / own, 1.0)
                p = np.maximum(c - d[np.minimum(c, 3)], 0) / own[back] + rest[back] * low[inv]
                base = np.log10((seen + 0.5) / (m.tokens + 0.5 * (m.distinct + 1)))[inv]
                for col, v in zip(cols, (np.diff(first), *(np.add.reduceat(x, first[:-1]) for x in ((seen > 0).astype(np.int64)[inv], base, np.log10(p)))), strict=True):
                    col.extend(v.tolist())
            made = [pa.array(c, pa.int64() if i < 2 else pa.float64()) for i, c in enumerate(cols)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, *names])

    return run


def score(docs: DataFrame, model: LanguageModel, text: str = "text", names: tuple[str, ...] = ("n_tokens", "n_known", "base_score", "score")) -> DataFrame:
    """Add the number of tokens, of known ones, the smoothed unigram score and the model's; all log10, summed over tokens."""
    docs = docs.drop(*set(names) - {text})
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), f"`{names[0]}` long, `{names[1]}` long, `{names[2]}` double, `{names[3]}` double"])
    return docs.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model), text, list(names)), schema)


def perplexity(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add the perplexity of each text under the model."""
    found = score(docs.select(F.struct(*(c for c in docs.columns if c != "perplexity")).alias("doc"), F.col(text).alias("text")), model)
    return found.select("doc.*", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
