"""Sets of word shingles with a Jaccard similarity of at least a threshold, joined exactly and without all pairs of a group.

1. Equal sets are one class, known by a 64-bit digest of the set (two different sets share one with a chance of 2**-64).
2. Shingles that are frequent in some part of the input are counted; the order of a set's shingles is by rarity, then hash. Any one order
   gives the same result; this one keeps shared passages out of prefixes.
3. Each class sends its prefix (the shingles of which a similar set must have one) to shards by shingle; a shingle counted often is dealt to
   several cells by class. A run is what one cell has of one shingle. Members stay in a run while the length filter, the positional filter and
   a parity sketch (two sets differ in at least as many shingles as their sketches in bits) leave them a partner.
4. In each run a member names one earlier member it may be similar to: of the NEAR before it the one with the nearest sketch, or else the first.
   (In a large group of near copies most pairs may be similar but aren't; without the nearest one most members would still be open.)
   Each class takes the one named most often, and the pair is verified on whole sets, which are made again from the texts for those classes alone that a bitmap of bounded size lets through.
5. What is still open is done in full. `earlier` wants one earlier similar class of each class, so only classes without one ask again, for all
   earlier partners. `links` wants classes connected: links make groups, pairs of groups name one pair each, and then the members of all but
   the largest group of a run ask for all partners in other groups. Those that ask go to every cell of a shingle, the others stay in theirs.
   In `links` that is a token-group matrix: a table of which groups have how many members, which sizes and which reach in each
   shingle's run; a member opens a group only if sizes and places allow the overlap. Pairs in a group are never made.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.scratch import Scratch, small
from tagloom.llm.wordhash import SPACE, blocks, flat, mix, shingles, words

FLUSH, BLOCK, SHARD_ENTRIES, FREQUENT, PIECE_BITS, SCAN, NEAR, HUB, LEAST_BITS, MOST_BITS, EDGES = 1 << 20, 1 << 19, 1 << 18, 1 << 19, 13, 2048, 1024, 2000, 1 << 20, 1 << 30, 1 << 20
_SHORT, _CLASS = np.uint64(0xE7037ED1A0B428DB), np.uint64(0x8EBC6AF09C88C6E3)


@dataclass
class Sets:
    """Sets of some items: hashes sorted within each item; at[i]:at[i + 1] are those of item i."""

    tok: np.ndarray
    at: np.ndarray
    digest: np.ndarray
    row: np.ndarray
    part: np.ndarray

    def item(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))

    def some(self, want: np.ndarray) -> Sets:
        n = np.diff(self.at)
        return Sets(self.tok[np.repeat(want, n)], np.concatenate([[0], np.cumsum(n[want])]), self.digest[want], self.row[want], self.part[want])

    def sketches(self, longs: int) -> np.ndarray:
        """For each item 64 * longs bits: whether an odd number of its shingles has that bit as its place."""
        bits, out = 64 * longs, []
        for lo in range(0, len(self.at) - 1, 4096):
            hi = min(lo + 4096, len(self.at) - 1)
            tok = self.tok[self.at[lo] : self.at[hi]]
            of = np.repeat(np.arange(hi - lo), np.diff(self.at[lo : hi + 1]))
            odd = np.bincount(of * bits + (mix(tok ^ _SHORT) % np.uint64(bits)).astype(np.int64), minlength=(hi - lo) * bits) & 1
            out.append(np.packbits(odd.astype(bool).reshape(hi - lo, bits), axis=1).view(np.int64))
        return np.concatenate(out) if out else np.zeros((0, longs), np.int64)


def sets_of(texts: pa.Array, size: int, by_line: bool, least_words: int = 1) -> Sets:
    """Distinct shingles (48 bits of their hashes) of each text, or of each line with words; with fewer words, all as one; none below least_words."""
    data, offsets = flat(texts)
    w = words(data, offsets, SPACE)
    if by_line:
        breaks, doc = np.flatnonzero(data == 10), w.doc()
        before = np.cumsum(np.bincount(np.searchsorted(w.start, breaks), minlength=len(doc) + 1))[: len(doc)]
        line = before - np.searchsorted(breaks, offsets[:-1])[doc] if len(doc) else doc
        cut = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (line[1:] != line[:-1])])) if len(doc) else np.zeros(0, np.int64)
        first, row, part = np.append(cut, len(doc)), doc[cut], line[cut]
    else:
        first, row = w.first, np.arange(len(texts))
        part = np.zeros(len(texts), np.int64)
    n = np.diff(first)
    end = np.repeat(first[1:], n)
    h = shingles(w.hash, size)
    full = np.flatnonzero(np.arange(len(h)) + size <= end[: len(h)])
    item = np.repeat(np.arange(len(n)), n)
    few = np.flatnonzero((n >= least_words) & (n < size))
    short = np.zeros(len(few), np.uint64)
    for k in range(1, size):
        own = n[few] == k
        if own.any():
            short[own] = mix(shingles(w.hash, k)[first[few[own]]] + np.full(1, k, np.uint64) * _SHORT)
    tok, of = np.concatenate([h[full], short]) >> np.uint64(16), np.concatenate([item[full], few])
    parts = []
    for lo in range(0, max(1, len(n)), 1 << 16):  # one sort of item and hash together
        own = slice(None) if len(n) <= 1 << 16 else (of >= lo) & (of < lo + (1 << 16))
        both = np.sort((of[own] - lo).astype(np.uint64) << np.uint64(48) | tok[own])
        both = both[np.concatenate([[True], both[1:] != both[:-1]])] if len(both) else both
        parts.append((both & np.uint64((1 << 48) - 1), (both >> np.uint64(48)).astype(np.int64) + lo))
    tok, of = (np.concatenate(x) for x in zip(*parts, strict=True))
    at = np.searchsorted(of, np.arange(len(n) + 1))
    sums = np.zeros(len(tok) + 1, np.uint64)
    np.cumsum(mix(tok ^ _CLASS), out=sums[1:])
    return Sets(tok, at, mix(sums[at[1:]] - sums[at[:-1]] + np.diff(at).astype(np.uint64) * _SHORT), row, part)


class Seen:
    """Digests that a task has met, up to a bounded number, to leave out most repeats; those it lets through are sorted out by a shuffle."""

    def __init__(self, most: int = FLUSH >> 2):
        self.most, self.known, self.fresh = most, np.zeros(0, np.uint64), []

    def new(self, digest: np.ndarray) -> np.ndarray:
        mask = np.zeros(len(digest), bool)
        mask[np.unique(digest, return_index=True)[1]] = True
        if len(self.known):
            mask &= self.known[np.minimum(np.searchsorted(self.known, digest), len(self.known) - 1)] != digest
        if len(self.known) < self.most:
            self.fresh.append(digest[mask])
            if sum(map(len, self.fresh)) > self.most >> 3:
                self.known = np.unique(np.concatenate([self.known, *self.fresh]))
                self.fresh.clear()
        return mask


def _each(batches: Iterator[pa.RecordBatch], size: int, by_line: bool, text: int = 0, least_words: int = 1) -> Iterator[tuple[pa.RecordBatch, Sets]]:
    for batch in batches:
        for lo, hi in blocks(batch.column(text), BLOCK):
            part = batch.slice(lo, hi - lo)
            yield part, sets_of(part.column(text), size, by_line, least_words)


def _planes(x: np.ndarray, kind: str) -> bytes:
    """An array's bytes, first those of one place of all numbers, then of the next: high places that are zero shrink to nothing when compressed."""
    x = np.ascontiguousarray(x.astype(kind))
    return x.view(np.uint8).reshape(len(x), -1).T.tobytes()


def _unplaned(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    wide = np.dtype(kind).itemsize
    return np.concatenate([np.ascontiguousarray(np.frombuffer(x.as_py(), np.uint8).reshape(wide, -1).T).view(kind).ravel() for x in column])


def _table(names: str, *columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names.split())


def _int64(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64) if a.dtype == np.uint64 else a.astype(np.int64))


@dataclass(frozen=True)
class SetJoin:
    """What counts as an item, and when two are similar: 100 * intersection >= percent * union. Items with fewer than least_words
    words have an empty set, which is similar to none."""

    size: int
    percent: int
    by_line: bool = False
    least_words: int = 1

    @property
    def longs(self) -> int:
        """Length of a sketch: lines are short."""
        return 1 if self.by_line else 4

    @property
    def wide(self) -> int:
        """Length of the sketches that pairs are tried on before whole sets; they tell sets of some thousand shingles apart."""
        return 1 if self.by_line else 64

    @property
    def sketch(self) -> list[str]:
        return [f"s{i}" for i in range(self.longs)]

    def least(self, n):
        """Shingles that a set of n must share with any similar one."""
        return -(-self.percent * n // 100)

    def overlap(self, n, m):
        """Shingles that similar sets of n and m share at least."""
        return -(-self.percent * (n + m) // (100 + self.percent))

    def scan(self, docs: DataFrame, keys: list[str], text: str, scratch: Scratch) -> DataFrame:
        """One reading of the texts, saved: a row for each item (keys, part: line number or 0, n: size, digest, sketch), and rows (tok, n) of
        shingles that come more than once among a task's last million or two, with tok null for the number of all."""
        kinds = [docs.schema[k].dataType.simpleString() for k in keys]
        names = [f"k{i}" for i in range(len(keys))] + ["part", "n", "digest", *self.sketch, "tok", "often"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[np.ndarray] = []
            seen = Seen()
            types: list[pa.DataType] = []

            def flush() -> pa.RecordBatch:
                tok = np.concatenate(held)
                total = len(tok)
                held.clear()
                tok.sort()
                again = np.zeros(total + 1, bool)
                np.equal(tok[1:], tok[:-1], out=again[1:-1])
                first = np.flatnonzero(again[1:] & ~again[:-1])
                c = np.flatnonzero(again[:-1] & ~again[1:]) - first + 1
                tok = pa.array(np.append(np.uint64(0), tok[first]).view(np.int64), mask=np.arange(len(first) + 1) == 0)
                none = [pa.nulls(len(tok), t) for t in (*types, pa.int64())]
                return pa.RecordBatch.from_arrays([*none, pa.array(np.append(total, c)), *[pa.nulls(len(tok), pa.int64())] * (1 + self.longs), tok, pa.array([True] * len(tok))], names)

            for part, s in _each(batches, self.size, self.by_line, len(keys), self.least_words):
                types = [part.column(i).type for i in range(len(keys))]
                n = np.diff(s.at)
                at = pa.array(s.row.astype(np.int64))
                yield pa.RecordBatch.from_arrays([*(part.column(i).take(at) for i in range(len(keys))), _int64(s.part), _int64(n), _int64(s.digest), *map(pa.array, s.sketches(self.longs).T), pa.nulls(len(n), pa.int64()), pa.array(np.zeros(len(n), bool))], names)
                new = seen.new(s.digest)
                held.append(s.tok[np.repeat(new, n)])
                if sum(map(len, held)) > 2 * FLUSH:
                    yield flush()
            if held:
                yield flush()

        longs = ", ".join(f"{c} long" for c in self.sketch)
        schema = ", ".join([*(f"k{i} {k}" for i, k in enumerate(kinds)), f"part long, n long, digest long, {longs}, tok long, often boolean"])
        return scratch.save(docs.select(*keys, text).mapInArrow(run, schema), "scan")

    def items(self, scan: DataFrame) -> DataFrame:
        return scan.filter("NOT often").drop("tok", "often")

    def frequent(self, scan: DataFrame, scratch: Scratch) -> tuple[np.ndarray, np.ndarray, int]:
        """At most FREQUENT of the most frequent shingles, sorted, with the power of two of their counts; and the number of all."""
        counts = scratch.save(scan.filter("often").groupBy("tok").agg(F.sum("n").alias("n")), "frequent")
        total = counts.filter("tok IS NULL").agg(F.sum("n")).first()[0] or 0
        powers = counts.filter("tok IS NOT NULL").groupBy(F.length(F.bin("n")).alias("p")).count().orderBy(F.desc("p")).collect()
        least, room = 64, FREQUENT
        for r in powers:
            if (room := room - r["count"]) < 0:
                break
            least = r.p
        got = counts.filter((F.col("tok").isNotNull()) & (F.length(F.bin("n")) >= least)).select("tok", F.length(F.bin("n")).cast("int").alias("p")).toPandas()
        tok, p = got.tok.to_numpy(np.int64).view(np.uint64), got.p.to_numpy(np.uint8)
        scratch.drop(counts)
        order = np.argsort(tok)
        return tok[order], p[order], int(total)

    def _prefixes(self, frequent, shards: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, powers = frequent.value
            marked = np.zeros(1 << 22, bool)
            marked[(known & np.uint64(len(marked) - 1)).astype(np.int64)] = True
            seen = Seen()
            held: list[tuple] = []
            count = 0

            def flush() -> pa.RecordBatch:
                tok, digest, n, pos, power = (np.concatenate(x) for x in zip(*held, strict=True))
                held.clear()
                spread = np.where(power > PIECE_BITS, mix(tok ^ mix(piece_of(tok, digest, power))), tok)
                shard = (mix(spread) % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard.astype(np.uint16) if shards <= 1 << 16 else shard, kind="stable")
                own = shard[order]
                cuts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1], [True]])).tolist()
                rows = [(int(own[lo]), *(_planes(x[order[lo:hi]], t) for x, t in ((tok, "<u8"), (digest, "<u8"), (n, "<u4"), (pos, "<u4"), (power, "u1")))) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
                cols = list(zip(*rows, strict=True))
                return _table("shard tok digest n pos power", pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:]))

            for _, s in _each(batches, self.size, self.by_line, 0, self.least_words):
                s = s.some(seen.new(s.digest))
                n = np.diff(s.at)
                item = s.item()
                power = np.zeros(len(s.tok), np.uint8)
                order = np.arange(len(s.tok))
                maybe = np.flatnonzero(marked[(s.tok & np.uint64(len(marked) - 1)).astype(np.int64)]) if len(known) else order[:0]
                if len(maybe):
                    at = np.minimum(np.searchsorted(known, s.tok[maybe]), len(known) - 1)
                    hit = known[at] == s.tok[maybe]
                    power[maybe[hit]] = powers[at[hit]]
                    touched = np.zeros(len(n), bool)
                    touched[item[maybe[hit]]] = True
                    own = np.flatnonzero(touched[item])
                    rank = np.sort((item[own] << 6 | power[own]).astype(np.uint64) << np.uint64(32) | own.astype(np.uint64))  # by rarity, then hash
                    order[own] = (rank & np.uint64((1 << 32) - 1)).astype(np.int64)
                size = np.where(n > 0, n - self.least(n) + 1, 0)
                of, pos = np.repeat(np.arange(len(n)), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                if len(pos):
                    at = order[s.at[of] + pos]
                    held.append((s.tok[at], s.digest[of], n[of].astype(np.uint32), pos.astype(np.uint32), power[at]))
                    count += len(pos)
                if count >= FLUSH >> 1:
                    yield flush()
                    count = 0
            if held:
                yield flush()

        return run

    def _fits(self, n, pos, m, other):
        """Length and positional filter: the pair's first shared shingle may be this one."""
        need = self.overlap(n, m)
        return (np.minimum(n, m) >= self.least(np.maximum(n, m))) & (np.minimum(n - pos, m - other) >= need)

    def _reaches(self, n, x, m, y):
        """The sketches' bound: pairs whose sets may share enough."""
        return n + m - np.bitwise_count(x ^ y).sum(1, dtype=np.int64) >= 2 * self.overlap(n, m)

    def fits(self, x: str, y: str) -> Column:
        """Both filters as a condition on two entries, x and y being the prefixes of their columns."""
        n, m = F.col(f"{x}n"), F.col(f"{y}n")
        need = F.expr(f"({self.percent} * ({x}n + {y}n) + {99 + self.percent}) div {100 + self.percent}")
        apart = reduce(Column.__add__, [F.bit_count(F.col(f"{x}{c}").bitwiseXOR(F.col(f"{y}{c}"))) for c in self.sketch])
        return (100 * F.least(n, m) >= self.percent * F.greatest(n, m)) & (F.least(n - F.col(f"{x}pos"), m - F.col(f"{y}pos")) >= need) & (n + m - apart >= 2 * need)

    def _runs(self, table: pa.Table) -> pa.Table:
        """The members of runs that have a partner left by length and position."""
        tok, digest, n, pos, power = (_unplaned(table[c], t) for c, t in (("tok", "<u8"), ("digest", "<u8"), ("n", "<u4"), ("pos", "<u4"), ("power", "u1")))
        piece = piece_of(tok, digest, power)
        order = np.lexsort((digest, piece, tok))
        tok, digest, n, pos, power, piece = tok[order], digest[order], n[order].astype(np.int64), pos[order].astype(np.int64), power[order], piece[order]
        new = np.ones(len(tok), bool)
        new[1:] = (tok[1:] != tok[:-1]) | (digest[1:] != digest[:-1])
        tok, digest, n, pos, power, piece = (x[new] for x in (tok, digest, n, pos, power, piece))
        cut = np.flatnonzero(np.concatenate([[True], (tok[1:] != tok[:-1]) | (piece[1:] != piece[:-1]), [True]]))
        size = np.diff(cut)
        keep = np.repeat(size > SCAN, size) | (power > PIECE_BITS)  # looking for partners would cost more here, or they lie in other pieces
        two = cut[:-1][size == 2]
        fit = self._fits(n[two], pos[two], n[two + 1], pos[two + 1])
        keep[two[fit]] = keep[two[fit] + 1] = True
        some = (size > 2) & (size <= SCAN)
        for a, k in zip(cut[:-1][some].tolist(), size[some].tolist(), strict=True):
            x = slice(a, a + k)
            for lo in range(a, a + k, 128):
                y = slice(lo, min(lo + 128, a + k))
                f = self._fits(n[y, None], pos[y, None], n[None, x], pos[None, x])
                f[np.arange(y.stop - lo), np.arange(lo - a, y.stop - a)] = False
                keep[y] |= f.any(1)
        pieces = np.left_shift(1, np.maximum(power.astype(np.int64) - PIECE_BITS, 0))
        return pa.Table.from_batches([_table("tok piece pieces digest pos", *(_int64(x[keep]) for x in (tok, piece, pieces, digest, pos)))])

    def _choose(self, order: list[str]):
        """Members of runs that have a partner left by their sketches too, and one earlier partner of each."""

        def run(table: pa.Table) -> pa.Table:
            table = table.sort_by([(c, "ascending") for c in ("tok", "piece", *order, "digest")])
            tok, piece, pieces, digest, n, pos = (table[c].to_numpy() for c in ("tok", "piece", "pieces", "digest", "n", "pos"))
            sketch = np.stack([table[c].to_numpy().view(np.uint64) for c in self.sketch], 1)
            new = np.concatenate([[True], (tok[1:] != tok[:-1]) | (piece[1:] != piece[:-1])])
            start = np.maximum.accumulate(np.where(new, np.arange(len(tok)), 0))
            end = np.append(np.flatnonzero(new), len(tok))[np.cumsum(new)]
            best, keep = np.full(len(tok), -1), pieces > 1

            def may(x, y):
                ok = self._fits(n[x], pos[x], n[y], pos[y])
                ok[ok] = self._reaches(n[x[ok]], sketch[x[ok]], n[y[ok]], sketch[y[ok]])
                return ok

            place, share = np.arange(len(tok)) - start, np.zeros(len(tok))
            at, step = np.flatnonzero(place >= 1), 1
            while len(at) and step <= NEAR:  # the nearest of those just before
                x = at[self._fits(n[at], pos[at], n[at - step], pos[at - step])]
                y = x - step
                both = n[x] + n[y]
                common = both - np.bitwise_count(sketch[x] ^ sketch[y]).sum(1, dtype=np.int64)
                nearer = (common >= 2 * self.overlap(n[x], n[y])) & (common > share[x] * both)
                best[x[nearer]], share[x[nearer]] = y[nearer], (common / both)[nearer]
                step += 1
                at = at[place[at] >= step]
            at, step = np.flatnonzero((place > NEAR) & (best < 0)), 0
            while len(at):  # or the first
                hit = may(at, start[at] + step)
                best[at[hit]] = start[at[hit]] + step
                step += 1
                at = at[~hit]
                at = at[start[at] + step < at]
            keep[best >= 0] = True
            keep[best[best >= 0]] = True
            at, step = np.flatnonzero(~keep & (np.arange(len(tok)) + 1 < end)), 1
            while len(at):  # those named by none look at later ones
                hit = may(at, at + step)
                keep[at[hit]] = True
                step += 1
                at = at[~hit]
                at = at[at + step < end[at]]
            named = pa.array(digest[best[keep]], mask=best[keep] < 0)
            return table.filter(pa.array(keep)).append_column("named", named)

        return run

    def _whole(self, bitmap):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits, seen = np.frombuffer(bitmap.value, np.uint8), Seen()
            for _, s in _each(batches, self.size, self.by_line, 0, self.least_words):
                place = (s.digest % np.uint64(len(bits) * 8)).astype(np.int64)
                want = ((bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 > 0) & (np.diff(s.at) > 0)
                few = s.some(want)
                few = few.some(seen.new(few.digest))
                wide = few.sketches(self.wide)
                yield _table("digest wide toks", _int64(few.digest), pa.array([x.tobytes() for x in wide], pa.binary()), pa.array([few.tok[a:b].tobytes() for a, b in zip(few.at[:-1].tolist(), few.at[1:].tolist(), strict=True)], pa.binary()))

        return run

    def _verify(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = (np.frombuffer(v.as_py(), "<u8") for v in (x, y))
                both = len(np.intersect1d(p, q, assume_unique=True))
                ok.append(100 * both >= self.percent * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    def _near(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u8").reshape(-1, self.wide) for i in (4, 5))
            n, m = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(self._reaches(n, x, m, y)))

    def _joined(self, pairs: DataFrame, sets: DataFrame, column: Column, scratch: Scratch) -> DataFrame:
        """Pairs with a column of sets of both, x and y. The set of an a with many partners is dealt out in several copies."""
        hubs = scratch.save(pairs.groupBy("a").count().filter(F.col("count") > HUB).select("a", F.ceil(F.col("count") / HUB).cast("int").alias("salts")), "hubs")
        few = small(hubs, 100_000)
        ends = pairs.select(F.col("a").alias("digest")).union(pairs.select("b")).distinct()
        held = sets.select("digest", column.alias("x")).join(small(scratch.save(ends, "ends"), 1_000_000), "digest", "left_semi")
        x = held.withColumnRenamed("digest", "a").join(few, "a", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
        y = held.toDF("b", "y")
        salted = pairs.join(few, "a", "left").withColumn("salt", F.pmod(F.xxhash64("b"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
        return y.join(F.broadcast(salted) if pairs.limit(1_000_001).count() <= 1_000_000 else salted, "b").join(x, ["a", "salt"])

    def _verified(self, pairs: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
        """Pairs (a, b) that are similar, saved: first by wide sketches, then by whole sets."""
        pairs = near = scratch.save(pairs.select("a", "b"), "pairs")
        if self.wide > self.longs:
            both = self._joined(pairs, sets, F.struct("n", "wide"), scratch)
            near = scratch.save(both.select("a", "b", "x.n", F.col("y.n").alias("m"), "x.wide", F.col("y.wide").alias("other")).mapInArrow(self._near, "a long, b long"), "near")
        both = self._joined(near, sets, F.col("toks"), scratch)
        found = scratch.save(both.select("a", "b", "x", "y").mapInArrow(self._verify, "a long, b long"), "verified")
        scratch.drop(pairs, near)
        return found

    def _entries(self, texts: DataFrame, scan: DataFrame, classes: DataFrame, order: list[str], scratch: Scratch) -> tuple[DataFrame, DataFrame]:
        """Entries of all runs (tok, piece, pieces, digest, pos, named and the columns of classes), and the whole sets of their classes."""
        spark = texts.sparkSession
        known, powers, total = self.frequent(scan, scratch)
        shards = max(8, total * (100 - self.percent) // 100 // SHARD_ENTRIES + 1)
        ranks = spark.sparkContext.broadcast((known, powers))
        prefixes = texts.mapInArrow(self._prefixes(ranks, int(min(shards, 1 << 30))), "shard int, tok binary, digest binary, n binary, pos binary, power binary")
        runs = prefixes.groupBy("shard").applyInArrow(lambda t: self._runs(t), "tok long, piece long, pieces long, digest long, pos long")
        scratch.tidy()
        full = runs.join(classes, "digest").withColumn("cell", F.pmod(F.xxhash64("tok", "piece"), F.lit(shards)))
        entries = scratch.save(full.groupBy("cell").applyInArrow(self._choose(order), full.withColumn("named", F.lit(None).cast("long")).schema), "entries")
        bitmap = spark.sparkContext.broadcast(bitmap_of(entries.select("digest")))
        own = texts.mapInArrow(self._whole(bitmap), "digest long, wide binary, toks binary").withColumn("n", F.expr("length(toks) div 8"))
        sets = scratch.save(own.join(entries.select("digest").distinct(), "digest", "left_semi").dropDuplicates(["digest"]), "sets")
        for sent in (ranks, bitmap):
            sent.destroy()
        scratch.tidy()
        return entries, sets

    def _named(self, entries: DataFrame) -> DataFrame:
        """For each class b the earlier one named most often, a."""
        votes = entries.filter("named IS NOT NULL").groupBy(F.col("digest").alias("b"), F.col("named").alias("a")).count()
        return votes.groupBy("b").agg(F.max_by("a", F.struct("count", "a")).alias("a"))

    def _may(self, pairs: DataFrame) -> DataFrame:
        """Of pairs with a row for each shared shingle (xn, yn, xpos, ypos), those that what they share and what is left after its last place allow."""
        bound = pairs.groupBy("a", "b", "xn", "yn").agg(F.count("*").alias("c"), F.max("xpos").alias("px"), F.max("ypos").alias("py"))
        need = F.expr(f"({self.percent} * (xn + yn) + {99 + self.percent}) div {100 + self.percent}")
        return bound.filter(F.col("c") + F.least(F.col("xn") - F.col("px"), F.col("yn") - F.col("py")) - 1 >= need)

    def _side(self, entries: DataFrame, name: str, *more: str) -> DataFrame:
        return entries.select("tok", "piece", *(F.col(c).alias(f"{name}{c}") for c in ("digest", "n", "pos", *self.sketch, *more)))

    def earlier(self, texts: DataFrame, scan: DataFrame, classes: DataFrame, order: list[str], scratch: Scratch) -> DataFrame:
        """digest of each class that has a similar one before it in the order of some columns. classes: digest, n, sketch and these columns."""
        entries, sets = self._entries(texts, scan, classes, order, scratch)
        first = self._verified(self._named(entries), sets, scratch)
        asks = entries.join(first.select(F.col("b").alias("digest")), "digest", "left_anti").withColumn("piece", F.explode(F.expr("sequence(0L, pieces - 1)")))
        before = F.struct(*(f"x{c}" for c in order)) < F.struct(*(f"y{c}" for c in order))
        pairs = self._side(entries, "x", *order).join(self._side(asks, "y", *order), ["tok", "piece"]).filter(before & self.fits("x", "y"))
        rest = self._verified(self._may(pairs.withColumnsRenamed({"xdigest": "a", "ydigest": "b"})), sets, scratch)
        scratch.drop(entries, sets)
        return first.select("b").union(rest.select("b")).distinct().toDF("digest")

    def links(self, texts: DataFrame, scan: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
        """node, grp: the group of each class that is similar to another, directly or through others. classes: digest, n, sketch."""
        entries, sets = self._entries(texts, scan, classes, ["digest"], scratch)
        found = self._verified(self._named(entries), sets, scratch)
        for last in (False, True):
            groups = components(found, scratch)
            sizes = groups.groupBy("grp").agg(F.count("*").alias("members"))
            grouped = scratch.save(entries.join(groups.withColumnRenamed("node", "digest"), "digest", "left").withColumn("grp", F.coalesce("grp", "digest")).join(sizes, "grp", "left").withColumn("members", F.coalesce("members", F.lit(1))), "grouped")
            scratch.drop(groups)
            pairs = self._opened(grouped) if last else self._between(grouped)
            more = self._verified(pairs, sets, scratch)
            scratch.drop(grouped)
            found = found.union(more)
        scratch.drop(entries, sets)
        return components(found, scratch)

    def matrix(self, grouped: DataFrame) -> DataFrame:
        """The token-group matrix: for each shingle and group (in which some other group has the shingle too) how many members have it, their
        sizes and reach, and the first of them; a row for each piece of the shingle's run."""
        row = F.struct(*(F.col(c).alias(f"x{c}") for c in ("digest", "n", "pos", *self.sketch)))
        cells = grouped.groupBy("tok", "grp", "members").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max(F.col("n") - F.col("pos")).alias("reach"), F.min(row).alias("one"), F.max("pieces").alias("pieces"))
        shared = cells.groupBy("tok").agg(F.count("*").alias("k")).filter("k > 1").select("tok")
        return cells.join(shared, "tok", "left_semi").select("tok", F.col("grp").alias("xgrp"), F.col("members").alias("xmembers"), "low", "high", "reach", "one.*", F.explode(F.expr("sequence(0L, pieces - 1)")).alias("piece"))

    def _queries(self, grouped: DataFrame) -> DataFrame:
        """Members of runs with each larger group in the run; of two groups of one size the one with the smaller id asks."""
        asks = self._side(grouped, "y", "grp", "members")
        return self.matrix(grouped).join(asks, ["tok", "piece"]).filter(F.struct("ymembers", "ygrp") < F.struct("xmembers", "xgrp"))

    def _between(self, grouped: DataFrame) -> DataFrame:
        """One pair for each two groups that may be similar: the one named in most runs."""
        votes = self._queries(grouped).filter(self.fits("x", "y")).groupBy("xgrp", "ygrp", F.col("xdigest").alias("a"), F.col("ydigest").alias("b")).count()
        return votes.groupBy("xgrp", "ygrp").agg(F.max_by(F.struct("a", "b"), F.struct("count", "a", "b")).alias("p")).select("p.*")

    def _opened(self, grouped: DataFrame) -> DataFrame:
        """Pairs of members of different groups that may be similar, from the groups that a member opens by their sizes and reach."""
        need = F.ceil((self.percent * (F.col("yn") + F.greatest("low", F.expr(f"({self.percent} * yn + 99) div 100")))) / F.lit(100 + self.percent) - 1e-9)
        sizes = (100 * F.col("high") >= self.percent * F.col("yn")) & (100 * F.col("yn") >= self.percent * F.col("low"))
        opens = self._queries(grouped).filter(sizes & (F.least(F.col("yn") - F.col("ypos"), "reach") >= need)).select("ydigest", "xgrp").distinct()
        asks = self._side(grouped.withColumn("piece", F.explode(F.expr("sequence(0L, pieces - 1)"))), "y").join(opens, "ydigest")
        pairs = self._side(grouped, "x", "grp").join(asks, ["tok", "piece", "xgrp"]).filter(self.fits("x", "y"))
        return self._may(pairs.withColumnsRenamed({"xdigest": "a", "ydigest": "b"}))


def piece_of(tok: np.ndarray, digest: np.ndarray, power: np.ndarray) -> np.ndarray:
    """The piece of a frequent shingle's run in which a class lies; pieces hold some thousands."""
    bits = np.maximum(power.astype(np.int64) - PIECE_BITS, 0).astype(np.uint64)
    return (mix(tok ^ mix(digest)) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.uint64)


def bitmap_of(digests: DataFrame) -> bytes:
    """A bitmap with the place of each digest, of some bits a digest and at most MOST_BITS; gathered in slices on the executors. What it lets
    through by chance is sorted out by a join."""
    size = 1 << max(1, 16 * digests.count()).bit_length()
    size, slices = min(max(size, LEAST_BITS), MOST_BITS), 64
    wide = size // slices

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = [np.zeros(0, np.int64)]
        for batch in batches:
            places.append((batch.column(0).to_numpy().view(np.uint64) % np.uint64(size)).astype(np.int64))
        place = np.unique(np.concatenate(places))
        cuts = np.searchsorted(place, np.arange(slices + 1) * wide)
        for i in np.flatnonzero(np.diff(cuts)).tolist():
            bits = np.zeros(wide, bool)
            bits[place[cuts[i] : cuts[i + 1]] - i * wide] = True
            yield _table("part bits", pa.array([i], pa.int32()), pa.array([np.packbits(bits).tobytes()], pa.binary()))

    def either(table: pa.Table) -> pa.Table:
        bits = np.bitwise_or.reduce([np.frombuffer(x.as_py(), np.uint8) for x in table["bits"]])
        return pa.Table.from_batches([_table("part bits", table["part"].combine_chunks().slice(0, 1), pa.array([bits.tobytes()], pa.binary()))])

    got = digests.mapInArrow(mark, "part int, bits binary").groupBy("part").applyInArrow(either, "part int, bits binary").collect()
    whole = bytearray(size // 8)
    for r in got:
        whole[r.part * wide // 8 : (r.part + 1) * wide // 8] = r.bits
    return bytes(whole)


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of some millions of edges (u, v) at a time, stars with the same components: u the smallest node."""
    held: list[tuple] = []

    def flush() -> pa.RecordBatch:
        node, place = np.unique(np.concatenate([x for pair in held for x in pair]), return_inverse=True)
        cut = np.cumsum([len(x) for pair in held for x in pair])
        ends = np.split(place, cut[:-1])
        u, v, label, before = np.concatenate(ends[::2]), np.concatenate(ends[1::2]), np.arange(len(node)), None
        held.clear()
        while before is None or (before != label).any():
            before = label.copy()
            least = np.minimum(label[u], label[v])
            for x in (u, v):
                np.minimum.at(label, label[x], least)
                np.minimum.at(label, x, least)
            label = label[label]
        at = np.flatnonzero(label != np.arange(len(node)))
        return _table("u v", pa.array(node[label[at]]), pa.array(node[at]))

    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        if sum(len(x) for x, _ in held) > 1 << 22:
            yield flush()
    if held:
        yield flush()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """node, grp: the smallest node reachable by links (a, b), saved. Each task makes stars of some EDGES links, so one does all of no more than
    these at once; else the stars of neighbours are joined, larger ones then smaller ones, until one task can hold them or nothing changes."""

    def stars(edges: DataFrame) -> tuple[DataFrame, int]:
        held = scratch.save(edges, "edges")
        tasks = held.count() // EDGES + 1
        made = held.coalesce(tasks).mapInArrow(_contract, "u long, v long")
        made = scratch.save(made.distinct() if tasks > 1 else made, "edges")
        scratch.drop(held)
        return made, tasks

    def mark(edges: DataFrame):
        return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()

    edges, tasks = stars(links.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).filter("u <> v"))
    now = mark(edges) if tasks > 1 else None
    while tasks > 1:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("m").alias("u"), "v").filter("u <> v").distinct()
        down = large.groupBy("v").agg(F.min("u").alias("m"))
        less = large.join(down, "v").select(F.col("m").alias("u"), F.explode(F.array("u", "v")).alias("v")).filter("u <> v").distinct()
        new, tasks = stars(less)
        scratch.drop(edges)
        edges, before = new, now
        now = mark(edges) if tasks > 1 else None
        if now == before:
            break
    return edges.select(F.col("v").alias("node"), F.col("u").alias("grp")).union(edges.select("u", "u").distinct())
