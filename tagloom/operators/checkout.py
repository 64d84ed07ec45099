"""Sample barcodes: which sample a read pair belongs to, its tag, trimming, orientation and merging of overlapping mates.

A run has as many barcodes as samples, so the list goes to all tasks, and a task works on whole Arrow batches of pairs in numpy. Seeds are searched bit-parallel:
a machine word a barcode holds which of its beginnings end at the current base, and each base moves the words of all reads and barcodes by one shift and mask. Starts found
are held against the limits of low- and high-quality mismatches, all of a barcode together. Tags, cuts and strands are index arithmetic on the batch's bytes.
Mates are merged by matching the second mate's first bases with every place of the first, for all pairs at once. Every barcode start is tried, qualities are those of the
matched bases. All counting is DataFrame work."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.sequence import IUPAC, iupac_complement
from tagloom.operators.profiles import flat_bytes

_CODE = np.full(256, 4, np.uint8)
_CODE[list(b"ATGC")] = range(4)
_OTHER = np.full(256, ord("N"), np.uint8)
_OTHER[list(b"ATGC")] = list(b"TACG")
_ROWS = 4096


@dataclass
class Barcode:
    """A compiled barcode: upper-case codes are seed, lower-case ones fuzzy, N is a place of the tag."""

    sample: str
    master: str
    slave: str | None = None

    def __post_init__(self) -> None:
        if not set(self.master.upper()) <= set(IUPAC):
            raise ValueError(f"not an IUPAC barcode: {self.master}")
        if self.slave and not set(self.slave.upper()) <= set(IUPAC):
            self.slave = None  # a slave that can't be read is skipped


@dataclass
class Limits:
    """Mismatches of fuzzy bases: qualities up to `low` are low ones; shares of a barcode's length that may mismatch with low and with high quality."""

    low: int = 15
    low_share: float = 0.2
    high_share: float = 0.05


@dataclass
class Merging:
    """Sizes of the search for overlaps: how far into the second mate its seed may begin, the seed, the stretch behind it that is compared (partial: which an end may cut short)."""

    most_offset: int = 5
    seed: int = 5
    match: int = 10
    partial: bool = False


@dataclass
class Reads:
    """Reads of a batch in flat arrays of bases and qualities: where each begins, and its length."""

    seq: np.ndarray
    qual: np.ndarray
    start: np.ndarray
    size: np.ndarray
    _codes: np.ndarray | None = field(default=None, repr=False)

    @classmethod
    def of(cls, seqs: list[str | None] | pa.Array, quals: list[str | None] | pa.Array) -> Reads:
        """A missing quality counts as zero. Columns of ASCII with whole qualities are taken as they lie in Arrow's buffers."""
        if isinstance(seqs, pa.Array):
            (seq, size), (qual, held) = flat_bytes(seqs), flat_bytes(quals)
            if np.array_equal(size, held) and not (seq & 128).any() and not (qual & 128).any():
                return cls(seq, qual, np.cumsum(size) - size, size)
            seqs, quals = seqs.to_pylist(), quals.to_pylist()
        seqs = [x or "" for x in seqs]
        size = np.fromiter(map(len, seqs), np.int64, len(seqs))
        quals = [q if q is not None and len(q) == n else ((q or "") + "!" * n)[:n] for q, n in zip(quals, size.tolist(), strict=True)]
        flat = lambda x: np.frombuffer("".join(x).encode("latin-1", "replace"), np.uint8)
        return cls(flat(seqs), flat(quals), np.cumsum(size) - size, size)

    def __len__(self) -> int:
        return len(self.size)

    def places(self, wide: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the first bases of each read, and which of them are there."""
        inside = np.arange(wide)[None] < self.size[:, None]
        return np.where(inside, self.start[:, None] + np.arange(wide)[None], 0), inside

    def codes(self) -> np.ndarray:
        """Codes of bases in a matrix, a 4 for what isn't one."""
        if self._codes is None:
            at, inside = self.places(int(self.size.max(initial=0)))
            self._codes = np.where(inside, _CODE[self.seq[at]], 4).astype(np.uint8) if at.size else np.zeros(at.shape, np.uint8)
        return self._codes

    def rows(self, which: np.ndarray) -> Reads:
        return Reads(self.seq, self.qual, self.start[which], self.size[which])

    def cut(self, pieces: list[tuple[np.ndarray, np.ndarray]]) -> Reads:
        """Each read as some pieces of it (begin, length), one after the other."""
        begin = np.stack([self.start + b for b, _ in pieces], 1).ravel()
        size = np.stack([n for _, n in pieces], 1)
        at = ranges(begin, size.ravel())
        return Reads(self.seq[at], self.qual[at], np.cumsum(size.sum(1)) - size.sum(1), size.sum(1))

    def turned(self, which: np.ndarray) -> Reads:
        """Reads with some of them on the other strand."""
        at = ranges(self.start, self.size)
        turn = np.repeat(which, self.size)
        at = np.where(turn, 2 * np.repeat(self.start, self.size) + np.repeat(self.size, self.size) - 1 - at, at)
        seq = self.seq[at]
        return Reads(np.where(turn, _OTHER[seq], seq), self.qual[at], np.cumsum(self.size) - self.size, self.size)

    def texts(self, of: str) -> pa.Array:
        flat, end = getattr(self, of)[ranges(self.start, self.size)], np.cumsum(self.size)
        if not (flat & 128).any() and len(flat) < 1 << 31:
            return pa.StringArray.from_buffers(len(self), pa.py_buffer(np.concatenate([[0], end]).astype(np.int32)), pa.py_buffer(flat))
        flat = flat.tobytes().decode("latin-1")
        return pa.array([flat[a:b] for a, b in zip((end - self.size).tolist(), end.tolist(), strict=True)], pa.string())


def ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of all ranges."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())


def stacked(parts: list[Reads]) -> Reads:
    """Reads of several objects in one."""
    moved = np.cumsum([0, *(len(p.seq) for p in parts[:-1])])
    return Reads(*(np.concatenate(x) for x in ([p.seq for p in parts], [p.qual for p in parts], [p.start + m for p, m in zip(parts, moved.tolist(), strict=True)], [p.size for p in parts])))


class Patterns:
    """Compiled barcodes: for each its seed as bit masks of the bases (the first 64 places), and the bases that each place allows."""

    def __init__(self, barcodes: list[str], limits: Limits):
        self.size = np.array([len(b) for b in barcodes])
        self.allowed = [np.array([[x in IUPAC[c.upper()] for x in "ATGC"] + [False] for c in b]) for b in barcodes]
        self.seed = [a | np.array([[c.islower()] * 4 + [False] for c in b]) for a, b in zip(self.allowed, barcodes, strict=True)]
        self.mask = np.array([[sum(1 << i for i in range(min(len(b), 64)) if s[i, c]) for c in range(5)] for b, s in zip(barcodes, self.seed, strict=True)], np.uint64).reshape(-1, 5)
        self.top = np.array([1 << (min(len(b), 64) - 1) for b in barcodes], np.uint64)
        self.word = next(w for n, w in ((16, np.uint16), (32, np.uint32), (np.inf, np.uint64)) if max(map(len, barcodes), default=0) <= n)
        self.tag = [np.array([i for i, c in enumerate(b) if c == "N"], np.int64) for b in barcodes]
        self.most_low, self.most_high, self.low = [int(n * limits.low_share) for n in self.size], [int(n * limits.high_share) for n in self.size], limits.low

    def find(self, reads: Reads, which: np.ndarray | None = None) -> np.ndarray:
        """First start of each pattern (or of one for each read) that matches; -1 without one."""
        codes = reads.codes()
        one = which is not None
        kinds, n = 1 if one else len(self.size), len(reads)
        out = np.full((n, kinds), -1)
        if not out.size:
            return out
        masks, top = self.mask.astype(self.word), self.top.astype(self.word)
        by_place = np.ascontiguousarray(codes.T).astype(np.intp)
        step = masks.ravel().take(by_place + 5 * which)[:, None] if one else np.stack([m.take(by_place) for m in masks], 1)  # place, pattern, read
        state, hits = np.zeros((kinds, n), self.word), np.zeros((len(by_place), kinds, n), bool)
        top = top[which][None] if one else top[:, None]
        for j in range(len(by_place)):
            np.left_shift(state, self.word(1), out=state)
            np.bitwise_or(state, self.word(1), out=state)
            np.bitwise_and(state, step[j], out=state)
            np.not_equal(state & top, 0, out=hits[j])
        end, pattern, row = np.unravel_index(np.flatnonzero(hits), hits.shape)
        if not len(row):
            return out
        pattern = which[row] if one else pattern
        best = np.full(out.shape, 1 << 60)
        for p in np.unique(pattern).tolist():
            here = pattern == p
            n, r = int(self.size[p]), row[here]
            start = end[here] - min(n, 64) + 1
            fits = start + n <= reads.size[r]
            r, start = r[fits], start[fits]
            at = start[:, None] + np.arange(n)[None]
            base, places = codes[r[:, None], at], np.arange(n)[None]
            wrong = ~self.allowed[p][places, base]
            low = reads.qual[reads.start[r][:, None] + at].astype(np.int64) - 33 <= self.low
            good = self.seed[p][places, base].all(1) & ((wrong & low).sum(1) <= self.most_low[p]) & ((wrong & ~low).sum(1) <= self.most_high[p])
            np.minimum.at(best, (r[good], 0 if one else p), start[good])
        out[best < 1 << 60] = best[best < 1 << 60]
        return out

    def tags(self, reads: Reads, which: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Places of the tag of each read, whose pattern `which` begins at `at`; -1 where it has fewer, and in all where `at` is -1."""
        places = np.full((len(reads), max(map(len, self.tag), default=0)), -1)
        for p in np.unique(which[at >= 0]).tolist():
            rows = np.flatnonzero((which == p) & (at >= 0))
            places[rows, : len(self.tag[p])] = (reads.start[rows] + at[rows])[:, None] + self.tag[p][None]
        return places


def trimmed(reads: Reads, at: np.ndarray, size: np.ndarray, least: int = 10) -> Reads:
    """Barcodes cut out where there is one (at is not -1), with what is before and after them where that has at most `least` bases."""
    has = at >= 0
    after = np.where(has, reads.size - at - size, 0)
    return reads.cut([(np.zeros_like(at), np.where(has, np.where(at > least, at, 0), reads.size)), (np.where(has, at + size, 0), np.where(after > least, after, 0))])


def without_switch(reads: Reads, which: np.ndarray, slave: bool = False) -> Reads:
    """Bases of template switching cut: up to 3 T and 3 to 7 G that a master's rest begins with, or C and A that a slave's ends with."""
    wide = 11
    i = np.arange(wide)[None]
    at = np.where(slave, reads.size[:, None] - 1 - i, i)
    inside = (i < reads.size[:, None]) & which[:, None]
    base = np.where(inside, reads.seq[np.where(inside, reads.start[:, None] + at, 0)] if len(reads.seq) else 0, 0)
    run = lambda hit: np.logical_and.accumulate(hit, 1).sum(1)
    first = run(base == ord("A" if slave else "T"))
    second = run((base == ord("C" if slave else "G")) | (i < first[:, None])) - first
    n = np.where((first <= 3) & (second >= 3), first + np.minimum(second, 7), 0)
    return reads.cut([(np.zeros_like(n) if slave else n, reads.size - n)])


def merged(first: Reads, second: Reads, sizes: Merging) -> tuple[np.ndarray, Reads]:
    """Which pairs overlap, and those merged where the second mate begins inside the first: the better base of each shared place, ties to the second."""
    n = len(first)
    w1, w2, seed, match = int(first.size.max(initial=0)), int(second.size.max(initial=0)), sizes.seed, sizes.match
    at1, in1 = first.places(w1 + match)
    at2, in2 = second.places(max(w2, sizes.most_offset + seed) + match)
    one = np.where(in1, first.seq[at1] if len(first.seq) else 0, 0)
    two = np.where(in2, second.seq[at2] if len(second.seq) else 0, 1)
    begin, offset = np.full(n, -1), np.zeros(n, np.int64)
    for i in range(sizes.most_offset):
        open_ = np.flatnonzero(begin < 0)
        if not len(open_) or w1 < seed:
            break
        hit = np.ones((len(open_), w1 - seed + 1), bool)
        for j in range(seed):
            hit &= one[open_, j : j + w1 - seed + 1] == two[open_, i + j, None]
        r, p = np.nonzero(hit)  # in order of places
        row = open_[r]
        a, b = (p + seed)[:, None] + np.arange(match)[None], i + seed + np.arange(match)[None]
        inside = (a < first.size[row][:, None]) & (b < second.size[row][:, None])
        bad = (one[row[:, None], a] != two[row[:, None], b]) & inside
        compared = inside.sum(1)
        good = ((compared == match) | (sizes.partial & (compared > 0))) & (bad.sum(1) <= compared * 0.1) & ~(bad[:, 1:] & bad[:, :-1]).any(1)
        row, p = row[good], p[good]
        least = np.full(n, 1 << 40)
        np.minimum.at(least, row, p)
        begin[row], offset[row] = least[row], i
    which = begin >= 0
    f, s, begin, offset = first.rows(which), second.rows(which), begin[which], offset[which]
    shared = np.minimum(f.size - begin, s.size - offset)
    left, right = f.cut([(begin, shared)]), s.cut([(offset, shared)])
    better = left.qual > right.qual
    middle = Reads(np.where(better, left.seq, right.seq), np.where(better, left.qual, right.qual), left.start, left.size)
    longer = f.size - begin > shared
    parts = stacked([f.cut([(np.zeros_like(begin), begin)]), middle, f.cut([(begin + shared, np.where(longer, f.size - begin - shared, 0))]), s.cut([(offset + shared, np.where(longer, 0, s.size - offset - shared))])])
    m = int(which.sum())
    size = parts.size.reshape(4, m).T
    at = ranges(parts.start.reshape(4, m).T.ravel(), size.ravel())
    total = size.sum(1)
    return which, Reads(parts.seq[at], parts.qual[at], np.cumsum(total) - total, total)


SCHEMA = "sample string, matched string, type string, umi string, umi_qual string, s1 string, q1 string, s2 string, q2 string, swapped boolean"


class Checkout:
    """Barcodes and options of a run, applied to batches of pairs."""

    def __init__(self, barcodes: list[Barcode], cut: bool, both_ways: bool, mask: str, merge: Merging | None, switch: bool, complement: bool, limits: Limits, most_trim: int = 10):
        if complement:
            barcodes = [x for b in barcodes for x in (b, Barcode(b.sample, iupac_complement(b.master), iupac_complement(b.slave) if b.slave else None))]
        self.barcodes, self.cut, self.both_ways, self.merge, self.switch = barcodes, cut, both_ways, merge, switch
        self.flags, self.most_trim = [x == "1" for x in mask.split(":")], most_trim
        self.masters = Patterns([b.master for b in barcodes], limits)
        self.slaves = Patterns([b.slave if b.slave and b.slave != "N" else "N" for b in barcodes], limits)
        self.wanted = np.array([bool(b.slave) and b.slave != "N" for b in barcodes], bool)

    def __call__(self, s1: list | pa.Array, q1: list | pa.Array, s2: list | pa.Array, q2: list | pa.Array) -> list[pa.Array]:
        s1, q1, s2, q2 = (x if isinstance(x, pa.Array) else pa.array(x, pa.string()) for x in (s1, q1, s2, q2))
        n, paired = len(s1), s2.is_valid().to_numpy(zero_copy_only=False)
        one, two = Reads.of(s1, q1), Reads.of(s2, q2)
        at = np.full((n, len(self.barcodes), 2), -1)
        if self.barcodes:
            at[:, :, 0] = self.masters.find(one)
            if self.both_ways and paired.any():
                at[paired, :, 1] = self.masters.find(two.rows(paired))
        at = at.reshape(n, -1)
        hit = at >= 0
        some, first = hit.any(1), hit.argmax(1) if at.shape[1] else np.zeros(n, np.int64)
        of, swapped = np.where(some, first // 2, -1), some & (first % 2 == 1)
        at = np.where(some, at[np.arange(n), first], -1) if at.shape[1] else np.full(n, -1)
        both, own = stacked([one, two]), np.arange(n) + np.where(swapped, n, 0)
        master, other = both.rows(own), both.rows(np.where(swapped, np.arange(n), np.arange(n) + n))
        asked = some & paired & (self.wanted[of] if len(self.barcodes) else False)
        to = np.full(n, -1)
        if asked.any():
            to[asked] = self.slaves.find(other.rows(asked), of[asked])[:, 0]
        whole = some & ~(asked & (to < 0))
        places = np.concatenate([self.masters.tags(master, of, at), self.slaves.tags(other, of, to)], 1)
        size = (places >= 0).sum(1)
        tag = Reads(both.seq[places[places >= 0]], both.qual[places[places >= 0]], np.cumsum(size) - size, size)
        if self.cut:
            master = trimmed(master, at, np.where(some, self.masters.size[of] if len(self.barcodes) else 0, 0), self.most_trim)
            other = trimmed(other, to, np.where(to >= 0, self.slaves.size[of] if len(self.barcodes) else 0, 0), self.most_trim)
            if self.switch:
                master, other = without_switch(master, some), without_switch(other, to >= 0, True)
        if self.flags[0]:
            master = master.turned(np.ones(n, bool))
        if self.flags[1]:
            other = other.turned(paired)
        type_ = np.where(paired, "paired", "unpaired").astype(object)
        gone, first = ~paired, master
        if self.merge and (tried := np.flatnonzero(whole & paired)).size:
            which, made = merged(master.rows(tried), other.rows(tried), self.merge)
            rows = tried[which]
            type_[rows] = "overlapped"
            gone = gone.copy()
            gone[rows] = True
            of_made = np.arange(n)
            of_made[rows] = n + np.arange(len(rows))
            first = stacked([master, made]).rows(of_made)
        names = np.array([b.sample for b in self.barcodes] + ["undef-m"], object)
        sample = np.where(whole, names[of], np.where(some, "undef-s", "undef-m"))
        text = lambda x: pa.array(x, pa.string())
        some_of = lambda reads, none: [pc.if_else(pa.array(none), pa.scalar(None, pa.string()), reads.texts(c)) for c in ("seq", "qual")]
        return [text(sample), text(names[of]), text(type_), *some_of(tag, ~some), first.texts("seq"), first.texts("qual"), *some_of(other, gone), pa.array(swapped)]


def checkout(
    reads: DataFrame, barcodes: list[Barcode] | dict[str, list[Barcode]], keep: list[str], cut: bool = False, both_ways: bool = True, mask: str = "0:1", merge: bool | Merging = False,
    switch: bool = False, skip_undef: bool = False, partial: bool = False, complement: bool = False, limits: Limits | None = None, file: str = "file", most_trim: int = 10,
) -> DataFrame:
    """Assign read pairs (s1, q1, s2, q2) to the first barcode that is found, the first mate before the second. Columns in `keep` pass through.

    sample is undef-m without a master, undef-s without its slave (matched: whose master it has); type is paired, overlapped or unpaired. s2 may be null. A null read has no barcode, a
    missing quality counts as zero. Reads without a sample are oriented too, those without a slave are also cut.
    barcodes: of all reads, or by the value of the column `file` (None: of files that aren't named).
    switch: template-switch bases go too (only where barcodes are cut); skip_undef: pairs without a sample are left out; merge, partial: see Merging;
    complement: barcodes are looked for on the other strand too; most_trim: bases before and behind a barcode that are cut with it."""
    by_file = barcodes if isinstance(barcodes, dict) else {None: barcodes}
    sizes = merge if isinstance(merge, Merging) else Merging(partial=partial) if merge else None
    options = (cut, both_ways, mask, sizes, switch, complement, limits or Limits(), most_trim)
    named = isinstance(barcodes, dict)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = {f: Checkout(b, *options) for f, b in by_file.items()}
        for whole in batches:
            files = np.array(whole.column(whole.num_columns - 1).to_pylist(), object) if named else None
            for name in [None] if files is None else sorted({f if f in made else None for f in files.tolist()}, key=str):
                rows = np.arange(whole.num_rows) if files is None else np.flatnonzero([f == name if name is not None else f not in made or f is None for f in files.tolist()])
                for a in range(0, len(rows), _ROWS):
                    batch = whole.take(pa.array(rows[a : a + _ROWS]))
                    columns = [batch.column(len(keep) + i) for i in range(4)]
                    run_ = made[name] if name in made else Checkout([], *options)
                    yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), *run_(*columns)], [f"c{i}" for i in range(len(keep) + 10)])

    kinds = ", ".join(f"`{c}` {reads.schema[c].dataType.simpleString()}" for c in keep)
    wanted = reads.select(*keep, "s1", "q1", "s2", "q2", *([F.col(file).alias("_of_file")] if named else []))
    found = wanted.mapInArrow(run, f"{kinds}, {SCHEMA}" if keep else SCHEMA)
    return found.filter(~F.col("sample").isin("undef-m", "undef-s")) if skip_undef else found


def compiled(rows: DataFrame) -> list[Barcode]:
    """Barcodes of a table (ord, sample, master, slave), in its order; a barcode list is as long as a run has samples."""
    return [Barcode(r["sample"], r.master, r.slave) for r in rows.orderBy("ord").collect()]


def checkout_batch(reads: DataFrame, rows: DataFrame, keep: list[str], **options) -> DataFrame:
    """Reads of several files, each with the barcodes of its own rows, in one pass over the reads. reads has a file column; rows: ord, sample, master, slave, fastq1, and fastq2 or not.
    Barcodes without a file are for all."""
    table = rows.orderBy("ord").collect()
    files = {r.fastq1 for r in table if r.fastq1 is not None}
    barcodes = {f: [Barcode(r["sample"], r.master, r.slave) for r in table if r.fastq1 in (None, f)] for f in (*files, None)}
    return checkout(reads, barcodes, keep, **options)


def checkout_log(found: DataFrame) -> DataFrame:
    """Pairs with a sample's master, with master and slave, and merged, by sample; undef-m counts none."""
    whole = ~F.col("sample").isin("undef-m", "undef-s")
    return found.groupBy(F.col("matched").alias("sample")).agg(F.count_if(F.col("sample") != "undef-m").alias("master"), F.count_if(whole).alias("master_slave"), F.count_if(F.col("type") == "overlapped").alias("overlapped"))
