"""Gapped local alignment of distinct reads, on both strands, with a library of alleles.

The library is small and goes to all tasks, in pieces of at most PIECE bases. A task packs all words of a batch of reads into codes, looks them up in the sorted words
of the library, and so gets for each read, strand and allele the diagonal with most shared words. Around that diagonal a band of
an affine-gap dynamic programme runs in numpy for thousands of such pairs at once, first for scores alone. For the pairs with a read's highest score it runs again
and is traced back, all pairs a step at a time, which gives the ends, the identities, and where in the read the allele's reference point lies, whatever gaps are before it. The best of a read and kind of segment has the highest score, then most identities, then the first names, the forward strand, the first diagonal.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Match, mismatch, and the price of a gap of n bases, OPEN + n * EXTEND.
MATCH, MISMATCH, OPEN, EXTEND = 2, -3, 5, 2
PIECE, CELLS, READS = 1 << 22, 1 << 23, 1024
HIT = "rc boolean, gene string, alleles string, segments string, ref_point int, score int, n_ident int, shift int, q_from int, q_to int, a_from int, a_to int, q_ref int"

_CODE = np.full(256, 4, np.uint8)
_CODE[list(b"ACGT")] = range(4)


@dataclass
class Library:
    """Alleles of a piece of the library: names, codes of their bases in a padded matrix, and their words in order."""

    names: list[tuple]
    kinds: list[str]
    kind: np.ndarray
    codes: np.ndarray
    size: np.ndarray
    ref: np.ndarray
    words: np.ndarray
    of: np.ndarray
    at: np.ndarray

    @classmethod
    def made(cls, rows: list, k: int) -> Library:
        flat, start = joined([r.seq for r in rows])
        size = np.diff(start) - 1
        codes = np.full((len(rows), int(size.max())), 8, np.uint8)
        inside = np.arange(codes.shape[1])[None] < size[:, None]
        codes[inside] = np.where(flat < 4, flat, 8)[np.concatenate([np.arange(a, b - 1) for a, b in zip(start[:-1].tolist(), start[1:].tolist(), strict=True)])]
        place, code = words_of(flat, k)
        order = np.argsort(code, kind="stable")
        of = np.searchsorted(start, place, "right") - 1
        kinds = sorted({r.kind for r in rows})
        return cls([(r.gene, r.kind, r.alleles, r.segments) for r in rows], kinds, np.array([kinds.index(r.kind) for r in rows]), codes, size, np.array([r.ref_point for r in rows]), code[order], of[order], (place - start[of])[order])


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all bases, a 4 for what isn't one and after each text; where texts begin, and the end."""
    data = _CODE[np.frombuffer(("\n".join(texts) + "\n").encode("ascii", "replace"), np.uint8)]
    return data, np.concatenate([[0], np.cumsum([len(x) + 1 for x in texts])])


def words_of(flat: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and codes of all words of k known bases."""
    n = len(flat) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.zeros(n, np.int64)
    for i in range(k):
        code = (code << 2) | (flat[i : i + n] & 3)
    bad = np.concatenate([[0], np.cumsum(flat > 3)])
    place = np.flatnonzero(bad[k:] == bad[:-k])
    return place, code[place]


def best_diagonals(flat: np.ndarray, start: np.ndarray, library: Library, k: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, allele and diagonal (place in the text less place in the allele) with most shared words, where it has `least` of them at least."""
    place, code = words_of(flat, k)
    low, high = np.searchsorted(library.words, code, "left"), np.searchsorted(library.words, code, "right")
    n = high - low
    hit = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    place = np.repeat(place, n)
    text = np.searchsorted(start, place, "right") - 1
    wide = int(np.diff(start).max()) + library.codes.shape[1]
    shift = place - start[text] - library.at[hit] + library.codes.shape[1]
    key, count = np.unique((text * len(library.size) + library.of[hit]) * wide + shift, return_counts=True)
    pair = key // wide
    order = np.lexsort((key, -count, pair))
    first = order[np.concatenate([[True], pair[order][1:] != pair[order][:-1]])] if len(order) else order
    first = first[count[first] >= least]
    return pair[first] // len(library.size), pair[first] % len(library.size), key[first] % wide - library.codes.shape[1]


def _steps(query: np.ndarray, allele: np.ndarray, band: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Rows of the dynamic programme, one for each column of the alleles: the score with and without gaps in the allele, and what it is the best of."""
    rows, pairs = allele.shape
    wide, kind = 2 * band + 1, np.int16 if MATCH * rows < 16_000 else np.int32
    low, dear, extend = kind(-16_384), kind(OPEN + EXTEND), kind(EXTEND)
    h, f = np.zeros((wide, pairs), kind), np.full((wide, pairs), low)
    for i in range(rows):
        opened, longer = np.full_like(h, low), np.full_like(h, low)
        np.subtract(h[1:], dear, out=opened[:-1])
        np.maximum(f[1:] - extend, low, out=longer[:-1])
        f = np.maximum(opened, longer)
        diagonal = (query[i : i + wide] == allele[i]).astype(kind)
        diagonal *= kind(MATCH - MISMATCH)
        diagonal += h
        diagonal += kind(MISMATCH)
        inner = np.maximum(diagonal, f)
        np.maximum(inner, 0, out=inner)
        e = np.full_like(h, low)
        for b in range(1, wide):  # a gap goes on or begins
            np.maximum(inner[b - 1] - dear, e[b - 1] - extend, out=e[b])
        h = np.maximum(inner, e)
        yield h, inner, f, e, diagonal, opened, longer


def scores(query: np.ndarray, allele: np.ndarray, band: int) -> np.ndarray:
    """The best local score of each pair within the band. query: a column a pair, codes of the places band before the pair's diagonal on, as many as alleles have
    bases and the band has places; allele: a column a pair."""
    best = np.zeros(allele.shape[1], np.int32)
    for h, *_ in _steps(query, allele, band):
        np.maximum(best, h.max(0), out=best)
    return best


def traced(query: np.ndarray, allele: np.ndarray, ref: np.ndarray, middle: np.ndarray, band: int) -> np.ndarray:
    """As `scores`, with the way back: columns score, n_ident, q_from, q_to, a_from, a_to, q_ref."""
    rows, pairs = allele.shape
    back, kept = np.zeros((rows, 2 * band + 1, pairs), np.uint8), []
    best, end = np.zeros(pairs, np.int64), np.zeros(pairs, np.int64)
    for i, (h, inner, f, e, diagonal, opened, longer) in enumerate(_steps(query, allele, band)):
        back[i] = np.where(h == 0, 0, np.where(diagonal == h, 1, np.where(f == h, 2, 3)))
        back[i] |= (longer >= opened).astype(np.uint8) << 2
        back[i, 1:] |= (e[:-1] - EXTEND >= inner[:-1] - (OPEN + EXTEND)).astype(np.uint8) << 3
        top = h.max(0)
        end[top > best], best = i, np.maximum(best, top)
        kept.append(h)
    every = np.arange(pairs)
    i, b = end.copy(), (np.stack(kept)[end, :, every] == best[:, None]).argmax(1)
    q_to = i + middle - band + b
    out = np.stack([best, np.zeros(pairs, np.int64), q_to, q_to, i, i, np.where(ref == i + 1, q_to + 1, -1)], 1)
    state, active = np.zeros(pairs, np.int64), best > 0
    while active.any():
        p = every[active]
        x, y = i[p], b[p]
        cell = np.where(x >= 0, back[np.maximum(x, 0), y, p], 0)
        kind = np.where(state[p] == 0, cell & 3, state[p] + 1)  # 0 begin, 1 pair of bases, 2 gap in the read, 3 gap in the allele
        j = x + middle[p] - band + y
        m = kind == 1
        out[p[m], 1] += query[x[m] + y[m], p[m]] == allele[x[m], p[m]]
        out[p[m], 2], out[p[m], 4] = j[m], x[m]
        at_ref = (x == ref[p]) & ((kind == 1) | (kind == 2))
        out[p[at_ref], 6] = (j + (kind == 2))[at_ref]
        on = np.where(kind == 2, cell >> 2 & 1, cell >> 3 & 1)
        state[p] = np.where((kind >= 2) & (on == 1), kind - 1, 0)
        i[p] = x - ((kind == 1) | (kind == 2))
        b[p] = y + (kind == 2) - (kind == 3)
        active[p] = kind > 0
    before = ref == out[:, 4] - 1
    out[before, 6] = out[before, 2] - 1
    return out


def align_batch(reads: list[str], library: Library, k: int, band: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each read and kind of segment the pairs with the highest score: read, allele, other strand or not, diagonal, and the columns of `traced`."""
    n = len(reads)
    table = str.maketrans("ACGT", "TGCA")
    flat, start = joined([*reads, *("".join(c if c in "ACGT" else "N" for c in x).translate(table)[::-1] for x in reads)])
    text, allele, shift = best_diagonals(flat, start, library, k, least)
    rows, wide = library.codes.shape[1], 2 * band + 1
    bases = np.where(flat < 4, flat, 7).astype(np.uint8)

    def opened(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        t = text[part]
        at = (start[t] + shift[part] - band)[None] + np.arange(rows + wide - 1)[:, None]
        return np.where((at >= start[t]) & (at < start[t + 1] - 1), bases[np.clip(at, 0, len(bases) - 1)], 6), np.ascontiguousarray(library.codes[allele[part]].T)

    step = max(1, CELLS // (rows * wide))
    parts = lambda x: (x[a : a + step] for a in range(0, len(x), step))
    score = np.concatenate([np.zeros(0, np.int32), *(scores(*opened(p), band) for p in parts(np.arange(len(text))))])
    group = (text % max(n, 1)) * len(library.kinds) + library.kind[allele]
    highest = np.zeros(n * len(library.kinds), np.int32)
    np.maximum.at(highest, group, score)
    won = np.flatnonzero((score == highest[group]) & (score > 0))
    found = np.concatenate([np.zeros((0, 7), np.int64), *(traced(*opened(p), library.ref[allele[p]], shift[p], band) for p in parts(won))])
    return text[won] % max(n, 1), allele[won], text[won] >= n, shift[won], found


def _aligned(sent, k: int, band: int, least: int, least_identical: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = sent.value
        order_of = np.empty(len(library.names), np.int64)
        order_of[sorted(range(len(library.names)), key=lambda i: (library.names[i][0], library.names[i][2]))] = np.arange(len(library.names))
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for b in range(0, len(texts), READS):
                read, allele, rc, shift, found = align_batch(texts[b : b + READS], library, k, band, least)
                good = found[:, 1] >= least_identical
                read, allele, rc, shift, found = read[good], allele[good], rc[good], shift[good], found[good]
                kind = library.kind[allele]
                order = np.lexsort((shift, rc, order_of[allele], -found[:, 1], -found[:, 0], kind, read))
                first = order[np.concatenate([[True], (read[order][1:] != read[order][:-1]) | (kind[order][1:] != kind[order][:-1])])] if len(order) else order
                names = [library.names[i] for i in allele[first].tolist()]
                whole = lambda x: pa.array(x[first].astype(np.int32))  # noqa: E731, B023
                text = lambda i: pa.array([x[i] for x in names], pa.string())  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays([
                    pa.array([texts[b + i] for i in read[first].tolist()], pa.string()), text(1), pa.array(rc[first]), text(0), text(2), text(3), whole(library.ref[allele]), whole(found[:, 0]), whole(found[:, 1]), whole(shift), *(whole(found[:, c]) for c in range(2, 7)),
                ], ["read", "kind", *(x.split()[0] for x in HIT.split(", "))])

    return run


def gapped_hits(reads: DataFrame, alleles: DataFrame, k: int = 7, band: int = 16, least: int = 3, least_identical: int = 7) -> DataFrame:
    """The best gapped hit of each distinct sequence (both strands) and kind of segment: read, kind and the columns of HIT; places are those on the hit's strand, q_ref where the
    reference point lies (-1 if it is more than a base outside of the alignment).

    reads: seq (null or empty: no hit); alleles: gene, kind, alleles, segments, ref_point, seq. Gaps of a hit may move it `band` diagonals away from the one with most
    shared words of k bases, of which it needs `least`."""
    spark = reads.sparkSession
    distinct = reads.select("seq").filter(F.length("seq") > 0).distinct()
    sizes = alleles.select(F.length("seq").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    pieces, found = -(-sizes.n // PIECE), None
    for piece in range(pieces):
        part = alleles.filter(F.length("seq") >= k).filter(F.pmod(F.xxhash64("gene", "kind", "alleles", "seq"), F.lit(pieces)) == piece)
        rows = part.select("gene", "kind", "alleles", "segments", "ref_point", "seq").orderBy("gene", "kind", "alleles", "seq").collect()  # a piece of the library
        if rows:
            sent = spark.sparkContext.broadcast(Library.made(rows, k))
            hits = distinct.mapInArrow(_aligned(sent, k, band, least, least_identical), f"read string, kind string, {HIT}")
            found = hits if found is None else found.unionByName(hits)
    if found is None:
        return spark.createDataFrame([], f"read string, kind string, {HIT}")
    if pieces == 1:
        return found
    hit = [x.split()[0] for x in HIT.split(", ")]
    first = F.struct(-F.col("score"), -F.col("n_ident"), "gene", "alleles", "rc", "shift")
    return found.groupBy("read", "kind").agg(F.min_by(F.struct(*hit), first).alias("hit")).select("read", "kind", "hit.*")
