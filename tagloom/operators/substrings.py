"""Longest shared stretches with a small library, and containment among many strings.

The library is a suffix automaton of all its strings: a state stands for stretches that lie in the same strings. All texts of an Arrow batch walk it together,
a base at a time, by table look-ups: where a state can't go on with a base, the table says from which shorter stretch it can."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CODE = np.full(256, 4, np.uint8)
_CODE[list(b"ATGC")] = range(4)
PIECE, AT_ONCE = 1 << 18, 8192


@dataclass
class Automaton:
    """go: state and base to state (the last base code leads to the start); length: of what is matched after that step, counted from the state it takes, or -1 where
    the match goes on by one; names: by state."""

    go: np.ndarray
    length: np.ndarray
    names: list[str]

    @classmethod
    def made(cls, strings: list[tuple[str, str]]) -> Automaton:
        """Of (name, string); stretches don't go over letters that aren't bases."""
        next_: list[dict[int, int]] = [{}]
        size, link, named = [0], [-1], [set()]

        def state(n: int, moves: dict[int, int], to: int) -> int:
            next_.append(moves), size.append(n), link.append(to), named.append(set())
            return len(size) - 1

        def split(p: int, q: int, c: int) -> int:
            """The state of the stretch that leads from p to q, apart from q's longer ones."""
            copy = state(size[p] + 1, dict(next_[q]), link[q])
            while p != -1 and next_[p].get(c) == q:
                next_[p][c] = copy
                p = link[p]
            link[q] = copy
            return copy

        def extended(last: int, c: int) -> int:
            if c in next_[last]:
                q = next_[last][c]
                return q if size[q] == size[last] + 1 else split(last, q, c)
            new, p = state(size[last] + 1, {}, 0), last
            while p != -1 and c not in next_[p]:
                next_[p][c] = new
                p = link[p]
            if p != -1:
                q = next_[p][c]
                link[new] = q if size[q] == size[p] + 1 else split(p, q, c)
            return new

        for name, string in strings:
            last = 0
            for c in _CODE[np.frombuffer(string.encode("ascii", "replace"), np.uint8)].tolist():
                last = 0 if c == 4 else extended(last, c)
                named[last].add(name)
        order = sorted(range(1, len(size)), key=size.__getitem__)
        for s in reversed(order):
            named[link[s]] |= named[s]
        go, length = np.zeros((len(size), 5), np.int32), np.full((len(size), 5), -1, np.int32)
        length[:, 4] = 0
        for s in [0, *order]:
            for c in range(4):
                if c in next_[s]:
                    go[s, c] = next_[s][c]
                elif s == 0:
                    length[s, c] = 0
                else:
                    up = link[s]
                    go[s, c], length[s, c] = go[up, c], length[up, c] if length[up, c] >= 0 else size[up] + 1
        return cls(go, length, [",".join(sorted(x)) for x in named])

    def longest(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Length, end and state of the longest, then leftmost, stretch of each text that a string of the library holds."""
        n, wide = len(texts), max(map(len, texts), default=0)
        codes = np.full((n, wide), 4, np.uint8)
        size = np.fromiter(map(len, texts), np.int64, n)
        codes[np.arange(wide)[None] < size[:, None]] = _CODE[np.frombuffer("".join(texts).encode("ascii", "replace"), np.uint8)]
        state, here = np.zeros(n, np.int32), np.zeros(n, np.int32)
        best, end, at = np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n, np.int32)
        for j in range(wide):
            step = self.length[state, codes[:, j]]
            here = np.where(step < 0, here + 1, step)
            state = self.go[state, codes[:, j]]
            better = here > best
            best, end, at = np.where(better, here, best), np.where(better, j, end), np.where(better, state, at)
        return best, end, at


def longest_stretches(texts: DataFrame, text: str, library: list[tuple[str, str]], least: int = 2) -> DataFrame:
    """text, names, start and end (0-based, inclusive) of the longest, then leftmost, stretch of at least `least` bases that each distinct text shares with
    the library (name, string), and the names of all strings that hold it. Texts without one, nulls and empty ones are left out.

    A library of more than PIECE bases is used in pieces, of which the best are taken together."""
    spark, pieces, size = texts.sparkSession, [[]], 0
    for name, string in library:
        if size and size + len(string) > PIECE:
            pieces.append([])
            size = 0
        pieces[-1].append((name, string))
        size += len(string)

    def walk(sent):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, batch.num_rows, AT_ONCE):
                    values = batch.column(0).slice(a, AT_ONCE)
                    n, end, state = sent.value.longest(values.to_pylist())
                    rows = np.flatnonzero(n >= least)
                    names = [sent.value.names[s] for s in state[rows].tolist()]
                    yield pa.RecordBatch.from_arrays([values.take(pa.array(rows)), pa.array(names, pa.string()), pa.array((end - n + 1)[rows].astype(np.int32)), pa.array(end[rows].astype(np.int32))], ["text", "names", "start", "end"])

        return run

    distinct = texts.filter(F.length(text) > 0).select(F.col(text).alias("text")).distinct()
    found = None
    for piece in pieces:
        part = distinct.mapInArrow(walk(spark.sparkContext.broadcast(Automaton.made(piece))), "text string, names string, start int, end int")
        found = part if found is None else found.unionByName(part)
    if len(pieces) > 1:
        rank = F.struct(F.col("end") - F.col("start"), -F.col("start"))
        best = found.groupBy("text").agg(F.max(rank).alias("r"), F.collect_list(F.struct(rank.alias("r"), "names")).alias("all"))  # a row a piece
        names = F.array_join(F.sort_array(F.array_distinct(F.flatten(F.transform(F.filter("all", lambda x: x["r"] == F.col("r")), lambda x: F.split(x["names"], ","))))), ",")
        found = best.select("text", names.alias("names"), (-F.col("r.col2")).alias("start"), (F.col("r.col1") - F.col("r.col2")).alias("end"))
    return found.withColumnRenamed("text", text)


def contained(texts: DataFrame, text: str, patterns: DataFrame, pattern: str, k: int = 7) -> DataFrame:
    """All (text, pattern) of which the text holds the pattern; both distinct.

    A pattern is looked up by its rarest word of k letters: texts are joined with patterns by words, not by all their stretches, and what is found is held against the whole pattern.
    Words of all patterns are counted, so a word that many patterns share leads to few of them; a pattern of under k letters is looked up whole, by length."""
    every = lambda c, n: F.when(F.length(c) >= n, F.array_distinct(F.transform(F.sequence(F.lit(0), F.length(c) - n), lambda i: F.substring(c, i + 1, F.lit(n)))))
    wanted = patterns.filter(F.length(pattern) > 0).select(F.col(pattern).alias("pattern")).distinct()
    words = wanted.filter(F.length("pattern") >= k).select("pattern", F.explode(every("pattern", k)).alias("word"))
    often = words.groupBy("word").agg(F.count("*").alias("n"))
    anchors = words.join(often, "word").groupBy("pattern").agg(F.min_by("word", F.struct("n", "word")).alias("word"))
    anchors = anchors.unionByName(wanted.filter(F.length("pattern") < k).select("pattern", F.col("pattern").alias("word")))
    held = texts.filter(F.length(text) > 0).select(F.col(text).alias("text")).distinct()
    short = F.array(*(F.coalesce(every("text", n), F.array().cast("array<string>")) for n in range(1, k))) if k > 1 else F.array()
    parts = held.select("text", F.explode(F.flatten(F.concat(F.array(F.coalesce(every("text", k), F.array().cast("array<string>"))), short))).alias("word")) if wanted.filter(F.length("pattern") < k).limit(1).count() else held.filter(F.length("text") >= k).select("text", F.explode(every("text", k)).alias("word"))
    return parts.join(anchors, "word").filter(F.contains("text", F.col("pattern"))).select(F.col("text").alias(text), F.col("pattern").alias(pattern))
