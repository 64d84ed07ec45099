"""Line dedup: lines whose sets of word shingles are similar to those of an earlier line go.

An exact set-similarity join of lines (`setjoin`: shingles ordered by rarity, prefix, length and positional filters, Jaccard verified).
The tokens ordered by rarity are shingles of 5 words, so that a line of common words in another order is no repeat. A line goes if some earlier
line is directly similar to it, whether that one stays or goes: in a chain A ~ B ~ C with A and C apart, B and C both go. Earlier means a smaller
document key, then text hash, then line number. A line with fewer words than a shingle is compared as a whole, so it goes only as an exact repeat
(case folded); with `least_words` above 1 (off by default) lines of fewer words always stay. Lines without words stay.

A null or empty text stays as it is. Rows with one key and one text are repeats of one row: their lines get the same decision, so a line
of theirs isn't an earlier line of itself. A null key sorts after all others. Other columns pass through, whatever their names; columns n_lines and
n_removed of the input give way to the new ones. A text whose lines all go becomes empty. A very long text is a batch of its own in a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.scratch import Scratch
from tagloom.llm.setjoin import SetJoin


def _without(text: int, kept: list[str]):
    """Drops lines; columns come in order, the numbers of the lines that go last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lines, removed = [], [], []
            for value, gone in zip(batch.column(text).to_pylist(), batch.column(len(kept)).to_pylist(), strict=True):
                split, gone = (value or "").split("\n"), set(gone or ())
                texts.append("\n".join(x for i, x in enumerate(split) if i not in gone) if gone else value)
                lines.append(len(split) if value else 0)
                removed.append(len(gone))
            cols = [pa.array(texts, pa.string()) if i == text else batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(lines, pa.int64()), pa.array(removed, pa.int64())], [*kept, "n_lines", "n_removed"])

    return run


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80, least_words: int = 1) -> DataFrame:
    """k, h, gone: key, text hash and numbers (from 0) of the lines that go, one row for each document that loses any."""
    join, scratch = SetJoin(size, percent, True, least_words), Scratch(docs.sparkSession)
    rows = docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    scan = join.scan(rows, ["k", "h"], "text", scratch)
    lines = join.items(scan).filter("n > 0").select(F.col("k0").isNull().alias("last"), F.col("k0").alias("k"), F.col("k1").alias("h"), "part", "n", "digest", *join.sketch)
    order = ["last", "k", "h", "part"]
    place = F.struct(*order)
    classes = scratch.save(lines.groupBy("digest").agg(F.min("n").alias("n"), *(F.min(c).alias(c) for c in join.sketch), F.min(place).alias("first"), F.count("*").alias("copies")), "classes")
    gone = join.earlier(rows.select("text"), scan, classes.select("digest", "n", *join.sketch, "first.*"), order, scratch).withColumn("all", F.lit(True))
    some = classes.select("digest", "first", "copies").join(gone, "digest", "left").filter("all OR copies > 1").select("digest", "first", "all")
    found = lines.select("digest", *order).join(some, "digest").filter(F.col("all").isNotNull() | (F.col("first") < place)).groupBy("k", "h").agg(F.collect_set("part").alias("gone"))
    found = scratch.save(found, "gone")
    scratch.drop_all(found)
    return found


def remove_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80, least_words: int = 1) -> DataFrame:
    """All rows and columns, the text without lines that repeat an earlier one, and n_lines and n_removed."""
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    gone = repeated_lines(docs.select(key, text), key, text, size, percent, least_words)
    whole = docs.select(F.struct(*kept).alias("row"), F.col(key).alias("k"), F.xxhash64(text).alias("h"))
    joined = whole.join(gone, whole["k"].eqNullSafe(gone["k"]) & (whole["h"] == gone["h"]), "left")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema), "n_lines long, n_removed long"])
    columns = [F.col("row").getField(c).alias(f"c{i}") for i, c in enumerate(kept)]
    return joined.select(*columns, "gone").mapInArrow(_without(kept.index(text), kept), schema)
