"""Reads as they are: repeats, qualities, CDR3 bundles, back-tracking, reports."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagloom.operators import profiles
from tagloom.sources.tables import saved, sent_if_small


def frequent_reads(reads: DataFrame, least: int = 10) -> DataFrame:
    """Reads whose sequence comes at least so often. Sequences are counted first; the most common ones, of which there can be at most 4,096, go to all tasks, so that their reads aren't gathered."""
    counts = saved(reads.groupBy("seq").agg(F.count("*").alias("copies")).filter((F.col("copies") >= least) & F.col("seq").isNotNull()), "copies")
    common = (counts.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0] >> 12) + least
    hot = F.broadcast(counts.filter(F.col("copies") > common))
    rest = reads.join(F.broadcast(counts.filter(F.col("copies") > common).select("seq")), "seq", "left_anti")
    return reads.join(hot, "seq").unionByName(rest.join(counts.filter(F.col("copies") <= common), "seq"))


def mean_quality(reads: DataFrame) -> DataFrame:
    """Distinct sequences with their number and mean quality at each place, cut to whole numbers and held to 2..40. Sequences without a quality are left out."""

    def finished(sums: list[np.ndarray]) -> list[pa.Array]:
        means = [np.clip(v[::2] // v[1::2], 2, 40) for v in sums]
        return [pa.array([int(v[1::2].max()) for v in sums], pa.int64()), pa.array([",".join(map(str, m.tolist())) for m in means], pa.string())]

    return profiles.summed(reads.filter(F.length("qual") > 0).select("seq", "qual"), ["seq"], None, finished, "n long, quals string", lambda batch, code, n: profiles.by_place(batch.column("qual"), code, n))


def quality_matrix(reads: DataFrame) -> DataFrame:
    """Reads by place and quality: a task counts its own reads in a matrix, and sends that."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((0, 256), np.int64)
        for batch in batches:
            _, place, symbol = profiles.letters(batch.column(0))
            if len(place):
                here = np.bincount(place * 256 + symbol, minlength=256 * max(int(place.max()) + 1, len(total))).reshape(-1, 256)
                here[: len(total)] += total
                total = here
        place, symbol = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array((symbol - 33).astype(np.int32)), pa.array(total[place, symbol])], ["pos", "q", "n"])

    return reads.select("qual").mapInArrow(counted, "pos int, q int, n long").groupBy("pos", "q").agg(F.sum("n").alias("n"))


def good_windows(reads: DataFrame, size: int = 5, least: int = 15) -> DataFrame:
    """Reads in which each window of qualities has the least mean; one shorter than a window counts as a window of what it has. Reads without a quality are left out."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            qual = batch.column("qual")
            row, place, symbol = profiles.letters(qual)
            n = np.bincount(row, minlength=batch.num_rows)
            sums = np.concatenate([[0], np.cumsum(symbol.astype(np.int64) - 33)])
            starts = np.flatnonzero((place + size <= n[row]) | (place == 0))
            ends = np.minimum(starts + size, (np.cumsum(n))[row[starts]])
            bad = row[starts][sums[ends] - sums[starts] < size * least]
            good = (n > 0) if size * least > 0 else np.ones(batch.num_rows, bool)
            good[bad] = False
            good &= qual.is_valid().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(good))

    return reads.mapInArrow(kept, reads.schema)


def cdr3_bundles(reads: DataFrame) -> DataFrame:
    """Reads of each CDR3 cut to the window that all of them have around its start, however many they are. reads: cdr3, seq, start (0-based)."""
    room = reads.groupBy("cdr3").agg(F.min("start").alias("l"), F.min(F.length("seq") - F.col("start")).alias("r"))
    return reads.join(room, "cdr3").select("cdr3", F.substring("seq", F.col("start") - F.col("l") + 1, F.col("l") + F.col("r")).alias("part")).groupBy("cdr3", "part").agg(F.count("*").alias("n"))


def listed(reads: DataFrame, wanted: DataFrame) -> DataFrame:
    """Reads whose CDR3 is in a list."""
    return reads.join(sent_if_small(wanted.select(F.col(wanted.columns[0]).alias("cdr3")), "listed"), "cdr3", "left_semi")


def back_track(details: DataFrame, consensus: DataFrame, query: str, by: tuple[str, ...] = ("sample", "mate")) -> DataFrame:
    """Reads behind the consensuses that hold a query. details: by, umi, seq, cnt; consensus: by, umi, seq."""
    return details.join(consensus.filter(F.contains("seq", F.lit(query))).select(*by, "umi"), [*by, "umi"], "left_semi")


def redundant_cdr3s(reads: DataFrame) -> DataFrame:
    """CDR3s of each tag, those one place from a more frequent one of the same tag added to it. reads: umi, cdr3."""
    from tagloom.operators.clonotypes import one_apart

    counts = saved(reads.groupBy("umi", "cdr3").agg(F.count("*").alias("size")), "counts")
    pairs = one_apart(counts.withColumnRenamed("cdr3", "cdr3nt"), ("umi",)).filter("a_size < b_size")
    into = pairs.groupBy("umi", F.col("a").alias("cdr3")).agg(F.max_by("b", F.struct("b_size", "b")).alias("into"))
    moved = counts.join(into, ["umi", "cdr3"], "left").withColumn("cdr3", F.coalesce("into", "cdr3"))
    return moved.groupBy("umi", "cdr3").agg(F.sum("size").alias("n"))


def largest_tags_first(found: DataFrame) -> DataFrame:
    """umi, cdr3, n: tags with most reads first, then in each tag the largest CDR3 first."""
    total = found.groupBy("umi").agg(F.sum("n").alias("total"))
    return found.join(total, "umi").orderBy(F.desc("total"), "umi", F.desc("n"), "cdr3")


def stacked_report(log: DataFrame, by: str, values: list[str]) -> DataFrame:
    """Sums of a log's columns by sample, one row for each value."""
    sums = log.groupBy(by).agg(*(F.sum(v).alias(v) for v in values))
    return sums.unpivot([by], values, "metric", "value")


def over_threshold(hist: DataFrame, estimates: DataFrame, by: tuple[str, ...] = ("sample", "type")) -> DataFrame:
    """The report's histogram with each sample's largest over-sequencing threshold."""
    return hist.join(estimates.groupBy(by[0]).agg(F.max("overseq_threshold").alias("threshold")), by[0])


def assembled_fractions(log: DataFrame) -> DataFrame:
    """Of an assembly log: tags and reads of each sample that end in a consensus, as ratios of sums."""
    sums = log.groupBy("sample").agg(*(F.sum(c).alias(c) for c in ("migs_good_total", "migs_total", "reads_good_total", "reads_total")))
    return sums.select("sample", (F.col("migs_good_total") / F.col("migs_total")).alias("migs_fraction"), (F.col("reads_good_total") / F.col("reads_total")).alias("reads_fraction"))


def mapping_rates(log: DataFrame) -> DataFrame:
    """Of a mapping log (sample, type, events and reads: good, mapped, total): mapping and quality rates, one row for each type and metric."""
    one = lambda m: log.select("sample", "type", F.lit(m).alias("metric"), (F.col(f"{m}_mapped") / F.col(f"{m}_total")).alias("mapping_rate"), (F.col(f"{m}_good") / F.col(f"{m}_mapped")).alias("quality_rate"))
    return one("events").union(one("reads"))


def normalised_histogram(hist: DataFrame, by: tuple[str, ...] = ("sample", "type")) -> DataFrame:
    """Share of each bin in its group's reads, and the group's peak bin."""
    whole = Window.partitionBy(*by)  # a histogram has at most 17 bins
    return hist.select(*by, "bin", (F.col("reads") / F.sum("reads").over(whole)).alias("share"), F.max_by("bin", F.struct("reads", "bin")).over(whole).alias("peak"))
