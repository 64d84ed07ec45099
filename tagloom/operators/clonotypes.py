"""Clonotype tables: counters, rollups, error filters, spike-ins, hypermutation graph, pairing of samples, reports."""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.sequence import codons_to_protein, hamming, one_off, wildcards
from tagloom.operators.substrings import contained
from tagloom.sources.tables import saved

KEY = ("cdr3nt", "v", "j", "d")
COUNTERS = ("good_events", "total_events", "good_reads", "total_reads")
MOST_PAIRS = 1 << 20


def with_share(table: DataFrame, of: str, name: str) -> DataFrame:
    """A column's share of its sum over all rows; the sum is one row, joined to the others."""
    table = saved(table, "shares")
    total = table.agg(F.sum(of).alias("total_of_all"))
    return table.crossJoin(F.broadcast(total)).withColumn(name, F.col(of) / F.col("total_of_all")).drop("total_of_all")


def roll_up(reads: DataFrame, least_quality: int = 25) -> DataFrame:
    """Clonotypes of reads (cdr3nt, v, j, d, quality, inc): events and reads, all and of good quality, and the share of good events."""
    good = F.col("quality") >= least_quality
    found = reads.groupBy(*KEY).agg(F.count_if(good).alias("good_events"), F.count("*").alias("total_events"), F.sum(F.when(good, F.col("inc")).otherwise(0)).alias("good_reads"), F.sum("inc").alias("total_reads"))
    return with_share(found.filter("good_events > 0"), "good_events", "fraction")


def by_good_events(table: DataFrame) -> DataFrame:
    """Rows with most good events first; ties by CDR3, V and J."""
    return table.orderBy(F.desc("good_events"), "cdr3nt", "v", "j", "d")


def canonical_or_broken(aa) -> F.Column:
    """The mapping's looser test: out of frame, with a stop, or ending in F or W."""
    return F.col(aa).rlike("[?*]|[FW]$")


def canonical(aa) -> F.Column:
    return F.col(aa).rlike("^C.+[FW]$")


def functional(aa) -> F.Column:
    return F.col(aa).rlike("^[a-zA-Z]+$")


def collapse(table: DataFrame) -> DataFrame:
    """One row for each CDR3: names from the row with most good reads, counters summed."""
    best = F.max_by(F.struct("v", "j", "d"), F.struct("good_reads", "v", "j", "d"))
    return table.groupBy("cdr3nt").agg(best.alias("best"), *(F.sum(c).alias(c) for c in COUNTERS)).select("cdr3nt", "best.*", *COUNTERS)


def one_apart(table: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Pairs (a, b) of rows whose CDR3s differ in one place: an equi-join on the CDR3 with one place masked. table: id columns `by`, cdr3nt, size."""
    # merged: Spark takes exploded rows for no more than the table has, and would broadcast them
    masks = table.select(*by, "cdr3nt", "size", F.explode(wildcards(F.col("cdr3nt"))).alias("mask"))
    a, b = masks.select(*by, "mask", F.col("cdr3nt").alias("a"), F.col("size").alias("a_size")), masks.select(*by, "mask", F.col("cdr3nt").alias("b"), F.col("size").alias("b_size"))
    return a.join(b.hint("merge"), [*by, "mask"]).filter("a <> b").drop("mask").distinct()


def two_apart(left: DataFrame, right: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, a, b, mm) of all strings a of the left and b of the right table (by, cdr3nt) of one length with the same by-values that differ in at most two places; both distinct.

    Strings are cut in five; two that differ in at most two places agree in three of the parts, so they meet under one of ten hashes of three parts. Where a hash is too common
    (its pairs would be more than MOST_PAIRS), the left strings that have it are looked up by all their neighbours at one place instead, of which both sides share one."""
    def keyed(t: DataFrame, name: str) -> DataFrame:
        n = F.length("cdr3nt")
        part = [F.substring("cdr3nt", F.floor(n * i / 5).cast("int") + 1, F.floor(n * (i + 1) / 5).cast("int") - F.floor(n * i / 5).cast("int")) for i in range(5)]
        keys = F.array(*(F.xxhash64(F.lit(k), n, *(part[i] for i in three), *by) for k, three in enumerate(combinations(range(5), 3))))
        return t.select(*by, "cdr3nt").distinct().withColumn("key", F.explode(keys)).withColumnRenamed("cdr3nt", name)

    sides = {"a": saved(keyed(left, "a"), "left-keys"), "b": saved(keyed(right, "b"), "right-keys")}
    counts = [sides[s].groupBy("key").agg(F.count("*").alias(f"n{s}")) for s in "ab"]
    common = saved(counts[0].join(counts[1], "key").filter(F.col("na") * F.col("nb") > MOST_PAIRS).select("key"), "common-keys")
    near = lambda pairs: pairs.filter(F.length("a") == F.length("b")).withColumn("mm", hamming(F.col("a"), F.col("b"))).filter("mm <= 2").distinct()
    on = ["key", *by]
    if common.limit(1).count() == 0:
        return near(sides["a"].join(sides["b"], on).drop("key"))
    usual = sides["a"].join(common, "key", "left_anti").join(sides["b"], on).drop("key")
    masked = lambda t, name: t.select(*by, name).distinct().withColumn("m", F.explode(one_off(F.col(name))))
    rest = masked(sides["a"].join(common, "key", "left_semi"), "a").join(masked(sides["b"].join(common, "key", "left_semi"), "b"), ["m", *by]).drop("m")
    return near(usual.unionByName(rest))


def erroneous_singletons(table: DataFrame, ratio: int = 20, by: tuple[str, ...] = ("v", "j", "d")) -> DataFrame:
    """Rows with one good event that are an error of a larger one with the same by-values: one place apart and `ratio` times the reads, or two and its square."""
    table = saved(table, "clonotypes")
    lone, large = table.filter("good_events = 1"), table.filter(F.col("good_reads") > ratio)
    pairs = two_apart(lone, large, by).filter("mm > 0")
    sized = pairs.join(lone.select(*by, F.col("cdr3nt").alias("a"), "good_reads"), [*by, "a"]).join(large.select(*by, F.col("cdr3nt").alias("b"), F.col("good_reads").alias("parent_reads")), [*by, "b"])
    bad = sized.filter((F.col("parent_reads") > ratio * F.col("good_reads")) & ((F.col("mm") == 1) | (F.col("parent_reads") > ratio * ratio * F.col("good_reads"))))
    return table.join(bad.select(F.col("a").alias("cdr3nt"), *by).distinct(), ["cdr3nt", *by], "left_semi").filter("good_events = 1")


def filter_by_raw(assembled: DataFrame, raw: DataFrame, ratio: float = 1.0, keep_nonfunctional: bool = False, singleton_ratio: int | None = None, collapsed: bool = False, ordered: bool = False) -> DataFrame:
    """Assembled clonotypes that gained reads against the raw ones, canonical, functional unless kept, with their new share. collapsed: both tables by CDR3 first; ordered: most good events first."""
    if collapsed:
        assembled, raw = collapse(assembled), collapse(raw)
    key = ["cdr3nt"] if collapsed else list(KEY)
    assembled, raw = saved(assembled, "assembled"), saved(raw, "raw")
    totals = assembled.agg(F.sum("total_reads").alias("t_asm")).crossJoin(raw.agg(F.sum("total_reads").alias("t_raw")))  # two sums
    asm = assembled.withColumn("aa", codons_to_protein(F.col("cdr3nt"))).filter(canonical("aa"))
    if singleton_ratio:
        asm = asm.join(erroneous_singletons(assembled, singleton_ratio, tuple(key[1:])).select(*key), key, "left_anti")
    known = raw.groupBy(*key).agg(F.sum("good_reads").alias("raw_reads"))
    kept = asm.join(known, key, "left").crossJoin(F.broadcast(totals)).filter(F.col("raw_reads").isNull() | (F.col("good_reads") * F.col("t_raw") > ratio * F.col("raw_reads") * F.col("t_asm")))
    kept = kept if keep_nonfunctional else kept.filter(functional("aa"))
    return _ordered(with_share(kept.select(*KEY, "aa", *COUNTERS), "good_events", "share"), ordered)


def _ordered(table: DataFrame, ordered: bool) -> DataFrame:
    return by_good_events(table) if ordered else table


def filter_statistics(assembled: DataFrame, kept: DataFrame) -> DataFrame:
    """Clonotypes, events and reads before and after a filter, in one row."""
    sums = lambda t, name: t.agg(F.count("*").alias(f"{name}_clonotypes"), F.sum("good_events").alias(f"{name}_events"), F.sum("good_reads").alias(f"{name}_reads"))
    return sums(assembled, "total").crossJoin(sums(kept, "kept"))  # one row each


def filter_log(assembled: DataFrame, raw: DataFrame, ratio: float = 1.0, keep_nonfunctional: bool = False, singleton_ratio: int | None = None) -> DataFrame:
    """One row: clonotypes, events and reads filtered and in all, and those of clonotypes that pass but for being non-functional (which the
    filtered ones include unless they are kept)."""
    assembled = saved(assembled, "assembled")
    passed = saved(filter_by_raw(assembled, raw, ratio, True, singleton_ratio).drop("share"), "passed")
    broken = ~functional("aa")
    sums = lambda t, name: t.agg(F.count("*").alias(f"clonotypes_{name}"), F.coalesce(F.sum("good_events"), F.lit(0)).alias(f"events_{name}"), F.coalesce(F.sum("good_reads"), F.lit(0)).alias(f"reads_{name}"))
    row = sums(assembled, "total").crossJoin(sums(passed if keep_nonfunctional else passed.filter(~broken), "kept")).crossJoin(sums(passed.filter(broken), "broken"))  # one row each
    kinds = ("clonotypes", "events", "reads")
    return row.select(*(c for k in kinds for c in ((F.col(f"{k}_total") - F.col(f"{k}_kept")).alias(f"{k}_filtered"), F.col(f"{k}_total"))), *(F.col(f"{k}_broken").alias(f"non_functional_{k}") for k in kinds))


def graph_nodes(table: DataFrame) -> DataFrame:
    """Nodes of the hypermutation graph: each CDR3 with its protein, size and log10 share of all."""
    nodes = table.groupBy("cdr3nt").agg(F.sum("good_events").alias("size"))
    return with_share(nodes, "size", "share").select("cdr3nt", codons_to_protein(F.col("cdr3nt")).alias("aa"), "size", F.log10("share").alias("log_share"))


def hypermutations(table: DataFrame, most_ratio: float = 10_000) -> DataFrame:
    """Undirected edges a < b between CDR3s one place apart with comparable sizes: the codons and amino acids that differ."""
    nodes = saved(table.groupBy("cdr3nt").agg(F.sum("good_events").alias("size")), "nodes")
    edges = one_apart(nodes).filter((F.col("a") < F.col("b")) & (F.abs(F.log10(F.col("a_size") / F.col("b_size"))) < abs(math.log10(most_ratio))))
    place = F.aggregate(F.sequence(F.lit(1), F.length("a")), F.lit(0), lambda s, i: F.when(F.substring("a", i, F.lit(1)) != F.substring("b", i, F.lit(1)), i - 1).otherwise(s))
    at = F.col("pos") - F.col("pos") % 3 + 1
    codon = lambda c: F.substring(c, at, F.lit(3))
    found = edges.withColumn("pos", place).select("a", "b", "pos", codon("a").alias("codon_a"), codon("b").alias("codon_b"))
    aa = codons_to_protein(F.col("codon_a")), codons_to_protein(F.col("codon_b"))
    return found.select("a", "b", "pos", (aa[0] != aa[1]).alias("missense"), F.concat(aa[0], F.lit("<>"), aa[1]).alias("substitution"), F.concat("codon_a", F.lit("<>"), "codon_b").alias("codons"))


def split_spikes(table: DataFrame, spikes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows within two places of a spike-in, and the rest."""
    table = saved(table, "clonotypes")
    near = two_apart(table, spikes).select(F.col("a").alias("cdr3nt")).distinct()
    return table.join(near, "cdr3nt", "left_semi"), table.join(near, "cdr3nt", "left_anti")


def paired_samples(assembled: DataFrame, raw: DataFrame) -> DataFrame:
    """Samples of both sides, with a mark of where they are."""
    a, r = assembled.select("sample").distinct().withColumn("a", F.lit(True)), raw.select("sample").distinct().withColumn("r", F.lit(True))
    return a.join(r, "sample", "full").select("sample", F.when(F.col("a") & F.col("r"), "both").when(F.col("a"), "assembled").otherwise("raw").alias("side"))


def filter_batch(tables: DataFrame, ratio: float = 1.0, keep_nonfunctional: bool = False, singleton_ratio: int | None = None, collapsed: bool = False) -> DataFrame:
    """The filter over all samples that have a raw and an assembled table, singletons by sample. tables: sample, side (raw or assembled), the key and counters."""
    if collapsed:
        best = F.max_by(F.struct("v", "j", "d"), F.struct("good_reads", "v", "j", "d"))
        one = tables.groupBy("sample", "side", "cdr3nt").agg(best.alias("best"), *(F.sum(c).alias(c) for c in COUNTERS))
        tables = one.select("sample", "side", "cdr3nt", "best.*", *COUNTERS)
    key, tables = ["sample", "cdr3nt"] if collapsed else ["sample", *KEY], saved(tables, "clonotypes")
    asm, raw = tables.filter("side = 'assembled'").drop("side"), tables.filter("side = 'raw'")
    total = raw.groupBy("sample").agg(F.sum("total_reads").alias("t_raw")).join(asm.groupBy("sample").agg(F.sum("total_reads").alias("t_asm")), "sample")
    known = raw.groupBy(*key).agg(F.sum("good_reads").alias("raw_reads"))
    named = asm.withColumn("aa", codons_to_protein(F.col("cdr3nt"))).filter(canonical("aa"))
    if singleton_ratio:
        bad = erroneous_singletons(asm, singleton_ratio, tuple(c for c in key if c != "cdr3nt"))
        named = named.join(bad.select(*key), key, "left_anti")
    named = named if keep_nonfunctional else named.filter(functional("aa"))
    kept = named.join(total, "sample").join(known, key, "left").filter(F.col("raw_reads").isNull() | (F.col("good_reads") * F.col("t_raw") > ratio * F.col("raw_reads") * F.col("t_asm")))
    whole = kept.groupBy("sample").agg(F.sum("good_events").alias("sample_events"))
    return kept.join(whole, "sample").select("sample", *KEY, "aa", *COUNTERS, (F.col("good_events") / F.col("sample_events")).alias("share"))


def final_counts(log: DataFrame) -> DataFrame:
    """Of a filter log by sample: clonotypes and events left, rates of those filtered, and rates of non-functional ones."""
    rate = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    kinds = ("clonotypes", "events", "reads")
    return log.select(
        "sample", *((F.col(f"{k}_total") - F.col(f"{k}_filtered")).alias(f"{k}_left") for k in kinds), *(rate(f"{k}_filtered", f"{k}_total").alias(f"{k}_filter_rate") for k in kinds),
        *(rate(f"non_functional_{k}", f"{k}_total").alias(f"{k}_non_functional_rate") for k in kinds),
    )


def merge_noncanonical(table: DataFrame) -> DataFrame:
    """Counters of each canonical CDR3, with those of the others that contain it; of several, the longest, then the first, takes them."""
    table = saved(table, "clonotypes")
    canon, rest = table.filter(canonical("aa")), table.filter(~canonical("aa"))
    pairs = contained(rest, "cdr3nt", canon.select(F.col("cdr3nt").alias("into")), "into")
    to = pairs.groupBy("cdr3nt").agg(F.min_by("into", F.struct(-F.length("into"), "into")).alias("into"))
    moved = rest.join(to, "cdr3nt").select(F.col("into").alias("cdr3nt"), *COUNTERS)
    return canon.select("cdr3nt", *COUNTERS).unionByName(moved).groupBy("cdr3nt").agg(*(F.sum(c).alias(c) for c in COUNTERS))
