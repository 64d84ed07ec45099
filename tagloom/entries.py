"""The steps of a run as functions from files to files: each reads what the step before wrote, writes its tables below a folder, and returns them by name.

Folders: checkout (FASTQ files by sample and a manifest, log), histogram (tables), assembly (consensus and log), clonotypes (tables and logs, raw and assembled), filtered (tables and log).
Tables are Parquet, `table_to_text` writes them tab-separated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators import assemble as assembly
from tagloom.operators import checkout as barcodes
from tagloom.operators import clonotypes, mapping, reads, repertoire, umi
from tagloom.sources import fastq, runs, tables

Tables = dict[str, DataFrame]


def _stored(made: Tables, folder: str, mode: str = "error") -> Tables:
    for name, table in made.items():
        table.write.mode(mode).parquet(f"{folder}/{name}")
    spark = next(iter(made.values())).sparkSession
    return {name: spark.read.schema(table.schema).parquet(f"{folder}/{name}") for name, table in made.items()}


def stored(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}")


def table_to_text(spark: SparkSession, folder: str, name: str, target: str) -> None:
    """A table of a step as tab-separated text."""
    tables.write_table(stored(spark, folder, name), target)


def checkout(
    spark: SparkSession, table: str, out: str, first_mates: str | None = None, second_mates: str | None = None, oriented: bool = False, trim: bool = False, switch: bool = False, most_trim: int = 10, mask: str = "0:1",
    limits: str = "15:0.2:0.05", first: int | None = None, overlap: bool = False, overlap_offset: int = 5, overlap_seed: int = 5, overlap_match: int = 10, overlap_partial: bool = False,
    complement: bool = False, skip_undef: bool = False, compress: bool = False, split: int = fastq.SPLIT,
) -> Tables:
    """Demultiplex files, or all that the barcode table names, to files by sample; more files are appended to a folder that is there."""
    rows = tables.read_barcodes(spark, table, first_mates, second_mates)
    if first_mates:
        pairs = [(first_mates, second_mates)]
    else:
        pairs = [(r.fastq1, r.fastq2) for r in rows.filter("fastq1 IS NOT NULL").select("fastq1", "fastq2").distinct().orderBy("fastq1", "fastq2").collect()]
    low, low_share, high_share = limits.split(":")
    parts = [fastq.read_fastq(spark, [a], [b] if b else None, first, split) for a, b in pairs]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    merge = barcodes.Merging(overlap_offset, overlap_seed, overlap_match, overlap_partial) if overlap else False
    options = {"cut": trim, "both_ways": not oriented, "mask": mask, "merge": merge, "switch": switch, "skip_undef": skip_undef, "complement": complement, "most_trim": most_trim, "limits": barcodes.Limits(int(low), float(low_share), float(high_share))}
    assigned = tables.saved(barcodes.checkout_batch(found, rows, ["h1", "h2"], **options), "checkout")
    fastq.write_samples(assigned, out, compress)
    return _stored({"log": barcodes.checkout_log(assigned)}, out, "append") | {"manifest": fastq.manifest(spark, out)}


def tagged_reads(spark: SparkSession, folder: str, quality: int = 15, only_first: bool = False, split: int = fastq.SPLIT) -> DataFrame:
    """sample, type, mate, orig_mate, header, umi, seq and qual of a checkout's samples; the tag is in both mates' headers. undef-m and undef-s are no samples."""
    kinds = [r.type for r in fastq.manifest(spark, folder).select("type").distinct().orderBy("type").collect()]
    if not kinds:
        raise ValueError(f"no samples in {folder}")
    out = None
    for kind in kinds:
        found = fastq.read_samples(spark, folder, kind, split=split).filter(~F.col("sample").isin("undef-m", "undef-s")).withColumn("type", F.lit(kind))
        for mate in (1, 2) if kind == "paired" else (1,):
            first = F.when(F.contains(f"h{mate}", F.lit(" R1 ")), 1).otherwise(2)
            part = found.select("sample", "type", F.lit(mate).alias("mate"), first.alias("orig_mate"), F.col(f"h{mate}").alias("header"), umi.parse_umi(F.col("h1"), quality).alias("umi"), F.col(f"s{mate}").alias("seq"), F.col(f"q{mate}").alias("qual"))
            out = part if out is None else out.unionByName(part)
    return out.filter("orig_mate = 1") if only_first else out


def histogram(spark: SparkSession, checked: str, out: str, quality: int = 15, only_first: bool = False, ratio: float = 1.0) -> Tables:
    """Tag statistics of all samples: coverage of all and of collided tags (by reads and by tags), estimates, position weights by sample and over all."""
    found = tagged_reads(spark, checked, quality, only_first).filter("mate = 1")
    counts = tables.saved(umi.coverage(found), "counts")
    hist, hit = tables.saved(umi.histogram(counts), "histogram"), tables.saved(umi.histogram(umi.collided(counts, ratio)), "collided")
    return _stored({
        "overseq": umi.wide(hist), "overseq_units": umi.wide(hist, "units"), "collision": umi.wide(hit), "collision_units": umi.wide(hit, "units"), "estimates": umi.collision_filter_advised(umi.estimates(counts, ratio)),
        "pwm": umi.position_weights(counts, ratio), "pwm_summary": umi.position_weights(counts, ratio, together=True), "bins": hist,
    }, out)


def assemble(
    spark: SparkSession, checked: str, estimates: str, out: str, quality: int = 15, default_mask: str = "1:1", force_overseq: int | None = None, force_collision_filter: bool = False, only_first: bool = False, metadata: str | None = None,
) -> Tables:
    """Consensus of all samples of a checkout, with the thresholds of its histogram. metadata: a tab-separated table (sample, type, mask)."""
    found = tables.saved(tagged_reads(spark, checked, quality, only_first).filter("umi IS NOT NULL"), "tagged")
    masks = spark.read.csv(metadata, sep="\t", schema="sample string, type string, mask string", comment="#") if metadata else None
    rules = stored(spark, estimates, "estimates")
    made = tables.saved(assembly.assemble_batch(found, rules, masks, default_mask, force_overseq, force_collision_filter, fastq.manifest(spark, checked)), "consensus")
    log = found.groupBy("sample", "type").agg(F.count_distinct("umi").alias("migs_total"), F.count("*").alias("reads_total")).join(made.groupBy("sample", "type").agg(F.count_distinct("umi").alias("migs_good"), F.sum("count").alias("reads_good")), ["sample", "type"], "left").fillna(0)
    return _stored({"consensus": made, "log": log}, out)


def map_clonotypes(
    spark: SparkSession, checked: str, assembled: str, library: str, genes: str, out: str, species: str = "HomoSapiens", raw_quality: int = 25, assembled_quality: int = 30, all_segments: bool = False, all_alleles: bool = False, strict: bool = False,
) -> Tables:
    """Clonotype tables of all samples, raw and assembled, tags with their clonotype, and logs. strict: counters of non-canonical CDR3s go to canonical ones in them."""
    segments = tables.read_library(spark, library, species, genes.split(","), all_segments, all_alleles)
    alleles = tables.saved(mapping.trimmed_alleles(segments), "alleles")
    d_alleles = alleles.filter("kind = 'D'").select(F.col("segments").alias("alleles"), "seq")
    raw = tagged_reads(spark, checked).select("sample", "umi", "seq", "qual", F.lit(1).cast("long").alias("inc"), F.lit("raw").alias("type"))
    asm = stored(spark, assembled, "consensus").select("sample", "umi", "seq", "qual", F.col("count").alias("inc"), F.lit("assembled").alias("type"))
    every = tables.saved(raw.unionByName(asm), "mapped-reads")
    wanted = every.select("sample", "type").distinct().crossJoin(F.broadcast(alleles.select("species", "gene").distinct()))  # samples by genes
    table, log = repertoire.clonotypes_batch(every, wanted, alleles.filter("kind <> 'D'"), d_alleles if d_alleles.limit(1).count() else None, raw_quality=raw_quality, assembled_quality=assembled_quality)
    made = {"clonotypes": table, "log": log}
    if strict:
        made["merged"] = clonotypes.merge_noncanonical(table.withColumn("aa", F.col("cdr3aa")))
    return _stored(made, out)


def filter_clonotypes(spark: SparkSession, mapped: str, out: str, ratio: float = 1.0, singletons: bool = False, singleton_ratio: int = 20, keep_nonfunctional: bool = False, collapsed: bool = False) -> Tables:
    """Assembled clonotypes without hot-spot errors, by the raw ones of the same sample, and samples that have one side alone."""
    table = tables.saved(stored(spark, mapped, "clonotypes").withColumn("side", F.col("type")), "clonotypes")
    made = clonotypes.filter_batch(table.select("sample", "side", *clonotypes.KEY, *clonotypes.COUNTERS), ratio, keep_nonfunctional, singleton_ratio if singletons else None, collapsed)
    asm = table.filter("side = 'assembled'")
    counts = lambda t, name: t.groupBy("sample").agg(F.count("*").alias(f"clonotypes_{name}"), F.sum("good_events").alias(f"events_{name}"), F.sum("good_reads").alias(f"reads_{name}"))
    filtered = tables.saved(made, "filtered")
    log = counts(asm, "total").join(counts(filtered, "kept"), "sample", "left").fillna(0)
    return _stored({"clonotypes": filtered, "log": log, "pairing": clonotypes.paired_samples(asm, table.filter("side = 'raw'"))}, out)


def graph(spark: SparkSession, filtered: str, sample: str, out: str, most_ratio: float = 10_000) -> Tables:
    """The hypermutation graph of a sample's filtered clonotypes."""
    table = stored(spark, filtered, "clonotypes").filter(F.col("sample") == sample)
    return _stored({"nodes": clonotypes.graph_nodes(table), "edges": clonotypes.hypermutations(table, most_ratio)}, out)


def report(spark: SparkSession, out: str, checked: str | None = None, estimates: str | None = None, assembled: str | None = None, mapped: str | None = None, filtered: str | None = None) -> None:
    """A page of the run's tables; steps that weren't run are named as missing."""
    of = lambda folder, name: stored(spark, folder, name) if folder else None
    bins, log = of(estimates, "bins"), of(mapped, "log")
    runs.write_report({
        "Checkout": of(checked, "log"), "Estimates": of(estimates, "estimates"), "Coverage": None if bins is None else reads.normalised_histogram(bins), "Assembly": of(assembled, "log"),
        "Mapping": None if log is None else reads.mapping_rates(log), "Filter": of(filtered, "log"),
    }, out)


def umi_frequencies(spark: SparkSession, checked: str, out: str, quality: int = 15) -> Tables:
    """Tags of all samples with their reads, most frequent first."""
    return _stored({"tags": umi.frequency_table(umi.coverage(tagged_reads(spark, checked, quality).filter("mate = 1")))}, out)


def consensus_fastq(spark: SparkSession, assembled: str, out: str, compress: bool = False) -> None:
    """Consensuses as FASTQ in folders by sample and mate; the header names the tag and its reads."""
    header = F.concat(F.lit("@MIG."), "umi", F.lit(" R"), F.col("mate").cast("string"), F.lit(" UMI:"), "umi", F.lit(":"), F.col("count").cast("string"))
    fastq.write_fastq(stored(spark, assembled, "consensus").withColumn("header", header), out, by=("sample", "mate"), compress=compress)


def quality_histogram(spark: SparkSession, files: str, out: str) -> Tables:
    """Reads by place and quality of some files (comma-separated)."""
    return _stored({"matrix": reads.quality_matrix(fastq.read_fastq(spark, files.split(",")).select(F.col("q1").alias("qual")))}, out)


def frequent_reads(spark: SparkSession, files: str, out: str, least: int = 10) -> Tables:
    """Reads whose sequence comes at least so often in some files, and these sequences with their mean quality."""
    found = tables.saved(reads.frequent_reads(fastq.read_fastq(spark, files.split(",")).select(F.col("h1").alias("header"), F.col("s1").alias("seq"), F.col("q1").alias("qual")), least), "frequent")
    return _stored({"reads": found, "sequences": reads.mean_quality(found)}, out)


def split_spikes(spark: SparkSession, filtered: str, sample: str, spikes: str, out: str) -> Tables:
    """A sample's clonotypes within two places of the CDR3s of a list (one a line), and the others."""
    table = stored(spark, filtered, "clonotypes").filter(F.col("sample") == sample)
    near, rest = clonotypes.split_spikes(table, spark.read.text(spikes).select(F.trim("value").alias("cdr3nt")))
    return _stored({"spikes": near, "others": rest}, out)


def print_library(spark: SparkSession, library: str, all_segments: bool = False, all_alleles: bool = False) -> Tables:
    """Species and genes that a library has."""
    return {"genes": tables.available_genes(spark, library, all_segments, all_alleles).orderBy("species", "gene")}


ENTRIES = {f.__name__: f for f in (checkout, histogram, assemble, map_clonotypes, filter_clonotypes, graph, report, umi_frequencies, consensus_fastq, quality_histogram, frequent_reads, split_spikes, print_library, table_to_text)}
