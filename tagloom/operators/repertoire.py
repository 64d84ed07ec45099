"""From reads to clonotypes: reads joined with the CDR3 of their sequence, quality of the CDR3, counters, full signatures, totals, sinks.

reads: seq, qual, inc (reads behind it: 1 for a raw read), and for assembled ones umi. CDR3s are found once for each distinct sequence (`mapping`) and
joined back, so a sequence that many reads share is aligned once. Reads with a null sequence or quality have no CDR3."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.sequence import translate_both_ends
from tagloom.operators.alignment import gapped_hits
from tagloom.operators.clonotypes import canonical_or_broken
from tagloom.operators.mapping import best_hits, cdr3s, d_segments
from tagloom.sources.tables import saved, sent_if_small

SIGNATURE = ("cdr3nt", "cdr3aa", "v", "j", "d", "v_end", "d_start", "d_end", "j_start")
COUNTERS = ("good_events", "total_events", "good_reads", "total_reads")


def with_d(found: DataFrame, d_alleles: DataFrame | None) -> DataFrame:
    """CDR3s with the D segments of what lies between V and J; a dot and -1 where there is none. Places are those in the CDR3."""
    if d_alleles is None:
        return found.withColumns({"d": F.lit("."), "d_start": F.lit(-1), "d_end": F.lit(-1)})
    middle = F.when(F.col("j_start") > F.col("v_end") + 1, F.substring("cdr3nt", F.col("v_end") + 2, F.col("j_start") - F.col("v_end") - 1))
    with_middle = found.withColumn("middle", middle)
    hits = d_segments(with_middle.filter("middle IS NOT NULL"), d_alleles).withColumnsRenamed({"d_start": "s", "d_end": "e"})
    shift = F.col("v_end") + 1
    named = with_middle.join(hits, "middle", "left")
    return named.withColumns({"d": F.coalesce("d", F.lit(".")), "d_start": F.coalesce((F.col("s") + shift).cast("int"), F.lit(-1)), "d_end": F.coalesce((F.col("e") + shift).cast("int"), F.lit(-1))}).drop("middle", "s", "e")


def map_reads(reads: DataFrame, alleles: DataFrame, d_alleles: DataFrame | None = None, k: int = 7, chimeric: bool = False, gapped: bool = True) -> DataFrame:
    """CDR3 (read, v, j, d, cdr3nt, from, rc and places) of each distinct sequence that has one; not gapped: by the diagonal with most shared words."""
    return with_d(cdr3s((gapped_hits if gapped else best_hits)(reads, alleles, k), chimeric), d_alleles)


def append_reads(reads: DataFrame, found: DataFrame, least_quality: int = 25) -> DataFrame:
    """All reads with what was found in their sequence; mapped: it has a CDR3; good: whose bases all have the least quality (25 for raw reads,
    30 for consensuses)."""
    found = sent_if_small(found, "found")  # of distinct sequences, which may be few
    joined = reads.join(found, reads["seq"] == found["read"], "left").drop("read")
    along = F.when(F.col("rc"), F.reverse("qual")).otherwise(F.col("qual"))
    slice_ = F.substring(along, (F.col("from") + 1).cast("int"), F.length("cdr3nt"))
    mapped = F.col("cdr3nt").isNotNull() & F.col("qual").isNotNull()
    return joined.withColumn("mapped", mapped).withColumn("good", F.col("mapped") & slice_.rlike(f"^[\\x{33 + least_quality:02x}-~]+$"))


def once_a_tag(appended: DataFrame, order: Column) -> DataFrame:
    """For files of one sample: whether an event counts, as a tag's CDR3 may come in several files. The first good event of each tag and CDR3, by an order, does."""
    first = sent_if_small(appended.filter("good").groupBy("umi", "cdr3nt").agg(F.min(order).alias("first_place")), "first-places")
    return appended.join(first, ["umi", "cdr3nt"], "left").withColumn("counts", ~F.col("good") | (order == F.col("first_place"))).drop("first_place")


def count_clonotypes(appended: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Events and reads, good and all, of each V, J, CDR3 start and CDR3, with the places of the segments (of the first by order, where they differ)."""
    counts = F.col("counts") if "counts" in appended.columns else F.lit(True)
    places = ("d", "v_end", "d_start", "d_end", "j_start")
    return appended.filter("mapped").groupBy(*by, "v", "j", "from", "cdr3nt").agg(
        F.min(F.struct(*places)).alias("p"), F.count_if(F.col("good") & counts).alias("good_events"), F.count_if(counts).alias("total_events"),
        F.coalesce(F.sum(F.when(F.col("good"), F.col("inc"))), F.lit(0)).cast("long").alias("good_reads"), F.sum("inc").cast("long").alias("total_reads"),
    ).select(*by, "v", "j", "from", "cdr3nt", "p.*", *COUNTERS)


def clonotype_table(counted: DataFrame, good_total: DataFrame, ordered: bool = True, by: tuple[str, ...] = ()) -> DataFrame:
    """The clonotype table: canonical, out-of-frame or stopped CDR3s with good events, rolled up to their full signature, with the share of all good events (of the same by-values)."""
    counted = saved(counted, "counted")  # else a test of the protein, which is made of a key of the groups, moves below them, to all reads
    named = counted.withColumn("cdr3aa", translate_both_ends(F.col("cdr3nt"))).filter(canonical_or_broken("cdr3aa"))
    rolled = named.groupBy(*by, *SIGNATURE).agg(*(F.sum(c).alias(c) for c in COUNTERS)).filter("good_events > 0")
    total = good_total.select(*by, F.col("events_good").alias("all_good"))
    shared = rolled.join(F.broadcast(total), list(by)) if by else rolled.crossJoin(F.broadcast(total))  # a row a sample, or one
    shared = shared.select(*by, F.col("good_events").alias("count"), (F.col("good_events") / F.col("all_good")).alias("fraction"), *SIGNATURE, *COUNTERS)
    return shared.orderBy(*by, F.desc("count"), "cdr3nt", "v", "j", "d") if ordered else shared


def mapping_totals(appended: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The mapping log: events and reads that are good, mapped, and all."""
    one = lambda test, name: [F.count_if(test).alias(f"events_{name}"), F.coalesce(F.sum(F.when(test, F.col("inc"))), F.lit(0)).cast("long").alias(f"reads_{name}")]
    sums = [x for test, name in ((F.col("good"), "good"), (F.col("mapped"), "mapped"), (F.lit(True), "total")) for x in one(test, name)]
    return appended.groupBy(*by).agg(*sums) if by else appended.agg(*sums)


def clonotypes_from_reads(reads: DataFrame, alleles: DataFrame, d_alleles: DataFrame | None = None, least_quality: int = 25, k: int = 7, chimeric: bool = False, gapped: bool = True, file_order: str | None = None, ordered: bool = True) -> DataFrame:
    """The whole way: segments, CDR3s, reads appended, clonotype table. file_order: a column with the number of a read's file, of files of one sample, in which a tag's CDR3 counts once."""
    appended = append_reads(reads, map_reads(reads, alleles, d_alleles, k, chimeric, gapped), least_quality)
    appended = saved(once_a_tag(appended, F.col(file_order)) if file_order else appended, "appended")
    return clonotype_table(count_clonotypes(appended), mapping_totals(appended), ordered)


def clonotypes_batch(reads: DataFrame, samples: DataFrame, alleles: DataFrame, d_alleles: DataFrame | None = None, k: int = 7, raw_quality: int = 25, assembled_quality: int = 30) -> tuple[DataFrame, DataFrame]:
    """Clonotype tables (sample, type, gene, and the columns of a table) and mapping log of all samples at once. reads: sample, type (raw or assembled), seq, qual, inc; samples: sample, species,
    gene, type: which to map, by which library; alleles have species and gene too."""
    wanted = reads.join(F.broadcast(samples.select("sample", "type", "gene").distinct()), ["sample", "type"])  # a row a sample; by sample, the reads of one would be one task
    found = map_reads(wanted, alleles.join(samples.select("species", "gene").distinct(), ["species", "gene"], "left_semi"), d_alleles, k).withColumnRenamed("gene", "of_gene")
    appended = append_reads(wanted.filter("type = 'raw'"), found, raw_quality).unionByName(append_reads(wanted.filter("type = 'assembled'"), found, assembled_quality))
    other = F.col("of_gene").isNotNull() & (F.col("of_gene") != F.col("gene"))
    appended = appended.withColumns({"mapped": F.col("mapped") & ~other, "good": F.col("good") & ~other})
    by = ("sample", "type", "gene")
    appended = saved(appended, "appended")
    log = saved(mapping_totals(appended, by), "mapping-log")
    return clonotype_table(count_clonotypes(appended, by), log, False, by), log


def annotated_reads(appended: DataFrame) -> DataFrame:
    """Records for a FASTQ file of reads with a good CDR3: the header says where it lies and its segments."""
    header = F.concat("header", F.lit(" CDR3:"), "cdr3nt", F.lit(":"), F.col("from").cast("string"), F.lit(" V:"), "v", F.lit(" J:"), "j", F.lit(" D:"), "d")
    return appended.filter("good").select(header.alias("header"), "seq", "qual")


def unmapped_reads(appended: DataFrame) -> DataFrame:
    return appended.filter("NOT mapped").select("header", "seq", "qual")


def tag_table(appended: DataFrame) -> DataFrame:
    """umi, mig_sz, cdr3nt, v, j, d of each good consensus."""
    return appended.filter("good").select("umi", F.col("inc").alias("mig_sz"), "cdr3nt", "v", "j", "d")

