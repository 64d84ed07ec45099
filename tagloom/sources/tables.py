"""Tab-separated tables: barcodes, segment libraries, clonotypes, and logs stacked over samples. A missing value is written as a dot."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLONOTYPES = "count long, fraction double, cdr3nt string, cdr3aa string, v string, j string, d string, v_end int, d_start int, d_end int, j_start int, good_events long, total_events long, good_reads long, total_reads long"
SEGMENTS = "species string, gene string, segment_type string, allele_id string, ref_point int, seq string"


def read_barcodes(spark: SparkSession, path: str, fastq1: str | None = None, fastq2: str | None = None) -> DataFrame:
    """ord, sample, master, slave, fastq1, fastq2; rows that name other files are left out. Parted by tabs or spaces, # begins a comment."""
    rows = spark.read.text(path).filter(~F.col("value").rlike(r"^\s*(#|$)"))
    part = F.split("value", r"[\t ]")
    at = lambda i: F.nullif(F.nullif(F.try_element_at(part, F.lit(i)), F.lit("")), F.lit("."))
    named = rows.select(F.monotonically_increasing_id().alias("ord"), *(at(i + 1).alias(c) for i, c in enumerate(("sample", "master", "slave", "fastq1", "fastq2"))))
    for column, name in (("fastq1", fastq1), ("fastq2", fastq2)):
        if name:
            named = named.filter(F.col(column).isNull() | (F.col(column) == name))
    return named


def read_segments(spark: SparkSession, path: str, species: str, genes: list[str]) -> DataFrame:
    """Segments of a species and some genes, whatever their case."""
    rows = spark.read.csv(path, sep="\t", schema=SEGMENTS, comment="#")
    return rows.filter((F.upper("species") == species.upper()) & F.upper("gene").isin([g.upper() for g in genes]))


def library_name(all_segments: bool = False, all_alleles: bool = False) -> str:
    """A library's files: with non-functional segments or not, with all alleles of a segment or the first of each."""
    return "segments" + (".all" if all_segments else "") + (".minor" if all_alleles else "")


def read_library(spark: SparkSession, folder: str, species: str, genes: list[str], all_segments: bool = False, all_alleles: bool = False) -> DataFrame:
    """Segments of a species and some genes in the wanted variant of a library; a gene that its listing doesn't have is an error."""
    listed = {(r.gene or "").upper() for r in available_genes(spark, folder, all_segments, all_alleles).filter(F.upper("species") == species.upper()).collect()}
    missing = [g for g in genes if g.upper() not in listed]
    if missing:
        raise ValueError(f"no {', '.join(missing)} of {species} in {library_name(all_segments, all_alleles)}")
    return read_segments(spark, f"{folder}/{library_name(all_segments, all_alleles)}.txt", species, genes)


def read_listing(spark: SparkSession, folder: str, all_segments: bool = False, all_alleles: bool = False) -> DataFrame:
    """species, gene and whether there are V, D, J and both V and J segments, as 0 or 1."""
    return spark.read.csv(f"{folder}/{library_name(all_segments, all_alleles)}.metadata", sep="\t", schema="species string, gene string, v int, d int, j int, vj int", comment="#")


def available_genes(spark: SparkSession, folder: str, all_segments: bool = False, all_alleles: bool = False) -> DataFrame:
    """species and gene that reads can be mapped to, and whether they have D segments."""
    return read_listing(spark, folder, all_segments, all_alleles).filter("vj = 1").select("species", "gene", (F.col("d") == 1).alias("has_d"))


HITS = "query long, allele string, q_start int, q_end int, a_start int, a_end int, q_seq string, a_seq string, n_ident int"


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """Hits of an external aligner: nine tab-separated columns, places from 1 on and inclusive, an allele's falling on the other strand; aligned sequences with gaps as -."""
    return spark.read.csv(path, sep="\t", schema=HITS)


def library_metadata(segments: DataFrame) -> DataFrame:
    """Which genes have V, D and J segments, and so can be mapped."""
    has = lambda t: F.max(F.startswith("segment_type", F.lit(t)).cast("int"))
    return segments.groupBy("species", "gene").agg(has("V").alias("v"), has("D").alias("d"), has("J").alias("j")).withColumn("vj", F.col("v") * F.col("j"))


def read_clonotypes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, schema=CLONOTYPES, nullValue=".")


def write_table(table: DataFrame, path: str, mode: str = "error") -> None:
    table.write.mode(mode).csv(path, sep="\t", header=True, nullValue=".")


def stacked(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """One table of all samples' tables, with the file each row comes from."""
    return spark.read.csv(pattern, sep="\t", header=True, schema=schema, nullValue=".").withColumn("file", F.input_file_name())


def append_new(table: DataFrame, path: str, key: str = "sample") -> None:
    """Append rows whose key the table at the path doesn't have yet; the first time all of them."""
    try:
        known = table.sparkSession.read.schema(table.schema).parquet(path).select(key).distinct()
        table = table.join(known, key, "left_anti")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    table.write.mode("append").parquet(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one in spark.checkpoint.dir, which the cluster shares; where that is unset, and only on a local master, below a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(table: DataFrame, name: str) -> DataFrame:
    """A table that several steps read, written to the shared folder once; one that was is returned as it is."""
    if getattr(table, "is_saved", False):
        return table
    path = shared_folder(table.sparkSession, name)
    table.write.parquet(path)
    out = table.sparkSession.read.schema(table.schema).parquet(path)
    out.is_saved = True
    return out


def sent_if_small(table: DataFrame, name: str, most_bytes: int = 16 << 20) -> DataFrame:
    """A table, saved, that goes to all tasks if it holds few bytes, so that what it is joined with isn't moved; a larger one is joined as Spark decides."""
    held = saved(table, name)
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) if kind in ("string", "binary") else F.lit(0)) + 16 for c, kind in held.dtypes)
    return F.broadcast(held) if (held.agg(F.sum(size)).first()[0] or 0) <= most_bytes else held
