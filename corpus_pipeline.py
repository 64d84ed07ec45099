"""A corpus pipeline of the operators in tagloom.llm: each stage works on all that its predecessor kept.

Stages take (spark, docs, sf_dir). All but the last return the columns of `documents`: language ID drops texts in no known
language, line dedup drops repeated lines (and documents of which nothing is left), the n-gram Jaccard join keeps one document of each
group, decontamination drops documents that hold a benchmark window, packing returns the pieces of training sequences.
Null and empty texts go at the first stage; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.decontaminate import remove_contaminated
from tagloom.llm.language import learn, reject_unknown
from tagloom.llm.line_dedup import remove_repeated_lines
from tagloom.llm.near_duplicates import one_of_each
from tagloom.llm.pack import pack
from tagloom.llm.queries import tokenizer_path
from tagloom.llm.scratch import bounded_batches, saved


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return reject_unknown(docs, learn(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    kept = remove_repeated_lines(docs).filter((F.col("n_removed") == 0) | (F.trim("text") != ""))
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return pack(docs, tokenizer_path())


STAGES = [("language", language), ("lines", lines), ("near duplicates", near_duplicates), ("decontamination", decontamination), ("packing", packing)]
#: Packing goes by a retrieval order that SQL can't express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on `documents`, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs, name.replace(" ", "-"))
    return docs
