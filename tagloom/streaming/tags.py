"""Tag counts of a run that is still going on: read files that come into a folder are counted as they come.

State is one count for each sample, type and tag. Each micro-batch writes the counts that it changed (update mode) to a folder of its own, which a repeated batch overwrites; counts only grow, so the
largest of a tag is the last. After the last file they equal those of a batch over all files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tagloom.operators import umi


def count_tags(spark: SparkSession, folder: str, schema: StructType | str, target: str, by: tuple[str, ...] = ("sample", "type"), quality: int = 15, files_at_once: int = 100, until_done: bool = True) -> StreamingQuery:
    """Start counting the reads (by-columns, header) in the Parquet files of a folder. until_done: stop when all files that are there are counted; the next start goes on from there."""
    reads = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(folder)
    counts = umi.coverage(reads.withColumn("umi", umi.parse_umi(F.col("header"), quality)), by)

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{target}/counts/batch={batch}")

    writer = counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{target}/state")
    return (writer.trigger(availableNow=True) if until_done else writer).start()


def counts_so_far(spark: SparkSession, target: str, by: tuple[str, ...] = ("sample", "type")) -> DataFrame:
    """The latest count of each tag."""
    return spark.read.parquet(f"{target}/counts").groupBy(*by, "umi").agg(F.max("n").alias("n"))
