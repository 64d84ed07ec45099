"""Intermediate tables in the folder that the whole cluster shares."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: A writer holds so much of each open file in memory.
GROUP_BYTES = 16 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset, and only on a local master, a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: later steps neither repeat the work nor need lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.option("parquet.block.size", GROUP_BYTES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Saved tables of one operator, dropped as soon as nothing reads them any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = new_folder(self.spark, name)
        df.write.option("parquet.block.size", GROUP_BYTES).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)  # holds the table, so that no other gets its id
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables of this object; others are left alone."""
        for table in tables:
            if id(table) in self.paths:
                path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(table))[1])
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def tidy(self) -> None:
        """Let Spark's cleaner find the shuffle files of finished steps, which it removes once the driver has forgotten their plans."""
        gc.collect()
        self.spark._jvm.System.gc()

    def drop_all(self, *but: DataFrame) -> None:
        self.drop(*(t for t, _ in list(self.paths.values()) if not any(t is x for x in but)))


def small(df: DataFrame, rows: int, wide: str | None = None, most_bytes: int = 64 << 20) -> DataFrame:
    """Broadcast a saved table if it has at most so many rows and, in a column of free length, bytes; a larger one is joined as Spark decides."""
    if wide:
        n, size = df.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(wide)), F.lit(0))).first()
        return F.broadcast(df) if n <= rows and size <= most_bytes else df
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def crc_of(column: str):
    """crc32 of a key as text; a null key counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def bounded_batches(spark: SparkSession) -> None:
    """Hand Python workers 2 MB of texts at a time, however long they are, and read some hundred texts of a file at once. A shuffled join whose
    partitions are small holds the smaller side by hash, so that wide rows need no sort."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(2 << 20))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", "512")
    spark.conf.set("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
