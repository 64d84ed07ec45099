"""N-gram Jaccard join: documents whose sets of word shingles are similar, directly or through others, form one group.

See `setjoin` for the method (token-group matrix over groups of similar documents). Null texts and texts without words have an empty
set and are linked with nothing. Copies are one class. Rows that share an id are rows of one document: they share a group only if their sets do; a
null id is never the smallest. Other columns pass through `one_of_each` and are ignored by `similar_groups`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.scratch import Scratch, saved, small
from tagloom.llm.setjoin import SetJoin


def similar_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """key, n_shingles and component_id (the smallest key of its group) of each row."""
    join, scratch = SetJoin(size, percent), Scratch(docs.sparkSession)
    scan = join.scan(docs, [key], text, scratch)
    items = join.items(scan)
    classes = scratch.save(items.filter("n > 0").groupBy("digest").agg(F.min("n").alias("n"), *(F.min(c).alias(c) for c in join.sketch), F.min("k0").alias("low")), "classes")
    groups = join.links(docs.select(F.col(text).alias("text")), scan, classes.drop("low"), scratch).withColumnRenamed("node", "digest")
    lows = classes.select("digest", "low").join(groups, "digest")
    lowest = lows.groupBy("grp").agg(F.min("low").alias("first"))
    known = classes.select("digest", "low").join(groups, "digest", "left").join(lowest, "grp", "left").select("digest", F.coalesce("first", "low").alias("first"))
    found = scratch.save(items.select("k0", "n", "digest").join(known, "digest", "left").select(F.col("k0"), "n", F.when(F.col("n") > 0, F.col("first")).otherwise(F.col("k0")).alias("first")), "found")
    scratch.drop_all(found)
    return found.toDF(key, "n_shingles", "component_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """Documents with the smallest key of their group; rows that repeat a kept key are kept, as are rows with a null key or an empty set."""
    lower = similar_groups(docs.select(key, text), key, text, size, percent).filter(F.col("component_id") < F.col(key)).select(F.col(key).alias("gone")).distinct()
    lower = small(saved(lower, "gone"), 2_000_000, None if lower.schema["gone"].dataType.simpleString() != "string" else "gone")  # so the texts needn't move
    return docs.join(lower, docs[key] == lower["gone"], "left_anti")
