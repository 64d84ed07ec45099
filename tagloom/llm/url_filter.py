"""URL filters as a sort-merge range join, in DataFrame operations alone.

A rule is (host, path): it fits its host and all subdomains when the URL's path starts with the rule's path; the longest fitting
rule gives the verdict (ties of length: the longer path). A host is keyed by its labels in reverse, each followed by a dot (`com.example.`),
so that a rule's hosts are the interval of keys that begin with the rule's key. Intervals of rules with one path are nested or disjoint.
A sweep over the sorted keys keeps the stack of active rules: a rule's begin pushes it, its end pops it. The running sum of both is the depth;
for each depth a window carries the rule pushed there last, and the entries up to the current depth are the stack.

Keys of URLs are swept once each, however many rows share them. Sweeps are split by rule path and by a salt of the key's hash, whose number
follows the number of hosts; rules are repeated for each salt, URLs are not. Pages get their verdict by a join on (host, path start), whose large groups the adaptive planner splits.

Null URLs and URLs without `://` have an empty host and path; no rule fits them, so they get the default verdict. A rule listed twice
counts once; listed as allow and block, it blocks. Rules with a null or empty host are ignored. Rows with equal ids are judged one by one. Without rules or pages
the result has no verdict other than the default, or no rows. A URL of any length is judged whole. Other columns are not read, so their names can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

A_TO_Z = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z lower-cased; empty for a null or a URL without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), *A_TO_Z)


def url_path(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.concat_ws(".", F.reverse(F.split(host, r"\.", -1))), F.lit("."))


def apply_rules(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", default: str = "allow", salts: int | None = None) -> DataFrame:
    """page_id, host, path, rule (its host and path; null without one) and verdict of each page. rules: host, path, verdict."""
    judged = pages.select(F.col(page_id), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    rules = rules.filter("host <> ''").groupBy(F.translate("host", *A_TO_Z).alias("host"), F.coalesce("path", F.lit("")).alias("start")).agg(F.min(F.col("verdict") != "block").alias("allows"))

    deepest = rules.agg(F.max(F.size(F.split("host", r"\."))).alias("n")).first().n or 1  # a rule has at most one rule above it for each of its labels
    salts = salts or max(32, judged.agg(F.approx_count_distinct("host").alias("n")).first().n >> 17)
    key = host_key(F.col("host")).cast("binary")
    rule = F.struct(F.length("host").alias("n"), "host", "allows")
    push = F.struct(key.alias("key"), F.lit(1).alias("kind"), F.lit(1).alias("step"), rule.alias("rule"))
    pop = F.struct(F.concat(key, F.lit(bytearray(b"\xff"))).alias("key"), F.lit(0).alias("kind"), F.lit(-1).alias("step"), F.lit(None).cast(rules.select(rule).schema[0].dataType).alias("rule"))
    events = rules.select("start", F.explode(F.array(push, pop)).alias("e")).select("start", "e.*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))

    lengths = rules.select(F.length("start").alias("n")).distinct().agg(F.sort_array(F.collect_set("n")).alias("ns"))  # at most as many as the longest path has characters
    hosts = judged.select("host", "path").filter("host <> ''").crossJoin(F.broadcast(lengths)).select("host", F.explode(F.transform(F.filter("ns", lambda n: n <= F.length("path")), lambda n: F.substring("path", F.lit(1), n))).alias("start")).distinct()
    nothing = F.lit(None).cast(events.schema["rule"].dataType)
    probes = hosts.join(rules.select("start").distinct(), "start", "left_semi").select("start", key.alias("key"), F.lit(2).alias("kind"), F.lit(0).alias("step"), nothing.alias("rule"), F.pmod(F.xxhash64("host"), F.lit(salts)).cast("int").alias("salt"), "host")
    sweep = Window.partitionBy("start", "salt").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = events.withColumn("host", F.lit(None).cast("string")).unionByName(probes).withColumn("depth", F.sum("step").over(sweep).cast("int"))
    levels = [F.last(F.when((F.col("kind") == 1) & (F.col("depth") == d), F.col("rule")), True).over(sweep) for d in range(1, deepest + 1)]
    stacked = swept.withColumn("stack", F.slice(F.array(*levels), F.lit(1), F.col("depth"))).filter("kind = 2 AND depth > 0")
    top = stacked.select("host", "start", F.element_at("stack", -1).alias("top"))
    fits = top.groupBy("host").agg(F.collect_list(F.struct((F.col("top.n") + F.length("start")).alias("n"), F.length("start").alias("m"), F.concat("top.host", "start").alias("rule"), F.col("top.allows").alias("allows"), "start")).alias("fits"))
    best = F.array_max(F.filter("fits", lambda x: F.startswith(F.col("path"), x["start"])))
    return judged.join(fits, "host", "left").withColumn("best", best).select(page_id, "host", "path", F.col("best.rule").alias("rule"), F.coalesce(F.when(F.col("best.allows"), "allow").when(~F.col("best.allows"), "block"), F.lit(default)).alias("verdict"))
