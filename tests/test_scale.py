"""What only shows at size, shown on small tables: joins that change while they run, even columns, skewed samples, made reads."""

import contextlib
import math
import tempfile

from pyspark.sql import functions as F

from tagloom.operators import assemble, clonotypes, mapping, reads, repertoire, umi
from tagloom.plans import queries as plans
from tagloom.plans import run_queries


@contextlib.contextmanager
def settings(spark, **conf):
    conf = {k.replace("__", "."): v for k, v in conf.items()}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_tags_are_moved_after_their_join(spark):
    """Under a join by the same keys Spark leaves a repartition out, and adaptive execution may then part a tag's reads."""
    rows = spark.range(600).select(F.lit("S").alias("sample"), (F.col("id") % 2 + 1).cast("int").alias("mate"), (F.col("id") % 20).cast("string").alias("umi"), F.repeat(F.lit("ATGC"), 10).alias("seq"))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        found = assemble.statuses(rows)
        assert found.count() == 20
        assert "hashpartitioning(place" in found._jdf.queryExecution().executedPlan().toString()


def test_even_entropy_has_no_correlation(spark):
    rows = [("S", "F", pos, nt, 0.25, 0.25) for pos in range(4) for nt in "ATGC"]
    found = umi.information(spark.createDataFrame(rows, "sample string, type string, pos int, nt string, unit_share double, read_share double")).first()
    assert found.entropy == 8 and math.isnan(found.correlation)


def test_good_windows_of_any_length(spark):
    rows = spark.createDataFrame([("a", "5555555"), ("b", "55555!5"), ("c", "55"), ("d", "~~~"), ("e", ""), ("f", None), ("g", "5555!!5555")], "name string, qual string")
    assert sorted(r.name for r in reads.good_windows(rows, 5, 20).collect()) == ["a", "d"]
    assert reads.good_windows(rows, 5, 20).schema == rows.schema


def test_samples_are_broadcast_to_reads(spark):
    rows = spark.range(100).select((F.col("id") % 2).cast("string").alias("sample"), F.when(F.col("id") >= 0, "raw").alias("type"), F.lit("ATGC").alias("seq"), F.lit("IIII").alias("qual"), F.lit(1).alias("inc"))
    samples = rows.select("sample", "type").distinct().withColumns({"species": F.lit("x"), "gene": F.lit("TRB")})
    alleles = spark.createDataFrame([("x", "TRB", "V", "V1*01", "V1", 5, "ATGCATGCATGC")], "species string, gene string, kind string, alleles string, segments string, ref_point int, seq string")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plans = []
        real, repertoire.saved = repertoire.saved, lambda t, name: plans.append(t._jdf.queryExecution().executedPlan().toString()) or real(t, name)
        try:
            repertoire.clonotypes_batch(rows, samples, alleles)[1].collect()
        finally:
            repertoire.saved = real
    assert "BroadcastHashJoin [sample" in plans[0] and "SortMergeJoin [sample" not in plans[0]


def test_masked_strings_are_not_broadcast(spark):
    table = spark.createDataFrame([("u", "ATG", 1), ("u", "ATC", 2)], "umi string, cdr3nt string, size long")
    pairs = clonotypes.one_apart(table, ("umi",))
    assert "BroadcastHashJoin" not in pairs._jdf.queryExecution().executedPlan().toString() and pairs.count() == 2


def test_hits_carry_numbers_not_names(spark):
    seq = "ATGCCATTGACGTACGGATCCATTGCAAGT"
    alleles = spark.createDataFrame([("TRB", "V", n * 3000, n, 9, seq) for n in "BA"], "gene string, kind string, alleles string, segments string, ref_point int, seq string")
    found = mapping.best_hits(spark.createDataFrame([(seq,)], "seq string"), alleles)
    (row,) = found.collect()
    assert (row.segments, row.alleles, row.shift, row.score) == ("A", "A" * 3000, 0, 20)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any("alleles" in line for line in plan.splitlines() if "hashpartitioning" in line)


def test_looked_up_reads_are_those_made_base_by_base(spark):
    keys = spark.range(300).selectExpr("id * 977 + 3 AS l_partkey", "nullif(id * 31 + 7, 38) AS l_orderkey", "cast(id % 7 + 1 AS int) AS l_linenumber")
    for name, quick in plans._QUICK.items():
        assert keys.filter(f"NOT (({plans._COLUMNS[name].format(div='div')}) <=> ({quick}))").count() == 0


def test_pairs_are_looked_up_whole(spark):
    """Both strands of a read, and no translation of each read's bases."""
    keys = spark.range(3000).selectExpr("id * 977 + 3 AS l_partkey", "nullif(id * 31 + 7, 38) AS l_orderkey", "cast(id % 7 + 1 AS int) AS l_linenumber")
    seq, turned = f"({plans._SEQ.format(div='div')})", run_queries._RC.format(f"({plans._SEQ.format(div='div')})")
    assert keys.filter(f"NOT ({seq} <=> {run_queries._whole_reads(False)} AND {turned} <=> {run_queries._whole_reads(True)})").count() == 0
    rows = keys.selectExpr("*", "cast(l_partkey % 50 + 1 AS double) l_quantity")
    with tempfile.TemporaryDirectory(dir="/tmp") as folder:
        rows.write.parquet(f"{folder}/lineitem.parquet")
        pairs = run_queries._pairs(spark, folder)
        plain = spark.sql(run_queries._PAIRS.replace("FROM lineitem", "FROM {lineitem}").replace("{div}", "div") + " SELECT * FROM pairs", lineitem=rows)
        assert pairs.count() == 3000 and pairs.exceptAll(plain).count() == 0
        assert "ACGT, TGCA" not in pairs._jdf.queryExecution().optimizedPlan().toString()


def test_found_sequences_are_sent_to_reads(spark):
    """Few distinct sequences go to all reads, however many of those there are."""
    rows = spark.range(100).select(F.lit("ATGCATGC").alias("seq"), F.lit("IIIIIIII").alias("qual"), F.lit(1).alias("inc"), F.lit("T").alias("umi"))
    found = spark.createDataFrame([("ATGCATGC", "TGCA", "V1", "J1", 1, False)], "read string, cdr3nt string, v string, j string, from int, rc boolean")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        appended = repertoire.append_reads(rows, found)
        once = repertoire.once_a_tag(appended, F.col("inc"))
        listed = reads.listed(rows.withColumn("cdr3", F.col("seq")), found.select("read"))
        for table in (appended, once, listed):
            assert "SortMergeJoin" not in table._jdf.queryExecution().executedPlan().toString() and table.count() == 100
        assert once.filter("counts AND good").count() == 100


def test_proteins_are_made_of_clonotypes_not_of_reads(spark):
    """A test of the protein, which is made of a key of the groups, would be pushed below them."""
    rows = spark.range(50).select(F.lit("TGTGCCTTT").alias("cdr3nt"), F.lit("V1").alias("v"), F.lit("J1").alias("j"), F.lit(".").alias("d"), F.lit(1).alias("from"), *(F.lit(-1).alias(c) for c in ("v_end", "d_start", "d_end", "j_start")), F.lit(True).alias("mapped"), F.lit(True).alias("good"), F.lit(1).alias("inc"))
    total = spark.createDataFrame([(50,)], "events_good long")
    table = repertoire.clonotype_table(repertoire.count_clonotypes(rows), total)
    assert "Range" not in table._jdf.queryExecution().optimizedPlan().toString()
    assert [(r["count"], r.fraction, r.cdr3aa) for r in table.collect()] == [(50, 1.0, "CAF")]


def test_details_of_usual_and_large_tags_are_the_same(spark, monkeypatch):
    base = "ATGCCATTGACGTACGGATCCATTGCAAGTTACGGCAT"
    seqs = [base, base[1:] + "A", "C" + base[:-1], base[:20] + "T" + base[21:], base[::-1], base[:30] + "N" + base[31:], "TT" + base]
    rows = spark.createDataFrame([("S", 1 + n % 2, f"T{n % 3}", seqs[n * n % len(seqs)]) for n in range(120)] + [("S", 1, "few", base), ("S", 1, None, base)], "sample string, mate int, umi string, seq string")
    usual = assemble.alignment_details(rows)
    assert "Generate" not in usual._jdf.queryExecution().executedPlan().toString()  # cores aren't moved
    usual = sorted(map(tuple, usual.collect()))
    monkeypatch.setattr(assemble, "MOST_READS", 0)
    assert usual and usual == sorted(map(tuple, assemble.alignment_details(rows).collect()))


def test_qualities_are_added_up_as_matrices(spark):
    """Not letter by letter in arrays of whole numbers, and of several batches at once; lengths and letters of any kind give the same means."""
    import numpy as np
    import pyarrow as pa

    from tagloom.operators import profiles

    quals = ["5555", "II", None, "", "5I5I", "é5", "!!!", "IIII"]
    code = np.array([0, 1, 0, 2, 0, 1, 1, 1])
    row, place, symbol = profiles.letters(pa.array(quals))
    want = profiles._ragged(code, 3, np.tile(row, 2), np.concatenate([2 * place, 2 * place + 1]), np.concatenate([symbol.astype(np.int64) - 33, np.ones(len(row), np.int64)]))
    assert [v.tolist() for v in profiles.by_place(pa.array(["x", *quals]).slice(1), code, 3)] == [v.tolist() for v in want]
    parts = [pa.RecordBatch.from_arrays([pa.array(["a"] * 5)], ["x"])] * 3
    assert [b.num_rows for b in profiles._gathered(iter(parts))] == [15]
    rows = spark.createDataFrame([("A", "55"), ("A", "II"), ("A", "I"), ("C", None), ("C", "")], "seq string, qual string")
    assert [tuple(r) for r in reads.mean_quality(rows).collect()] == [("A", 3, "33,30")]
