"""Pairs within two places, profiles of hot keys, external hits, libraries, details, streams, records of runs, and a run from files to filtered clonotypes."""

import random

import pytest
from pyspark.sql import functions as F

from tagloom.operators import alignment, assemble, checkout, clonotypes, mapping, profiles, reads, repertoire, umi
from tagloom.sources import fastq, runs, tables
from tagloom.streaming import tags

RC = str.maketrans("ACGT", "TGCA")


@pytest.mark.parametrize("most", [1 << 20, 3])
def test_two_apart(spark, monkeypatch, most):
    monkeypatch.setattr(clonotypes, "MOST_PAIRS", most)
    r = random.Random(6)
    dna = lambda n: "".join(r.choice("AC") for _ in range(n))
    left = [(dna(r.choice([1, 3, 4, 5, 12])), r.choice("xy")) for _ in range(120)] + [("ACGTACGTAC", "x")] * 3
    right = [(dna(r.choice([1, 3, 4, 5, 12])), r.choice("xy")) for _ in range(60)] + [("ACGTACGTTT", "x"), (None, "x")]
    frame = lambda rows: spark.createDataFrame(rows, "cdr3nt string, v string")
    got = sorted(tuple(x) for x in clonotypes.two_apart(frame(left), frame(right), ("v",)).collect())
    far = lambda a, b: sum(x != y for x, y in zip(a, b, strict=True))
    assert got == sorted({(v, a, b, far(a, b)) for a, v in left for b, w in right if v == w and b and len(a) == len(b) and far(a, b) <= 2})


def test_filters_by_cdr3(spark):
    rows = [("TGTAAATTT", "V1", 9, 90, 100), ("TGTAAATTT", "V2", 1, 95, 10), ("TGTAACTTT", "V1", 1, 1, 1), ("TGTCCCTTC", "V1", 5, 5, 900)]
    df = spark.createDataFrame([(c, v, "J", "D", n, n, g, g) for c, v, n, g, _ in rows], "cdr3nt string, v string, j string, d string, good_events long, total_events long, good_reads long, total_reads long")
    raw = spark.createDataFrame([(c, "W", "J", "D", n, n, w, w) for c, _, n, _, w in rows], df.schema)
    got = clonotypes.filter_by_raw(df, raw, singleton_ratio=20, collapsed=True, ordered=True).collect()
    assert [(r.cdr3nt, r.v, r.good_events, r.good_reads) for r in got] == [("TGTAAATTT", "V2", 10, 185)]
    both = df.withColumn("side", F.lit("assembled")).union(raw.withColumn("side", F.lit("raw"))).withColumn("sample", F.lit("s"))
    assert [r.cdr3nt for r in clonotypes.filter_batch(both, singleton_ratio=20, collapsed=True).collect()] == ["TGTAAATTT"]


def test_profiles_of_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(profiles, "HELD", 10)
    rows = [("AC", "I5"), ("AC", "5I"), ("G", "I"), (None, "II"), ("T", None), ("C", "")] * 50
    df = spark.createDataFrame(rows, "seq string, qual string").repartition(5)
    assert sorted(map(tuple, reads.mean_quality(df).collect()), key=str) == sorted([("AC", 100, "30,30"), ("G", 50, "40"), (None, 50, "40,40")], key=str)
    assert sorted(map(tuple, reads.quality_matrix(df).collect())) == [(0, 20, 50), (0, 40, 150), (1, 20, 50), (1, 40, 100)]
    assert reads.mean_quality(df.filter("false")).count() == 0 and reads.quality_matrix(df.filter("false")).count() == 0


def test_external_hits_are_those_of_the_own_alignment(spark):
    r = random.Random(3)
    dna = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    v, j = dna(50) + "TGT" + dna(4), "TTT" + dna(30)
    lib = spark.createDataFrame([("TRB", "V", "V1", "V1", 53, v), ("TRB", "J", "J1", "J1", -1, j)], "gene string, kind string, alleles string, segments string, ref_point int, seq string")
    middle = dna(12)
    read = v[:20] + v[22:53] + middle + j[:15] + "G" + j[15:]
    back = read[::-1].translate(RC)
    n, m = len(read), 51
    q_v, a_v = v[:20] + "--" + v[22:53], v[:53]
    q_j, a_j = j[:15] + "G" + j[15:], j[:15] + "-" + j[15:]
    hits = [(1, "V1", 1, m, 1, 53, q_v, a_v, 51), (1, "J1", m + 13, n, 1, 33, q_j, a_j, 33), (1, "V1", 1, 9, 1, 9, v[:9], v[:9], 9)]
    other = [(2, "V1", n - m + 1, n, 53, 1, q_v[::-1].translate(RC), a_v[::-1].translate(RC), 51), (2, "J1", 1, n - m - 12, 33, 1, q_j[::-1].translate(RC), a_j[::-1].translate(RC), 33)]
    table = spark.createDataFrame(hits + other + [(3, "V1", 1, 5, 1, 5, "ACGTA", "ACGTA", 5)], tables.HITS)
    queries = spark.createDataFrame([(1, read), (2, back), (3, "ACGTA")], "query long, seq string")
    got = {x.read: (x.cdr3nt, x.rc) for x in mapping.cdr3s(mapping.external_hits(table, queries, lib)).collect()}
    own = {x.read: (x.cdr3nt, x.rc) for x in mapping.cdr3s(alignment.gapped_hits(queries.select("seq"), lib)).collect()}
    assert got == own == {read: ("TGT" + middle + "TTT", False), back: ("TGT" + middle + "TTT", True)}


def test_libraries(spark, tmp_path):
    for name, extra in (("segments", ""), ("segments.all", "Human\tTRB\tVariable\tP*01\t1\tAC\n"), ("segments.minor", "Human\tTRB\tVariable\tV1*02\t1\tAC\n")):
        (tmp_path / f"{name}.txt").write_text("Human\tTRB\tVariable\tV1*01\t5\tACGT\nHuman\tTRB\tJoining\tJ1*01\t1\tACGT\n" + extra)
        (tmp_path / f"{name}.metadata").write_text("#SPECIES\tGENE\tV\tD\tJ\tVJ\nHuman\tTRB\t1\t1\t1\t1\nHuman\tIGH\t1\t0\t0\t0\n")
    folder = str(tmp_path)
    count = lambda **x: tables.read_library(spark, folder, "human", ["trb"], **x).count()
    assert (count(), count(all_segments=True), count(all_alleles=True)) == (2, 3, 3)
    assert [tuple(r) for r in tables.available_genes(spark, folder).collect()] == [("Human", "TRB", True)]
    with pytest.raises(ValueError, match="igh"):
        tables.read_library(spark, folder, "Human", ["TRB", "igh"])


def test_details_are_joined_where_they_lie(spark):
    r = random.Random(1)
    rows = [("s", m, u, "".join(r.choice("ACGT") for _ in range(40))) for u in ("AAAA", "CCCC") for m in (1, 2)]
    df = spark.createDataFrame([x for x in rows for _ in range(6)], "sample string, mate int, umi string, seq string")
    details = assemble.save_details(assemble.alignment_details(df), "details_of_a_test", buckets=4)
    made = assemble.assemble(df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = reads.back_track(details, made.select("sample", "mate", "umi", "seq"), rows[0][3][5:30])
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [(x.umi, x.cnt) for x in found.collect()] == [("AAAA", 6)]
    scan = plan.split("details_of_a_test")[0].rsplit("Join", 1)[1]
    assert "Exchange" not in scan
    spark.sql("DROP TABLE details_of_a_test")


def test_stream_goes_on(spark, tmp_path):
    schema = "sample string, type string, header string"
    rows = [("s", "t", f"@r R1 UMI:{u}:IIII") for u in ("AAAA", "AAAA", "CCCC")] + [("s", "t", "@r"), ("s", "t", None)]
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")
    for _ in range(2):
        spark.createDataFrame(rows, schema).repartition(2).write.mode("append").parquet(folder)
        tags.count_tags(spark, folder, schema, target, files_at_once=1).awaitTermination()
    batch = umi.coverage(spark.read.parquet(folder).withColumn("umi", umi.parse_umi(F.col("header"))))
    assert sorted(map(tuple, tags.counts_so_far(spark, target).collect())) == sorted(map(tuple, batch.collect())) == [("s", "t", "AAAA", 4), ("s", "t", "CCCC", 2)]


def test_records_of_runs(spark, tmp_path):
    folder = str(tmp_path / "runs")
    with runs.recorded(folder, "assemble", least=5):
        pass
    assert runs.errors(spark, folder).count() == 0
    with pytest.raises(KeyError), runs.recorded(folder, "map", gene="TRB"):
        raise KeyError("no such gene")
    assert sorted((r.entry, r.params) for r in runs.calls(spark, folder).collect()) == [("assemble", '{"least": 5}'), ("map", '{"gene": "TRB"}')]
    (error,) = runs.errors(spark, folder).collect()
    assert error.entry == "map" and "no such gene" in error.message and "KeyError" in error.trace
    page = tmp_path / "report.html"
    runs.write_report({"Checkout": spark.createDataFrame([("<s>", 1, None)], "sample string, n int, x double"), "Assembly": None}, str(page))
    assert "&lt;s&gt;" in page.read_text() and "not run" in page.read_text()
    with pytest.raises(ValueError, match="more than"):
        runs.write_report({"x": spark.range(3)}, str(page), most=2)


def test_from_files_to_filtered_clonotypes(spark, tmp_path):
    """Checkout with merging, tag counts, assembly, mapping and the filter, as one run over files."""
    r = random.Random(9)
    dna = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    v, j = dna(40) + "TGTGCC", "AACTTTGG" + dna(30)
    lib = spark.createDataFrame([("TRB", "V", "V1*01", "V1", 43, v), ("TRB", "J", "J1*01", "J1", 2, j)], "gene string, kind string, alleles string, segments string, ref_point int, seq string")
    clones = [v + "AGCGATGGACTG" + j, v[:20] + v[21:] + "CCAGATGGTCTG" + j]
    one, two = [], []
    for tag in range(24):
        code, clone = "".join("ACGT"[tag // 4**k % 4] for k in range(4)), clones[tag % 2]
        for copy in range(6 if tag < 20 else 1):
            x = list(clone)
            if copy == 0:
                x[r.randrange(len(x))] = r.choice("ACGT")
            x = "".join(x)
            one.append((f"@r{len(one)}", "AATGC" + code + "TGCA" + x[:80]))
            two.append((f"@r{len(two)}", x[30:][::-1].translate(RC)))
    for name, rows in (("R1", one), ("R2", two)):
        (tmp_path / f"{name}.fastq").write_text("".join(f"{h}\n{s}\n+\n{'I' * len(s)}\n" for h, s in rows))
    pairs = fastq.read_fastq(spark, [str(tmp_path / "R1.fastq")], [str(tmp_path / "R2.fastq")], split=5000)
    found = checkout.checkout(pairs, [checkout.Barcode("S", "ATGCNNNNTGCA")], ["h1", "h2"], cut=True, merge=True)
    fastq.write_samples(found, str(tmp_path / "checkout"))
    back = fastq.read_samples(spark, str(tmp_path / "checkout"), "overlapped", ["S"])
    tagged = back.select("sample", F.lit(1).alias("mate"), umi.parse_umi(F.col("h1")).alias("umi"), F.col("s1").alias("seq"), F.col("q1").alias("qual"))
    assert tagged.count() == len(one) and tagged.select("umi").distinct().count() == 24
    made = assemble.assemble(tagged)
    assert made.count() == 20
    raw = repertoire.clonotypes_from_reads(tagged.select("umi", "seq", "qual", F.lit(1).alias("inc")), lib)
    asm = repertoire.clonotypes_from_reads(made.select("umi", "seq", "qual", F.col("count").alias("inc")), lib, least_quality=30)
    kept = clonotypes.filter_by_raw(asm, raw, ordered=True)
    assert {(x.cdr3nt, x.v, x.j, x.good_events) for x in kept.collect()} == {("TGTGCCAGCGATGGACTGAACTTT", "V1", "J1", 10), ("TGTGCCCCAGATGGTCTGAACTTT", "V1", "J1", 10)}
