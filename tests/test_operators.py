import gzip

import pytest
from pyspark.sql import functions as F

from tagloom.functions import sequence as sq
from tagloom.operators import assemble, checkout, clonotypes, mapping, reads, repertoire, umi
from tagloom.sources import fastq, tables


def rows(df, *by):
    return [tuple(r) for r in df.orderBy(*by).collect()] if by else [tuple(r) for r in df.collect()]


def test_translation_from_both_ends(spark):
    df = spark.createDataFrame([("TGTGCATTT",), ("TGTGCATTTA",), ("TGTGCATTTAC",), ("TGTTAATTT",), ("",)], "s string")
    assert [r[0] for r in df.select(sq.translate_both_ends(F.col("s"))).collect()] == ["CAF", "C??L", "C?IY", "C*F", ""]


def test_scalars(spark):
    df = spark.createDataFrame([("ATGNacgt", "I5!")], "s string, q string")
    got = df.select(sq.reverse_complement(F.col("s")), sq.reverse_complement_masked(F.col("s")), sq.least_phred(F.col("q")), sq.phred_symbol(F.lit(50)), sq.coverage_bin(F.lit(1025))).first()
    assert tuple(got) == ("NNNNNCAT", "acgtNCAT", 0, "I", 10)
    assert sq.iupac_complement("ATGRn") == "nYCAT"


def test_umi_gate(spark):
    headers = ["@r R1 UMI:ATGC:IIII", "@r R1 UMI:ATGC:II/I", "@r R1 UMI:ATNC:IIII", "@r UMI:ATGC:I:I: x", "@r R1", None]
    df = spark.createDataFrame([(h,) for h in headers], "h string")
    assert [r[0] for r in df.select(umi.parse_umi(F.col("h"), 15)).collect()] == ["ATGC", None, None, "ATGC", None, None]


@pytest.mark.parametrize("small, hit", [(5, True), (20, False)])
def test_collision_ratio(spark, small, hit):
    df = spark.createDataFrame([("s", "t", "AAAA", 100), ("s", "t", "AAAT", small)], "sample string, type string, umi string, n long")
    assert bool(umi.collided(df, 0.1).count()) is hit


def test_consensus_recovers_shifts(spark):
    import random

    r = random.Random(3)
    base = "".join(r.choice("ATGC") for _ in range(60))
    shifted = [base[5 + o : 45 + o] for o in (-2, -1, 0, 1, 2)] + ["".join(r.choice("ATGC") for _ in range(40))]
    df = spark.createDataFrame([("s", 1, "AAAA", x) for x in shifted * 2], "sample string, mate int, umi string, seq string")
    (got,) = assemble.assemble(df).collect()
    assert base[5:45] in got.seq and got.seq in base and got["count"] == 10
    assert assemble.assemble(df.filter("false")).count() == 0


def test_checkout_outcomes(spark):
    b = [checkout.Barcode("S", "ATGCNNNN", "GGGCC")]
    q = lambda s: "I" * len(s)
    pairs = [("CCATGCACGTAA", "TTGGGCCTT"), ("TTGGGCCTT", "CCATGCACGTAA"), ("CCATGCACGTAA", "TTTTTTTT"), ("CCCC", "CCCC"), (None, None)]
    df = spark.createDataFrame([(i, a, q(a or ""), c, q(c or "")) for i, (a, c) in enumerate(pairs)], "i int, s1 string, q1 string, s2 string, q2 string")
    got = {r.i: (r.sample, r.umi, r.swapped) for r in checkout.checkout(df, b, ["i"]).collect()}
    assert got == {0: ("S", "ACGT", False), 1: ("S", "ACGT", True), 2: ("undef-s", "ACGT", False), 3: ("undef-m", None, False), 4: ("undef-m", None, False)}
    with pytest.raises(ValueError):
        checkout.Barcode("S", "AXX")


def test_singletons_and_spikes(spark):
    df = spark.createDataFrame([("AAAA", "v", "j", "d", 9, 9, 1000, 1000), ("AAAT", "v", "j", "d", 1, 1, 2, 2), ("AATT", "v", "j", "d", 1, 1, 2, 2), ("TTTT", "v", "j", "d", 1, 1, 2, 2)], "cdr3nt string, v string, j string, d string, good_events long, total_events long, good_reads long, total_reads long")
    assert rows(clonotypes.erroneous_singletons(df).select("cdr3nt"), "cdr3nt") == [("AAAT",), ("AATT",)]
    spikes, rest = clonotypes.split_spikes(df, df.filter("cdr3nt = 'AAAA'"))
    assert (spikes.count(), rest.count()) == (3, 1)
    made = df.withColumn("aa", F.when(F.col("cdr3nt") == "AATT", "CAF").otherwise("XX"))
    assert clonotypes.merge_noncanonical(made).count() == 1


def test_mapping_finds_a_cdr3_on_both_strands(spark):
    v, j = "ACGTTGCAAGGCTTACCGATAGGCTGT", "TTTGGACCATTGCAGGTACCA"
    middle = "GCAAGCGATGGA"
    seq = "AA" + v + middle + j
    rc = seq[::-1].translate(str.maketrans("ACGT", "TGCA"))
    lib = spark.createDataFrame([("h", "TRB", "Variable", "V1*01", 27, v + "AA"), ("h", "TRB", "Joining", "J1*01", -1, j)], "species string, gene string, segment_type string, allele_id string, ref_point int, seq string")
    hits = mapping.best_hits(spark.createDataFrame([(seq,), (rc,)], "seq string"), lib.select("gene", F.left("segment_type", F.lit(1)).alias("kind"), F.col("allele_id").alias("alleles"), F.lit("x").alias("segments"), "ref_point", "seq"), 9)
    got = mapping.cdr3s(hits).select("cdr3nt").distinct().collect()
    assert [r[0] for r in got] == ["TGT" + middle + "TTT"]
    d = mapping.d_segments(spark.createDataFrame([("AAGCGATCC",)], "middle string"), spark.createDataFrame([("D1", "GGGCGATGG"), ("D2", "ATCGC")], "alleles string, seq string"))
    assert rows(d) == [("AAGCGATCC", "D1,D2", 2, 6)]


def test_fastq_round_trip(spark, tmp_path):
    one, two = tmp_path / "a_R1.fastq.gz", tmp_path / "a_R2.fastq"
    with gzip.open(one, "wt") as f:
        f.write("@r1\nACGT\n+\n@III\n@r2\nGG\n+\nII\n")
    two.write_text("@r1\nTT\n+\nII\n@r2\nCC\n+\nII\n")
    got = fastq.read_fastq(spark, [str(one)], [str(two)])
    assert [(r.idx, r.s1, r.q1, r.s2) for r in got.collect()] == [(0, "ACGT", "@III", "TT"), (1, "GG", "II", "CC")]
    assert fastq.read_fastq(spark, [str(one)], first=1).count() == 1
    fastq.write_fastq(got, str(tmp_path / "out"), "h1", "s1", "q1")
    assert spark.read.text(str(tmp_path / "out")).count() == 8
    two.write_text("@r1\nTT\n+\nII\n")
    with pytest.raises(Exception):  # noqa: B017
        fastq.read_fastq(spark, [str(one)], [str(two)]).collect()


def test_tables(spark, tmp_path):
    path = tmp_path / "barcodes.txt"
    path.write_text("#sample\tmaster\tslave\nS1 ATGN .\nS2\tGGGN\tCC\n\n")
    assert [(r["sample"], r.master, r.slave) for r in tables.read_barcodes(spark, str(path)).orderBy("ord").collect()] == [("S1", "ATGN", None), ("S2", "GGGN", "CC")]
    log = spark.createDataFrame([("a", 1)], "sample string, n int")
    log.write.parquet(str(tmp_path / "log"))
    tables.append_new(spark.createDataFrame([("a", 2), ("b", 3)], "sample string, n int"), str(tmp_path / "log"))
    assert rows(spark.read.parquet(str(tmp_path / "log")), "sample") == [("a", 1), ("b", 3)]


def test_windows_and_bundles(spark):
    df = spark.createDataFrame([("IIIIII",), ("I!!!!!",), ("II",)], "qual string")
    assert rows(reads.good_windows(df), "qual") == [("II",), ("IIIIII",)]
    b = spark.createDataFrame([("C", "AACCG", 2), ("C", "ACCGG", 1)], "cdr3 string, seq string, start int")
    assert rows(reads.cdr3_bundles(b)) == [("C", "ACCG", 2)]


def test_reads_to_clonotypes_with_quality_tags_and_totals(spark):
    v, j = "ACGTTGCAAGGCTTACCGATAGGCTGT", "TTTGGACCATTGCAGGTACCA"
    seq = "AA" + v + "GCAAGCGATGGA" + j
    rc = seq[::-1].translate(str.maketrans("ACGT", "TGCA"))
    lib = spark.createDataFrame([("h", "TRB", "V", "V1*01", "V1", 27, v + "AA"), ("h", "TRB", "J", "J1*01", "J1", -1, j)], "species string, gene string, kind string, alleles string, segments string, ref_point int, seq string")
    d = spark.createDataFrame([("D1", "AGCGATG")], "alleles string, seq string")
    bad = "I" * 30 + "!" + "I" * (len(seq) - 31)
    table = spark.createDataFrame([("@a", "U1", seq, "I" * len(seq), 5), ("@b", "U1", rc, "I" * len(seq), 3), ("@c", "U2", seq, bad, 2), ("@d", "U3", "ACGT" * 15, "I" * 60, 1), ("@e", None, None, None, 1)], "header string, umi string, seq string, qual string, inc int")
    found = repertoire.map_reads(table, lib, d, 9)
    appended = repertoire.append_reads(table, found, 30)
    assert tuple(repertoire.mapping_totals(appended).first()) == (2, 8, 3, 10, 5, 12)
    (row,) = repertoire.clonotype_table(repertoire.count_clonotypes(appended), repertoire.mapping_totals(appended)).collect()
    assert (row["count"], row.fraction, row.cdr3aa, row.v, row.j, row.d, row.good_reads, row.total_reads) == (2, 1.0, "CASDGF", "V1", "J1", "D1", 8, 10)
    assert row.cdr3nt[row.d_start : row.d_end + 1] == "AGCGATG" and row.total_events == 3
    once = repertoire.count_clonotypes(repertoire.once_a_tag(appended, F.col("header")))
    assert once.agg(F.sum("good_events")).first()[0] == 1
    assert repertoire.unmapped_reads(appended).count() == 2 and rows(repertoire.tag_table(appended).select("umi", "mig_sz"), "mig_sz") == [("U1", 3), ("U1", 5)]
    assert sorted(r[0].split(" ")[2] for r in repertoire.annotated_reads(appended).collect()) == ["V:V1", "V:V1"]
    samples = spark.createDataFrame([("s", "raw", "h", "TRB"), ("s", "assembled", "h", "TRB")], "sample string, type string, species string, gene string")
    batch = table.withColumn("sample", F.lit("s")).withColumn("type", F.when(F.col("umi") == "U1", "assembled").otherwise("raw"))
    counted, log = repertoire.clonotypes_batch(batch, samples, lib, d, 9)
    assert rows(counted.select("type", "good_events", "good_reads")) == [("assembled", 2, 8)] and log.count() == 2


def test_assembly_of_a_large_tag_is_the_same(spark, monkeypatch):
    import random

    r = random.Random(4)
    base = "".join(r.choice("ATGC") for _ in range(70))
    reads_ = []
    for u in ("AAAA", "CCCC", "GGGG"):
        for m in (1, 2):
            for _ in range(30):
                x = list(base[10 + r.randint(-3, 3) :][: r.randint(40, 50)])
                for _ in range(r.randint(0, 3)):
                    x[r.randrange(len(x))] = r.choice("ATGCN")
                reads_.append(("s", m, u, "".join(x)))
    df = spark.createDataFrame([*reads_, ("s", 1, None, base), ("s", 1, "TTTT", None)], "sample string, mate int, umi string, seq string")
    one = rows(assemble.assemble(df), "umi", "mate")
    log = assemble.assembly_log(df).first()
    monkeypatch.setattr(assemble, "MOST_READS", 5)
    assert rows(assemble.assemble(df), "umi", "mate") == one and len(one) == 6
    assert assemble.assembly_log(df).first() == log and log.migs_good_total == 3
    assert assemble.alignment_details(df).agg(F.sum("cnt")).first()[0] == log.reads_good_1 + log.reads_good_2


def test_checkout_options(spark):
    b = [checkout.Barcode("S", "ATGCNNNN", "G?G")]
    assert b[0].slave is None
    df = spark.createDataFrame([("CCATGCACGTAA", "I" * 12, None, None), ("CCCC", "IIII", None, None)], "s1 string, q1 string, s2 string, q2 string")
    assert [r.umi for r in checkout.checkout(df, b, [], skip_undef=True).collect()] == ["ACGT"]
    assert [r["sample"] for r in checkout.checkout(df, [checkout.Barcode("S", "NNNNGCAT")], [], complement=True).collect()] == ["S", "undef-m"]
    table = spark.createDataFrame([(1, "A", "ATGC", None, "x"), (2, "B", "CCCC", None, None)], "ord long, sample string, master string, slave string, fastq1 string")
    got = checkout.checkout_batch(df.withColumn("file", F.lit("x")).union(df.withColumn("file", F.lit("y"))), table, ["file"])
    assert rows(got.select("file", "sample"), "file", "sample") == [("x", "A"), ("x", "B"), ("y", "B"), ("y", "undef-m")]


def test_tables_start_empty(spark, tmp_path):
    one = spark.createDataFrame([("a", 1)], "sample string, n int")
    for _ in range(2):
        tables.append_new(one, str(tmp_path / "new"))
    assert rows(spark.read.parquet(str(tmp_path / "new"))) == [("a", 1)]
    seg = tmp_path / "seg.txt"
    seg.write_text("#species\tgene\n" + "Human\tTRB\tVariable\tTRBV1*01\t5\tACGT\nHuman\tTRB\tJoining\tTRBJ1*01\t1\tACGT\nMouse\tTRB\tVariable\tx\t5\tA\n")
    lib = tables.read_segments(spark, str(seg), "human", ["trb"])
    assert lib.count() == 2 and tuple(tables.library_metadata(lib).first()) == ("Human", "TRB", 1, 0, 1, 1)
    df = spark.createDataFrame([("@a UMI:ACGT:5", "AAC", "123")], "header string, seq string, qual string")
    assert rows(fastq.groom(df, reverse=True)) == [("@a_UMI:ACGT:5", "GTT", "321")]
    log = spark.createDataFrame([("s", 10, 2, 20, 4, 30, 6, 1, 1, 1)], "sample string, clonotypes_total long, clonotypes_filtered long, events_total long, events_filtered long, reads_total long, reads_filtered long, non_functional_clonotypes long, non_functional_events long, non_functional_reads long")
    assert clonotypes.final_counts(log).first().events_left == 16
