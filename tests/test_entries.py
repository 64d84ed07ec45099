"""A run of the entries over files, as a user would call them."""

import random

import pytest

from tagloom import __main__ as cli
from tagloom import entries

RC = str.maketrans("ACGT", "TGCA")


def test_a_run_on_files(spark, tmp_path, capsys):
    r = random.Random(9)
    dna = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    v, j, d = dna(40) + "TGTGCC", "AACTTTGG" + dna(30), "GGGACAGGGGGC"
    (tmp_path / "segments.txt").write_text(f"HomoSapiens\tTRB\tVariable\tTRBV1*01\t43\t{v}\nHomoSapiens\tTRB\tJoining\tTRBJ1*01\t2\t{j}\nHomoSapiens\tTRB\tDiversity\tTRBD1*01\t0\t{d}\n")
    (tmp_path / "segments.metadata").write_text("#SPECIES\tGENE\tV\tD\tJ\tVJ\nHomoSapiens\tTRB\t1\t1\t1\t1\n")
    clones = [v + "AGGGACAGACTG" + j, v[:20] + v[21:] + "CCAGATGGTCTG" + j]
    one, two = [], []
    for tag in range(24):
        code, clone = "".join("ACGT"[tag // 4**k % 4] for k in range(4)), clones[tag % 2]
        for copy in range(6 if tag < 20 else 1):
            x = list(clone)
            if copy == 0:
                x[r.randrange(len(x))] = r.choice("ACGT")
            one.append("AATGC" + code + "TGCA" + "".join(x)[:80])
            two.append("".join(x)[30:][::-1].translate(RC))
    one, two = one + [dna(50)] * 3, two + [dna(50)] * 3
    for name, rows in (("R1", one), ("R2", two)):
        (tmp_path / f"{name}.fastq").write_text("".join(f"@r{i}\n{s}\n+\n{'I' * len(s)}\n" for i, s in enumerate(rows)))
    at = lambda name: str(tmp_path / name)
    (tmp_path / "barcodes.txt").write_text(f"#sample\tmaster\tslave\nS\tATGCNNNNTGCA\t.\t{at('R1.fastq')}\t{at('R2.fastq')}\n")
    checked = entries.checkout(spark, at("barcodes.txt"), at("checkout"), trim=True, overlap=True, split=4000)
    assert sorted(tuple(x) for x in checked["log"].collect()) == [("S", 124, 124, 124), ("undef-m", 0, 0, 0)] and len(one) == 127
    found = entries.histogram(spark, at("checkout"), at("histogram"))
    assert [tuple(x)[:4] for x in found["overseq"].collect()] == [("S", "overlapped", 4, 0)] and found["pwm_summary"].count() == found["pwm"].count() > 8
    made = entries.assemble(spark, at("checkout"), at("histogram"), at("assembly"), force_overseq=5)
    assert made["consensus"].count() == 20 and tuple(made["log"].first())[2:] == (24, 124, 20, 120)
    mapped = entries.map_clonotypes(spark, at("checkout"), at("assembly"), str(tmp_path), "TRB", at("mapped"), strict=True)
    want = {("TGTGCCAGGGACAGACTGAACTTT", "TRBV1", "TRBJ1"), ("TGTGCCCCAGATGGTCTGAACTTT", "TRBV1", "TRBJ1")}
    assembled = mapped["clonotypes"].filter("type = 'assembled'").collect()
    assert {(x.cdr3nt, x.v, x.j) for x in assembled} == want and {x["count"] for x in assembled} == {10}
    assert {x.d for x in assembled if "GGGACAG" in x.cdr3nt} == {"TRBD1"}
    kept = entries.filter_clonotypes(spark, at("mapped"), at("filtered"), singletons=True)
    assert {(x.cdr3nt, x.v, x.j) for x in kept["clonotypes"].collect()} == want and kept["pairing"].first().side == "both"
    assert entries.graph(spark, at("filtered"), "S", at("graph"))["nodes"].count() == 2
    entries.report(spark, at("report.html"), at("checkout"), at("histogram"), at("assembly"), at("mapped"))
    page = (tmp_path / "report.html").read_text()
    assert "mapping_rate" in page and "not run" in page
    tags = entries.umi_frequencies(spark, at("checkout"), at("tags"))["tags"].collect()
    assert len(tags) == 24 and {x.n for x in tags} == {1, 6}
    (tmp_path / "spikes.txt").write_text("TGTGCCAGGGACAGACTGAACTTA\n")
    split = entries.split_spikes(spark, at("filtered"), "S", at("spikes.txt"), at("spikes"))
    assert [x.cdr3nt for x in split["spikes"].collect()] == ["TGTGCCAGGGACAGACTGAACTTT"] and split["others"].count() == 1
    matrix = entries.quality_histogram(spark, at("R1.fastq"), at("quality"))["matrix"]
    assert {x.q for x in matrix.collect()} == {40}
    often = entries.frequent_reads(spark, at("R1.fastq"), at("often"), least=5)
    assert often["sequences"].count() == 20 and 100 <= often["reads"].count() <= 120
    entries.consensus_fastq(spark, at("assembly"), at("fastq"))
    text = "\n".join(p.read_text() for p in (tmp_path / "fastq").glob("sample=S/mate=1/part-*"))
    assert text.count("@MIG.") == 20 and ":6\n" in text
    cli.main(["--runs", at("runs"), "print-library", str(tmp_path)])
    assert "HomoSapiens" in capsys.readouterr().out
    with pytest.raises(Exception):  # noqa: B017
        cli.main(["--runs", at("runs"), "histogram", at("nowhere"), at("x")])
    assert len(list((tmp_path / "runs" / "calls").glob("*.json"))) == 2 and len(list((tmp_path / "runs" / "errors").glob("*.json"))) == 1
    options = cli.parser().parse_args(["checkout", "b", "o", "--first", "5", "--overlap", "--limits", "10:0.1:0"])
    assert (options.first, options.overlap, options.limits, options.trim) == (5, True, "10:0.1:0", False)
