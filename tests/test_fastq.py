"""FASTQ in byte ranges against one-task reading, mates in step, blocked gzip, files by sample, retries."""

import gzip
import pickle
import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from tagloom.sources import fastq


def records(seed, n):
    r = random.Random(seed)
    dna = lambda k: "".join(r.choice("ACGTN") for _ in range(k))
    out = []
    for i in range(n):
        s = dna(r.choice([0, 1, 5, 30, 200]))
        q = "".join(r.choice("@+I#") for _ in s)  # lines of quality that look like headers
        out.append((f"@read{i} {'x' * r.randint(0, 20)}", s, q))
    return out


def text(rows, end="\n"):
    return ("\n".join(f"{h}\n{s}\n+{'@' if i % 3 == 0 else ''}\n{q}" for i, (h, s, q) in enumerate(rows)) + end).encode()


def bgzf(data, size):
    out = b""
    for part in [data[i : i + size] for i in range(0, len(data), size)] + [b""]:
        z = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = z.compress(part) + z.flush()
        out += b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff\x06\x00BC\x02\x00" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(part), len(part))
    return out


@pytest.mark.parametrize("kind", ["plain", "no end", "gz", "bgzf"])
def test_ranges_read_each_record_once(tmp_path, monkeypatch, kind):
    rows = records(1, 60)
    if kind == "no end":
        rows[-1] = ("@last", "AC", "@@")
    data = text(rows, "" if kind == "no end" else "\n")
    path = tmp_path / ("a.fastq" + (".gz" if "gz" in kind else ""))
    path.write_bytes({"gz": gzip.compress, "bgzf": lambda x: bgzf(x, 97)}.get(kind, lambda x: x)(data))
    monkeypatch.setattr(fastq, "CHUNK", 50)
    for split in (1, 7, 33, 120, 1000, 10**6):
        if kind == "gz" or split > 6 or kind == "plain":
            spans = fastq.spans_of(str(path), split)
            got = [x for s in spans for chunk in fastq._records(s) for x in zip(*chunk, strict=True)]
            assert got == [tuple(y.encode() for y in x) for x in rows], (kind, split)
            assert (len(spans) > 1) == (kind != "gz" and split < path.stat().st_size)


def test_numbers_and_mates_in_step(spark, tmp_path):
    one, two = records(2, 80), records(3, 80)
    a, b = tmp_path / "a_R1.fastq", tmp_path / "a_R2.fastq.gz"
    a.write_bytes(text(one))
    b.write_bytes(bgzf(text(two), 300))
    want = [(i, *x, *y) for i, (x, y) in enumerate(zip(one, two, strict=True))]
    for split in (200, 1500, 1 << 20):
        got = fastq.read_fastq(spark, [str(a)], [str(b)], split=split)
        assert [tuple(r)[1:] for r in got.orderBy("idx").collect()] == want
        assert (got.rdd.getNumPartitions() > 1) == (split < 10_000)
    single = fastq.read_fastq(spark, [str(a), str(b)], split=500)
    assert sorted(tuple(r)[:3] for r in single.collect()) == sorted([(str(a), i, x[0]) for i, x in enumerate(one)] + [(str(b), i, x[0]) for i, x in enumerate(two)])
    assert [r.h2 for r in fastq.read_fastq(spark, [str(a)], [str(b)], first=3).orderBy("idx").collect()] == [x[0] for x in two[:3]]
    b.write_bytes(bgzf(text(two[:-1]), 300))
    for split in (200, 1 << 20):
        with pytest.raises(Exception, match="before|records"):
            fastq.read_fastq(spark, [str(a)], [str(b)], split=split).collect()
    a.write_bytes(b"@a\nAC\nII\n")
    with pytest.raises(Exception, match="whole"):
        fastq.read_fastq(spark, [str(a)]).collect()
    a.write_bytes(b"")
    assert fastq.read_fastq(spark, [str(a)]).count() == 0


@pytest.mark.parametrize("compress", [False, True])
def test_samples(spark, tmp_path, compress):
    rows = [("A" if i % 3 else "undef-m", ["paired", "overlapped", "unpaired"][i % 4 % 3], "ACGT" if i % 3 else None, "IIII" if i % 3 else None, i % 5 == 0, f"@r{i}", "AC", "II", f"@m{i}", "GGT", "I#I") for i in range(60)]
    df = spark.createDataFrame(rows, "sample string, type string, umi string, umi_qual string, swapped boolean, h1 string, s1 string, q1 string, h2 string, s2 string, q2 string").repartition(3)
    path = str(tmp_path / "out")
    fastq.write_samples(df.filter("umi IS NULL OR h1 < '@r4'"), path, compress)
    fastq.write_samples(df.filter("NOT (umi IS NULL OR h1 < '@r4')"), path, compress)
    names = {p.name.split("_")[1].split("-")[0] for p in (tmp_path / "out" / "A").iterdir() if not p.name.startswith(".")}
    assert names == {"R0", "R1", "R2", "R12"}
    got = fastq.read_samples(spark, path, "paired", split=100)
    def heads(i):
        tag = " UMI:ACGT:IIII" if i % 3 else ""
        return (f"@m{i} R2{tag}", f"@r{i} R1{tag}") if i % 5 == 0 else (f"@r{i} R1{tag}", f"@m{i} R2{tag}")
    assert sorted((r["sample"], r.h1, r.s1, r.h2, r.s2, r.q2) for r in got.collect()) == sorted((x[0], heads(i)[0], "AC", heads(i)[1], "GGT", "I#I") for i, x in enumerate(rows) if x[1] == "paired")
    assert fastq.read_samples(spark, path, "overlapped", ["A"]).count() == sum(x[0] == "A" and x[1] == "overlapped" for x in rows)
    assert not [p for p in (tmp_path / "out" / "_writing").iterdir() if p.is_dir()]


def test_a_failed_job_leaves_no_files(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(100).select(F.lit("A").alias("sample"), F.when(F.col("id") < 90, "paired").otherwise("nothing").alias("type"), F.lit("").alias("umi"), F.lit("").alias("umi_qual"), F.lit(False).alias("swapped"), *(F.lit("@x").alias(f"{c}{m}") for m in (1, 2) for c in "hsq"))
    with pytest.raises(Exception):  # noqa: B017
        fastq.write_samples(df, path)
    assert not list((tmp_path / "out").glob("**/*.fastq"))
    fastq.write_samples(df.filter("id < 90"), path)
    assert fastq.read_samples(spark, path, "paired").count() == 90 and fastq.manifest(spark, path).count() >= 1


def test_small_ranges_share_tasks(spark, tmp_path):
    """Tasks grow with bytes and cores, not with ranges, and hold no other task's span."""
    one, two = records(4, 2000), records(5, 2000)
    a, b = tmp_path / "a_R1.fastq", tmp_path / "a_R2.fastq"
    a.write_bytes(text(one))
    b.write_bytes(text(two))
    got = fastq.read_fastq(spark, [str(a)], [str(b)], split=400)
    assert len(fastq.spans_of(str(a), 400)) > 300 and 1 < got.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    assert [tuple(r)[1:] for r in got.orderBy("idx").collect()] == [(i, *x, *y) for i, (x, y) in enumerate(zip(one, two, strict=True))]
    single = fastq.read_fastq(spark, [str(a)], split=400)
    assert [(r.idx, r.h1) for r in single.orderBy("idx").collect()] == [(i, x[0]) for i, x in enumerate(one)]
    spans = fastq.json.dumps([list(vars(fastq.Span(str(a), i, i + 1)).values()) for i in range(5000)])
    assert len(pickle.dumps(fastq.FastqReader({"spans": spans}))) < 500


def test_missing_texts_are_written_empty():
    heads, seqs, quals = ["@a", "@b", "@c R1"], ["AC", None, ""], ["II", None, None]
    table = fastq.pa.table([["@x", *heads], ["GG", *seqs], ["##", *quals]], ["h", "s", "q"]).combine_chunks().to_batches()[0].slice(1)
    assert bytes(fastq._as_text(*table.columns)) == b"@a\nAC\n+\nII\n@b\n\n+\n\n@c R1\n\n+\n\n"
    assert bytes(fastq._as_text(*table.slice(3).columns)) == b""
