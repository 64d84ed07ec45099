"""The suffix automaton and containment against brute force."""

import random

import pytest

from tagloom.operators import clonotypes, mapping, substrings

RC = str.maketrans("ACGT", "TGCA")


def longest(text, library, least):
    best = None
    for n in range(len(text), least - 1, -1):
        for a in range(len(text) - n + 1):
            part = text[a : a + n]
            names = sorted({k for k, x in library if part in x}) if set(part) <= set("ACGT") else []
            if names:
                return text, ",".join(names), a, a + n - 1
    return best


@pytest.mark.parametrize("piece", [1 << 18, 20])
def test_longest_stretches(spark, monkeypatch, piece):
    monkeypatch.setattr(substrings, "PIECE", piece)
    r = random.Random(piece)
    dna = lambda n, of="ACGT": "".join(r.choice(of) for _ in range(n))
    library = [(f"D{i % 7}", dna(r.randint(1, 25), "ACGTN" if i == 3 else "ACG" if i % 2 else "AC")) for i in range(12)] + [("E", "ACAC"), ("E", "ACAC"), ("F", "")]
    texts = [dna(r.randint(0, 40), r.choice(["ACGTN", "AC", "ACG"])) for _ in range(300)] + [None, "", "N", "A", "G" * 200]
    for least in (1, 2, 6):
        got = substrings.longest_stretches(spark.createDataFrame([(t, 1) for t in texts], "t string, text int"), "t", library, least)
        assert sorted(tuple(x) for x in got.collect()) == sorted({x for t in texts if t and (x := longest(t, library, least))})


def test_d_segments(spark):
    d = spark.createDataFrame([("D1", "GGGCGATGG"), ("D2", "ATCGC")], "alleles string, seq string")
    long = "TT" + "GGGCGATGG" * 20
    got = mapping.d_segments(spark.createDataFrame([("AAGCGATCC",), (long,), ("TT",), (None,)], "middle string"), d)
    assert sorted(tuple(x) for x in got.collect()) == [("AAGCGATCC", "D1,D2", 2, 6), (long, "D1", 2, 10)]
    assert mapping.d_segments(spark.createDataFrame([("ACGT",)], "middle string"), d.filter("false")).count() == 0


def test_contained(spark):
    r = random.Random(3)
    dna = lambda n: "".join(r.choice("AC") for _ in range(n))
    patterns = [dna(r.randint(1, 12)) for _ in range(80)] + ["", None, "ACACACACA"]
    texts = [dna(r.randint(0, 30)) for _ in range(150)] + [None, "", patterns[0]]
    frame = lambda x: spark.createDataFrame([(v, v) for v in x], "cdr3nt string, into string")
    want = sorted({(t, p) for t in texts if t for p in patterns if p and p in t})
    assert sorted(tuple(x) for x in substrings.contained(frame(texts), "cdr3nt", frame(patterns), "into").collect()) == want
    long = [p for p in patterns if p and len(p) >= 7]
    assert sorted(tuple(x) for x in substrings.contained(frame(texts), "cdr3nt", frame(long), "into").collect()) == [x for x in want if len(x[1]) >= 7]


def test_merge_takes_the_longest(spark):
    rows = [("TGTAAATTT", "CKF", 1), ("TGTAAATTTGGG", "CKFG", 2), ("ATGTAAATTTGGGATGT", "?", 4), ("CCCCCCCCC", "PPP", 8), ("TGTAAATTTGG", "CKFW", 16)]
    df = spark.createDataFrame([(c, a, n, n, n, n) for c, a, n in rows], "cdr3nt string, aa string, good_events long, total_events long, good_reads long, total_reads long")
    got = sorted((r.cdr3nt, r.good_events, r.total_reads) for r in clonotypes.merge_noncanonical(df).collect())
    assert got == [("TGTAAATTT", 1 + 0, 1), ("TGTAAATTTGG", 16 + 2 + 4, 22)]
