"""Gapped alignment against a plain Smith-Waterman, and CDR3s behind insertions and deletions on both strands."""

import random

import pytest
from pyspark.sql import functions as F

from tagloom.operators import alignment, mapping

RC = str.maketrans("ACGT", "TGCA")


def smith_waterman(a, q, ref):
    """Best local alignment of allele a with read q: score, identities, q_from, q_to, a_from, a_to, q_ref; ties as the operator's."""
    low = -10**9
    n, m = len(a), len(q)
    H, E, F_ = ([[low if t else 0 for _ in range(m + 1)] for _ in range(n + 1)] for t in (0, 1, 1))
    best = (0, 0, 0)
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            F_[i][j] = max(H[i - 1][j] - 7, F_[i - 1][j] - 2)
            E[i][j] = max(H[i][j - 1] - 7, E[i][j - 1] - 2)
            d = H[i - 1][j - 1] + (2 if a[i - 1] == q[j - 1] and a[i - 1] in "ACGT" else -3)
            H[i][j] = max(0, d, F_[i][j], E[i][j])
            if H[i][j] > best[0]:
                best = (H[i][j], i, j)
    score, i, j = best
    ends, ident, places, state = (i, j), 0, {}, "M"
    while True:
        if state == "M":
            if H[i][j] == 0:
                break
            d = H[i - 1][j - 1] + (2 if a[i - 1] == q[j - 1] and a[i - 1] in "ACGT" else -3)
            if H[i][j] == d:
                ident += a[i - 1] == q[j - 1]
                places[i - 1] = j - 1
                first = (i - 1, j - 1)
                i, j = i - 1, j - 1
            else:
                state = "F" if H[i][j] == F_[i][j] else "E"
        elif state == "F":
            places[i - 1] = j
            state = "F" if F_[i - 1][j] - 2 >= H[i - 1][j] - 7 else "M"
            i -= 1
        else:
            state = "E" if E[i][j - 1] - 2 >= H[i][j - 1] - 7 else "M"
            j -= 1
    places.setdefault(first[0] - 1, first[1] - 1)
    places.setdefault(ends[0], ends[1])
    return score, ident, first[1], ends[1] - 1, first[0], ends[0] - 1, places.get(ref, -1)


def mutated(r, s, gaps):
    s = list(s)
    for _ in range(r.randint(0, 3)):
        s[r.randrange(len(s))] = r.choice("ACGTN")
    for _ in range(gaps):
        at, n = r.randrange(5, len(s) - 5), r.randint(1, 4)
        if r.random() < 0.5:
            del s[at : at + n]
        else:
            s[at:at] = [r.choice("ACGT") for _ in range(n)]
    return "".join(s)


def test_against_smith_waterman():
    r = random.Random(8)
    dna = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    alleles = [dna(r.randint(40, 70)) for _ in range(6)]
    rows = [type("Row", (), {"gene": "g", "kind": "V", "alleles": f"a{i}", "segments": f"s{i}", "ref_point": r.randrange(0, len(x)), "seq": x})() for i, x in enumerate(alleles)]
    reads = []
    for _ in range(120):
        x = dna(r.randint(0, 20)) + mutated(r, r.choice(alleles), r.randint(0, 2)) + dna(r.randint(0, 20))
        reads.append(x if r.random() < 0.5 else x.replace("N", "A")[::-1].translate(RC))
    reads += ["", "ACGT", "N" * 50, alleles[0]]
    library = alignment.Library.made(rows, 7)
    read, allele, rc, _, found = alignment.align_batch(reads, library, 7, 16, 2)
    best, seen = {}, 0
    for i, a, c, row in zip(read.tolist(), allele.tolist(), rc.tolist(), found.tolist(), strict=True):
        best[i] = max(best.get(i, (0,)), (row[0], a, c, row))
    for i, x in enumerate(reads):
        want = max(((smith_waterman(a, y, rows[k].ref_point) if set(y) & set(a) else (0,)), k, c) for k, a in enumerate(alleles) for c, y in ((False, x), (True, "".join(z if z in "ACGT" else "N" for z in x).translate(RC)[::-1])))
        if want[0][0] >= 40:
            seen += 1
            assert best[i][0] == want[0][0]
            k, c = best[i][1], best[i][2]
            y = "".join(z if z in "ACGT" else "N" for z in x).translate(RC)[::-1] if c else x
            assert tuple(best[i][3]) == smith_waterman(alleles[k], y, rows[k].ref_point)
    assert seen > 100 and not {120, 121, 122} & set(best)


def library(spark):
    r = random.Random(1)
    dna = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    v = [dna(52) + "TGT" + dna(5) for _ in range(3)]
    j = ["TTT" + dna(40) for _ in range(2)]
    rows = [("TRB", "V", f"V{i}*01", f"V{i}", 55, x) for i, x in enumerate(v)] + [("TRB", "J", f"J{i}*01", f"J{i}", -1, x) for i, x in enumerate(j)]
    return v, j, spark.createDataFrame(rows, "gene string, kind string, alleles string, segments string, ref_point int, seq string")


@pytest.mark.parametrize("piece", [1 << 22, 100])
def test_cdr3s_behind_gaps(spark, monkeypatch, piece):
    monkeypatch.setattr(alignment, "PIECE", piece)
    v, j, lib = library(spark)
    middle = "GCAAGCGATGGACCATTCAG"
    want = {}
    for i, x in enumerate(v):
        for cut in (x, x[:20] + x[23:], x[:30] + "ACG" + x[30:], x[:15] + x[16:]):
            for k, y in enumerate(j):
                s = "AC" + cut[:-5] + middle + y[:20] + y[22:]
                want[s] = want[s[::-1].translate(RC)] = ("TGT" + middle + "TTT", f"V{i}", f"J{k}")
    hits = alignment.gapped_hits(spark.createDataFrame([*((s,) for s in want), *((s,) for s in list(want)[:5]), (None,), ("",), ("ACGT" * 9,)], "seq string"), lib)
    got = {r.read: (r.cdr3nt, r.v, r.j) for r in mapping.cdr3s(hits).collect()}
    assert got == want
    assert alignment.gapped_hits(lib.filter("false"), lib).count() == 0 and alignment.gapped_hits(lib, lib.filter("false")).count() == 0
    assert hits.filter(F.col("n_ident") < 7).count() == 0
