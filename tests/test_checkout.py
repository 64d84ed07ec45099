"""Checkout of whole batches against the plain functions, read by read."""

import itertools
import random

import numpy as np
import pytest

import plain_checkout as plain
from tagloom.operators import checkout

RC = str.maketrans("ATGC", "TACG")


def pairs(seed, barcodes, n):
    r = random.Random(seed)
    dna = lambda k: "".join(r.choice("ATGC" if r.random() < 0.97 else "N") for _ in range(k))
    qual = lambda s: "".join(chr(33 + r.choice([2, 12, 20, 35])) for _ in s)

    def planted(code, x, at_end=False):
        made = "".join(r.choice({"N": "ATGC"}.get(c.upper(), "") or plain.IUPAC[c.upper()]) for c in code or "")
        made = "".join(c if r.random() < 0.95 else r.choice("ATGC") for c in made)
        at = r.randint(0, 15)
        switch = r.choice(["", "TTGGGG", "TTTTGGG", "GGGGGGGGG"])
        return x[:at] + made + (x[at:] + r.choice(["", "CCCCAA", "CCCCCCCCCA", "CCC"]) if at_end else switch + x[at:])

    out = []
    for _ in range(n):
        b = r.choice(barcodes)
        fragment = dna(r.randint(20, 90))
        one, two = planted(b.master, fragment[: r.randint(0, 80)]), planted(b.slave, fragment[-r.randint(1, 80) :][::-1].translate(RC), True)
        if r.random() < 0.5:
            one = planted(b.master, fragment)
            two = planted(b.slave, fragment[len(fragment) // 3 :], True)
        two = None if r.random() < 0.1 else two
        if two is not None and r.random() < 0.4:
            one, two = two, one
        out.append((one, qual(one), two, None if two is None else qual(two)))
    return [*out, (None, None, None, None), ("", "", "", ""), ("ATGC", "IIII", "", ""), ("NNNN" * 30, "I" * 120, "A" * 5, "I" * 5)]


BARCODES = [
    checkout.Barcode("A", "ATGCNNNNtRcagt", "GGGCNNcc"), checkout.Barcode("B", "CCRNNNNttgacctagg"), checkout.Barcode("C", "NNNNtNNNNtacgGTAC", "N"), checkout.Barcode("D", "TTWgcatgcatgcatgcatgcatg", "ACGTNNNNacgtacgtacgt"),
    checkout.Barcode("E", "G" + "acgt" * 17 + "TC", "CAT"),
]


@pytest.mark.parametrize(("cut", "switch", "both", "mask", "merge", "partial"), [*itertools.product([False, True], [False, True], [False, True], ["0:1"], [True], [False]), (True, True, True, "1:0", True, True), (True, False, True, "1:1", False, False), (False, False, True, "0:0", True, True)])
def test_batches_equal_single_reads(cut, switch, both, mask, merge, partial):
    run = checkout.Checkout(BARCODES, cut, both, mask, checkout.Merging(partial=partial) if merge else None, switch, False, checkout.Limits())
    made = pairs(7, BARCODES, 400)
    got = list(zip(*(c.to_pylist() for c in run(*map(list, zip(*made, strict=True)))), strict=True))
    want = [plain.one(BARCODES, *p, cut=cut, both_ways=both, mask=mask, merge=merge, switch=switch, partial=partial) for p in made]
    for g, w, p in zip(got, want, made, strict=True):
        assert g == w, p
    assert {w[0] for w in want} >= {"A", "B", "C", "D", "undef-s", "undef-m"} and (not merge or any(w[2] == "overlapped" for w in want))


def test_overlap_takes_the_better_base():
    a, b = "AAAACCCCGGGGTTTTACGT", "CCCCGGGGTTTTACGTAAAATTTT"
    which, made = checkout.merged(checkout.Reads.of([a, "A" * 20], ["I" * 20] * 2), checkout.Reads.of([b, "C" * 20], ["5" * 24, "I" * 20]), checkout.Merging())
    assert which.tolist() == [True, False] and made.texts("seq").to_pylist() == ["AAAACCCCGGGGTTTTACGTAAAATTTT"]


def test_overlap_sizes():
    r = random.Random(2)
    rows = []
    for _ in range(300):
        f = "".join(r.choice("AC") for _ in range(60))
        a, b = f[: r.randint(0, 40)], list(f[r.randint(0, 40) :])
        for _ in range(r.randint(0, 2)):
            if b:
                b[r.randrange(len(b))] = "G"
        rows.append((a, "I" * len(a), "".join(b), "".join(r.choice("5I") for _ in b)))
    for sizes in (checkout.Merging(3, 4, 6), checkout.Merging(1, 8, 20, True), checkout.Merging(9, 3, 10, True)):
        which, made = checkout.merged(checkout.Reads.of([x[0] for x in rows], [x[1] for x in rows]), checkout.Reads.of([x[2] for x in rows], [x[3] for x in rows]), sizes)
        want = [plain.overlap(*x, most_offset=sizes.most_offset, seed=sizes.seed, match=sizes.match, partial=sizes.partial) for x in rows]
        assert which.tolist() == [w is not None for w in want]
        assert list(zip(made.texts("seq").to_pylist(), made.texts("qual").to_pylist(), strict=True)) == [w for w in want if w]


def test_switches():
    for slave, texts in ((False, ["TTGGGGACA", "TTTTGGG", "GGGGGGGGGG", "GG", "", "TTTGGGTTT"]), (True, ["ACACCCCAA", "CCCAAAA", "CCCCCCCCCCA", "CC", "", "CCC"])):
        reads = checkout.Reads.of(texts, ["I" * len(t) for t in texts])
        assert checkout.without_switch(reads, np.ones(len(texts), bool), slave).texts("seq").to_pylist() == [plain.trim_switch(t, "I" * len(t), slave)[0] for t in texts]


def test_log_counts_masters_without_slave(spark):
    b = [checkout.Barcode("S", "ATGCNNNN", "GGGCC")]
    df = spark.createDataFrame([("CCATGCACGTAA", "I" * 12, "TTGGGCC", "I" * 7), ("CCATGCACGTAA", "I" * 12, "TTTT", "IIII"), ("CC", "II", "CC", "II")], "s1 string, q1 string, s2 string, q2 string")
    assert sorted(tuple(r) for r in checkout.checkout_log(checkout.checkout(df, b, [])).collect()) == [("S", 2, 1, 0), ("undef-m", 0, 0, 0)]
    assert checkout.checkout(df, [], []).filter("sample = 'undef-m'").count() == 3
    assert checkout.checkout(df.filter("false"), b, []).count() == 0


def test_columns_of_pairs_are_used_as_they_lie_in_arrow():
    """Batches of ASCII with whole qualities aren't made lists of texts; others (nulls, other letters, short qualities) still give the same."""
    import pyarrow as pa

    seqs = ["ATGAAAACACCCCCCCCCCCCCCCCCC", "CATACGTTTGCAACGTACGTACGTACGT", "", "ATGCCCCCACC", "GGATCATTACGTACGTACGTACGT"]
    mates = ["GGAACTTACGTACGTACGTACG", "CCACGGGGGGGGGGGGGG", "CCAC", None, "TTTT"]
    barcodes = [checkout.Barcode("S1", "ATGNNNNCA", "GGANNTT"), checkout.Barcode("S2", "CATNNNNt", "CCAc"), checkout.Barcode("S3", "GGATCNN")]
    run = checkout.Checkout(barcodes, True, True, "0:1", checkout.Merging(), False, False, checkout.Limits())
    for s1, s2, short in ((seqs, mates, 0), (["é" + seqs[0], None, *seqs[2:]], mates, 0), (seqs, mates, 2)):
        q1, q2 = (["I" * max(0, len(x) - short) if x is not None else None for x in s] for s in (s1, s2))
        whole = [pa.array(["x", *x, "y"], pa.string()).slice(1, len(x)) for x in (s1, q1, s2, q2)]
        got = [c.to_pylist() for c in run(*whole)]
        alone = [[c.to_pylist()[0] for c in run(*([x[i]] for x in (s1, q1, s2, q2)))] for i in range(len(s1))]
        assert [list(r) for r in zip(*got, strict=True)] == alone and all(c.type in (pa.string(), pa.bool_()) for c in run(*whole))
    one = checkout.Reads.of(pa.array(seqs), pa.array(["I" * len(x) for x in seqs]))
    assert not one.seq.flags.owndata and one.texts("seq").to_pylist() == seqs
