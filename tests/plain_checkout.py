"""Barcode search, trimming and merging read by read, as plain as can be: what the batch functions are held against."""

import re

from tagloom.functions.sequence import IUPAC, seed_regex

RC = str.maketrans("ATGC", "TACG")


def find(barcode: str, seq: str, qual: str, low: int = 15, low_share: float = 0.2, high_share: float = 0.05) -> int:
    """First start at which the seed matches and mismatches of low and of high quality are within their limits; -1 without one."""
    n, upper = len(barcode), barcode.upper()
    for m in re.finditer(f"(?={seed_regex(barcode)})", seq):
        a, bad, worse = m.start(), 0, 0
        for i in range(n):
            if seq[a + i] not in IUPAC[upper[i]]:
                worse += ord(qual[a + i]) - 33 > low
                bad += ord(qual[a + i]) - 33 <= low
        if bad <= int(n * low_share) and worse <= int(n * high_share):
            return a
    return -1


def tag(barcode: str, seq: str, qual: str, at: int) -> tuple[str, str]:
    places = [at + i for i, c in enumerate(barcode) if c == "N"]
    return "".join(seq[p] for p in places), "".join(qual[p] for p in places)


def trim(seq: str, qual: str, at: int, size: int, least: int = 10) -> tuple[str, str]:
    """Cut a barcode out, with what is before and after it where that has at most `least` bases."""
    keep = [*(range(at) if at > least else ()), *(range(at + size, len(seq)) if len(seq) - at - size > least else ())]
    return "".join(seq[i] for i in keep), "".join(qual[i] for i in keep)


def trim_switch(seq: str, qual: str, slave: bool = False) -> tuple[str, str]:
    """Cut the bases of template switching: up to 3 T and 3 to 7 G that a master's rest begins with, or C and A that a slave's ends with."""
    m = re.search(r"C{3,7}A{0,3}$", seq) if slave else re.match(r"T{0,3}G{3,7}", seq)
    if not m:
        return seq, qual
    return (seq[: m.start()], qual[: m.start()]) if slave else (seq[m.end() :], qual[m.end() :])


def overlap(s1: str, q1: str, s2: str, q2: str, most_offset: int = 5, seed: int = 5, match: int = 10, partial: bool = False) -> tuple[str, str] | None:
    """Mates merged where the second begins inside the first: the better base of each shared place, ties to the second. With partial, the
    compared stretch may be cut short by the end of a mate."""
    for i in range(most_offset):
        k = s2[i : i + seed]
        p = s1.find(k) if len(k) == seed else -1
        while p >= 0:
            a, b = s1[p + seed : p + seed + match], s2[i + seed : i + seed + match]
            bad = [x != y for x, y in zip(a, b, strict=False)]
            if (len(bad) == match or (partial and bad)) and sum(bad) <= len(bad) * 0.1 and not any(x and y for x, y in zip(bad, bad[1:], strict=False)):
                n = min(len(s1) - p, len(s2) - i)
                best = [(s1[p + j], q1[p + j]) if q1[p + j] > q2[i + j] else (s2[i + j], q2[i + j]) for j in range(n)]
                tail = (s1[p + n :], q1[p + n :]) if len(s1) - p > n else (s2[i + n :], q2[i + n :])
                return s1[:p] + "".join(x for x, _ in best) + tail[0], q1[:p] + "".join(y for _, y in best) + tail[1]
            p = s1.find(k, p + 1)
    return None


def reverse(seq):
    return "".join(c if c in "ATGC" else "N" for c in seq).translate(RC)[::-1]


def one(barcodes, s1, q1, s2, q2, cut=False, both_ways=True, mask="0:1", merge=False, switch=False, **sizes):
    """sample, matched, type, umi, umi_qual, s1, q1, s2, q2, swapped of one read or pair."""
    flags = [x == "1" for x in mask.split(":")]
    s1, q1, pair = s1 or "", q1 or "", s2 is not None
    sample = matched = "undef-m"
    u = uq = None
    ms, mq, os, oq, swapped = s1, q1, s2 or "", q2 or "", False
    hits = [(b, *x, at) for b in barcodes for x in ([(s1, q1, s2 or "", q2 or "", False)] + ([(s2, q2, s1, q1, True)] if pair and both_ways else [])) if (at := find(b.master, x[0], x[1])) >= 0]
    if hits:
        b, ms, mq, os, oq, swapped, at = hits[0]
        sample = matched = b.sample
        u, uq = tag(b.master, ms, mq, at)
        if cut:
            ms, mq = trim(ms, mq, at, len(b.master))
            ms, mq = trim_switch(ms, mq) if switch else (ms, mq)
        if pair and b.slave and b.slave != "N":
            to = find(b.slave, os, oq)
            if to < 0:
                sample = "undef-s"
            else:
                v, vq = tag(b.slave, os, oq, to)
                u, uq = u + v, uq + vq
                if cut:
                    os, oq = trim(os, oq, to, len(b.slave))
                    os, oq = trim_switch(os, oq, True) if switch else (os, oq)
    if flags[0]:
        ms, mq = reverse(ms), mq[::-1]
    if pair and flags[1]:
        os, oq = reverse(os), oq[::-1]
    if merge and pair and sample not in ("undef-m", "undef-s") and (whole := overlap(ms, mq, os, oq, **sizes)):
        return sample, matched, "overlapped", u, uq, *whole, None, None, swapped
    return sample, matched, "paired" if pair else "unpaired", u, uq, ms, mq, os if pair else None, oq if pair else None, swapped
