"""Scalar functions on DNA, quality and barcode strings, as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LETTERS = "ATGC"
#: IUPAC codes with the bases they stand for, and their complements.
IUPAC = {"A": "A", "T": "T", "G": "G", "C": "C", "R": "AG", "Y": "CT", "M": "AC", "S": "GC", "W": "AT", "K": "GT", "V": "ACG", "D": "AGT", "H": "ACT", "B": "CGT", "N": "ATGC"}
COMPLEMENTS = ("ACGTRYMKVBHDSWN", "TGCAYRKMBVDHSWN")
#: The standard genetic code, codons in the order T, C, A, G of each place.
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def phreds(quality: Column) -> Column:
    """Phred values of a quality string."""
    return F.transform(F.filter(F.split(quality, ""), lambda c: c != ""), lambda c: F.ascii(c) - 33)


def least_phred(quality: Column) -> Column:
    return F.array_min(phreds(quality))


def phred_symbol(q: Column) -> Column:
    """Symbol of a Phred value, held to 2..40."""
    return F.char(F.least(F.greatest(q.cast("int"), F.lit(2)), F.lit(40)) + 33)


def reverse_complement(seq: Column) -> Column:
    """Of upper-case bases; anything else becomes N."""
    return F.reverse(F.translate(F.regexp_replace(seq, "[^ACGT]", "N"), "ACGT", "TGCA"))


def reverse_complement_masked(seq: Column) -> Column:
    """As reverse_complement, but lower-case bases keep their case."""
    return F.reverse(F.translate(F.regexp_replace(seq, "[^ACGTacgt]", "N"), "ACGTacgt", "TGCAtgca"))


def iupac_complement(pattern: str) -> str:
    upper, lower = str.maketrans(*COMPLEMENTS), str.maketrans(*(x.lower() for x in COMPLEMENTS))
    return pattern.translate(upper | lower)[::-1]


def seed_regex(barcode: str) -> str:
    """Upper-case codes must match; lower-case ones may be any base."""
    return "".join(f"[{IUPAC[c]}]" if c.isupper() else "[ATGC]" for c in barcode)


def _codons() -> Column:
    order = "TCAG"
    pairs = [x for i, aa in enumerate(AMINO_ACIDS) for x in (F.lit(order[i // 16] + order[i // 4 % 4] + order[i % 4]), F.lit(aa))]
    return F.create_map(*pairs)


def codons_to_protein(seq: Column) -> Column:
    """Amino acids of the whole codons of a sequence; an unknown codon is ?."""
    n = F.floor(F.length(seq) / 3).cast("int")
    every = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.coalesce(F.try_element_at(_codons(), F.substring(seq, i * 3 + 1, F.lit(3))), F.lit("?"))))
    return F.coalesce(F.array_join(every, ""), F.lit(""))


def translate_both_ends(seq: Column) -> Column:
    """Protein of a sequence read from both ends: out of frame, unknown bases fill the middle codon, and the middle is lower-case."""
    n = F.length(seq)
    gap = (F.lit(3) - n % 3) % 3
    half = F.floor(n / 2).cast("int")
    filled = F.concat(F.substring(seq, F.lit(1), half), F.substring(F.lit("??"), F.lit(1), gap), F.substring(seq, half + 1, n))
    protein = codons_to_protein(F.when(gap == 0, seq).otherwise(filled))
    middle = F.floor(half / 3).cast("int") + 1
    odd = F.concat(F.substring(protein, F.lit(1), middle - 1), F.lower(F.substring(protein, middle, F.lit(1))), F.substring(protein, middle + 1, n))
    return F.when(gap == 0, protein).otherwise(odd)


def coverage_bin(n: Column) -> Column:
    """Power of two of a count, 16 at most."""
    return F.least(F.length(F.bin(n)) - 1, F.lit(16))


def core(seq: Column, offset: Column | int, anchor: int) -> Column:
    """2 * anchor + 1 bases around the middle, moved by an offset."""
    offset = F.lit(offset) if isinstance(offset, int) else offset
    return F.substring(seq, F.floor(F.length(seq) / 2).cast("int") - anchor - offset + 1, F.lit(2 * anchor + 1))


def hamming(a: Column, b: Column) -> Column:
    """Places in which two strings of one length differ."""
    return F.aggregate(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x != y).cast("int")), F.lit(0), lambda s, x: s + x)


def wildcards(seq: Column, pad: str = "_") -> Column:
    """The string with each place in turn replaced: two strings that differ in one place share one of these."""
    return F.transform(F.sequence(F.lit(1), F.length(seq)), lambda i: F.overlay(seq, F.lit(pad), i, F.lit(1)))


def one_off(seq: Column) -> Column:
    """The string and all that differ from it by one base: strings of one length that differ in at most two places share one of these."""
    letters = F.array(*map(F.lit, LETTERS))
    return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.length(seq)), lambda i: F.transform(letters, lambda c: F.overlay(seq, c, i, F.lit(1))))))


def file_prefix(path: Column) -> Column:
    """A FASTQ file's name without folder and .fastq or .fastq.gz."""
    return F.regexp_extract(path, r"([^/]*?)(?:\.fastq)?(?:\.gz)?$", 1)


def seed_masked(seq: Column, ref_point: Column, is_v: Column) -> Column:
    """An allele in lower case but for the seed around its reference point: 6 before to 10 after for V, 10 before to 6 after for J."""
    before, after = F.when(is_v, 6).otherwise(10), F.when(is_v, 10).otherwise(6)
    start, end = F.greatest(ref_point - before, F.lit(0)), F.least(ref_point + after, F.length(seq))
    return F.concat(F.lower(F.substring(seq, F.lit(1), start)), F.upper(F.substring(seq, start + 1, end - start)), F.lower(F.substring(seq, end + 1, F.length(seq))))


def percent(part: Column, whole: Column) -> Column:
    """Percentage cut off after two decimals."""
    return F.floor(part * 10000 / whole) / 100
