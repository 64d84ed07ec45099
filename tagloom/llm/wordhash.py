"""Words of a whole Arrow batch of texts as 64-bit hashes, found and hashed by numpy over the UTF-8 bytes.

A word's hash is a sum over its bytes of a random value per byte times a power of an odd base, modulo 2**64, so the
hashes of all words of a batch come from one running sum; a mixer then spreads the bits. Two different words get the same
hash with a chance of about 2**-60.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 & ~0x7 | 0x5)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE_VALUES = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHINGLE_BASE = np.uint64(0xD6E8FEB86659FD93)
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))

#: Bytes that part words: for words `[^\x20\x09-\x0D]+`, and for words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
_LOWER_BYTES = LOWER.tobytes()
_FOLDED_VALUES = _BYTE_VALUES[LOWER]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of a public 64-bit hash)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = (1 << max(19, (n - 2).bit_length())) + 1  # for blocks of 512 KB, or the next power of two
        made = []
        for base in (_BASE, _INVERSE):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        _powers = (made[0], made[1])
    return _powers


@dataclass
class Words:
    """Words of some texts, in order. first[i]:first[i + 1] are those of text i; start and end are offsets in data and lower."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    data: bytes
    fold: bool
    sums: np.ndarray

    @cached_property
    def lower(self) -> np.ndarray:
        return np.frombuffer(self.data.translate(_LOWER_BYTES) if self.fold else self.data, np.uint8)

    def hash_of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of other stretches of bytes, in the same measure."""
        return mix((self.sums[end] - self.sums[start]) * _power_tables(len(self.sums))[1][start])

    def text(self, i: int) -> bytes:
        return self.lower[self.start[i] : self.end[i]].tobytes()

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and where each begins; a null is an empty text."""
    texts = pa.array([], pa.large_string()) if len(texts) == 0 else texts.cast(pa.large_string()).fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray, parting: np.ndarray, fold: bool = True) -> Words:
    """Lower-case A-Z (if fold) and take the words between parting bytes; no word goes beyond its text."""
    n = len(data)
    raw = data.tobytes()  # bytes look up a table of bytes several times as fast as arrays do
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = np.frombuffer(raw.translate((~parting).tobytes()), bool)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    up, down = _power_tables(n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    value = (_FOLDED_VALUES if fold else _BYTE_VALUES).take(data)
    value *= up[:n]
    np.cumsum(value, out=sums[1:])
    return Words(mix((sums[end] - sums[start]) * down[start]), start, end, np.searchsorted(start, offsets), raw, fold, sums)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of so many words that begin at each word; the last size - 1 places are not made."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, size):
        out *= _SHINGLE_BASE
        out += hashes[k : n + k]
    return mix(out)


def blocks(texts: pa.Array, most: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about so many bytes; a longer text is a range of its own."""
    _, offsets = flat(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, to
        at = to
