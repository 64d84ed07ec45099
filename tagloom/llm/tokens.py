"""Token ids of whole texts by a public tokenizer, each distinct word encoded once a worker.

The vocabulary's own pre-tokenizer never joins what white space parts, nor a letter or digit and punctuation after it, so the ids of
a text are those of its words one after the other. Words of Latin letters go straight to the vocabulary's merges;
all others through the whole tokenizer.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np
import pyarrow as pa

from tagloom.llm.wordhash import SPACE, flat, words

MOST_WORDS = 1 << 21
_ASCII_ALNUM, _STOPS = np.zeros(256, bool), np.zeros(256, bool)
_ASCII_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_STOPS[list(b".,;:!?|)")] = True


def _byte_letters() -> dict[int, str]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others for code points from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """Ids of words, kept by hash in sorted arrays; begins anew beyond MOST_WORDS words."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self._clear()

    def _clear(self) -> None:
        self.known, self.at, self.n, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint16)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of some words, each without white space."""
        model, letters = self.tokenizer.model, self.letters
        out: list[list[int]] = [[]] * len(texts)
        other = []
        for i, x in enumerate(texts):
            if x.isalpha() and max(x) < "ɐ" and "İ" not in x and unicodedata.is_normalized("NFC", x):
                x = x.lower()
                out[i] = [t.id for t in model.tokenize(x if x.isascii() else "".join(letters[b] for b in x.encode()))]
            else:
                other.append(i)
        for i, e in zip(other, self.tokenizer.encode_batch_fast([texts[i] for i in other], add_special_tokens=False), strict=True):
            out[i] = e.ids
        return out

    def _learn(self, new: np.ndarray, texts: list[str]) -> None:
        if len(self.known) + len(new) > MOST_WORDS:
            self._clear()
        got = self.encode(texts)
        n = np.fromiter(map(len, got), np.int64, len(got))
        at = len(self.ids) + np.cumsum(n) - n
        self.ids = np.concatenate([self.ids, np.fromiter((i for x in got for i in x), np.uint16, int(n.sum()))])
        where = np.searchsorted(self.known, new)
        self.known, self.at, self.n = np.insert(self.known, where, new), np.insert(self.at, where, at), np.insert(self.n, where, n)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts and where each text's begin; hashes of all word pieces and where each text's begin."""
        data, offsets = flat(texts)
        w = words(data, offsets, SPACE, b"<|" not in data.tobytes())  # special strings are told apart by case
        a, b, low = w.start, w.end, w.lower
        last = low[b - 1] if len(b) else low[:0]
        two, three = np.maximum(b - 2, 0), np.maximum(b - 3, 0)
        latin = (b - a > 2) & (low[three] == 0xC3) & (low[two] >= 0x80) & (low[two] <= 0xBF) & (low[two] != 0x97) & (low[two] != 0xB7) if len(b) else np.zeros(0, bool)
        stop = (b - a > 1) & _STOPS[last] & (_ASCII_ALNUM[low[two]] | latin) if len(b) else latin
        n = 1 + stop.astype(np.int64)
        ends = np.cumsum(n)
        start, end = np.repeat(a, n), np.repeat(b, n)
        second = ends[stop] - 1
        start[second] = b[stop] - 1
        end[second - 1] = b[stop] - 1
        h = w.hash_of(start, end)
        first = np.concatenate([[0], ends])[w.first]
        distinct, at, back = np.unique(h, return_index=True, return_inverse=True)
        if len(distinct):
            new = ~np.isin(distinct, self.known, assume_unique=True)
            if len(self.known) + int(new.sum()) > MOST_WORDS:
                self._clear()
                new[:] = True
            if new.any():
                self._learn(distinct[new], [low[start[i] : end[i]].tobytes().decode("utf-8", "replace") for i in at[new]])
            where = np.searchsorted(self.known, distinct)
            size, place = self.n[where][back], self.at[where][back]
            upto = np.cumsum(size)
            ids = self.ids[np.arange(upto[-1]) - np.repeat(upto - size, size) + np.repeat(place, size)]
            text_at = np.concatenate([[0], upto])[first]
        else:
            ids, text_at = np.zeros(0, np.uint16), np.zeros(len(texts) + 1, np.int64)
        return ids, text_at, h, first
