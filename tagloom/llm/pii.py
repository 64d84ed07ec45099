"""Personal data: exact patterns with checks, and a linear-chain conditional random field for other ways of writing it.

The field's labels are outside, and begin and inside of each kind; its features are word shapes around a token. It is trained by
gradient steps on a small labelled table (tokens and labels; by default the one that `labelled_table` makes from templates), once on the driver,
and decoded by Viterbi over numpy batches of lines. Every span must hold a trigger by its kind's own check (a digit, an @, or the word `at` in
brackets), so lines without one need no decoding; lines with one are decoded whole. A span of the field is kept if it doesn't touch a span of
the patterns and passes the kind's check; spans of the patterns always stay. `evaluate` gives precision and recall of the field by kind.

Null and empty texts have no spans. Lines of any length are decoded whole; of one with more than `LONG` tokens only back pointers and places are kept
(some 25 bytes a token), features and scores being made block by block. Equal labellings go by the order of labels. Offsets are code points, ends exclusive. Rows with equal ids are judged one by one; other columns
are not read.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
_LOCAL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
#: Possessive runs, and starts only at a run's begin, find the same leftmost matches in linear time.
_EMAIL_AT, _EMAIL = re.compile(_LOCAL), re.compile(r"(?<![A-Za-z0-9._%+-])" + _LOCAL)
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CELLS, LONG, PENDING = 1 << 17, 1 << 12, 1 << 15
_TOKEN = re.compile(r"[A-Za-zÀ-ɏ]+|[0-9]+|[^\sA-Za-z0-9À-ɏ]|\n")
_TRIGGER = re.compile(r"[0-9@]|[\[({]\s*(?:at|dot)\s*[\])}]", re.I)
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
HASHED = 1 << 14
IS_BEGIN, IS_INSIDE = (np.array([x[0] == p for x in LABELS]) for p in "BI")
FIRST = np.array([0.0 if x[0] != "I" else -1e6 for x in LABELS])


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while m := (at and _EMAIL_AT.match(text, at)) or _EMAIL.search(text, at):
        yield m.span()
        at = m.end()


def pattern_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, rank of the kind, end, kind) of what the patterns find, in order."""
    found = []
    if "@" in text:
        found += [(a, 0, b) for a, b in _emails(text)]
    found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
    for m in _CARD.finditer(text):
        if 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(found)


def _shape(t: str) -> str:
    if t[0].isdigit():
        return f"d{min(len(t), 9)}"
    if t[0].isalpha():
        return t.lower() if len(t) <= 3 or t.lower() in ("phone", "call", "mail", "email", "card", "visa") else "Xx" if t[0].isupper() else "x"
    return t


def _features(tokens: list[str]) -> np.ndarray:
    """Feature numbers of each token: its shape, and those around it."""
    s = ["<", "<", *map(_shape, tokens), ">", ">"]
    rows = []
    for i in range(2, len(s) - 2):
        names = (f"0{s[i]}", f"-{s[i - 1]}", f"+{s[i + 1]}", f"-0{s[i - 1]} {s[i]}", f"0+{s[i]} {s[i + 1]}", f"-+{s[i - 1]} {s[i + 1]}", f"--{s[i - 2]} {s[i - 1]}", f"++{s[i + 1]} {s[i + 2]}", "1")
        rows.append([zlib.crc32(n.encode()) % HASHED for n in names])
    return np.array(rows, np.int64).reshape(-1, 9)


def labelled_table(rows: int = 600, seed: int = 5) -> list[tuple[list[str], list[str]]]:
    """Tokens and labels of made-up sentences: personal data in several ways of writing, and numbers that are none."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("aeionrstlmdu") for _ in range(r.randint(2, 9)))
    num = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    some = {
        "email": [lambda: f"{word()}@{word()}.{r.choice(['com', 'org', 'net'])}", lambda: f"{word()} [at] {word()} [dot] com", lambda: f"{word()}.{word()} (at) {word()}.org", lambda: f"{word()} @ {word()}.net", lambda: f"{word()} (at) {word()} (dot) {r.choice(['com', 'net'])}"],
        "ip": [lambda: ".".join(str(r.randint(0, 255)) for _ in range(4)), lambda: " . ".join(str(r.randint(0, 255)) for _ in range(4)), lambda: "[.]".join(str(r.randint(0, 255)) for _ in range(4))],
        "card": [lambda: " ".join(num(4) for _ in range(4)), lambda: "-".join(num(4) for _ in range(4)), lambda: num(16), lambda: ".".join(num(4) for _ in range(4))],
        "phone": [lambda: f"+{num(2)} {num(3)} {num(4)} {num(3)}", lambda: f"({num(3)}) {num(3)}-{num(4)}", lambda: f"{num(3)}-{num(3)}-{num(4)}", lambda: f"tel {num(4)} {num(6)}", lambda: f"{num(3)}.{num(3)}.{num(4)}", lambda: f"phone {num(3)} {num(3)} {num(4)}"],
    }
    none = [lambda: f"20{num(2)}-0{num(1)}-1{num(1)}", lambda: f"{num(2)},{num(3)}.{num(2)}", lambda: f"v{num(1)}.{num(1)}.{num(1)}", lambda: f"1{num(1)}:{num(2)}", lambda: num(r.randint(1, 8)), lambda: f"{num(2)} - {num(2)}", lambda: f"({num(4)})", lambda: f"{num(1)}.{num(1)}.", lambda: f"no {num(5)} / {num(4)}", lambda: f"{num(3)} {num(3)}", lambda: num(20)]
    out = []
    for _ in range(rows):
        parts = [(" ".join(word() for _ in range(r.randint(0, 6))), "")]
        for _ in range(r.randint(1, 3)):
            kind = r.choice([*KINDS, "", "", ""])
            text = r.choice(some[kind] if kind else none)()
            lead = re.match(r"(tel|phone) ", text)
            parts += [(lead[0], ""), (text[lead.end() :], kind)] if lead else [(text, kind)]
            parts.append((r.choice(["", ",", ".", ";"]) + " " + " ".join(word() for _ in range(r.randint(1, 6))), ""))
        tokens, labels = [], []
        for text, kind in parts:
            for i, t in enumerate(_TOKEN.findall(text)):
                tokens.append(t)
                labels.append(f"{'I' if i else 'B'}-{kind}" if kind else "O")
        out.append((tokens, labels))
    return out


def _lse(a: np.ndarray, axis: int) -> np.ndarray:
    m = a.max(axis, keepdims=True)
    return (m + np.log(np.exp(a - m).sum(axis, keepdims=True))).squeeze(axis)


def train(table: list[tuple[list[str], list[str]]] | None = None, passes: int = 6, rate: float = 0.3, l2: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """Weights (feature, label) and (label, next label), by adaptive gradient steps on the log-likelihood."""
    k = len(LABELS)
    w, t = np.zeros((HASHED, k)), np.zeros((k, k))
    gw, gt = np.full((HASHED, k), 1e-6), np.full((k, k), 1e-6)
    data = [(_features(a), np.array([LABELS.index(x) for x in b])) for a, b in (labelled_table() if table is None else table) if len(a)]
    for _ in range(passes):
        for f, y in data:
            e, n = w[f].sum(1), len(y)
            fore, back = np.empty((n, k)), np.zeros((n, k))
            fore[0] = e[0]
            for i in range(1, n):
                fore[i] = e[i] + _lse(fore[i - 1][:, None] + t, 0)
            for i in range(n - 2, -1, -1):
                back[i] = _lse(t + (e[i + 1] + back[i + 1])[None], 1)
            z = _lse(fore[-1], 0)
            g = np.exp(fore + back - z)
            g[np.arange(n), y] -= 1
            d = np.zeros((k, k))
            if n > 1:
                d = np.exp(fore[:-1, :, None] + t[None] + (e + back)[1:, None, :] - z).sum(0)
                np.subtract.at(d, (y[:-1], y[1:]), 1)
            full = np.repeat(g, f.shape[1], 0)
            i = f.ravel()
            np.add.at(gw, i, full**2)
            np.add.at(w, i, -rate * (full + l2 * w[i]) / np.sqrt(gw[i]))
            gt += d**2
            t -= rate * (d + l2 * t) / np.sqrt(gt)
    for a in range(k):  # inside only follows begin or inside of its kind
        for b in range(k):
            if LABELS[b][0] == "I" and LABELS[a][1:] != LABELS[b][1:]:
                t[a, b] = -1e6
    return w, t


def viterbi(runs: list[np.ndarray], w: np.ndarray, t: np.ndarray) -> list[np.ndarray]:
    """Best labels of each run of tokens, given its features; runs of about one length are decoded together."""
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(runs)
    order = sorted(range(len(runs)), key=lambda i: len(runs[i]))
    groups: list[list[int]] = []
    for i in order:
        if not groups or (len(groups[-1]) + 1) * len(runs[i]) > CELLS:
            groups.append([])
        groups[-1].append(i)
    for part in groups:
        longest = max(len(runs[i]) for i in part)
        if not longest:
            continue
        e = np.zeros((len(part), longest, len(LABELS)))
        for j, i in enumerate(part):
            e[j, : len(runs[i])] = w[runs[i]].sum(1)
        lens = np.array([len(runs[i]) for i in part])
        best, came = e[:, 0] + FIRST, np.zeros((len(part), longest, len(LABELS)), np.uint8)
        for i in range(1, longest):
            s = best[:, :, None] + t[None]
            came[:, i] = s.argmax(1)
            best = np.where((i < lens)[:, None], s.max(1) + e[:, i], best)
        for j, i in enumerate(part):
            y = np.zeros(lens[j], np.int64)
            if lens[j]:
                y[-1] = best[j].argmax()
                for x in range(lens[j] - 1, 0, -1):
                    y[x - 1] = came[j, x, y[x]]
            out[i] = y
    return out


def viterbi_in_blocks(blocks: Iterator[np.ndarray], w: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Best labels of one run whose features come in blocks: what is carried on is one column of scores."""
    came, best = [], None
    for f in blocks:
        e, back = w[f].sum(1), np.zeros((len(f), len(LABELS)), np.uint8)
        for i in range(len(f)):
            if best is None:
                best = e[i] + FIRST
                continue
            s = best[:, None] + t
            back[i] = s.argmax(0)
            best = s.max(0) + e[i]
        came.append(back)
    n = sum(map(len, came))
    y = np.zeros(n, np.uint8)
    if n:
        y[-1] = best.argmax()
    for back in reversed(came):
        for row in back[::-1]:
            n -= 1
            if n:
                y[n - 1] = row[y[n]]
    return y


def token_features(text: str, a: int, b: int, start: array, stop: array) -> Iterator[np.ndarray]:
    """Features of the tokens of text[a:b] in blocks of LONG; each token's place is added to start and stop."""
    held, left = [], 0  # the first `left` are there for their neighbours
    for x in _TOKEN.finditer(text, a, b):
        start.append(x.start())
        stop.append(x.end())
        held.append(x[0])
        if len(held) == left + LONG + 2:
            yield _features(held)[left:-2]
            held, left = held[-4:], 2
    if len(held) > left:
        yield _features(held)[left:]


class Taken:
    """Stretches of a text that spans cover."""

    def __init__(self, spans: list[tuple]):
        self.start, self.stop = array("q"), array("q")
        for a, _, b in spans:  # by start
            if self.stop and a < self.stop[-1]:
                self.stop[-1] = max(b, self.stop[-1])
            else:
                self.start.append(a)
                self.stop.append(b)

    def touches(self, a: int, b: int) -> bool:
        i = bisect_right(self.stop, a)
        return i < len(self.stop) and self.start[i] < b


def _open_lines(text: str, taken: Taken) -> Iterator[tuple[int, int, int]]:
    """Begin, end and number of tokens of each line with a trigger that the patterns have left; the number stops at LONG + 1."""
    end = 0
    for m in _TRIGGER.finditer(text):
        if m.start() < end:
            continue
        a, b = text.rfind("\n", 0, m.start()) + 1, text.find("\n", m.start())
        end = len(text) if b < 0 else b
        n, left = 0, False
        for x in _TOKEN.finditer(text, a, end):
            n += 1
            left = left or (_TRIGGER.match(text, x.start()) is not None and not taken.touches(*x.span()))
            if left and n > LONG:
                break
        if left:
            yield a, end, n


def _plausible(kind: str, s: str) -> bool:
    n = len(_digits(s))
    if kind == "phone":
        return 7 <= n <= 15
    if kind == "card":
        return 14 <= n <= 19 and luhn(_digits(s))
    if kind == "ip":
        return len(x := re.findall("[0-9]+", s)) == 4 and all(len(v) <= 3 and int(v) <= 255 for v in x)
    return bool(re.search(r"@|[\[({]\s*at\s*[\])}]", s, re.I)) and len(s) >= 6


def find_spans(texts: list[str], w: np.ndarray, t: np.ndarray) -> list[tuple[list, list]]:
    """For each text its pattern spans, and those and the field's spans together."""
    base = [pattern_spans(x) for x in texts]
    every = [list(b) for b in base]
    pending: list[tuple] = []

    def keep(i: int, taken: Taken, start: array, stop: array, y: np.ndarray) -> None:
        begins = np.flatnonzero(IS_BEGIN[y])  # a label that isn't inside ends what came before
        ends = np.append(np.flatnonzero(~IS_INSIDE[y]), len(y))
        for at, to in zip(begins.tolist(), ends[np.searchsorted(ends, begins, "right")].tolist(), strict=True):
            a, b, kind = start[at], stop[to - 1], LABELS[y[at]][2:]
            if not taken.touches(a, b) and _plausible(kind, texts[i][a:b]):
                every[i].append((a, KINDS.index(kind), b))

    def decode() -> None:
        for (i, taken, start, stop, _), y in zip(pending, viterbi([f for *_, f in pending], w, t), strict=True):
            keep(i, taken, start, stop, y)
        pending.clear()

    waiting = 0
    for i, x in enumerate(texts):
        taken = Taken(base[i])
        for a, b, n in _open_lines(x, taken):
            start, stop = array("q"), array("q")
            if n > LONG:
                y = viterbi_in_blocks(token_features(x, a, b, start, stop), w, t)
                keep(i, taken, start, stop, y)
                continue
            pending.append((i, taken, start, stop, np.concatenate(list(token_features(x, a, b, start, stop)))))
            waiting += n
            if waiting > PENDING:
                decode()
                waiting = 0
    decode()
    return [(b, sorted(set(e))) for b, e in zip(base, every, strict=True)]


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


COLUMNS = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def _find(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            some = pc.fill_null(pc.match_substring_regex(texts, r"[0-9@\[({]"), False).to_pylist()
            at = [i for i, s in enumerate(some) if s]
            found = dict(zip(at, find_spans(texts.take(pa.array(at, pa.int64())).to_pylist(), *model.value), strict=True))
            cols: list[list] = [[] for _ in range(6)]
            for i in range(batch.num_rows):
                base, every = found.get(i, ((), ()))
                n = {k: len(list(g)) for k, g in groupby(sorted(b[1] for b in base))}
                for c, v in zip(cols, (*(n.get(k, 0) for k in range(4)), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every)), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64() if i < 4 else pa.string()) for i, c in enumerate(cols))], ["key", *(c.split()[0] for c in COLUMNS.split(", "))])

    return run


def evaluate(model: tuple[np.ndarray, np.ndarray], table: list[tuple[list[str], list[str]]]) -> dict[str, tuple[float, float]]:
    """Precision and recall of the field's spans by kind on a labelled table."""

    def spans(labels: list[str]) -> set[tuple[int, int, str]]:
        cuts = [i for i, x in enumerate([*labels, "O"]) if x[0] != "I"]
        return {(a, b, labels[a][2:]) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if labels[a] != "O"}

    table = [(a, b) for a, b in table if a]
    got = [spans([LABELS[i] for i in y]) for y in viterbi([_features(a) for a, _ in table], *model)]
    out = {}
    for kind in KINDS:
        found, right = ([{s for s in x if s[2] == kind} for x in y] for y in (got, [spans(b) for _, b in table]))
        hit = sum(len(x & y) for x, y in zip(found, right, strict=True))
        out[kind] = hit / max(1, sum(map(len, found))), hit / max(1, sum(map(len, right)))
    return out


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text", labelled: DataFrame | None = None) -> DataFrame:
    """The key, how many spans of each kind the patterns found, their digest, and all spans as kind:start:end. labelled: tokens and labels (arrays of
    strings) of at most some thousand sentences."""
    table = None if labelled is None else [(r.tokens, r.labels) for r in labelled.select("tokens", "labels").collect()]
    model = docs.sparkSession.sparkContext.broadcast(train(table))
    found = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(_find(model), f"key {docs.schema[key].dataType.simpleString()}, {COLUMNS}")
    return found.withColumnRenamed("key", key)


def redact(text: str, spans: str) -> str:
    """The text with each span (as `personal_data` gives them) replaced by its kind in angle brackets."""
    out, at = [], 0
    for s in filter(None, spans.split(",")):
        kind, a, b = s.split(":")
        if int(a) >= at:
            out += [text[at : int(a)], f"<{kind}>"]
            at = int(b)
    return "".join([*out, text[at:]])
