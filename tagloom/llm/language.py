"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

Texts become code points: letters lower-cased, digits one symbol, white space one symbol. N-grams of 1 to 3 are hashed to 2**15
features; a document's vector is log(1 + count) * idf, of length 1, with document frequencies of all labelled rows. Weights are learned by follow-the-regularised-leader with an elastic
net, one pass after another over a bounded sample of labelled rows; a temperature fitted on rows left out of the sample's
training makes the score a probability. Sample: for each language about `sample_rows` / (number of languages) rows, taken by a hash
of the id and the text, features made on the executors from whole texts, so the driver holds about `sample_rows` sparse vectors.
Prediction covers every row and its whole text.

A null text, or one without a letter, is `und` with score 0; so is every text if nothing could be learned. Rows without a language
teach nothing. A null id counts as an empty text where ids are hashed; repeated rows get the same answer and come into the sample together; ties go to the
language that sorts first. A very long text is folded a part at a time. Other columns pass through; those named like the new ones give way.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.wordhash import blocks, flat, mix

BITS, ORDERS, AT_ONCE, CHUNK = 15, 3, 32, 1 << 20
FEATURES = 1 << BITS
_FACTORS = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 63, ORDERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_tables: list[np.ndarray] = []


def _fold() -> tuple[np.ndarray, np.ndarray]:
    """For each code point of the basic plane: what it counts as, and whether it is a letter."""
    if not _tables:
        fold, letter = np.arange(1 << 16, dtype=np.uint32), np.zeros(1 << 16, bool)
        for i in range(1 << 16):
            c = chr(i)
            letter[i] = c.isalpha()
            fold[i] = 0x20 if c.isspace() else 0x30 if c.isdigit() else ord(c.lower()) if len(c.lower()) == 1 else i
        _tables.extend((fold, letter))
    return _tables[0], _tables[1]


def counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A row of n-gram counts for each of a few texts, and whether it has a letter."""
    fold, letter = _fold()
    out, lettered = np.zeros((len(texts), FEATURES), np.float32), np.zeros(len(texts), bool)
    for i, text in enumerate(texts.to_pylist()):
        for at in range(0, len(text or ""), CHUNK):
            raw = np.frombuffer(text[at : at + CHUNK + ORDERS - 1].encode("utf-32-le", "surrogatepass"), np.uint32)
            low = raw < 1 << 16
            c = np.where(low, fold[np.where(low, raw, 0)], raw).astype(np.uint64)
            lettered[i] |= letter[raw[low]].any() or any(chr(x).isalpha() for x in set(raw[~low].tolist()))
            h, n = np.zeros(len(c), np.uint64), min(CHUNK, len(c))
            for k in range(min(ORDERS, len(c))):
                h = (h[: len(c) - k] if k else h) + c[k:] * _FACTORS[k]
                out[i] += np.bincount((mix(h[:n] + np.uint64(k)) >> np.uint64(64 - BITS)).astype(np.int64), minlength=FEATURES)
    return out, lettered


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            part = batch.slice(at, AT_ONCE)
            rows, lettered = counts(part.column(1))
            idx = [np.flatnonzero(r) for r in rows]
            got = [part.column(0), part.column(2), pa.array([x.astype(np.uint16).tobytes() for x in idx]), pa.array([r[x].tobytes() for r, x in zip(rows, idx, strict=True)], pa.binary())]
            yield pa.RecordBatch.from_arrays(got, ["lang", "mark", "idx", "cnt"]).filter(pa.array(lettered))


def _softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class LanguageModel:
    """Weights, idf and temperature; made by `train`."""

    def __init__(self, langs: list[str], idf: np.ndarray, weights: np.ndarray, bias: np.ndarray, temperature: float = 1.0):
        self.langs, self.idf, self.weights, self.bias, self.temperature = langs, idf, weights, bias, temperature

    def scores(self, rows: np.ndarray) -> np.ndarray:
        x = np.log1p(rows) * self.idf
        x /= np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)
        return (x @ self.weights + self.bias) / self.temperature


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's texts with each feature, and the number of its texts as feature -1."""
    df, n = np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            rows, _ = counts(batch.column(0).slice(at, AT_ONCE))
            df += (rows > 0).sum(0)
            n += len(rows)
    if n:
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, -1)), pa.array(np.append(df[seen], n))], ["feature", "n"])


def train(rows: list[tuple[str, int, np.ndarray, np.ndarray]], df: np.ndarray, texts: int, passes: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02) -> LanguageModel | None:
    """rows: (language, mark, feature numbers, counts), in any order; one fifth, by mark, only sets the temperature. df: of all texts, by feature."""
    langs = sorted({r[0] for r in rows})
    if not langs:
        return None
    rows = sorted(rows, key=lambda r: (r[1], r[0], r[2].tobytes(), r[3].tobytes()))
    idf = np.log((1 + texts) / (1 + df)).astype(np.float32) + np.float32(1)
    data = []
    for lang, mark, idx, cnt in rows:
        x = np.log1p(cnt) * idf[idx]
        data.append((langs.index(lang), mark, idx, (x / max(math.sqrt(float(x @ x)), 1e-12)).astype(np.float32)))
    held = [d for d in data if d[1] % 5 == 0] if len(data) >= 50 else data
    taught = [d for d in data if d[1] % 5] if len(data) >= 50 else data
    k = len(langs)
    z, n, w = (np.zeros((FEATURES + 1, k)) for _ in range(3))
    for _ in range(passes):
        for y, _, idx, x in taught:
            i, v = np.append(idx.astype(np.int64), FEATURES), np.append(x, 1.0)  # the last is the bias
            zi, ni = z[i], n[i]
            wi = np.where(np.abs(zi) > l1, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2), 0.0)
            p = _softmax(v @ wi)
            p[y] -= 1
            g = v[:, None] * p
            z[i] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha * wi
            n[i] = ni + g * g
    w = np.where(np.abs(z) > l1, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)
    model = LanguageModel(langs, idf, w[:-1].astype(np.float32), w[-1].astype(np.float32))
    s = np.array([x @ w[idx] + w[-1] for _, _, idx, x in held])
    y = np.array([d[0] for d in held])
    grid = [2.0 ** (t / 8) for t in range(-40, 41)]
    model.temperature = min(grid, key=lambda t: -np.log(np.maximum(_softmax(s / t)[np.arange(len(y)), y], 1e-15)).mean())
    return model


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample_rows: int = 4000) -> LanguageModel | None:
    """Train on labelled rows; rows without language or text are left out."""
    mark = F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")), F.col(text), F.lit(5)), F.lit(1 << 30))
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), mark.alias("mark"))
    n = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    if not n:
        return None
    share = sample_rows / len(n)
    most = F.create_map(*(x for k, v in n.items() for x in (F.lit(k), F.lit(int(min(1.0, share / v) * (1 << 30))))))
    got = rows.filter(F.col("mark") < F.try_element_at(most, F.col("lang"))).select("lang", "text", "mark").mapInArrow(_features, "lang string, mark long, idx binary, cnt binary").toArrow()
    sums = dict(rows.select("text").mapInArrow(_frequencies, "feature long, n long").groupBy("feature").agg(F.sum("n")).collect())  # a row for each feature
    texts, df = sums.pop(-1), np.zeros(FEATURES)
    df[list(sums)] = list(sums.values())
    return train([(a.as_py(), b.as_py(), np.frombuffer(c.as_py(), np.uint16), np.frombuffer(d.as_py(), np.float32)) for a, b, c, d in zip(*got.columns, strict=True)], df, texts)


def identify(docs: DataFrame, model: LanguageModel | None, text: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """Add the predicted language and its probability; all other columns stay as they are."""
    docs = docs.drop(*{pred, score} - {text})
    kept = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts, best, prob = batch.column(batch.schema.get_field_index(text)), [], []
            for at in range(0, batch.num_rows, AT_ONCE):
                rows, lettered = counts(texts.slice(at, AT_ONCE))
                p = _softmax(m.scores(rows)) if m else None
                for i, ok in enumerate(lettered):
                    j = int(p[i].argmax()) if m and ok else -1
                    best.append(m.langs[j] if j >= 0 else "und")
                    prob.append(float(p[i, j]) if j >= 0 else 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.string()), pa.array(prob, pa.float64())], [*batch.schema.names, pred, score])

    return docs.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), f"`{pred}` string, `{score}` double"])).select(*kept, pred, score)


def reject_unknown(docs: DataFrame, model: LanguageModel | None, least: float = 0.5, text: str = "text") -> DataFrame:
    """Documents in a language that the model knows with at least this probability."""
    found = identify(docs.select(F.struct(*docs.columns).alias("doc"), F.col(text).alias("text")), model)
    return found.filter((F.col("lang_pred") != "und") & (F.col("score") >= least)).select("doc.*")
