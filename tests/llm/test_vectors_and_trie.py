"""Whitening, exact top-k products and the conversation trie against brute force, with nulls, ties, repeats, hot keys, empty tables and clashing names."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.llm import extract, products, running, trie, whitening
from tagloom.llm.decontaminate import contamination
from tagloom.llm.scratch import Scratch

SCHEMA = "vec_id long, embedding array<float>, n long, key string, id int"


def vectors(seed=3, n=300, dim=12):
    r = np.random.default_rng(seed)
    x = (r.standard_normal((n, dim)) * np.linspace(3, 0.2, dim) + r.standard_normal(dim)).astype(np.float32)
    rows = [(i, v.tolist(), 1, "a", 7) for i, v in enumerate(x)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [1.0] * (dim - 1), [nan] + [1.0] * (dim - 1), [inf] + [1.0] * (dim - 1), [None] + [1.0] * (dim - 1), [1e30] * dim]
    return rows + [rows[0], rows[5], (None, x[3].tolist(), 1, "b", 7), (900, [0.0] * dim, 1, "b", 7)] + [(1000 + 50 * i, v, 1, "b", 7) for i, v in enumerate(odd)]


def taken(rows, scale, add, dim=12):
    good = [(i, np.floor(np.array(v, np.float64) * scale)) for i, v, *_ in rows if v is not None and len(v) == dim and None not in v and np.isfinite(v).all() and max(map(abs, v)) * scale < 2**62]
    return [i for i, _ in good], np.array([v for _, v in good]).astype(np.int64) + add


def test_whitening(spark):
    rows = vectors()
    got = whitening.whitened(spark.createDataFrame(rows, SCHEMA).repartition(5)).toPandas()
    ids, x = taken(rows, 1024, 100_000)
    n = len(x)
    s = x.sum(0)
    c = x - s / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    assert len(got) == 8 * n and set(got.n) == {n} and got.identity_error.max() < 1e-10
    want = c @ v[:, :8] / np.sqrt(e[:8])
    deviation = ((n * x.astype(object) - s) ** 2).sum(1)
    for k in range(8):
        part = got[got.component == k + 1]
        assert np.allclose(part.explained, e[k] / e.sum(), rtol=1e-10)
        key = lambda ids, d, z: sorted((-1 if i is None or i != i else int(i), int(a), round(float(b), 7)) for i, a, b in zip(ids, d, z, strict=True))
        plus = key(ids, deviation, want[:, k])
        assert key(part.vec_id, part.deviation, part.whitened) in (plus, key(ids, deviation, -want[:, k]))


def test_whitening_without_variance(spark):
    flat = [(i, [float(i % 3), 2.0 * (i % 3), 5.0], 1, "a", 7) for i in range(9)]
    got = whitening.whitened(spark.createDataFrame(flat, SCHEMA)).toPandas()
    assert len(got) == 27 and got[got.component > 1].whitened.isna().all() and got[got.component == 1].explained.iloc[0] == pytest.approx(1)
    one = whitening.whitened(spark.createDataFrame(flat[:1], SCHEMA)).toPandas()
    assert len(one) == 3 and one.whitened.isna().all() and one.explained.isna().all() and set(one.deviation) == {0}
    assert whitening.whitened(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whitened(spark.createDataFrame([(1, None, 1, "a", 7)], SCHEMA)).count() == 0


def test_whitening_of_large_numbers_and_bad_condition(spark):
    r = np.random.default_rng(1)
    x = r.standard_normal((400, 4)) @ np.diag([1e7, 1e3, 1, 0.02])
    got = whitening.whitened(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).toPandas()
    assert got.identity_error.max() < 1e-4 and got.deviation.isna().any() and got.deviation.notna().sum() == sum(d < 2**63 for d in exact_deviations(x)) * 4


def exact_deviations(x):
    w = np.floor(x * 1024).astype(np.int64).astype(object) + 100_000
    return ((len(w) * w - w.sum(0)) ** 2).sum(1)


def best_products(rows, every, k):
    ids, y = taken([r for r in rows if r[0] is not None], 256, 0)
    y = y.astype(object)
    out = []
    for a, i in enumerate(ids):
        if i % every == 0:
            near = sorted((-int(y[a] @ y[b]), j) for b, j in enumerate(ids) if b != a)[:k]
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("block", [2048, 16])
def test_products(spark, monkeypatch, block):
    monkeypatch.setattr(products, "RUN", 64)
    monkeypatch.setattr(products, "QUERIES", 5)
    rows = vectors() + [(50 * i, [1.0] * 12, 1, "tie", 7) for i in range(30)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    monkeypatch.setattr(products, "BLOCK", block)
    got = products.top_products(frame, every=10)
    assert sorted(tuple(r) for r in got.collect()) == best_products(rows, 10, 5)


def test_products_few_and_large(spark):
    few = [(0, [1.0, 2.0], 1, "a", 7), (1, [2.0, 2.0], 1, "a", 7)]
    assert [tuple(r) for r in products.top_products(spark.createDataFrame(few, SCHEMA)).collect()] == [(0, 1, 1, 6 * 65536)]
    assert products.top_products(spark.createDataFrame(few[1:], SCHEMA)).count() == 0
    assert products.top_products(spark.createDataFrame([], SCHEMA)).count() == 0
    big = [(i, [float(1 << 40), float(i)], 1, "a", 7) for i in range(4)]
    assert {r.score for r in products.top_products(spark.createDataFrame(big, SCHEMA)).collect()} == {2**63 - 1}
    exact = [(i, [float(1 << 20) + i, -3.0 * i], 1, "a", 7) for i in range(60)]
    got = products.top_products(spark.createDataFrame(exact, "vec_id long, embedding array<double>, n long, key string, id int"))
    assert sorted(tuple(r) for r in got.collect()) == sorted((q, k + 1, j, -s) for q in (0, 50) for k, (s, j) in enumerate(sorted((-(((1 << 28) + 256 * q) * ((1 << 28) + 256 * j) + 9 * 65536 * q * j), j) for j in range(60) if j != q)[:5]))


def test_running(spark):
    r = random.Random(5)
    rows = [(k, i, r.randrange(-(2**63), 2**63)) for k in (1, 2, 3, 3, 9) for i in range(r.choice([1, 7, 400]))] + [(5, i, 1 << 62) for i in range(2000)]
    got = running.running(spark.createDataFrame(rows, "k long, i long, v long").repartition(3), "k", [F.col("i"), F.col("v")], ["v"], Scratch(spark), "run")
    want, at = [], {}
    for k, i, v in sorted(rows):
        n, s = at.get(k, (0, 0))
        at[k] = (n + 1, (s + v + 2**63) % 2**64 - 2**63)
        want.append((k, i, v, *at[k]))
    assert sorted(tuple(x) for x in got.collect()) == sorted(want)


def brute_trie(rows):
    convs = {}
    for c, t, role, text in rows:
        if c is not None:
            md5 = lambda x: hashlib.md5((x or "").encode()).hexdigest()
            convs.setdefault(c, []).append((t is not None, t or 0, hashlib.md5((md5(role) + md5(text)).encode()).digest(), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(v)] for c, v in convs.items()}
    nodes = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        path = own.get(base, [])[:h] + own[c][h:]
        for d in range(len(path) + 1):
            nodes.setdefault(tuple(path[:d]), []).append((c, d == len(path)))
    out, totals = [], {}
    for p in sorted(nodes, key=len, reverse=True):
        kids = totals.get(p, [0, 0, 0])
        own_saved = (len(nodes[p]) - 1) * (len(re.findall("[^\x20\x09-\x0d]+", p[-1][1])) if p else 0)
        leaves, saved = kids[1] or 1, kids[2] + own_saved
        if p:
            up = totals.setdefault(p[:-1], [0, 0, 0])
            up[0], up[1], up[2] = up[0] + 1, up[1] + leaves, up[2] + saved
        ends = ",".join(str(c) for c in sorted(c for c, e in nodes[p] if e))
        first = lambda q: min(c for c, _ in nodes[q])
        out.append((first(p), len(p), first(p[:-1]) if p else None, len(nodes[p]), kids[0], leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def talk(seed=2, n=260):
    r = random.Random(seed)
    pool = [f"word{i} " * (i % 5) for i in range(6)]
    rows = [(c, t, r.choice(["user", "assistant", None]), r.choice(pool)) for c in range(n) for t in range(r.choice([1, 2, 3, 9])) if c % 7 or t]
    rows += [(1000 + c, t, "user", f"same {t}") for c in range(60) for t in range(6)]  # many copies
    rows += [(2020, t, "user", f"long {t % 3}") for t in range(900)] + [(2021, t, "user", f"long {t % 3}") for t in range(700)]
    rows += [(None, 1, "user", "none"), (7, None, "user", "first"), (8, 2, None, None), (8, 2, "user", "tie"), (8, 2, "user", "tie"), (-3, 0, "user", "neg"), (-41, 0, "user", "x"), (3000, 0, "user", "a" * 100_000)]
    return rows


@pytest.mark.parametrize(("shard", "queue"), [(4096, 1 << 20), (4, 8), (30, 1)])
def test_trie(spark, shard, queue):
    rows = talk()
    frame = spark.createDataFrame([(*x, 1, "t") for x in rows], "conv_id long, turn long, role string, text string, depth long, conv string").repartition(5)
    assert sorted((tuple(x) for x in trie.prefix_trie(frame, shard, queue).collect()), key=str) == brute_trie(rows)


def test_trie_split_conversations(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 64)
    rows = talk(4, 60)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted((tuple(x) for x in trie.prefix_trie(frame, 16).collect()), key=str) == brute_trie(rows)


def test_trie_empty(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert trie.prefix_trie(spark.createDataFrame([], schema)).count() == 0
    assert trie.prefix_trie(spark.createDataFrame([(None, 0, "user", "x")], schema)).count() == 0
    alone = trie.prefix_trie(spark.createDataFrame([(5, 0, "user", "x")], schema)).collect()
    assert sorted((tuple(x) for x in alone), key=str) == brute_trie([(5, 0, "user", "x")])


def test_queue_spills():
    q = trie.LevelQueue(4)
    r = np.random.default_rng(0)
    sent = {}
    for _ in range(20):
        level, rows = r.integers(0, 5, 6), r.integers(0, 9, (6, 3))
        q.push(level, rows)
        for x, (conv, a, b) in zip(level.tolist(), rows.tolist(), strict=True):
            s = sent.setdefault(x, {}).setdefault(conv, [0, 0])
            s[0], s[1] = s[0] + a, s[1] + b
    assert q.file is not None
    for level in range(4, -1, -1):
        assert {int(c): [int(a), int(b)] for c, a, b in q.pop(level)} == sent.get(level, {})


@pytest.mark.parametrize("most", [500_000, 0])
def test_clashing_names_of_contaminated_documents(spark, most):
    words = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"a {words} b", 5, "r", [1]), (2, "clean", 6, "s", [2])], "doc_id long, text string, _row int, n_words string, _FOUND array<int>")
    tests = spark.createDataFrame([("i", words)], "item_id string, text string")
    got = contamination(docs, tests, broadcast_windows=most)
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.contaminated, r["_row"], r["_FOUND"]) for r in got.collect()) == [(1, 14, 12, True, 5, [1]), (2, 1, 0, False, 6, [2])]


def test_unclosed_tags_take_linear_time():
    began = time.time()
    for page in ("<a " * 300_000, "<!" * 500_000, "<p>kept</p>" + "<a " * 300_000, "<a \"'" * 100_000 + ">"):
        text = extract.main_text(page, {"path": [], "host": frozenset(), "template": {}})
        assert text == ("kept" if "kept" in page else "")
    assert time.time() - began < 20
