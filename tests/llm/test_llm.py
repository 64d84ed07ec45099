"""The operators against brute force on small fixtures with nulls, empty and long texts, ties, repeats, empty tables and clashing names."""

import hashlib
import itertools
import json
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagloom.llm import extract, language, line_dedup, near_duplicates, neighbours, ngram, pack, pii, tokens, url_filter
from tagloom.llm.decontaminate import contamination, remove_contaminated
from tagloom.llm.queries import tokenizer_path
from tagloom.llm.scratch import Scratch, saved

WORDS = [a + b for a in "ba ke li mo nu re sa ti wo".split() for b in "ba ke li mo nu re sa ti wo".split()]


def low(x):
    return re.sub("[A-Z]", lambda m: m[0].lower(), x or "")


def space_words(x):
    return re.findall("[^\x20\x09-\x0d]+", low(x))


@pytest.fixture(scope="module")
def texts():
    r = random.Random(4)
    made = [" ".join(r.choice(WORDS) for _ in range(r.randint(1, 60))) for _ in range(40)]
    for i in range(40):
        x = made[i].split(" ")
        x[r.randrange(len(x))] = "Changed."
        made.append(" ".join(x))
    long = " ".join(r.choice(WORDS) for _ in range(20_000))
    return [*made, *made[:5], None, "", " \n\t ", "one", "one", long, long + " tail", "é ñ ß 日本 x"]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", "_doc clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, _extra string").repartition(3)


def groups(texts, size, percent):
    sets = []
    for t in texts:
        w = space_words(t)
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in range(len(sets))}


def test_near_duplicates(docs, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates.similar_groups(docs, size=4, percent=85).collect()}
    want = groups(texts, 4, 85)
    assert got == want
    kept = near_duplicates.one_of_each(docs, size=4, percent=85)
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in want.items() if c == i}
    assert kept.columns == docs.columns
    assert near_duplicates.similar_groups(docs.filter("false")).count() == 0


def test_line_dedup(spark):
    long = " ".join(WORDS[:40])
    near = long.replace(WORDS[39], "other")
    rows = [(2, f"{near}\nshort\nnew line of words here"), (1, f"{long}\nshort\n\na b c"), (3, "a b c\nshort"), (4, None), (5, ""), (None, long), (6, long), (6, long)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.text, r.n_removed) for r in line_dedup.remove_repeated_lines(df).collect()), key=str)
    assert got == sorted([(1, f"{long}\nshort\n\na b c", 0), (2, "new line of words here", 2), (3, "", 2), (4, None, 0), (5, "", 0), (0, "", 1), (6, "", 1), (6, "", 1)], key=str)
    assert line_dedup.remove_repeated_lines(df.filter("false")).count() == 0
    kept = line_dedup.remove_repeated_lines(df, least_words=4)
    assert {(r.doc_id, r.text) for r in kept.collect() if r.doc_id in (2, 3)} == {(2, "short\nnew line of words here"), (3, "a b c\nshort")}


def test_line_dedup_takes_direct_matches(spark):
    """Against brute force, with chains: a line goes if an earlier line is similar, whether that one stays or not; names clash, a text is very long."""
    r = random.Random(11)
    lines, rows = [" ".join(r.choice(WORDS) for _ in range(r.randint(1, 30))) for _ in range(30)], []
    for _ in range(200):  # chains: each a small change of some line before
        w = r.choice(lines).split(" ")
        w[r.randrange(len(w))] = r.choice(WORDS)
        lines.append(" ".join(w))
    r.shuffle(lines)
    for i in range(40):
        rows.append((i, "\n".join(lines[5 * i : 5 * i + 5]), 1, 2, "a", "b", "c", "d"))
    rows.append((40, "\n".join(" ".join(r.choice(WORDS) for _ in range(12)) for _ in range(3000)) + "\n" + lines[0], 1, 2, "a", "b", "c", "d"))
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines int, n_removed int, k string, h string, gone string, `row` string").repartition(4)
    got = line_dedup.remove_repeated_lines(df)
    assert got.columns == ["doc_id", "text", "k", "h", "gone", "row", "n_lines", "n_removed"]
    seen, index, want = [], {}, {}
    for i, text, *_ in rows:
        kept = []
        for x in text.split("\n"):
            w = space_words(x)
            s = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))}
            near = {y for t in s for y in index.get(t, ())}
            if not any(10 * len(s & seen[y]) >= 8 * len(s | seen[y]) for y in near):
                kept.append(x)
            for t in s:
                index.setdefault(t, []).append(len(seen))
            seen.append(s)
        want[i] = "\n".join(kept)
    assert {x.doc_id: x.text for x in got.collect()} == want


def brute_contamination(text, items, size):
    split = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low(t))
    w, hit, found = split(text), set(), set()
    for item, t in items:
        v = split(t)
        k = min(size, len(v))
        windows = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)} if k else set()
        for i in range(len(w) - k + 1) if k else ():
            if tuple(w[i : i + k]) in windows:
                hit |= set(range(i, i + k))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_decontamination(spark, docs, texts, broadcast):
    items = [(1, " ".join(texts[50].split(" ")[:15])), (2, "One!"), (3, None), (4, "..."), (10, " ".join(texts[50].split(" ")[2:14]).upper()), (5, texts[60])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(docs, bench, broadcast_windows=broadcast)
    seen = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in got.collect()}
    for i, t in enumerate(texts):
        n, hit, found = brute_contamination(t, items, 10)
        assert seen[i] == (n, hit, len(found)), i
    clean = remove_contaminated(docs, bench)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {i for i, v in seen.items() if not v[1]}
    assert contamination(docs, bench.filter("false"), broadcast_windows=broadcast).filter("contaminated").count() == 0


def test_language_model(docs, texts):
    model = ngram.count(docs)
    t = [[*space_words(x), "</s>"] for x in texts]
    n = sum(map(len, t))
    assert (model.tokens, model.texts, model.distinct) == (n, len(t), len({w for x in t for w in x}))
    count = lambda w: sum(x.count(w) for x in t)
    got = {r.doc_id: r for r in ngram.score(docs, model).collect()}
    for i in (0, 80, 85, 86):
        want = sum(np.log10((count(w) + 0.5) / (n + 0.5 * (model.distinct + 1))) for w in t[i])
        assert got[i].n_tokens == len(t[i]) and abs(got[i].base_score - want) < 1e-9
    a = ngram.Arrays(model)
    every = np.unique(np.concatenate([ngram.tokens(pa.array([x]))[0] for x in texts]))
    before = np.full(len(every), every[3])
    d, (total, *seen) = model.pair_discounts, a.firsts(every[3:4])
    follow = a.before(every)
    e = model.word_discounts
    lower = np.maximum(follow - e[np.minimum(follow, 3)], 0) / model.pairs + model.left / (model.distinct + 1)
    g = ngram.pair(before, every)
    order = np.argsort(g)
    c = np.empty(len(g), np.int64)
    c[order] = a.pairs(g[order], before[order])
    p = np.maximum(c - d[np.minimum(c, 3)], 0) / total[0] + sum(d[k + 1] * seen[k][0] for k in range(3)) / total[0] * lower
    assert abs(p.sum() + sum(d[k + 1] * seen[k][0] for k in range(3)) / total[0] * model.left / (model.distinct + 1) - 1) < 1e-9
    for i in (0, 80, 85, 86):  # the score, by counting
        pairs = Counter(p for x in t for p in zip(["<s>", *x], x, strict=False))
        firsts = {w for _, w in pairs}
        after = lambda w: [c for (v, _), c in pairs.items() if v == w]
        total_score = 0.0
        for v, w in zip(["<s>", *t[i]], t[i], strict=False):
            n_before = sum(b == w for _, b in pairs)
            low = max(n_before - e[min(n_before, 3)], 0) / len(pairs) + model.left / (len(firsts) + 1)
            c, own = pairs[v, w], after(v)
            rest = sum(d[min(x, 3)] for x in own)
            total_score += np.log10((max(c - d[min(c, 3)], 0) + rest * low) / sum(own))
        assert abs(got[i].score - total_score) < 1e-9
    clash = ngram.perplexity(docs.withColumns({"score": F.lit("x"), "n_tokens": F.lit(1)}), model)
    assert clash.columns == [*docs.columns, "score", "n_tokens", "perplexity"] and clash.filter("score <> 'x'").count() == 0
    assert ngram.score(docs.withColumn("score", F.lit("x")), model).columns == [*docs.columns, "n_tokens", "n_known", "base_score", "score"]
    none = ngram.count(docs.filter("false"))
    assert ngram.score(docs, none).agg(F.sum("score")).first()[0] == 0.0


def test_language_model_spreads_hot_words(spark, docs, monkeypatch):
    hot = docs.select("doc_id", F.expr("concat_ws(' ', text, array_join(array_repeat(concat('the ', doc_id), size(split(coalesce(text, ''), ' '))), ' '))").alias("text"))
    model = ngram.count(hot)
    load = ngram.loads(hot.select("text"))
    assert model.spread.any() and not model.spread.all() and load.sum() == model.tokens
    got = {r.doc_id: r.score for r in ngram.score(hot, model).collect()}
    monkeypatch.setattr(ngram, "loads", lambda rows: np.where(np.arange(ngram.BUCKETS) < model.tokens, 1, 0))
    plain = ngram.count(hot)
    assert not plain.spread.any() and plain.tokens == model.tokens and plain.pairs == model.pairs
    for r in ngram.score(hot, plain).collect():
        assert abs(got[r.doc_id] - r.score) < 1e-9
    some = np.unique(ngram.tokens(pa.array(["the 3 the 5 nothing", "ba ke li mo"]))[0])
    want, few, far = ngram.Arrays(model).firsts(some), ngram.Arrays(model), ngram.Arrays(model)
    far.local = False  # as on a store that can't be mapped
    monkeypatch.setattr(ngram, "MAPS", 2)
    monkeypatch.setattr(ngram, "KEPT_BYTES", 1000)
    for arrays in (few, far):
        assert (arrays.firsts(some) == want).all() and (arrays.before(some) == ngram.Arrays(plain).before(some)).all()
    assert len(few.maps) == 2 and (far.bytes <= 1000 or len(far.maps) == 1)


def test_url_filter(spark):
    urls = ["https://www.Example.com/en/1", "http://a.b.www.example.com/en/x?" + "y" * 50_000, "http://net/es/" + "z" * 50_000, "http://com/", "http://example.com/", "http://zzz.com/en/", "http://a.example.com/en/", "http://x.com", "http://x.com/?q", "https://b.net/fr/x#y", "ftp://net/es/", None, "no host", "http://example.com.org/en/", "http://xexample.com/en/"]
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rdf = spark.createDataFrame(rules, "host string, path string, verdict string")
    for r in url_filter.apply_rules(pages, rdf, salts=3).collect():
        fits = [(h + p, v) for h, p, v in rules if (r.host == h or r.host.endswith("." + h)) and r.path.startswith(p)]
        want = max(fits, key=lambda x: len(x[0]), default=(None, "allow"))
        assert (r.rule, r.verdict) == want, r
    assert url_filter.apply_rules(pages.unionByName(pages), rdf).count() == 2 * len(urls)
    deep = [(".".join("abcdefg"[i:]), "/", "allow" if i % 2 else "block") for i in range(7)]
    ddf = spark.createDataFrame(deep, "host string, path string, verdict string")
    hosts = [".".join("abcdefg"[i:]) for i in range(7)] + ["z." + ".".join("abcdefg"[i:]) for i in range(7)] + ["x.g", "f", "aa.b.c.d.e.f.g"]
    for r in url_filter.apply_rules(spark.createDataFrame([(i, f"http://{h}/") for i, h in enumerate(hosts)], "page_id long, url string"), ddf).collect():
        fits = [(h + p, v) for h, p, v in deep if r.host == h or r.host.endswith("." + h)]
        assert (r.rule, r.verdict) == max(fits, key=lambda x: len(x[0]), default=(None, "allow")), r
    assert url_filter.apply_rules(pages, rdf.filter("false")).filter("rule IS NOT NULL").count() == 0
    assert url_filter.apply_rules(pages.filter("false"), rdf).count() == 0


def test_pii(spark):
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    r = random.Random(6)
    for _ in range(20_000):
        x = "".join(r.choice("ab._@-@. ") for _ in range(r.randint(1, 25)))
        assert [m.span() for m in email.finditer(x)] == list(pii._emails(x))
    text = "é mail jo@ex.org, 10.0.0.256 10.0.0.25, 4111 1111 1111 1111, +1 (826) 555-4081 1.2.3.4 or (at) call (555) 123-4567 now, v1.2.3 of 2024-01-15"
    df = spark.createDataFrame([(1, text), (1, text), (2, None), (3, ""), (4, "a" * 300_000 + "@"), (5, "1 " * 50_000)], "doc_id long, text string")
    got = {x.doc_id: x for x in pii.personal_data(df).collect()}
    assert (got[1].n_email, got[1].n_ip, got[1].n_card) == (1, 2, 1)
    shown = pii.redact(text, got[1].spans)
    assert "jo@" not in shown and "4111" not in shown and "123-4567" not in shown and "v1.2.3" in shown
    assert [got[i].spans for i in (2, 3, 4)] == ["", "", ""]
    assert pii.personal_data(df.filter("false")).count() == 0


def test_pii_patterns_against_the_plain_ones(spark):
    """All kinds, their numbers and digest against the contract's patterns, on texts with many near misses."""
    plain = [re.compile(x) for x in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]
    digits = lambda x: re.sub("[^0-9]", "", x)

    def ok(kind, x):
        if kind == 1:
            return all(int(v) <= 255 for v in x.split("."))
        if kind == 2:
            d = [int(c) for c in digits(x)][::-1]
            return 14 <= len(d) <= 19 and (sum(d[::2]) + sum(v * 2 - 9 * (v > 4) for v in d[1::2])) % 10 == 0
        return kind == 0 or 10 <= len(digits(x)) <= 15

    r = random.Random(8)
    pieces = ["4111 1111 1111 1111", "4111111111111112", "10.0.0.1", "1.2.3.4.5.6.7.8", "256.1.1.1", "+1 (826) 555-4081", "+12-34", "a@b.c", "é@x.y", "@", ".", " ", "-", "+", "1", "23", "\n", "é", "x", "(", ")"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randint(1, 14))) for _ in range(1500)]
    rows = {x.doc_id: x for x in pii.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, x in enumerate(texts):
        want = sorted((m.start(), k, m.end()) for k, p in enumerate(plain) for m in p.finditer(x) if ok(k, m[0]))
        row = rows[i]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == j for _, k, _ in want) for j in range(4)], x
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and set(filter(None, joined.split(","))) <= set(row.spans.split(","))


def test_pii_field(spark):
    """Viterbi against all labellings, precision and recall on sentences not trained on, whole lines, a labelled table of one's own."""
    g = np.random.Generator(np.random.PCG64(2))
    w, t = g.standard_normal((pii.HASHED, len(pii.LABELS))), g.standard_normal((len(pii.LABELS), len(pii.LABELS)))
    runs = [pii._features(["a", "1", "@", "b"][:n]) for n in (1, 2, 3, 4)]
    for f, y in zip(runs, pii.viterbi(runs, w, t), strict=True):
        e = w[f].sum(1)
        value = lambda z: sum(e[i, v] for i, v in enumerate(z)) + sum(t[a, b] for a, b in zip(z, z[1:], strict=False))
        every = [z for z in itertools.product(range(len(pii.LABELS)), repeat=len(f)) if pii.LABELS[z[0]][0] != "I"]
        assert tuple(y.tolist()) == max(every, key=value)
    model = pii.train()
    for kind, (precision, recall) in pii.evaluate(model, pii.labelled_table(300, 77)).items():
        assert precision > 0.85 and recall > 0.85, kind
    far = " ".join(["word"] * 300)
    text = f"{far} mail jo (at) ex (dot) org {far}\n{far}"
    ((base, every),) = pii.find_spans([text], *model)
    assert not base and [text[a:b] for a, _, b in every] == ["jo (at) ex (dot) org"]
    table = spark.createDataFrame([(a, b) for a, b in pii.labelled_table(50) if a], "tokens array<string>, labels array<string>")
    assert pii.personal_data(spark.createDataFrame([(1, "x@y.z")], "doc_id long, text string"), labelled=table).first().n_email == 1


def test_pii_long_lines_in_blocks(monkeypatch):
    model = pii.train()
    lines = [" ".join(a) for a, _ in pii.labelled_table(400, 9)]
    texts = [" ".join(lines[:150]), "\n".join(lines[150:300]), "x@y.z 1.2.3.4 " * 50 + "me (at) there.org", "0" * 5000 + "1.2.3.4", "", "5"]
    whole = pii.find_spans(texts, *model)
    assert any(len(every) > len(base) for base, every in whole) and whole[3][0] == [(0, 1, 5007)]
    for long in (2, 3, 64):
        monkeypatch.setattr(pii, "LONG", long)
        assert pii.find_spans(texts, *model) == whole


def test_extract(spark):
    page = "<html><body><nav>menu</nav><div class='ad box'>ad</div><article><h1>T {0}</h1><p>one &amp;\n {0} <b>two<p>three<script>x('</p>')</script> four {0}<div id=comments>no</div></article><footer>f</footer>"
    rows = [(i, f"http://h/{i}", page.format(i)) for i in range(6)] + [(7, None, None), (8, "x", ""), (9, "http://h2/", "<p>a<br>b<ul><li>c<li>d</ul><aside>e</aside><ta")]
    got = {r.page_id: (r.text, r.n_chars) for r in extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[2] == ("T 2\none & 2 two\nthree four 2", 28) and got[7] == ("", 0) and got[8] == ("", 0) and got[9][0] == "a b\nc\nd"


def test_packing(docs, texts):
    path = tokenizer_path()
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    ids = [np.array(whole.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for t in texts]
    got = pack.pack(docs, path, window=256).collect()
    for i, want in enumerate(ids):
        pieces = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got if r.doc_id == i)
        at = 0
        for start, n, crc, total in pieces:
            assert start == at and total == len(want) and crc == zlib.crc32(want[start : start + n].tobytes())
            at += n
        assert at == len(want)
    by = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == by.get(r.sequence_id, 0)
        by[r.sequence_id] = r.offset + r.length
    assert all(n == 256 or (n < 256 and n & (n - 1) == 0) for n in by.values())
    assert pack.pack(docs.filter("false"), path).count() == 0
    encoder, r = tokens.WordEncoder(path), random.Random(2)
    some = ["".join(r.choice("abcDE'stém.,;!?|)9 \n\té«ñ<|x>ß́ ÀŸ日本") for _ in range(r.randint(0, 40))) for _ in range(2000)] + ["<|endoftext|> a <|ENDOFTEXT|> A"]
    flat, at, _, _ = encoder(pa.array(some))
    for j, t in enumerate(some):
        assert flat[at[j] : at[j + 1]].tolist() == whole.encode(t, add_special_tokens=False).ids


def test_nearest(spark):
    g = np.random.Generator(np.random.PCG64(1))
    x = (g.standard_normal((900, 8)) + np.repeat(g.standard_normal((9, 8)) * 3, 100, 0)).astype(np.float32)
    x[300:350] = x[300]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (1000, [0.0] * 8), (1100, [float("nan")] * 8), (1200, [1.0] * 7), (None, [1.0] * 8), (0, x[0].tolist())]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    hit = 0
    for q in range(0, 900, 100):
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        want = [i for i in np.lexsort((np.arange(900), d)).tolist() if i != q][:10]
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [k for k, _, _ in own] == list(range(1, 11)) and all(abs(s - d[v]) < 1e-9 for _, v, s in own)
        hit += len({v for _, v, _ in own} & set(want))
    assert hit >= 0.9 * 90 and {r.query_id for r in got} == set(range(0, 900, 100))
    nodes = spark.createDataFrame([(i, v.tobytes()) for i, v in enumerate(x)], "id long, vec binary")
    whole = neighbours.scanned(nodes.filter("id % 90 = 0"), 10, nodes, 5, "<f4").collect()
    for q in range(0, 900, 90):
        d = ((x.astype(float) - x[q].astype(float)) ** 2).sum(1)
        own = sorted((r.d, r.nbr) for r in whole if r.id == q)
        assert len(own) == 5 and np.allclose([a for a, _ in own], np.sort(d)[:5])
    few = spark.createDataFrame(rows[:4], "vec_id long, embedding array<float>")
    assert neighbours.nearest(few).count() == 3 and neighbours.nearest(few.filter("false")).count() == 0


def test_nearest_measures_doubles(spark):
    g = np.random.Generator(np.random.PCG64(2))
    x = 1 + 1e-10 * g.standard_normal((60, 4))  # all alike as floats
    got = neighbours.nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), every=20).collect()
    for q in (0, 20, 40):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        want = [i for i in np.argsort(d).tolist() if i != q][:10]
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [v for _, v, _ in own] == want and all(s == d[v] for _, v, s in own)


def test_language(spark):
    r = random.Random(8)
    make = lambda letters: " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 7))) for _ in range(30))
    rows = [(i, make("abcdefgh" if i % 2 else "efghijkl"), "xx" if i % 2 else "yy") for i in range(300)] + [(900, None, "xx"), (901, "12 --", "yy"), (902, "", None), (903, make("abcd"), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn(df.filter("doc_id % 4 <> 2"))
    got = {x.doc_id: (x.lang_pred, x.score) for x in language.identify(df, model).collect()}
    assert np.mean([got[i][0] == ("xx" if i % 2 else "yy") for i in range(300) if i % 4 == 2]) > 0.97
    assert got[900] == got[901] == got[902] == ("und", 0.0) and got[903][0] == "xx" and all(0 <= s <= 1 for _, s in got.values())
    kept = language.reject_unknown(df, model)
    assert kept.columns == df.columns and {900, 901, 902}.isdisjoint(x.doc_id for x in kept.collect())
    clash = language.identify(df.withColumn("score", F.lit("x")), model)
    assert clash.columns == [*df.columns, "lang_pred", "score"] and clash.schema["score"].dataType.simpleString() == "double"
    assert language.learn(df.filter("false")) is None and language.identify(df, None).filter("lang_pred <> 'und'").count() == 0


def brute_lines(texts):
    """Of texts in order: each without the lines that are similar to an earlier one, by shingles of five words."""
    seen, index, out = [], {}, []
    for text in texts:
        kept = []
        for x in text.split("\n"):
            w = space_words(x)
            s = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
            near = {y for t in s for y in index.get(t, ())}
            if not any(10 * len(s & seen[y]) >= 8 * len(s | seen[y]) for y in near):
                kept.append(x)
            for t in s:
                index.setdefault(t, []).append(len(seen))
            seen.append(s)
        out.append("\n".join(kept))
    return out


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    """Each stage on all that its predecessor kept, with nulls, empty and repeated texts, an extra column with a clashing name; the whole run agrees."""
    import corpus_pipeline
    from tokenizers import Tokenizer

    r = random.Random(21)
    sentence = lambda n, words: " ".join(r.choice(words) for _ in range(n))
    one, two = WORDS[:40], [w[::-1] for w in WORDS[40:]]
    made = [("\n".join(sentence(r.randint(8, 30), words) for _ in range(r.randint(1, 4))), lang) for i in range(160) for words, lang in ((one, "xx"), (two, "yy")) if i % 2 == (lang == "xx")]
    lines = [t.split("\n")[0] for t, _ in made]
    bench = [sentence(14, one) for _ in range(3)]
    for i in range(0, 60, 3):  # repeated lines, near copies, benchmark passages
        t, lang = made[i]
        made.append((t + "\n" + r.choice(lines), lang))
        words = t.replace("\n", " ").split(" ")
        words[len(words) // 2] = r.choice(one)
        made.append((" ".join(words), lang))
        made.append((f"{sentence(6, one)} {bench[i % 3]} {sentence(6, one)}", "xx"))
    made += [(None, "xx"), ("", "yy"), ("12 34", None), made[5], (made[7][0], None)]
    rows = [(i, t, lang, "src", len(t) if t else None, "clash") for i, (t, lang) in enumerate(made)] + [(None, sentence(20, one), "xx", None, 1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `_gone` string")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(bench)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now, steps = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        now = saved(stage(spark, now, str(tmp_path)), name.replace(" ", "-"))
        steps[name] = now.collect()
        assert name == "packing" or now.columns == docs.columns
    kept = sorted(steps["language"], key=lambda x: (x.doc_id is None, x.doc_id or 0))
    assert len(kept) > 0.95 * len(rows) and all(x.text and re.search("[a-z]", x.text) for x in kept)
    texts = brute_lines([x.text for x in kept])
    want = [(x.doc_id, t) for x, t in zip(kept, texts, strict=True) if t == x.text or t.strip(" ")]
    assert sorted(((x.doc_id, x.text) for x in steps["lines"]), key=str) == sorted(want, key=str) and all(x.n_chars == len(x.text) for x in steps["lines"])
    least = groups([t for _, t in want], 5, 80)
    want = [x for i, x in enumerate(want) if x[0] is None or least[i][1] == i]
    assert sorted(((x.doc_id, x.text) for x in steps["near duplicates"]), key=str) == sorted(want, key=str)
    want = [x for x in want if not brute_contamination(x[1], list(enumerate(bench)), 10)[1]]
    assert sorted(((x.doc_id, x.text) for x in steps["decontamination"]), key=str) == sorted(want, key=str)
    whole = Tokenizer.from_file(tokenizer_path())
    ids = {i: np.array(whole.encode(t, add_special_tokens=False).ids + [2], "<u4") for i, t in want}
    pieces = {}
    for x in steps["packing"]:
        assert x.ids_crc32 == zlib.crc32(ids[x.doc_id][x.start : x.start + x.length].tobytes())
        pieces.setdefault(x.doc_id, []).append((x.start, x.length))
    assert all(sum(n for _, n in pieces[i]) == len(v) for i, v in ids.items()) and pieces.keys() == ids.keys()
    run = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {x.doc_id for x in run} == ids.keys() and sum(x.length for x in run) == sum(map(len, ids.values()))


def test_pipeline_on_empty_tables(spark, tmp_path):
    import corpus_pipeline

    for name, kind in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], kind).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_queries_keep_their_contracts(spark, tmp_path):
    """Columns, types and folds of the queries on rows with nulls, empty texts, repeats and extra columns."""
    from tagloom.llm.queries import QUERIES

    r = random.Random(2)
    texts = [" ".join(r.choice(WORDS) for _ in range(r.randint(1, 30))) for _ in range(60)] + [None, "", "x@y.z 10.0.0.1", "12"]
    rows = [(i, t, "xx" if i % 2 else "yy", "s", 1, "extra") for i, t in enumerate(texts)]
    spark.createDataFrame(rows + rows[:1], "doc_id long, text string, lang string, source string, n_chars long, score string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, texts[3]), (None, "a"), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, "http://a.com/x", "<p>t</p>"), (1, None, None)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([(i, [float(i % 7 + 1), float(i)]) for i in range(300)] + [(None, None)], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    want = {
        "op2_language_model": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double", "op3_ngram_jaccard": "doc_id bigint, n_shingles bigint, component_id bigint",
        "op4_url_filter": "page_id bigint, host string, path string, rule string, verdict string", "op5_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
        "op6_extract": "page_id bigint, url string, text string, n_chars bigint", "op7_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
        "op8_nearest": "query_id bigint, rank int, vec_id bigint, score double", "op9_decontamination": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
        "op10_language": "doc_id bigint, held_out boolean, lang_pred string, score double",
    }
    got = {}
    for name, columns in want.items():
        df = QUERIES[name](spark, str(tmp_path))
        assert ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema) == columns, name
        got[name] = df.collect()
    for name, mod, rest in (("op2_language_model", 5, 1), ("op10_language", 4, 2)):
        assert len(got[name]) == 65 and all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % mod == rest) for x in got[name])
    train = sum(len(space_words(t)) + 1 for i, t in [*enumerate(texts), (0, texts[0])] if zlib.crc32(str(i).encode()) % 5 != 1)
    assert {x.train_tokens for x in got["op2_language_model"]} == {train}
    assert {x.lang_pred for x in got["op10_language"]} <= {"xx", "yy", "und"} and all(x.lang_pred == "und" for x in got["op10_language"] if x.doc_id in (60, 61, 63))
    assert {x.query_id for x in got["op8_nearest"]} == {0, 100, 200} and len(got["op8_nearest"]) == 30 and len(got["op4_url_filter"]) == len(got["op6_extract"]) == 2


def bm25(docs):
    """For each document as a seed the scores of all others for all its terms; documents are lists of token ids."""
    n, mean, tf = len(docs), sum(map(len, docs)) / len(docs), [Counter(x) for x in docs]
    df = Counter(t for x in tf for t in x)

    def score(seed):
        out = {}
        for d, own in enumerate(tf):
            norm = 1.2 * (0.25 + 0.75 * len(docs[d]) / mean)
            total = sum(np.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * own[t] * 2.2 / (own[t] + norm) for t in tf[seed].keys() & own.keys() - {2})
            if total and d != seed:
                out[d] = total
        return out

    return score


def test_packing_by_retrieval(spark):
    """Index and order against brute-force BM25 with statistics of the whole table; documents of one topic meet across partitions."""
    r = random.Random(3)
    topics = [[f"{w}{c}" for w in WORDS[:40]] for c in "abcdefgh"]
    made = [" ".join([*(r.choice(topics[i % 8]) for _ in range(r.randint(20, 50))), *(r.choice(WORDS) for _ in range(10))]) for i in range(400)]
    made += ["", None, "alone"]
    df = spark.createDataFrame([(i, made[i], "x", 1) for i in range(403)], "doc_id long, text string, place string, term int").repartition(5, "doc_id")
    path = tokenizer_path()
    scratch = Scratch(spark)
    table, frequency, count, mean = pack.tokenized(df, path, "doc_id", "text", 2, 4096, scratch)
    rows = sorted(table.collect(), key=lambda x: x.key)
    ids = [np.frombuffer(x.ids, "<u2").tolist() for x in rows]
    assert count == 403 and abs(mean - np.mean([len(x) for x in ids])) < 1e-9
    assert all(frequency[t] == sum(t in x for x in ids) for t in set(ids[0]))
    weights = pack.idf(frequency, count)
    weights[2] = 0
    sizes = np.array([len(x) for x in ids])
    index = pack.Index(np.concatenate(ids).astype(np.uint16), sizes, weights, mean)
    score = bm25(ids)
    for seed in range(0, 403, 31):
        want, got = score(seed), index.scores(seed)
        assert all(abs(want.get(d, 0) - got[d]) < 1e-3 for d in range(403) if d != seed)
    used, left, found = set(), 256, None  # the greedy rule, step by step
    for d in pack.in_order(sizes, index, 256, 256):
        if found is not None:
            best = max((found[x] for x in found if x not in used), default=0)
            assert not best or abs(found[d] - best) < 1e-3
        used.add(d)
        if sizes[d] >= left:
            left = 256 - (int(sizes[d]) - left) % 256
            found = score(d) if left < 256 else None
        else:
            found = score(d) if found is None or d not in found else found
            left -= int(sizes[d])
    assert len(used) == 403
    got = pack.pack(df, path, window=512, shard_docs=50).collect()
    sizes, parts, total = {}, {}, {}
    for x in sorted(got, key=lambda x: (x.sequence_id, x.offset)):
        assert x.offset == sizes.get(x.sequence_id, 0)
        sizes[x.sequence_id] = x.offset + x.length
        parts.setdefault(x.doc_id, []).append((x.start, x.length))
        total[x.doc_id] = x.doc_tokens
    assert all(n == 512 or (n < 512 and n & (n - 1) == 0) for n in sizes.values()) and len(parts) == 403
    for d, p in parts.items():
        assert [a for a, _ in sorted(p)] == [0, *np.cumsum([n for _, n in sorted(p)])[:-1]] and sum(n for _, n in p) == total[d]
    together = pairs = 0
    for s in sizes:
        own = sorted({x.doc_id for x in got if x.sequence_id == s and x.doc_id < 400})
        pairs += len(own) * (len(own) - 1) // 2
        together += sum(a % 8 == b % 8 for i, a in enumerate(own) for b in own[i + 1 :])
    assert together > 0.6 * pairs  # by chance an eighth


def test_extract_keeps_what_belongs_to_the_article(spark):
    page = "<body><header>Site</header><div class='cookie-notice'>c</div><article><header><h1>Title {0}</h1></header><div class='article-header'>By A{0}</div><p class='notice-period'>Notice {0}</p><section id='search-methods'><p>Search {0}</p></section><div class='ad'>buy</div><div id='comment-list'>list {0}</div><div class='comments'>no</div><nav>n</nav></article></body>"
    deep = "<div>" * 5000 + "<p>deep text</p>" + "</div>" * 5000
    long = "<article>" + "".join(f"<p>{i} x</p>" for i in range(20_000)) + "</article>"
    rows = [(i, f"http://a/{i}", page.format(i)) for i in range(5)] + [(3, "http://a/3", page.format(3)), (6, "http://d/", deep), (7, "http://l/", long), (None, "http://n/", "<p>t</p>")]
    got = [(r.page_id, r.text) for r in extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("wrapper", F.lit("x"))).collect()]
    assert sorted(t for i, t in got if i == 3) == ["Title 3\nBy A3\nNotice 3\nSearch 3\nlist 3"] * 2
    assert dict(got)[6] == "deep text" and dict(got)[7] == "\n".join(f"{i} x" for i in range(20_000)) and dict(got)[None] == "t"
    assert extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_tree_matching_against_brute_force():
    r = random.Random(5)

    def tree(depth):
        return f"<div class={r.choice('ab')}>" + ("".join(tree(depth - 1) for _ in range(r.randint(0, 3))) if depth else "t") + "</div>"

    def best(a, b):
        """The most nodes that any order-keeping match of two trees of one key pairs, where a pair counts the smaller tree."""
        x, y = extract._nodes(a), extract._nodes(b)
        sizes = {}
        for k in (*x, *y):
            extract._size(k, sizes)

        def go(i, j):
            if i == len(x) or j == len(y):
                return 0
            return max(go(i + 1, j), go(i, j + 1), min(sizes[id(x[i])], sizes[id(y[j])]) + go(i + 1, j + 1) if x[i].key == y[j].key else 0)

        return go(0, 0), sizes

    for _ in range(60):
        a, b = (extract.parse(tree(3)) for _ in range(2))
        sizes, pairs = {}, []
        extract._size(a, sizes)
        extract._size(b, sizes)
        extract.align(a, b, pairs, sizes)
        assert pairs[0] == (a, b) and all(p.key == q.key for p, q in pairs)
        for p, q in pairs:
            got = sum(min(sizes[id(x)], sizes[id(y)]) for x, y in pairs if x.up is p and y.up is q)
            assert got == best(p, q)[0]


def test_extract_counts_all_pages_of_a_host(spark):
    first = "<body><div class=a><h1>T {0}</h1><p>one text of page {0} that is long enough to read</p><p>other text {0} of it, again long enough</p></div></body>"
    second = "<body><div class=b><p>Home of all</p><h1>U {0}</h1><p>some text of page {0} that is long enough to read</p><p>last text {0} of it, again long enough</p></div></body>"
    rows = [(0, "http://h/0", "<body><div class=b><p>Home of all</p></div></body>")]
    rows += [(i, f"http://h/{i}", (first if i % 3 else second).format(i)) for i in range(1, 60)]
    rows += [(100 + i, f"http://same/{i}", first.format(1)) for i in range(6)]
    got = {r.page_id: r.text for r in extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert not any("Home of all" in got[i] for i in range(1, 60))
    assert all(f"some text of page {i} " in got[i] and f"U {i}" in got[i] for i in range(3, 60, 3)) and "other text 1 of it" in got[100]


def test_extract_finds_the_container_by_all_pages_of_a_host(spark):
    """The first pages of a host have one part, all others two: their container is the box around them. Some pages are of no account."""
    part = "<div class=part><p>text {0} of page {1} that is long enough to read</p></div>"
    outer = "<body><div class=x><p>Home of all</p></div><div class=page>{0}</div></body>"
    rows = [(i, f"http://h/{i}", outer.format("".join(part.format(n, i) for n in range(1 if i < 40 else 2)))) for i in range(240)]
    rows += [(-3, "http://h/", None), (-2, "http://h/", ""), (None, "http://h/", outer.format(part.format(0, "null"))), (-1, "http://one/", outer.format(part.format(0, 0)))]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    found, firsts = extract.supports(table.repartition(5))
    got = {r.host: json.loads(r.wrapper)["path"] for r in extract.wrappers(found, firsts).collect()}
    assert got == {"h": ["body", "div.page"], "one": []} and [r.first[:40] for r in firsts.orderBy("host").collect()] == [rows[0][2][:40], rows[-1][2][:40]]
    texts = {r.page_id: r.text for r in extract.extract(table).collect()}
    assert all(texts[i] == "\n".join(f"text {n} of page {i} that is long enough to read" for n in range(1 if i < 40 else 2)) for i in range(240))
    assert texts[None] == "text 0 of page null that is long enough to read" and texts[-3] == texts[-2] == ""


def test_members_of_a_large_group_name_a_near_one(spark, monkeypatch):
    """Of near copies that are similar to some and not to most others, few are open after the first naming."""
    import random

    from tagloom.llm.near_duplicates import similar_groups
    from tagloom.llm.setjoin import SetJoin

    dice, base = random.Random(5), [f"w{i}" for i in range(150)]
    texts = [" ".join("x" + str(dice.random()) if i > 60 and dice.random() < 0.026 else w for i, w in enumerate(base)) for _ in range(150)]
    left, real = [], SetJoin._between

    def between(self, grouped):
        left.append(grouped.select("grp").distinct().count())
        return real(self, grouped)

    monkeypatch.setattr(SetJoin, "_between", between)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in similar_groups(docs, size=4, percent=85).collect()}
    sets = [{tuple(w[i : i + 4]) for i in range(len(w) - 3)} for w in map(str.split, texts)]
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((group[a], group[b]))
                group = [x if g == y else g for g in group]
    assert found == dict(enumerate(group))
    assert left[0] <= 10  # 35 when each named the first


def test_few_links_are_joined_by_one_task(spark, monkeypatch):
    """A chain of links in many partitions took rounds of joins; with more links than a task may hold it still does, with the same groups."""
    from tagloom.llm import setjoin

    saves = []
    real = Scratch.save
    monkeypatch.setattr(Scratch, "save", lambda self, df, name: saves.append(name) or real(self, df, name))
    links = spark.range(300).filter("id % 100 < 90").selectExpr("(id * 7919) % 100003 AS a", "((id + 1) * 7919) % 100003 AS b").repartition(16)
    got = {tuple(r) for r in setjoin.components(links, Scratch(spark)).collect()}
    assert len(saves) == 2
    least = {i: min(n * 7919 % 100003 for n in range(i // 100 * 100, i // 100 * 100 + 91)) for i in range(300) if i % 100 <= 90}
    assert got == {(i * 7919 % 100003, g) for i, g in least.items()}
    monkeypatch.setattr(setjoin, "EDGES", 8)
    assert {tuple(r) for r in setjoin.components(links, Scratch(spark)).collect()} == got
    assert setjoin.components(links.filter("a < 0"), Scratch(spark)).count() == 0


def test_repeats_of_a_scan_are_counted(spark):
    """Shingles that come more than once with their numbers, and the number of all; words are found without folding the bytes first."""
    from tagloom.llm import wordhash
    from tagloom.llm.setjoin import SetJoin, sets_of

    texts = ["a b c d\nA b c d e\n\n f", "\n\n", "", "b c d e\r\nx", None, "é b c\vd \n e"]
    join = SetJoin(2, 80, True)
    scan = join.scan(spark.createDataFrame(list(enumerate(texts)), "k long, text string").coalesce(1), ["k"], "text", Scratch(spark))
    known = [(i, j, space_words(x)) for i, t in enumerate(texts) for j, x in enumerate((t or "").split("\n"))]
    assert sorted(map(tuple, join.items(scan).select("k0", "part", "n").collect())) == [(i, j, len({tuple(w[k : k + 2]) for k in range(max(1, len(w) - 1))})) for i, j, w in known if w]
    s = sets_of(pa.array(texts), 2, True)
    count = Counter(s.tok.view(np.int64).tolist())
    assert dict(map(tuple, scan.filter("often").select("tok", "n").collect())) == {None: len(s.tok)} | {t: c for t, c in count.items() if c > 1}
    w = wordhash.words(*wordhash.flat(pa.array(["Ab É c"])), wordhash.SPACE)
    assert "lower" not in vars(w) and [w.text(i) for i in range(3)] == [b"ab", "É".encode(), b"c"]


def test_tasks_hold_little_of_wide_texts(spark):
    """What a stage hands to a Python worker, reads of a file and holds while it writes, at a time."""
    from tagloom.llm.scratch import bounded_batches

    bounded_batches(spark)
    wide = saved(spark.range(3000).select("id", F.repeat(F.lit("abcdefgh"), 512).alias("text")).coalesce(1), "wide")

    def sizes(batches):
        for b in batches:
            yield b.from_pydict({"n": [b.nbytes]})

    assert 1 << 20 < max(r.n for r in wide.mapInArrow(sizes, "n long").collect()) < 3 << 20
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 512
