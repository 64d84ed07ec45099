"""The queries of this subpackage and, where DuckDB's SQL can express one, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.decontaminate import contamination
from tagloom.llm.extract import extract
from tagloom.llm.language import identify, learn
from tagloom.llm import ngram
from tagloom.llm.line_dedup import remove_repeated_lines
from tagloom.llm.near_duplicates import similar_groups
from tagloom.llm.neighbours import nearest
from tagloom.llm.pack import pack
from tagloom.llm.pii import personal_data
from tagloom.llm.products import top_products
from tagloom.llm.scratch import Scratch, bounded_batches, crc_of
from tagloom.llm.trie import prefix_trie
from tagloom.llm.url_filter import apply_rules
from tagloom.llm.whitening import whitened

#: Lower-casing of A-Z alone, in SQL.
LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


_OP9_SQL = f"""
WITH i AS (SELECT DISTINCT CAST(item_id AS VARCHAR) item, regexp_extract_all({LOW.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
iw AS (SELECT DISTINCT item, k, list_slice(w, p, p + k - 1) win FROM (SELECT item, w, least(10, len(w)) k FROM i WHERE len(w) > 0), range(1, 100000) r(p) WHERE p + k - 1 <= len(w)),
d AS (SELECT row_number() OVER () rid, doc_id, coalesce(regexp_extract_all({LOW.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) w FROM documents),
dp AS (SELECT rid, w, unnest(range(1, len(w) + 1)) p FROM d),
ks AS (SELECT DISTINCT k FROM iw),
h AS (SELECT rid, p, k, item FROM (SELECT rid, p, k, list_slice(w, p, p + k - 1) win FROM dp, ks WHERE p + k - 1 <= len(w)) JOIN iw USING (k, win)),
hw AS (SELECT rid, count(DISTINCT q) n FROM (SELECT rid, unnest(range(p, p + k)) q FROM h) GROUP BY rid),
hi AS (SELECT rid, count(DISTINCT item) n, string_agg(DISTINCT item, ',' ORDER BY item) s FROM h GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) n_words, coalesce(hw.n, 0) n_hit, coalesce(hi.n, 0) n_items, sha256(coalesce(s, '')) items_sha256, hw.n IS NOT NULL contaminated
FROM d LEFT JOIN hw USING (rid) LEFT JOIN hi USING (rid)"""

#: (host, path, verdict) of the URL filter's production rules.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "pages"), spark.createDataFrame(RULES, "host string, path string, verdict string"))


_OP4_SQL = f"""
WITH p AS (SELECT page_id, {LOW.format("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path, row_number() OVER () rid FROM pages),
r(h, s, v) AS (VALUES {", ".join(map(str, RULES))}),
f AS (SELECT rid, arg_max(h || s, length(h || s)) rule, arg_max(v, length(h || s)) v FROM p, r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s) GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(v, 'allow') verdict FROM p LEFT JOIN f USING (rid)"""

def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", crc_of("doc_id") % 4 == 2)
    found = identify(docs.select("doc_id", "held_out", "text"), learn(docs.filter(~docs.held_out)))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op6_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def tokenizer_path() -> str:
    """The vocabulary of the packing query, from the installed package of public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", crc_of("doc_id") % 5 == 1)
    model = ngram.count(docs.filter(~docs.held_out))
    found = ngram.score(docs, model).withColumn("train_tokens", F.lit(model.tokens).cast("long"))
    scores = Scratch(spark).save(found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"), "scores")
    model.drop()
    return scores


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "documents"), size=4, percent=85)


_OP3_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all({LOW.format("text")}, '[^\x20\x09-\x0D]+'), []) w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN w ELSE list_slice(w, p, p + 3) END g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) n FROM s GROUP BY doc_id),
l AS (SELECT a, b FROM (SELECT x.doc_id a, y.doc_id b, count(*) c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL) JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) n_shingles, least(d.doc_id, min(r.b)) component_id FROM d LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.a = d.doc_id GROUP BY d.doc_id"""


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_lines", "n_removed", "text")


_OP1_SQL = f"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) ls FROM documents),
p AS (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) i FROM d),
w AS (SELECT doc_id * 1000000 + i l, regexp_extract_all({LOW.format("ls[i]")}, '[^\x20\x09-\x0D]+') w FROM p),
s AS (SELECT DISTINCT l, CASE WHEN len(w) < 5 THEN w ELSE list_slice(w, q, q + 4) END g FROM (SELECT l, w, unnest(range(1, greatest(len(w) - 3, 2))) q FROM w WHERE len(w) >= 1)),
n AS (SELECT l, count(*) n FROM s GROUP BY l),
g AS (SELECT DISTINCT b l FROM (SELECT x.l a, y.l b, count(*) c FROM s x JOIN s y ON x.g = y.g AND x.l < y.l GROUP BY ALL) JOIN n p ON p.l = a JOIN n q ON q.l = b WHERE 100 * c >= 80 * (p.n + q.n - c))
SELECT d.doc_id, CAST(CASE WHEN text <> '' THEN len(ls) ELSE 0 END AS BIGINT) n_lines, count(g.l) n_removed,
CASE WHEN count(g.l) = 0 THEN any_value(text) ELSE coalesce(string_agg(ls[i], chr(10) ORDER BY i) FILTER (g.l IS NULL), '') END AS text
FROM d JOIN p USING (doc_id, ls) LEFT JOIN g ON g.l = doc_id * 1000000 + i GROUP BY d.doc_id, ls, d.text"""


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


_CRC = "list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(c::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END)"
_OP12_SQL = f"""
WITH t AS (SELECT conv_id c, coalesce(role, '') r, coalesce(text, '') x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(md5(coalesce(role, '')) || md5(coalesce(text, '')))) p FROM conversations WHERE conv_id IS NOT NULL),
v AS (SELECT c, xor({_CRC}, 4294967295) % 4 h FROM (SELECT DISTINCT c FROM t)),
o AS (SELECT v.c, 0 part, p, r, x FROM v JOIN t ON t.c = v.c - v.c % 20 WHERE p <= h UNION ALL SELECT v.c, 1, p, r, x FROM v JOIN t USING (c) WHERE p > h),
l AS (SELECT v.c, coalesce(list(struct_pack(r, x) ORDER BY part, p) FILTER (o.c IS NOT NULL), []) s FROM v LEFT JOIN o USING (c) GROUP BY v.c),
m AS (SELECT c, d::BIGINT d, s[1:d] s, len(s) = d e FROM l, range(0, 10000) q(d) WHERE d <= len(s)),
n AS (SELECT d, s, min(c) c, count(*) n, string_agg(c, ',' ORDER BY c) FILTER (e) ends, (n - 1) * CASE WHEN d > 0 THEN len(regexp_extract_all(any_value(s)[d].x, '[^\x20\x09-\x0D]+')) ELSE 0 END w FROM m GROUP BY d, s),
k AS (SELECT d - 1 d, s[1:d - 1] s, count(*) k FROM n WHERE d > 0 GROUP BY ALL),
a AS (SELECT n.*, coalesce(k, 0) k FROM n LEFT JOIN k USING (d, s)),
u AS (SELECT s[1:q] s, q d, count(*) FILTER (k = 0) leaves, sum(w)::BIGINT w FROM a, range(0, 10000) z(q) WHERE q <= d GROUP BY ALL)
SELECT a.c conv_id, a.d AS depth, b.c parent_conv_id, a.n n_convs, a.k n_children, u.leaves n_leaves, u.w saved_tokens, sha256(coalesce(a.ends, '')) ends_sha256
FROM a JOIN u USING (d, s) LEFT JOIN n b ON b.d = a.d - 1 AND b.s = a.s[1:a.d - 1]"""


def op13_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(table(spark, sf_dir, "embeddings"))


_OP13_SQL = """
WITH v AS (SELECT row_number() OVER () i, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) y FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT q.vec_id query_id, row_number() OVER (PARTITION BY q.i ORDER BY list_inner_product(q.y, c.y) DESC, c.vec_id)::INT AS rank, c.vec_id, list_inner_product(q.y, c.y)::BIGINT score
FROM v q, v c WHERE q.vec_id % 50 = 0 AND q.i <> c.i QUALIFY rank <= 5"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op1_line_dedup": op1_line_dedup, "op2_language_model": op2_language_model, "op3_ngram_jaccard": op3_ngram_jaccard, "op4_url_filter": op4_url_filter, "op5_pii": op5_pii, "op6_extract": op6_extract, "op7_packing": op7_packing, "op8_nearest": op8_nearest, "op9_decontamination": op9_decontamination, "op10_language": op10_language, "op11_whitening": op11_whitening, "op12_trie": op12_trie, "op13_products": op13_products}
ORACLES: dict[str, str] = {"op1_line_dedup": _OP1_SQL, "op3_ngram_jaccard": _OP3_SQL, "op4_url_filter": _OP4_SQL, "op9_decontamination": _OP9_SQL, "op12_trie": _OP12_SQL, "op13_products": _OP13_SQL}
