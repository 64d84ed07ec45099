"""Queries of whole steps of a run: gapped mapping, checkout of pairs, files, D segments, containment. They join the queries of `queries`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.sequence import IUPAC, reverse_complement
from tagloom.operators import assemble, checkout, clonotypes, mapping, reads, repertoire, umi
from tagloom.plans.queries import _APPENDED, _ASSEMBLY, _COLLIDED, _N, _PROTEIN, _SEQ, _UMI8, ORACLES, QUERIES, _assembly, _counts, _cte, _looked_up, _mapped_reads, _mig_reads, _qualities, _quick, _reads, query
from tagloom.sources import fastq
from tagloom.sources.tables import saved, shared_folder
from tagloom.streaming import tags

__all__ = ["ORACLES", "QUERIES"]


def _dna(key: str, salt: int, size: int) -> str:
    """SQL of bases that depend on a key without a pattern."""
    return "||".join(f"substr('ATGC', cast(((({key}) + {salt}) * (({key}) + {salt}) * 31 + (({key}) + {salt}) * {(i + salt) ** 2 * 101} + {(i + salt) ** 3 * 17}) % 10007 {{div}} 7 % 4 as int) + 1, 1)" for i in range(size))


def _segments(kind: str, div: str) -> str:
    """Alleles of part: 40 V or J genes of random bases, several parts to an allele. V is known by base 50, J by base 8."""
    seq = _dna("p_partkey % 40", 3, 55) if kind == "V" else _dna("p_partkey % 40", 307, 40)
    return f"SELECT p_partkey % 40 k, {seq.format(div=div)} AS seq FROM part GROUP BY 1, 2"


_LINES = "SELECT l_orderkey o, l_linenumber l, l_partkey % 40 kv, (l_orderkey * 7 + l_linenumber) % 40 kj, substr('GATTACAGATTACAGATTACA', cast(l_linenumber as int), 9) middle, l_linenumber inc, cast(l_quantity as int) % 39 + 2 q, l_returnflag AS sample, CASE WHEN l_linestatus = 'O' THEN 'raw' ELSE 'assembled' END AS type FROM lineitem"


def _library(spark, sf_dir) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    part = part.select((F.col("p_partkey") % 40).alias("p_partkey")).distinct()  # an allele's bases are made once
    one = lambda kind, ref: spark.sql(_segments(kind, "div").replace("FROM part", "FROM {part}"), part=part).select(F.lit("TRB").alias("gene"), F.lit(kind).alias("kind"), F.concat(F.lit(kind), F.col("k").cast("string"), F.lit("*01")).alias("alleles"), F.concat(F.lit(kind), F.col("k").cast("string")).alias("segments"), F.lit(ref).alias("ref_point"), "seq", "k")
    return one("V", 50).union(one("J", 8))


def _lines(spark, sf_dir) -> DataFrame:
    return spark.sql(_LINES.replace("FROM lineitem", "FROM {lineitem}"), lineitem=spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


_MADE = f"v AS ({_segments('V', '//')}), j AS ({_segments('J', '//')}), li AS ({_LINES}), en AS (SELECT li.*, v.seq va, j.seq ja FROM li JOIN v ON v.k = kv JOIN j ON j.k = kj)"


def _gapped_reads(spark, sf_dir) -> DataFrame:
    """Reads of a V, a middle and a J, some with bases cut out of or put into V or J, every second one on the other strand."""
    lines, lib = _lines(spark, sf_dir), _library(spark, sf_dir)
    side = lambda kind: F.broadcast(lib.filter(F.col("kind") == kind).select(F.col("k").alias(f"k{kind.lower()}"), F.col("seq").alias(kind)))  # noqa: E731  40 rows
    ends = lines.join(side("V"), "kv").join(side("J"), "kj").select("l", "o", "sample", "type", "q", "inc", "middle", F.substring("V", 1, 52).alias("v"), F.substring("J", 1, 30).alias("j"))
    cut = ends.selectExpr("l", "sample", "type", "q", "inc", "middle", "CASE o % 4 WHEN 1 THEN concat(substr(v, 1, 20), substr(v, 23)) WHEN 2 THEN concat(substr(v, 1, 25), 'ACG', substr(v, 26)) ELSE v END AS v", "CASE WHEN o % 3 = 1 THEN concat(substr(j, 1, 16), substr(j, 18)) ELSE j END AS j")
    whole = cut.select("l", "sample", "type", "q", "inc", F.concat("v", "middle", "j").alias("seq"))
    return whole.select("sample", "type", "q", "inc", F.when(F.col("l") % 2 == 0, reverse_complement(F.col("seq"))).otherwise(F.col("seq")).alias("seq"))


@query(f"WITH {_MADE} SELECT substr(va, 48, 5) || middle || substr(ja, 1, 12) cdr3nt, 'V' || kv v, 'J' || kj j, count(*) reads FROM en GROUP BY ALL")
def gapped_cdr3s(spark, sf_dir):
    """CDR3s of reads with gaps on both strands: those that the reads were made of."""
    reads = _gapped_reads(spark, sf_dir).groupBy("seq").agg(F.count("*").alias("n"))
    found = repertoire.map_reads(reads, _library(spark, sf_dir))
    return reads.join(found, reads["seq"] == found["read"]).groupBy("cdr3nt", "v", "j").agg(F.sum("n").alias("reads"))


#: Seeds, fuzzy places, tags in master and slave; the third has no slave.
BARCODES = [checkout.Barcode("S1", "ATGNNNNCAtgcawt", "GGRNNtt"), checkout.Barcode("S2", "CATNNNNtgctagca", "CCAc"), checkout.Barcode("S3", "GGATCNNtacgt")]
_QS = "concat(" + ", ".join(f"chr(cast(35 + (ph + {i} * l) % 39 as int))" for i in range(80)) + ")"
_RC = "reverse(translate({}, 'ACGT', 'TGCA'))"
_PAIRS = f"""WITH b AS (SELECT l_orderkey o, l_linenumber l, {_SEQ} AS seq, {_UMI8} AS umi, cast(l_quantity as int) ph FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) l_partkey, min(l_quantity) l_quantity FROM lineitem GROUP BY l_orderkey, l_linenumber) x),
m AS (SELECT o, l, ph, concat(substr(seq, 1, cast(o % 5 as int)), CASE o % 4 WHEN 0 THEN concat('ATG', substr(umi, 1, 4), 'CA') WHEN 1 THEN concat('CAT', substr(umi, 1, 4)) WHEN 2 THEN concat('GGATC', substr(umi, 1, 2)) ELSE 'TTTTTT' END,
  CASE WHEN o % 4 = 2 THEN 'TACGT' WHEN o % 7 = 0 THEN 'TGCAAC' WHEN o % 4 = 0 THEN 'TGCAAT' ELSE 'TGCTAGCA' END, seq) AS m1,
  concat(substr('TATA', 1, cast(l % 4 as int)), CASE WHEN o % 11 = 0 THEN 'TTTT' WHEN o % 4 = 0 THEN concat('GGA', substr(umi, 5, 2), 'TT') ELSE 'CCAC' END, {_RC.format("substr(seq, cast(1 + (o + l) % 30 as int))")}) AS m2 FROM b),
q AS (SELECT *, {_QS} AS qs FROM m),
p AS (SELECT o, l, m1, m2, substr(qs, 1, length(m1)) AS q1, reverse(substr(qs, 1, length(m2))) AS q2 FROM q),
pairs AS (SELECT o, l, CASE WHEN o % 3 = 0 THEN m2 ELSE m1 END AS s1, CASE WHEN o % 3 = 0 THEN q2 ELSE q1 END AS q1, CASE WHEN o % 3 = 0 THEN m1 ELSE m2 END AS s2, CASE WHEN o % 3 = 0 THEN q1 ELSE q2 END AS q2 FROM p)"""


def _whole_reads(turned: bool) -> str:
    """SQL of _SEQ, or its other strand, looked up from the key's remainder (see `_bases`) and the place of the wrong base; 48 if there is none."""
    texts = ["".join("ATGC"[(k * 31 + i * 17 + (k * i) % 13 + (i == at)) % 4] for i in range(48)) for k in range(52) for at in range(49)]
    texts = [x.translate(str.maketrans("ACGT", "TGCA"))[::-1] for x in texts] if turned else texts
    return _looked_up(texts, "l_partkey % 52 * 49 + least((l_orderkey*7 + l_linenumber*3) % 97, 48)")


def _pairs(spark, sf_dir) -> DataFrame:
    """Pairs with their bases and qualities, and those of the other strand, looked up whole: the second mate is a beginning of the one and an end of the other."""
    made = f"{_PAIRS} SELECT * FROM pairs".replace(f"{_SEQ} AS seq", f"{_whole_reads(False)} AS seq, {_whole_reads(True)} AS other")
    made = made.replace(_RC.format("substr(seq, cast(1 + (o + l) % 30 as int))"), "substr(other, 1, 48 - cast((o + l) % 30 as int))")
    made = made.replace(f"{_QS} AS qs", f"{_qualities('ph', 'l', 80)} AS qs, {_qualities('ph + l', '38 * l', 80)} AS sq").replace("reverse(substr(qs, 1, length(m2)))", "substr(sq, 81 - length(m2))")
    made = _quick(made)
    return spark.sql(made.replace("FROM lineitem", "FROM {lineitem}").replace("{div}", "div"), lineitem=spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


def _found(barcode: str, reads: str) -> str:
    """SQL of the first start of a barcode in the reads (o, l, mate, s, q)."""
    n, letters = len(barcode), list(enumerate(barcode))
    base = lambda i: f"substr(s, p::INT + {i}, 1)"
    seed = " AND ".join([f"{base(i)} IN ({', '.join(map(repr, IUPAC[c]))})" for i, c in letters if c.isupper() and c != "N"])
    wrong = lambda sign: "+".join(["0", *(f"({base(i)} NOT IN ({', '.join(map(repr, IUPAC[c.upper()]))}) AND ascii(substr(q, p::INT + {i}, 1)) - 33 {sign} 15)::INT" for i, c in letters if c.islower() and c != "n")])
    return f"SELECT o, l, mate, min(p)::INT AS st FROM {reads}, range(1, 90) t(p) WHERE p + {n} - 1 <= length(s) AND {seed} AND {wrong('<=')} <= {int(n * 0.2)} AND {wrong('>')} <= {int(n * 0.05)} GROUP BY ALL"


def _places(barcode: str, text: str, at: str) -> str:
    return "||".join(["''", *(f"substr({text}, {at} + {i}, 1)" for i, c in enumerate(barcode) if c == "N")])


def _by(value: str) -> str:
    """SQL of a value for each barcode, by its number."""
    return "CASE k " + " ".join(f"WHEN {k} THEN {value.format(m=b.master, s=b.slave or 'N', n=len(b.master), t=len(b.slave or ''), tag_u=_places(b.master, 'ms', 'st'), tag_q=_places(b.master, 'mq', 'st'), tag_v=_places(b.slave or '', 'os', 'too'), tag_w=_places(b.slave or '', 'oq', 'too'), name=b.sample)}" for k, b in enumerate(BARCODES)) + " END"


_CHECKED = f"""{_PAIRS.replace("{div}", "//")}, mt AS (SELECT o, l, 0 mate, s1 s, q1 q FROM pairs UNION ALL SELECT o, l, 1, s2, q2 FROM pairs),
ma AS ({" UNION ALL ".join(f"SELECT {k} k, * FROM ({_found(b.master, 'mt')})" for k, b in enumerate(BARCODES))}),
fm AS (SELECT * FROM ma QUALIFY row_number() OVER (PARTITION BY o, l ORDER BY k, mate) = 1),
mo AS (SELECT p.o, p.l, k, st, coalesce(mate, 0) = 1 swapped, CASE WHEN mate = 1 THEN s2 ELSE s1 END ms, CASE WHEN mate = 1 THEN q2 ELSE q1 END mq, CASE WHEN mate = 1 THEN s1 ELSE s2 END os, CASE WHEN mate = 1 THEN q1 ELSE q2 END oq FROM pairs p LEFT JOIN fm USING (o, l)),
sl AS ({" UNION ALL ".join(f"SELECT {k} k, * FROM ({_found(b.slave, f'(SELECT o, l, 0 mate, os s, oq q FROM mo WHERE k = {k})')})" for k, b in enumerate(BARCODES) if b.slave)}),
fo AS (SELECT mo.*, sl.st too, {_by("'{name}'")} matched, k IS NOT NULL AND ({_by("'{s}'")} = 'N' OR sl.st IS NOT NULL) whole FROM mo LEFT JOIN sl USING (o, l, k)),
tg AS (SELECT *, CASE WHEN k IS NOT NULL THEN {_by("{tag_u}")} || coalesce({_by("{tag_v}")}, '') END umi, CASE WHEN k IS NOT NULL THEN {_by("{tag_q}")} || coalesce({_by("{tag_w}")}, '') END umi_qual,
  {_by("st + {n}")} e, {_by("too + {t}")} f FROM fo),
cu AS (SELECT *, CASE WHEN k IS NULL THEN ms ELSE CASE WHEN st - 1 > 10 THEN substr(ms, 1, st - 1) ELSE '' END || CASE WHEN length(ms) - e + 1 > 10 THEN substr(ms, e) ELSE '' END END a, CASE WHEN k IS NULL THEN mq ELSE CASE WHEN st - 1 > 10 THEN substr(mq, 1, st - 1) ELSE '' END || CASE WHEN length(ms) - e + 1 > 10 THEN substr(mq, e) ELSE '' END END aq,
  {_RC.format("CASE WHEN too IS NULL THEN os ELSE CASE WHEN too - 1 > 10 THEN substr(os, 1, too - 1) ELSE '' END || CASE WHEN length(os) - f + 1 > 10 THEN substr(os, f) ELSE '' END END")} b,
  reverse(CASE WHEN too IS NULL THEN oq ELSE CASE WHEN too - 1 > 10 THEN substr(oq, 1, too - 1) ELSE '' END || CASE WHEN length(os) - f + 1 > 10 THEN substr(oq, f) ELSE '' END END) bq FROM tg),
ov AS (SELECT o, l, i, p FROM cu, range(0, 5) x(i), range(0, 90) y(p) WHERE whole AND p + 15 <= length(a) AND i + 15 <= length(b) AND substr(a, p::INT + 1, 5) = substr(b, i::INT + 1, 5) AND hamming(substr(a, p::INT + 6, 10), substr(b, i::INT + 6, 10)) <= 1 QUALIFY row_number() OVER (PARTITION BY o, l ORDER BY i, p) = 1),
mg AS (SELECT cu.*, i, p, least(length(a) - p, length(b) - i) n FROM cu LEFT JOIN ov USING (o, l)),
jo AS (SELECT o, l, string_agg(CASE WHEN substr(aq, (p + j)::INT, 1) > substr(bq, (i + j)::INT, 1) THEN substr(a, (p + j)::INT, 1) ELSE substr(b, (i + j)::INT, 1) END, '' ORDER BY j) js, string_agg(greatest(substr(aq, (p + j)::INT, 1), substr(bq, (i + j)::INT, 1)), '' ORDER BY j) jq FROM mg, range(1, 90) z(j) WHERE p IS NOT NULL AND j <= n GROUP BY ALL),
co AS (SELECT o, l, CASE WHEN whole THEN matched WHEN k IS NOT NULL THEN 'undef-s' ELSE 'undef-m' END AS sample, coalesce(matched, 'undef-m') matched, CASE WHEN p IS NULL THEN 'paired' ELSE 'overlapped' END AS type, umi, umi_qual,
  CASE WHEN p IS NULL THEN a ELSE substr(a, 1, p::INT) || js || CASE WHEN length(a) - p > n THEN substr(a, (p + n)::INT + 1) ELSE substr(b, (i + n)::INT + 1) END END s1, CASE WHEN p IS NULL THEN aq ELSE substr(aq, 1, p::INT) || jq || CASE WHEN length(a) - p > n THEN substr(aq, (p + n)::INT + 1) ELSE substr(bq, (i + n)::INT + 1) END END q1,
  CASE WHEN p IS NULL THEN b END s2, CASE WHEN p IS NULL THEN bq END q2, swapped FROM mg LEFT JOIN jo USING (o, l))"""


@query(f"{_CHECKED} SELECT * FROM co")
def checkout_pairs(spark, sf_dir):
    """Pairs with fuzzy barcodes on either mate, slaves, tags of both, cut and merged where they overlap."""
    return checkout.checkout(_pairs(spark, sf_dir), BARCODES, ["o", "l"], cut=True, merge=True)


@query(f"{_CHECKED} SELECT matched AS sample, count(*) FILTER (sample <> 'undef-m') master, count(*) FILTER (sample NOT LIKE 'undef%') master_slave, count(*) FILTER (type = 'overlapped') overlapped FROM co GROUP BY matched")
def checkout_pairs_log(spark, sf_dir):
    return checkout.checkout_log(checkout.checkout(_pairs(spark, sf_dir), BARCODES, [], cut=True, merge=True))


@query(f"""{_CHECKED} SELECT sample, '@' || o || '.' || l || CASE WHEN swapped THEN ' R2' ELSE ' R1' END || CASE WHEN umi <> '' THEN ' UMI:' || umi || ':' || umi_qual ELSE '' END h1, s1, q1,
CASE WHEN type = 'paired' THEN '@' || o || '.' || l || CASE WHEN swapped THEN ' R1' ELSE ' R2' END || CASE WHEN umi <> '' THEN ' UMI:' || umi || ':' || umi_qual ELSE '' END END h2, s2, q2 FROM co""")
def fastq_round_trip(spark, sf_dir):
    """Checked-out pairs written as files by sample, and read again in several ranges a file."""
    header = F.concat(F.lit("@"), F.col("o").cast("string"), F.lit("."), F.col("l").cast("string"))
    pairs = _pairs(spark, sf_dir).withColumns({"h1": header, "h2": header})
    path = shared_folder(spark, "samples")
    fastq.write_samples(checkout.checkout(pairs, BARCODES, ["h1", "h2"], cut=True, merge=True), path)
    reads = [fastq.read_samples(spark, path, kind, split=1 << 18) for kind in ("paired", "overlapped")]
    return reads[0].unionByName(reads[1]).select("sample", "h1", "s1", "q1", "h2", "s2", "q2")


_D = ["GGGACAGGGGGC", "GGGACTAGCGGGGGGG", "ACGTACCATG"]
_MIDDLE = f"substr({_SEQ}, 5, 14)"


@query(f"""WITH m AS (SELECT DISTINCT {_MIDDLE.format(div="//")} middle FROM lineitem), d AS (SELECT * FROM (VALUES {", ".join(f"('D{i}', '{x}')" for i, x in enumerate(_D, 1))}) v(name, x)), s AS (SELECT * FROM d UNION ALL SELECT name, {_RC.format("x")} FROM d),
w AS (SELECT DISTINCT name, substr(x, a::INT, n::INT) w FROM s, range(1, 17) t(a), range(2, 15) u(n) WHERE a + n - 1 <= length(x)), p AS (SELECT middle, a - 1 a, n, substr(middle, a::INT, n::INT) w FROM m, range(1, 14) t(a), range(2, 15) u(n) WHERE a + n - 1 <= 14)
SELECT middle, string_agg(DISTINCT name, ',' ORDER BY name) d, a::INT d_start, (a + n - 1)::INT d_end FROM p JOIN w USING (w) GROUP BY middle, a, n QUALIFY row_number() OVER (PARTITION BY middle ORDER BY n DESC, a) = 1""")
def d_segments(spark, sf_dir):
    """The D segments that middles hold a stretch of."""
    middles = spark.sql(f"SELECT {_quick(_MIDDLE)} AS middle FROM {{lineitem}}", lineitem=spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    return mapping.d_segments(middles, spark.createDataFrame([(f"D{i}", x) for i, x in enumerate(_D, 1)], "alleles string, seq string"))


_CORE = f"concat('TGT', substr({_SEQ}, 1, cast(6 + 3 * (l_linenumber % 4) as int)), 'TTT')"
_LOOSE = f"SELECT CASE WHEN l_suppkey % 3 = 0 THEN concat('GG', {_CORE}, substr('ACCA', 1, cast(l_suppkey % 5 as int))) ELSE {_CORE} END AS cdr3nt, CASE WHEN l_suppkey % 3 = 0 THEN 'GCF?' ELSE 'CAF' END AS aa, 1 AS good_events, l_linenumber AS good_reads FROM lineitem"


@query(f"""WITH r AS ({_LOOSE.format(div="//")}), t AS (SELECT cdr3nt, aa, count(*) good_events, sum(good_reads)::BIGINT good_reads FROM r GROUP BY ALL), c AS (SELECT * FROM t WHERE aa = 'CAF'),
x AS (SELECT n.cdr3nt, c.cdr3nt AS target FROM t n JOIN c ON contains(n.cdr3nt, c.cdr3nt) WHERE n.aa <> 'CAF' QUALIFY row_number() OVER (PARTITION BY n.cdr3nt ORDER BY length(c.cdr3nt) DESC, c.cdr3nt) = 1),
a AS (SELECT cdr3nt, good_events, good_reads FROM c UNION ALL SELECT target, good_events, good_reads FROM x JOIN t USING (cdr3nt))
SELECT cdr3nt, sum(good_events)::BIGINT good_events, sum(good_events)::BIGINT total_events, sum(good_reads)::BIGINT good_reads, sum(good_reads)::BIGINT total_reads FROM a GROUP BY cdr3nt""")
def merged_noncanonical(spark, sf_dir):
    """Canonical CDR3s with the counters of longer ones that hold them."""
    rows = spark.sql(_quick(_LOOSE).replace("FROM lineitem", "FROM {lineitem}"), lineitem=spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    table = rows.groupBy("cdr3nt", "aa").agg(F.count("*").alias("good_events"), F.count("*").alias("total_events"), F.sum("good_reads").alias("good_reads"), F.sum("good_reads").alias("total_reads"))
    return clonotypes.merge_noncanonical(table)


@query(f"WITH {_N} SELECT sample, type, least(length(bin(n)) - 1, 16) bin, sum(n)::BIGINT reads, count(*) units FROM n GROUP BY ALL")
def streamed_histogram(spark, sf_dir):
    """The coverage histogram of reads that come in file by file, counted as a stream."""
    folder, target = shared_folder(spark, "incoming"), shared_folder(spark, "tag-counts")
    header = F.concat(F.lit("@read R1 UMI:"), "umi8", F.lit(":"), F.repeat(F.char(F.col("phred") + 33), F.lit(8)))
    _reads(spark, sf_dir, "sample", "type", "umi8", "phred").select("sample", "type", header.alias("header")).repartition(6).write.parquet(folder)
    tags.count_tags(spark, folder, "sample string, type string, header string", target, files_at_once=2).awaitTermination()
    return umi.histogram(tags.counts_so_far(spark, target))


@query(f"""{_ASSEMBLY}, k AS (SELECT sample, mate, umi FROM cons SEMI JOIN wh USING (sample, umi) WHERE contains(seq, 'ATGCAT')) SELECT sample, mate, count(DISTINCT umi) umis, sum(cnt)::BIGINT reads FROM pl SEMI JOIN k USING (sample, mate, umi) GROUP BY ALL""")
def back_tracked_details(spark, sf_dir):
    """Reads in the consensuses that hold a query, from the table of alignment details."""
    r = _mig_reads(spark, sf_dir)
    table = "details_" + shared_folder(spark, "x").rsplit("-", 1)[1]
    details = assemble.save_details(assemble.alignment_details(r), table, buckets=16)
    found = reads.back_track(details, assemble.assemble(r), "ATGCAT")
    return found.groupBy("sample", "mate").agg(F.count_distinct("umi").alias("umis"), F.sum("cnt").alias("reads"))


@query(f"""WITH {_cte("sample", "type", "cdr3nt", "v", "j", "d", "phred", "inc")}, s AS (SELECT type AS sample, CASE WHEN sample = 'N' THEN 'raw' ELSE 'assembled' END side, cdr3nt, v, j, d, count(*) FILTER (phred >= 25) good_events, count(*) total_events, coalesce(sum(inc) FILTER (phred >= 25), 0)::BIGINT good_reads, sum(inc)::BIGINT total_reads FROM r GROUP BY ALL HAVING count(*) FILTER (phred >= 25) > 0),
n AS (SELECT sample, side, cdr3nt, v, j, d FROM s QUALIFY row_number() OVER (PARTITION BY sample, side, cdr3nt ORDER BY good_reads DESC, v DESC, j DESC, d DESC) = 1),
c AS (SELECT sample, side, cdr3nt, sum(good_events)::BIGINT good_events, sum(total_events)::BIGINT total_events, sum(good_reads)::BIGINT good_reads, sum(total_reads)::BIGINT total_reads FROM s GROUP BY ALL),
a AS (SELECT * FROM c WHERE side = 'assembled'), w AS (SELECT * FROM c WHERE side = 'raw'), {_PROTEIN},
bad AS (SELECT x.sample, x.cdr3nt FROM a x WHERE good_events = 1 AND EXISTS (SELECT 1 FROM a y WHERE y.sample = x.sample AND ((hamming(x.cdr3nt, y.cdr3nt) = 1 AND y.good_reads > 2 * x.good_reads) OR (hamming(x.cdr3nt, y.cdr3nt) = 2 AND y.good_reads > 4 * x.good_reads)))),
k AS (SELECT a.sample, a.cdr3nt, v, j, d, aa, a.good_events, a.total_events, a.good_reads, a.total_reads FROM a ANTI JOIN bad USING (sample, cdr3nt) JOIN n USING (sample, side, cdr3nt) JOIN p USING (cdr3nt) JOIN (SELECT sample, sum(total_reads) ta FROM a GROUP BY 1) USING (sample) JOIN (SELECT sample, sum(total_reads) tw FROM w GROUP BY 1) USING (sample) LEFT JOIN w USING (sample, cdr3nt)
WHERE regexp_full_match(aa, 'C.+[FW]') AND regexp_full_match(aa, '[a-zA-Z]+') AND (w.good_reads IS NULL OR a.good_reads * tw > w.good_reads * ta)) SELECT *, round(good_events / sum(good_events) OVER (PARTITION BY sample), 9) share FROM k""")
def filter_batch_collapsed(spark, sf_dir):
    """The filter of all samples by CDR3, without singletons near larger ones."""
    r = _reads(spark, sf_dir, "sample", "type", "cdr3nt", "v", "j", "d", "phred", "inc").withColumn("side", F.when(F.col("sample") == "N", "raw").otherwise("assembled")).withColumn("sample", F.col("type"))
    good = F.col("phred") >= 25
    tables = r.groupBy("sample", "side", *clonotypes.KEY).agg(F.count_if(good).alias("good_events"), F.count("*").alias("total_events"), F.sum(F.when(good, F.col("inc")).otherwise(0)).alias("good_reads"), F.sum("inc").alias("total_reads")).filter("good_events > 0")
    return clonotypes.filter_batch(tables, singleton_ratio=2, collapsed=True).withColumn("share", F.round("share", 9))


@query(f"""WITH {_APPENDED}, o AS (SELECT *, NOT good OR inc = min(inc) FILTER (good) OVER (PARTITION BY umi, cdr3nt) counts FROM ap)
SELECT v, j, fr AS "from", cdr3nt, min(d) d, 3 v_end, 8 d_start, 12 d_end, 20 j_start, count(*) FILTER (good AND counts) good_events, count(*) FILTER (counts) total_events, coalesce(sum(inc) FILTER (good), 0)::BIGINT good_reads, sum(inc)::BIGINT total_reads FROM o WHERE mapped GROUP BY ALL""")
def same_sample_clonotypes(spark, sf_dir):
    """Clonotype counters of several files of one sample, in which a tag's CDR3 counts in the first."""
    return repertoire.count_clonotypes(repertoire.once_a_tag(_mapped_reads(spark, sf_dir), F.col("inc")))


_PWM_ALL = _COLLIDED.format(ratio=0.1) + """, g AS (SELECT * FROM n ANTI JOIN c USING (sample, type, umi)), p AS (SELECT pos, substr(umi, pos::INT + 1, 1) nt, count(*) u, sum(n) k FROM g, range(0, 8) t(pos) GROUP BY ALL)"""


@query(f"WITH {_PWM_ALL} SELECT pos::INT pos, nt, round(u / sum(u) OVER (PARTITION BY pos), 6) unit_share, round(k / sum(k) OVER (PARTITION BY pos), 6) read_share FROM p")
def umi_position_weights_all(spark, sf_dir):
    """Position weights over all samples; collisions are those within a sample."""
    return umi.position_weights(_counts(spark, sf_dir), 0.1, together=True).withColumns({c: F.round(c, 6) for c in ("unit_share", "read_share")})


@query(f"WITH {_N}, h AS (SELECT sample, type, least(length(bin(n)) - 1, 16) bin, sum(n) reads FROM n GROUP BY ALL) SELECT sample, type, " + ", ".join(f"coalesce(sum(reads) FILTER (bin = {b}), 0)::BIGINT from_{1 << b}" for b in range(17)) + " FROM h GROUP BY sample, type")
def umi_histogram_wide(spark, sf_dir):
    return umi.wide(umi.histogram(_counts(spark, sf_dir)))


@query(f"WITH {_cte('sample', 'mate', 'umi6', 'seq', 'line')}, u AS (SELECT * EXCLUDE (line) RENAME (umi6 AS umi) FROM r WHERE mate = 1 AND line % 3 < 2), " + _assembly("sample", "u") + " SELECT * FROM cons SEMI JOIN wh USING (sample, umi)")
def mig_assembly_masked(spark, sf_dir):
    """Consensus of first mates that were first before."""
    r = _reads(spark, sf_dir, "sample", "mate", "umi6", "seq", "line").withColumnRenamed("umi6", "umi").withColumn("orig_mate", F.when(F.col("line") % 3 < 2, 1).otherwise(2))
    return assemble.assemble(r, mask="1:0", only_first=True)


def _batch(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    made = saved(_gapped_reads(spark, sf_dir).withColumn("qual", F.repeat(F.char(F.col("q") + 33), F.length("seq"))), "reads")
    samples = made.select("sample", "type").distinct().filter("sample <> 'N' OR type = 'raw'").withColumns({"species": F.lit("human"), "gene": F.lit("TRB")})
    return repertoire.clonotypes_batch(made, samples, _library(spark, sf_dir).withColumn("species", F.lit("human")))


_WANTED = f"{_MADE}, b AS (SELECT *, q >= CASE WHEN type = 'raw' THEN 25 ELSE 30 END good FROM en WHERE sample <> 'N' OR type = 'raw'), lo AS (SELECT sample, type, 'TRB' gene, count(*) FILTER (good) events_good, coalesce(sum(inc) FILTER (good), 0)::BIGINT reads_good, count(*) events_mapped, sum(inc)::BIGINT reads_mapped, count(*) events_total, sum(inc)::BIGINT reads_total FROM b GROUP BY ALL)"


@query(f"WITH {_WANTED} SELECT sample, type, 'TRB' gene, substr(va, 48, 5) || middle || substr(ja, 1, 12) cdr3nt, 'V' || kv v, 'J' || kj j, count(*) FILTER (good) good_events, round(count(*) FILTER (good) / any_value(events_good), 9) fraction, coalesce(sum(inc) FILTER (good), 0)::BIGINT good_reads FROM b JOIN lo USING (sample, type) GROUP BY ALL HAVING count(*) FILTER (good) > 0")
def clonotypes_batch(spark, sf_dir):
    """Clonotype tables of all samples, raw and assembled."""
    table, _ = _batch(spark, sf_dir)
    return table.groupBy("sample", "type", "gene", "cdr3nt", "v", "j").agg(F.sum("good_events").alias("good_events"), F.round(F.sum("fraction"), 9).alias("fraction"), F.sum("good_reads").alias("good_reads"))


@query(f"WITH {_WANTED} SELECT * FROM lo")
def mapping_log_batch(spark, sf_dir):
    return _batch(spark, sf_dir)[1]


@query(f"WITH {_WANTED} SELECT sample, type, 'events' metric, round(events_mapped / events_total, 9) mapping_rate, round(events_good / events_mapped, 9) quality_rate FROM lo UNION ALL SELECT sample, type, 'reads', round(reads_mapped / reads_total, 9), round(reads_good / reads_mapped, 9) FROM lo")
def report_mapping_rates_batch(spark, sf_dir):
    """Mapping and quality rates of all samples and types."""
    return reads.mapping_rates(_batch(spark, sf_dir)[1]).withColumns({c: F.round(c, 9) for c in ("mapping_rate", "quality_rate")})
