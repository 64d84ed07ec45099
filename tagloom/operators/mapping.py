"""V, D and J segments: library preparation, alignment of distinct sequences, CDR3 borders, D search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.sequence import reverse_complement
from tagloom.operators.alignment import HIT, PIECE
from tagloom.operators.substrings import longest_stretches
from tagloom.sources.tables import saved


def trimmed_alleles(segments: DataFrame, v_left: int = 50, j_right: int = 20) -> DataFrame:
    """Alleles cut around the reference point, equal sequences of a gene as one with all their names. D segments stay whole."""
    is_v, is_j = F.startswith("segment_type", F.lit("V")), F.startswith("segment_type", F.lit("J"))
    start = F.when(is_v, F.greatest(F.col("ref_point") - v_left, F.lit(0))).otherwise(0)
    end = F.when(is_j, F.least(F.col("ref_point") + j_right + 1, F.length("seq"))).otherwise(F.length("seq"))
    cut = segments.select("species", "gene", F.left("segment_type", F.lit(1)).alias("kind"), "allele_id", (F.col("ref_point") - start).alias("ref_point"), F.substring("seq", start + 1, end - start).alias("seq"))
    return cut.groupBy("species", "gene", "kind", "seq").agg(F.min("ref_point").alias("ref_point"), F.array_join(F.sort_array(F.collect_set("allele_id")), ",").alias("alleles"), F.array_join(F.sort_array(F.collect_set(F.split_part("allele_id", F.lit("*"), F.lit(1)))), ",").alias("segments"))


def seeds(table: DataFrame, k: int) -> DataFrame:
    """Each place's k-mer."""
    at = F.when(F.length("seq") >= k, F.sequence(F.lit(0), F.length("seq") - k))
    return table.withColumn("at", F.explode(at)).withColumn("kmer", F.substring("seq", F.col("at") + 1, F.lit(k)))


def best_hits(reads: DataFrame, alleles: DataFrame, k: int = 11, least: int = 2) -> DataFrame:
    """Best ungapped hit of each distinct sequence (both strands) and kind of segment: the diagonal with most shared k-mers.

    reads: seq. An equi-join on k-mers, so no read is held against a whole library (one of at most PIECE bases goes to all tasks); ties go to the first allele names, then the diagonal."""
    forward = reads.select("seq").distinct()
    both = forward.select("seq", F.col("seq").alias("read"), F.lit(False).alias("rc")).unionByName(forward.select(reverse_complement(F.col("seq")).alias("seq"), F.col("seq").alias("read"), F.lit(True).alias("rc")))
    named = ["gene", "kind", "alleles", "segments", "ref_point"]
    alleles = saved(alleles.select(*named, "seq"), "alleles")
    names = saved(alleles.select(*named).distinct().orderBy("gene", "alleles", "kind", "segments", "ref_point").withColumn("no", F.monotonically_increasing_id()), "names")  # in order; names may be long, so hits go by number
    numbered = alleles.join(names, [alleles[c].eqNullSafe(names[c]) for c in named]).select("no", alleles["kind"], "seq")
    small = (alleles.agg(F.sum(F.length("seq"))).first()[0] or 0) <= PIECE
    sent = F.broadcast if small else lambda t: t  # so that words of reads aren't moved
    lib = seeds(numbered, k).select("no", "kind", F.col("at").alias("a_at"), "kmer")
    hits = seeds(both, k).join(sent(lib), "kmer").groupBy("read", "rc", "kind", "no", (F.col("at") - F.col("a_at")).alias("shift")).agg(F.count("*").alias("score"), F.min("at").alias("q_from"), (F.max("at") + k - 1).alias("q_to"), F.min("a_at").alias("a_from"), (F.max("a_at") + k - 1).alias("a_to"))
    places = ["shift", "score", "q_from", "q_to", "a_from", "a_to"]
    best = hits.filter(F.col("score") >= least).groupBy("read", "kind").agg(F.min_by(F.struct("rc", "no", *places), F.struct(-F.col("score"), "no", "rc", "shift")).alias("hit")).select("read", "kind", "hit.*")
    return best.join(sent(names.drop("kind")), "no").select("read", "kind", "rc", "gene", "alleles", "segments", "ref_point", *places)


def external_hits(hits: DataFrame, queries: DataFrame, alleles: DataFrame, least_identical: int = 7) -> DataFrame:
    """Hits of an external aligner as `gapped_hits` would give them: of each query and kind of segment the one with most identities, ties to the first names.

    hits: columns of `sources.tables.read_hits`; queries: query, seq; alleles: gene, kind, alleles, segments, ref_point, seq (hits name `alleles`). Of hits on the other strand, places are turned to it."""
    named = hits.filter(F.col("n_ident") >= least_identical).join(queries, "query").join(alleles.select("gene", "kind", F.col("alleles").alias("allele"), "segments", "ref_point"), "allele")
    rc = F.col("a_start") > F.col("a_end")
    n = F.length("seq")
    turned = named.select(
        F.col("seq").alias("read"), "kind", rc.alias("rc"), "gene", F.col("allele").alias("alleles"), "segments", "ref_point", "n_ident",
        F.when(rc, n - F.col("q_end")).otherwise(F.col("q_start") - 1).alias("q_from"), F.when(rc, n - F.col("q_start")).otherwise(F.col("q_end") - 1).alias("q_to"), (F.least("a_start", "a_end") - 1).alias("a_from"), (F.greatest("a_start", "a_end") - 1).alias("a_to"),
        F.when(rc, F.reverse("q_seq")).otherwise(F.col("q_seq")).alias("q"), F.when(rc, F.reverse("a_seq")).otherwise(F.col("a_seq")).alias("a"),
    )
    step = F.struct(F.lit(0).alias("q"), F.lit(0).alias("a"), F.lit(-1).alias("at"))
    columns = F.transform(F.sequence(F.lit(1), F.length("q")), lambda i: F.struct((F.substring("q", i, F.lit(1)) != "-").cast("int").alias("q"), (F.substring("a", i, F.lit(1)) != "-").cast("int").alias("a")))
    ahead = F.col("ref_point") - F.col("a_from")  # bases of the allele before the reference point
    walked = F.aggregate(columns, step, lambda s, c: F.struct((s["q"] + c["q"]).alias("q"), (s["a"] + c["a"]).alias("a"), F.when((s["at"] < 0) & (c["a"] == 1) & (s["a"] == ahead), s["q"]).otherwise(s["at"]).alias("at")))
    place = F.when(ahead == -1, F.col("q_from") - 1).when(F.col("ref_point") == F.col("a_to") + 1, F.col("q_to") + 1).when(walked["at"] >= 0, F.col("q_from") + walked["at"]).otherwise(-1)
    made = turned.withColumn("q_ref", place).withColumns({"score": F.col("n_ident"), "shift": F.col("q_from") - F.col("a_from")})
    cols = [x.split()[0] for x in HIT.split(", ")]
    return made.groupBy("read", "kind").agg(F.min_by(F.struct(*cols), F.struct(-F.col("n_ident"), "gene", "alleles", "rc", "shift")).alias("hit")).select("read", "kind", "hit.*")


def cdr3s(hits: DataFrame, chimeric: bool = False, least: int = 7, most: int = 300) -> DataFrame:
    """CDR3 of each read with a V and a J hit on one strand and (unless chimeric) of one gene, both reference points in the hit, give or take one.

    Of gapped hits the reference point's place in the read is known (q_ref); of ungapped ones it follows from the diagonal."""
    near = hits.filter((F.col("ref_point") + 1 >= F.col("a_from")) & (F.col("ref_point") - 1 <= F.col("a_to")))
    near = near if "q_ref" in hits.columns else near.withColumn("q_ref", F.col("ref_point") + F.col("shift"))
    side = lambda kind: F.max(F.when(F.col("kind") == kind, F.struct("rc", "gene", "segments", "q_ref", "q_from", "q_to")))  # noqa: E731  a read has one hit of a kind
    both = near.groupBy("read").agg(side("V").alias("v"), side("J").alias("j")).filter("v.rc = j.rc")
    both = both.select("read", *(F.col(f"{p}.{c}").alias(f"{p}_{c}") for p in "vj" for c in ("rc", "gene", "segments", "q_ref", "q_from", "q_to")))
    both = both if chimeric else both.filter("v_gene = j_gene")
    start, end = F.col("v_q_ref") - 3, F.col("j_q_ref") + 4
    strand = F.when(F.col("v_rc"), reverse_complement(F.col("read"))).otherwise(F.col("read"))
    found = both.withColumns({"from": start, "to": end, "strand": strand}).filter((F.col("from") >= 0) & (F.col("to") <= F.length("read")) & (F.col("to") - F.col("from")).between(least, most))
    return found.select("read", F.col("v_gene").alias("gene"), F.col("v_segments").alias("v"), F.col("j_segments").alias("j"), F.substring("strand", F.col("from") + 1, F.col("to") - F.col("from")).alias("cdr3nt"), "from", F.col("v_rc").alias("rc"), (F.col("v_q_to") - F.col("from")).alias("v_end"), (F.col("j_q_from") - F.col("from")).alias("j_start"))


def d_segments(middles: DataFrame, d_alleles: DataFrame, least: int = 2) -> DataFrame:
    """The longest, then leftmost, stretch of each middle that a D allele or its reverse complement holds, and all alleles that hold it. middles: middle; d_alleles: alleles, seq, a library's D segments."""
    table = str.maketrans("ACGT", "TGCA")
    forward = [(r.alleles, r.seq) for r in d_alleles.select("alleles", "seq").filter("seq IS NOT NULL").orderBy("alleles", "seq").collect()]  # a gene has some dozens
    library = forward + [(name, "".join(c if c in "ACGT" else "N" for c in x)[::-1].translate(table)) for name, x in forward]
    return longest_stretches(middles, "middle", library, least).withColumnsRenamed({"names": "d", "start": "d_start", "end": "d_end"})
