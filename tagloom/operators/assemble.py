"""Consensus of reads that share a tag: vote for a core, shift reads onto it, count bases by place.

Tags of usual size are assembled by numpy, many at once, after one shuffle by tag; a tag with more than MOST_READS distinct reads goes through
DataFrame aggregations, which sum it up on many tasks. Both give the same rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.sequence import core, hamming
from tagloom.operators import profiles
from tagloom.operators.umi import collided
from tagloom.sources.tables import saved, sent_if_small


MOST_READS, AT_ONCE = 100_000, 20_000
_LETTER = np.full(256, 4)
_LETTER[list(b"ATGC")] = range(4)


def migs(reads: DataFrame, least_length: int = 32, by: tuple[str, ...] = ("sample",)) -> DataFrame:
    """Distinct reads of each tag and mate with their number."""
    return reads.filter(F.col("umi").isNotNull() & (F.length("seq") >= least_length)).groupBy(*by, "mate", "umi", "seq").agg(F.count("*").alias("cnt"))


def passing(groups: DataFrame, least: int = 5, filter_collisions: bool = False, ratio: float = 0.1, by: tuple[str, ...] = ("sample",)) -> DataFrame:
    """Tags whose every mate has enough reads and, if asked, that are not collided."""
    sizes = groups.groupBy(*by, "umi", "mate").agg(F.sum("cnt").alias("n")).groupBy(*by, "umi").agg(F.min("n").alias("least"), F.floor(F.avg("n")).alias("n"))
    kept = sizes.filter(F.col("least") >= least)
    return kept.join(collided(sizes, ratio, by).select(*by, "umi"), [*by, "umi"], "left_anti") if filter_collisions else kept


def best_cores(groups: DataFrame, offset: int = 5, anchor: int = 10, by: tuple[str, ...] = ("sample",)) -> DataFrame:
    """The most voted core of each tag and mate; ties by the sum of offsets, then the core."""
    votes = groups.select(*by, "mate", "umi", "cnt", F.explode(F.transform(F.sequence(F.lit(-offset), F.lit(offset)), lambda o: F.struct(o.alias("o"), core(F.col("seq"), o, anchor).alias("core")))).alias("c"))
    score = votes.groupBy(*by, "mate", "umi", F.col("c.core").alias("core")).agg(F.sum("cnt").alias("votes"), F.sum(F.abs("c.o")).alias("away"))
    return score.groupBy(*by, "mate", "umi").agg(F.min_by("core", F.struct(-F.col("votes"), "away", "core")).alias("core"))


def aligned(groups: DataFrame, offset: int = 5, anchor: int = 10, most: int = 5, by: tuple[str, ...] = ("sample",)) -> DataFrame:
    """Reads shifted to the core: x bases left of the middle, y right; reads with more than `most` mismatches are left out."""
    with_core = groups.join(best_cores(groups, offset, anchor, by), [*by, "mate", "umi"])
    best = F.array_min(F.transform(F.sequence(F.lit(-offset), F.lit(offset)), lambda o: F.struct(hamming(core(F.col("seq"), o, anchor), F.col("core")).alias("mm"), o.alias("o"))))
    middle = F.floor(F.length("seq") / 2).cast("int")
    return with_core.withColumn("best", best).filter(F.col("best.mm") <= most).select(*by, "mate", "umi", "seq", "cnt", (middle - F.col("best.o")).alias("x"), (F.length("seq") - middle + F.col("best.o")).alias("y"))


def consensus(reads: DataFrame, least: int = 5, by: tuple[str, ...] = ("sample",)) -> DataFrame:
    """Consensus sequence and quality of aligned reads: unknown bases and padding count a quarter for each letter; ties go A, T, G, C. Reads are added up by place in the tasks that
    have them, so a tag of any size sends one row a task."""
    key = [*by, "mate", "umi"]
    spans = reads.groupBy(*key).agg(F.max("x").alias("left"), F.sum("cnt").alias("n"), F.max("y").alias("right")).filter(F.col("n") >= least)
    placed = reads.join(spans, key).select(*key, "n", "left", "right", "x", "seq", "cnt")

    def amounts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each key the bases by place (four a place), then a last number, so that the vector is as long as the span."""
        left, right, x, cnt = (batch.column(c).to_numpy() for c in ("left", "right", "x", "cnt"))
        row, place, base = profiles.letters(batch.column("seq"))
        nt = _LETTER[base]
        known = nt < 4
        width = (left + right).astype(np.int64)
        every = np.repeat(np.arange(len(x)), width)
        padding = np.arange(len(every)) - np.repeat(np.cumsum(width) - width, width)
        quarter, known_row, known_spot = cnt // 4, row[known], (left - x)[row[known]] + place[known]
        spread = [(every, 4 * padding + c, quarter[every]) for c in range(4)]  # a quarter for each letter, which known bases give back
        back = [(known_row, 4 * known_spot + c, -quarter[known_row]) for c in range(4)]
        parts = [*spread, *back, (known_row, 4 * known_spot + nt[known], cnt[known_row])]
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))

    def finished(sums: list[np.ndarray]) -> list[pa.Array]:
        return [pa.array([v.tobytes() for v in sums], pa.binary())]

    sums = profiles.summed(placed, [*key, "n"], amounts, finished, "vector binary")

    def read_off(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, seqs, quals = batch.column("n").to_numpy(), [], []
            for total, vector in zip(n.tolist(), batch.column("vector").to_pylist(), strict=True):
                votes = np.frombuffer(vector, np.int64).reshape(-1, 4)
                top = votes.argmax(1)
                share = votes[np.arange(len(top)), top] / total
                seqs.append(np.frombuffer(b"ATGC", np.uint8)[top].tobytes().decode())
                quals.append((np.clip(((share - 0.25) / 0.75 * 40).astype(np.int64), 2, 40) + 33).astype(np.uint8).tobytes().decode())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in key), batch.column("n"), pa.array(seqs, pa.string()), pa.array(quals, pa.string())], [*key, "count", "seq", "qual"])

    kinds = ", ".join(f"`{c}` {reads.schema[c].dataType.simpleString()}" for c in key)
    return sums.mapInArrow(read_off, f"{kinds}, count long, seq string, qual string")


def _in_order(words: np.ndarray) -> np.ndarray:
    """Words of letters (along the last axis), one after the other, as values in their order: as whole numbers where those are wide enough."""
    wide, held = words.shape[-1], np.bincount(words.ravel(), minlength=256) > 0
    bits = max(1, (int(held.sum()) - 1).bit_length())
    if wide * bits > 63:
        return np.ascontiguousarray(words).view(f"S{wide}").ravel()
    rank = (np.cumsum(held) - 1)[words]
    out = np.zeros(words.shape[:-1], np.int64)
    for i in range(wide):
        out = out << bits | rank[..., i]
    return out.ravel()


def placed_of(tag: np.ndarray, seqs: list[bytes], cnt: np.ndarray, offset: int, anchor: int, most: int, least: int):
    """Tags' (numbered from 0, in order) reads shifted to their core: all bases, where each read's begin, its bases left and right of the middle, whether it is in the consensus (at most `most`
    mismatches, and the tag has `least` such reads), and of each tag reads and distinct reads with few mismatches."""
    tags, wide = int(tag[-1]) + 1, 2 * anchor + 1
    size = np.array([len(x) for x in seqs])
    begin, data = np.cumsum(size) - size, np.frombuffer(b"".join(seqs), np.uint8)
    offsets = np.arange(-offset, offset + 1)
    middle = size // 2
    cores = data[(begin + middle - anchor)[:, None, None] - offsets[None, :, None] + np.arange(wide)[None, None]]
    _, code = np.unique(_in_order(cores), return_inverse=True)
    vote, place, back = np.unique(np.repeat(tag, len(offsets)) * (int(code.max()) + 1) + code, return_index=True, return_inverse=True)
    votes, away = np.bincount(back, np.repeat(cnt, len(offsets))), np.bincount(back, np.tile(np.abs(offsets), len(seqs)))
    owner = vote // (int(code.max()) + 1)
    order = np.lexsort((vote, away, -votes, owner))
    best = place[order[np.searchsorted(owner[order], np.arange(tags))]]
    chosen = cores.reshape(-1, wide)[best]
    apart = (cores != chosen[tag][:, None]).sum(2)
    at = apart.argmin(1)  # ties: the most negative offset
    keep = apart[np.arange(len(at)), at] <= most
    n, distinct = np.bincount(tag[keep], cnt[keep], tags).astype(np.int64), np.bincount(tag[keep], minlength=tags)
    keep &= n[tag] >= least
    x, y = middle - offsets[at], size - middle + offsets[at]
    return data, begin, x, y, keep, n, distinct


def consensus_of(tag: np.ndarray, seqs: list[bytes], cnt: np.ndarray, offset: int, anchor: int, most: int, least: int):
    """Tags' (numbered from 0, in order) reads in consensus, distinct reads in it, and sequence and quality; empty below `least` reads."""
    data, begin, x, y, keep, n, distinct = placed_of(tag, seqs, cnt, offset, anchor, most, least)
    tags, size = len(n), x + y
    left, right = np.zeros(tags, np.int64), np.zeros(tags, np.int64)
    np.maximum.at(left, tag[keep], x[keep])
    np.maximum.at(right, tag[keep], y[keep])
    width = left + right
    base = np.cumsum(width) - width
    k = np.flatnonzero(keep)
    read = np.repeat(k, size[k])
    inside = np.arange(len(read)) - np.repeat(np.cumsum(size[k]) - size[k], size[k])
    spot = base[tag[read]] + left[tag[read]] - x[read] + inside
    nt, total = _LETTER[data[begin[read] + inside]], int(width.sum())
    known, quarter = nt < 4, cnt // 4
    sums = np.bincount(spot[known] * 4 + nt[known], cnt[read[known]], total * 4).reshape(total, 4)
    spread = np.bincount(tag[k], quarter[k], tags)
    sums += (np.repeat(spread, width) - np.bincount(spot[known], quarter[read[known]], total))[:, None]
    top = sums.argmax(1)
    share = sums[np.arange(total), top] / np.maximum(np.repeat(n, width), 1)
    cqs = np.clip(((share - 0.25) / 0.75 * 40).astype(np.int64), 2, 40)
    nts, quals = np.frombuffer(b"ATGC", np.uint8)[top].tobytes().decode(), (cqs + 33).astype(np.uint8).tobytes().decode()
    return n, distinct, [nts[a : a + w] for a, w in zip(base.tolist(), width.tolist(), strict=True)], [quals[a : a + w] for a, w in zip(base.tolist(), width.tolist(), strict=True)]


def _whole_tags(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Of batches sorted by tag and mate (the first columns; then seq, cnt): tables that hold them whole, with each row's tag, numbered from 0, and the first row of each."""
    rest = None

    def numbered(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
        new = np.zeros(table.num_rows, bool)
        new[0] = True
        for i in range(keys):
            coded = table.column(i).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            new[1:] |= coded[1:] != coded[:-1]
        return table, np.cumsum(new) - 1, np.flatnonzero(new)

    for batch in batches:
        table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch], rest.schema)])
        last = [table.column(i)[-1] for i in range(keys)]
        cut = table.num_rows
        while cut and all(table.column(i)[cut - 1] == last[i] for i in range(keys)):
            cut -= 1
        if cut >= AT_ONCE or (cut and table.num_rows > 2 * AT_ONCE):
            yield numbered(table.slice(0, cut))
            table = table.slice(cut)
        rest = table
    if rest is not None and rest.num_rows:
        yield numbered(rest)


def _assembled(offset: int, anchor: int, most: int, least: int, keys: int):
    """Batches sorted by tag and mate: the by-columns, umi, mate, seq, cnt. A row for each tag and mate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, tag, first in _whole_tags(batches, keys):
            cnt = table.column(keys + 1).to_numpy()
            n, distinct, seq, qual = consensus_of(tag, [x.encode() for x in table.column(keys).to_pylist()], cnt, offset, anchor, most, least)
            reads, rows = np.bincount(tag, cnt).astype(np.int64), np.bincount(tag)
            some = n >= least
            yield pa.RecordBatch.from_arrays([*(table.column(i).combine_chunks().take(pa.array(first)) for i in range(keys)), pa.array(n), pa.array(reads - n), pa.array(rows - distinct), pa.array(seq, mask=~some), pa.array(qual, mask=~some)], [f"c{i}" for i in range(keys + 5)])

    return run


def _detailed(offset: int, anchor: int, most: int, least: int, keys: int):
    """As `_assembled`, a row for each read in a consensus, with the read padded to the consensus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, tag, _ in _whole_tags(batches, keys):
            seqs = table.column(keys).to_pylist()
            _, _, x, y, keep, n, _ = placed_of(tag, [s.encode() for s in seqs], table.column(keys + 1).to_numpy(), offset, anchor, most, least)
            left, right = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            np.maximum.at(left, tag[keep], x[keep])
            np.maximum.at(right, tag[keep], y[keep])
            rows = np.flatnonzero(keep)
            before, after = (left[tag] - x)[rows].tolist(), (right[tag] - y)[rows].tolist()
            aligned = pa.array(["N" * a + seqs[r] + "N" * b for r, a, b in zip(rows.tolist(), before, after, strict=True)], pa.string())
            columns = [table.column(i).combine_chunks().take(pa.array(rows)) for i in range(keys + 2)]
            yield pa.RecordBatch.from_arrays([*columns[:keys], aligned, *columns[keys:]], [f"c{i}" for i in range(keys + 3)])

    return run


def _by_tag(good: DataFrame, key: list[str]) -> DataFrame:
    """Reads of tags of usual size, those of a tag in one task and in order of its mates."""
    usual = good.filter(F.col("rows") <= MOST_READS).select(*key, "mate", "seq", "cnt", F.xxhash64(*key).alias("place"))
    return usual.repartition("place").sortWithinPartitions(*key, "mate").drop("place")  # by a column that the join hasn't: a repartition by its own keys is left out, and a join may be turned into one that parts tags


def statuses(reads: DataFrame, least: int = 5, filter_collisions: bool = False, by: tuple[str, ...] = ("sample",), offset: int = 5, anchor: int = 10, most: int = 5, ratio: float = 0.1) -> DataFrame:
    """A row for each tag and mate: n (reads), average (of the tag's mates), collided, small (some mate has too few reads), and for the others count
    (reads in consensus), dropped_reads, dropped_sequences, seq and qual (null if too few reads are left)."""
    key = [*by, "umi"]
    groups = saved(migs(reads, 2 * (anchor + offset + 1), by), "tags")
    sizes = groups.groupBy(*key, "mate").agg(F.sum("cnt").alias("n"), F.count("*").alias("rows"))
    tags = sizes.groupBy(*key).agg(F.min("n").alias("least"), F.floor(F.avg("n")).alias("average"), F.max("rows").alias("rows"))
    tags = tags.withColumn("small", F.col("least") < least).withColumn("collided", F.lit(False))
    if filter_collisions:
        hit = collided(tags.select(*key, F.col("average").alias("n")), ratio, by).select(*key, F.lit(True).alias("hit"))
        tags = tags.join(hit, key, "left").withColumn("collided", F.coalesce("hit", F.lit(False))).drop("hit")
    good = groups.join(tags.filter("NOT small AND NOT collided").select(*key, "rows"), key)
    kinds = {f.name: f.dataType.simpleString() for f in good.schema}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in (*key, "mate")), "count long, dropped_reads long, dropped_sequences long, seq string, qual string"])
    found = _by_tag(good, key).mapInArrow(_assembled(offset, anchor, most, least, len(key) + 1), schema)
    large = good.filter(F.col("rows") > MOST_READS).drop("rows")
    placed = saved(aligned(large, offset, anchor, most, by), "large-tags")
    left = placed.groupBy(*key, "mate").agg(F.sum("cnt").alias("count"), F.count("*").alias("kept"))
    drops = large.groupBy(*key, "mate").agg(F.sum("cnt").alias("n"), F.count("*").alias("rows")).join(left, [*key, "mate"], "left").fillna(0, ["count", "kept"])
    made = drops.join(consensus(placed, least, by).drop("count"), [*key, "mate"], "left")
    found = found.unionByName(made.select(*key, "mate", "count", (F.col("n") - F.col("count")).alias("dropped_reads"), (F.col("rows") - F.col("kept")).alias("dropped_sequences"), "seq", "qual"))
    return sizes.drop("rows").join(tags.drop("least", "rows"), key).join(found, [*key, "mate"], "left")


def assemble(reads: DataFrame, least: int = 5, filter_collisions: bool = False, by: tuple[str, ...] = ("sample",), offset: int = 5, anchor: int = 10, most: int = 5, ratio: float = 0.1, mask: str = "1:1", only_first: bool = False) -> DataFrame:
    """Consensus of every tag that passes; of paired reads only where both mates have one.

    mask: which mates are assembled; only_first: only reads that were first mates before they were oriented (orig_mate)."""
    key = [*by, "umi"]
    reads = reads.filter(F.col("mate").isin([m for m, on in enumerate(mask.split(":"), 1) if on == "1"])) if mask != "1:1" else reads
    reads = reads.filter("orig_mate = 1") if only_first else reads
    found = saved(statuses(reads, least, filter_collisions, by, offset, anchor, most, ratio), "consensus")
    short = found.filter("seq IS NULL").select(*key).distinct()
    return found.filter("seq IS NOT NULL").join(short, key, "left_anti").select(*key, "mate", "count", "seq", "qual")


def alignment_details(reads: DataFrame, least: int = 5, by: tuple[str, ...] = ("sample",), offset: int = 5, anchor: int = 10, most: int = 5) -> DataFrame:
    """Reads behind each consensus, shifted and padded as they were counted: by, mate, umi, aligned, seq, cnt."""
    key = [*by, "umi"]
    groups = saved(migs(reads, 2 * (anchor + offset + 1), by), "tags")
    sizes = groups.groupBy(*key, "mate").agg(F.sum("cnt").alias("n"), F.count("*").alias("rows")).groupBy(*key).agg(F.min("n").alias("least"), F.max("rows").alias("rows"))
    tags = sent_if_small(sizes.filter(F.col("least") >= least).drop("least"), "sizes")
    good = groups.join(tags, key)
    kinds = {f.name: f.dataType.simpleString() for f in good.schema}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in (*key, "mate")), "aligned string, seq string, cnt long"])
    found = _by_tag(good, key).mapInArrow(_detailed(offset, anchor, most, least, len(key) + 1), schema)
    if tags.filter(F.col("rows") > MOST_READS).limit(1).count():
        placed = saved(aligned(good.filter(F.col("rows") > MOST_READS).drop("rows"), offset, anchor, most, by), "placed")
        span = placed.groupBy(*key, "mate").agg(F.max("x").alias("left"), F.max("y").alias("right"), F.sum("cnt").alias("n")).filter(F.col("n") >= least)
        padded = F.concat(F.repeat(F.lit("N"), F.col("left") - F.col("x")), F.col("seq"), F.repeat(F.lit("N"), F.col("right") - F.col("y")))
        found = found.unionByName(placed.join(span, [*key, "mate"]).select(*key, "mate", padded.alias("aligned"), "seq", "cnt"))
    return found.select(*by, "mate", "umi", "aligned", "seq", "cnt")


def save_details(details: DataFrame, table: str, by: tuple[str, ...] = ("sample",), buckets: int = 200) -> DataFrame:
    """Alignment details as a table of the catalog, bucketed and sorted by tag and mate, so that joins with tags don't move it."""
    key = [*by, "mate", "umi"]
    details.repartition(buckets, *key).write.bucketBy(buckets, *key).sortBy(*key).saveAsTable(table)  # a task a bucket
    return details.sparkSession.table(table)


def assembly_log(reads: DataFrame, least: int = 5, by: tuple[str, ...] = ("sample",), filter_collisions: bool = False, ratio: float = 0.1) -> DataFrame:
    """The counters of an assembly, a row for each of the by-columns: tags and reads in consensus by mate and in all, reads and distinct reads
    dropped within tags, and tags and reads dropped for their size and as collided, by mate."""
    found = saved(statuses(reads, least, filter_collisions, by, ratio=ratio), "consensus")
    passed = ~F.col("small") & ~F.col("collided")
    tests = {"overseq": F.col("small") & ~F.col("collided") & (F.col("n") < least), "collision": F.col("collided")}
    count = lambda test, name: F.count_if(test).alias(name)
    add = lambda test, column, name: F.coalesce(F.sum(F.when(test, F.col(column))), F.lit(0)).alias(name)
    made = F.col("seq").isNotNull()
    by_mate = [
        x for m in (1, 2) for mate in (F.col("mate") == m,) for x in (
            count(mate & made, f"migs_good_{m}"), add(mate & made, "count", f"reads_good_{m}"), add(mate & passed, "dropped_reads", f"reads_dropped_{m}"), add(mate & passed, "dropped_sequences", f"sequences_dropped_{m}"),
            *(y for k, test in tests.items() for y in (count(mate & test, f"migs_dropped_{k}_{m}"), add(mate & test, "n", f"reads_dropped_{k}_{m}"))),
        )
    ]
    tags = found.groupBy(*by, "umi").agg(F.max("average").alias("average"), F.bool_and(made).alias("whole"))
    total = tags.groupBy(*by).agg(F.count_if("whole").alias("migs_good_total"), F.count("*").alias("migs_total"), add(F.col("whole"), "average", "reads_good_total"), F.sum("average").alias("reads_total"))
    return found.groupBy(*by).agg(*by_mate).join(total, list(by)).withColumn("mig_count_threshold", F.lit(least))


def assemble_batch(reads: DataFrame, estimates: DataFrame, metadata: DataFrame | None = None, default_mask: str = "1:1", force_overseq: int | None = None, force_collision_filter: bool = False, manifest: DataFrame | None = None) -> DataFrame:
    """Consensus of all samples, each with its own thresholds and mask. reads: sample, type, mate, umi, seq; estimates: sample, type,
    overseq_threshold, filter_collisions; metadata: sample, type, mask (`1:1`, `1:0`, `0:1`; a missing one is the default). Samples without an estimate are left out,
    and those that a manifest (sample, type), where one is given, doesn't have."""
    rules = estimates.select("sample", "type", (F.lit(force_overseq) if force_overseq else F.col("overseq_threshold")).cast("long").alias("least_n"), (F.lit(force_collision_filter) | F.coalesce("filter_collisions", F.lit(False))).alias("filter_collided"))
    if metadata is not None:
        rules = rules.join(metadata.select("sample", "type", "mask"), ["sample", "type"])
    else:
        rules = rules.withColumn("mask", F.lit(default_mask))
    rules = rules if manifest is None else rules.join(manifest.select("sample", "type").distinct(), ["sample", "type"], "left_semi")
    rules = rules.withColumn("mask", F.split(F.coalesce("mask", F.lit(default_mask)), ":"))
    wanted = reads.join(F.broadcast(rules), ["sample", "type"]).filter(F.element_at("mask", F.col("mate").cast("int")) == "1")
    found = saved(statuses(wanted, 1, False, ("sample", "type")), "consensus")
    tags = found.groupBy("sample", "type", "umi").agg(F.min("n").alias("fewest"), F.min("count").alias("left"), F.max("average").alias("n")).join(F.broadcast(rules.drop("mask")), ["sample", "type"])
    hit = collided(tags.filter("filter_collided").select("sample", "type", "umi", "n"), 0.1).select("sample", "type", "umi")
    whole = tags.filter((F.col("fewest") >= F.col("least_n")) & (F.col("left") >= F.col("least_n"))).join(hit, ["sample", "type", "umi"], "left_anti")
    return found.join(whole.select("sample", "type", "umi"), ["sample", "type", "umi"], "left_semi").select("sample", "type", "umi", "mate", "count", "seq", "qual")
