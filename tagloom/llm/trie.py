"""Conversation prefix trie: nodes by running hashes, subtree totals by time-forward processing.

Turns become fixed-size rows (a digest of role and text, a number of words), and texts go no further. Conversations are rebuilt from the head of their
base and their own rest; running sums (`running`) of hashes of (depth, digest) give each prefix a 128-bit name, so equal prefixes of all conversations group together.
A path of nodes with one child and the same members is one run (its smallest member owns it), so that a conversation of any length is a few runs.

Totals of subtrees: runs with at most SHARD members lie in subtrees whose top has at most so many too, and all of such a subtree is in one
shard. A shard sorts its runs by reverse level order (Spark's external sort) and passes each run's totals to its parent through a queue by level, which spills
what is needed last to a file of its task. Totals of shard roots, summed by parent, go to the next round, in which runs with at most SHARD**2 members are
sharded in the same way, and so on; a run with more than m members takes m turns of the input, so each round has a small part of the one before.

Rules: a null conv_id is no conversation; turns of equal number are ordered by the digest of role and text, nulls as empty. A conversation without turns left is a member of the root alone.
No conversations give no nodes. Other columns play no part.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.running import running
from tagloom.llm.scratch import Scratch, crc_of

SHARD, QUEUE, CHUNK, IDS = 256, 1 << 20, 1 << 16, 8192
EMPTY = hashlib.sha256(b"").hexdigest()


def turns(rows: DataFrame) -> DataFrame:
    """conv, turn, digest and words of each turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.md5(role.cast("binary")), F.md5(text.cast("binary"))).cast("binary")))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    return rows.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv"), "turn", digest.alias("digest"), words.alias("words"))


def rebuilt(rows: DataFrame, scratch: Scratch, heads: int = 4, block: int = 20) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv, len), and their rebuilt turns: conv, depth (`count`), name of the prefix (to_a, to_b), words, and words so far (to_words)."""
    digests = scratch.save(turns(rows), "digests")  # texts are read once, though range partitioning looks at its input twice
    own = running(digests, "conv", [F.asc_nulls_first("turn"), F.col("digest")], [], scratch, "turns")
    h = crc_of("conv") % heads
    sizes = scratch.save(own.groupBy("conv").agg(F.max("count").alias("n")).select("conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % block).alias("base")), "sizes")
    based = sizes.join(sizes.select(F.col("conv").alias("base"), F.col("n").alias("base_n")), "base", "left").withColumn("m", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = scratch.save(based.select("conv", "base", "n", "h", "m", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")), "conversations")
    lent = own.filter(F.col("count") < heads).withColumnRenamed("conv", "base").join(convs.select("conv", "base", "m"), "base").filter("count <= m").select("conv", F.col("count").alias("depth"), "digest", "words")
    piece = (F.col("count") / CHUNK).cast("long")  # a conversation's turns meet its row in pieces
    shifts = convs.select("conv", "m", "h", F.explode(F.sequence(F.lit(0), (F.col("n") / CHUNK).cast("long"))).alias("piece"))
    rest = own.filter(F.col("count") > h).withColumn("piece", piece).join(shifts, ["conv", "piece"]).select("conv", (F.col("count") - F.col("h") + F.col("m")).alias("depth"), "digest", "words")
    named = lent.unionByName(rest).withColumns({lane: F.xxhash64(F.lit(lane), "depth", "digest") for lane in ("a", "b")}).select("conv", "depth", "words", "a", "b")
    return convs, scratch.save(running(named, "conv", [F.col("depth")], ["a", "b", "words"], scratch, "prefixes"), "rebuilt")


def _with_hot(left: DataFrame, right: DataFrame, keys: list[str], members: str, most: int) -> DataFrame:
    """Inner join with nodes (unique by keys). Nodes with more than `most` members, of which there are few, go to all tasks; so no task gets
    more than `most` rows of one node."""
    hot = F.broadcast(right.filter(F.col(members) > most))
    return left.join(hot, keys).unionByName(left.join(F.broadcast(right.filter(F.col(members) > most).select(*keys)), keys, "left_anti").join(right.filter(F.col(members) <= most), keys))


class LevelQueue:
    """Messages (conv, leaves, saved) by level, taken level by level from the deepest on; beyond `most` messages those of the shallowest levels go to a file."""

    def __init__(self, most: int = QUEUE):
        self.most, self.held, self.levels, self.spilled, self.file = most, 0, {}, {}, None

    def push(self, level: np.ndarray, messages: np.ndarray) -> None:
        order = np.argsort(level, kind="stable")
        level, messages = level[order], messages[order]
        cut = np.flatnonzero(np.concatenate([[True], level[1:] != level[:-1], [True]])) if len(level) else np.zeros(1, np.int64)
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            self.levels.setdefault(int(level[a]), []).append(messages[a:b])
        self.held += len(level)
        if self.held > self.most:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        for level in sorted(self.levels):
            if self.held <= self.most // 2:
                break
            rows = summed(np.concatenate(self.levels.pop(level)))
            self.held = sum(len(x) for parts in self.levels.values() for x in parts)
            self.spilled.setdefault(level, []).append((self.file.seek(0, 2), len(rows)))
            self.file.write(rows.tobytes())

    def pop(self, level: int) -> np.ndarray:
        """All messages of a level, summed by conv and sorted by it."""
        parts = self.levels.pop(level, [])
        self.held -= sum(len(x) for x in parts)
        for at, n in self.spilled.pop(level, []):
            self.file.seek(at)
            parts.append(np.frombuffer(self.file.read(24 * n), np.int64).reshape(-1, 3))
        return summed(np.concatenate(parts)) if parts else np.zeros((0, 3), np.int64)


def summed(messages: np.ndarray) -> np.ndarray:
    messages = messages[np.argsort(messages[:, 0], kind="stable")]
    first = np.flatnonzero(np.concatenate([[True], messages[1:, 0] != messages[:-1, 0]]))
    out = np.add.reduceat(messages, first)
    out[:, 0] = messages[first, 0]
    return out


_OUT = "message boolean, conv long, level long, members long, leaves long, saved long, roots array<long>"


def _forward(most: int, queue: int = QUEUE):
    """Totals of a shard's runs, and messages to parents with more than `most` members. Rows: level, conv, members, leaves, saved (a run's own, or a message's), up
    (the parent), up_level, up_members, roots; sorted by falling level, messages of a level before its runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, at, inbox = LevelQueue(queue), None, None
        for batch in batches:
            level, conv, members, leaves, saved, up, up_level, up_members = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(8))
            message, roots = batch.column(8).to_numpy(zero_copy_only=False), batch.column(9)
            cut = np.flatnonzero(np.concatenate([[True], level[1:] != level[:-1], [True]])) if len(level) else np.zeros(1, np.int64)
            for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                sent, runs = a + np.flatnonzero(message[a:b]), a + np.flatnonzero(~message[a:b])
                if len(sent):
                    waiting.push(level[sent], np.stack([conv[sent], leaves[sent], saved[sent]], 1))
                if not len(runs):
                    continue
                if at != level[a]:
                    at, inbox = level[a], waiting.pop(int(level[a]))
                total = np.stack([conv[runs], leaves[runs], saved[runs]], 1)
                if len(inbox):
                    place = np.minimum(np.searchsorted(inbox[:, 0], conv[runs]), len(inbox) - 1)
                    total[:, 1:] += np.where((inbox[place, 0] == conv[runs])[:, None], inbox[place, 1:], 0)
                inner = up_members[runs] <= most
                onward = np.stack([up[runs], total[:, 1], total[:, 2]], 1)
                waiting.push(up_level[runs][inner], onward[inner])
                out = np.flatnonzero(~inner & (up_members[runs] < np.iinfo(np.int64).max))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat([False, True], [len(runs), len(out)])), pa.array(np.concatenate([total[:, 0], onward[out, 0]])), pa.array(np.concatenate([level[runs], up_level[runs][out]])),
                    pa.array(np.concatenate([members[runs], up_members[runs][out]])), pa.array(np.concatenate([total[:, 1], onward[out, 1]])), pa.array(np.concatenate([total[:, 2], onward[out, 2]])),
                    pa.concat_arrays([pa.nulls(len(runs), roots.type), roots.take(pa.array(runs[out]))]),
                ], [x.split()[0] for x in _OUT.split(", ")])

    return run


def subtree_totals(runs: DataFrame, limits: list[int], scratch: Scratch, queue: int = QUEUE) -> DataFrame:
    """conv, level, leaves and saved of each run's subtree. runs: level, conv, members, leaves, saved, up, up_level, up_members, and roots: by limit, the name
    of the topmost subtree with so many members that the run is in."""
    kind = lambda members: sum((F.col(members) > x).cast("int") for x in limits)
    none, cols = F.lit(np.iinfo(np.int64).max), ("level", "conv", "members", "leaves", "saved", "up", "up_level", "up_members", "message", "roots")
    runs = runs.withColumns({"up": F.coalesce("up", F.lit(0)), "up_level": F.coalesce("up_level", F.lit(0)), "up_members": F.coalesce("up_members", none), "message": F.lit(False)})
    totals, waiting = None, None
    for i, limit in enumerate(limits):
        shard = F.coalesce(F.element_at("roots", i + 1), F.lit(0)) if i < len(limits) - 1 else F.lit(0)
        here = runs.filter(kind("members") == i).select(*cols, shard.alias("shard"))
        if waiting is not None:
            came = waiting.filter(kind("members") == i).withColumn("shard", shard).groupBy("shard", "level", "conv", "members").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
            here = here.unionByName(came.withColumns({"up": F.lit(0), "up_level": F.lit(0), "up_members": none, "message": F.lit(True), "roots": F.lit(None).cast("array<long>")}))
        in_order = here.repartition("shard").sortWithinPartitions(F.desc("level"), F.desc("message"), "conv").select(*cols)
        done = scratch.save(in_order.mapInArrow(_forward(limit, queue), _OUT), f"round-{i}")
        made, passed = done.filter("NOT message").select("conv", "level", "leaves", "saved"), done.filter("message").drop("message")
        totals, waiting = (made, passed) if totals is None else (totals.unionByName(made), waiting.unionByName(passed))
    return totals


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (to_a, to_b, conv) as texts of up to IDS ids of one node."""
    for batch in batches:
        a, b, conv = (c.to_numpy() for c in batch.columns)
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, bool)
        new |= (np.arange(len(a)) - np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))) % IDS == 0
        cut = np.append(np.flatnonzero(new), len(a))
        ids = conv.astype(str).tolist()
        text = [",".join(ids[i:j]) for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(a[cut[:-1]]), pa.array(b[cut[:-1]]), pa.array(conv[cut[:-1]]), pa.array(text, pa.string())], ["to_a", "to_b", "first", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted texts (to_a, to_b, first, ids) one hash a node, text after text."""
    at, state = None, None

    def table(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], ["to_a", "to_b", "ends_sha256"])

    for batch in batches:
        out = []
        for a, b, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if at == (a, b):
                state.update(b"," + ids.encode())
                continue
            if at:
                out.append((*at, state.hexdigest()))
            at, state = (a, b), hashlib.sha256(ids.encode())
        yield table(out)
    if at:
        yield table([(*at, state.hexdigest())])


def prefix_trie(rows: DataFrame, shard: int = SHARD, queue: int = QUEUE) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession)
    convs, prefixes = rebuilt(rows, scratch)
    count, lowest, turns_ = convs.agg(F.count("*"), F.min("conv"), F.sum("len")).first()
    long_ = lambda c, name: F.lit(c).cast("long").alias(name)
    if not count:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    most = max(shard, turns_ >> 16)  # at most 65,536 nodes have more members
    # the name of a prefix less its last turn's part is its parent's; differences of wrapped sums are taken as decimals and wrapped again
    grouped = prefixes.groupBy("to_a", "to_b", F.col("count").alias("depth")).agg(F.count("*").alias("members"), F.min("conv").alias("conv"), F.min("words").alias("words"), F.min(F.col("to_words") - F.col("words")).alias("above"), F.min(wrapped("to_a", "a")).alias("up_a"), F.min(wrapped("to_b", "b")).alias("up_b"))
    root = spark.range(1).select(long_(0, "to_a"), long_(0, "to_b"), long_(0, "depth"), long_(count, "members"), long_(lowest, "conv"), long_(0, "words"), long_(0, "above"), long_(None, "up_a"), long_(None, "up_b"))
    alone = scratch.save(grouped.unionByName(root), "alone")
    below = alone.filter("depth > 0").groupBy(F.col("up_a").alias("to_a"), F.col("up_b").alias("to_b")).agg(F.count("*").alias("children"))
    parents = alone.select(F.col("to_a").alias("up_a"), F.col("to_b").alias("up_b"), F.col("conv").alias("up"), F.col("members").alias("up_members"))
    placed = _with_hot(alone.filter("depth > 0"), parents, ["up_a", "up_b"], "up_members", most).unionByName(alone.filter("depth = 0").withColumns({"up": F.lit(None).cast("long"), "up_members": F.lit(None).cast("long")}))
    nodes = scratch.save(placed.join(below, ["to_a", "to_b"], "left").withColumn("children", F.coalesce("children", F.lit(0))), "nodes")
    limits = [shard]
    while limits[-1] < count:
        limits.append(limits[-1] * shard)
    sized = _with_hot(prefixes.select("conv", F.col("count").alias("depth"), "to_a", "to_b"), alone.select("to_a", "to_b", "members"), ["to_a", "to_b"], "members", most)
    top = lambda x: F.min_by("to_a", F.when(F.col("members") <= x, F.col("depth")))
    paths = scratch.save(sized.groupBy("conv").agg(F.array(*map(top, limits)).alias("roots"), F.max_by("to_a", "depth").alias("to_a"), F.max_by("to_b", "depth").alias("to_b")), "paths")
    runs = nodes.groupBy("conv", "members").agg(
        F.min("depth").alias("top"), F.max("depth").alias("level"), F.sum((F.col("members") - 1) * F.col("words")).alias("saved"), F.max_by(F.col("children") == 0, "depth").cast("long").alias("leaves"),
        F.min("above").alias("top_above"), F.min_by(F.struct("up", "up_members"), "depth").alias("p"),
    ).select("conv", "members", "top", "level", "saved", "leaves", "top_above", "p.*", (F.col("top") - 1).alias("up_level"))
    runs = scratch.save(runs.join(paths.select("conv", "roots"), "conv", "left"), "runs")
    totals = subtree_totals(runs.select("level", "conv", "members", "leaves", "saved", "up", "up_level", "up_members", "roots"), limits, scratch, queue)
    spread = totals.join(runs.select("conv", "level", "members", "top", "top_above"), ["conv", "level"]).withColumn("piece", F.explode(F.sequence((F.col("top") / CHUNK).cast("long"), (F.col("level") / CHUNK).cast("long"))))
    summed_ = nodes.withColumn("piece", (F.col("depth") / CHUNK).cast("long")).join(spread.select("conv", "members", "piece", "leaves", "saved", "top_above"), ["conv", "members", "piece"])
    ends = paths.select("to_a", "to_b", "conv").unionByName(convs.filter("len = 0").select(long_(0, "to_a"), long_(0, "to_b"), "conv"))
    texts = ends.repartitionByRange("to_a", "to_b", "conv").sortWithinPartitions("to_a", "to_b", "conv").mapInArrow(_joined_ids, "to_a long, to_b long, first long, ids string")
    hashes = texts.repartition("to_a", "to_b").sortWithinPartitions("to_a", "to_b", "first").mapInArrow(_hashed, "to_a long, to_b long, ends_sha256 string")
    return summed_.join(hashes, ["to_a", "to_b"], "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("up").alias("parent_conv_id"), F.col("members").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("saved") - (F.col("members") - 1) * (F.col("above") - F.col("top_above"))).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )


def wrapped(total: str, part: str):
    """total - part modulo 2**64, as a long."""
    span, half = F.expr(f"{1 << 64}BD"), F.expr(f"{1 << 63}BD")
    exact = F.col(total).cast("decimal(20,0)") - F.col(part).cast("decimal(20,0)")
    return F.when(exact >= half, exact - span).when(exact < -half, exact + span).otherwise(exact).cast("long")
