"""FASTQ in and out.

Reading is a Python data source over byte ranges: a task begins at a byte of a file, skips to the first record that begins behind it (a line that begins with @
whose second next begins with +, which no quality line can be), and goes on to the last record that begins in its range, so each record is read once whatever
the ranges are. Of blocked gzip files (BGZF) the blocks are such points; other gzip files are one range. Record numbers and mates in step come from a first pass that counts the records of each range.
A task counts, and reads, neighbouring ranges of a file up to `SPLIT` bytes, or less while cores would be idle, so small ranges cost no task each. Mates of unequal number are an error.

Writing fans out by sample: tasks write files of their own under a folder of the job, and the commit moves the files of finished attempts to their sample and then adds
one manifest file, by which samples are read. So mates stay in step after a retry, and an append is seen whole or not at all."""

from __future__ import annotations

import gzip
import json
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import zip_longest

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from tagloom.functions.sequence import reverse_complement

SPLIT, CHUNK = 64 << 20, 4 << 20
_BLOCK = b"\x1f\x8b\x08\x04"  # fixed value: how a gzip member with an extra field begins
SCHEMA = "file string, idx long, h1 string, s1 string, q1 string, h2 string, s2 string, q2 string"


@dataclass
class Span(InputPartition):
    """Records of a file that begin in a range of bytes (end -1: to the end of the file), at most `most` (-1: all), numbered from `idx` on; where in its mates' file the first one's mate is."""

    file: str
    begin: int = 0
    end: int = -1
    idx: int = 0
    most: int = -1
    mate: str | None = None
    mate_begin: int = 0
    mate_skip: int = 0
    whole: bool = False
    split: int = 0  # counted in ranges of so many bytes


def _where(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _block_size(head: bytes) -> int:
    """Bytes of the gzip block that begins here, 0 if none does."""
    if head[:4] != _BLOCK or len(head) < 18 or head[12:16] != b"BC\x02\x00":
        return 0
    return int.from_bytes(head[16:18], "little") + 1


def splittable(path: str) -> bool:
    """Plain or blocked gzip."""
    if not path.endswith(".gz"):
        return True
    where, inner = _where(path)
    with where.open_input_file(inner) as f:
        return _block_size(f.read(18)) > 0


def _chunks(path: str, begin: int, end: int) -> Iterator[tuple[bytes, bool]]:
    """Text from a place of the file on, without end, and whether it is of the range."""
    where, inner = _where(path)
    if path.endswith(".gz") and not splittable(path):
        with where.open_input_stream(inner, compression=None) as raw, gzip.open(raw) as text:
            while data := text.read(CHUNK):
                yield data, True
        return
    with where.open_input_file(inner) as f:
        size = f.size()
        end = size if end < 0 else end
        f.seek(begin)
        if not path.endswith(".gz"):
            while data := f.read(min(CHUNK, end - begin) if begin < end else 1 << 16):
                yield data, begin < end
                begin += len(data)
            return
        head = f.read((1 << 17) + 64)
        at = next((i for i in range(len(head)) if (n := _block_size(head[i : i + 18])) and (begin + i + n == size or head[i + n : i + n + 4] == _BLOCK)), None)
        begin = size if at is None else begin + at
        f.seek(begin)
        while begin < size:
            head = f.read(18)
            n = _block_size(head)
            if not n:
                raise ValueError(f"{path}: no gzip block at byte {begin}")
            yield zlib.decompress(head + f.read(n - 18), 31), begin < end
            begin += n


def _records(span: Span, begin: int | None = None, end: int | None = None) -> Iterator[tuple[list[bytes], list[bytes], list[bytes]]]:
    """Headers, sequences and qualities of the range's records, a chunk at a time."""
    begin, end = span.begin if begin is None else begin, span.end if end is None else end
    rest, at, mine, synced = b"", 0, 0, begin == 0

    def cut(lines: list[bytes]) -> tuple[list[bytes], list[bytes], list[bytes]]:
        if not all(x[:1] == b"@" for x in lines[::4]) or not all(x[:1] == b"+" for x in lines[2::4]):
            raise ValueError(f"{span.file}: not a whole FASTQ record near {lines[0][:60]!r}")
        return lines[::4], lines[1::4], lines[3::4]

    for data, own in _chunks(span.file, begin, end):
        mine += len(data) if own else 0
        rest += data
        if not synced:
            lines = rest.split(b"\n")[:-1]
            first = next((i for i in range(1, len(lines) - 2) if lines[i][:1] == b"@" and lines[i + 2][:1] == b"+"), None)
            if first is None:
                if not own and len(lines) > 8:
                    return
                continue
            skipped = sum(map(len, lines[:first])) + first
            rest, at, synced = rest[skipped:], skipped, True
        lines = rest.split(b"\n")[:-1]
        lines = lines[: len(lines) // 4 * 4]
        size = sum(map(len, lines)) + len(lines)
        last = False
        if at + size > mine:
            here, kept = at, 0
            while kept < len(lines) and here <= mine:
                here += sum(map(len, lines[kept : kept + 4])) + 4
                kept += 4
            last = not own and (kept < len(lines) or at + size > mine and here > mine)
            lines, size = (lines[:kept], here - at) if not own else (lines, size)
        if lines:
            yield cut(lines)
        if last:
            return
        rest, at = rest[size:], at + size
    if synced and rest.strip(b"\n") and at <= mine:
        lines = rest.rstrip(b"\n").split(b"\n")
        lines += [b""] if len(lines) == 3 and rest.endswith(b"+\n") else []  # an empty last read
        if len(lines) != 4:
            raise ValueError(f"{span.file}: not a whole FASTQ record at its end: {lines[0][:60]!r}")
        yield cut(lines)


def _limited(records: Iterator[tuple], skip: int, most: int) -> Iterator[tuple]:
    for chunk in records:
        n = len(chunk[0])
        if skip >= n:
            skip -= n
            continue
        chunk, skip = tuple(x[skip:] for x in chunk), 0
        if most >= 0:
            chunk = tuple(x[:most] for x in chunk)
            most -= len(chunk[0])
        if chunk[0]:
            yield chunk
        if most == 0:
            return


def _in_step(span: Span) -> Iterator[tuple]:
    """Chunks of six columns: records and their mates."""
    mates, held = _limited(_records(Span(span.mate), span.mate_begin, -1), span.mate_skip, -1), ([], [], [])
    for chunk in _limited(_records(span), 0, span.most):
        while len(held[0]) < len(chunk[0]):
            more = next(mates, None)
            if more is None:
                raise ValueError(f"{span.mate} ends before {span.file}")
            held = tuple(a + b for a, b in zip(held, more, strict=True))
        n = len(chunk[0])
        yield *chunk, *(x[:n] for x in held)
        held = tuple(x[n:] for x in held)
    if span.whole and (held[0] or next(mates, None)):
        raise ValueError(f"{span.file} ends before {span.mate}")


class FastqReader(DataSourceReader):
    def __init__(self, options: dict):
        self.counting = options.get("count") == "true"
        if "spans" in options:
            self.spans = [Span(*x) for x in json.loads(options["spans"])]
            return
        first, second = ([x for x in options.get(k, "").split(",") if x] for k in ("path", "mates"))
        if second and len(second) != len(first):
            raise ValueError("as many files of mates as of reads are needed")
        self.spans = [Span(a, mate=b, whole=True) for a, b in zip_longest(first, second)]

    def __getstate__(self) -> dict:
        return {"counting": self.counting}  # a task gets its own span, not all of them

    def partitions(self) -> list[InputPartition]:
        return self.spans or [Span("")]

    def read(self, span: Span) -> Iterator[pa.RecordBatch]:
        if not span.file:
            return
        if self.counting:
            ranges = [(a, min(a + span.split, span.end)) for a in range(span.begin, span.end, span.split)] if span.split else [(span.begin, span.end)]
            counts = [sum(len(h) for h, _, _ in _records(span, *x)) for x in ranges]
            n = len(ranges)
            begins = pa.array([str(a) for a, _ in ranges], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([span.file] * n), pa.array(counts, pa.int64()), begins, *(pa.nulls(n, pa.string()) for _ in range(5))], [x.split()[0] for x in SCHEMA.split(", ")])
            return
        idx = span.idx
        for chunk in _in_step(span) if span.mate else _limited(_records(span), 0, span.most):
            n = len(chunk[0])
            columns = [pa.array(x, pa.binary()).cast(pa.string()) for x in chunk] + [pa.nulls(n, pa.string())] * (6 - len(chunk))
            yield pa.RecordBatch.from_arrays([pa.array([span.file] * n), pa.array(range(idx, idx + n), pa.int64()), *columns], [x.split()[0] for x in SCHEMA.split(", ")])
            idx += n


class FastqSource(DataSource):
    """spark.read.format("fastq").option("mates", ...).load(paths): a task a file; read_fastq splits files."""

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return FastqReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("samples are appended, nothing is overwritten")
        return SampleWriter(self.options)


def spans_of(path: str, split: int) -> list[Span]:
    where, inner = _where(path)
    size = where.get_file_info(inner).size
    if size is None:
        raise FileNotFoundError(path)
    if size <= split or not splittable(path):
        return [Span(path)]
    return [Span(path, a, min(a + split, size)) for a in range(0, size, split)]


def _packed(spans: list[Span], most: int, split: int) -> list[list[Span]]:
    """Ranges of a file, in order, as lists of neighbouring ones of at most so many bytes in all."""
    several = max(1, most // split)
    return [spans[i : i + several] for i in range(0, len(spans), several)]


def read_fastq(spark: SparkSession, paths: list[str], mates: list[str] | None = None, first: int | None = None, split: int = SPLIT) -> DataFrame:
    """Reads, or pairs, of some files, numbered by file, in ranges of `split` bytes; `first` takes the first so many of each file, and reads no further."""
    spark.dataSource.register(FastqSource)
    if mates and len(mates) != len(paths):
        raise ValueError("as many files of mates as of reads are needed")
    load = lambda spans, **more: spark.read.format("fastq").options(spans=json.dumps([list(vars(s).values()) for s in spans]), **more).load()
    pairs = list(zip(paths, mates or [None] * len(paths), strict=True))
    if first is not None:
        return load([Span(a, most=first, mate=b) for a, b in pairs])
    cut = {p: spans_of(p, split) for p in {*paths, *(mates or [])}}
    if all(len(cut[a]) == 1 for a in paths):
        return load([Span(a, mate=b, whole=True) for a, b in pairs])
    cores = spark.sparkContext.defaultParallelism
    most = lambda files: max(split, min(SPLIT, sum(cut[p][-1].end for p in files if len(cut[p]) > 1) // cores))
    counted = [p for p in cut if len(cut[p]) > 1 or mates]
    tasks = [Span(p, pack[0].begin, pack[-1].end, split=split if len(cut[p]) > 1 else 0) for p in counted for pack in _packed(cut[p], most(counted), split)]
    number = {(r.file, int(r.h1)): r.idx for r in load(tasks, count="true").select("file", "h1", "idx").collect()}  # a row a range
    starts: dict[str, list[int]] = {}
    total: dict[str, int] = {}
    for p in counted:
        starts[p], total[p] = [], 0
        for s in cut[p]:
            starts[p].append(total[p])
            total[p] += number[p, s.begin]
    plan = []
    for a, b in pairs:
        if b and total[a] != total[b]:
            raise ValueError(f"{a} has {total[a]} records, {b} has {total[b]}")
        at = 0
        for pack in _packed(cut[a], most(paths), split):
            idx, begin, skip = starts[a][at] if a in starts else 0, 0, 0
            if b:
                place = bisect_right(starts[b], idx) - 1
                begin, skip = cut[b][place].begin, idx - starts[b][place]
            plan.append(Span(a, pack[0].begin, pack[-1].end, idx, -1, b, begin, skip))
            at += len(pack)
    return load(plan)


@dataclass
class Written(WriterCommitMessage):
    """Files of a finished task: (where it is, where it goes), and its rows of the manifest."""

    files: list[tuple[str, str]]
    rows: list[str]


def _as_text(heads: pa.Array, seqs: pa.Array, quals: pa.Array) -> pa.Buffer | bytes:
    """Records as they stand in a file, joined in Arrow; a missing text is empty."""
    wide = pa.large_string()
    parts = heads.cast(wide), seqs.cast(wide), pa.scalar("+", wide), quals.cast(wide), pa.scalar("", wide), pa.scalar("\n", wide)
    joined = pc.binary_join_element_wise(*parts, null_handling="replace", null_replacement="")
    return joined.buffers()[2].slice(0, int(np.frombuffer(joined.buffers()[1], np.int64)[len(joined)])) if len(joined) else b""


class SampleWriter(DataSourceArrowWriter):
    """Columns sample, type, h1, s1, q1, h2, s2, q2 to files by sample and mate: R0 of unpaired reads, R1 and R2 of paired ones, R12 of merged ones."""

    NAMES = {"unpaired": ("R0",), "paired": ("R1", "R2"), "overlapped": ("R12",)}

    def __init__(self, options: dict):
        self.path, self.end = options["path"].rstrip("/"), ".fastq.gz" if options.get("compress", "false").lower() == "true" else ".fastq"
        self.job = uuid.uuid4().hex[:12]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        task = TaskContext.get()
        mark = f"{self.job}-{task.partitionId():05d}"
        where, root = _where(self.path)
        folder = f"{root}/_writing/{self.job}/{task.partitionId()}-{task.attemptNumber()}-{task.taskAttemptId()}"
        where.create_dir(folder)
        open_: dict[tuple[str, str], list] = {}
        for batch in iterator:
            columns = {c: batch.column(c) for c in batch.schema.names}
            coded = [columns[c].dictionary_encode(null_encoding="encode") for c in ("sample", "type")]
            kinds, of = np.unique(np.stack([c.indices.to_numpy() for c in coded], 1), axis=0, return_inverse=True)
            for no, (sample, kind) in enumerate(kinds.tolist()):
                key = coded[0].dictionary[sample].as_py(), coded[1].dictionary[kind].as_py()
                rows = pa.array(np.flatnonzero(of.ravel() == no))
                if key not in open_:
                    names = [f"{key[0]}_{m}-{mark}{self.end}" for m in self.NAMES[key[1]]]
                    open_[key] = [(n, where.open_output_stream(f"{folder}/{n}", compression="gzip" if self.end.endswith("gz") else None)) for n in names]
                for m, (_, out) in enumerate(open_[key], 1):
                    out.write(_as_text(*(columns[f"{c}{m}"].take(rows) for c in "hsq")))
        files, lines = [], []
        for (sample, kind), outs in open_.items():
            for name, out in outs:
                out.close()
                files.append((f"{folder}/{name}", f"{root}/{sample}/{name}"))
            made = [f"{self.path}/{sample}/{name}" for name, _ in outs]
            lines.append("\t".join([sample, kind, *made, *["."] * (2 - len(made))]))
        return Written(files, lines)

    def commit(self, messages: list[Written | None]) -> None:
        where, root = _where(self.path)
        done = [m for m in messages if m is not None]
        for folder in sorted({to.rsplit("/", 1)[0] for m in done for _, to in m.files} | {f"{root}/_manifest", f"{root}/_writing"}):
            where.create_dir(folder)
        for m in done:
            for at, to in m.files:
                where.move(at, to)
        with where.open_output_stream(f"{root}/_writing/{self.job}.tsv") as out:
            out.write("".join(f"{line}\n" for m in done for line in m.rows).encode())
        where.move(f"{root}/_writing/{self.job}.tsv", f"{root}/_manifest/{self.job}.tsv")  # from here on the files are part of the table
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        """Files that no manifest names go."""
        where, root = _where(self.path)
        if where.get_file_info(f"{root}/_writing/{self.job}").type == fs.FileType.Directory:
            where.delete_dir(f"{root}/_writing/{self.job}")


def write_samples(found: DataFrame, path: str, compress: bool = False) -> None:
    """Checked-out pairs (sample, type, umi, umi_qual, swapped, h1, s1, q1, h2, s2, q2) as FASTQ files by sample, appended to what is there. Headers say which mate a read was, and its tag; undef-m
    and undef-s are samples too."""
    found.sparkSession.dataSource.register(FastqSource)
    tag = F.when(F.length("umi") > 0, F.concat(F.lit(" UMI:"), "umi", F.lit(":"), "umi_qual")).otherwise("")
    turned = F.coalesce("swapped", F.lit(False))
    head = lambda own, other, mark, mark_other: F.concat(F.when(turned, F.concat(F.col(other), F.lit(mark_other))).otherwise(F.concat(F.col(own), F.lit(mark))), tag)
    table = found.select("sample", "type", head("h1", "h2", " R1", " R2").alias("h1"), "s1", "q1", head("h2", "h1", " R2", " R1").alias("h2"), "s2", "q2")
    table.write.format("fastq").mode("append").options(path=path, compress=str(compress)).save()


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """sample, type, fastq1, fastq2 of all that was committed: a row for each task that wrote some of a sample."""
    return spark.read.csv(f"{path}/_manifest", sep="\t", schema="sample string, type string, fastq1 string, fastq2 string", nullValue=".", pathGlobFilter="*.tsv")


def read_samples(spark: SparkSession, path: str, type_: str, samples: list[str] | None = None, split: int = SPLIT) -> DataFrame:
    """Reads of one type of all or some samples, with their sample."""
    rows = manifest(spark, path).filter(F.col("type") == type_)
    files = (rows if samples is None else rows.filter(F.col("sample").isin(samples))).orderBy("fastq1").collect()
    reads = read_fastq(spark, [r.fastq1 for r in files], [r.fastq2 for r in files] if files and type_ == "paired" else None, split=split)
    return reads.withColumn("sample", F.element_at(F.split("file", "/"), -2))


def write_fastq(reads: DataFrame, path: str, header: str = "header", seq: str = "seq", qual: str = "qual", by: tuple[str, ...] = (), compress: bool = False, mode: str = "error") -> None:
    """One record a row, in folders by the given columns (sample, mate); `write_samples` makes files of a run's samples."""
    text = reads.select(*by, F.concat_ws("\n", header, seq, F.lit("+"), qual).alias("value"))
    text.write.mode(mode).partitionBy(*by).text(path, compression="gzip" if compress else "none")


def groom(reads: DataFrame, header: str = "header", seq: str = "seq", qual: str = "qual", reverse: bool = False) -> DataFrame:
    """Consensus reads whose header has its tag joined to the name; if asked, on the other strand."""
    named = reads.withColumn(header, F.regexp_replace(header, " UMI:", "_UMI:"))
    return named.withColumns({seq: reverse_complement(F.col(seq)), qual: F.reverse(qual)}) if reverse else named
