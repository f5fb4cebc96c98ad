"""One large JSON array as a Spark data source.

``spark.read.format("json_array")`` cuts a file into byte ranges that tasks read side by side. A
record belongs to the range in which its opening brace lies. A task finds its place by the depth of
braces and brackets and by quotes: it reads blocks of bounded size, never the array.

A task takes consecutive ranges, of many small files or a part of a large one, so that tasks grow with
the bytes and not with the ranges. Where one begins within a file, it cannot be seen from there whether
that is within a string or a record. The stretches before it are therefore summed up first, in tasks and
for both answers (begins within a string or not): how depth and quotes change across them. Files that
one task reads whole need no sums.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a range, and bytes that a task holds at once beside the record it reads.
RANGE_BYTES, BLOCK_BYTES = 64 << 20, 1 << 20
#: Bytes of ranges that a task reads one after another, about; of small inputs a quarter of a core's share.
TASK_BYTES = 32 << 20
BATCH_ROWS = 2_000
#: Wanted ids that the readers are given by name.
WANTED_IDS = 1_000
QUOTE, BACKSLASH = 34, 92
#: How much each byte outside strings adds to the depth.
DEPTH = np.zeros(256, np.int64)
DEPTH[[ord("{"), ord("[")]] = 1
DEPTH[[ord("}"), ord("]")]] = -1
#: Bytes that change depth or quotes.
TELLING = DEPTH != 0
TELLING[QUOTE] = True


class Scanner:
    """Goes through bytes in blocks, and knows depth and whether it is within a string."""

    def __init__(self, depth: int = 0, inside: bool = False, escaped: bool = False):
        self.depth, self.inside, self.escaped = depth, inside, escaped

    def block(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(depth after each byte, whether each byte lies outside strings); the state moves to the end."""
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(0, bool)
        slash = data == BACKSLASH
        # a sign is escaped if an odd run of backslashes ends before it
        at = np.arange(len(data))
        last = np.maximum.accumulate(np.where(slash, -1, at))  # the last sign that is none
        run = np.where(slash, at - last, 0)
        if self.escaped:
            run[: int(np.argmin(slash)) if not slash.all() else len(data)] += 1
        before = np.empty(len(data), np.int64)
        before[0], before[1:] = int(self.escaped), run[:-1]
        quote = (data == QUOTE) & (before % 2 == 0)
        state = (np.cumsum(quote) + int(self.inside)) % 2 == 1  # after each byte
        outside = ~state & ~quote
        depth = self.depth + np.cumsum(np.where(outside, DEPTH[data], 0))
        self.depth, self.inside = int(depth[-1]), bool(state[-1])
        self.escaped = bool(run[-1] % 2)
        return depth, outside

    def changes(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places where the depth changes, depth after each); the state moves to the end. Without
        backslashes only braces, brackets and quotes are looked at."""
        if self.escaped or (data == BACKSLASH).any():
            depth, outside = self.block(data)
            at = np.flatnonzero(outside & (DEPTH[data] != 0))
            return at, depth[at]
        at = np.flatnonzero(TELLING[data])
        kind = data[at]
        quote = kind == QUOTE
        inside = (np.cumsum(quote) + int(self.inside)) % 2 == 1
        found = np.flatnonzero(~inside & ~quote)
        depth = self.depth + np.cumsum(DEPTH[kind[found]])
        if len(at):
            self.inside = bool(inside[-1])
        if len(found):
            self.depth = int(depth[-1])
        return at[found], depth


def blocks(path: str, start: int, end: int | None, size: int = BLOCK_BYTES) -> Iterator[np.ndarray]:
    """The bytes from ``start`` on, to ``end`` or the end of the file, a block at a time."""
    from pyarrow import fs

    where, name = fs.FileSystem.from_uri(path)
    with where.open_input_file(name) as f:
        f.seek(start)
        at = start
        while end is None or at < end:
            raw = f.read(size if end is None else min(size, end - at))
            if not raw:
                return
            at += len(raw)
            yield np.frombuffer(raw, np.uint8)


@dataclass
class Range:
    """A byte range of a file; ``depth``, ``inside`` and ``escaped`` as its first byte finds them."""

    path: str
    start: int
    end: int
    depth: int = 0
    inside: bool = False
    escaped: bool = False


@dataclass
class Share(InputPartition):
    """The ranges that a task reads."""

    parts: list[Range]


def summed(path: str, start: int, end: int) -> list[tuple[int, bool, bool]]:
    """(change of depth, within a string at the end, escaped at the end) of a range that begins outside
    and inside a string, each unescaped and escaped."""
    scanners = [Scanner(0, inside, escaped) for inside in (False, True) for escaped in (False, True)]
    first = True
    for data in blocks(path, start, end):
        if first and data[0] not in (QUOTE, BACKSLASH):  # an escaped sign that tells nothing is as any other
            scanners = [scanners[0]] * 2 + [scanners[2]] * 2
        first = False
        for s in {id(s): s for s in scanners}.values():
            s.changes(data)
    return [(s.depth, s.inside, s.escaped) for s in scanners]


def dealt(files: list[tuple[str, int]], size: int, task: int) -> list[list[tuple[str, int, int]]]:
    """(path, start, end) of the stretches of each task: ranges of ``size`` bytes in the files' order
    until they have ``task`` bytes, those that follow each other in a file as one."""
    out, held = [], 0
    for path, length in files:
        for lo in range(0, length, size):
            hi = min(lo + size, length)
            if not out or held >= task:
                out.append([])
                held = 0
            last = out[-1][-1] if out[-1] else ("", 0, 0)
            if lo and last[0] == path:
                out[-1][-1] = (path, last[1], hi)
            else:
                out[-1].append((path, lo, hi))
            held += hi - lo
    return out


def ranges(spark: SparkSession, path: str, size: int) -> list[list[Range]]:
    """The ranges of each task, of all files below ``path``, with the state that each begins with.

    The driver gets four small sums a range of a file that several tasks read; the bytes are read by tasks."""
    files = [tuple(f) for f in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length").collect()]
    task = min(TASK_BYTES, sum(n for _, n in files) // (4 * spark.sparkContext.defaultParallelism))
    shares = dealt(files, size, task)
    length = dict(files)
    cuts = [c for share in shares for c in share if c[2] < length[c[0]]]
    found = sums_of(spark, cuts) if cuts else {}
    out, depth, inside, escaped = [], 0, False, False
    for share in shares:
        out.append([])
        for name, lo, hi in share:
            if not lo:
                depth, inside, escaped = 0, False, False
            out[-1].append(Range(name, lo, hi, depth, inside, escaped))
            if (name, lo) in found:
                change, inside, escaped = found[name, lo][2 * inside + escaped]
                depth += change
    return out


def sums_of(spark: SparkSession, cuts: list[tuple[str, int, int]]) -> dict[tuple[str, int], list[tuple[int, bool, bool]]]:
    """:func:`summed` of each of the stretches, by path and start."""
    kinds = "k long, depth array<long>, inside array<boolean>, escaped array<boolean>"

    def sums(batches):
        for batch in batches:
            out = [summed(*row) for row in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)))]
            cols = [pa.array([[s[j] for s in x] for x in out], pa.list_(t)) for j, t in enumerate((pa.int64(), pa.bool_(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["k", "depth", "inside", "escaped"])

    rows = spark.createDataFrame([(k, *c) for k, c in enumerate(cuts)], "k long, path string, start long, stop long")
    return {cuts[r.k][:2]: list(zip(r.depth, r.inside, r.escaped)) for r in rows.repartition(len(cuts), "k").mapInArrow(sums, kinds).collect()}


def records(part: Range) -> Iterator[tuple[bytes, bool]]:
    """(bytes, whole) of each record that begins in a range; its end may lie beyond. A record that the
    file cuts short is not whole. Memory is a block and the record being read."""
    scanner, at, held, open_ = Scanner(part.depth, part.inside, part.escaped), part.start, [], False

    def parts():
        yield from blocks(part.path, part.start, part.end)
        yield from blocks(part.path, part.end, None)

    for data in parts():
        change, after = scanner.changes(data)
        begins = change[(after == 2) & (data[change] == ord("{"))].tolist()
        ends = change[(after == 1) & (data[change] == ord("}"))].tolist()
        raw, lo, b, e = data.tobytes(), 0, 0, 0
        while True:
            if open_:
                while e < len(ends) and ends[e] < lo:
                    e += 1
                if e == len(ends):
                    held.append(raw[lo:])
                    break
                held.append(raw[lo : ends[e] + 1])
                yield b"".join(held), True
                held, open_, lo = [], False, ends[e] + 1
            while b < len(begins) and begins[b] < lo:
                b += 1
            if b == len(begins) or at + begins[b] >= part.end:
                break
            open_, lo = True, begins[b]
        at += len(data)
        if at >= part.end and not open_:
            return
    if open_:
        yield b"".join(held), False


class JsonArrayReader(DataSourceReader):
    def __init__(self, shares: list[list[Range]], key: str | None, wanted: set | None):
        self.shares, self.key, self.wanted = shares, key, wanted

    def partitions(self):
        return [Share(parts) for parts in self.shares] or [Share([])]

    def read(self, share: Share):
        rows = []
        for part in share.parts:
            for raw, whole in records(part):
                text = raw.decode(errors="replace")
                if whole and self.wanted is not None and self.unwanted(text):
                    continue
                rows.append((text, part.path, whole))
                if len(rows) == BATCH_ROWS:
                    yield self.batch(rows)
                    rows = []
        if rows:
            yield self.batch(rows)

    def unwanted(self, text: str) -> bool:
        """Whether a record's key is none of those wanted; one that is no JSON stays, to be reported."""
        try:
            return json.loads(text).get(self.key) not in self.wanted
        except ValueError:
            return False

    def batch(self, rows):
        cols = zip(zip(*rows), (pa.string(), pa.string(), pa.bool_()))
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in cols], ["record", "path", "whole"])


class JsonArraySource(DataSource):
    """Options: ``ranges`` (as :func:`read_array` makes them), ``key`` and ``wanted``."""

    @classmethod
    def name(cls):
        return "json_array"

    def schema(self):
        return "record string, path string, whole boolean"

    def reader(self, schema):
        shares = [[Range(*x) for x in share] for share in json.loads(self.options["ranges"])]
        wanted = self.options.get("wanted")
        return JsonArrayReader(shares, self.options.get("key"), None if wanted is None else set(json.loads(wanted)))


def read_array(spark: SparkSession, path: str, schema: str, range_bytes: int = RANGE_BYTES, wanted: DataFrame | None = None, key: str = "id") -> DataFrame:
    """The records of all files below ``path``, each one JSON array of objects: the fields of
    ``schema`` and ``_corrupt``, the record where it is no JSON of that schema or is cut short.

    A file is read by up to as many tasks as it has ranges, through pyarrow's file systems. An empty file or
    array gives no row. Signs between records are not looked at; an array within the array is no
    record. With ``wanted`` (a column ``key``) only its records and corrupt ones: up to WANTED_IDS
    ids go to the readers, which pass over the others; more are joined. The files are read once.
    """
    spark.dataSource.register(JsonArraySource)
    shares = [[(p.path, p.start, p.end, p.depth, p.inside, p.escaped) for p in share] for share in ranges(spark, path, range_bytes)]
    source = spark.read.format("json_array").option("ranges", json.dumps(shares))
    if wanted is not None:
        wanted = wanted.select(key).where(F.col(key).isNotNull()).distinct()
        few = [r[0] for r in wanted.limit(WANTED_IDS + 1).collect()]
        if len(few) <= WANTED_IDS:
            source, wanted = source.option("key", key).option("wanted", json.dumps(few)), None
    x = F.from_json("record", f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rows = source.load().select(x.alias("x"), "record", "whole").select("x.*", "record", "whole")
    rows = rows.withColumn("_corrupt", F.when(F.col("_corrupt").isNotNull() | ~F.col("whole"), F.col("record"))).drop("record", "whole")
    if wanted is None:
        return rows
    marked = rows.join(wanted.withColumn("__wanted", F.lit(True)), key, "left")
    return marked.where("_corrupt is not null or __wanted").select(*rows.columns)
