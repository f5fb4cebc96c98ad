"""Shared pieces of the training-data operators: shared-folder tables and
vectorised word hashing over whole Arrow string columns."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import hashlib
import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Text is hashed in slices of about this many bytes, so that a task's memory
#: does not follow the size of its Arrow batches. One longer document is a slice of its own.
SLICE_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words cut at ASCII white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
#: Bytes of words of ASCII digits, lower-case letters and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True

_MUL, _ADD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Words of more bytes are hashed one by one, by a cryptographic hash.
LONG_WORD = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a new local one where it is unset
    and Spark runs in one process. A cluster without the setting is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='spark-shared-')}"
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    release(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Empty the files of a :func:`stored` table that nothing reads any more."""
    df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(df.stored_at)


#: Rows of texts that Spark hands to Python at once: its default of 10,000 makes batches of whole
#: texts as large as all else a task holds.
BATCH_ROWS = 2_000


def small_batches(spark: SparkSession) -> None:
    """Sets the rows of an Arrow batch to BATCH_ROWS, unless the session has set its own number."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


#: Memory of its own above which a worker gives back what is free: an idle one has some 75 MB.
IDLE_BYTES = 128 << 20
#: Functions whose results a worker keeps for further tasks (``lru_cache``).
KEPT: list = []


def own_bytes() -> int:
    """Memory of this process without mapped files; 0 where that is not told."""
    try:
        with open("/proc/self/statm") as f:
            pages = f.read().split()
    except OSError:
        return 0
    return (int(pages[1]) - int(pages[2])) * os.sysconf("SC_PAGE_SIZE")


def give_back() -> None:
    """Free memory goes back to the system, once the process has more than IDLE_BYTES."""
    if own_bytes() <= IDLE_BYTES:
        return
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc alone has it
        ctypes.CDLL(None).malloc_trim(0)


def forget(keep: tuple = ()) -> None:
    """Drops what KEPT but ``keep`` hold in this process."""
    for kept in KEPT:
        if kept not in keep:
            kept.cache_clear()


def lean(read, keep: tuple = ()):
    """``read`` for mapInArrow, so that a task leaves little behind in its worker. Spark uses workers
    again for all that follows: what one step has freed but not given back, or keeps for its next
    tasks (all of KEPT but ``keep``), else adds up with the memory of later ones."""

    @functools.wraps(read)
    def run(batches):
        forget(keep)
        try:
            yield from read(batches)
        finally:
            give_back()

    return run


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of plans that nothing refers to any more; it
    waits for the driver's garbage collector, which a small driver may not run for long."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; bijective."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_slices(batch: pa.RecordBatch, name: str = "text"):
    """(first row, last row, bytes, offsets) of consecutive rows; null counts as empty."""
    col = pc.fill_null(batch.column(batch.schema.get_field_index(name)).cast(pa.large_string()), "")
    if not len(col):
        return
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(col):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + SLICE_BYTES, "right")) - 1)
        hi = min(hi, len(col))
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words: eight bytes at a time are mixed in by a bijection, so that no sum of
    powers makes words of one length collide. Two words of up to eight bytes and one length never do."""
    lens = ends - starts
    h = mix(lens.astype(np.uint64) * _ADD + _MUL)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(data) + 1,), (1,)) if len(data) else np.zeros(1, np.uint64)
    at = np.flatnonzero(lens <= LONG_WORD)
    done = 0
    while len(at := at[lens[at] > done]):
        rest = np.minimum(lens[at] - done, 8).astype(np.uint64)
        part = eight[starts[at] + done] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - rest * np.uint64(8)))
        h[at] = mix((h[at] ^ part) * _MUL + _ADD)
        done += 8
    for k in np.flatnonzero(lens > LONG_WORD).tolist():
        h[k] = int.from_bytes(hashlib.blake2b(data[starts[k] : ends[k]].tobytes(), digest_size=8).digest(), "little")
    return h


class Words:
    """All words of a slice: byte ``starts`` and ``ends``, 64-bit ``hash``, ``doc`` (row in the slice),
    and ``first`` (index of each row's first word, one more at the end)."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, keep: np.ndarray = NOT_SPACE, cuts: np.ndarray = np.zeros(0, np.int64)):
        """``keep`` has the bytes of words; words end at ``cuts`` (byte positions), too."""
        inside = keep[data]
        n = len(data)
        before = np.empty(n + 1, bool)
        before[0] = False
        before[1:] = inside
        before[offs] = before[cuts] = False
        self.starts = np.flatnonzero(inside & ~before[:n])
        after = np.empty(n + 1, bool)
        after[n] = False
        after[:n] = inside
        after[offs] = after[cuts] = False
        self.ends = np.flatnonzero(inside & ~after[1:]) + 1
        self.hash = hashes(data, self.starts, self.ends)
        self.first = np.searchsorted(self.starts, offs)
        self.doc = np.repeat(np.arange(len(offs) - 1), np.diff(self.first))


def word_hash(word: str) -> int:
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(Words(raw, np.array([0, len(raw)]), np.ones(256, bool)).hash[0])


def runs(keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values in a sorted array, and its length at the end."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def multi_arange(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenated ranges start..start+len-1."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    return np.arange(total) + np.repeat(starts - (ends - lens), lens)


def bitset_of(ids: DataFrame, column: str, bits: int = 24) -> np.ndarray:
    """A bit for each value's low ``bits`` bits: 2**bits bits at most, whatever the input. May hold
    values that are not there, lacks none that are; test with :func:`in_bitset`."""
    from pyspark.sql import functions as F

    slot = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    rows = (
        ids.select(F.shiftright(slot, 6).cast("int").alias("w"), F.expr("shiftleft(1L, cast(0 as int))").alias("one"), slot.bitwiseAND(F.lit(63)).cast("int").alias("s"))
        .select("w", F.expr("shiftleft(one, s)").alias("b"))
        .groupBy("w")
        .agg(F.bit_or("b").alias("b"))
        .toArrow()
    )
    out = np.zeros(1 << (bits - 6), np.int64)
    out[rows.column("w").to_numpy()] = rows.column("b").to_numpy()
    return out


def in_bitset(bitset: np.ndarray, values: np.ndarray) -> np.ndarray:
    slot = values.astype(np.int64) & (len(bitset) * 64 - 1)
    return ((bitset[slot >> 6] >> (slot & 63)) & 1).astype(bool)
