"""Best-fit packing of tokenised documents into sequences, bulk-synchronously.

Pieces are range-sorted by length, longest first, and get their rank in their length. Equal lengths
and the sequences that one match left with equal gaps form runs; a round range-sorts the runs of
pieces and gaps by size, and each range is swept for successors, the smallest gap that a piece fits.
Where several want one gap, rank decides, longest first. Gaps are then updated, and the next round
begins. What is placed by a match is found for each piece from its rank.
"""

from __future__ import annotations

import functools
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEPT, NOT_SPACE, Words, lean, multi_arange, small_batches, stored, text_slices

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 4096
END_ID = 1
#: A worker's memory of words already encoded is emptied at this many.
CACHED_WORDS = 400_000
#: 1 for ASCII letters, 2 for ASCII signs but the apostrophe. The tokenizer always cuts between the
#: two kinds, so a word and the signs around it are encoded apart, which leaves fewer distinct words.
KINDS = np.zeros(256, np.uint8)
KINDS[[*range(65, 91), *range(97, 123)]] = 1
KINDS[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'"]] = 2
#: New words are encoded this many at a time, as one text with a mark between them. The mark is a
#: token of its own; the few words that hold it are encoded alone.
JOINED_WORDS, MARK = 500, "~"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Encodes texts through their distinct white-space-separated words.

    The tokenizer drops white space and looks at nothing across it or across the cuts of KINDS, so
    the ids of a text are those of its words in order; each distinct word is encoded once.
    ``added``: as the tokenizer does by default, an added token in a text (as <|endoftext|>) is its
    one id, a word of its own; else it is encoded like other text.
    """

    def __init__(self, path: str, added: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        contents = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()] if added else []
        self.added = sorted(contents, key=len, reverse=True)
        self.any_added = re.compile(b"|".join(map(re.escape, self.added)))
        self.forget()
        self.mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids[0]

    def forget(self) -> None:
        """Words known so far: sorted hashes, their bytes, and where in ``flat`` the ids of each begin, and how many."""
        self.hashes = np.zeros(0, np.uint64)
        self.begin, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)
        #: the bytes of the known words one after another, and where each begins
        self.spelt, self.spelt_at = bytearray(), np.zeros(0, np.int64)
        self.spelt_sizes = np.zeros(0, np.int64)

    def encode_words(self, words: list[str]) -> list[bytes]:
        plain = [k for k, w in enumerate(words) if MARK not in w]
        texts = [f" {MARK} ".join(words[k] for k in plain[i : i + JOINED_WORDS]) + f" {MARK}" for i in range(0, len(plain), JOINED_WORDS)]
        out = [b""] * len(words)
        if len(plain) < len(words):
            rest = sorted(set(range(len(words))) - set(plain))
            for k, e in zip(rest, self.tokenizer.encode_batch([words[k] for k in rest], add_special_tokens=False)):
                out[k] = np.array(e.ids, np.uint32).tobytes()
        at = 0
        for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            ids = np.array(e.ids, np.uint32)
            ends = np.flatnonzero(ids == self.mark)
            raw, begin = ids.tobytes(), 0
            for end in ends.tolist():
                out[plain[at]] = raw[4 * begin : 4 * end]
                begin, at = end + 1, at + 1
        return out

    def cuts(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Where words end beside white space: between the KINDS, and at (not within) added tokens."""
        kind = KINDS[data]
        cuts = np.flatnonzero(kind[1:] + kind[:-1] == 3) + 1
        raw = data.tobytes() if self.added else b""
        if not any(token in raw for token in self.added):
            return cuts
        found = [m.span() for lo, hi in zip(offs[:-1].tolist(), offs[1:].tolist()) for m in self.any_added.finditer(raw, lo, hi)]
        begin, end = np.array(found, np.int64).reshape(-1, 2).T
        within = np.searchsorted(begin, cuts) > np.searchsorted(end, cuts, "right")
        return np.concatenate([cuts[~within], begin, end])

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice of texts, each text followed by END_ID, and where each text begins."""
        w = Words(data, offs, NOT_SPACE, self.cuts(data, offs))
        distinct, at, inverse = np.unique(w.hash, return_index=True, return_inverse=True)
        if not self.same(data, w, at[inverse]):
            return self.encode_apart(data, offs, w)
        begin, sizes = np.empty(len(distinct), np.int64), np.empty(len(distinct), np.int64)
        place = np.minimum(np.searchsorted(self.hashes, distinct), max(0, len(self.hashes) - 1))
        new = np.ones(len(distinct), bool) if not len(self.hashes) else self.hashes[place] != distinct
        begin[~new], sizes[~new] = self.begin[place[~new]], self.sizes[place[~new]]
        if not self.spelt_alike(data, w, at[~new], place[~new]):
            return self.encode_apart(data, offs, w)
        if new.any():
            raw = data.tobytes()
            words = [raw[s:e].decode() for s, e in zip(w.starts[at[new]].tolist(), w.ends[at[new]].tolist())]
            pieces = self.encode_words(words)
            n = np.array([len(p) >> 2 for p in pieces], np.int64)
            begin[new], sizes[new] = len(self.flat) + np.cumsum(n) - n, n
            self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(pieces), np.uint32)])
            known = np.concatenate([self.hashes, distinct[new]])
            order = np.argsort(known, kind="stable")
            self.hashes = known[order]
            self.begin = np.concatenate([self.begin, begin[new]])[order]
            self.sizes = np.concatenate([self.sizes, sizes[new]])[order]
            long = (w.ends - w.starts)[at[new]]
            self.spelt_at = np.concatenate([self.spelt_at, len(self.spelt) + np.cumsum(long) - long])[order]
            self.spelt_sizes = np.concatenate([self.spelt_sizes, long])[order]
            self.spelt += data[multi_arange(w.starts[at[new]], long)].tobytes()
        lens = sizes[inverse]
        ids = self.flat[multi_arange(begin[inverse], lens)]
        if len(self.hashes) > CACHED_WORDS:
            self.forget()
        return self.ended(ids, lens, w, offs)

    def same(self, data: np.ndarray, w: Words, other: np.ndarray) -> bool:
        """Whether each word has the bytes of the word ``other``, which has its hash."""
        lens = w.ends - w.starts
        if (lens != lens[other]).any():
            return False
        return bool((data[multi_arange(w.starts, lens)] == data[multi_arange(w.starts[other], lens)]).all())

    def spelt_alike(self, data: np.ndarray, w: Words, at: np.ndarray, place: np.ndarray) -> bool:
        """Whether the words ``at`` have the bytes of the known ones at ``place``."""
        lens = (w.ends - w.starts)[at]
        if (lens != self.spelt_sizes[place]).any():
            return False
        known = np.frombuffer(bytes(self.spelt), np.uint8)
        return bool((data[multi_arange(w.starts[at], lens)] == known[multi_arange(self.spelt_at[place], lens)]).all())

    def encode_apart(self, data: np.ndarray, offs: np.ndarray, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`encode`, where two words of one hash differ: words are told apart by their bytes."""
        raw = data.tobytes()
        words = [raw[s:e] for s, e in zip(w.starts.tolist(), w.ends.tolist())]
        known = dict.fromkeys(words)
        known.update(zip(known, self.encode_words([x.decode() for x in known])))
        parts = [known[x] for x in words]
        return self.ended(np.frombuffer(b"".join(parts), np.uint32), np.array([len(p) >> 2 for p in parts], np.int64), w, offs)

    def ended(self, ids: np.ndarray, lens: np.ndarray, w: Words, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each text with END_ID after them, and where each text begins."""
        # a text's ids come after those of the texts before it and their END_IDs
        total = np.concatenate([[0], np.cumsum(lens)])[w.first]
        n = len(offs) - 1
        out = np.full(len(ids) + n, END_ID, np.uint32)
        where = np.ones(len(out), bool)
        where[total[1:] + np.arange(n)] = False
        out[where] = ids
        return out, total + np.arange(n + 1)


@functools.lru_cache(maxsize=1)
def encoder_of(path: str) -> WordEncoder:
    """A worker's encoder: the tokenizer is read once, not for each of its tasks."""
    return WordEncoder(path, added=True)


KEPT.append(encoder_of)


def pieces(docs: DataFrame, id_col: str, text_col: str, path: str, capacity: int) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of each row; only texts beyond the capacity are cut."""
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches):
        encoder = encoder_of(path)
        for batch in batches:
            for lo, hi, data, offs in text_slices(batch):
                ids, first = encoder.encode(data, offs)
                lens = np.diff(first)
                count = -(-lens // capacity)
                doc = np.repeat(np.arange(hi - lo), count)
                piece = multi_arange(np.zeros(len(count), np.int64), count)
                start = piece * capacity
                length = np.minimum(capacity, lens[doc] - start)
                raw = memoryview(ids.astype("<u4").tobytes())
                begin = (first[doc] + start).tolist()
                crc = [zlib.crc32(raw[4 * b : 4 * (b + n)]) for b, n in zip(begin, length.tolist())]
                cols = [batch.column(0).slice(lo, hi - lo).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, ["id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lean(cut, keep=(encoder_of,)), f"id {kind}, piece int, start long, length long, ids_crc32 long")


#: Kinds of rows of a round: runs of pieces, of gaps, of gaps that open in the next round, and matches.
PIECES, GAPS, LATER, MATCH = range(4)
RUNS = "kind int, size long, at long, n long, sequence long, gap long, each long"


def sweep(batches):
    """Matches the runs of one range of sizes, given by size, pieces before gaps: every gap takes the
    longest pieces it fits that no smaller gap took, as many of one length as it holds.

    Pieces wait on a stack as opening brackets do, gaps close them, so that the runs that are left in
    two neighbouring ranges match one another as if both had been swept at once. Rows of matches:
    ``n`` pieces of length ``size`` from rank ``at``, ``each`` to a sequence, from ``sequence`` on,
    of a gap ``gap``. Other rows: ``n`` pieces from rank ``at``, or ``n`` sequences from number ``at``.
    """
    stack: list[list[int]] = []
    out = []
    for batch in batches:
        for kind, size, at, n, *rest in zip(*(c.to_pylist() for c in batch.columns)):
            if kind == PIECES:
                stack.append([size, at, n])
            elif kind == GAPS:
                while n and stack:
                    length, rank, left = stack[-1]
                    each = size // length
                    used = min(n, -(-left // each))
                    take = min(left, used * each)
                    out.append((MATCH, length, rank, take, at, size, each))
                    full, more = divmod(take, each)
                    out += [(LATER, size - k * length, first, m, 0, 0, 0) for k, first, m in ((each, at, full), (more, at + full, 1)) if k and m and size > k * length]
                    at, n = at + used, n - used
                    stack[-1][1:] = rank + take, left - take
                    if left == take:
                        stack.pop()
                if n:
                    out.append((kind, size, at, n, 0, 0, 0))
            else:
                out.append((kind, size, at, n, *rest))
    out += [(PIECES, *run, 0, 0, 0) for run in stack]
    cols = list(zip(*out)) or [[]] * 7
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k == 0 else pa.int64()) for k, c in enumerate(cols)], [c.split()[0] for c in RUNS.split(", ")])


def matched_round(runs: DataFrame) -> DataFrame:
    """One round: ranges of sizes are swept side by side, then the runs that they leave, which are
    few, across the ranges. Of those that want one gap the longer rank first."""
    swept = runs.repartitionByRange("size", "kind").sortWithinPartitions("size", "kind", "at").mapInArrow(lean(sweep), RUNS)
    return stored(swept.repartition(1).sortWithinPartitions("size", "kind", "at").mapInArrow(lean(sweep), RUNS))


def matches(lengths: DataFrame, capacity: int) -> DataFrame:
    """The MATCH rows that place all pieces of ``lengths`` (size, n).

    Every piece of more than half the capacity opens a sequence. Rounds fill the gaps until none
    fits a piece that is left; then as many sequences open as the rest must have at least."""
    spark = lengths.sparkSession
    zero = F.lit(0).cast("long")
    state = lengths.select(F.lit(PIECES).alias("kind"), "size", zero.alias("at"), "n", zero.alias("sequence"), zero.alias("gap"), zero.alias("each"))
    piece, found = F.col("kind") == PIECES, F.col("kind") == MATCH
    figures = [F.sum(F.when(piece, F.col("size") * F.col("n"))).alias("tokens"), F.sum(F.when(piece & (F.col("size") * 2 > capacity), F.col("n"))).alias("long"),
               F.min(F.when(piece, F.col("size"))).alias("shortest"), F.count(F.when(found, 1)).alias("found"), F.max(F.when(~piece & ~found, F.col("size"))).alias("widest")]
    left, rounds, n_sequences = state.agg(*figures).first(), [], 0
    while left.tokens:
        if not left.found or (left.widest or 0) < left.shortest:
            fresh = left.long or -(-left.tokens // capacity)
            state = state.unionByName(spark.createDataFrame([(GAPS, capacity, n_sequences, fresh, 0, 0, 0)], RUNS))
            n_sequences += fresh
        swept = matched_round(state)
        left = swept.agg(*figures).first()
        rounds.append(swept.where(found))
        # gaps that fit no piece are closed
        state = swept.where(piece | (~found & (F.col("size") >= (left.shortest or capacity)))).withColumn("kind", F.when(piece, PIECES).otherwise(GAPS))
    return functools.reduce(DataFrame.unionByName, rounds) if rounds else spark.createDataFrame([], RUNS)


def best_fit_packing(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Texts are encoded as the tokenizer does by default, without special tokens around them; added
    tokens within them are one id each. Null and empty texts are the end id alone, one piece of
    length 1. Repeated rows and rows
    without an id are packed each; an empty table gives no row. Other columns are not read. Ties in length go by id, then piece.
    The driver holds one count for each (sorted partition, length) and the matches of runs, which
    go to all tasks; pieces stay in Spark.
    """
    spark = docs.sparkSession
    small_batches(spark)
    cut = stored(pieces(docs, id_col, text_col, path or tokenizer_path(), capacity))

    def ranked(batches):
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            length = batch.column(3).to_numpy()
            order = np.argsort(length, kind="stable")
            sizes = length[order]
            first = np.flatnonzero(np.concatenate([[True], sizes[1:] != sizes[:-1]])) if len(sizes) else np.zeros(0, int)
            n = np.diff(np.append(first, len(sizes)))
            rank = np.empty(len(length), np.int64)
            rank[order] = seen[sizes] + multi_arange(np.zeros(len(n), np.int64), n)
            np.add.at(seen, length, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(length), part, np.int32)), pa.array(rank)], [*batch.schema.names, "part", "rank"])

    kind = docs.schema[id_col].dataType.simpleString()
    base = f"id {kind}, piece int, start long, length long, ids_crc32 long"
    ordered = stored(cut.repartitionByRange(F.col("length").desc(), "id", "piece").sortWithinPartitions(F.col("length").desc(), "id", "piece").mapInArrow(lean(ranked), f"{base}, part int, rank long"))
    # sorted by length, so partitions share at most one length with the next: capacity + partitions rows
    found = ordered.groupBy("length", "part").agg(F.count("*").alias("n")).toArrow().to_pandas().sort_values(["length", "part"])
    before = {(int(a), int(b)): int(c) for a, b, c in zip(found["length"], found["part"], found.groupby("length")["n"].cumsum() - found["n"])}
    lengths = ordered.groupBy(F.col("length").alias("size")).agg(F.count("*").alias("n"))
    rows = matches(lengths, capacity).select("size", "at", "sequence", "gap", "each").toArrow()
    rows = np.stack([c.to_numpy() for c in rows.columns], axis=1)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    edge = np.searchsorted(rows[:, 0], np.arange(capacity + 2))
    shared = spark.sparkContext.broadcast((rows, edge, before))

    def placed(batches):
        rows, edge, before = shared.value
        for batch in batches:
            length, part, rank = (batch.column(k).to_numpy() for k in (3, 5, 6))
            key = length.astype(np.int64) * (1 << 32) + part
            for k in np.unique(key).tolist():
                rank = np.where(key == k, rank + before[k >> 32, k & 0xFFFFFFFF], rank)
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for size in np.unique(length).tolist():
                mine = length == size
                run = rows[edge[size] : edge[size + 1]]
                at = np.searchsorted(run[:, 1], rank[mine], "right") - 1
                nth, within = np.divmod(rank[mine] - run[at, 1], run[at, 4])
                sequence[mine] = run[at, 2] + nth
                offset[mine] = capacity - run[at, 3] + within * size
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:5], "sequence_id", "offset"])

    return ordered.mapInArrow(lean(placed), f"{base}, sequence_id long, offset long").withColumnRenamed("id", id_col)
