"""Matching sequences to a catalogue: exact, then with wildcards, then by local alignment."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.seq import wildcard_identity

#: Gap opening and extension, the characters that :func:`alignment_match` aligns unless told otherwise.
GAP_OPEN, GAP_EXTEND, ALIGNED = -11, -1, 400


#: Pairs that are aligned at once, of like lengths, and cells of a row of all of them.
BLOCK, BLOCK_CELLS = 512, 1 << 18


class Substitution:
    """Scores of pairs of characters. ``scores`` holds a pair in either order or both; a pair it lacks
    scores ``other`` (below 0), and one with a character of ``neutral`` and one of the table 0."""

    def __init__(self, scores: dict[tuple[str, str], int], other: int = -4, neutral: str = "X"):
        if other >= 0:
            raise ValueError("other must be below 0")
        letters = sorted({c for pair in scores for c in pair} | set(neutral))
        self.codes = np.array([ord(c) for c in letters])
        self.table = np.full((len(letters) + 1,) * 2, other, np.int64)
        place = {c: k for k, c in enumerate(letters)}
        for (a, b), score in scores.items():
            self.table[place[a], place[b]] = score
            if (b, a) not in scores:
                self.table[place[b], place[a]] = score
        for c in neutral:
            self.table[place[c], :-1] = self.table[:-1, place[c]] = 0

    @classmethod
    def parse(cls, text: str, other: int = -4, neutral: str = "X") -> Substitution:
        """Of a matrix file: # comments, a line of column characters, then a character and its scores a line."""
        head, *rows = [line.split() for line in text.splitlines() if line.strip() and not line.startswith("#")]
        return cls({(row[0], c): int(v) for row in rows for c, v in zip(head, row[1:])}, other, neutral)

    def places(self, codes: np.ndarray) -> np.ndarray:
        """Where the characters stand in the table; its last place is for those it lacks."""
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, at, len(self.codes))


def _codes(texts: list[str], pad: int) -> np.ndarray:
    """A row of character codes for each text, filled up with ``pad``."""
    width = max(map(len, texts))
    codes = np.array(texts, dtype=f"<U{width}").view(np.uint32).reshape(len(texts), width).astype(np.int64)
    codes[np.arange(width) >= np.array([len(x) for x in texts])[:, None]] = pad
    return codes


def _align_block(a: list[str], b: list[str], match: int, mismatch: int, table: Substitution | None) -> list[tuple[int, float, int]]:
    """Rows of all pairs are computed whole: a gap along the row is a running maximum, since it never
    pays to open one out of another. Filled up places match nothing, so no best place lies there."""
    xs, ys = _codes(a, -1), _codes(b, -2)
    if table:
        x_at, y_at = table.places(xs), table.places(ys)
    n, width = len(a), ys.shape[1] + 1
    at, pairs = np.arange(width), np.arange(n)
    score, same, size = (np.zeros((n, width), np.int64) for _ in range(3))
    down, down_same, down_size = np.full((n, width), -(1 << 40)), same.copy(), size.copy()
    best, best_same, best_size = (np.zeros(n, np.int64) for _ in range(3))
    edge = np.zeros((n, 1), np.int64)
    for i, x in enumerate(xs.T):
        opened = score + GAP_OPEN >= down + GAP_EXTEND
        down = np.where(opened, score + GAP_OPEN, down + GAP_EXTEND)
        down_same, down_size = np.where(opened, same, down_same), np.where(opened, size, down_size) + 1
        eq = ys == x[:, None]
        pair = table.table[x_at[:, i, None], y_at] if table else np.where(eq, match, mismatch)
        diagonal = np.hstack([edge, score[:, :-1] + pair])
        d_same, d_size = np.hstack([edge, same[:, :-1] + eq]), np.hstack([edge, size[:, :-1] + 1])
        stop = np.maximum(diagonal, down) <= 0
        by_down = down > diagonal
        score = np.where(stop, 0, np.maximum(diagonal, down))
        same, size = (np.where(stop, 0, np.where(by_down, p, q)) for p, q in ((down_same, d_same), (down_size, d_size)))
        level = score - GAP_EXTEND * at
        top = np.maximum.accumulate(level, axis=1)
        source = np.hstack([edge, np.maximum.accumulate(np.where(level == top, at, 0), axis=1)[:, :-1]])
        along = np.hstack([edge, top[:, :-1] + GAP_OPEN + GAP_EXTEND * at[:-1]])
        longer = along > score
        score = np.where(longer, along, score)
        same = np.where(longer, np.take_along_axis(same, source, 1), same)
        size = np.where(longer, np.take_along_axis(size, source, 1) + at - source, size)
        k = score.argmax(axis=1)
        higher = score[pairs, k] > best
        best = np.where(higher, score[pairs, k], best)
        best_same, best_size = np.where(higher, same[pairs, k], best_same), np.where(higher, size[pairs, k], best_size)
    identity = np.divide(best_same, best_size, out=np.zeros(n), where=best_size > 0)
    return list(zip(best.tolist(), identity.tolist(), best_size.tolist()))


def local_aligns(a: list[str], b: list[str], match: int = 5, mismatch: int = -4, table: Substitution | None = None) -> list[tuple[int, float, int]]:
    """(score, identity, length) of the best local alignment of each pair, with affine gaps;
    (0, 0.0, 0) where either is empty. Characters score by ``table``, without one by match and mismatch."""
    out = [(0, 0.0, 0)] * len(a)
    order = sorted((i for i in range(len(a)) if a[i] and b[i]), key=lambda i: (len(b[i]), len(a[i])))
    lo = 0
    while lo < len(order):
        block = order[lo : lo + BLOCK]
        block = block[: max(1, BLOCK_CELLS // max(max(len(a[i]), len(b[i])) for i in block))]
        lo += len(block)
        for i, found in zip(block, _align_block([a[i] for i in block], [b[i] for i in block], match, mismatch, table)):
            out[i] = found
    return out


def local_align(a: str, b: str, match: int = 5, mismatch: int = -4, table: Substitution | None = None) -> tuple[int, float, int]:
    return local_aligns([a], [b], match, mismatch, table)[0]


def common_order(a: str, b: str) -> int:
    """Characters of the longest common subsequence: no alignment pairs more equal ones. A bit of a
    whole number stands for each character of ``a``, so a character of ``b`` is a few operations."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    free = full
    for c in b:
        hit = free & places.get(c, 0)
        free = ((free + hit) | (free - hit)) & full
    return len(a) - free.bit_count()


def common_letters(a: Column, b: Column) -> Column:
    """Characters that two strings share in any order: no alignment pairs more equal ones."""
    count = lambda s, c: F.length(s) - F.length(F.replace(s, c, F.lit("")))
    return F.aggregate(F.array_distinct(F.split(a, "")), F.lit(0), lambda n, c: n + F.least(count(a, c), count(b, c)))


#: Pairs whose bounds are computed at once, and bytes of their tables.
BOUND_PAIRS, BOUND_BYTES = 2048, 16 << 20


def _bounds_block(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(characters shared in any order, longest common subsequence) of pairs of strings that are not
    empty: :func:`common_order` of all pairs at once, on words of 64 bits with a carry between them."""
    xs, ys = _codes(a, -1), _codes(b, -1)
    n = len(a)
    place = np.zeros(max(int(xs.max()), int(ys.max())) + 2, np.int64)
    place[xs[xs >= 0]] = place[ys[ys >= 0]] = 1
    k = int(place.sum()) + 1
    place = np.where(place > 0, np.cumsum(place) - 1, k - 1)  # the last is the filling, at place -1 as well
    xs, ys, at = place[xs], place[ys], np.arange(n)
    count = lambda codes: np.bincount((at[:, None] * k + codes).ravel(), minlength=n * k).reshape(n, k)[:, :-1]
    letters = np.minimum(count(xs), count(ys)).sum(1)
    words = -(-xs.shape[1] // 64)
    hits = np.zeros((words, n, k), np.uint64)
    for i, c in enumerate(xs.T):
        hits[i >> 6, at, c] |= np.uint64(1) << np.uint64(i & 63)
    hits[:, :, -1] = 0
    free = np.full((words, n), ~np.uint64(0))
    for c in ys.T:
        carry = np.zeros(n, np.uint64)
        for w in range(words):
            old = free[w]
            hit = old & hits[w, at, c]
            once = old + hit
            more = once + carry
            carry = ((once < old) | (more < once)).astype(np.uint64)
            free[w] = more | (old ^ hit)
    size = np.array([len(t) for t in a])
    order = np.zeros(n, np.int64)
    for w in range(words):
        bits = np.clip(size - 64 * w, 0, 64).astype(np.uint64)
        mask = np.where(bits == 64, ~np.uint64(0), (np.uint64(1) << (bits & np.uint64(63))) - np.uint64(1))
        order += np.bitwise_count(~free[w] & mask)
    return letters, order


def shared_bounds(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(:func:`common_letters`, :func:`common_order`) of each pair of strings, of like lengths at once."""
    letters, order = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    by_size = sorted((i for i in range(len(a)) if a[i] and b[i]), key=lambda i: (len(a[i]), len(b[i])))
    lo = 0
    while lo < len(by_size):
        hi = min(lo + BOUND_PAIRS, len(by_size))
        longest = max(len(a[i]) + len(b[i]) for i in by_size[lo:hi])
        # a character of a pair has a place in every word of the other's table
        hi = max(lo + 1, min(hi, lo + BOUND_BYTES // (16 * longest + 8 * min(longest, 64) * (longest // 64 + 1))))
        at = by_size[lo:hi]
        letters[at], order[at] = _bounds_block([a[i] for i in at], [b[i] for i in at])
        lo = hi
    return letters, order


def _reach(a: list[str], b: list[str], least: float, aligned: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Whether each bound leaves a pair: letters, and letters and order. Of whole sequences if ``aligned`` is None."""
    need = least * np.array([min(len(p), len(q)) for p, q in zip(a, b)]) - 1e-9
    letters, order = shared_bounds([p[:aligned] for p in a], [q[:aligned] for q in b])
    return letters >= need, (letters >= need) & (order >= need)


def _aligner(keep: list[str], a: str, b: str, aligned: int | None, table: Substitution | None, least: float | None):
    """Batches of ``keep`` with a and b to those that may reach ``least``, with score, identity and length."""

    def align(batches):
        for batch in batches:
            p, q = batch.column(a).to_pylist(), batch.column(b).to_pylist()
            if least is not None:
                at = np.flatnonzero(_reach(p, q, least, aligned)[1])
                batch, p, q = batch.take(pa.array(at)), [p[i] for i in at], [q[i] for i in at]
            found = local_aligns([t[:aligned] for t in p], [t[:aligned] for t in q], table=table)
            cols = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.int64(), pa.float64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *cols], [*keep, "score", "identity", "length"])

    return align


def align_pairs(pairs: DataFrame, a: str = "x", b: str = "y", aligned: int | None = None, table: Substitution | None = None, least: float | None = None) -> DataFrame:
    """(a, b, score, identity, length) of distinct pairs of whole sequences, or of their first ``aligned`` characters.

    With ``least``, only of pairs whose identity times length may be that share of the shorter sequence:
    both bounds (:func:`shared_bounds`) are of what is aligned, and lose no such pair."""
    return pairs.select(a, b).distinct().mapInArrow(_aligner([a, b], a, b, aligned, table, least), f"{a} string, {b} string, score long, identity double, length long")


def aligned_share(pairs: DataFrame, least: float = 0.8, aligned: int | None = None) -> DataFrame:
    """(pairs, by_letters, by_order) in one row: distinct pairs (x, y), and those that each bound of
    :func:`align_pairs` leaves, of whole sequences unless ``aligned`` is given; only the last are aligned."""

    def bounds(batches):
        for batch in batches:
            found = _reach(batch.column(0).to_pylist(), batch.column(1).to_pylist(), least, aligned)
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)]), *(pa.array([int(f.sum())]) for f in found)], ["pairs", "by_letters", "by_order"])

    # the pairs of an entry are distinct, so nothing is gained by making them so before they are dealt
    distinct = pairs.select("x", "y").repartition(_tasks(pairs), "x", "y").distinct()
    rows = distinct.mapInArrow(bounds, "pairs long, by_letters long, by_order long")
    return rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("pairs", "by_letters", "by_order")])


def _tasks(df: DataFrame) -> int:
    """The session's number of partitions, which adaptive execution keeps where it is asked for:
    sequences are few bytes and much work, and would be gathered in a few tasks."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _sequences(chains: DataFrame, entities: DataFrame, entry: str, seq: str, entity: str) -> tuple[DataFrame, DataFrame]:
    """Distinct (entry, x) and (entry, y, entity): of equal sequences of one entry the last entity."""
    e = entities.where(F.col(seq) != "").groupBy(entry, F.col(seq).alias("y")).agg(F.max(entity).alias(entity))
    return chains.where(F.col(seq) != "").select(entry, F.col(seq).alias("x")).distinct(), e


def wildcard_match(x: DataFrame, e: DataFrame, entry: str, entity: str, least: float = 0.9) -> DataFrame:
    """(entry, x, entity, value): the entity of equal length and highest identity of ``least`` or more
    over positions without X; of ties the smallest. Joined on entry and length."""
    pairs = x.withColumn("n", F.length("x")).join(e.withColumn("n", F.length("y")), [entry, "n"])
    scored = pairs.withColumn("s", wildcard_identity(F.col("x"), F.col("y"))).where(F.col("s") >= least)
    best = scored.groupBy(entry, "x").agg(F.min(F.struct((-F.col("s")).alias("s"), entity)).alias("b"))
    return best.select(entry, "x", f"b.{entity}", (-F.col("b.s")).alias("value"))


def pairs_in_reach(x: DataFrame, e: DataFrame, entry: str) -> DataFrame:
    """Pairs (x, y) of an entry with lengths within the larger of 60 and half of the sequence's own.
    Joined on entry and the doublings of length within reach, four at most."""
    reach = F.greatest(F.lit(60), F.length("x") * 0.5)
    band = lambda n: F.floor(F.log2(F.greatest(n, F.lit(32)))).cast("int")
    bands = x.withColumn("band", F.explode(F.sequence(band(F.length("x") - reach), band(F.length("x") + reach))))
    n = _tasks(x)
    bands, known = bands.repartition(n, entry, "band"), e.withColumn("band", band(F.length("y"))).repartition(n, entry, "band")
    return bands.join(known, [entry, "band"]).where(F.abs(F.length("x") - F.length("y")) <= reach)


def alignment_match(x: DataFrame, e: DataFrame, entry: str, entity: str, least: float = 0.8, aligned: int | None = ALIGNED, table: Substitution | None = None) -> DataFrame:
    """(entry, x, entity, value): the entity of the highest identity times coverage of ``least`` or
    more, of :func:`pairs_in_reach`; of ties the smallest. With ``aligned`` None sequences are aligned whole,
    else their first ``aligned`` characters. Only pairs that may reach ``least`` are aligned, where they are
    made: neither pairs nor what is found of them are shuffled, but for the best by task."""
    pairs = pairs_in_reach(x, e, entry).select(entry, entity, "x", "y")
    value = F.col("identity") * F.col("length") / F.least(F.length("x"), F.length("y"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema) + ", score long, identity double, length long"
    scored = pairs.mapInArrow(_aligner(pairs.columns, "x", "y", aligned, table, least), schema).withColumn("s", value).where(F.col("s") >= least)
    best = scored.groupBy(entry, "x").agg(F.min(F.struct((-F.col("s")).alias("s"), entity)).alias("b"))
    return best.select(entry, "x", f"b.{entity}", (-F.col("b.s")).alias("value"))


def match_cascade(chains: DataFrame, entities: DataFrame, entry: str, seq: str, entity: str, aligned: int | None = None, table: Substitution | None = None) -> DataFrame:
    """Chains with their entity, value and evidence: exact, wildcard, alignment or unmatched.

    Sequences are aligned whole unless ``aligned`` is given. Each stage sees only the distinct sequences
    that no earlier one matched. Null or empty sequences are unmatched."""
    x, e = _sequences(chains, entities, entry, seq, entity)
    exact = x.join(e.withColumnRenamed("y", "x"), [entry, "x"]).select(entry, "x", entity, F.lit(1.0).alias("value"))
    rest = x.join(exact, [entry, "x"], "left_anti")
    wild = wildcard_match(rest, e, entry, entity)
    rest = rest.join(wild, [entry, "x"], "left_anti")
    found = exact.withColumn("evidence", F.lit("exact")).unionByName(wild.withColumn("evidence", F.lit("wildcard")))
    found = found.unionByName(alignment_match(rest, e, entry, entity, aligned=aligned, table=table).withColumn("evidence", F.lit("alignment")))
    out = chains.join(found.withColumnRenamed("x", seq), [entry, seq], "left")
    return out.withColumn("evidence", F.coalesce("evidence", F.lit("unmatched")))


def positional_align(df: DataFrame, key: str, a: str, b: str, keep: int = 4) -> DataFrame:
    """(key, kind, bad): whether two lists of a row agree by position: ok, count or name; bad holds
    the first ``keep`` positions (from 0) whose names differ."""
    pairs = F.arrays_zip(F.sequence(F.lit(0), F.greatest(F.size(a), F.size(b), F.lit(1)) - 1).alias("i"), F.col(a).alias("a"), F.col(b).alias("b"))
    bad = F.transform(F.filter(pairs, lambda p: ~p["a"].eqNullSafe(p["b"])), lambda p: p["i"])
    kind = F.when(F.size(a) != F.size(b), "count").when(F.size("bad") > 0, "name").otherwise("ok")
    return df.select(key, a, b, bad.alias("bad")).select(key, kind.alias("kind"), F.slice("bad", 1, keep).alias("bad"))


def global_align(a: str, b: str, match: int = 2, mismatch: int = -1, gap: int = -3) -> list[tuple[int, int]]:
    """Pairs (place in a, place in b) of the best global alignment, on ties pairing before a gap in
    b, and that before a gap in a. Rows are computed whole, gaps along them as a running maximum.

    Only every ``step``-th row of scores is kept. From the last stretch of rows to the first, a stretch
    is computed again from the row before it, up to where the path enters it, with two bits a cell:
    memory is some 5 bytes times len(b) times the root of len(a)."""
    x, y = (np.array([ord(c) for c in s], np.int32) for s in (a, b))
    slope = np.int32(gap) * np.arange(len(y) + 1, dtype=np.int32)

    def below(row, i):
        width = len(row)
        paired = row[:-1] + np.where(y[: width - 1] == x[i], np.int32(match), np.int32(mismatch))
        best = np.empty(width, np.int32)
        best[0] = (i + 1) * gap
        np.maximum(paired, row[1:] + np.int32(gap), out=best[1:])
        return np.maximum.accumulate(best - slope[:width]) + slope[:width], paired

    step = math.isqrt(len(x)) + 1
    row, marks = slope, []
    for i in range(len(x)):
        if i % step == 0:
            marks.append(row)
        row = below(row, i)[0]
    i, j, pairs = len(x), len(y), []
    while i and j:
        low = (i - 1) // step * step
        row, ways = marks[low // step][: j + 1], []
        for k in range(low, i):
            new, paired = below(row, k)
            ways.append((np.packbits(new[1:] == paired), np.packbits(new[1:] == row[1:] + np.int32(gap))))
            row = new
        while i > low and j:
            at, bit = (j - 1) >> 3, 128 >> (j - 1 & 7)
            if ways[i - low - 1][0][at] & bit:
                i, j = i - 1, j - 1
                pairs.append((i, j))
            elif ways[i - low - 1][1][at] & bit:
                i -= 1
            else:
                j -= 1
    return pairs[::-1]


#: Cells of the tables of scores that :func:`global_aligns` holds at once.
CELLS = 1 << 21


def _global_block(a: str, texts: list[str], match: int, mismatch: int, gap: int) -> np.ndarray:
    """Where each place of ``a`` stands in each text, or -1: :func:`global_align` of all texts at once.
    Rows of all texts are computed whole with two bits a cell; filled up places lie behind every path."""
    x, y = np.array([ord(c) for c in a], np.int64), _codes(texts, -1)
    n, width = y.shape
    slope = np.int32(gap) * np.arange(width + 1, dtype=np.int32)
    row, ways = np.broadcast_to(slope, (n, width + 1)), np.empty((len(x), n, width), np.uint8)
    for i, c in enumerate(x):
        paired = row[:, :-1] + np.where(y == c, np.int32(match), np.int32(mismatch))
        down = row[:, 1:] + np.int32(gap)
        new = np.empty((n, width + 1), np.int32)
        new[:, 0] = (i + 1) * gap
        np.maximum(paired, down, out=new[:, 1:])
        row = np.maximum.accumulate(new - slope, axis=1) + slope
        ways[i] = (row[:, 1:] == paired) + 2 * (row[:, 1:] == down).astype(np.uint8)
    out = np.full((n, len(x)), -1, np.int64)
    at, i, j = np.arange(n), np.full(n, len(x)), np.array([len(t) for t in texts])
    while len(at := at[(i[at] > 0) & (j[at] > 0)]):
        way = ways[i[at] - 1, at, j[at] - 1]
        pair, down = (way & 1) == 1, way == 2
        out[at[pair], i[at[pair]] - 1] = j[at[pair]] - 1
        i[at] -= pair | down
        j[at] -= ~down
    return out


def global_aligns(a: str, texts: list[str], match: int = 2, mismatch: int = -1, gap: int = -3) -> list[np.ndarray]:
    """Of each text the place of each character of ``a`` in it by :func:`global_align`, or -1. Texts of
    like lengths are aligned at once, CELLS cells a block; a longer one alone, in little memory."""
    out = [np.full(len(a), -1, np.int64)] * len(texts)
    order, block = sorted((k for k, t in enumerate(texts) if t and a), key=lambda k: len(texts[k])), []

    def done():
        for k, found in zip(block, _global_block(a, [texts[k] for k in block], match, mismatch, gap) if block else ()):
            out[k] = found
        block.clear()

    for k in order:
        cells = len(a) * len(texts[k])
        if cells > CELLS:
            out[k] = np.full(len(a), -1, np.int64)
            for i, j in global_align(a, texts[k], match, mismatch, gap):
                out[k][i] = j
            continue
        if (len(block) + 1) * cells > CELLS:
            done()
        block.append(k)
    done()
    return out


def reference_mapping(df: DataFrame, seq: str, reference: str, positions: list[int]) -> DataFrame:
    """(seq, position, mapped, n_mapped, identity): where the positions of the reference stand in
    each distinct sequence (null: nowhere), how many do, and the share of the reference's characters
    that are paired with an equal one. Null and empty sequences give no row."""

    letters = np.array([ord(c) for c in reference], np.int64)
    asked = np.array(positions, np.int64)
    inside = (asked >= 0) & (asked < len(reference))

    def align(batches):
        for batch in batches:
            texts, m = batch.column(0).to_pylist(), len(positions)
            found = np.array(global_aligns(reference, texts), np.int64).reshape(len(texts), len(reference))
            codes = [np.array([ord(c) for c in s], np.int64) for s in texts]
            same = [int((letters[f >= 0] == c[f[f >= 0]]).sum()) / max(1, len(reference)) for f, c in zip(found, codes)]
            mapped = np.full((len(texts), m), -1, np.int64)
            mapped[:, inside] = found[:, asked[inside]]
            n = (mapped >= 0).sum(1)
            cols = [
                batch.column(0).take(pa.array(np.repeat(np.arange(len(texts)), m))), pa.array(np.tile(asked, len(texts)), pa.int32()),
                pa.array(mapped.ravel(), pa.int32(), mask=mapped.ravel() < 0), pa.array(np.repeat(n, m), pa.int32()), pa.array(np.repeat(same, m), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(cols, [seq, "position", "mapped", "n_mapped", "identity"])

    distinct = df.where(F.col(seq) != "").select(seq).distinct().repartition(_tasks(df), seq)
    return distinct.mapInArrow(align, f"{seq} string, position int, mapped int, n_mapped int, identity double")


def pair_identity_sample(df: DataFrame, id_col: str, seq: str, k_pairs: int, seed: int) -> DataFrame:
    """(pairs, median, p10, p90) of the aligned identities of ``k_pairs`` pairs of sequences, drawn
    by a hash of their ids and the seed: the sample is the feature, its size a parameter."""
    drawn = df.where(F.col(seq) != "").select(F.col(seq).alias("s"), F.xxhash64(id_col, F.lit(seed)).alias("h"), F.col(id_col).alias("i")).orderBy("h", "i").limit(2 * k_pairs)
    ranked = drawn.withColumn("k", F.row_number().over(Window.orderBy("h", "i")) - 1)  # of a bounded sample
    pairs = ranked.groupBy(F.floor(F.col("k") / 2).alias("pair")).agg(F.min_by("s", "k").alias("x"), F.max_by("s", "k").alias("y"), F.count("*").alias("n")).where("n = 2")
    found = pairs.join(align_pairs(pairs), ["x", "y"])
    return found.agg(F.count("*").alias("pairs"), *[F.percentile("identity", F.lit(q)).alias(name) for q, name in ((0.5, "median"), (0.1, "p10"), (0.9, "p90"))])
