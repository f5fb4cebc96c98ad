"""Near-duplicate line removal by an exact set-similarity join.

Lines are sets of words. Words are ordered by rarity; two lines of Jaccard similarity t or more
share a word among their first n - ceil(t n) + 1. Candidates of a shared prefix word pass the
length filter, a positional filter and a bound from 128-bit parity sketches (none drops a true
match), and are verified on their word sets. A line with an earlier match goes.

Texts are cut into word sets once; the sets are written to the shared folder, and postings and
verification read them there. A line needs one earlier match only: in each bucket of postings it
looks for the nearest candidates first and then looks no further, so a large group of near copies
costs about its size. Lines whose nearest candidates all fail are searched for to the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, NOT_SPACE, SLICE_BYTES, Words, bitset_of, discard, free_name, in_bitset, lean, mix, release, runs, small_batches, stored, text_slices
from .ngram_join import _often, frequent_order, prefix_length

PERCENT = 80
#: Candidates after which a line looks no further in a bucket; one that differs in no more than
#: NEAR of what a match may, as far as sketches tell, ends the search, too. Lines none of whose
#: candidates match are searched for anew.
KEPT, NEAR = 8, 0.75
NEWLINE = 10
#: Postings of a bucket, about: one task sorts those of a bucket at once.
BUCKET_POSTINGS = 3 << 17
#: Candidate pairs of a bucket that are held at once.
HELD_PAIRS = 2_000_000
#: Rows that are unpacked at once.
CUT_ROWS = 256

#: Words are told apart by this many bits of their hashes, so that a word and the number of its
#: line within a slice sort as one integer. Two different words of a pair of lines are taken for
#: one with a probability of about 1e-10.
TOKEN_BITS = 44
#: Words seen less often in a stretch of CHUNK words count as rare.
CHUNK, SEEN = 1 << 22, 3
#: Sets of fewer words match equal sets only.
LEAST_WORDS = 4
#: 64-bit words of a line's parity sketch: each of its words flips one bit. Two sketches differ in
#: no more places than their sets do.
SKETCH = 2


def order_of(major: np.ndarray, minor: np.ndarray) -> np.ndarray:
    """An order by ``major``, of equals by ``minor`` (32 bits): only equals are sorted a second time, and
    both sorts are of single integers, which numpy does several times faster than a lexsort."""
    order = np.argsort(major)
    edge = runs(major[order])
    size = np.diff(edge)
    tied = np.flatnonzero(np.repeat(size > 1, size))
    if len(tied):
        these = order[tied]
        run = np.repeat(np.arange(len(size), dtype=np.uint64), size)[tied]
        order[tied] = these[np.argsort(run << np.uint64(32) | minor[these].astype(np.uint64))]
    return order


def order_of_places(doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    """An order by document and line, packed in one integer where both fit."""
    if len(doc) and doc.min() >= 0 and doc.max() < 1 << 39 and line.max() < 1 << 24:
        return np.argsort(doc << 24 | line)
    return np.lexsort((line, doc))


class Sets:
    """Word sets: set k is tokens[edge[k]:edge[k+1]], sorted and distinct; ``number`` has k for each token."""

    def __init__(self, tokens: np.ndarray, edge: np.ndarray):
        self.tokens, self.edge, self.n = tokens, edge, np.diff(edge)
        self.number = np.repeat(np.arange(len(self.n)), self.n)

    def prefixes(self, p: np.ndarray, order: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the token, its set, its place) of the first p[k] tokens of each set k, rare
        ones first: those that ``order`` lacks by hash, then by their ranks there (from 1)."""
        if len(order[0]):
            at = np.minimum(np.searchsorted(order[0], self.tokens), len(order[0]) - 1)
            rank = np.where(order[0][at] == self.tokens, order[1][at], 0)
        else:
            rank = np.zeros(len(self.tokens), np.int64)
        rare = rank == 0
        upto = np.concatenate([[0], np.cumsum(rare)])
        place = upto[1:] - 1 - upto[self.edge[:-1]][self.number]
        first = np.flatnonzero(rare & (place < p[self.number]))
        n_rare = np.diff(upto[self.edge])
        short = np.flatnonzero(~rare & (n_rare < p)[self.number])
        ranked = short[np.argsort(self.number[short] << 32 | rank[short])]
        edge = runs(self.number[ranked])
        nth = np.arange(len(ranked)) - np.repeat(edge[:-1], np.diff(edge)) + n_rare[self.number[ranked]]
        more = nth < p[self.number[ranked]]
        index = np.concatenate([first, ranked[more]])
        return index, self.number[index], np.concatenate([place[first], nth[more]])

    def parity(self) -> np.ndarray:
        if not len(self.n):
            return np.zeros((0, SKETCH), np.uint64)
        bit = self.tokens >> np.uint64(TOKEN_BITS - 7)
        flips = np.uint64(1) << (bit & np.uint64(63))
        word = bit >> np.uint64(6)
        return np.stack([np.bitwise_xor.reduceat(np.where(word == np.uint64(k), flips, np.uint64(0)), self.edge[:-1]) for k in range(SKETCH)], 1)


class Lines(Sets):
    """The lines of a slice: line k is of row ``doc`` and its number there is ``line``. Lines without
    words are left out."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        w = Words(LOWER[data], offs, NOT_SPACE)
        self.words = w.hash >> np.uint64(64 - TOKEN_BITS)
        breaks = np.flatnonzero(data == NEWLINE)
        before = np.searchsorted(breaks, w.starts)  # line breaks before each word
        at_row = np.searchsorted(breaks, offs[:-1])
        begins = runs(before + w.doc)[:-1] if len(w.doc) else np.zeros(0, int)  # rises with each line and each row
        self.doc = w.doc[begins]
        self.line = (before[begins] - at_row[self.doc]).astype(np.int64) if len(begins) else np.zeros(0, np.int64)
        number = np.repeat(np.arange(len(begins), dtype=np.uint64), np.diff(np.append(begins, len(w.doc))))
        if len(begins) < 1 << (64 - TOKEN_BITS):
            packed = np.sort((number << np.uint64(TOKEN_BITS)) | self.words)
            new = np.ones(len(packed), bool)
            new[1:] = packed[1:] != packed[:-1]
            packed = packed[new]
            tokens, number = packed & np.uint64((1 << TOKEN_BITS) - 1), packed >> np.uint64(TOKEN_BITS)
        else:
            order = np.lexsort((self.words, number))
            tokens, number = self.words[order], number[order]
            new = np.ones(len(tokens), bool)
            new[1:] = (tokens[1:] != tokens[:-1]) | (number[1:] != number[:-1])
            tokens, number = tokens[new], number[new]
        super().__init__(tokens, runs(number))
        mixed = np.concatenate([[np.uint64(0)], np.cumsum(mix(self.tokens ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
        self.fp = mix(mixed[self.edge[1:]] - mixed[self.edge[:-1]] + self.n.astype(np.uint64)).view(np.int64) if len(self.n) else np.zeros(0, np.int64)

    def repeats(self, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first line of each distinct word set, later lines of equal sets), by ``doc`` and line; a
        first line that a repeated row gives again is neither."""
        rising = bool((doc[1:] >= doc[:-1]).all()) and not ((doc[1:] == doc[:-1]) & (self.line[1:] < self.line[:-1])).any()
        by_set = np.argsort(self.fp, kind="stable") if rising else np.lexsort((self.line, doc, self.fp))
        edge = runs(self.fp[by_set])
        first = by_set[edge[:-1]]
        head = np.repeat(first, np.diff(edge))
        later = (doc[head] != doc[by_set]) | (self.line[head] != self.line[by_set])
        return first, by_set[later]


def ranked(order: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(sorted tokens, their ranks by count from 1) of (sorted tokens, counts)."""
    rank = np.empty(len(order[0]), np.int64)
    rank[np.argsort(order[1], kind="stable")] = np.arange(1, len(rank) + 1)
    return order[0], rank


def packed_tokens(tokens: np.ndarray) -> np.ndarray:
    """TOKEN_BITS-bit tokens at 6 bytes each."""
    return np.ascontiguousarray(tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).ravel()


def unpacked_tokens(raw) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def binary_of(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary column whose rows are the next ``sizes`` bytes of ``flat``."""
    offs = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offs), pa.py_buffer(flat)])


def sets_of(col: pa.Array) -> Sets:
    """The sets of a column of :func:`packed_tokens`."""
    offs = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(col.buffers()[2], np.uint8)[offs[0] : offs[-1]] if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return Sets(unpacked_tokens(raw), (offs - offs[0]).astype(np.int64) // 6)


def set_slices(batch: pa.RecordBatch, name: str = "tokens"):
    """Parts of a batch of about SLICE_BYTES of ``name`` each; one longer row is a part of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy().astype(np.int64))
    lo = 0
    while lo < len(batch):
        base = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + SLICE_BYTES, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


#: kind of a profile row: a word seen often in some stretch of text (key) and its count (doc); how
#: many tokens a slice posts (doc); the first line of a word set (key: fingerprint) in its slice,
#: with its tokens; a later line of that slice with an equal set
FREQUENT, POSTED, FIRST, AGAIN = 0, 1, 2, 3


def _profile(rows: DataFrame, percent: int) -> DataFrame:
    """(kind, key, doc, line, tokens) of words, postings and lines: the one pass over the texts."""

    def part(kind, key, doc, line, tokens=None):
        n = np.broadcast(key, doc, line).size
        cols = [pa.array(np.full(n, kind, np.int32)), *(pa.array(np.broadcast_to(np.asarray(c, np.int64), n)) for c in (key, doc, line))]
        return pa.RecordBatch.from_arrays([*cols, pa.nulls(n, pa.binary()) if tokens is None else tokens], ["kind", "key", "doc", "line", "tokens"])

    def often(held):
        tokens, n = _often(held, SEEN)
        return part(FREQUENT, tokens.view(np.int64), n, 0)

    def read(batches):
        held, size = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for lo, hi, data, offs in text_slices(batch):
                x = Lines(data, offs)
                if not len(x.n):
                    continue
                doc = ids[lo:hi][x.doc].astype(np.int64)
                first, again = x.repeats(doc)
                first = np.sort(first)
                kept = np.where(x.n[first] >= LEAST_WORDS, x.n[first], 0)
                yield part(POSTED, 0, prefix_length(kept[kept > 0], percent).sum(), 0)
                mine = np.zeros(len(x.n), bool)
                mine[first[kept > 0]] = True
                yield part(FIRST, x.fp[first], doc[first], x.line[first], binary_of(packed_tokens(x.tokens[mine[x.number]]), 6 * kept))
                if len(again):
                    yield part(AGAIN, x.fp[again], doc[again], x.line[again])
                held.append(x.words)
                size += len(x.words)
                if size >= CHUNK:
                    yield often(held)
                    held, size = [], 0
        if held:
            yield often(held)

    return rows.mapInArrow(lean(read), "kind int, key long, doc long, line long, tokens binary")


def _equal(profile: DataFrame) -> DataFrame:
    """(doc, line) of the lines whose set an earlier line has. Slices have told their own repeats,
    so a set has as many rows here as slices hold it."""
    firsts = profile.where(F.col("kind") == FIRST).select("key", "doc", "line")
    least = firsts.groupBy("key").agg(F.min(F.struct("doc", "line")).alias("least"), F.count("*").alias("n")).where("n > 1")
    later = firsts.join(least, "key").where(F.struct("doc", "line") != F.col("least")).select("doc", "line")
    return later.union(profile.where(F.col("kind") == AGAIN).select("doc", "line"))


#: Columns of a bucket's postings, as packed arrays.
_POSTED = (("tok", "u4"), ("fp", "u4"), ("parity", f"{SKETCH}u8"), ("n", "u4"), ("pos", "u2"), ("doc", "i8"), ("line", "u4"))


def planes(a: np.ndarray) -> bytes:
    """The bytes of an array, all first bytes before all second ones: high bytes hardly vary, and
    are then compressed in the shuffle."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes()


def from_planes(parts: list[bytes], kind: str) -> np.ndarray:
    kind = np.dtype(kind)
    return np.concatenate([np.ascontiguousarray(np.frombuffer(p, np.uint8).reshape(kind.itemsize, -1).T).view(kind.base).reshape(-1, *kind.shape) for p in parts])


def _blobs(lines: DataFrame, shared, percent: int, n_buckets: int) -> DataFrame:
    """The prefix postings of stored ``lines`` by bucket. ``shared`` has the order of words and a bit
    set of the tokens to post, if not all are."""

    def emit(batches):
        order, asked = shared.value
        for whole in batches:
            for batch in set_slices(whole):
                x = sets_of(batch.column("tokens"))
                if asked is not None:  # sets without such a token need no prefixes
                    some = np.add.reduceat(in_bitset(asked, x.tokens.view(np.int64)), x.edge[:-1]) > 0
                    batch = batch.filter(pa.array(some))
                    if not len(batch):
                        continue
                    x = sets_of(batch.column("tokens"))
                index, of, pos = x.prefixes(prefix_length(x.n, percent), order)
                if asked is not None:
                    few = in_bitset(asked, x.tokens[index].view(np.int64))
                    index, of, pos = index[few], of[few], pos[few]
                if not len(index):
                    continue
                fp, doc, line = (batch.column(c).to_numpy() for c in ("key", "doc", "line"))
                tok = x.tokens[index]
                cols = ((tok >> np.uint64(TOKEN_BITS - 32)).astype(np.uint32), (fp.view(np.uint64) >> np.uint64(32)).astype(np.uint32)[of], x.parity()[of], x.n[of].astype(np.uint32), np.minimum(pos, 65535).astype(np.uint16), doc[of], line[of].astype(np.uint32))
                parts = list(zip(*_split((tok % np.uint64(n_buckets)).astype(np.int64), cols)))
                yield pa.RecordBatch.from_arrays([pa.array(parts[0], pa.int32()), *(pa.array(c, pa.binary()) for c in parts[1:])], ["bucket", *(c for c, _ in _POSTED)])

    return lines.mapInArrow(lean(emit), "bucket int, " + ", ".join(f"{c} binary" for c, _ in _POSTED))


def _split(bucket: np.ndarray, cols) -> list[tuple]:
    """(bucket, packed columns) of each bucket."""
    at = np.argsort(bucket, kind="stable")
    edge = runs(bucket[at]).tolist()
    cols = [c[at] for c in cols]
    return [(int(bucket[at[i]]), *(planes(c[i:j]) for c in cols)) for i, j in zip(edge[:-1], edge[1:])]


FOUND = "doc long, line long, with_doc long, with_line long, kind int, score int"
#: kind of a found row: a candidate; a candidate of a line that may have more than were found
CANDIDATE, MORE = 1, 2


def _candidates(blobs: DataFrame, percent: int, kept: int | None, wanted) -> DataFrame:
    """Candidate pairs of first lines; without ``kept``, all of the wanted ones, in several blocks."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = {c: [] for c, _ in _POSTED}
        for batch in batches:
            for c in raw:
                raw[c] += batch.column(c).to_pylist()
        tok, fp, parity, n, pos, doc, line = (from_planes(raw.pop(c), t) for c, t in _POSTED)
        for cols in _pairs(tok, fp, parity, n.astype(np.int64), pos.astype(np.int64), doc, line.astype(np.int64), percent, kept, wanted.value if wanted else None):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["doc", "line", "with_doc", "with_line", "kind", "score"])

    return blobs.groupBy("bucket").applyInArrow(match, FOUND)


def line_key(doc, line):
    """A long for the bit set of lines; equal keys of different lines only cost time."""
    return (doc & 0xFFFFFFFF) * 1021 + line


def most_apart(total, percent: int):
    """In how many tokens two sets of ``total`` tokens together may differ and still match."""
    return total - 2 * -(-total * percent // (100 + percent))


def _pairs(tok, fp, parity, n, pos, doc, line, percent, kept, wanted):
    """Blocks of columns of FOUND, a block for about HELD_PAIRS pairs."""
    parity = parity.reshape(len(tok), -1)
    bits = 64 * parity.shape[1]
    # ln(1 - 2 d / bits): what differs in more places than half the bits has no telling difference
    apart = np.append(-bits / 2 * np.log1p(-np.arange(bits // 2) * 2 / bits), np.inf)
    key = tok.astype(np.uint64) << np.uint64(32) | n.astype(np.uint64)
    order = order_of(key, fp)
    new = np.ones(len(order), bool)
    new[1:] = (key[order[1:]] != key[order[:-1]]) | (fp[order[1:]] != fp[order[:-1]])
    edge = np.append(np.flatnonzero(new), len(order))
    alike = np.flatnonzero(np.repeat(np.diff(edge) > 1, np.diff(edge)))
    if len(alike):  # of equal sets the first line stays
        these = order[alike]
        order[alike] = these[np.lexsort((line[these], doc[these], fp[these], key[these]))]
        head = order[np.repeat(edge[:-1], np.diff(edge))[alike]]
        again = (head != order[alike]) & (parity[head] == parity[order[alike]]).all(1)
        order = np.delete(order, alike[again])
    edge = runs(tok[order])
    order = order[np.repeat(np.diff(edge) >= 2, np.diff(edge))]
    tok, parity, n, pos, doc, line = (c[order] for c in (tok, parity, n, pos, doc, line))
    m = len(tok)
    if not m:
        return
    rank = np.empty(m, np.int64)
    by_place = order_of_places(doc, line)
    fresh = np.ones(m, bool)
    fresh[1:] = (doc[by_place][1:] != doc[by_place][:-1]) | (line[by_place][1:] != line[by_place][:-1])
    rank[by_place] = np.cumsum(fresh) - 1
    place = by_place[fresh]
    got, near, more = np.zeros(len(place), np.int64), np.zeros(len(place), bool), np.zeros(len(place), bool)
    later_all, earlier_all, score_all, held = [], [], [], 0

    def block():
        a, b, s = (np.concatenate(x) for x in (later_all, earlier_all, score_all))
        _, first = np.unique(a * len(place) + b, return_index=True)
        a, b, s = a[first], b[first], s[first]
        later_all[:], earlier_all[:], score_all[:] = [], [], []
        x, y = place[a], place[b]
        return doc[x], line[x], doc[y], line[y], np.where(more[a], MORE, CANDIDATE).astype(np.int32), s.astype(np.int32)

    def tested(i, j):
        """Takes the candidates among (i, j), postings of one token, i of the later line."""
        nonlocal held
        total, less, more_ = n[i] + n[j], np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
        most = most_apart(total, percent)
        # what comes before the shared word in either line, and from it on, bounds the overlap
        close = np.minimum(n[i] - pos[i], n[j] - pos[j]) + np.minimum(pos[i], pos[j]) >= (total - most) // 2
        close &= less * 100 >= more_ * percent
        i, j, most = i[close], j[close], most[close]
        differ = np.bitwise_count(parity[i] ^ parity[j]).sum(1, dtype=np.int64)
        ok = differ <= most
        i, j, differ, most = i[ok], j[ok], differ[ok], most[ok]
        if len(i):
            likely = apart[np.minimum(differ, bits // 2)]
            later_all.append(rank[i])
            earlier_all.append(rank[j])
            score_all.append(np.minimum(1000 * likely / (most + 1), 1e6))
            np.add.at(got, rank[i], 1)
            near[rank[i[likely <= NEAR * most]]] = True
            held += len(i)

    edge = runs(tok)
    of_run = np.repeat(np.arange(len(edge) - 1), np.diff(edge))
    lo, hi = edge[of_run], edge[of_run + 1]
    i = np.arange(m)
    if wanted is not None:
        i = i[in_bitset(wanted, line_key(doc, line))]
    if kept is not None:
        # all of a run are first compared with its earliest line: a pair of many tokens is then one pair
        earliest = (np.minimum.reduceat(rank * m + np.arange(m), edge[:-1]) % m)[of_run]
        u = i[rank[earliest[i]] < rank[i]]
        tested(u, earliest[u])
    shift = 0
    while len(i):
        if kept is not None:
            done = near[rank[i]] | (got[rank[i]] >= kept)
            more[rank[i[done]]] = True
            i = i[~done]
        shift += 1
        # sorted by length within a word: beyond the length bound nothing further fits
        down, up = i - shift, i + shift
        below = (down >= lo[i]) & (n[np.maximum(down, 0)] * 100 >= n[i] * percent)
        above = (up < hi[i]) & (n[i] * 100 >= n[np.minimum(up, m - 1)] * percent)
        for side, other in ((below, down), (above, up)):
            u, v = i[side], other[side]
            earlier = rank[v] < rank[u]
            tested(u[earlier], v[earlier])
            if held > HELD_PAIRS and kept is None:
                yield block()
                held = 0
        i = i[below | above]
    if later_all:
        yield block()


PAIR = ["doc", "line", "with_doc", "with_line"]


def _ends(pairs: DataFrame) -> np.ndarray:
    """A bit set of the lines of the pairs."""
    ends = pairs.select("doc", "line").union(pairs.select("with_doc", "with_line"))
    return bitset_of(ends.select(line_key_column("doc", "line").alias("key")), "key", 25)


def _sets_of_ends(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """(doc, line, tokens), stored, of the lines of the pairs (and few others)."""
    wanted = lines.sparkSession.sparkContext.broadcast(_ends(pairs))

    def few(batches):
        for batch in batches:
            key = line_key(batch.column("doc").to_numpy(), batch.column("line").to_numpy())
            yield batch.filter(pa.array(in_bitset(wanted.value, key)))

    return stored(lines.select("doc", "line", "tokens").mapInArrow(lean(few), "doc long, line long, tokens binary"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(doc, line) of the pairs' later lines that match their earlier one."""
    other = sets.select(F.col("doc").alias("with_doc"), F.col("line").alias("with_line"), F.col("tokens").alias("others"))
    both = sets.join(pairs.select(*PAIR).hint("shuffle_hash"), ["doc", "line"]).join(other.hint("shuffle_hash"), ["with_doc", "with_line"])

    def verify(batches):
        for whole in batches:
            for batch in set_slices(whole):
                x, y = sets_of(batch.column("tokens")), sets_of(batch.column("others"))
                packed = [(s.number.astype(np.uint64) << np.uint64(TOKEN_BITS)) | s.tokens for s in (x, y)]
                flat = np.sort(np.concatenate(packed))
                shared = np.bincount((flat[1:][flat[1:] == flat[:-1]] >> np.uint64(TOKEN_BITS)).astype(np.int64), minlength=len(batch))
                keep = 100 * shared >= percent * (x.n + y.n - shared)
                yield batch.select(["doc", "line"]).filter(pa.array(keep))

    return stored(both.select("doc", "line", "tokens", "others").mapInArrow(lean(verify), "doc long, line long").distinct())


def line_key_column(doc: str, line: str):
    return F.col(doc).bitwiseAND(F.lit(0xFFFFFFFF)) * 1021 + F.col(line)


def _tokens_of(lines: DataFrame, order, left, percent: int) -> np.ndarray:
    """A bit set of the prefix tokens of the lines in the bit set ``left``."""

    def read(batches):
        for whole in batches:
            for batch in set_slices(whole):
                batch = batch.filter(pa.array(in_bitset(left.value, line_key(batch.column("doc").to_numpy(), batch.column("line").to_numpy()))))
                if len(batch):
                    x = sets_of(batch.column("tokens"))
                    index, _, _ = x.prefixes(prefix_length(x.n, percent), order.value[0])
                    yield pa.RecordBatch.from_arrays([pa.array(np.unique(x.tokens[index]).view(np.int64))], ["token"])

    return bitset_of(lines.mapInArrow(lean(read), "token long"), "token")


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, n_buckets: int | None = None) -> DataFrame:
    """(id, line): the lines, numbered from 0, that match an earlier one of any row.

    Earlier means a smaller id, then a smaller line number. A line matches one whose word set
    (words at ASCII white space, A-Z lower-cased) has Jaccard similarity percent/100 or more with
    its own. Lines without words match nothing and stay. Of repeated rows with one id the lines
    count once: they share (id, line) and so their fate. Rows without an id are not read: their
    lines have no place in the order, and match nothing. Ids are integers; other columns are not
    read. An empty table gives no row.
    """
    spark = docs.sparkSession
    small_batches(spark)
    share = spark.sparkContext.broadcast
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    profile = stored(_profile(rows, percent))
    if n_buckets is None:
        n_posted = profile.where(F.col("kind") == POSTED).agg(F.sum("doc")).first()[0] or 0
        n_buckets = max(64, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_posted // BUCKET_POSTINGS))
    order = ranked(frequent_order(profile.where(F.col("kind") == FREQUENT).select(F.col("key").alias("token"), F.col("doc").alias("n"))))
    equal = stored(_equal(profile))
    lines = profile.where((F.col("kind") == FIRST) & (F.octet_length("tokens") > 0)).select("key", "doc", "line", "tokens")
    plain = share((order, None))
    found = stored(_candidates(_blobs(lines, plain, percent, n_buckets), percent, KEPT, None))
    # the likeliest candidate of each line is verified first; then, where it fails, the others found
    nearest = F.min(F.struct("score", "with_doc", "with_line")).alias("x")
    tried = stored(found.groupBy("doc", "line").agg(nearest, F.max("kind").alias("kind")))
    sets = _sets_of_ends(found, lines)
    first = _verified(tried.select("doc", "line", "x.with_doc", "x.with_line"), sets, percent)
    failed = stored(tried.join(first, ["doc", "line"], "left_anti"))
    others = stored(found.join(failed.select("doc", "line"), ["doc", "line"], "left_semi").select(*PAIR).distinct())
    then = _verified(others, sets, percent)
    discard(sets)
    left = stored(failed.where(F.col("kind") == MORE).select("doc", "line").join(then, ["doc", "line"], "left_anti"))
    out = equal.union(first).union(then)
    if not left.isEmpty():
        bits = share(bitset_of(left.select(line_key_column("doc", "line").alias("key")), "key", 25))
        asked = share((order, _tokens_of(lines, plain, bits, percent)))
        rest = stored(_candidates(_blobs(lines, asked, percent, n_buckets), percent, None, bits).select(*PAIR).distinct())
        out = out.union(_verified(rest, _sets_of_ends(rest, lines), percent))
    out = stored(out.distinct())
    discard(profile)
    return out.select(F.col("doc").alias(id_col), "line")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, n_buckets: int | None = None) -> DataFrame:
    """``docs`` with later matching lines taken out of the text; other columns as they are.

    No row goes: a text all of whose lines go becomes empty, a null text stays null. Rows without
    an id keep all their lines. The columns n_lines and n_removed are added; columns of these names
    in ``docs`` give way to them.
    """
    spark = docs.sparkSession
    docs = docs.drop(*({"n_lines", "n_removed"} - {id_col, text_col}))
    key, lost = free_name(docs, "key"), free_name(docs, "lost")
    gone = duplicate_lines(docs, id_col, text_col, percent, n_buckets)
    per_row = stored(gone.groupBy(F.col(id_col).alias(key)).agg(F.collect_set("line").alias(lost)))
    del gone
    release(spark)
    touched = spark.sparkContext.broadcast(bitset_of(per_row.select(key), key))
    with_id = docs.withColumn(key, F.col(id_col).cast("long"))
    # only rows that may have lost a line are joined; the texts of the others are not shuffled. The
    # hash table is of line numbers, so texts need no sort
    hit = _marked(with_id, key, text_col, touched, True).join(per_row.hint("shuffle_hash"), key, "left").select(*docs.columns, lost)
    n_lines = F.when(F.col(text_col).isNull(), 0).otherwise(F.length(text_col) - F.length(F.replace(F.col(text_col), F.lit("\n"), F.lit(""))) + 1)
    same = _marked(with_id, key, text_col, touched, False).withColumns({"n_lines": n_lines, "n_removed": F.lit(0)}).drop(key)
    return _cut(hit, same.schema, text_col, lost).unionByName(same)


def _marked(rows: DataFrame, key: str, text_col: str, touched, hit: bool) -> DataFrame:
    """The rows whose key is in the bit set, their texts compressed, or the others as they are."""
    fields = [T.StructField(f.name, T.BinaryType()) if hit and f.name == text_col else f for f in rows.schema.fields]

    def mark(batches):
        small = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            found = in_bitset(touched.value, pc.fill_null(batch.column(key), 0).to_numpy())
            batch = batch.filter(pa.array(found == hit))
            if hit:
                at = batch.schema.get_field_index(text_col)
                texts = batch.column(at).cast(pa.large_binary())
                raw = pa.array([small.compress(x.as_buffer()) if x.is_valid else None for x in texts], pa.binary())
                batch = pa.RecordBatch.from_arrays([raw if k == at else c for k, c in enumerate(batch.columns)], batch.schema.names)
            yield batch

    return rows.mapInArrow(lean(mark), T.StructType(fields))


def _cut(rows: DataFrame, schema: T.StructType, text_col: str, lost: str) -> DataFrame:
    """Texts unpacked, without the lines numbered in ``lost`` (null: none); n_lines and n_removed added."""

    def cut(batches):
        whole = zstandard.ZstdDecompressor()

        def text(packed, gone):
            if not packed.is_valid:
                return None, 0, 0
            raw = whole.decompress(packed.as_buffer())
            lines = raw.split(b"\n")
            if gone.is_valid:
                out = set(gone.as_py())
                raw = b"\n".join(x for k, x in enumerate(lines) if k not in out)
            return raw, len(lines), len(gone.as_py()) if gone.is_valid else 0

        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            for lo in range(0, len(batch), CUT_ROWS):
                part = batch.slice(lo, CUT_ROWS)
                texts, n, n_lost = zip(*map(text, part.column(at), part.column(lost)))
                cols = [pa.array(texts, pa.binary()).cast(pa.string()) if k == at else c for k, c in enumerate(part.columns[:-1])]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int32()), pa.array(n_lost, pa.int32())], schema.names)

    return rows.mapInArrow(lean(cut), schema)
