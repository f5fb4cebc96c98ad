"""Benchmark decontamination by CGK embedding, bit-sampling LSH and exact edit verification.

Texts and items are sequences of words. An item is found where a stretch of text is within
k = floor(m * percent / 100) word edits of its m words. The CGK random walk embeds items and
item-sized windows of text so that edit distance becomes Hamming distance; windows and items of one
size that agree on all sampled symbols of one of many samplings meet in a bucket, and are aligned
exactly. To embed every window of a corpus costs far more than to read it, so windows are cut only
where the text holds one of the k + 1 chunks of an item of that size unchanged: within k edits one
always is, and no window that could match is left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, LOWER, Words, lean, mix, small_batches, text_slices

PERCENT = 15
#: Embeddings, samplings of each, symbols of a sampling. A window of which a share s of the symbols
#: agrees with its item's is missed with probability (1 - s**SYMBOLS) ** (EMBEDDINGS * SAMPLINGS).
EMBEDDINGS, SAMPLINGS, SYMBOLS = 8, 8, 4
#: Words of items that one pass over the text compares with: the bound of what is broadcast.
BLOCK_WORDS = 100_000
#: Symbols of windows that are embedded at once.
BLOCK_SYMBOLS = 1 << 20
_C = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)


def grams(h: np.ndarray, q: int) -> np.ndarray:
    """Hashes of all runs of q words."""
    acc = np.zeros(max(0, len(h) - q + 1), np.uint64)
    for t in range(q):
        acc += (h[t : t + len(acc)] ^ np.uint64(t)) * _C[t % 5]
    return mix(acc)


def cgk(symbols: np.ndarray, steps: int, seed: int) -> np.ndarray:
    """Embeds each row of symbols into ``steps`` symbols: at each step a row gives its current one, and
    a coin drawn for the step and symbol moves on or not; past a row's end all symbols are 0."""
    n, width = symbols.shape
    padded = np.zeros((n, width + 1), np.uint64)
    padded[:, :width] = symbols
    at, row = np.zeros(n, np.int64), np.arange(n)
    out = np.empty((n, steps), np.uint64)
    for t in range(steps):
        s = padded[row, at]
        out[:, t] = s
        step = mix(s + np.uint64((seed * 1_000_003 + t) * 2 + 1)) & np.uint64(1)
        at = np.minimum(at + step.astype(np.int64), width)
    return out


def bucket_keys(symbols: np.ndarray, seed: int) -> np.ndarray:
    """(SAMPLINGS, rows): the bucket of each row in each sampling of one embedding. The sampled places
    lie in the first 2 m of the embedding, where the walk of m symbols is on its way."""
    size = symbols.shape[1]
    embedded = cgk(symbols, 2 * size, seed)
    rng = np.random.default_rng(seed)
    places = (rng.random((SAMPLINGS, SYMBOLS)) * 2 * size).astype(np.int64)
    mixed = [mix((embedded[:, p] * _C[:SYMBOLS]).sum(1, dtype=np.uint64) + np.uint64(k)) for k, p in enumerate(places)]
    return np.stack(mixed)


def edits(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(least word edits that turn some stretch of ``text`` into ``item``, where it ends)."""
    idx = np.arange(len(text) + 1)
    d = np.zeros(len(text) + 1, np.int64)
    for i, w in enumerate(item, 1):
        c = np.minimum(d + 1, np.concatenate([[i], d[:-1] + (text != w)]))
        c[0] = i
        d = np.minimum.accumulate(c - idx) + idx
    end = int(d.argmin())
    return int(d[end]), end


class Items:
    """A block of items ready for matching."""

    def __init__(self, ids: list, texts: list[str], percent: int):
        self.ids, self.words, self.k = [], [], []
        for i, t in zip(ids, texts):
            raw = np.frombuffer((t or "").encode(), np.uint8)
            h = Words(LOWER[raw], np.array([0, len(raw)]), ALNUM).hash
            if len(h):
                self.ids.append(i)
                self.words.append(h)
                self.k.append(len(h) * percent // 100)
        self.size = np.array([len(w) for w in self.words], np.int64)
        chunks: dict[int, list] = {}
        for j, (w, k) in enumerate(zip(self.words, self.k)):
            q = len(w) // (k + 1)
            for c in range(k + 1):
                chunks.setdefault(q, []).append((int(grams(w[c * q : (c + 1) * q], q)[0]), j, c * q))
        self.chunks = {}
        for q, rows in chunks.items():
            rows.sort()
            hashes = np.array([r[0] for r in rows], np.uint64)
            near = np.zeros(1 << 16, bool)
            near[(hashes >> np.uint64(48)).astype(np.int64)] = True
            self.chunks[q] = (hashes, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), near)
        #: for each size, and each embedding and sampling of it: sorted bucket keys, and their items
        self.buckets: dict[int, list[list[tuple[np.ndarray, np.ndarray]]]] = {}
        for size in np.unique(self.size).tolist():
            items = np.flatnonzero(self.size == size)
            symbols = np.stack([self.words[j] for j in items.tolist()])
            self.buckets[size] = []
            for e in range(EMBEDDINGS):
                keys = bucket_keys(symbols, e)
                order = np.argsort(keys, axis=1, kind="stable")
                self.buckets[size].append([(k[o], items[o]) for k, o in zip(keys, order)])

    def windows(self, w: Words) -> dict[int, np.ndarray]:
        """For each size the first words of the windows of the slice that hold a chunk of an item of
        that size in place."""
        found: dict[int, list] = {}
        for q, (hashes, item, offset, near) in self.chunks.items():
            g = grams(w.hash, q)
            at = np.flatnonzero(near[(g >> np.uint64(48)).astype(np.int64)])
            at = at[w.doc[at] == w.doc[at + q - 1]] if len(at) else at
            lo, hi = np.searchsorted(hashes, g[at], "left"), np.searchsorted(hashes, g[at], "right")
            at, lo, n = at[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
            if not len(at):
                continue
            # chunks of many items of one size and place give one window
            kinds, of = np.unique(lo, return_inverse=True)
            for k, first in enumerate(kinds.tolist()):
                here = at[of == k]
                last = first + int(n[of == k][0])
                for size, back in set(zip(self.size[item[first:last]].tolist(), offset[first:last].tolist())):
                    # a window that starts before its row is moved to the row's start
                    found.setdefault(size, []).append(np.maximum(here - back, w.first[w.doc[here]]))
        return {size: np.unique(np.concatenate(x)) for size, x in found.items()}

    def candidates(self, w: Words) -> list[tuple[int, int]]:
        """(item, first word) of the windows that share a bucket with an item of their size."""
        out = set()
        for size, starts in self.windows(w).items():
            rows = max(1, BLOCK_SYMBOLS // size)
            for lo in range(0, len(starts), rows):
                start = starts[lo : lo + rows]
                place = start[:, None] + np.arange(size)
                last = w.first[w.doc[start] + 1]
                symbols = np.where(place < last[:, None], w.hash[np.minimum(place, len(w.hash) - 1)], np.uint64(0))
                for e, samplings in enumerate(self.buckets[size]):
                    for mine, (keys, items) in zip(bucket_keys(symbols, e), samplings):
                        a, b = np.searchsorted(keys, mine, "left"), np.searchsorted(keys, mine, "right")
                        for k in np.flatnonzero(b > a).tolist():
                            out.update((j, int(start[k])) for j in items[a[k] : b[k]].tolist())
        return sorted(out)

    def matches(self, data: np.ndarray, offs: np.ndarray) -> list[tuple[int, object, int, int, int]]:
        """(row, item id, first word, past its last, edits): the best place of each item in each row."""
        w = Words(LOWER[data], offs, ALNUM)
        if not len(w.hash) or not self.words:
            return []
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for j, s in self.candidates(w):
            d, k, words = int(w.doc[s]), self.k[j], self.words[j]
            first, last = int(w.first[d]), int(w.first[d + 1])
            if s + len(words) <= last and np.array_equal(w.hash[s : s + len(words)], words):
                found = (0, s - first, s - first + len(words))
            else:
                lo, hi = max(first, s - 2 * k), min(last, s + len(words) + 2 * k)
                n, end = edits(words, w.hash[lo:hi])
                if n > k:
                    continue
                _, back = edits(words[::-1], w.hash[lo : lo + end][::-1])
                found = (n, lo + end - back - first, lo + end - first)
            if (d, j) not in best or found < best[d, j]:
                best[d, j] = found
        return [(d, self.ids[j], a, b, n) for (d, j), (n, a, b) in sorted(best.items(), key=lambda x: x[0])]


def item_blocks(items: DataFrame, item_id: str, item_text: str, percent: int, block_words: int = BLOCK_WORDS):
    """The items in blocks of about ``block_words`` words, one at a time on the driver."""
    rows = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("text")).where(F.col("text").isNotNull())
    words = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-words // (6 * block_words)) or 1
    for b in range(n):
        part = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b).orderBy("item", "text").toArrow()
        yield Items(part.column("item").to_pylist(), part.column("text").to_pylist(), percent)


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(id, item_id, first_word, end_word, edits): for each row and item found in it the best place.

    Words are runs of ASCII digits, letters and characters beyond ASCII, A-Z lower-cased. Null and
    empty texts and items give no rows, repeated rows repeated results; items of equal text are
    found alike. Other columns are not read. Nothing is shuffled; items beyond BLOCK_WORDS words
    take further passes over the text.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kinds = docs.schema[id_col].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = None
    for block in item_blocks(items, item_id, item_text, percent):
        shared = spark.sparkContext.broadcast(block)

        def scan(batches, shared=shared):
            block = shared.value
            for batch in batches:
                for lo, hi, data, offs in text_slices(batch):
                    found = block.matches(data, offs)
                    if found:
                        row, item, a, b, n = zip(*found)
                        yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo).take(pa.array(row)), pa.array(item), *(pa.array(x, pa.int64()) for x in (a, b, n))], ["id", "item", "first_word", "end_word", "edits"])

        part = rows.mapInArrow(lean(scan), f"id {kinds[0]}, item {kinds[1]}, first_word long, end_word long, edits long")
        out = part if out is None else out.union(part)
    return out.withColumnsRenamed({"id": id_col, "item": item_id})


def without_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` in which no item is found, all columns as they are, without a shuffle.

    Null and empty texts hold no item and stay; so do rows without an id and repeated ones, each by
    its own text. Without items every row stays; an empty table gives no row.
    """
    spark = docs.sparkSession
    small_batches(spark)
    names = docs.columns
    at = names.index(text_col)
    for block in item_blocks(items, item_id, item_text, percent):
        shared = spark.sparkContext.broadcast(block)

        def scan(batches, shared=shared):
            block = shared.value
            for batch in batches:
                text = pa.RecordBatch.from_arrays([batch.column(at)], ["text"])
                keep = np.ones(len(batch), bool)
                for lo, _, data, offs in text_slices(text):
                    keep[[lo + m[0] for m in block.matches(data, offs)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(lean(scan), docs.schema)
    return docs
