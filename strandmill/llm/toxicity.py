"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence's probability is a logistic score of its words;
the document's is their noisy-or. Training sees document labels only, and the sentence scores
then locate the offending sentences.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, LOWER, Words, text_slices

#: Labelled rows that training reads at most (those of smallest id hash).
MAX_TRAIN_ROWS = 12_000
#: Words that the model keeps, the most telling of those in so many training rows or more.
MAX_WORDS, MIN_ROWS = 2_000, 5
CUTS = np.zeros(256, bool)
CUTS[[10, 33, 46, 63]] = True


@dataclass
class BagModel:
    words: np.ndarray  # sorted word hashes
    weights: np.ndarray
    bias: float
    prior: float  # the score of a text without words


def held_out(id_col: str, parts: int = 4, held: int = 2) -> Column:
    """By the id's crc32; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts)) == held, F.lit(False))


def _sentences(data: np.ndarray, offs: np.ndarray):
    """(words, sentence number of each word within the slice, the row of each sentence)."""
    w = Words(data, offs, ALNUM)
    cuts = np.concatenate([[0], np.cumsum(CUTS[data])])
    key = cuts[w.starts] + w.doc  # rises at every cut and every new row
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    return w, np.cumsum(new) - 1, w.doc[new]


def _features(docs: DataFrame, id_col: str, text_col: str, label_col: str) -> pa.Table:
    """label, and distinct (sentence, word hash) pairs of each row."""

    def read(batches):
        for batch in batches:
            for lo, hi, data, offs in text_slices(batch):
                w, sentence, of = _sentences(LOWER[data], offs)
                first = np.searchsorted(of, np.arange(hi - lo + 1))
                pairs = np.unique(np.stack([sentence.astype(np.uint64), w.hash]), axis=1) if len(w.hash) else np.zeros((2, 0), np.uint64)
                at = np.searchsorted(pairs[0].astype(np.int64), first)
                hashes, sents = pairs[1], pairs[0].astype(np.int64)
                rows = [(hashes[a:b].tobytes(), (sents[a:b] - first[d]).astype(np.int32).tobytes()) for d, (a, b) in enumerate(zip(at[:-1], at[1:]))]
                if rows:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())], ["label", "words", "sents"])

    rows = docs.select(F.col(label_col).cast("int").alias("label"), F.col(text_col).alias("text"))
    return rows.mapInArrow(read, "label int, words binary, sents binary").toArrow()


def noisy_or(z: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(probability of each row, of each sentence)."""
    p = np.clip(1 / (1 + np.exp(-z)), 1e-9, 1 - 1e-6)
    return 1 - np.exp(np.bincount(row, np.log1p(-p), n)), p


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = MAX_TRAIN_ROWS, passes: int = 150, max_words: int = MAX_WORDS, min_rows: int = MIN_ROWS) -> BagModel:
    """Fit on at most ``max_rows`` rows of ``docs`` with a label (a documented bound, so the numpy
    descent on the driver is bounded too). Null labels are skipped; of repeated labels of one id the
    largest holds; without labels every text scores 0. The model keeps the ``max_words`` most telling
    words of those in ``min_rows`` training rows or more (both bound the model, like the rows)."""
    marked = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("label_id")).agg(F.max(label_col).alias("y"))
    chosen = marked.orderBy(F.xxhash64("label_id"), "label_id").limit(max_rows)
    got = _features(docs.select(id_col, text_col).join(F.broadcast(chosen), F.col(id_col) == F.col("label_id")), id_col, text_col, "y")
    y = got.column("label").to_numpy().astype(float)
    words = [np.frombuffer(b, np.uint64) for b in got.column("words").to_pylist()]
    if not len(y) or not sum(map(len, words)):
        return BagModel(np.zeros(0, np.uint64), np.zeros(0), -20.0, 0.1)
    sents = [np.frombuffer(b, np.int32) for b in got.column("sents").to_pylist()]
    flat = np.concatenate(words)
    row = np.repeat(np.arange(len(y)), [len(w) for w in words])
    seen, inv = np.unique(flat, return_inverse=True)
    pairs = np.unique(inv.astype(np.int64) * len(y) + row)
    word, of = pairs // len(y), pairs % len(y)
    rows_of, pos = np.bincount(word, minlength=len(seen)), np.bincount(word, y[of], len(seen))
    base = y.mean()
    z = (pos - rows_of * base) / np.sqrt(rows_of * base * (1 - base) + 1e-9)
    z[rows_of < min_rows] = 0
    kept = np.sort(np.argsort(-np.abs(z), kind="stable")[:max_words])
    index = np.full(len(seen), -1)
    index[kept] = np.arange(len(kept))
    sizes = np.array([int(s.max()) + 1 if len(s) else 1 for s in sents])
    begin = np.concatenate([[0], np.cumsum(sizes)])
    sent = np.concatenate([s + b for s, b in zip(sents, begin)])
    sent_row = np.repeat(np.arange(len(y)), sizes)
    held = index[inv] >= 0
    sent, feat = sent[held], index[inv][held]
    weights, bias = np.zeros(len(kept)), -6.0
    m, v = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for step in range(1, passes + 1):
        zs = bias + np.bincount(sent, weights[feat], len(sent_row))
        prob, p = noisy_or(zs, sent_row, len(y))
        prob = np.clip(prob, 1e-6, 1 - 1e-6)
        pull = np.where(y > 0, -(1 - prob) / prob, 1.0)[sent_row] * p
        grad = np.append(np.bincount(feat, pull[sent], len(kept)), pull.sum()) / len(y)
        grad[:-1] += 2e-4 * np.sign(weights)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        move = 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    order = np.argsort(seen[kept])
    return BagModel(seen[kept][order], weights[order], float(bias), float(base))


def score(docs: DataFrame, model: BagModel, id_col: str = "doc_id", text_col: str = "text", cut: float = 0.3, sentence_cut: float = 0.3) -> DataFrame:
    """id, score (0 to 1), predicted (0 or 1), offending: (start, end, score) in bytes of the UTF-8
    text from the first to past the last word of each sentence at ``sentence_cut`` or above.

    Null, empty and wordless texts score 0. Whole texts count. A row per row, those without an id and
    repeated ones, too; an empty table gives none. Nothing is shuffled.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def scan(batches):
        for batch in batches:
            for lo, hi, data, offs in text_slices(batch):
                n = hi - lo
                w, sentence, of = _sentences(LOWER[data], offs)
                found = [[] for _ in range(n)]
                if len(w.hash) and len(model.words):
                    at = np.minimum(np.searchsorted(model.words, w.hash), len(model.words) - 1)
                    hit = np.flatnonzero(model.words[at] == w.hash)
                    pairs = np.unique(sentence[hit].astype(np.int64) * len(model.words) + at[hit])
                    z = model.bias + np.bincount(pairs // len(model.words), model.weights[pairs % len(model.words)], len(of))
                    prob, p = noisy_or(z, of, n)
                    edge = np.searchsorted(sentence, np.arange(len(of) + 1))
                    for s in np.flatnonzero(p >= sentence_cut).tolist():
                        d = int(of[s])
                        found[d].append({"start": int(w.starts[edge[s]] - offs[d]), "end": int(w.ends[edge[s + 1] - 1] - offs[d]), "score": float(p[s])})
                else:
                    prob = np.zeros(n)
                prob = np.clip(prob, 0.0, 1.0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n), pa.array(prob), pa.array((prob >= cut).astype(np.int32)), pa.array(found, spans)], ["id", "score", "predicted", "offending"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(scan, f"id {kind}, score double, predicted int, offending array<struct<start:long,end:long,score:double>>").withColumnRenamed("id", id_col)
