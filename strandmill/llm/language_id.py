"""Language identification by error-correcting output codes.

Every language has a codeword; binary classifiers over hashed byte trigrams predict its bits.
Decoding weights each bit's logistic loss by the classifier's accuracy on the training rows and
takes the nearest codeword; a small lead over the second marks the text as ambiguous.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean, small_batches, text_slices

BUCKET_BITS = 15
UNDETERMINED = "und"
#: Rows that training reads at most, over all languages (those of smallest id hash).
MAX_TRAIN_ROWS = 20_000
AMBIGUOUS_LEAD = 0.05


@dataclass
class CodeModel:
    languages: list[str]
    code: np.ndarray  # languages x bits, of -1 and 1
    weights: np.ndarray  # buckets x bits
    trust: np.ndarray  # a weight for each bit


def codewords(n: int) -> np.ndarray:
    """Exhaustive codes for up to 4 languages; beyond, of seeded random codes the one whose
    closest two codewords lie farthest apart."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 4:
        cols = [[1 if c >> i & 1 else -1 for i in range(n)] for c in range(1, 1 << (n - 1))]
        return np.array(cols).T
    bits, rng, best = max(15, int(np.ceil(10 * np.log2(n)))), np.random.default_rng(7), None
    for _ in range(200):
        c = rng.choice([-1, 1], (n, bits))
        c = c[:, np.abs(c.sum(0)) < n]
        apart = min((int((c[i] != c[j]).sum()) for i in range(n) for j in range(i)), default=0)
        if best is None or apart > best[0]:
            best = (apart, c)
    return best[1]


def trigram_buckets(data: np.ndarray) -> np.ndarray:
    """Bucket of the trigram at each byte but the last two; ASCII non-letters count as one blank."""
    d = data.copy()
    d[(d < 97) | ((d > 122) & (d < 128))] = 32
    d = d.astype(np.uint32)
    code = (d[:-2] << np.uint32(16)) | (d[1:-1] << np.uint32(8)) | d[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)


def _lowered(batch: pa.RecordBatch, name: str) -> pa.RecordBatch:
    low = pc.utf8_lower(pc.fill_null(batch.column(batch.schema.get_field_index(name)), ""))
    return pa.RecordBatch.from_arrays([low], ["text"])


def _slices(batch: pa.RecordBatch, name: str = "text"):
    """(first row, last row, buckets, the row of each) without trigrams across rows."""
    for lo, hi, data, offs in text_slices(_lowered(batch, name)):
        if len(data) < 3:
            yield lo, hi, np.zeros(0, np.uint32), np.zeros(0, np.int64)
            continue
        row = np.repeat(np.arange(hi - lo), np.diff(offs))
        inside = row[:-2] == row[2:]
        yield lo, hi, trigram_buckets(data)[inside], row[:-2][inside]


def held_out(id_col: str, parts: int = 5, held: int = 0) -> Column:
    """By the id's crc32; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts)) == held, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = MAX_TRAIN_ROWS) -> CodeModel:
    """Fit on the rows of ``docs`` with a language: all, or the ``max_rows`` of smallest id hash.

    Trigram counts by language are summed by Spark; at most languages x 2**15 sums reach the driver.
    """
    small_batches(docs.sparkSession)
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    ids = rows.select(F.xxhash64(F.col(id_col)).alias("h")).orderBy("h").limit(max_rows).agg(F.max("h")).first()[0]
    rows = rows.where(F.xxhash64(F.col(id_col)) <= F.lit(ids)).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def count(batches):
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            which = names.indices.to_numpy(zero_copy_only=False)
            size, total = 1 << BUCKET_BITS, None
            for lo, hi, bucket, row in _slices(batch):
                key = which[lo + row].astype(np.int64) * size + bucket
                found = np.bincount(key, minlength=size * len(names.dictionary))
                total = found if total is None else total + found
            if total is not None and (at := np.flatnonzero(total)).size:
                yield pa.RecordBatch.from_arrays([names.dictionary.take(pa.array(at // size)), pa.array((at % size).astype(np.int32)), pa.array(total[at].astype(np.int64))], ["lang", "bucket", "n"])

    sums = rows.mapInArrow(lean(count), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    languages = sorted(sums["lang"].unique())
    share = np.zeros((1 << BUCKET_BITS, max(1, len(languages))))
    for k, lang in enumerate(languages):
        mine = sums[sums["lang"] == lang]
        share[mine["bucket"], k] = mine["n"] / mine["n"].sum()
    code = codewords(len(languages))
    floor, weights = 1e-6, np.zeros((1 << BUCKET_BITS, code.shape[1]), np.float32)
    trust = np.ones(code.shape[1])
    for b in range(code.shape[1] if len(languages) > 1 else 0):
        up, down = share[:, code[:, b] > 0].mean(1), share[:, code[:, b] < 0].mean(1)
        weights[:, b] = np.log((up + floor) / (down + floor))
        # how far apart the two sides lie, per trigram: bits that tell more count more
        trust[b] = ((up - down) * weights[:, b]).sum()
    return CodeModel(languages, code, weights, trust / trust.sum())


def decode(margins: np.ndarray, model: CodeModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nearest codeword, its softmax share, lead over the second) by loss-weighted decoding."""
    loss = np.stack([(np.logaddexp(0, -margins * word) * model.trust).sum(1) for word in model.code], 1)
    best = loss.argmin(1)
    share = np.exp(-(loss - loss.min(1, keepdims=True)) * 4)
    share /= share.sum(1, keepdims=True)
    ordered = np.sort(share, 1)
    lead = ordered[:, -1] - ordered[:, -2] if share.shape[1] > 1 else np.ones(len(share))
    return best, share[np.arange(len(best)), best], lead


def predict(docs: DataFrame, model: CodeModel, id_col: str = "doc_id", text_col: str = "text", keep: list[str] = (), lead: float = AMBIGUOUS_LEAD) -> DataFrame:
    """id, the columns ``keep``, lang_pred, score (0 to 1) and ambiguous, a row per row of ``docs``.

    ``und`` with score 0 where text is null or holds no letter, or no language was learned. Texts of
    one or two letters have no trigram: every language is as near, the first is taken, ambiguous.
    The whole text counts. Repeated rows give repeated results, rows without an id keep theirs, an
    empty table gives no row; nothing is shuffled.
    """
    fields = [docs.schema[id_col], *(docs.schema[c] for c in keep)]
    code = model
    small_batches(docs.sparkSession)
    # a text that is kept goes to the workers once
    name = f"k{[*keep].index(text_col)}" if text_col in keep else "text"

    def scan(batches):
        for batch in batches:
            lang, score, unsure = [], [], []
            text = pc.fill_null(batch.column(batch.schema.get_field_index(name)), "")
            letters = pc.match_substring_regex(text, r"\p{L}").to_numpy(zero_copy_only=False)
            for lo, hi, bucket, row in _slices(batch, name):
                n, bits = hi - lo, code.weights.shape[1]
                sums = np.stack([np.bincount(row, code.weights[bucket, b], n) for b in range(bits)], 1)
                count = np.maximum(1, np.bincount(row, minlength=n))[:, None]
                if not code.languages:
                    best, share, ahead = np.zeros(n, int), np.zeros(n), np.zeros(n)
                else:
                    best, share, ahead = decode(sums / count * np.minimum(count, 60) ** 0.5, code)
                for d in range(n):
                    known = bool(letters[lo + d]) and bool(code.languages)
                    lang.append(code.languages[best[d]] if known else UNDETERMINED)
                    score.append(float(share[d]) if known else 0.0)
                    unsure.append(bool(ahead[d] < lead) if known else True)
            if len(batch):
                kept = [batch.column(k) for k in range(1 + len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(unsure, pa.bool_())], ["id", *(f"k{i}" for i in range(len(keep))), "lang_pred", "score", "ambiguous"])

    rows = docs.select(F.col(id_col).alias("id"), *(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)), *([] if text_col in keep else [F.col(text_col).alias("text")]))
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(["id", *(f"k{i}" for i in range(len(keep)))], fields)) + ", lang_pred string, score double, ambiguous boolean"
    out = rows.mapInArrow(lean(scan), schema)
    return out.select(F.col("id").alias(id_col), *(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), "lang_pred", "score", "ambiguous")
