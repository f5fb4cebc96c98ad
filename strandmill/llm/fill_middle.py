"""Fill-in-middle transformation by piece tables.

A document's text is an immutable buffer, the sentinels are another. A piece table is a list of
descriptors (buffer, start, end) over both: cutting splits a descriptor, an arrangement permutes
them, and its inverse puts them back. Hashes and texts stream the descriptors; no text is edited.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import small_batches, text_slices

#: The sentinels of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
#: Where descriptors come from: prefix, middle and suffix of the text, then the three sentinels.
ARRANGED = {"psm": (3, 0, 4, 2, 5, 1), "spm": (4, 2, 3, 0, 5, 1)}
#: Per cent of texts that stay plain, and of the others that begin with the suffix.
PLAIN_FROM, SPM_BELOW = 90, 20


class PieceTable:
    """Descriptors (buffer, start, end) over a text and the sentinels."""

    def __init__(self, text, pieces: list[tuple[int, int, int]] | None = None):
        self.buffers = (memoryview(text), memoryview(SENTINELS))
        self.pieces = [(0, 0, len(text))] if pieces is None else pieces

    def cut(self, at: int) -> None:
        """Split the text's descriptor that ``at`` (a byte of the text) lies in, or the last that it ends."""
        for k in range(len(self.pieces) - 1, -1, -1):
            buffer, start, end = self.pieces[k]
            if not buffer and start <= at <= end:
                self.pieces[k : k + 1] = [(0, start, at), (0, at, end)]
                return
        raise IndexError(at)

    def arrange(self, order: tuple[int, ...]) -> None:
        """Place the descriptors in ``order``, the sentinels' three after those of the text."""
        slots = self.pieces + [(1, k, k + 3) for k in (0, 3, 6)]
        self.pieces = [slots[k] for k in order]

    def restore(self, order: tuple[int, ...]) -> None:
        """The inverse of :meth:`arrange`: descriptors back at their places, the sentinels' away."""
        slots = [self.pieces[0]] * len(order)
        for place, k in enumerate(order):
            slots[k] = self.pieces[place]
        self.pieces = slots[:-3]

    def stream(self):
        for buffer, start, end in self.pieces:
            yield self.buffers[buffer][start:end]

    def digest(self) -> str:
        h = hashlib.sha256()
        for part in self.stream():
            h.update(part)
        return h.hexdigest()

    @classmethod
    def parsed(cls, output, order: tuple[int, ...]) -> PieceTable:
        """Of an arranged text. None of its three texts holds a sentinel, so the first of each is its
        own: a sentinel neither begins within another nor within a text and its neighbour."""
        raw, pieces, at = bytes(output), [], 0
        for k, nxt in zip(order, [*order[1:], None]):
            if k >= 3:
                pieces.append((1, 3 * (k - 3), 3 * (k - 2)))
                at += 3
            else:
                end = len(raw) if nxt is None else raw.index(SENTINELS[3 * (nxt - 3) : 3 * (nxt - 2)], at)
                pieces.append((0, at, end))
                at = end
        return cls(output, pieces)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1) -> DataFrame:
    """One row per row: id, n (code points), form (plain, psm or spm), prefix_chars, middle_chars,
    output (the text), output_sha256.

    Cuts and form follow from the SHA-256 of seed and id alone. Null texts count as empty; empty
    texts and those that hold a sentinel are plain, and of a plain text the lengths are null. A null
    id is hashed as empty text. Repeated rows give repeated rows, an empty table none. Other columns
    are not read. Nothing is shuffled.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    sha = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), sha.alias("sha"))
    rows = rows.select("id", "text", *[F.conv(F.substring("sha", 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)])
    names = ["id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def build(batches):
        for batch in batches:
            marked = pc.fill_null(pc.match_substring_regex(batch.column(1), "<P>|<S>|<M>"), False).to_numpy(zero_copy_only=False)
            hashes = [batch.column(k).to_numpy() for k in range(2, 6)]
            for lo, hi, data, offs in text_slices(batch):
                starts = np.flatnonzero((data & 0xC0) != 0x80)  # the code points' first bytes
                first = np.searchsorted(starts, offs)
                n = np.diff(first)
                a, b, h3, h4 = (h[lo:hi] for h in hashes)
                a, b = a % (n + 1), b % (n + 1)
                p, m = np.minimum(a, b), np.maximum(a, b)
                plain = (n == 0) | marked[lo:hi] | (h3 % 100 >= PLAIN_FROM)
                place = np.append(starts, len(data))  # a cut at a text's end lies where the next begins
                cut_p, cut_m = place[first[:-1] + p] - offs[:-1], place[first[:-1] + m] - offs[:-1]
                view, out = memoryview(data), []
                for d in range(hi - lo):
                    table = PieceTable(view[offs[d] : offs[d + 1]])
                    form = "plain" if plain[d] else "spm" if h4[d] % 100 < SPM_BELOW else "psm"
                    if form != "plain":
                        table.cut(int(cut_p[d]))
                        table.cut(int(cut_m[d]))
                        table.arrange(ARRANGED[form])
                    out.append((form, b"".join(table.stream()).decode(), table.digest()))
                form, text, digest = zip(*out)
                lens = [pa.array(v, mask=plain) for v in (p.astype(np.int64), (m - p).astype(np.int64))]
                cols = [pa.array(n.astype(np.int64)), pa.array(form), *lens, pa.array(text, pa.string()), pa.array(digest)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *(c.cast(k) for c, k in zip(cols, kinds))], names)

    made = rows.mapInArrow(build, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string")
    return made.withColumnRenamed("id", id_col)


def restored(rows: DataFrame, output_col: str = "output", form_col: str = "form") -> DataFrame:
    """``rows`` with ``restored``, the text as it was, and ``restored_sha256``, from output and form
    alone: the output is read back as a piece table, whose inverse arrangement is the text. Columns of
    these two names are replaced. A null output counts as empty, and its form as plain."""
    small_batches(rows.sparkSession)
    rows = rows.drop("restored", "restored_sha256")
    at = [rows.columns.index(c) for c in (output_col, form_col)]

    def rebuild(batches):
        for batch in batches:
            texts, digests = [], []
            for raw, form in zip(batch.column(at[0]).cast(pa.binary()), batch.column(at[1]).to_pylist()):
                raw = raw.as_buffer() if raw.is_valid else b""
                table = PieceTable(raw) if form not in ARRANGED or not len(memoryview(raw)) else PieceTable.parsed(raw, ARRANGED[form])
                if form in ARRANGED and len(table.pieces) > 1:
                    table.restore(ARRANGED[form])
                texts.append(b"".join(table.stream()).decode())
                digests.append(table.digest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string()), pa.array(digests, pa.string())], [*batch.schema.names, "restored", "restored_sha256"])

    schema = StructType([*rows.schema.fields, StructField("restored", StringType()), StructField("restored_sha256", StringType())])
    return rows.mapInArrow(rebuild, schema)
