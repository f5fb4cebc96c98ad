"""Cross-tokenizer alignment: the tokens of two tokenizers over one text, grouped and linked by bytes.

Within a stretch of text both tokenizers' cumulative token ends are dictionaries from end to index;
the ends that both have, in order, slice the two id lists into groups, and links are expanded slice
by slice. Texts are aligned a stretch at a time between places where both tokenizers always cut (as
before a single space between words), and each distinct stretch of a worker once.

How many documents hold a pair of ids linked is counted over the corpus. A task works off its
documents in blocks of bounded text: a block keeps its distinct pairs, stretches and, for each
document, the stretches it holds. Only the blocks' distinct pairs are shuffled and counted; their
counts come back to the block, where the documents' sums follow.
"""

from __future__ import annotations

import functools
import hashlib
import re
from array import array
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import multi_arange, small_batches, stored

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Letters of words, and signs, that may stand by themselves.
LETTER = "[A-Za-zÀ-ÖØ-öø-ÿ]"
SIGNS = '.,;:!?"()[]{}-_*#@=+&%$'
#: Stretches that A and B encode the same with others around them, an end of line between: so many at once.
SIMPLE, JOINED = re.compile(r" ?\S+"), 200
#: A worker forgets the stretches it has aligned beyond so many characters of them, before a block.
CACHED_CHARS = 2_000_000
#: A block ends with the document that brings its text to so many characters.
BLOCK_CHARS = 4_000_000
SPACE = "▁"  # stands for a space in the pieces of B


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones stand for
    themselves, the others in order for letters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def piece_bytes(piece: str) -> bytes:
    """The bytes of a piece of B: U+2581 is a space, <0xHH> the byte HH."""
    if m := re.fullmatch(r"<0x([0-9A-F]{2})>", piece):
        return bytes([int(m[1], 16)])
    return piece.replace(SPACE, " ").encode()


def align(a: list[int], b: list[int]) -> list[tuple[int, int, int, int]]:
    """Groups (first of a, past last of a, first of b, past last of b) of two lists of token lengths
    of the same bytes, by the ends that both have."""
    ends = [dict(zip(accumulate(lens), range(1, len(lens) + 1))) for lens in (a, b)]
    both = sorted(ends[0].keys() & ends[1].keys())
    cuts_a, cuts_b = ([0, *map(at.__getitem__, both)] for at in ends)
    return list(zip(cuts_a, cuts_a[1:], cuts_b, cuts_b[1:]))


def overlaps(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Pairs of places whose byte ranges overlap, of two lists of token lengths of one group."""
    out, i, j, left_a, left_b = [], 0, 0, a[0], b[0]
    while True:
        out.append((i, j))
        step = min(left_a, left_b)
        left_a, left_b = left_a - step, left_b - step
        if not left_a:
            i += 1
            left_a = a[i] if i < len(a) else 0
        if not left_b:
            j += 1
            left_b = b[j] if j < len(b) else 0
        if i == len(a) or j == len(b):
            return out


def cutter(pieces: list[str]) -> re.Pattern | None:
    """Finds the stretches of a text, a space before it: words, numbers, signs and ends of lines by
    themselves where both tokenizers cut there, else all up to the next single space between words.

    A never joins letters, numbers and signs (an apostrophe begins tokens of its own, so it is no sign
    here), nor ends of lines and what follows. B joins two characters only if a piece has them side by
    side; signs that a piece has beside a letter or digit are left out. None if B joins across spaces
    or ends of lines: its texts are one stretch."""
    pairs = {p for piece in pieces if not re.fullmatch(r"<0x..>", piece) for p in zip(piece, piece[1:])}
    if any(y == SPACE != x or "\n" in (x, y) for x, y in pairs):
        return None
    beside = {s for x, y in pairs for s, other in ((x, y), (y, x)) if re.match(rf"{LETTER}|[0-9]", other)}
    sign = "[" + "".join(re.escape(c) for c in SIGNS if c not in beside) + "]"
    ends = rf"(?={sign}|\n| \S|\Z)"
    return re.compile(rf" ?{LETTER}+{ends}| ?{sign}+(?={LETTER}|[0-9]|\n| \S|\Z)| ?[0-9]+{ends}|\n+(?={LETTER}|{sign}|\Z)|(?s:.+?)(?:(?=(?<=\S) \S)|\Z)")


class Aligner:
    """Aligns stretches of text and keeps what it has aligned: of each its tokens of A and of B, its
    groups, their text, and its links a << 32 | b. A stretch whose tokens do not spell it has no number."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        self.bytes_a = {k: bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode() for token, k in self.a.get_vocab().items()}
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.bytes_b = [piece_bytes(p) for p in pieces]
        self.cut = cutter(pieces)
        line = self.a.token_to_id("Ċ")  # the end of line by itself
        self.line = -1 if line is None else line
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.said: list[str] = []
        self.figures = array("q")  # tokens of A, of B, groups and links of each
        self.links, self.chars = array("q"), 0

    def lengths(self, ids: list[int], table, raw: bytes) -> list[int] | None:
        """The bytes of each token, or None if the tokens do not spell ``raw``."""
        tokens = list(map(table.__getitem__, ids))
        return list(map(len, tokens)) if b"".join(tokens) == raw else None

    def keep(self, a: list[int], b: list[int], groups: list[str], links: int) -> int:
        self.said.append(";".join(groups))
        self.figures.extend((a, b, len(groups), len(self.links) - links))
        return len(self.said) - 1

    def grouped(self, a: list[int], b: list[int], len_a: list[int], len_b: list[int], end: int = -1) -> list[int]:
        """Aligns two lists of ids and keeps them, cut at each group of which the token ``end`` of A is
        all (and not kept), or whole: the numbers of what is kept."""
        out, said, links, i0, j0 = [], [], len(self.links), 0, 0
        for i, p, j, q in align(len_a, len_b):
            if p - i == 1 == q - j:
                if a[i] == end:
                    out.append(self.keep(i - i0, j - j0, said, links))
                    said, links, i0, j0 = [], len(self.links), p, q
                    continue
                said.append(f"{a[i]}|{b[j]}")
                self.links.append(a[i] << 32 | b[j])
            else:
                said.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
                self.links.extend(a[i + x] << 32 | b[j + y] for x, y in overlaps(len_a[i:p], len_b[j:q]))
        return out if end >= 0 else [self.keep(len(a), len(b), said, links)]

    def learn_one(self, part: str, whole: bool = False) -> int:
        """The number of a stretch, -1 if it is not spelled. B puts a space before what it encodes, so a
        stretch gets an end of line before it, which joins nothing, and its two tokens are taken off."""
        a = self.a.encode(part, add_special_tokens=False).ids
        b = self.b.encode(part[1:]) if whole else self.b.encode("\n" + part)[2:]
        raw = part.encode()
        len_a, len_b = self.lengths(a, self.bytes_a, raw), self.lengths(b, self.bytes_b, raw)
        return -1 if len_a is None or len_b is None else self.grouped(a, b, len_a, len_b)[0]

    def learn(self, parts: list[str]) -> None:
        """Learns stretches: words, numbers and signs a batch at a time, each ended by an end of line."""
        self.chars += sum(map(len, parts))
        simple = SIMPLE.fullmatch if self.line >= 0 else lambda p: None
        alone, joined = [p for p in parts if not simple(p)], [p for p in parts if simple(p)]
        for lo in range(0, len(joined), JOINED):
            batch = joined[lo : lo + JOINED]
            text = "\n".join(batch) + "\n"
            raw, a, b = text.encode(), self.a.encode(text, add_special_tokens=False).ids, self.b.encode("\n" + text)[2:]
            len_a, len_b = self.lengths(a, self.bytes_a, raw), self.lengths(b, self.bytes_b, raw)
            if len_a is None or len_b is None:
                alone += batch
            else:
                self.known.update(zip(batch, self.grouped(a, b, len_a, len_b, self.line), strict=True))
        for part in alone:
            self.known[part] = self.learn_one(part)

    def document(self, text: str) -> list[int]:
        """Numbers of the stretches of a text, in order; none where its tokens do not spell it."""
        text = " " + text
        if self.cut:
            parts = self.cut.findall(text)
            found = list(map(self.known.get, parts))
            if None in found:
                self.learn(list({p for p, k in zip(parts, found) if k is None}))
                found = list(map(self.known.get, parts))
            if -1 not in found:
                return found
        whole = self.learn_one(text, True)  # what one stretch adds another could lack: the text itself decides
        return [] if whole < 0 else [whole]


@functools.lru_cache(maxsize=1)
def aligner_of(path_a: str, path_b: str) -> Aligner:
    """A worker's aligner: vocabularies are read once, not for each of its tasks."""
    return Aligner(path_a, path_b)


def _narrow(x: np.ndarray) -> np.ndarray:
    """Counts and places in as few bytes as the largest needs; :func:`_wide` knows them by their length."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def _wide(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


class Block:
    """Documents of bounded text, with the numbers of their stretches in ``aligner``."""

    def __init__(self, aligner: Aligner):
        if aligner.chars > CACHED_CHARS:
            aligner.forget()
        self.aligner, self.chars = aligner, 0
        self.ids, self.held, self.times, self.digests = [], [], [], []

    def add(self, id_value, text: str | None) -> None:
        at = self.aligner.document(text) if text else []
        held, times = np.unique(np.array(at, np.int64), return_counts=True)
        self.chars += len(text or "")
        self.ids.append(id_value)
        self.held.append(held)
        self.times.append(times)
        self.digests.append(hashlib.sha256(";".join(map(self.aligner.said.__getitem__, at)).encode()).hexdigest() if at else "")

    def columns(self) -> list:
        figures = np.frombuffer(self.aligner.figures, np.int64).reshape(-1, 4) if len(self.aligner.figures) else np.zeros((0, 4), np.int64)
        flat = np.frombuffer(self.aligner.links, np.int64) if len(self.aligner.links) else np.zeros(0, np.int64)
        begin = np.cumsum(figures[:, 3]) - figures[:, 3]
        sizes = np.array([len(h) for h in self.held], np.int64)
        ends = np.cumsum(np.append(0, sizes))
        parts, held = np.unique(np.concatenate(self.held), return_inverse=True)
        times = np.concatenate(self.times)
        n = figures[parts, 3]
        ptr = np.cumsum(np.append(0, n))
        pairs, at = np.unique(flat[multi_arange(begin[parts], n)], return_inverse=True)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        code = np.repeat(doc, n[held]) * max(1, len(pairs)) + at[multi_arange(ptr[held], n[held])]
        docs = np.bincount(np.unique(code) % max(1, len(pairs)), minlength=len(pairs))
        sums = np.cumsum(np.vstack([np.zeros((1, 4), np.int64), figures[parts[held]] * times[:, None]]), axis=0)
        rows = sums[ends[1:]] - sums[ends[:-1]]
        blobs = [_narrow(x).tobytes() for x in (sizes, held, times, n, at)]
        return [*rows.T, self.digests, *blobs, len(held), len(parts), len(at), pairs, docs]


BLOBS = ["sizes", "held", "times", "part_links", "link_pair"]
FIGURES = ["n_a", "n_b", "n_groups", "n_links"]


def blocks(docs: DataFrame, id_col: str, text_col: str, path_a: str, path_b: str) -> DataFrame:
    """One row per block: its number, arrays of its documents' figures, packed places, and arrays of
    its distinct pairs and how many of its documents hold each."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["block", "ids", *FIGURES, "groups_sha256", *BLOBS, "n_held", "n_parts", "n_all", "pairs", "docs"]

    def read(batches):
        from pyspark import TaskContext

        aligner, number = aligner_of(path_a, path_b), TaskContext.get().partitionId() << 32
        block = Block(aligner)

        def done(kind):
            figures = block.columns()
            cols = [pa.array([number], pa.int64()), pa.array([block.ids], pa.list_(kind))]
            cols += [pa.array([f], pa.list_(pa.int64())) for f in figures[:4]] + [pa.array([figures[4]], pa.list_(pa.string()))]
            cols += [pa.array([f], pa.binary()) for f in figures[5:10]] + [pa.array([f], pa.int64()) for f in figures[10:13]]
            return pa.RecordBatch.from_arrays(cols + [pa.array([f], pa.list_(pa.int64())) for f in figures[13:]], names)

        for batch in batches:
            id_type = batch.column(0).type
            for id_value, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                block.add(id_value, text.as_py())
                if block.chars >= BLOCK_CHARS:
                    yield done(id_type)
                    block, number = Block(aligner), number + 1
        if block.ids:
            yield done(id_type)

    lists = ", ".join(f"{f} array<long>" for f in FIGURES)
    rest = ", ".join(f"{b} binary" for b in BLOBS)
    schema = f"block long, ids array<{kind}>, {lists}, groups_sha256 array<string>, {rest}, n_held long, n_parts long, n_all long, pairs array<long>, docs array<long>"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(read, schema)


def pair_counts(made: DataFrame) -> DataFrame:
    """(pair, total, best): in how many documents each pair of ids is linked, and whether no pair of
    its A id is in more."""
    each = made.select(F.explode(F.arrays_zip("pairs", "docs")).alias("x"))
    total = stored(each.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.docs").alias("total")))
    token = F.shiftright("pair", 32)
    top = total.groupBy(token.alias("token")).agg(F.max("total").alias("top"))
    return total.join(top, token == F.col("token")).select("pair", "total", (F.col("total") == F.col("top")).alias("best"))


def token_alignment(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row per row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A text is encoded whole, without special tokens (their strings are plain text): a space and the
    text by A, the text by B. Null and empty texts, and those whose tokens do not spell a space and the text,
    have zeros and an empty digest. A null id is kept; repeated rows count as documents each; an empty
    table gives no row. Other columns are not read. Very long texts are a block of their own.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    made = stored(blocks(docs, id_col, text_col, path_a or tokenizer_path(TOKENIZER_A), path_b or tokenizer_path(TOKENIZER_B)))
    asked = made.select("block", F.posexplode("pairs").alias("pos", "pair"))
    answers = asked.join(pair_counts(made), "pair").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("pos", "total", "best"))).alias("x"))
    answers = answers.select("block", F.col("x.total").alias("totals"), F.transform("x.best", lambda b: b.cast("int")).alias("bests"))
    both = made.drop("pairs", "docs").join(answers, "block", "left")
    names = ["id", *FIGURES, "n_best", "count_sum", "groups_sha256"]

    def summed(batches):
        for batch in batches:
            for k in range(len(batch)):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                sizes, held, times, part_links, link_pair = (_wide(row[b].as_py(), n) for b, n in zip(BLOBS, (len(row["ids"]), *[row[c].as_py() for c in ("n_held", "n_held", "n_parts", "n_all")])))
                ptr, ends = np.cumsum(np.append(0, part_links)), np.cumsum(np.append(0, sizes))
                sums = []
                for c in ("bests", "totals"):
                    of = row[c].values.to_numpy().astype(np.int64) if row[c].is_valid else np.zeros(0, np.int64)
                    links = np.cumsum(np.append(0, of[link_pair]))
                    docs_of = np.cumsum(np.append(0, (links[ptr[1:]] - links[ptr[:-1]])[held] * times))
                    sums.append(pa.array(docs_of[ends[1:]] - docs_of[ends[:-1]]))
                yield pa.RecordBatch.from_arrays([row["ids"].values, *(row[f].values for f in FIGURES), *sums, row["groups_sha256"].values], names)

    figures = ", ".join(f"{f} long" for f in FIGURES)
    return both.mapInArrow(summed, f"id {kind}, {figures}, n_best long, count_sum long, groups_sha256 string").withColumnRenamed("id", id_col)
