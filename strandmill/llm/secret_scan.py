"""Secret scans with multipart credential linking.

Strong parts are reported by themselves. Weak parts (short identifiers, bare secrets, endpoints)
are interval-joined with the parts of their scope, a stretch of ``scope`` characters around them,
and reported only where a part that stands for something else is there.
"""

from __future__ import annotations

import bisect
import hashlib
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_A = re.ASCII | re.IGNORECASE
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", _A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: The order of kinds among spans with one start.
KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")
#: What each kind stands for; parts that stand for different things complement each other.
STANDS_FOR = {"assign": "secret", "access": "id", "hex": "secret", "weak_id": "id", "weak_secret": "secret", "endpoint": "endpoint"}
#: The patterns of weak parts.
WEAK = {
    "weak_id": re.compile(r"\b(?:AKIA[A-Z0-9]{8,15}|ASIA[A-Z0-9]{16,})(?![A-Z0-9])", re.ASCII),
    "weak_secret": re.compile(r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[a-z])(?=[A-Za-z0-9+/]*[A-Z])[A-Za-z0-9+/]{32,64}={0,2}(?![A-Za-z0-9+/=_-])", re.ASCII),
    "endpoint": re.compile(r"\b(?:https?|jdbc|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqp|s3)://[A-Za-z0-9.:@/_-]+", re.ASCII),
}
#: Literals of which a weak part of the kind holds one.
_HINTS = {"weak_id": ("AKIA", "ASIA"), "endpoint": ("://",)}


def base_spans(text: str) -> list[tuple[int, int, str]]:
    low, out = text.lower(), []
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


class Reach:
    """Intervals by start with the furthest end so far: whether one of them meets a given interval."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts, self.furthest = [], []
        for s, e in sorted(spans):
            self.starts.append(s)
            self.furthest.append(max(e, self.furthest[-1]) if self.furthest else e)

    def meets(self, low: int, high: int) -> bool:
        k = bisect.bisect_right(self.starts, high)
        return k > 0 and self.furthest[k - 1] >= low


def linked_spans(text: str, base: list[tuple[int, int, str]], scope: int) -> list[tuple[int, int, str]]:
    """Weak parts with a complementary part, strong or weak, at most ``scope`` characters away.

    Identifiers, secrets and endpoints complement each other, so two weak parts of different
    kinds near each other are both reported. A weak part that overlaps a base span is that span
    and is not repeated; parts that touch or overlap otherwise are at distance 0.
    """
    if not base and not any(h in text for hints in _HINTS.values() for h in hints):
        return []  # weak secrets alone complement nothing
    strong = Reach([(s, e - 1) for s, e, _ in base])
    weak = []
    for kind, pattern in WEAK.items():
        if kind in _HINTS and not any(h in text for h in _HINTS[kind]):
            continue
        weak += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if not strong.meets(m.start(), m.end() - 1)]
    of: dict[str, list[tuple[int, int]]] = {}
    for s, e, kind in base + weak:
        of.setdefault(STANDS_FOR[kind], []).append((s, e))
    reach = {role: Reach(spans) for role, spans in of.items()}
    return [(s, e, kind) for s, e, kind in weak if any(r.meets(s - scope, e + scope) for role, r in reach.items() if role != STANDS_FOR[kind])]


STRUCT = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]))))


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = 200) -> DataFrame:
    """One row per row of ``docs``: counts of base spans by kind, SHA-256 of their list, all spans
    as text and as an array of (kind, start, end) in code points.

    Null and empty texts have no spans (the digest is that of the empty string). Repeated rows give
    repeated results, rows without an id keep theirs, an empty table gives no row; other columns are
    not read. Nothing is shuffled.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def scan(batches):
        for batch in batches:
            rows = []
            for text in pc.fill_null(batch.column(1), "").to_pylist():
                base = base_spans(text)
                more = linked_spans(text, base, scope)
                counts = [sum(k == kind for _, _, k in base) for kind in KINDS[:3]]
                every = sorted(base + more, key=lambda x: (x[0], KINDS.index(x[2])))
                rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every), [{"kind": k, "start": s, "end": e} for s, e, k in every]))
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 3 + [pa.string()] * 2 + [STRUCT])], ["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "found"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, found array<struct<kind:string,start:long,end:long>>"
    return rows.mapInArrow(scan, schema).withColumnRenamed("id", id_col)
