"""Bounds before alignment, alignment in little memory, and reports with reasons."""

import json
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np

from pyspark.sql import functions as F

from strandmill import catalog
from strandmill.operators import alignment
from strandmill.sources import tables

SF = "/root/testdata/sf0.001"


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_bounds_are_never_below_the_equal_places_of_an_alignment(spark):
    rng = random.Random(6)
    pairs = [("", ""), ("", "AC"), ("A" * 70, "A" * 70), ("ACCA", "CAAC")]
    for _ in range(120):
        a = "".join(rng.choices("ACDEX", k=rng.randint(1, 90)))
        cut = rng.randint(0, len(a))
        pairs.append((a, a[:cut] + "".join(rng.choices("ACDEX", k=rng.randint(0, 9))) + a[min(len(a), cut + rng.randint(0, 9)) :]))
    order = [alignment.common_order(a, b) for a, b in pairs]
    assert order == [longest(a, b) for a, b in pairs]
    df = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "k int, a string, b string")
    letters = {r.k: r.n for r in df.select("k", alignment.common_letters(df.a, df.b).alias("n")).collect()}
    assert [letters[k] for k in range(len(pairs))] == [(Counter(a) & Counter(b)).total() for a, b in pairs]
    for k, (_, identity, length) in enumerate(alignment.local_aligns(*map(list, zip(*pairs)))):
        assert round(identity * length) <= order[k] <= letters[k]


def test_pairs_that_the_bounds_leave_are_all_that_reach_the_share(spark):
    """Over every pair of an entry, and over sequences longer than what is aligned."""
    rng = random.Random(9)
    base = ["".join(rng.choices("ACDEFGHIKL", k=n)) for n in (30, 80, 450, 520)]
    pairs = [(p, q[: len(q) - rng.randint(0, 9)]) for p in base for q in base] + [("".join(c for c in p if rng.random() < share), p) for p in base for share in (0.97, 0.9, 0.7)]
    df = spark.createDataFrame([(p, q) for p, q in pairs if p and q], "x string, y string")
    for aligned in (400, None):
        value = lambda r: r.identity * r.length / min(len(r.x), len(r.y))
        every = {(r.x, r.y): value(r) for r in alignment.align_pairs(df, aligned=aligned).collect()}
        few = {(r.x, r.y): value(r) for r in alignment.align_pairs(df, aligned=aligned, least=0.8).collect()}
        assert {k: v for k, v in every.items() if v >= 0.8} == {k: v for k, v in few.items() if v >= 0.8}
        share = alignment.aligned_share(df, aligned=aligned).first()
        assert share.by_order == len(few) and share.pairs == len(every) and share.by_order <= share.by_letters <= share.pairs
        assert len(few) < len(every)


def test_cascade_of_long_sequences_against_aligning_every_pair(spark):
    chains, entities = (df.toPandas() for df in catalog.long_sequences(spark, SF))
    of = defaultdict(dict)
    for r in entities.sort_values("ent").itertuples():
        of[r.entry][r.seq] = r.ent
    want = {}
    for r in chains.itertuples():
        known = of[r.entry]
        if r.seq in known:
            want[r.cust] = (known[r.seq], "exact")
            continue
        near = []
        for y, ent in known.items():
            used = [(p, q) for p, q in zip(r.seq, y) if "X" not in p + q]
            if len(y) == len(r.seq) and used:
                near.append((-sum(p == q for p, q in used) / len(used), ent))
        near = [n for n in near if n[0] <= -0.9]
        if near:
            want[r.cust] = (min(near)[1], "wildcard")
            continue
        ys = [y for y in known if abs(len(y) - len(r.seq)) <= max(60, 0.5 * len(r.seq))]
        found = alignment.local_aligns([r.seq[:400]] * len(ys), [y[:400] for y in ys])
        values = [(-identity * n / min(len(r.seq), len(y)), known[y]) for y, (_, identity, n) in zip(ys, found)]
        values = [v for v in values if v[0] <= -0.8]
        want[r.cust] = (min(values)[1], "alignment") if values else (None, "unmatched")
    out = catalog.queries()["join_match_cascade_long"](spark, SF).collect()
    assert {r.cust: (r.ent, r.evidence) for r in out} == want and len(out) == len(chains)
    assert {e for _, e in want.values()} == {"exact", "wildcard", "alignment", "unmatched"}
    share = catalog.queries()["join_alignment_share"](spark, SF).first()
    assert 0 < share.by_order < share.by_letters <= share.pairs


def whole_table(a, b, match=2, mismatch=-1, gap=-3):
    score = np.zeros((len(a) + 1, len(b) + 1), int)
    score[:, 0], score[0] = gap * np.arange(len(a) + 1), gap * np.arange(len(b) + 1)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            score[i + 1, j + 1] = max(score[i, j] + (match if x == y else mismatch), score[i, j + 1] + gap, score[i + 1, j] + gap)
    i, j, pairs = len(a), len(b), []
    while i and j:
        if score[i, j] == score[i - 1, j - 1] + (match if a[i - 1] == b[j - 1] else mismatch):
            i, j = i - 1, j - 1
            pairs.append((i, j))
        elif score[i, j] == score[i - 1, j] + gap:
            i -= 1
        else:
            j -= 1
    return pairs[::-1]


def test_global_alignment_in_stretches_equals_the_whole_table():
    rng = random.Random(12)
    for _ in range(60):
        a, b = ("".join(rng.choices("ACD", k=rng.randint(0, 60))) for _ in range(2))
        assert alignment.global_align(a, b) == whole_table(a, b)
    assert alignment.global_align("", "AC") == alignment.global_align("AC", "") == []


def test_long_texts_are_mapped_in_little_memory():
    rng = random.Random(13)
    reference = "".join(rng.choices("ACDEFGHIKL", k=900))
    text = "".join(rng.choices("MNPQ", k=60_000)) + reference + "".join(rng.choices("MNPQ", k=39_100))
    tracemalloc.start()
    pairs = dict(alignment.global_align(reference, text))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6 and all(pairs[i] == 60_000 + i for i in range(900))


def test_stage_report_with_reasons(spark):
    rows = [(k, "a" if k % 2 else "b", "far" if k % 5 == 0 else "old" if k % 7 == 0 else None) for k in range(1, 101)] + [(None, None, "far"), (200, None, None)]
    df = spark.createDataFrame(rows, "id int, part string, why string")
    line, lost = tables.write_stage_report(df, tables.shared_path(spark), "part", "why", "id", k=2)
    got = json.loads(spark.read.text(line).first().value)
    cell = lambda p, w: [i for i, q, v in rows if q == p and v == w]
    assert got["rows"] == 102 and got["kept"] + got["dropped"] == 102 and got["by"] == {"": 1, "a": len(cell("a", None)), "b": len(cell("b", None))}
    for why in ("far", "old"):
        for part in ("a", "b"):
            assert got["reasons"][why][part] == {"n": len(cell(part, why)), "first": cell(part, why)[:2]}
    assert got["reasons"]["far"][""]["n"] == 1 and spark.read.json(lost).count() == got["dropped"]
    line, lost = tables.write_stage_report(df.limit(0), tables.shared_path(spark), "part", "why", "id")
    assert json.loads(spark.read.text(line).first().value) == {"rows": 0, "kept": 0, "dropped": 0, "by": {}, "reasons": {}}


def test_texts_are_mapped_side_by_side_in_many_tasks(spark):
    """A block of texts of any lengths equals the texts one by one; few bytes of texts are many tasks."""
    rng = random.Random(14)
    a = "".join(rng.choices("ACDE", k=40))
    texts = ["".join(rng.choices("ACDEé\U0001f926", k=rng.randint(0, 70))) for _ in range(300)] + [a, a[5:], "", "Z" * 90]
    for cells in (1, 3000, alignment.CELLS):
        most, alignment.CELLS = alignment.CELLS, cells
        try:
            got = alignment.global_aligns(a, texts)
        finally:
            alignment.CELLS = most
        assert [[(i, j) for i, j in enumerate(g.tolist()) if j >= 0] for g in got] == [alignment.global_align(a, t) for t in texts]
    assert [len(g) for g in alignment.global_aligns("", ["A", ""])] == [0, 0]
    positions = [3, 0, 39, 40, -1]
    df = spark.createDataFrame([(t,) for t in [*texts, *texts]] + [(None,)], "s string").coalesce(1)
    out = alignment.reference_mapping(df, "s", a, positions)
    want = set()
    for t in {*texts} - {""}:
        pairs = dict(alignment.global_align(a, t))
        n, same = sum(p in pairs for p in positions), sum(a[i] == t[j] for i, j in pairs.items()) / len(a)
        want |= {(t, p, pairs.get(p), n, same) for p in positions}
    rows = [tuple(r) for r in out.collect()]
    assert set(rows) == want and len(rows) == len(want)
    assert out.rdd.getNumPartitions() == 8


def test_bounds_of_many_pairs_at_once(spark):
    """Against one pair at a time, across words of 64 bits; pairs of an alignment are not shuffled."""
    rng = random.Random(15)
    texts = ["".join(rng.choices("ACDEé\U0001f926", k=n)) for n in (0, 1, 2, 30, 63, 64, 65, 127, 128, 129, 200, 450)] + ["A" * 64, "A" * 130, "AC" * 70]
    a, b = zip(*[(p, q) for p in texts for q in texts] * 2)
    few, alignment.BOUND_BYTES = alignment.BOUND_BYTES, 1 << 16
    try:
        found = [alignment.shared_bounds(a, b)]
    finally:
        alignment.BOUND_BYTES = few
    found.append(alignment.shared_bounds(a, b))
    for letters, order in found:
        assert letters.tolist() == [(Counter(p) & Counter(q)).total() for p, q in zip(a, b)]
        assert order.tolist() == [alignment.common_order(p, q) for p, q in zip(a, b)]
    e = spark.createDataFrame([(1, t, k) for k, t in enumerate(texts) if t] + [(2, texts[5], 99)], "entry int, y string, ent int")
    x = e.select("entry", F.concat("y", F.lit("A")).alias("x"))
    out = alignment.alignment_match(x, e, "entry", "ent")
    keys = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning(x" in line]
    assert not keys
    want = {}
    for entry, y, ent in (tuple(r) for r in e.collect()):
        for x1 in (t + "A" for t in (texts if entry == 1 else texts[5:6]) if t):
            _, identity, n = alignment.local_align(x1[:400], y[:400])
            if abs(len(x1) - len(y)) <= max(60, len(x1) / 2) and (value := identity * n / min(len(x1), len(y))) >= 0.8:
                want[entry, x1] = min(want.get((entry, x1), (0, 0)), (-value, ent))
    assert {(r.entry, r.x): (-r.value, r.ent) for r in out.collect()} == want and len(want) > 5
