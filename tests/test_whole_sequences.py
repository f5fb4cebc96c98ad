"""Sequences longer than any default are aligned to their ends."""

import random
from collections import Counter, defaultdict

import pytest

from strandmill import catalog
from strandmill.operators import alignment


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Orders and lines of customers with some 600 lines each, two entries."""
    rng, d = random.Random(21), str(tmp_path_factory.mktemp("long"))
    orders, lines = [], []
    for cust, n in ((0, 620), (1, 610), (2, 640), (3, 600), (6, 690), (20, 90), (22, 700), (23, 450)):
        for k in range(n):
            if k % 7 == 0:
                orders.append((len(orders), cust))
            lines.append((orders[-1][0], k % 7 + 1, rng.randrange(2000), float(rng.randint(1, 50))))
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double").write.parquet(f"{d}/lineitem.parquet")
    return d


def in_reach(spark, tables):
    """(cust, sequence, known) with what each chain's entry knows within reach of its length."""
    chains, entities = (df.toPandas() for df in catalog.long_sequences(spark, tables))
    of = defaultdict(dict)
    for r in entities.sort_values("ent").itertuples():
        of[r.entry][r.seq] = r.ent
    return [(r.cust, r.seq, {y: k for y, k in of[r.entry].items() if abs(len(y) - len(r.seq)) <= max(60, 0.5 * len(r.seq))}) for r in chains.itertuples()]


def test_cascade_aligns_long_sequences_whole(spark, tables):
    got = {r.cust: (r.ent, r.value, r.evidence) for r in catalog.queries()["join_match_cascade_long"](spark, tables).collect()}
    assert len(got) == 8 and {c: got[c][2] for c in (0, 1, 20)} == {0: "exact", 1: "wildcard", 20: "exact"}
    for cust, x, known in in_reach(spark, tables):
        if cust in (0, 1, 20):
            continue
        found = [(-i * n / min(len(x), len(y)), k) for (y, k), (_, i, n) in zip(known.items(), alignment.local_aligns([x] * len(known), list(known)))]
        found = [f for f in found if f[0] <= -0.8]
        assert got[cust] == ((min(found)[1], round(-min(found)[0], 6), "alignment") if found else (None, None, "unmatched"))
    # chains without a tenth of their entity's lines, more than 500 of them left
    assert all(got[c][0] == c and got[c][1] > 0.95 and got[c][2] == "alignment" for c in (2, 6, 22))


def test_share_counts_pairs_by_whole_sequences(spark, tables):
    pairs = {(x, y) for _, x, known in in_reach(spark, tables) for y in known}
    need = lambda x, y: 0.8 * min(len(x), len(y)) - 1e-9
    letters = {(x, y) for x, y in pairs if (Counter(x) & Counter(y)).total() >= need(x, y)}
    order = {(x, y) for x, y in letters if alignment.common_order(x, y) >= need(x, y)}
    assert tuple(catalog.queries()["join_alignment_share"](spark, tables).first()) == (len(pairs), len(letters), len(order))
    assert sum(min(map(len, p)) > 500 for p in order) > 3


def test_entity_is_chosen_by_whole_sequences(spark):
    rng = random.Random(22)
    x = "".join(rng.choices("ACDEFG", k=480))
    known = [(1, 1, x[:400] + "P" * 80), (1, 2, "Q" * 60 + x[60:])]
    e = spark.createDataFrame(known, "entry int, ent int, seq string")
    r = alignment.match_cascade(spark.createDataFrame([(1, x)], "entry int, seq string"), e, "entry", "seq", "ent").first()
    assert (r.ent, r.value, r.evidence) == (2, 420 / 480, "alignment")


def test_blocks_of_long_pairs_are_small(monkeypatch):
    rng = random.Random(23)
    a, b = (["".join(rng.choices("ACDE", k=rng.randint(0, 90))) for _ in range(200)] for _ in range(2))
    want = [alignment.local_align(p, q) for p, q in zip(a, b)]
    sizes, whole = [], alignment._align_block
    monkeypatch.setattr(alignment, "_align_block", lambda p, q, *rest: sizes.append((len(p), max(map(len, p + q)))) or whole(p, q, *rest))
    monkeypatch.setattr(alignment, "BLOCK_CELLS", 400)
    assert alignment.local_aligns(a, b) == want
    assert all(n == 1 or n * longest <= 400 for n, longest in sizes) and max(n for n, _ in sizes) > 1
