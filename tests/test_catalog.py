"""Every query with SQL against DuckDB on the same tables, and a few with known answers."""

import math
import os

import duckdb
import pytest

from strandmill import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda k: names[k])

    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else f"{v:.6f}"
        if isinstance(v, bool) or v is None:
            return str(v)
        if isinstance(v, int):
            return f"{v:.6f}"
        return str(v)

    return sorted(tuple(value(r[k]) for k in order) for r in rows), [names[k] for k in order]


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, name):
    got = catalog.queries()[name](spark, SF)
    rows, names = canonical([tuple(r) for r in got.collect()], got.columns)
    assert rows
    if sql := catalog.oracle_sql().get(name):
        c = duckdb.connect()
        for t in TABLES:
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        want = c.execute(sql)
        cols = [x[0] for x in want.description]
        assert (rows, names) == canonical(want.fetchall(), cols)


@pytest.mark.parametrize("k,n,p", [(43, 69, 0.0533), (44, 69, 0.0295), (41, 69, 0.1480), (62, 99, 0.0154), (32, 99, 0.0006)])
def test_sign_test_known(spark, k, n, p):
    from strandmill.operators.stats import sign_test

    assert abs(sign_test(spark.createDataFrame([(k, n)], "k long, n long"), "k", "n").first().p - p) < 5e-5


def test_superposition_of_moved_and_mirrored_points(spark):
    import numpy as np

    from strandmill.operators.geometry import superpose_rmsd

    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 3)) * 10
    q, _ = np.linalg.qr(rng.normal(size=(3, 3)))
    q *= np.linalg.det(q)
    rows = [(1, *a, *b) for a, b in zip((x @ q + 50).tolist(), x.tolist())] + [(2, *a, *b) for a, b in zip((x * [1, 1, -1]).tolist(), x.tolist())]
    out = {r.g: r for r in superpose_rmsd(spark.createDataFrame(rows, "g int, px double, py double, pz double, tx double, ty double, tz double"), "g").collect()}
    assert out[1].rmsd < 1e-4 and out[2].rmsd > 5 and out[2].rmsd_mirror < 1e-4


def test_structure_scores_of_moved_mirrored_and_small_groups(spark):
    import numpy as np

    from strandmill.operators.geometry import structure_scores

    rng = np.random.default_rng(5)
    x = rng.normal(size=(40, 3)) * 10
    q, _ = np.linalg.qr(rng.normal(size=(3, 3)))
    q *= np.linalg.det(q)
    moved = x.copy()
    moved[30:] += [1.0, 0, 0]  # the scored points stand 1 beside their place
    sets = {1: (moved @ q + 50, x), 2: ((x * [1, 1, -1]) @ q, x), 3: (x[:2], x[:2])}
    rows = [(g, k < 30, *a, *b) for g, (p, t) in sets.items() for k, (a, b) in enumerate(zip(p.tolist(), t.tolist()))]
    df = spark.createDataFrame(rows, "g int, fit boolean, px double, py double, pz double, tx double, ty double, tz double")
    out = {r.g: r for r in structure_scores(df, "g", "fit").collect()}
    assert abs(out[1].transfer_rmsd - 1) < 1e-3 and out[1].fit_rmsd < 1e-3 and not out[1].mirrored and out[1].n_scored == 10
    assert out[2].mirrored and out[2].mirror_rmsd < 1e-3
    assert out[3].reason and out[3].fit_rmsd is None


def best_score(a, b, match=5, mismatch=-4):
    """The best local score by trying every gap length at every place."""
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    gap = lambda n: -11 - (n - 1)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d = h[i - 1][j - 1] + (match if a[i - 1] == b[j - 1] else mismatch)
            h[i][j] = max([0, d, *(h[i - n][j] + gap(n) for n in range(1, i + 1)), *(h[i][j - n] + gap(n) for n in range(1, j + 1))])
    return max(map(max, h))


def test_local_alignment_against_all_gap_lengths():
    import random

    from strandmill.operators.alignment import local_align, local_aligns

    rng = random.Random(4)
    for _ in range(60):
        a = "".join(rng.choices("ACD", k=rng.randint(1, 25)))
        cut = rng.randint(0, len(a))
        b = a[:cut] + "".join(rng.choices("ACD", k=rng.randint(0, 6))) + a[min(len(a), cut + rng.randint(0, 3)) :]
        if b:
            score, identity, length = local_align(a, b)
            assert score == best_score(a, b) and 0 <= identity <= 1 and length <= len(a) + len(b)
    words = ["", "A", "ACDA", "ACXDACCA" * 9, "DDAC" * 3]
    a, b = zip(*[(x, y) for x in words for y in words])
    assert local_aligns(list(a), list(b)) == [local_align(x, y) for x, y in zip(a, b)]
    assert local_align("", "A") == (0, 0.0, 0) and local_align("ACDA", "ACDA") == (20, 1.0, 4)


def traced(a, b, score, gap_open=-11, gap_extend=-1):
    """(score, identity, length) by cells that carry (score, same, size) of the path they end."""
    def better(p, q):
        return q if q[0] > p[0] else p

    none = (0, 0, 0)
    h = [[none] * (len(b) + 1) for _ in range(len(a) + 1)]
    down = [(-(10**6), 0, 0)] * (len(b) + 1)
    best = none
    for i in range(1, len(a) + 1):
        along = (-(10**6), 0, 0)
        for j in range(1, len(b) + 1):
            step = lambda p, cost: (p[0] + cost, p[1], p[2] + 1)
            along = better(step(h[i][j - 1], gap_open), step(along, gap_extend))
            down[j] = better(step(h[i - 1][j], gap_open), step(down[j], gap_extend))
            d = h[i - 1][j - 1]
            cell = better(better((d[0] + score(a[i - 1], b[j - 1]), d[1] + (a[i - 1] == b[j - 1]), d[2] + 1), down[j]), along)
            h[i][j] = cell if cell[0] > 0 else none
            best = better(best, h[i][j])
    return best[0], best[1] / best[2] if best[2] else 0.0, best[2]


MATRIX = """# a made-up table
   A  C  D
A  4 -1 -2
C -1  9 -3
D -2 -3  6
"""


def test_local_alignment_by_a_table():
    import random

    from strandmill.operators.alignment import Substitution, local_aligns

    table = Substitution.parse(MATRIX)
    rows = {(r, c): int(v) for r, line in zip("ACD", MATRIX.splitlines()[2:]) for c, v in zip("ACD", line.split()[1:])}
    score = lambda p, q: rows.get((p, q), 0 if "X" in (p, q) and {p, q} <= set("ACDX") else -4)
    rng = random.Random(9)
    texts = ["".join(rng.choices("ACDXZ", k=rng.randint(0, 30))) for _ in range(60)]
    texts += [t[:7] + t[9:] for t in texts[:30]]
    a, b = texts, texts[::-1]
    a, b = a + texts[:30], b + texts[60:]
    got = local_aligns(a, b, table=table)
    assert [g[0] for g in got] == [traced(p, q, score)[0] for p, q in zip(a, b)]
    assert got == local_aligns(a, b, table=Substitution({(p, q): v for (p, q), v in rows.items() if p <= q}))
    assert local_aligns(["AXDC"], ["ACDC"], table=table) == [(4 + 0 + 6 + 9, 0.75, 4)]
    with pytest.raises(ValueError):
        Substitution({("A", "A"): 1}, other=0)


def test_alignment_queries_against_brute_force(spark):
    """Every pair of an entry, aligned cell by cell, against both queries over their whole tables."""
    from collections import defaultdict

    chains, entities = (df.toPandas() for df in catalog._sequences(spark, SF))
    of = defaultdict(dict)
    for r in entities.sort_values("ent").itertuples():
        of[r.entry][r.seq] = r.ent
    score = lambda p, q: 5 if p == q else -4
    known, pairs, best = {}, set(), {}
    for entry, x in set(zip(chains.entry, chains.seq)):
        for y, ent in of[entry].items():
            pairs.add((x, y))
            _, identity, size = known.setdefault((x, y), traced(x, y, score))
            value = identity * size / min(len(x), len(y))
            if value >= 0.8:
                best[entry, x] = min(best.get((entry, x), (0, 0)), (-value, ent))
    got = catalog.queries()["seq_local_alignment"](spark, SF).collect()
    assert len(got) == len(pairs) and {(r.x, r.y): (r.score, r.length) for r in got} == {k: (known[k][0], known[k][2]) for k in pairs}
    out = catalog.queries()["join_alignment_fallback"](spark, SF).collect()
    assert {(r.entry, r.x): (r.ent, round(r.value, 9)) for r in out} == {k: (ent, round(-v, 9)) for k, (v, ent) in best.items()}


def test_match_cascade_stages(spark):
    from strandmill.operators.alignment import match_cascade

    long = "ACDEFGHIKLMNPQRSTVWY" * 3
    e = spark.createDataFrame([(1, 7, long), (1, 8, "AACCA"), (1, 9, "AACCA"), (2, 1, long)], "entry int, ent int, seq string")
    seqs = ["AACCA", "AXCCA", long[:40] + long[43:], "WWWWW", "", None]
    out = match_cascade(spark.createDataFrame([(1, k, s) for k, s in enumerate(seqs)], "entry int, k int, seq string"), e, "entry", "seq", "ent")
    got = {r.k: (r.ent, r.evidence) for r in out.collect()}
    assert got == {0: (9, "exact"), 1: (9, "wildcard"), 2: (7, "alignment"), 3: (None, "unmatched"), 4: (None, "unmatched"), 5: (None, "unmatched")}


def test_rows_without_a_date_are_no_leak(spark):
    from strandmill.operators.windows import keep_split
    from strandmill.sources import tables

    rows = [(1, "a", "test"), (2, "a", "train"), (3, "b", "unknown"), (4, None, "train"), (5, None, "validation"), (6, "a", None)]
    df = spark.createDataFrame(rows, "id int, k string, split string")
    got = {r.id: (r.action, r.kept_in) for r in keep_split(df, ["k"], "split", catalog.RANKS).collect()}
    assert got == {1: ("keep", "test"), 2: ("drop", "test"), 3: ("undated", None), 4: ("drop", "validation"), 5: ("keep", "validation"), 6: ("undated", "test")}
    a, b = tables.write_splits(df.select("id", "split"), tables.shared_path(spark), "split", "test")
    assert sorted(r.id for r in spark.read.parquet(a).collect()) == [2, 3, 4, 5, 6] and [r.id for r in spark.read.parquet(b).collect()] == [1]


def test_homology_of_short_and_unknown_lengths(spark):
    from pyspark.sql import functions as F

    from strandmill.operators.rules import homology_role

    rows = [(0.5, 40, False), (0.5, None, False), (0.5, 200, False), (0.5, 350, True), (0.5, 350, None), (0.5, 500, False), (0.2, 40, False), (None, 200, False), (0.25, 400, False)]
    out = spark.createDataFrame(rows, "s double, n int, f boolean").select(homology_role(F.col("s"), F.col("n"), F.col("f")).alias("r")).collect()
    assert [r.r.role for r in out] == [None, None, "heavy", "fusion", "heavy", "fusion", "other", None, "heavy"]


def test_global_alignment_against_recursion():
    import functools
    import random

    from strandmill.operators.alignment import global_align

    rng = random.Random(2)
    for _ in range(40):
        a, b = ("".join(rng.choices("ACD", k=rng.randint(0, 9))) for _ in range(2))

        @functools.cache
        def best(i, j):
            if not i or not j:
                return -3 * (i + j)
            return max(best(i - 1, j - 1) + (2 if a[i - 1] == b[j - 1] else -1), best(i - 1, j) - 3, best(i, j - 1) - 3)

        pairs = global_align(a, b)
        assert pairs == sorted(pairs) and len({i for i, _ in pairs}) == len({j for _, j in pairs}) == len(pairs)
        assert sum(2 if a[i] == b[j] else -1 for i, j in pairs) - 3 * (len(a) + len(b) - 2 * len(pairs)) == best(len(a), len(b))


def test_reflection_and_truth_deviation(spark):
    import numpy as np

    from strandmill.operators.geometry import superpose_reflect, transfer_rmsd, truth_deviation

    x = np.random.default_rng(3).normal(size=(40, 3)) * 10
    other = x.copy()
    other[20:] += [40.0, 0, 0]
    sets = {1: (x + 50, x), 2: (x * [1, 1, -1], x), 3: (other, x), 4: (x[:2], x[:2])}
    rows = [(g, k < 20, *a, *b) for g, (p, t) in sets.items() for k, (a, b) in enumerate(zip(p.tolist(), t.tolist()))]
    df = spark.createDataFrame(rows, "g int, fit boolean, px double, py double, pz double, tx double, ty double, tz double")
    reflect = {r.g: r for r in superpose_reflect(df, "g").collect()}
    assert not reflect[1].mirrored and reflect[2].mirrored and reflect[2].rmsd_reflect < 1e-4
    truth = {r.g: r for r in truth_deviation(df, "g").collect()}
    assert truth[1].deviation < 1e-4 and not truth[1].swapped and truth[3].swapped and truth[4].deviation is None
    moved = {r.g: r for r in transfer_rmsd(df, "g", "fit").collect()}
    assert moved[3].fit_rmsd < 1e-4 and abs(moved[3].transfer_rmsd - 40) < 1e-3 and moved[4].reason


def test_ranks_of_ties_nulls_and_a_null_group(spark):
    from pyspark.sql import functions as F

    from strandmill.operators import ranks

    rows = [(g, x) for g, xs in {"a": [3.0, 1.0, 1.0, None, 1.0, 2.0], None: [5.0], "b": [4.0, 8.0]}.items() for x in xs] + [("c", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {(r.g, r.x): (r.n, r.below, r.size) for r in ranks.ranked(df, ["g"], "x").collect()}
    assert got == {("a", 1.0): (3, 0, 5), ("a", 2.0): (1, 3, 5), ("a", 3.0): (1, 4, 5), (None, 5.0): (1, 0, 1), ("b", 4.0): (1, 0, 2), ("b", 8.0): (1, 1, 2)}
    assert {r.g: r.m for r in ranks.medians(df, ["g"], {"m": F.col("x")}).collect()} == {"a": 1.0, None: 5.0, "b": 6.0}
    assert ranks.medians(df.where("false"), ["g"], {"m": F.col("x")}).count() == 0


def test_sign_test_of_many_rows(spark):
    from strandmill.operators import stats

    df = spark.createDataFrame([(0, 0), (0, 5), (5000, 10000), (4900, 10000)], "k long, n long")
    got = [r.p for r in stats.sign_test(df, "k", "n").collect()]
    assert got[0] == 1.0 and abs(got[1] - 0.0625) < 1e-12 and got[2] == 1.0 and abs(got[3] - 0.0466) < 5e-4
