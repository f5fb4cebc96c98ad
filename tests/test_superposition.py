"""Superposition by sums and a quartic against singular values, and whole score rows."""

import math

import numpy as np
import pytest

from strandmill.operators import geometry


def kabsch(p, t, q=None, u=None, reflect=False):
    """RMSD of q on u under the motion that fits p on t, by singular values."""
    pc, tc = p.mean(0), t.mean(0)
    a, s, b = np.linalg.svd((p - pc).T @ (t - tc))
    d = 1.0 if np.linalg.det(a @ b) > 0 or reflect else -1.0
    r = a @ np.diag([1, 1, d]) @ b
    q, u = (p, t) if q is None else (q, u)
    return float(np.sqrt((((q - pc) @ r + tc - u) ** 2).sum() / len(q)))


def frame(spark, groups):
    rows = [(g, bool(f), *map(float, a), *map(float, b)) for g, (p, t, fit) in groups.items() for a, b, f in zip(p, t, fit)]
    return spark.createDataFrame(rows, "g int, fit boolean, px double, py double, pz double, tx double, ty double, tz double")


def test_random_and_degenerate_groups(spark):
    rng = np.random.default_rng(11)
    groups = {}
    for g in range(40):
        n = int(rng.integers(3, 60))
        t = rng.normal(size=(n, 3)) * 10 + 100
        groups[g] = (t + rng.normal(size=(n, 3)) * rng.choice([0.01, 1, 30]), t, np.arange(n) < max(3, n // 2))
    flat = rng.normal(size=(20, 3)) * [10, 10, 0]
    line = np.outer(np.arange(20), [1.0, 2, 3])
    groups |= {100: (flat + rng.normal(size=(20, 3)) * [1, 1, 0], flat, np.arange(20) < 10), 101: (line + 5, line, np.arange(20) < 10), 102: (flat[:1], flat[:1] + 3, [True]), 103: (flat * 0 + 2, flat * 0 - 7, [True] * 20)}
    df = frame(spark, groups)
    got = {r.g: r for r in geometry.superpose_rmsd(df, "g").collect()}
    for g, (p, t, _) in groups.items():
        want = kabsch(np.asarray(p), np.asarray(t))
        assert abs(got[g].rmsd - want) < (2e-3 if g == 101 else 1e-5), g
    for g in range(40):
        p, t, _ = groups[g]
        mirror = kabsch(p * [1, 1, -1], t)
        assert abs(got[g].rmsd_mirror - mirror) < 1e-5
    moved = {r.g: r for r in geometry.transfer_rmsd(df, "g", "fit").collect()}
    for g in [*range(40), 100]:
        p, t, fit = (np.asarray(x) for x in groups[g])
        if (~fit).any():
            assert abs(moved[g].transfer_rmsd - kabsch(p[fit], t[fit], p[~fit], t[~fit])) < 1e-5, g
    assert moved[101].transfer_rmsd is None and moved[101].reason == "fit points on a line"
    assert moved[102].reason == "too few points" and moved[103].n_scored == 0 and moved[103].transfer_rmsd is None


@pytest.fixture(scope="module")
def scored(spark):
    """A random walk of a heavy chain of 200, another of 100 and a peptide of 9; two samples: exact but
    for the peptide 1 away, and turned and noisy. One record mirrored, one unresolved, some odd."""
    rng = np.random.default_rng(4)
    walk = np.cumsum(rng.normal(size=(309, 3)) * 2, axis=0)
    chain = ["H"] * 200 + ["L"] * 100 + ["P"] * 9
    pos = [*range(200), *range(100), *range(9)]
    ok = [not (c == "H" and k < 3 or c == "P" and k == 4) for c, k in zip(chain, pos)]
    turn, _ = np.linalg.qr(rng.normal(size=(3, 3)))
    turn *= np.linalg.det(turn)
    first = walk.copy()
    first[300:] += [1.0, 0, 0]
    second = walk @ turn + 7 + rng.normal(size=walk.shape) * 0.3
    records = {"a": (first, second, ok, chain), "m": (walk * [1, 1, -1], walk, ok, chain), "u": (walk, walk, [c != "H" for c in chain], chain), "one": (walk, walk, ok, ["H"] * 309), "few": (walk, walk, [k < 2 or c != "P" for c, k in zip(chain, pos)], chain), "long": (walk, walk, ok, ["P" if c == "L" else c for c in chain])}
    rows = []
    for name, (*samples, good, chains) in records.items():
        for s, pred in enumerate(samples):
            rows += [(name, s, c, k, bool(g), *map(float, p), *map(float, t)) for c, k, g, p, t in zip(chains, pos, good, pred, walk)]
    df = spark.createDataFrame(rows, "record string, sample int, chain string, pos int, ok boolean, px double, py double, pz double, tx double, ty double, tz double")
    return records, walk, {r.record: r for r in geometry.score_rows(df.repartition(5), "record", "sample", "chain", "pos", "ok").collect()}


def test_score_row_of_known_structures(scored):
    records, walk, rows = scored
    r, (first, second, ok, chain) = rows["a"], records["a"]
    assert (r.hc_len, r.pep_len, r.n_protein_chains, r.groove_start, r.n_groove_ca, r.n_pep_ca, r.n_all_ca, r.reason) == (200, 9, 3, 3, 180, 8, 305, None)
    assert abs(r.pep_rmsd[0] - 1) < 1e-4 and r.groove_rmsd[0] < 1e-3 and r.pep_internal[0] < 1e-3
    ok = np.array(ok)
    g, p = ok & (np.arange(309) < 183), ok & (np.arange(309) >= 300)
    want = [kabsch(second[g], walk[g], second[p], walk[p]), kabsch(second[p], walk[p]), kabsch(second[g], walk[g]), kabsch(second[ok], walk[ok])]
    assert all(abs(getattr(r, c)[1] - w) < 1.1e-4 for c, w in zip(("pep_rmsd", "pep_internal", "groove_rmsd", "ca_rmsd"), want))
    assert r.pep_rmsd_best == min(r.pep_rmsd) and abs(r.pep_rmsd_mean - sum(r.pep_rmsd) / 2) < 1e-4
    m = rows["m"]
    assert m.ca_rmsd[0] > 5 and m.ca_rmsd_mirror[0] < 1e-3 and m.ca_rmsd[1] < 1e-3


def test_records_that_cannot_be_scored_keep_their_row(scored):
    _, _, rows = scored
    assert {k: r.reason for k, r in rows.items() if r.reason} == {"u": "heavy chain unresolved", "one": geometry.ODD_CHAINS, "few": "fewer than three resolved residues", "long": geometry.ODD_CHAINS}
    assert all(r.pep_rmsd is None and r.pep_rmsd_best is None and r.pep_rmsd_mean is None for r in rows.values() if r.reason)
    assert rows["few"].n_pep_ca == 2 and rows["one"].n_pep_ca is None and rows["long"].pep_len == 109


def test_steps_settle_for_double_roots():
    x = math.sqrt(3)
    for _ in range(geometry.STEPS):  # a line: d = e = 0, roots 1, 1, -1, -1
        f, slope = (x * x - 2) * x * x + 1, 4 * (x * x - 1) * x
        x = x - f / slope if f > 0 and slope > 0 else x
    assert abs(x - 1) < 1e-7
