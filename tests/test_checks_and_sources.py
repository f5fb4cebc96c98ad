"""Checks with offenders, structure files, JSON lines, curves and ranks on rows with known answers."""

import io
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandmill.functions import seq
from strandmill.operators import checks, ranks, rules, stats
from strandmill.sources import json_lines, structures, tables


def test_ranks_of_odd_numbers_equal_sorting(spark):
    rng = random.Random(6)
    odd = [0.0, -0.0, 5e-324, -5e-324, 2.2e-308, 1e308, -1e308, math.inf, -math.inf, math.nan, 1.0, math.nextafter(1, 2), math.nextafter(1, 0), 2.0**53, 2.0**53 + 2]
    values = odd + [rng.choice([-1, 1]) * rng.random() * 10 ** rng.randint(-30, 30) for _ in range(300)] + [100000 + rng.random() / 1e6 for _ in range(300)] + [7.5] * 100
    df = spark.createDataFrame([("a", v) for v in values] + [("b", None)], "g string, x double").repartition(4)
    order = sorted(values, key=lambda v: (math.isnan(v), v))
    wanted = {f"r{k}": k for k in (0, 3, len(values) // 2, len(values) - 2, len(values) - 1, *rng.sample(range(len(values)), 10))}
    got = ranks.at_ranks(df, ["g"], "x", {n: (lambda k: lambda c: F.lit(k))(k) for n, k in wanted.items()}).first()
    for name, k in wanted.items():
        assert got[name] == order[k] or math.isnan(got[name]) and math.isnan(order[k])
    finite = [v for v in values if not math.isnan(v)]
    for r in ranks.ranked(df.where("not isnan(x)"), ["g"], "x").collect():
        assert (r.below, r.n, r.size) == (sum(v < r.x for v in finite), sum(v == r.x for v in finite), len(finite))
    words = spark.createDataFrame([("a", w) for w in "pear fig fig kiwi".split()], "g string, x string")
    assert [tuple(r) for r in ranks.ranked(words, ["g"], "x").orderBy("x").collect()] == [("a", "fig", 2, 0, 4), ("a", "kiwi", 1, 2, 4), ("a", "pear", 1, 3, 4)]
    assert ranks.at_ranks(df.where("false"), ["g"], "x", {"m": ranks.UPPER_MIDDLE}).count() == 0


def test_order_statistics_run_nothing_before_they_are_asked(spark):
    seen = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    stats.order_stats(spark.createDataFrame([("a", 1.0)], "g string, x double"), "g", "x")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == seen


def test_three_copies_of_kept(spark):
    rows = [
        ("ok", [0, 2], [True, False, True], [(0, True), (1, False), (2, True)], [(0, 2, True), (0, 1, False)]),
        ("mask", [0, 2], [True, True, True], [(0, True), (1, False), (2, True)], []),
        ("chains", [0, 2], [True, False, True], [(0, True), (1, True), (2, True)], None),
        ("interfaces", [0, 2], [True, False, True], [(0, True), (1, False), (2, True)], [(0, 1, True)]),
        ("none", [], [False], [(0, False)], [(0, 0, False)]),
        ("null", None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "id string, keep array<int>, mask array<boolean>, chains array<struct<chain_id:int,valid:boolean>>, interfaces array<struct<chain_1:int,chain_2:int,valid:boolean>>")
    got = {r.id: (r.mask_ok, r.chains_ok, r.interfaces_ok, r.passed) for r in checks.flag_consistency(df, "id", "keep", "mask", "chains", "interfaces").collect()}
    assert got == {"ok": (True,) * 4, "mask": (False, True, True, False), "chains": (True, False, True, False), "interfaces": (True, True, False, False), "none": (True,) * 4, "null": (False, False, True, False)}


def test_arrays_hold_together(spark):
    good = [(0, 5, True, 0, 10, 0, 2), (1, 7, False, 10, 4, 2, 1), (2, 9, True, 14, 6, 3, 3)]
    cases = {"good": (good, 3, [0, 2], 20, 6), "mask": (good, 4, [0, 2], 20, 6), "keep": (good, 3, [0, 3], 20, 6), "few": (good, 3, [0], 20, 6), "atoms": (good, 3, [0, 2], 21, 6), "residues": (good, 3, [0, 2], 20, 5), "order": ([(0, 9, *good[0][2:]), good[1], (2, 9, *good[2][2:])], 3, [0, 2], 20, 6), "empty": ([], 0, [], 0, 0)}
    chains = spark.createDataFrame([(k, *c) for k, (cs, *_) in cases.items() for c in cs], "id string, i int, number int, kept boolean, atom_idx int, atom_num int, res_idx int, res_num int")
    sizes = spark.createDataFrame([(k, *rest) for k, (_, *rest) in cases.items()], "id string, n_mask int, keep array<int>, n_atoms int, n_residues int")
    got = {r.id: [c for c in ("count_ok", "keep_ok", "order_ok", "atoms_ok", "residues_ok") if not r[c]] for r in checks.integrity(chains, sizes, "id", "i", "number", "kept").collect()}
    assert got.pop("empty") and got == {"good": [], "mask": ["count_ok"], "keep": ["keep_ok"], "few": ["keep_ok"], "atoms": ["atoms_ok"], "residues": ["residues_ok"], "order": ["order_ok"]}


def test_gate_of_a_run_and_references(spark):
    rows = [("a", [1.0, 2.0, 3.0], False), ("b", [0.0, 29.9, 1.0], None), ("w", [99.0], True), ("b", [1.0, 2.0, 30.0], False), (None, [1.0, 2.0, float("nan")], False), ("c", None, False)]
    df = spark.createDataFrame(rows, "id string, v array<double>, sanity boolean")
    assert [tuple(r) for r in checks.eval_rows(df, "id", "v", "sanity", 5).collect()] == [("count", True, 5), ("ids", False, 2), ("values", False, 3)]
    assert [tuple(r) for r in checks.eval_rows(df.where("false"), "id", "v", None, 0).collect()] == [("count", True, 0), ("ids", True, 0), ("values", True, 0)]
    refs = spark.createDataFrame([("x", f"u{k}") for k in range(5)] + [("y", "u1"), ("-1", "u2"), ("", "u3"), (None, "u4")], "ref string, user string")
    got = {r.ref: (r.passed, r.users, r.used_by) for r in checks.references(refs, "ref", "user", spark.createDataFrame([("y",), ("y",)], "k string"), "k").collect()}
    assert got == {"x": (False, 5, "u0,u1,u2"), "y": (True, None, None)}


def test_provenance_roles_and_triage(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    got = {r.id: r.missing for r in checks.provenance(df, "id", {"one": (df, "id"), "two": (df.where("id = 'a'"), "id")}).collect()}
    assert got == {"a": [], "b": ["two"], None: ["one", "two"]}
    roles = spark.createDataFrame([("a", "h", True), ("a", "p", False), ("b", "h", None)], "id string, role string, on boolean")
    assert {r.id: r.missing for r in checks.role_present(roles, "id", "role", ["h", "p"], F.col("on")).collect()} == {"a": ["p"], "b": ["h", "p"]}
    quality = spark.createDataFrame([("a", 1), ("b", 9), ("c", 9)], "id string, q int")
    errors = spark.createDataFrame([("b", 4.0)], "id string, e double")
    got = {r.id: (r["class"], r.why) for r in checks.triage(quality, errors, "id", [(F.col("q") < 5, "drop", F.col("q")), (F.col("e") > 3, "difficult", F.lit("far"))]).collect()}
    assert got == {"a": ("drop", "1"), "b": ("difficult", "far"), "c": ("rest", None)}


def packed(n_chains, atoms_of, model=None, **more):
    chains = np.array([(f"c{k}", True, k * atoms_of, atoms_of, k, 1) for k in range(n_chains)], [("name", "U4"), ("present", "?"), ("atom_idx", "<i4"), ("atom_num", "<i4"), ("res_idx", "<i4"), ("res_num", "<i4")])
    residues = np.array([("GLY", k % 2 == 0, k * atoms_of, atoms_of) for k in range(n_chains)], [("name", "U3"), ("present", "?"), ("atom_idx", "<i4"), ("atom_num", "<i4")])
    n = n_chains * atoms_of
    atoms = np.array([("CA", True, (k, 0, 0)) for k in range(n)], [("name", "U4"), ("present", "?"), ("coords", "<f4", 3)])
    if model is not None:
        more = {"ensemble": np.array([(0, model)], [("atom_coord_idx", "<i4"), ("atom_num", "<i4")]), "coords": np.array([((0, k, 0),) for k in range(model)], [("coords", "<f4", 3)])}
    out = io.BytesIO()
    np.savez(out, chains=chains, residues=residues, atoms=atoms, **more)
    return out.getvalue()


def test_structure_files_become_three_tables(spark, tmp_path):
    files = [("plain", packed(3, 4)), ("model", packed(2, 5, 10)), ("short", packed(2, 5, 9)), ("empty", packed(0, 4)), ("large", packed(2, 15_000)), ("broken", b"no zip"), ("null", None)]
    made = structures.write_structures(spark.createDataFrame(files, "path string, content binary"), f"file://{tmp_path}/out")
    n = lambda kind: {r.path: r["count"] for r in made[kind].groupBy("path").count().collect()}
    assert n("chains") == {"plain": 3, "model": 2, "short": 2, "large": 2} and n("atoms") == {"plain": 12, "model": 10, "short": 10, "large": 30_000}
    assert {r.path for r in made["errors"].collect()} == {"broken", "null"}
    at = {r.path: (r.x, r.y) for r in made["atoms"].where("idx = 7").collect()}
    assert at["plain"] == (7, 0) and at["model"] == (0, 7) and at["short"] == (7, 0)
    ends = made["chains"].groupBy("path").agg(F.max_by(F.col("atom_idx") + F.col("atom_num"), "idx").alias("end"))
    assert {r.path: r.end for r in ends.collect()} == n("atoms")


def test_json_lines_are_counted_in_the_same_pass(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k": 1, "v": [1.5, null]}\n\n{"k": 2}\n{"k": 3, "v": [2.')
    (tmp_path / "b.jsonl").write_text('nonsense\n{"k": 4, "other": {"x": 1}}\n')
    rows, counts = json_lines.read_lines(spark, str(tmp_path), "k long, v array<double>")
    got = rows.collect()
    assert sorted(r.k for r in got if r._corrupt is None) == [1, 2, 4] and counts.get == {"lines": 5, "good": 3, "bad": 2}
    assert {r._corrupt for r in got if r._corrupt} == {'{"k": 3, "v": [2.', "nonsense"}
    logs = spark.createDataFrame([(1, '{"train/loss": 0.5, "lr": "1e-3", "step": 7, "train/note": "x"}'), (2, "cut {"), (3, None)], "i int, line string")
    assert sorted(map(tuple, json_lines.dynamic_metrics(logs, "i", "line").collect())) == [(1, "lr", 0.001), (1, "train/loss", 0.5)]


def test_curve_counts_what_is_no_number(spark):
    rows = [(1, "a", 0, 2.0, 6.0), (1, "a", 1, 1.0, None), (1, "b", 0, math.nan, 1.0), (1, "b", 1, 4.0, 5.5), (1, "c", 0, None, None), (2, "a", 0, math.inf, 9.0)]
    df = spark.createDataFrame(rows, "step int, rec string, s int, v double, dev double")
    ref = spark.createDataFrame([("a", 2.0), ("b", 1.0)], "rec string, ref double")
    got = {r.step: r.asDict() for r in stats.validation_curve(df, ref, "step", "rec", "s", "v", "dev").collect()}
    assert {k: got[1][k] for k in ("ok", "failed", "non_finite", "swaps", "paired", "improved", "pooled_median", "first_median", "best_median", "delta")} == {"ok": 2, "failed": 1, "non_finite": 1, "swaps": 2, "paired": 2, "improved": 1, "pooled_median": 2.0, "first_median": 2.0, "best_median": 2.5, "delta": 1.25}
    assert (got[2]["ok"], got[2]["non_finite"], got[2]["pooled_median"], got[2]["paired"]) == (1, 1, None, 0)


def test_arms_totals_entities_and_samples(spark):
    pooled = spark.createDataFrame([("x", k, 1.0) for k in range(9)] + [("y", k, 0.5 if k else 2.0) for k in range(9)] + [("z", 99, 1.0)], "arm string, rec int, mean double")
    r = stats.compare_arms(pooled, "arm", "rec", "x").collect()
    assert [(a.arm, a.paired, a.improved, a.delta, a.p) for a in r] == [("y", 9, 8, -0.5, 0.0390625)]
    nested = spark.createDataFrame([([(True,), (False,), (None,)], None), (None, [(True,)])], "c array<struct<valid:boolean>>, i array<struct<valid:boolean>>")
    assert tuple(stats.valid_totals(nested, {"c": "c", "i": "i"}).first()) == (1, 2, 1, 0)
    entries = spark.createDataFrame([("e", [("ab\n c", ["q", "p", None, "q"])]), ("f", None)], "id string, items array<struct<s:string,acc:array<string>>>")
    got = {r.id: (r.s, r.length, r.acc) for r in tables.polymer_entities(entries, "id", "items", "s", ("acc",)).collect()}
    assert got == {"e": ("ABC", 3, ["p", "q"]), "f": (None, None, [])}
    arrays = spark.createDataFrame([([3.0, 1.0],), ([],), (None,)], "v array<double>").select(stats.sample_stats(F.col("v")).alias("s")).collect()
    assert [tuple(a.s) for a in arrays] == [(1.0, 2.0, 3.0), (None, None, None), (None, None, None)]
    ends = spark.createDataFrame([([(1, 2, None), (1, 3, True)],)], "i array<struct<chain_1:int,chain_2:int,valid:boolean>>")
    assert [x.valid for x in ends.select(rules.valid_interfaces(F.col("i"), F.array(F.lit(1), F.lit(2)))).first()[0]] == [True, False]
    with pytest.raises(ValueError):
        stats.distinct_runs(pooled, "rec", 3)
    assert spark.range(1).select(seq.clean(F.lit("a\r\nB"))).first()[0] == "AB"


def test_users_of_a_reference_are_dealt_to_many_small_tasks(spark):
    """Of one reference with nearly all rows and many with few, with null users; by what a plain loop gives."""
    from strandmill.operators import joins

    rows = [(1, k % 5000) for k in range(20_000)] + [(k, k % 11) for k in range(2, 3000)] + [(7, None), (7, 3), (8, None), (None, 1)]
    refs = spark.createDataFrame(rows, "r long, u long").repartition(4)
    have = spark.createDataFrame([(k,) for k in range(2, 3000) if k % 3] * 2, "k long")
    known, want = {k for k in range(2, 3000) if k % 3}, {}
    for r, u in set(rows):
        if r is not None and r not in known:
            want.setdefault(r, set()).add(u)
    first = lambda us: ",".join(map(str, sorted(u for u in us if u is not None)[: 3 - (None in us)]))
    out = joins.reference_exists(refs, "r", "u", have, "k")
    assert {r.r: (r.users, r.used_by) for r in out.collect()} == {r: (len(us), first(us)) for r, us in want.items()}
    plan = out._jdf.queryExecution().toString()
    assert plan.count("REPARTITION_BY_NUM") > 0 and "WindowGroupLimit" not in plan
    checked = checks.references(refs, "r", "u", have, "k")
    got = {r.r: (r.passed, r.users) for r in checked.collect()}
    assert got == {r: (r not in want, len(want[r]) if r in want else None) for r in {r for r, _ in rows if r is not None}}
