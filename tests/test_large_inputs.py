"""Operators for large files, ranges, groups and cells, each against its plain form."""

import json
import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strandmill import catalog
from strandmill.functions import seq
from strandmill.operators import joins, stats, windows
from strandmill.sources import json_array, tables
from strandmill.streaming import metrics

RECORDS = [
    {"id": "a{\"[", "x": [1, {"y": "}]\\"}], "t": "é🤦"},
    {"id": "b", "x": [], "t": "\\\\\""},
    {"id": "c", "x": [{"y": "{{{[["}], "t": "," * 40},
    {"id": "d", "x": None, "t": ""},
] * 3


def test_ranges_of_a_json_array_meet_at_any_byte(tmp_path):
    body = json.dumps(RECORDS, ensure_ascii=False, indent=1).encode()
    path = tmp_path / "a.json"
    path.write_bytes(body)
    uri = f"file://{path}"
    for size in (1, 2, 3, 7, 64, len(body)):
        state, got = (0, False, False), []
        for lo in range(0, len(body), size):
            hi = min(lo + size, len(body))
            got += [json.loads(raw) for raw, whole in json_array.records(json_array.Range(uri, lo, hi, *state)) if whole]
            change = json_array.summed(uri, lo, hi)[2 * state[1] + state[2]]
            state = (state[0] + change[0], *change[1:])
        assert got == RECORDS, size


def test_json_array_is_read_by_several_tasks(spark, tmp_path):
    many = [{"id": f"r{k}", "n": k, "t": "x" * (k % 97) + "\"}{["} for k in range(3000)]
    (tmp_path / "a.json").write_text(json.dumps(many))
    (tmp_path / "b.json").write_text("[]")
    (tmp_path / "c.json").write_text("")
    (tmp_path / "d.json").write_text('[{"id": "last", "n": 1, "t": "whole"}, {"id": "cut", "n": 2, "t": "sho')
    out = json_array.read_array(spark, str(tmp_path), "id string, n long, t string", 10_000)
    assert out.rdd.getNumPartitions() > 10
    rows = out.collect()
    good = {r.id: (r.n, r.t) for r in rows if r._corrupt is None}
    assert good == {r["id"]: (r["n"], r["t"]) for r in many} | {"last": (1, "whole")}
    assert [r._corrupt for r in rows if r._corrupt] == ['{"id": "cut", "n": 2, "t": "sho']
    wanted = spark.createDataFrame([("r7",), ("r2999",), ("nobody",), (None,)], "id string")
    for most in (0, 1000):  # as a semi-join, and by name
        json_array.WANTED_IDS = most
        got = json_array.read_array(spark, str(tmp_path), "id string, n long, t string", 10_000, wanted)
        assert {r.id for r in got.where("_corrupt is null").collect()} == {"r7", "r2999"}
    (tmp_path / "none").mkdir()
    assert json_array.read_array(spark, str(tmp_path / "none"), "id string").count() == 0


def test_manifest_round_trip_is_valid_json(spark, tmp_path):
    df = spark.createDataFrame([(k, f"t{k}\"", k % 3) for k in range(50)], "id long, t string, file int")
    tables.write_manifest(df, str(tmp_path / "m"), "file", "id")
    files = list((tmp_path / "m").glob("file=*/*.txt"))
    assert len(files) == 3 and sorted(r["id"] for f in files for r in json.loads(f.read_text())) == list(range(50))


def test_dyadic_cover_of_long_nested_and_odd_ranges(spark):
    spans = [(0, 10**9), (5, 10**9 - 7), (-13, 29), (7, 1), (7, 0), (7, -3), (-8, 8), (1 << 40, (1 << 32) + 1)]
    df = spark.createDataFrame(spans, "s long, n long").withColumn("c", joins.dyadic_cover(F.col("s"), F.col("n")))
    for r in df.collect():
        blocks = sorted((b.place << b.level, (b.place + 1) << b.level) for b in r.c)
        assert len(blocks) < 66 and (r.n > 0) == bool(blocks)
        if blocks:
            assert blocks[0][0] == r.s and blocks[-1][1] == r.s + r.n and all(a[1] == b[0] for a, b in zip(blocks, blocks[1:]))
    points = spark.createDataFrame([(p, 1) for p in (-14, -13, 0, 15, 16, 10**9 - 3, 10**9, None)], "p long, level int")
    got = joins.interval_join(points, spark.createDataFrame([*spans, (None, 3)], "s long, n long"), "p", "s", "n")
    want = {(p, s, n) for p in (-14, -13, 0, 15, 16, 10**9 - 3, 10**9) for s, n in spans if s <= p < s + n}
    assert sorted((r.p, r.s, r.n) for r in got.collect()) == sorted(want) and "level" in got.columns


@pytest.fixture(scope="module")
def series(spark):
    """A group of most rows, small ones, a null group, gaps, ties and nulls in values."""
    rng = random.Random(2)
    rows = [("hot", k, rng.choice([None, rng.randint(0, 10**6), k * 3])) for k in rng.sample(range(120_000), 60_000)]
    rows += [("up", k, k) for k in range(-50, 9_000)] + [("flat", k, 5) for k in range(3)] + [(None, k, -k) for k in range(10)] + [("one", 4, None)]
    return spark.createDataFrame(rows, "g string, o long, v long").repartition(8).cache()


def test_carried_scans_equal_plain_windows(series):
    w = Window.partitionBy("g").orderBy("o")
    rows = lambda df: sorted(map(str, df.collect()))
    for chunk in (None, F.floor(F.col("o") / 100), F.lit(0)):
        plain = series.withColumn("p", F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1))).where("p is null or v > p + 5")
        assert rows(windows.high_water(series, "g", ["o"], "v", 5, chunk).select("g", "o", "v")) == rows(plain.select("g", "o", "v"))
        plain = series.withColumn("ok", F.coalesce(F.col("v") > F.lag("v").over(w), F.lit(True))).groupBy("g").agg(F.bool_and("ok").alias("ok"))
        assert rows(windows.monotonic(series, "g", "o", "v", chunk=chunk)) == rows(plain)
        got = {r.g: r.spans for r in windows.islands(series.where("g <> 'hot' or g is null"), "g", "o", chunk).collect()}
        assert got == {"up": "-50-8999", "flat": "0-2", None: "0-9", "one": "4"}
    hot = windows.islands(series.where("g = 'hot'"), "g", "o").first().spans.split("+")
    places = sorted(r.o for r in series.where("g = 'hot'").select("o").collect())
    starts = [b for a, b in zip([None, *places], places) if a is None or b != a + 1]
    assert [int(x.split("-")[0]) for x in hot] == starts


def test_a_hot_group_is_spread_over_tasks(series):
    got = windows.high_water(series, "g", ["o"], "v").where("g = 'hot'")
    assert "Window" in got._jdf.queryExecution().toString()
    sizes = series.where("g = 'hot'").groupBy(windows.chunk_of(series, "o")).count()
    assert sizes.count() > 20 and sizes.agg(F.max("count")).first()[0] <= windows.CHUNK


def test_anchor_and_end_of_a_table(spark, series):
    flagged = series.withColumn("ok", F.col("o") % 7 == 3)
    w = Window.partitionBy("g")
    plain = flagged.withColumn("start", F.min(F.when(F.col("ok"), F.col("o"))).over(w)).where("ok and o < start + 700")
    got = windows.anchor_window(flagged, "g", "o", "ok", 700)
    assert sorted(map(str, got.select("g", "o", "start").collect())) == sorted(map(str, plain.select("g", "o", "start").collect()))
    offsets = spark.createDataFrame([("a", 1, 0, 3, 8), ("a", 2, 3, 5, 8), ("b", 1, 0, 3, 4), ("b", 2, 3, 2, 4), ("c", 1, 5, 1, 6), ("c", 2, 4, 2, 6), ("d", 1, 0, None, 3)], "g string, i int, off int, num int, size int")
    got = {r.g: (r.ok, r.end_ok) for r in windows.monotonic(offsets, "g", "i", "off", F.col("off") + F.col("num"), F.col("size")).collect()}
    assert got == {"a": (True, True), "b": (True, False), "c": (False, True), "d": (True, False)}


def test_points_of_one_cell_are_dealt_to_many_tasks(spark):
    rng = random.Random(3)
    at = [(k, rng.random(), rng.random(), rng.random() if k % 50 else None) for k in range(900)]
    far = [(1000 + k, rng.uniform(-50, 50), rng.uniform(-50, 50), 7.5 * (k % 3)) for k in range(600)]
    df = spark.createDataFrame([*at, *far], "id int, x double, y double, z double")
    a, b = df.where("id % 3 = 0"), df.where("id % 3 <> 0")
    rows = [tuple(r) for r in df.collect() if r.z is not None]
    for r, inclusive in ((0.4, True), (7.5, True), (7.5, False)):
        want = {(p[0], q[0]) for p in rows if p[0] % 3 == 0 for q in rows if q[0] % 3 and (lambda d: d <= r * r if inclusive else d < r * r)(sum((p[k] - q[k]) ** 2 for k in (1, 2, 3)))}
        for dense in (10, 4096):
            got = joins.radius_join(a, b, r, inclusive=inclusive, dense=dense)
            pairs = [(x.a_id, x.b_id) for x in got.collect()]
            assert len(pairs) == len(want) and set(pairs) == want


@pytest.mark.parametrize("n", [0, 1, 9, 56, 57, 60, 100, 999, 5000])
def test_sign_test_against_fractions(spark, n):
    ks = sorted({0, 1, n // 3, n // 2, (n + 1) // 2, n - n // 4, n} & set(range(n + 1)))
    got = {r.k: r.p for r in stats.sign_test(spark.createDataFrame([(k, n) for k in ks], "k long, n long"), "k", "n").collect()}
    for k in ks:
        m = min(k, n - k)
        want = min(Fraction(1), 2 * Fraction(sum(math.comb(n, i) for i in range(m + 1)), 2**n))
        assert got[k] == float(want) if n <= 56 else abs(got[k] - float(want)) < 1e-9


def test_sign_test_of_ten_million(spark):
    n = 10**7
    rows = [(n // 2 - d, n) for d in (0, 1500, 5000)] + [(None, 5)]
    p = [r.p for r in stats.sign_test(spark.createDataFrame(rows, "k long, n long"), "k", "n").collect()]
    normal = [math.erfc((d - 0.5) / math.sqrt(n / 4) / math.sqrt(2)) for d in (1500, 5000)]
    assert p[0] == 1 and abs(p[1] - normal[0]) < 1e-6 and abs(p[2] / normal[1] - 1) < 1e-3 and p[3] is None


@pytest.mark.parametrize("name", ["agg_sign_test", "join_interval_offsets", "join_radius", "win_islands", "win_runner_up"])
def test_queries_at_the_larger_scale_to_six_places(spark, name):
    import duckdb

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("orders", "lineitem", "embeddings", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.execute(catalog.oracle_sql()[name])
    names = [c[0] for c in want.description]
    text = lambda r: tuple(f"{v:.6f}" if isinstance(v, float) else str(v) for v in r)
    got = catalog.queries()[name](spark, sf).select(*names)
    assert sorted(map(text, got.collect())) == sorted(map(text, want.fetchall()))


def test_kmers_of_a_long_string(spark):
    import time

    long = "".join(random.Random(1).choices("ACGT\n", k=80_000))
    df = spark.createDataFrame([(long,), ("abcab",), ("ab",), ("",), (None,), ("aé🤦b\nc",)], "s string").repartition(1)
    began = time.time()
    got = {r.s: r.k for r in df.select("s", seq.kmers(F.col("s"), 3).alias("k")).collect()}
    assert time.time() - began < 5
    assert all(got[s] == list(dict.fromkeys(s[i : i + 3] for i in range(len(s) - 2))) for s in got if s is not None)


def test_running_metrics_leave_infinity_out(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", float("inf")), ("a", float("nan")), ("a", None), ("a", -float("inf")), ("a", 3.0)], "m string, v double")
    r = metrics.running_metrics(rows, "m", "v", F.lit(2)).first()
    assert (r.total, r.weight, r.rows) == (8.0, 4, 2)


def test_runner_up_by_an_order_that_is_not_the_score(spark):
    rows = [("a", 5, 1), ("a", 9, 2), ("a", 9, 3), ("b", 4, 1), ("c", None, 1), ("c", 2, 2)]
    df = spark.createDataFrame(rows, "e string, s int, i int")
    got = {r.e: (r.best, r.rival) for r in windows.runner_up(df, "e", "s", [F.asc("i")]).collect()}
    assert got == {"a": (5, 9), "b": (4, None), "c": (None, 2)}
    got = {r.e: (r.best, r.rival, r.ambiguous) for r in windows.runner_up(df, "e", "s", [F.desc("s"), F.asc("i")]).collect()}
    assert got == {"a": (9, 9, True), "b": (4, None, False), "c": (2, None, False)}


def test_whole_sequences_are_aligned(spark):
    from strandmill.operators.alignment import align_pairs, local_align

    rng = random.Random(8)
    tail = "".join(rng.choices("ACDEF", k=50))
    x, y = ("".join(rng.choices(s, k=500)) + tail for s in ("GH", "IK"))
    r = align_pairs(spark.createDataFrame([(x, y)], "x string, y string")).first()
    assert r.score == local_align(x, y)[0] == 250


def test_crosschecks_and_sets(spark):
    a = spark.createDataFrame([(1, "1999-01-01"), (2, "2001-01-01"), (3, None), (4, "1999-05-05")], "k int, d string")
    b = spark.createDataFrame([(1, "1999-06-01"), (2, "1998-01-01"), (4, "1999-05-05"), (5, "2000-01-01")], "k int, d string")
    got = {r.k: r.changes for r in joins.source_crosscheck(a, b, "k", "d", lambda d: F.when(d.isNull(), "?").when(d < "2000", "old").otherwise("new")).collect()}
    assert got == {1: False, 2: True, 5: True}
    names = spark.createDataFrame([("A", ["A", "B"]), ("C", ["A"]), (None, ["A"]), ("A", None)], "n string, ids array<string>")
    assert tuple(joins.name_crosscheck(names, F.col("n"), "ids").first()) == (2, 1, 0.5)
    sizes = spark.createDataFrame([([1, 2, 2, 3], [2, 2, 3]), (None, [1])], "a array<int>, b array<int>").select(joins.overlap(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in sizes] == [2, 0]
    entities = spark.createDataFrame([("e", "AA", 1), ("e", "AA", 2), ("f", "", 3)], "entry string, seq string, ent int")
    chains = spark.createDataFrame([("e", "AA", "c1"), ("f", "", "c2"), ("e", None, "c3")], "entry string, seq string, chain string")
    assert [tuple(r) for r in joins.exact_sequence(chains, entities, "entry", "seq", "ent").collect()] == [("e", "AA", "c1", 2)]


def test_ranges_are_dealt_to_tasks_by_bytes_and_read_once(spark, tmp_path):
    """Tasks and sums do not follow the number of ranges, records keep their order and nulls their file."""
    small = [(f"f{k}", 30_000) for k in range(100)]
    shares = json_array.dealt([*small, ("large", 500_000), ("empty", 0)], 1000, 100_000)
    assert len(shares) == 35 and all(sum(hi - lo for _, lo, hi in s) == 100_000 for s in shares)
    for name, size in (*small, ("large", 500_000)):
        mine = [c[1:] for s in shares for c in s if c[0] == name]
        assert mine[0][0] == 0 and mine[-1][1] == size and all(a[1] == b[0] for a, b in zip(mine, mine[1:]))
    df = spark.createDataFrame([(k, f"t{k}\"", k % 7) for k in range(700)], "id long, t string, file int")
    tables.write_manifest(df, str(tmp_path / "m"), "file", "id")
    assert [r["id"] for r in json.loads(next((tmp_path / "m/file=3").glob("*.txt")).read_text())] == list(range(3, 700, 7))
    wanted = spark.range(0, 2000, 2)
    out = json_array.read_array(spark, str(tmp_path / "m"), "id long, t string", 50, wanted.union(wanted))
    assert sorted(r.id for r in out.collect()) == list(range(0, 700, 2)) and out.rdd.getNumPartitions() < 60
    json_array.WANTED_IDS, most = 10, json_array.WANTED_IDS
    try:
        out = json_array.read_array(spark, str(tmp_path / "m"), "id long, t string", 50, wanted.union(wanted))
        assert sorted(r.id for r in out.collect()) == list(range(0, 700, 2))
        assert out._jdf.queryExecution().optimizedPlan().toString().count("RelationV2") == 1
    finally:
        json_array.WANTED_IDS = most


def test_dyadic_cover_looks_at_the_levels_of_its_range_only(spark):
    """A short range costs as many levels as its length has bits, wherever it lies."""
    short = spark.range(150_000).select((F.col("id") * 4 - 300_000).alias("s"), (F.col("id") % 50).cast("long").alias("n")).repartition(8)
    cost = lambda c: c.agg(F.sum(F.size("c")), F.sum(F.aggregate("c", F.lit(0).cast("long"), lambda n, b: n + F.call_function("shiftleft", F.lit(1).cast("long"), b["level"])))).first()
    covers = short.withColumn("c", joins.dyadic_cover(F.col("s"), F.col("n")))
    levels = covers._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(0, 62" not in levels and "[0,1,2,3,4,5,6,7,8" not in levels
    assert cost(covers)[1] == sum(k % 50 for k in range(150_000))
    assert covers.where("n = 0").agg(F.max(F.size("c"))).first()[0] == 0
    assert spark.range(1).select(joins.dyadic_cover(F.lit(None).cast("long"), F.lit(3)).alias("c")).first().c is None
