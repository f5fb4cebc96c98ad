"""The queries of the library's own operators on the driver tables, and their SQL.

rounded alike on both sides.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .functions import seq
from .operators import alignment, checks, geometry, joins, rules, stats, windows
from .sources import json_lines, structures, tables
from .streaming import metrics

_QUERIES: dict = {}
_SQL: dict[str, str] = {}

TRAIN_END, VAL_END = "1999-12-31", "2000-12-31"
RANKS = {"test": 0, "validation": 1, "train": 2}
SPLIT_SQL = f"CASE WHEN o_orderdate::date <= '{TRAIN_END}' THEN 'train' WHEN o_orderdate::date <= '{VAL_END}' THEN 'validation' ELSE 'test' END"
SPLITS_SQL = f"(SELECT *, {SPLIT_SQL} AS split FROM orders)"
RANK_SQL = "CASE split WHEN 'test' THEN 0 WHEN 'validation' THEN 1 ELSE 2 END"
POINTS_SQL = "(SELECT vec_id AS id, label, 50*embedding[1]::double AS x, 50*embedding[2]::double AS y, 50*embedding[3]::double AS z FROM embeddings)"


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict:
    return dict(_SQL)


def t(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def split_orders(spark, d):
    return rules.temporal_split(t(spark, d, "orders"), "o_orderdate", TRAIN_END, VAL_END)


def points(spark, d):
    e = t(spark, d, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("label"), *[(F.get("embedding", F.lit(k)).cast("double") * 50).alias(c) for k, c in enumerate("xyz")])


# projections and rules


@query(f"SELECT o_orderkey, {SPLIT_SQL} AS split FROM orders")
def prj_temporal_split(spark, d):
    return split_orders(spark, d).select("o_orderkey", "split")


@query("SELECT o_orderkey, upper(replace(coalesce(o_orderpriority,''),' ','')) AS k FROM orders")
def prj_key_normalize(spark, d):
    return t(spark, d, "orders").select("o_orderkey", rules.key_normalize(F.col("o_orderpriority")).alias("k"))


@query("SELECT c_custkey, lower(trim(c_name)) AS name, upper(substring(c_mktsegment,1,10)) AS seg FROM customer")
def prj_id_normalize(spark, d):
    return t(spark, d, "customer").select("c_custkey", F.lower(F.trim("c_name")).alias("name"), F.upper(F.substring("c_mktsegment", 1, 10)).alias("seg"))


@query("SELECT o_orderkey, CASE WHEN upper(trim(s)) IN ('','NONE','---','-1') THEN NULL ELSE s END AS s FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN ' none' WHEN 'O' THEN '---' ELSE o_orderstatus END AS s FROM orders)")
def prj_null_sentinel(spark, d):
    s = F.when(F.col("o_orderstatus") == "F", " none").when(F.col("o_orderstatus") == "O", "---").otherwise(F.col("o_orderstatus"))
    return t(spark, d, "orders").select("o_orderkey", rules.null_sentinel(s).alias("s"))


@query("SELECT doc_id, nullif(string_split(text, chr(10))[1], '') AS first FROM documents")
def prj_first_or_null(spark, d):
    first = rules.first_or_null(F.split("text", "\n"))
    return t(spark, d, "documents").select("doc_id", F.nullif(first, F.lit("")).alias("first"))


@query(r"SELECT c_custkey, regexp_extract(c_name, '^(.*?)(\d*)$', 1) AS prefix, nullif(regexp_extract(c_name, '(\d+)$', 1), '') AS oper FROM customer")
def prj_name_split(spark, d):
    return rules.name_split(t(spark, d, "customer"), "c_name").select("c_custkey", "prefix", "oper")


@query("SELECT p_partkey, CASE WHEN p_size IS NULL THEN '?' WHEN p_size <= 7 THEN '<=7' WHEN p_size <= 9 THEN '8-9' WHEN p_size <= 11 THEN '10-11' ELSE '>=12' END AS bucket FROM part")
def prj_length_bucket(spark, d):
    return t(spark, d, "part").select("p_partkey", rules.bucket(F.col("p_size"), [(7, "<=7"), (9, "8-9"), (11, "10-11")], ">=12").alias("bucket"))


@query("SELECT l_orderkey, string_agg(CASE l_returnflag WHEN 'A' THEN 'a' WHEN 'R' THEN 'r' ELSE 'X' END, '' ORDER BY l_linenumber, CASE l_returnflag WHEN 'A' THEN 'a' WHEN 'R' THEN 'r' ELSE 'X' END) AS seq FROM lineitem GROUP BY 1")
def prj_category_map(spark, d):
    return rules.category_sequence(t(spark, d, "lineitem"), "l_orderkey", "l_linenumber", "l_returnflag", {"A": "a", "R": "r"})


@query("SELECT p_partkey FROM part WHERE regexp_matches(p_type, '(?i)eco|small') AND NOT regexp_matches(p_name, '(?i)1[0-3]$') AND length(p_name) BETWEEN 5 AND 40")
def prj_multiregex_predicate(spark, d):
    p = t(spark, d, "part")
    return p.where(rules.multiregex(F.col("p_type"), ["eco|small"], [], F.length("p_name"), (5, 40)) & ~F.col("p_name").rlike("(?i)1[0-3]$")).select("p_partkey")


@query("SELECT l_orderkey, array_to_string(list_sort(list_distinct(list(l_returnflag || l_linestatus))), ',') AS flags FROM lineitem GROUP BY 1")
def prj_flags_sorted(spark, d):
    g = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set(F.concat("l_returnflag", "l_linestatus")).alias("f"))
    return g.select("l_orderkey", F.array_join(rules.flags_sorted(F.col("f")), ",").alias("flags"))


@query("SELECT p_partkey, CASE WHEN p_size <= 5 THEN 'peptide' WHEN regexp_matches(p_type,'(?i)eco') AND p_size > 30 THEN 'heavy' WHEN contains(p_name,'1') THEN 'receptor' ELSE 'other' END AS role, CASE WHEN p_size <= 5 THEN 'size ' || p_size WHEN regexp_matches(p_type,'(?i)eco') AND p_size > 30 THEN p_type WHEN contains(p_name,'1') THEN p_name ELSE 'default' END AS evidence FROM part")
def cls_role_rules(spark, d):
    ordered = [
        (F.col("p_size") <= 5, "peptide", F.concat(F.lit("size "), F.col("p_size").cast("string"))),
        (F.col("p_type").rlike("(?i)eco") & (F.col("p_size") > 30), "heavy", F.col("p_type")),
        (F.contains("p_name", F.lit("1")), "receptor", F.col("p_name")),
    ]
    return t(spark, d, "part").select("p_partkey", rules.first_rule(ordered, "other").alias("r")).select("p_partkey", "r.role", "r.evidence")


HOMOLOGY_SQL = """SELECT *, CASE WHEN s >= 0.25 AND (n > 400 OR (n > 320 AND f)) THEN 'fusion' WHEN s >= 0.25 AND n BETWEEN 150 AND 400 THEN 'heavy' WHEN s >= 0.10 AND s < 0.25 THEN 'other' END AS role,
    CASE WHEN s >= 0.25 AND (n > 400 OR (n > 320 AND f)) THEN printf('kmer_containment=%.3f, length=%d', s, n) WHEN s >= 0.25 AND n BETWEEN 150 AND 400 THEN printf('kmer_containment=%.3f', s) WHEN s >= 0.10 AND s < 0.25 THEN printf('ambiguous homology=%.3f', s) END AS evidence,
    CASE WHEN s >= 0.25 AND (n > 400 OR (n > 320 AND f)) THEN 'single_chain_fusion' WHEN s >= 0.10 AND s < 0.25 THEN 'ambiguous_homology' ELSE '' END AS flags
    FROM (SELECT p_partkey, p_name, (p_partkey % 100) / 100.0::double AS s, p_size * 10 AS n, p_type = 'ECONOMY' AS f FROM part)"""


def homology(spark, d):
    x = t(spark, d, "part").select("p_partkey", "p_name", (F.pmod("p_partkey", F.lit(100)) / F.lit(100.0)).alias("s"), (F.col("p_size") * 10).alias("n"), (F.col("p_type") == "ECONOMY").alias("f"))
    return x.withColumn("r", rules.homology_role(F.col("s"), F.col("n"), F.col("f"))).select("*", "r.*").drop("r")


@query(f"SELECT p_partkey, role, evidence, flags FROM ({HOMOLOGY_SQL})")
def cls_homology_call(spark, d):
    return homology(spark, d).select("p_partkey", "role", "evidence", F.array_join("flags", ",").alias("flags"))


TAGGED_SQL = f"""SELECT p_partkey, s, CASE WHEN hit THEN 'light' ELSE role END AS role, CASE WHEN hit THEN printf('named + length %d (tagged construct), homology %.3f', n, s) ELSE evidence END AS evidence,
    CASE WHEN NOT hit THEN flags WHEN flags = '' THEN 'expression_tag' ELSE flags || ',expression_tag' END AS flags
    FROM (SELECT *, (role IS NULL OR role = 'other') AND contains(p_name, 'widget') AND n BETWEEN 80 AND 260 AND s < 0.25 AS hit FROM ({HOMOLOGY_SQL}))"""


def tagged(spark, d):
    return rules.tagged_recovery(homology(spark, d), "role", F.contains("p_name", F.lit("widget")), F.col("n"), F.col("s"), "light")


@query(f"SELECT p_partkey, role, evidence, flags FROM ({TAGGED_SQL})")
def cls_tagged_recovery(spark, d):
    return tagged(spark, d).select("p_partkey", "role", "evidence", F.array_join("flags", ",").alias("flags"))


@query(f"SELECT p_partkey, coalesce(role, 'other') AS role, CASE WHEN role IS NULL THEN printf('no rule matched; homology=%.3f', s) ELSE evidence END AS evidence FROM ({TAGGED_SQL})")
def cls_default_evidence(spark, d):
    return rules.default_evidence(tagged(spark, d), "role", F.col("s")).select("p_partkey", "role", "evidence")


@query("SELECT p_partkey, CASE WHEN regexp_matches(p_name, '(?i)\\bcold\\b') THEN 'alpha' WHEN regexp_matches(p_name, '(?i)\\bsmall\\b') THEN 'beta' WHEN regexp_matches(p_name, '(?i)gear') THEN 'gamma' ELSE 'unknown' END AS role FROM part")
def cls_subrole_rules(spark, d):
    patterns = [(r"\bcold\b", "alpha"), (r"\bSMALL\b", "beta"), ("gear", "gamma")]
    return t(spark, d, "part").select("p_partkey", rules.sub_role(F.col("p_name"), patterns).alias("role"))


@query("SELECT event_id, user_id, value FROM events WHERE NOT coalesce(user_id % 5 = 0, false) AND user_id IS NOT NULL AND value IS NOT NULL AND isfinite(value)")
def flt_non_sanity(spark, d):
    e = t(spark, d, "events")
    return e.where(rules.scored(F.col("user_id") % 5 == 0, F.col("user_id"), F.array("value"))).select("event_id", "user_id", "value")


@query("SELECT d.doc_id, CASE WHEN l.toxic = 1 THEN 'drop' WHEN l.quality = 0 THEN 'difficult' WHEN l.doc_id IS NULL THEN 'unseen' WHEN d.n_chars < 500 THEN 'improve' ELSE 'rest' END AS class, CASE WHEN l.toxic = 1 THEN 'toxic' WHEN l.quality = 0 THEN 'quality 0' WHEN l.doc_id IS NULL THEN 'no label' WHEN d.n_chars < 500 THEN d.n_chars || ' characters' END AS why FROM documents d LEFT JOIN labels l USING (doc_id)")
def cls_triage(spark, d):
    short = F.concat(F.col("n_chars").cast("string"), F.lit(" characters"))
    ordered = [(F.col("toxic") == 1, "drop", F.lit("toxic")), (F.col("quality") == 0, "difficult", F.lit("quality 0")), (~F.col("has_error"), "unseen", F.lit("no label")), (F.col("n_chars") < 500, "improve", short)]
    return checks.triage(t(spark, d, "documents"), t(spark, d, "labels"), "doc_id", ordered)


@query("SELECT l_orderkey, count(*) FILTER (l_quantity > 25) AS n_ok, count(*) FILTER (NOT l_quantity > 25) AS n_dropped FROM lineitem GROUP BY 1")
def flt_finite(spark, d):
    x = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.when(F.col("l_quantity") > 25, F.col("l_quantity")).otherwise(float("nan"))).alias("v"))
    ok = F.size(rules.finite(F.col("v"))).cast("long")
    return x.select("l_orderkey", ok.alias("n_ok"), (F.size("v") - ok).alias("n_dropped"))


@query("SELECT o_orderkey FROM orders JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey WHERE n BETWEEN 2 AND 6 AND o_orderdate::date <= '2000-06-30' AND o_totalprice <= 200000")
def flt_record_quality(spark, d):
    n = stats.counter(t(spark, d, "lineitem"), "l_orderkey")
    o = t(spark, d, "orders").where((F.to_date("o_orderdate") <= F.lit("2000-06-30").cast("date")) & (F.col("o_totalprice") <= 200000))
    return o.join(n, F.col("l_orderkey") == F.col("o_orderkey")).where(F.col("n").between(2, 6)).select("o_orderkey")


@query("SELECT l_orderkey, count(*) FILTER (l_linenumber IN (1,3)) AS n_valid, count(*) FILTER (l_linenumber NOT IN (1,3)) AS n_invalid, count(*) FILTER (l_linenumber IN (1,3) AND l_suppkey % 4 IN (1,3)) AS n_interfaces FROM lineitem GROUP BY 1")
def prj_valid_flags(spark, d):
    ends = F.struct(F.col("l_linenumber").cast("long").alias("chain_1"), (F.col("l_suppkey") % 4).cast("long").alias("chain_2"))
    nested = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber")).alias("items"), F.collect_list(ends).alias("interfaces"))
    keep = F.array(F.lit(1), F.lit(3))
    v = nested.select("l_orderkey", rules.valid_flags(F.col("items"), keep, "l_linenumber").alias("v"), rules.valid_interfaces(F.col("interfaces"), keep.cast("array<long>")).alias("i"))
    n = lambda c, want: F.size(F.filter(c, lambda x: x["valid"] == want)).cast("long")
    return v.select("l_orderkey", n("v", True).alias("n_valid"), n("v", False).alias("n_invalid"), n("i", True).alias("n_interfaces"))


@query("SELECT p_partkey, array_to_string(list_transform(range(0, p_size), lambda i: CASE WHEN i IN (0, 2, 5) THEN '1' ELSE '0' END), '') AS mask FROM part")
def prj_bool_mask(spark, d):
    m = rules.bool_mask(F.col("p_size"), F.array(F.lit(0), F.lit(2), F.lit(5)))
    return t(spark, d, "part").select("p_partkey", F.array_join(F.transform(m, lambda b: F.when(b, "1").otherwise("0")), "").alias("mask"))


# leakage and checks


@query(f"SELECT o_orderkey, split, CASE WHEN {RANK_SQL} = b THEN 'keep' ELSE 'drop' END AS action, CASE b WHEN 0 THEN 'test' WHEN 1 THEN 'validation' ELSE 'train' END AS kept_in FROM (SELECT *, min({RANK_SQL}) OVER (PARTITION BY o_orderpriority, o_custkey) AS b FROM {SPLITS_SQL})")
def win_keep_split(spark, d):
    return windows.keep_split(split_orders(spark, d), ["o_orderpriority", "o_custkey"], "split", RANKS).select("o_orderkey", "split", "action", "kept_in")


@query(f"SELECT count(*) AS groups, coalesce(sum(n), 0)::bigint AS rows, count(*) FILTER (a = b) AS within, count(*) FILTER (a <> b) AS across FROM (SELECT count(*) AS n, min(split) AS a, max(split) AS b FROM {SPLITS_SQL} GROUP BY o_orderpriority, o_custkey HAVING count(*) > 1)")
def agg_pair_groups(spark, d):
    return stats.pair_groups(split_orders(spark, d), ["o_orderpriority", "o_custkey"], "split")


@query(f"SELECT count(*) AS total, count(*) FILTER (a = b) AS passed FROM (SELECT min(split) AS a, max(split) AS b FROM {SPLITS_SQL} GROUP BY o_orderpriority, o_custkey)")
def agg_leakage_check(spark, d):
    return stats.leakage_check(split_orders(spark, d), ["o_orderpriority", "o_custkey"], "split")


@query(f"SELECT s.split, count(o_orderkey) AS n FROM (VALUES ('train'), ('validation'), ('test'), ('unknown')) s(split) LEFT JOIN {SPLITS_SQL} o USING (split) GROUP BY 1")
def agg_split_counts(spark, d):
    return stats.split_counts(split_orders(spark, d), "split", ["train", "validation", "test", "unknown"])


def _checks():
    return {"price": F.col("o_totalprice") > 1000, "open": F.col("o_orderstatus") == "O", "urgent": F.col("o_orderpriority").startswith("1")}


_CHECK_SQL = {"price": "o_totalprice > 1000", "open": "o_orderstatus = 'O'", "urgent": "starts_with(o_orderpriority, '1')"}


@query(" UNION ALL ".join(f"SELECT '{k}' AS \"check\", count(*) FILTER ({c}) AS passed, count({c}) AS total FROM orders" for k, c in _CHECK_SQL.items()))
def agg_check_suite(spark, d):
    return stats.check_suite(t(spark, d, "orders"), _checks())


@query(" UNION ALL ".join(f"SELECT '{k}' AS \"check\", count(*) AS failed, array_to_string(list_sort(list(o_orderkey))[1:2], ',') AS examples FROM orders WHERE NOT ({c}) HAVING count(*) > 0" for k, c in _CHECK_SQL.items()))
def agg_failure_examples(spark, d):
    return stats.failure_examples(t(spark, d, "orders"), _checks(), "o_orderkey")


@query(f"SELECT count(*) FILTER ({SPLIT_SQL} = CASE WHEN year(o_orderdate) < 2000 THEN 'train' WHEN year(o_orderdate) = 2000 THEN 'validation' ELSE 'test' END) AS passed, count(*) AS total FROM orders")
def chk_split_date(spark, d):
    again = F.when(F.year("o_orderdate") < 2000, "train").when(F.year("o_orderdate") == 2000, "validation").otherwise("test")
    return split_orders(spark, d).agg(F.count_if(F.col("split") == again).alias("passed"), F.count("*").alias("total"))


# aggregates


@query("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def agg_counter(spark, d):
    return stats.counter(t(spark, d, "orders"), "o_orderpriority")


@query("SELECT k, count(*) AS n FROM (SELECT unnest(json_keys(props)) AS k FROM events) GROUP BY 1")
def agg_key_presence(spark, d):
    return stats.counter(t(spark, d, "events").select(F.explode(F.json_object_keys("props")).alias("k")), "k")


@query("SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS double) AS k, false AS corrupt FROM events WHERE event_id % 10 <> 0 UNION ALL SELECT NULL, NULL, NULL, true FROM events WHERE event_id % 10 = 0")
def src_jsonl_tolerant(spark, d):
    path = tables.shared_path(spark)
    line = F.to_json(F.struct("event_id", "user_id", F.get_json_object("props", "$.k").cast("double").alias("k")))
    t(spark, d, "events").select(F.when(F.col("event_id") % 10 == 0, F.substring(line, 1, 9)).otherwise(line).alias("value")).write.text(path)
    rows, _ = json_lines.read_lines(spark, path, "event_id long, user_id long, k double")
    return rows.select("event_id", "user_id", "k", F.col("_corrupt").isNotNull().alias("corrupt"))


@query("SELECT md5(text) AS h, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def agg_duplicate_ids(spark, d):
    return stats.duplicate_ids(t(spark, d, "documents").select(F.md5(F.col("text").cast("binary")).alias("h")), "h")


@query("SELECT length(p_name) AS len, count(*) AS n FROM part GROUP BY 1")
def agg_length_histogram(spark, d):
    return stats.counter(t(spark, d, "part").select(F.length("p_name").cast("long").alias("len")), "len")


@query("SELECT l_orderkey, bool_or(l_returnflag='A') AS has_a, bool_or(l_returnflag='N') AS has_n, bool_or(l_returnflag='R') AS has_r FROM lineitem GROUP BY 1")
def agg_entry_role_flags(spark, d):
    return stats.entry_role_flags(t(spark, d, "lineitem"), "l_orderkey", "l_returnflag", ["A", "N", "R"])


@query("SELECT reason, count(*) AS n FROM (SELECT CASE WHEN NOT bool_or(l_returnflag='A') THEN 'no A' WHEN NOT bool_or(l_returnflag='R') THEN 'no R' ELSE 'kept' END AS reason FROM lineitem GROUP BY l_orderkey) GROUP BY 1")
def agg_drop_reasons(spark, d):
    f = stats.entry_role_flags(t(spark, d, "lineitem"), "l_orderkey", "l_returnflag", ["A", "R"])
    return stats.counter(f.select(F.when(~F.col("has_a"), "no A").when(~F.col("has_r"), "no R").otherwise("kept").alias("reason")), "reason")


@query("""SELECT DISTINCT o_orderpriority, min, p05, upper_median, max FROM (SELECT o_orderpriority, min(o_totalprice) AS min, max(o_totalprice) AS max, list_sort(list(o_totalprice))[1 + floor((count(*) - 1) * 0.05)::int] AS p05, list_sort(list(o_totalprice))[1 + count(*) // 2] AS upper_median FROM orders GROUP BY 1)""")
def agg_order_stats(spark, d):
    return stats.order_stats(t(spark, d, "orders"), "o_orderpriority", "o_totalprice")


@query("SELECT event_type, round(quantile_cont(value, 0.5), 6) AS median, round(avg(value), 6) AS mean, count(value) AS n FROM events GROUP BY 1")
def agg_median_mean(spark, d):
    return stats.median_mean(t(spark, d, "events"), "event_type", "value")


@query("SELECT flag, count(*) AS n FROM (SELECT unnest(string_split(o_orderpriority, '-')) AS flag FROM orders) GROUP BY 1")
def agg_flag_counts(spark, d):
    return stats.counter(t(spark, d, "orders").select(F.explode(F.split("o_orderpriority", "-")).alias("flag")), "flag")


@query("SELECT year(o_orderdate) AS y, count(*) AS n FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_quantity > 30) GROUP BY 1")
def agg_missing_by_year(spark, d):
    have = t(spark, d, "lineitem").where("l_quantity > 30").select(F.col("l_orderkey").alias("o_orderkey"))
    return stats.counter(joins.anti_missing(t(spark, d, "orders"), have, "o_orderkey").select(F.year("o_orderdate").cast("long").alias("y")), "y")


@query(f"SELECT stage, split, count(*) AS n FROM (SELECT 'all' AS stage, split FROM {SPLITS_SQL} UNION ALL SELECT 'kept', split FROM (SELECT split, {RANK_SQL} AS r, min({RANK_SQL}) OVER (PARTITION BY o_orderpriority, o_custkey) AS b FROM {SPLITS_SQL}) WHERE r = b) GROUP BY 1, 2")
def agg_funnel(spark, d):
    s = split_orders(spark, d)
    kept = windows.keep_split(s, ["o_orderpriority", "o_custkey"], "split", RANKS).where("action = 'keep'")
    return stats.counter(s.select(F.lit("all").alias("stage"), "split").union(kept.select(F.lit("kept"), "split")), "stage", "split")


@query("SELECT l_returnflag, round(sum(l_discount*l_quantity)/sum(l_quantity), 6) AS value, sum(l_quantity) AS weight FROM lineitem GROUP BY 1")
def agg_weighted_merge(spark, d):
    return stats.weighted_merge(t(spark, d, "lineitem"), "l_returnflag", "l_discount", "l_quantity")


@query("SELECT round((20*max(v) FILTER (f='A') + 30*max(v) FILTER (f='R')) / 104, 6) AS value, round(50/104, 6) AS attainable FROM (SELECT l_returnflag AS f, sum(l_discount*l_quantity)/sum(l_quantity) AS v FROM lineitem GROUP BY 1)")
def agg_category_weighted(spark, d):
    v = stats.weighted_merge(t(spark, d, "lineitem"), "l_returnflag", "l_discount", "l_quantity")
    return stats.category_weighted(v, "l_returnflag", "value", {"A": 20.0, "R": 30.0, "absent": 54.0})


@query("SELECT l_returnflag, l_linestatus, round(a.m, 6) AS value, round(b.m, 6) AS ref FROM (SELECT l_returnflag, l_linestatus, avg(l_discount) AS m FROM lineitem GROUP BY 1, 2) a JOIN (SELECT l_returnflag, avg(l_discount) AS m FROM lineitem GROUP BY 1) b USING (l_returnflag) WHERE abs(a.m - b.m) > 0.0001")
def agg_reproduction_gate(spark, d):
    l = t(spark, d, "lineitem")
    ref = l.groupBy("l_returnflag").agg(F.avg("l_discount").alias("ref"))
    value = l.groupBy("l_returnflag", "l_linestatus").agg(F.avg("l_discount").alias("value")).join(ref, "l_returnflag")
    keyed = value.withColumn("key", F.struct("l_returnflag", "l_linestatus"))
    out = stats.reproduction_gate(keyed.select("key", "value"), keyed.select("key", "ref"), "key", 0.0001)
    return out.select("key.l_returnflag", "key.l_linestatus", F.round("value", 6).alias("value"), F.round("ref", 6).alias("ref"))


@query("SELECT o_custkey, sum(coalesce(e, b) - b + 1)::bigint AS length FROM (SELECT o_custkey, o_orderkey AS b, CASE WHEN o_orderstatus = 'F' THEN o_orderkey + 5 END AS e FROM orders) GROUP BY 1")
def agg_interval_length(spark, d):
    o = t(spark, d, "orders").select("o_custkey", F.col("o_orderkey").alias("b"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey") + 5).alias("e"))
    return stats.interval_length(o, "o_custkey", "b", "e")


_PAIR_SQL = "(SELECT user_id, avg(value) FILTER (event_type = (SELECT min(event_type) FROM events)) AS a, avg(value) FILTER (event_type = (SELECT max(event_type) FROM events)) AS b FROM events GROUP BY 1)"


def _runs(spark, d):
    e = t(spark, d, "events")
    lo, hi = e.agg(F.min("event_type"), F.max("event_type")).first()
    return stats.paired_runs(e, "event_type", lo, hi, "user_id", "value")


@query(f"SELECT user_id, round(a, 6) AS a, round(b, 6) AS b, round(b - a, 6) AS diff FROM {_PAIR_SQL} WHERE a IS NOT NULL AND b IS NOT NULL")
def join_paired_runs(spark, d):
    return _runs(spark, d).select("user_id", *[F.round(c, 6).alias(c) for c in ("a", "b", "diff")])


@query(f"SELECT round(quantile_cont(a, .5), 6) AS median_a, round(quantile_cont(b, .5), 6) AS median_b, round(quantile_cont(abs(b - a), .5), 6) AS median_abs, round(list_sort(list(abs(b - a)))[1 + floor(count(*) * 0.9)::int], 6) AS p90_abs FROM {_PAIR_SQL} WHERE a IS NOT NULL AND b IS NOT NULL")
def agg_noise_floor(spark, d):
    return stats.noise_floor(_runs(spark, d))


@query("""SELECT o_custkey, k, n, round(least(1.0, 2 * list_sum(list_transform(range(0, least(k, n - k) + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) - n * ln(2))))), 6) AS p FROM (SELECT o_custkey, count(*) FILTER (o_totalprice > 100000) AS k, count(*) AS n FROM orders GROUP BY 1)""")
def agg_sign_test(spark, d):
    o = t(spark, d, "orders").groupBy("o_custkey").agg(F.count_if(F.col("o_totalprice") > 100000).alias("k"), F.count("*").alias("n"))
    return stats.sign_test(o, "k", "n").withColumn("p", F.round("p", 6))


@query("SELECT event_type, round(corr(rx, ry), 6) AS rho, round(regr_slope(value, user_id), 6) AS slope FROM (SELECT event_type, user_id, value, rank() OVER (PARTITION BY event_type ORDER BY user_id) + (count(*) OVER (PARTITION BY event_type, user_id) - 1) / 2.0 AS rx, rank() OVER (PARTITION BY event_type ORDER BY value) + (count(*) OVER (PARTITION BY event_type, value) - 1) / 2.0 AS ry FROM events) GROUP BY 1")
def agg_rank_trend(spark, d):
    return stats.rank_trend(t(spark, d, "events"), "user_id", "value", "event_type")


@query("SELECT max(p_size) AS p_size, max_by(peak, p_size) AS peak FROM (SELECT p_size, max(p_retailprice) AS peak FROM part GROUP BY 1 HAVING max(p_retailprice) < 0.85 * 2400)")
def agg_argmax_constraint(spark, d):
    return stats.argmax_constraint(t(spark, d, "part"), "p_size", "p_retailprice", 2400.0)


@query("SELECT doc_id FROM documents ORDER BY md5('7' || doc_id), doc_id LIMIT 30")
def smp_seeded_subset(spark, d):
    return stats.seeded_subset(t(spark, d, "documents").select("doc_id"), "doc_id", 30, "7")


@query(f"SELECT cohort, round(quantile_cont(value, .5), 6) AS median, round(avg(value), 6) AS mean, count(value) AS n FROM (SELECT 'all' AS cohort, value FROM events UNION ALL SELECT 'held', value FROM events WHERE user_id % 3 = 0) GROUP BY 1")
def agg_cohort_cut(spark, d):
    cohorts = F.when(F.col("user_id") % 3 == 0, F.array(F.lit("all"), F.lit("held"))).otherwise(F.array(F.lit("all")))
    return stats.median_mean(t(spark, d, "events").select(F.explode(cohorts).alias("cohort"), "value"), "cohort", "value")


@query("SELECT count(*) FILTER (l_quantity > 10) AS chains_valid, count(*) FILTER (l_quantity <= 10) AS chains_invalid, count(*) FILTER (l_returnflag = 'A') AS interfaces_valid, count(*) FILTER (l_returnflag <> 'A') AS interfaces_invalid FROM lineitem")
def agg_valid_totals(spark, d):
    lists = {"chains": F.col("l_quantity") > 10, "interfaces": F.col("l_returnflag") == "A"}
    g = t(spark, d, "lineitem").groupBy("l_orderkey").agg(*[F.collect_list(F.struct("l_linenumber", c.alias("valid"))).alias(k) for k, c in lists.items()])
    return stats.valid_totals(g, {k: k for k in lists})


@query("SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey IS NOT NULL AND l_partkey <> -1")
def agg_distinct_refs(spark, d):
    nested = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_partkey")).alias("refs"))
    return stats.distinct_refs(nested, "refs", "l_partkey")


# joins and sets


@query("SELECT c_custkey, c_name, coalesce(n_name, '?') AS n_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON c_nationkey = n_nationkey")
def join_metadata_left(spark, d):
    n = t(spark, d, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return joins.metadata_left(t(spark, d, "customer"), n, "c_nationkey", {"n_name": "?"}).select("c_custkey", "c_name", "n_name")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 250000)")
def join_anti_missing(spark, d):
    return joins.anti_missing(t(spark, d, "customer").select("c_custkey"), t(spark, d, "orders").where("o_totalprice > 250000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def join_semi_available(spark, d):
    return joins.semi_available(t(spark, d, "documents").select("doc_id", "n_chars"), t(spark, d, "labels"), "doc_id")


@query("SELECT l_orderkey, a.l_linenumber AS a, b.l_linenumber AS b FROM lineitem a JOIN lineitem b USING (l_orderkey) WHERE a.l_returnflag = 'A' AND b.l_returnflag = 'R'")
def join_cross_pairs(spark, d):
    return joins.cross_pairs(t(spark, d, "lineitem"), "l_orderkey", "l_linenumber", "l_returnflag", "A", "R")


@query("SELECT o_orderkey, p_partkey FROM orders, part WHERE o_orderkey >= p_partkey * 4 AND o_orderkey < p_partkey * 4 + p_size")
def join_interval_offsets(spark, d):
    r = t(spark, d, "part").select("p_partkey", (F.col("p_partkey") * 4).alias("s"), F.col("p_size").cast("long").alias("n"))
    return joins.interval_join(t(spark, d, "orders").select("o_orderkey"), r, "o_orderkey", "s", "n").select("o_orderkey", "p_partkey")


@query(f"SELECT a.id AS a_id, b.id AS b_id FROM {POINTS_SQL} a, {POINTS_SQL} b WHERE a.label < 3 AND b.label >= 3 AND (a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z) <= 20.25")
def join_radius(spark, d):
    p = points(spark, d)
    return joins.radius_join(p.where("label < 3"), p.where("label >= 3"), 4.5).select("a_id", "b_id")


@query(f"SELECT a.id, round(sqrt(min((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z))), 6) AS dist FROM {POINTS_SQL} a, {POINTS_SQL} b WHERE a.label < 3 AND b.label >= 3 AND (a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z) < 36 GROUP BY 1")
def join_min_distance(spark, d):
    p = points(spark, d)
    return geometry.min_distance(p.where("label < 3"), p.where("label >= 3"), 6.0)


@query("SELECT c_custkey, a, b, a // 10 IS DISTINCT FROM b // 10 AS changes FROM (SELECT c_custkey, c_nationkey AS a, CASE WHEN c_custkey % 7 = 0 THEN c_nationkey + 1 ELSE c_nationkey END AS b FROM customer) WHERE a IS DISTINCT FROM b")
def join_source_crosscheck(spark, d):
    c = t(spark, d, "customer")
    other = c.select("c_custkey", F.when(F.col("c_custkey") % 7 == 0, F.col("c_nationkey") + 1).otherwise(F.col("c_nationkey")).alias("c_nationkey"))
    return joins.source_crosscheck(c, other, "c_custkey", "c_nationkey", lambda n: F.floor(n / 10))


@query("SELECT l_partkey, count(DISTINCT l_orderkey) AS users, array_to_string(list_sort(list_distinct(list(l_orderkey)))[1:3], ',') AS used_by FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40) GROUP BY 1")
def join_reference_exists(spark, d):
    return joins.reference_exists(t(spark, d, "lineitem"), "l_partkey", "l_orderkey", t(spark, d, "part").where("p_size <= 40"), "p_partkey")


@query("SELECT c_custkey AS k FROM customer UNION SELECT o_custkey FROM orders")
def set_union_ids(spark, d):
    return joins.union_ids(t(spark, d, "customer").withColumnRenamed("c_custkey", "k"), t(spark, d, "orders").withColumnRenamed("o_custkey", "k"), "k")


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def set_difference_ids(spark, d):
    return joins.difference_ids(t(spark, d, "documents"), t(spark, d, "labels"), "doc_id")


@query("SELECT o_custkey, len(list_intersect(list(DISTINCT o_orderkey % 5), list(DISTINCT o_orderkey % 7))) AS shared FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer) GROUP BY 1")
def set_intersect_ids(spark, d):
    o = t(spark, d, "orders")
    both = joins.intersect_ids(t(spark, d, "customer").withColumnRenamed("c_custkey", "o_custkey"), o, "o_custkey")
    lists = o.groupBy("o_custkey").agg(F.collect_set(F.col("o_orderkey") % 5).alias("a"), F.collect_set(F.col("o_orderkey") % 7).alias("b"))
    return lists.join(both, "o_custkey").select("o_custkey", joins.overlap(F.col("a"), F.col("b")).cast("long").alias("shared"))


# windows and top-k


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_extendedprice DESC, l_linenumber, l_partkey, l_suppkey) = 1")
def win_best_pair(spark, d):
    return windows.best_pair(t(spark, d, "lineitem"), "l_orderkey", [F.desc("l_quantity"), F.desc("l_extendedprice"), F.asc("l_linenumber"), F.asc("l_partkey"), F.asc("l_suppkey")]).select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT l_orderkey, best, rival, coalesce(rival > 0.5 * best, false) AS ambiguous FROM (SELECT l_orderkey, max(l_quantity) FILTER (r = 1) AS best, max(l_quantity) FILTER (r > 1) AS rival FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber) AS r FROM lineitem) GROUP BY 1)")
def win_runner_up(spark, d):
    return windows.runner_up(t(spark, d, "lineitem"), "l_orderkey", "l_quantity", [F.desc("l_quantity"), F.asc("l_linenumber")])


@query("SELECT event_id, user_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def win_last_per_record(spark, d):
    return windows.last_per_record(t(spark, d, "events"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).select("event_id", "user_id", "event_type", "value")


@query("SELECT event_id, user_id, start FROM (SELECT event_id, user_id, value > 50 AS ok, min(event_id) FILTER (value > 50) OVER (PARTITION BY user_id) AS start FROM events) WHERE ok AND event_id < start + 1800")
def win_anchor_window(spark, d):
    e = t(spark, d, "events").select("event_id", "user_id", (F.col("value") > 50).alias("ok"))
    return windows.anchor_window(e, "user_id", "event_id", "ok", 1800).select("event_id", "user_id", "start")


@query("SELECT conv_id, turn FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) <= 2")
def win_depth_cap(spark, d):
    return windows.depth_cap(t(spark, d, "conversations"), "conv_id", "turn", [8, 4, 2], 5).select("conv_id", "turn")


@query("SELECT l_orderkey, string_agg(CASE WHEN a = b THEN a::varchar ELSE a || '-' || b END, '+' ORDER BY a) AS spans FROM (SELECT l_orderkey, g, min(l_linenumber) AS a, max(l_linenumber) AS b FROM (SELECT l_orderkey, l_linenumber, l_linenumber - row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS g FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) GROUP BY 1, 2) GROUP BY 1")
def win_islands(spark, d):
    return windows.islands(t(spark, d, "lineitem"), "l_orderkey", "l_linenumber")


@query("SELECT user_id, bool_and(ok) AS ok, arg_max(event_id + value, event_id) = max(event_id) + 20 AS end_ok FROM (SELECT user_id, event_id, value, coalesce(value > lag(value) OVER (PARTITION BY user_id ORDER BY event_id), true) AS ok FROM (SELECT user_id, event_id, floor(value) AS value FROM events)) GROUP BY 1")
def win_monotonic(spark, d):
    e = t(spark, d, "events").withColumn("value", F.floor("value"))
    return windows.monotonic(e, "user_id", "event_id", "value", F.col("event_id") + F.col("value"), F.col("event_id") + 20)


@query("SELECT event_id, user_id, value FROM (SELECT *, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM events) WHERE p IS NULL OR value > p + 0.05")
def win_high_water(spark, d):
    return windows.high_water(t(spark, d, "events"), "user_id", ["ts", "event_id"], "value").select("event_id", "user_id", "value")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 6")
def top_hardest(spark, d):
    return stats.top_rows(t(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey")


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey DESC LIMIT 6")
def top_most_dropped(spark, d):
    return stats.counter(t(spark, d, "orders"), "o_custkey").orderBy(F.desc("n"), F.desc("o_custkey")).limit(6)


# sequences


@query("SELECT p_partkey, CASE WHEN length(p_name) >= 5 THEN len(list_distinct(list_transform(range(1, length(p_name) - 3), lambda i: substring(p_name, i, 5)))) ELSE 0 END AS n FROM part")
def seq_kmers(spark, d):
    return t(spark, d, "part").select("p_partkey", F.size(seq.kmers(F.col("p_name"))).cast("long").alias("n"))


_PANEL_SQL = "SELECT DISTINCT unnest(list_transform(range(1, length(text) - 3), lambda i: substring(text, i, 5))) AS kmer FROM benchmark WHERE length(text) >= 5"


@query(f"SELECT kmer FROM ({_PANEL_SQL})")
def seq_kmer_panel(spark, d):
    return t(spark, d, "benchmark").select(F.explode(seq.kmers(F.col("text"))).alias("kmer")).distinct()


@query(f"WITH panel AS ({_PANEL_SQL}), k AS (SELECT DISTINCT conv_id, turn, unnest(list_transform(range(1, length(text) - 3), lambda i: substring(text, i, 5))) AS kmer FROM conversations WHERE length(text) >= 5) SELECT c.conv_id, c.turn, round(coalesce(s, 0), 6) AS score FROM conversations c LEFT JOIN (SELECT conv_id, turn, avg(CASE WHEN panel.kmer IS NULL THEN 0.0 ELSE 1.0 END) AS s FROM k LEFT JOIN panel USING (kmer) GROUP BY 1, 2) USING (conv_id, turn)")
def seq_kmer_containment(spark, d):
    c = t(spark, d, "conversations").select(F.struct("conv_id", "turn").alias("k"), "text")
    out = seq.kmer_containment(c, "k", "text", seq_kmer_panel(spark, d))
    return out.select("k.conv_id", "k.turn", F.round("score", 6).alias("score"))


@query("SELECT a.p_partkey, round(CASE WHEN length(a.p_name) = length(b.p_name) THEN list_sum(list_transform(range(1, length(a.p_name) + 1), lambda i: CASE WHEN a.p_name[i] = b.p_name[i] THEN 1.0 ELSE 0 END)) / length(a.p_name) END, 6) AS identity FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1")
def seq_wildcard_identity(spark, d):
    p = t(spark, d, "part").select("p_partkey", "p_name")
    q = p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_name").alias("other"))
    return p.join(q, "p_partkey").select("p_partkey", F.round(seq.wildcard_identity(F.col("p_name"), F.col("other")), 6).alias("identity"))


@query("""SELECT p_partkey, round(list_sum(list_transform(range(1, n + 1), lambda i: CASE WHEN a[i] = o[i] THEN 1.0 ELSE 0 END)) / n, 6) AS identity,
 contains(replace(b, 'X', ''), replace(x, 'X', '')) OR coalesce(len(list_filter(range(1, least(length(x), length(b)) + 1), lambda i: x[i] <> 'X' AND x[i] = b[i])) / nullif(len(list_filter(range(1, least(length(x), length(b)) + 1), lambda i: x[i] <> 'X')), 0), 0) >= 0.9 AS ok
 FROM (SELECT p.p_partkey, p.p_name AS a, q.p_name AS o, least(length(p.p_name), length(q.p_name)) AS n, replace(p.p_name, 'e', 'X') AS x,
 CASE p.p_partkey % 3 WHEN 0 THEN q.p_name || replace(p.p_name, 'e', '') WHEN 1 THEN replace(p.p_name, 'a', 'o') ELSE q.p_name END AS b
 FROM part p JOIN part q ON q.p_partkey = p.p_partkey + 1)""")
def seq_prefix_identity(spark, d):
    p = t(spark, d, "part").select("p_partkey", "p_name")
    pairs = p.join(p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_name").alias("other")), "p_partkey")
    masked, k = F.replace("p_name", F.lit("e"), F.lit("X")), F.col("p_partkey") % 3
    full = F.when(k == 0, F.concat("other", F.replace("p_name", F.lit("e"), F.lit("")))).when(k == 1, F.replace("p_name", F.lit("a"), F.lit("o"))).otherwise(F.col("other"))
    return pairs.select("p_partkey", F.round(seq.prefix_identity(F.col("p_name"), F.col("other")), 6).alias("identity"), seq.agrees(masked, full).alias("ok"))


@query("SELECT role, count(*) AS n, min(d) AS min, quantile_cont(d, .5) AS median, round(quantile_cont(d, .9), 6) AS p90, max(d) AS max FROM (SELECT role, conv_id, count(*) AS d FROM conversations GROUP BY 1, 2) GROUP BY 1")
def msa_depth_by_kind(spark, d):
    c = t(spark, d, "conversations").groupBy("role", "conv_id").agg(F.count("*").alias("d"))
    return stats.depth_by_kind(c, "role", "d")


@query("SELECT event_id, key AS name, CAST(json_extract(props, '$.\"' || key || '\"') AS double) AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events) WHERE starts_with(key, 'k')")
def json_dynamic_metrics(spark, d):
    return json_lines.dynamic_metrics(t(spark, d, "events"), "event_id", "props", ("k",), ())


@query("SELECT l_orderkey, min(l_quantity) AS min, round(avg(l_quantity), 4) AS mean, arg_min(l_quantity, (l_linenumber, l_quantity)) AS first FROM lineitem GROUP BY 1")
def arr_sample_stats(spark, d):
    ordered = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity")))
    a = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.transform(ordered, lambda x: x["l_quantity"]).alias("v"))
    return a.select("l_orderkey", stats.sample_stats(F.col("v")).alias("s")).select("l_orderkey", "s.*")


# geometry


@query(f"SELECT a.label AS grp, count(*) AS contacts, count(DISTINCT b.id) AS touched FROM {POINTS_SQL} a, {POINTS_SQL} b WHERE a.label < 3 AND b.label >= 3 AND (a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z) <= 20.25 GROUP BY 1")
def geo_pair_contacts(spark, d):
    p = points(spark, d)
    return geometry.pair_contacts(p.where("label < 3").withColumn("grp", F.col("label")), p.where("label >= 3"))


@query(f"WITH c AS (SELECT id % 50 AS entry, label, avg(x) AS x, avg(y) AS y, avg(z) AS z FROM {POINTS_SQL} GROUP BY 1, 2) SELECT entry, a.label AS a, b.label AS b, round(sqrt(power(a.x-b.x,2)+power(a.y-b.y,2)+power(a.z-b.z,2)), 6) AS dist FROM c a JOIN c b USING (entry) WHERE a.label < b.label")
def geo_centroid_distance(spark, d):
    out = geometry.centroid_distances(points(spark, d).withColumn("entry", F.col("id") % 50), "entry", "label")
    return out.withColumn("dist", F.round("dist", 6))


# superposition in SQL: moments about means, the quartic's largest root, and the adjoint for a transfer

_P6 = ["px", "py", "pz", "tx", "ty", "tz"]
_PAIRS_SQL = "(SELECT vec_id, label, vec_id % 3 > 0 AS fit, " + ", ".join(f"50*embedding[{k}]::double AS {c}" for k, c in enumerate(_P6, 1)) + " FROM embeddings)"
_NINE = [c + e for c in "xyz" for e in "xyz"]


def _moments_sql(src: str, by: str, fit: str, cond: str) -> str:
    """Moments of the rows of ``cond`` about the means of those of ``fit``."""
    means = f"(SELECT {by}, {', '.join(f'avg({c}) FILTER ({fit}) AS m{c}' for c in _P6)} FROM {src} GROUP BY ALL)"
    nine = ", ".join(f"coalesce(sum((p{m[0]} - mp{m[0]}) * (t{m[1]} - mt{m[1]})) FILTER ({cond}), 0) AS {m}" for m in _NINE)
    total = " + ".join(f"power({c} - m{c}, 2)" for c in _P6)
    return f"(SELECT {by}, count(*) FILTER ({cond}) AS n, {nine}, coalesce(sum({total}) FILTER ({cond}), 0) AS total FROM {src} JOIN {means} USING ({by}) GROUP BY ALL)"


def _root_sql(d: str) -> str:
    f, slope = f"(((x*x - 2)*x - 8*({d}))*x + 1 - 4*e)", f"(4*(x*x - 1)*x - 8*({d}))"
    return f"list_reduce(list_prepend(sqrt(3.0::double), list_transform(range(60), lambda i: 0.0::double)), lambda x, i: CASE WHEN {f} > 0 AND {slope} > 0 THEN x - {f}/{slope} ELSE x END)"


def _fit_sql(src: str, by: str, cond: str) -> str:
    """With n, total, scale, root and mirror; rmsd and rmsd_mirror follow."""
    size = " + ".join(f"{m}*{m}" for m in _NINE)
    minors = " + ".join(f"power({p[0]}{q[0]}*{p[1]}{q[1]} - {p[0]}{q[1]}*{p[1]}{q[0]}, 2)" for p in ("xy", "xz", "yz") for q in ("xy", "xz", "yz"))
    det = "xx*(yy*zz - yz*zy) - xy*(yx*zz - yz*zx) + xz*(yx*zy - yy*zx)"
    inner = f"(SELECT *, sqrt(f) AS scale, coalesce(({det}) / nullif(power(f, 1.5), 0), 0) AS d, coalesce(({minors}) / nullif(f*f, 0), 0) AS e FROM (SELECT *, {size} AS f FROM {_moments_sql(src, by, cond, cond)}))"
    rooted = f"(SELECT *, {_root_sql('d')} AS root, {_root_sql('-d')} AS mirror FROM {inner})"
    rmsd = lambda r: f"sqrt(greatest(0, total - 2*scale*{r}) / nullif(n, 0))"
    return f"(SELECT *, {rmsd('root')} AS rmsd, {rmsd('mirror')} AS rmsd_mirror FROM {rooted})"


def _transfer_sql(src: str, by: str, fit: str, cond: str) -> str:
    """(by, m, moved): points of ``cond`` and their RMSD under the motion that fits ``fit``."""
    key = lambda q: [[f"{q}xx+{q}yy+{q}zz", f"{q}yz-{q}zy", f"{q}zx-{q}xz", f"{q}xy-{q}yx"], [None, f"{q}xx-{q}yy-{q}zz", f"{q}xy+{q}yx", f"{q}zx+{q}xz"], [None, None, f"{q}yy-{q}xx-{q}zz", f"{q}yz+{q}zy"], [None, None, None, f"{q}zz-{q}xx-{q}yy"]]
    upper = [(i, j) for i in range(4) for j in range(i, 4)]
    ks = ", ".join(f"({key('a.')[i][j]})/nullif(a.scale, 0){' - a.root' if i == j else ''} AS k{i}{j}" for i, j in upper)
    ms = ", ".join(f"({key('b.')[i][j]})/nullif(a.scale, 0) AS m{i}{j}" for i, j in upper)
    k = lambda i, j: f"k{min(i, j)}{max(i, j)}"

    def cofactor(i, j):
        (a, b, c), (p, q, r) = ([n for n in range(4) if n != skip] for skip in (i, j))
        det = f"({k(a, p)}*({k(b, q)}*{k(c, r)} - {k(b, r)}*{k(c, q)}) - {k(a, q)}*({k(b, p)}*{k(c, r)} - {k(b, r)}*{k(c, p)}) + {k(a, r)}*({k(b, p)}*{k(c, q)} - {k(b, q)}*{k(c, p)}))"
        return det if (i + j) % 2 == 0 else f"(-{det})"

    both = " + ".join(f"{1 if i == j else 2}*{cofactor(i, j)}*m{i}{j}" for i, j in upper)
    trace = " + ".join(cofactor(i, i) for i in range(4))
    cols = ", ".join(f"{alias}.{c}" for alias, c in (("a", "scale"),))
    base = f"(SELECT {by}, {cols}, b.n AS m, b.total AS rest, {ks}, {ms} FROM {_fit_sql(src, by, fit)} a JOIN {_moments_sql(src, by, fit, cond)} b USING ({by}))"
    return f"(SELECT {by}, m, sqrt(CASE WHEN rest - 2*scale*({both})/tr IS NOT NULL THEN greatest(0, rest - 2*scale*({both})/tr) END / nullif(m, 0)) AS moved FROM (SELECT *, CASE WHEN abs({trace}) > 1e-6 THEN {trace} END AS tr FROM {base}))"


def _rounded(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


@query(f"SELECT label, n, round(rmsd, 6) AS rmsd, round(rmsd_mirror, 6) AS rmsd_mirror FROM {_fit_sql(_PAIRS_SQL, 'label', 'true')}")
def geo_superpose_rmsd(spark, d):
    return _rounded(geometry.superpose_rmsd(point_pairs(spark, d), "label"), "rmsd", "rmsd_mirror")


# sources and sinks


@query("SELECT o_orderkey, o_custkey, 0::bigint AS depth, o_totalprice FROM orders")
def schema_conform(spark, d):
    from pyspark.sql.types import StructType

    target = StructType.fromDDL("o_orderkey bigint, o_custkey bigint, depth bigint, o_totalprice double")
    return tables.conform(t(spark, d, "orders"), target)


@query("SELECT l_orderkey, l_linenumber, upper(l_returnflag || l_linestatus) AS seq, 2 AS length, array_to_string(CASE WHEN l_suppkey % 2 = 0 THEN ['a', 'b'] ELSE ['b'] END, ',') AS accessions FROM lineitem")
def src_nested_metadata(spark, d):
    names = F.when(F.col("l_suppkey") % 2 == 0, F.array(F.lit("b"), F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("b"), F.lit(None).cast("string")))
    item = F.struct("l_linenumber", F.concat(F.lower("l_returnflag"), F.lit("\n"), "l_linestatus").alias("seq"), names.alias("accessions"))
    nested = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(item).alias("items"))
    return tables.polymer_entities(nested, "l_orderkey", "items", "seq", ("accessions",)).withColumn("accessions", F.array_join("accessions", ","))


@query("SELECT o_orderkey AS name, m.o AS \"offset\", m.s AS size, m IS NOT NULL AS found FROM orders LEFT JOIN (SELECT l_orderkey, max({'f': l_linenumber, 'o': l_partkey, 's': l_suppkey}) AS m FROM lineitem WHERE l_quantity > 25 GROUP BY 1) ON l_orderkey = o_orderkey")
def src_member_index(spark, d):
    size = F.when(F.col("l_quantity") > 25, F.col("l_suppkey")).otherwise(-1)
    rows = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("name"), F.col("l_linenumber").alias("file_no"), F.col("l_partkey").alias("offset"), size.alias("size"))
    return tables.member_index(rows, t(spark, d, "orders").select(F.col("o_orderkey").alias("name")))


@query("SELECT page_id, len(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS links FROM pages")
def prj_html_links(spark, d):
    found = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    return t(spark, d, "pages").select("page_id", F.size(found).cast("long").alias("links"))


@query("SELECT o_orderkey, l_linenumber AS no, l_returnflag AS flag, CASE WHEN l_orderkey IS NULL THEN 'no array' END AS error FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND o_orderkey % 7 <> 0")
def src_html_json_array(spark, d):
    items = t(spark, d, "lineitem").where("l_orderkey % 7 <> 0").groupBy("l_orderkey").agg(F.to_json(F.collect_list(F.struct(F.col("l_linenumber").alias("no"), F.col("l_returnflag").alias("flag")))).alias("j"))
    page = F.when(F.col("j").isNotNull(), F.concat(F.lit("<html><script>var rows = "), "j", F.lit(";</script></html>"))).otherwise("<html></html>")
    pages = t(spark, d, "orders").join(items, F.col("l_orderkey") == F.col("o_orderkey"), "left").select("o_orderkey", page.alias("html"))
    return tables.html_json_array(pages, "o_orderkey", "html", r"var rows = (\[.*?\]);", "no int, flag string").select("o_orderkey", "no", "flag", "error")


@query("SELECT l_orderkey, o.l_linenumber, o.l_partkey FROM (SELECT DISTINCT l_orderkey FROM lineitem) LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'N') o USING (l_orderkey)")
def src_nested_second_list(spark, d):
    item = F.struct("l_linenumber", "l_partkey")
    nested = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.when(F.col("l_returnflag") != "N", item)).alias("polymers"), F.collect_list(F.when(F.col("l_returnflag") == "N", item)).alias("others"))
    return tables.flatten(nested, "l_orderkey", "others")


@query("SELECT l_orderkey AS id, count(*) AS n_chains, sum(l_partkey)::bigint AS parts FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 200000) GROUP BY 1")
def src_manifest_array(spark, d):
    path = tables.shared_path(spark)
    records = t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_list(F.struct(F.col("l_linenumber").alias("chain_id"), F.col("l_partkey").alias("part"))).alias("chains"))
    tables.write_manifest(records.withColumn("file", F.floor(F.col("id") / 20000)), path, "file", "id")  # files grow with the table
    wanted = t(spark, d, "orders").where("o_totalprice > 200000").select(F.col("o_orderkey").alias("id"))
    got = tables.read_manifest(spark, path, "id long, chains array<struct<chain_id int, part long>>", wanted, "id", 1 << 18)
    return got.select("id", F.size("chains").cast("long").alias("n_chains"), F.aggregate("chains", F.lit(0).cast("long"), lambda a, c: a + c["part"]).alias("parts"))


_ENTRY_SQL = "(SELECT vec_id, 'e' || (vec_id // 60) AS path, vec_id % 60 AS i, vec_id // 60 % 2 = 0 AS whole, embedding FROM embeddings)"


@query(f"SELECT path, count(DISTINCT i // 20) AS chains, count(DISTINCT i // 5) AS residues, count(*) AS atoms, count(*) FILTER (vec_id % 3 > 0) AS present, round(sum(embedding[CASE WHEN whole THEN 4 ELSE 1 END]::double), 4) AS sx, sum(DISTINCT i // 5 * 5)::bigint AS offsets FROM {_ENTRY_SQL} GROUP BY path")
def src_structure_ingest(spark, d):
    import io

    import numpy as np
    import pandas as pd

    def packed(group):  # an entry of 60 atoms
        group = group.sort_values("vec_id")
        out, e, n = io.BytesIO(), np.stack(group.embedding.to_numpy())[:, :6].astype(float), len(group)
        no = int(group.vec_id.iloc[0]) // 60
        runs = lambda size: [(a, min(size, n - a)) for a in range(0, n, size)]
        chains = np.array([(f"c{a}", True, a, m, a // 5, -(-m // 5)) for a, m in runs(20)], [("name", "U8"), ("present", "?"), *[(f, "<i4") for f in ("atom_idx", "atom_num", "res_idx", "res_num")]])
        residues = np.array([("GLY", True, a, m) for a, m in runs(5)], [("name", "U3"), ("present", "?"), ("atom_idx", "<i4"), ("atom_num", "<i4")])
        atoms = np.array([("CA", v % 3 > 0, tuple(x)) for v, x in zip(group.vec_id, e[:, :3])], [("name", "U4"), ("present", "?"), ("coords", "<f8", 3)])
        model = e[:, 3:6] if no % 2 == 0 else e[:-1, 3:6]  # of odd entries the ensemble lacks an atom
        coords = np.array([(tuple(x),) for x in model], [("coords", "<f8", 3)])
        np.savez(out, chains=chains, residues=residues, atoms=atoms, coords=coords, ensemble=np.array([(0, len(model))], [("atom_coord_idx", "<i4"), ("atom_num", "<i4")]))
        return pd.DataFrame({"path": [f"e{no}"], "content": [out.getvalue()]})

    files = t(spark, d, "embeddings").groupBy(F.floor(F.col("vec_id") / 60)).applyInPandas(packed, "path string, content binary")
    made = structures.write_structures(files, tables.shared_path(spark))
    n = lambda kind, *more: made[kind].groupBy("path").agg(F.count("*").alias(kind), *more)
    atoms = n("atoms", F.count_if("present").alias("present"), F.round(F.sum("x"), 4).alias("sx"))
    return n("chains").join(n("residues", F.sum("atom_idx").alias("offsets")), "path").join(atoms, "path")


@query(f"SELECT CASE split WHEN 'test' THEN 'held' ELSE 'open' END AS side, split, count(*) AS n FROM {SPLITS_SQL} GROUP BY 1, 2")
def sink_split_partitions(spark, d):
    a, b = tables.write_splits(split_orders(spark, d).select("o_orderkey", "split"), tables.shared_path(spark), "split", "test")
    sides = spark.read.parquet(a).select(F.lit("open").alias("side"), "split").union(spark.read.parquet(b).select(F.lit("held"), "split"))
    return stats.counter(sides, "side", "split")


@query(f"SELECT split, o_orderkey FROM {SPLITS_SQL}")
def sink_id_lists(spark, d):
    path = tables.shared_path(spark)
    tables.write_id_lists(split_orders(spark, d), path, "split", "o_orderkey")
    return spark.read.schema("value string, split string").text(path).select("split", F.col("value").cast("long").alias("o_orderkey"))


@query("SELECT event_type, user_id % 4 AS step, count(*) AS n FROM events GROUP BY 1, 2")
def sink_step_snapshots(spark, d):
    path = tables.shared_path(spark)
    n = stats.counter(t(spark, d, "events").select("event_type", (F.col("user_id") % 4).alias("step")), "event_type", "step")
    tables.write_snapshots(n.where("step < 3").withColumn("n", F.lit(0).cast("long")), path, ["event_type", "step"])
    tables.write_snapshots(n, path, ["event_type", "step"])
    return spark.read.schema("n long, event_type string, step long").parquet(path).select("event_type", "step", "n")


# streams over the files of events


def _stream(spark, d):
    return spark.readStream.schema(t(spark, d, "events").schema).option("pathGlobFilter", "events.parquet").parquet(d)


@query("SELECT event_type, round(sum(value * (user_id % 3 + 1)) / sum(user_id % 3 + 1), 6) AS mean, count(value) AS n FROM events WHERE value IS NOT NULL GROUP BY 1")
def st_running_metrics(spark, d):
    sums = metrics.running_metrics(_stream(spark, d), "event_type", "value", F.col("user_id") % 3 + 1)
    out = metrics.run_updates(sums, tables.shared_path(spark), ["event_type"])
    return out.select("event_type", F.round(F.col("total") / F.col("weight"), 6).alias("mean"), F.col("rows").alias("n"))


@query("SELECT user_id, max(value) AS peak FROM events GROUP BY 1")
def st_running_peak(spark, d):
    return metrics.run_updates(metrics.running_peak(_stream(spark, d), "user_id", "value"), tables.shared_path(spark), ["user_id"]).drop("batch")


@query("SELECT event_id, CASE WHEN value IS NULL THEN 'no value' WHEN value > 50 THEN 'too far' END AS reason FROM events")
def st_append_rows(spark, d):
    rows = metrics.with_reason(_stream(spark, d), [(F.col("value").isNull(), "no value"), (F.col("value") > 50, "too far")])
    good, aside = metrics.append_once(rows.select("event_id", "reason"), tables.shared_path(spark), F.col("reason") == "no value")
    return good.union(aside).select("event_id", "reason")


# checks


@query("SELECT count(*) FILTER (a AND b) AS passed, count(*) AS total FROM (SELECT o_custkey IN (SELECT c_custkey FROM customer) AS a, o_orderkey IN (SELECT l_orderkey FROM lineitem) AS b FROM orders)")
def chk_provenance(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey")
    known = o.join(t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey")).distinct(), "o_custkey", "left_semi")
    return checks.summed(checks.provenance(o, "o_orderkey", {"customer": (known, "o_orderkey"), "lineitem": (t(spark, d, "lineitem"), "l_orderkey")}))


@query("SELECT count(*) FILTER (ok) AS passed, count(*) AS total FROM (SELECT bool_or(l_returnflag = 'A' AND l_quantity > 10) AS ok FROM lineitem GROUP BY l_orderkey)")
def chk_role_present(spark, d):
    return checks.summed(checks.role_present(t(spark, d, "lineitem"), "l_orderkey", "l_returnflag", ["A"], F.col("l_quantity") > 10))


@query("SELECT l_partkey, p_partkey IS NOT NULL AS passed, CASE WHEN p_partkey IS NULL THEN count(DISTINCT l_orderkey) END AS users, CASE WHEN p_partkey IS NULL THEN array_to_string(list_sort(list_distinct(list(l_orderkey)))[1:3], ',') END AS used_by FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 3) ON p_partkey = l_partkey WHERE l_partkey <> 7 GROUP BY l_partkey, p_partkey")
def chk_references(spark, d):
    return checks.references(t(spark, d, "lineitem"), "l_partkey", "l_orderkey", t(spark, d, "part").where("p_size > 3"), "p_partkey", ("", "-1", "7"))


@query(f"SELECT o_orderpriority, o_custkey FROM {SPLITS_SQL} GROUP BY 1, 2 HAVING count(DISTINCT split) > 1")
def chk_leakage(spark, d):
    g = split_orders(spark, d).groupBy("o_orderpriority", "o_custkey").agg(F.min("split").alias("lo"), F.max("split").alias("hi"))
    return g.where("lo <> hi").select("o_orderpriority", "o_custkey")


@query("""WITH e AS (SELECT * FROM events WHERE user_id % 5 <> 0), c AS (SELECT count(*) AS n, count(*) - count(DISTINCT event_id) AS twice, count(*) FILTER (NOT (value >= 0 AND value < 30 AND value / 2 < 30 AND value - 1 >= 0)) AS bad FROM e)
 SELECT unnest(['count', 'ids', 'values']) AS "check", unnest([n = 7976, twice = 0, bad = 0]) AS passed, unnest([n, twice, bad]) AS found FROM c""")
def chk_eval_rows(spark, d):
    e = t(spark, d, "events").withColumns({"v": F.array(F.col("value"), F.col("value") / 2, F.col("value") - 1), "sanity": F.col("user_id") % 5 == 0})
    return checks.eval_rows(e, "event_id", "v", "sanity", 7976)


# further joins and geometry


@query("SELECT round(avg((list_contains(u, user_id % 7))::int), 6) AS rate, count(*) FILTER (list_contains(u, user_id % 7)) AS n_match, count(*) AS n FROM events JOIN (SELECT event_type, list(DISTINCT event_id % 7) AS u FROM events WHERE value > 30 GROUP BY 1) USING (event_type)")
def join_name_crosscheck(spark, d):
    e = t(spark, d, "events")
    ids = e.where("value > 30").groupBy("event_type").agg(F.collect_set(F.col("event_id") % 7).alias("u"))
    return joins.name_crosscheck(e.join(ids, "event_type"), F.col("user_id") % 7, "u").withColumn("rate", F.round("rate", 6))


GROOVE_SQL = f"SELECT b.label, count(*) AS contacts, count(DISTINCT a.id % 190) FILTER (a.id % 190 < 90) AS lower, count(DISTINCT a.id % 190) FILTER (a.id % 190 >= 90) AS upper FROM {POINTS_SQL} a, {POINTS_SQL} b WHERE a.label = 0 AND b.label <> 0 AND (a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z) <= 20.25 GROUP BY 1"


def groove(spark, d):
    p = points(spark, d)
    rest = p.where("label <> 0")
    hits = joins.radius_join(p.where("label = 0"), rest, 4.5).join(rest.select(F.col("id").alias("b_id"), "label"), "b_id")
    return geometry.groove_halves(hits.withColumn("residue", F.col("a_id") % 190), "label", "residue")


@query(f"SELECT *, lower > 0 AND upper > 0 AS in_groove FROM ({GROOVE_SQL})")
def geo_groove_halves(spark, d):
    return groove(spark, d)


@query(f"SELECT DISTINCT b.label FROM {POINTS_SQL} b WHERE b.label <> 0 AND b.label NOT IN (SELECT q.label FROM {POINTS_SQL} p, {POINTS_SQL} q WHERE p.label = 0 AND q.label <> 0 AND (p.x-q.x)*(p.x-q.x)+(p.y-q.y)*(p.y-q.y)+(p.z-q.z)*(p.z-q.z) <= 0.25)")
def geo_detached(spark, d):
    p = points(spark, d)
    rest = p.where("label <> 0")
    near = joins.radius_join(p.where("label = 0"), rest, 0.5).select(F.col("b_id").alias("id")).distinct()
    touched = rest.join(near, "id", "left_semi").select("label").distinct()
    return rest.select("label").distinct().join(touched, "label", "left_anti")


# sequences against a catalogue

_SEQ = "string_agg(CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'R' THEN 'R' ELSE 'X' END, '' ORDER BY l_linenumber, CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'R' THEN 'R' ELSE 'X' END)"
_SEQS_SQL = f"s AS (SELECT l_orderkey AS o, l_orderkey // 100 AS entry, {_SEQ} AS seq FROM lineitem GROUP BY 1)"
_IDENTITY = "len(list_filter(range(1, length(x) + 1), lambda i: x[i] <> 'X' AND y[i] <> 'X' AND x[i] = y[i])) / nullif(len(list_filter(range(1, length(x) + 1), lambda i: x[i] <> 'X' AND y[i] <> 'X')), 0)"
_STAGES_SQL = f"""{_SEQS_SQL},
 e AS (SELECT entry, seq AS y, max(o) AS ent FROM s WHERE o % 10 = 0 GROUP BY 1, 2),
 c AS (SELECT DISTINCT entry, seq AS x FROM s WHERE o % 10 <> 0),
 w AS (SELECT entry, x, ent, {_IDENTITY} AS v FROM c JOIN e USING (entry) WHERE length(x) = length(y)),
 b AS (SELECT entry, x, ent, v FROM w WHERE v >= 0.9 QUALIFY row_number() OVER (PARTITION BY entry, x ORDER BY v DESC, ent) = 1)"""


def _sequences(spark, d):
    s = rules.category_sequence(t(spark, d, "lineitem"), "l_orderkey", "l_linenumber", "l_returnflag", {"A": "A", "R": "R"})
    s = s.select(F.col("l_orderkey").alias("o"), F.floor(F.col("l_orderkey") / 100).alias("entry"), "seq")
    return s.where("o % 10 <> 0"), s.where("o % 10 = 0").select("entry", F.col("o").alias("ent"), "seq")


@query(f"WITH {_SEQS_SQL} SELECT c.o, c.entry, c.seq, e.ent FROM s c JOIN (SELECT entry, seq, max(o) AS ent FROM s WHERE o % 10 = 0 GROUP BY 1, 2) e USING (entry, seq) WHERE c.o % 10 <> 0")
def join_exact_sequence(spark, d):
    return joins.exact_sequence(*_sequences(spark, d), "entry", "seq", "ent")


@query(f"WITH {_STAGES_SQL} SELECT entry, x, ent, round(v, 6) AS value FROM b")
def join_wildcard_sequence(spark, d):
    x, e = alignment._sequences(*_sequences(spark, d), "entry", "seq", "ent")
    return alignment.wildcard_match(x, e, "entry", "ent").withColumn("value", F.round("value", 6))


@query()
def join_alignment_fallback(spark, d):
    x, e = alignment._sequences(*_sequences(spark, d), "entry", "seq", "ent")
    return alignment.alignment_match(x, e, "entry", "ent", aligned=None)


@query()
def seq_local_alignment(spark, d):
    chains, entities = _sequences(spark, d)
    x, e = alignment._sequences(chains, entities, "entry", "seq", "ent")
    return alignment.align_pairs(alignment.pairs_in_reach(x, e, "entry"))


@query(f"""WITH {_STAGES_SQL}
 SELECT CASE WHEN k.y IS NOT NULL THEN 'exact' WHEN b.x IS NOT NULL THEN 'wildcard' ELSE 'later' END AS stage, count(*) AS n, sum(coalesce(k.ent, b.ent))::bigint AS ents
 FROM s LEFT JOIN e k ON k.entry = s.entry AND k.y = s.seq LEFT JOIN b ON b.entry = s.entry AND b.x = s.seq AND k.y IS NULL WHERE s.o % 10 <> 0 GROUP BY 1""")
def join_match_cascade(spark, d):
    out = alignment.match_cascade(*_sequences(spark, d), "entry", "seq", "ent")
    early = F.col("evidence").isin("exact", "wildcard")
    return out.groupBy(F.when(early, F.col("evidence")).otherwise("later").alias("stage")).agg(F.count("*").alias("n"), F.sum(F.when(early, F.col("ent"))).alias("ents"))


def long_sequences(spark, d):
    """A letter for each line of a customer, by part. Entities are all customers, 20 an entry; chains are
    theirs too: whole, with X for dear lines, without large lines, or with small lines only."""
    lines = t(spark, d, "lineitem").join(t(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("cust")), "l_orderkey")
    lines = lines.withColumn("at", F.col("l_orderkey") * 100 + F.col("l_linenumber")).withColumn("part", (F.col("l_partkey") % 20).cast("string"))
    letters = {str(k): c for k, c in enumerate("ACDEFGHIKLMNPQRSTVWY")}
    kind, n = F.col("cust") % 4, F.col("l_quantity")
    kept = lines.where((kind < 2) | (n <= F.when(kind == 2, 45).otherwise(20))).withColumn("part", F.when((kind == 1) & (n > 45), "X").otherwise(F.col("part")))
    whole, cut = (rules.category_sequence(x, "cust", "at", "part", letters).withColumn("entry", F.floor(F.col("cust") / 20)) for x in (lines, kept))
    return cut, whole.select("entry", F.col("cust").alias("ent"), "seq")


@query()
def join_match_cascade_long(spark, d):
    return alignment.match_cascade(*long_sequences(spark, d), "entry", "seq", "ent").select("cust", "entry", "ent", F.round("value", 6).alias("value"), "evidence")


@query()
def join_alignment_share(spark, d):
    x, e = alignment._sequences(*long_sequences(spark, d), "entry", "seq", "ent")
    return alignment.aligned_share(alignment.pairs_in_reach(x, e, "entry"))


@query("""SELECT l_orderkey, CASE WHEN len(a) <> len(b) THEN 'count' WHEN a <> b THEN 'name' ELSE 'ok' END AS kind,
 array_to_string(list_filter(range(0, greatest(len(a), len(b))), lambda i: a[i + 1] IS DISTINCT FROM b[i + 1])[1:4], ',') AS bad
 FROM (SELECT l_orderkey, list(l_linenumber ORDER BY l_linenumber) AS a, coalesce(list(l_linenumber ORDER BY l_linenumber) FILTER (l_quantity < 45), []) AS b FROM lineitem GROUP BY 1)""")
def join_positional_align(spark, d):
    lists = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("a"), F.array_sort(F.collect_list(F.when(F.col("l_quantity") < 45, F.col("l_linenumber")))).alias("b"))
    return alignment.positional_align(lists, "l_orderkey", "a", "b").withColumn("bad", F.array_join(F.col("bad").cast("array<string>"), ","))


_AGREE = "replace(a, 'X', '')"


@query(f"""SELECT count(*) FILTER (contains(replace(b, 'X', ''), {_AGREE}) OR coalesce(v, 0) >= 0.9) AS passed, count(*) AS total FROM (
 SELECT a, b, len(list_filter(range(1, least(length(a), length(b)) + 1), lambda i: a[i] <> 'X' AND a[i] = b[i])) / nullif(len(list_filter(range(1, least(length(a), length(b)) + 1), lambda i: a[i] <> 'X')), 0) AS v
 FROM (SELECT seq AS a, CASE WHEN o % 3 = 0 THEN replace(seq, 'R', 'A') WHEN o % 3 = 1 THEN seq[2:] ELSE 'A' || seq END AS b FROM (WITH {_SEQS_SQL} SELECT * FROM s)))""")
def chk_sequence_match(spark, d):
    chains, entities = _sequences(spark, d)
    s = chains.select("o", "seq").union(entities.select("ent", "seq"))
    b = F.when(F.col("o") % 3 == 0, F.replace("seq", F.lit("R"), F.lit("A"))).when(F.col("o") % 3 == 1, F.substring("seq", 2, 1 << 20)).otherwise(F.concat(F.lit("A"), "seq"))
    return s.agg(F.count_if(seq.agrees(F.col("seq"), b)).alias("passed"), F.count("*").alias("total"))


# curves and tables of runs

_CUTS = "[0, n // 8, n // 4, n // 2, 3 * n // 4, n, n + 1]"


@query(f"""WITH m AS (SELECT max(event_id) AS n FROM events), e AS (SELECT *, list_max(list_filter({_CUTS}, lambda x: x <= event_id)) AS bucket FROM events, m)
 SELECT bucket, count(*) AS n, round(avg(value), 6) AS mean, count(*) FILTER (value IS NULL) AS non_finite, max_by(user_id, event_id) AS rate, round(quantile_cont(value, .5), 6) AS secs FROM e GROUP BY 1""")
def agg_progress_buckets(spark, d):
    out = stats.progress_buckets(t(spark, d, "events"), "event_id", "value", "user_id", "value")
    return out.withColumns({"mean": F.round("mean", 6), "secs": F.round("secs", 6)})


@query("""WITH s AS (SELECT event_type, user_id, event_id, event_id % 97 = 0 AS odd, CASE WHEN value > 5 AND event_id % 97 <> 0 THEN value END AS v, value > 90 AS swap FROM events),
 r AS (SELECT user_id, avg(value) AS ref FROM events WHERE user_id % 10 <> 0 GROUP BY 1),
 p AS (SELECT event_type, user_id, min(v) AS best, avg(v) AS m, min_by(coalesce(v, -1), event_id) AS first, any_value(ref) AS ref, count(*) FILTER (odd OR v IS NOT NULL) AS filled FROM s LEFT JOIN r USING (user_id) GROUP BY 1, 2)
 SELECT event_type, round(pooled, 6) AS pooled_median, round(mean, 6) AS mean, ok, failed, round(fm, 6) AS first_median, round(bm, 6) AS best_median, non_finite, swaps, paired, improved, round(dm, 6) AS delta
 FROM (SELECT event_type, quantile_cont(v, .5) AS pooled, avg(v) AS mean, count(*) FILTER (odd) AS non_finite, count(*) FILTER (swap) AS swaps FROM s GROUP BY 1)
 JOIN (SELECT event_type, count(*) FILTER (filled > 0) AS ok, count(*) FILTER (filled = 0) AS failed, quantile_cont(nullif(first, -1), .5) AS fm, quantile_cont(best, .5) AS bm, quantile_cont(m - ref, .5) AS dm, count(m - ref) AS paired, count(*) FILTER (m < ref) AS improved FROM p GROUP BY 1) USING (event_type)""")
def agg_validation_curve(spark, d):
    e = t(spark, d, "events")
    v = F.when(F.col("event_id") % 97 == 0, F.when(F.col("event_id") % 2 == 0, float("nan")).otherwise(float("inf"))).when(F.col("value") > 5, F.col("value"))
    samples = e.select("event_type", "user_id", "event_id", v.alias("v"), "value")
    out = stats.validation_curve(samples, e.where("user_id % 10 <> 0").groupBy("user_id").agg(F.avg("value").alias("ref")), "event_type", "user_id", "event_id", "v", "value", 90.0)
    return _rounded(out, "pooled_median", "mean", "first_median", "best_median", "delta")


_RECORDS_SQL = "(SELECT event_type, user_id, avg(value) AS m, user_id % 3 = 0 AS held, (user_id % 4)::varchar AS bucket FROM events GROUP BY 1, 2)"
_BUCKETS = ["0", "1", "2", "3"]


def _records(spark, d):
    r = t(spark, d, "events").groupBy("event_type", "user_id").agg(F.avg("value").alias("m"))
    return r.withColumns({"held": F.col("user_id") % 3 == 0, "bucket": (F.col("user_id") % 4).cast("string")})


@query(f"""WITH e AS (SELECT *, user_id % 3 = 0 AS held, (user_id % 4)::varchar AS bucket FROM events), r AS (SELECT user_id, avg(value) AS ref FROM events WHERE user_id % 10 <> 0 GROUP BY 1),
 p AS (SELECT event_type, user_id, avg(value) AS m, arg_min(value, event_id) AS first, any_value(held) AS held, any_value(ref) AS ref FROM e LEFT JOIN r USING (user_id) GROUP BY 1, 2)
 SELECT * FROM (SELECT event_type, round(avg(value), 6) AS mean, round(quantile_cont(value, .5), 6) AS median, {', '.join(f"round(quantile_cont(value, .5) FILTER (bucket = '{b}'), 6) AS m_{b}" for b in _BUCKETS)} FROM e GROUP BY 1)
 JOIN (SELECT event_type, count(*) AS n, count(*) FILTER (m < ref) AS improved, count(m - ref) AS paired, count(*) FILTER (m < ref AND held) AS held_improved, count(m - ref) FILTER (held) AS held_paired,
   round(quantile_cont(first, .5), 6) AS first_median, round(quantile_cont(m - ref, .5), 6) AS delta, round(quantile_cont(m - ref, .5) FILTER (held), 6) AS held_delta FROM p GROUP BY 1) USING (event_type)""")
def agg_eval_table(spark, d):
    e = t(spark, d, "events").withColumns({"held": F.col("user_id") % 3 == 0, "bucket": (F.col("user_id") % 4).cast("string")})
    ref = e.where("user_id % 10 <> 0").groupBy("user_id").agg(F.avg("value").alias("ref"))
    out = stats.eval_table(e, ref, "event_type", "user_id", "event_id", "value", "held", "bucket", _BUCKETS)
    return _rounded(out, "mean", "median", "first_median", "delta", "held_delta", *[f"m_{b}" for b in _BUCKETS])


_RUNS = ['click', 'error', 'purchase', 'signup', 'view']  # of the SQL; the query finds them in the table


@query(f"SELECT bucket, {', '.join(f"round(quantile_cont(m, .5) FILTER (event_type = '{r}'), 6) AS {r}" for r in _RUNS)} FROM {_RECORDS_SQL} GROUP BY 1")
def agg_bucket_pivot(spark, d):
    r = _records(spark, d)
    runs = stats.distinct_runs(r, "event_type")
    return _rounded(stats.bucket_pivot(r, "bucket", "event_type", "m", runs), *runs)


@query("""WITH m AS (SELECT event_type, user_id, avg(value) AS mean FROM events GROUP BY 1, 2), p AS (SELECT a.event_type, a.mean - b.mean AS d FROM m a JOIN m b USING (user_id) WHERE b.event_type = 'click' AND a.event_type <> 'click' AND a.mean IS NOT NULL AND b.mean IS NOT NULL)
 SELECT event_type, count(*) AS paired, count(*) FILTER (d < 0) AS improved, round(quantile_cont(d, .5), 6) AS delta,
 round(least(1.0, 2 * list_sum(list_transform(range(0, least(count(*) FILTER (d < 0), count(*) FILTER (d >= 0)) + 1), lambda i: exp(lgamma(count(*) + 1) - lgamma(i + 1) - lgamma(count(*) - i + 1) - count(*) * ln(2))))), 6) AS p FROM p GROUP BY 1""")
def agg_pooled_draws(spark, d):
    e = t(spark, d, "events")
    pooled = stats.pooled_draws([e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1")], "event_type", "user_id", "value")
    return _rounded(stats.compare_arms(pooled, "event_type", "user_id", "click"), "delta", "p")


# scores, further checks and sinks


_SITES = "(SELECT label * 100000 + vec_id // 200 AS record, s AS sample, CASE WHEN vec_id % 200 < 40 THEN 'P' ELSE 'H' END AS chain, vec_id % 200 AS pos, vec_id % 7 > 0 AS ok, " + ", ".join(f"50*embedding[{k} + 3*s]::double AS {c}" for k, c in enumerate(_P6[:3], 1)) + ", " + ", ".join(f"50*embedding[{k}]::double AS {c}" for k, c in enumerate(_P6[3:], 20)) + " FROM embeddings, range(3) r(s))"


def _scores_sql() -> str:
    chains = "(SELECT record, chain, count(*) AS n, min(pos) FILTER (ok) AS start FROM sites WHERE sample = 0 GROUP BY 1, 2)"
    found = f"(SELECT record, count(*) AS n_protein_chains, max(n) AS hc_len, min(n) AS pep_len, arg_max(chain, (n, chain)) AS heavy, arg_min(chain, (n, chain)) AS peptide FROM {chains} GROUP BY 1)"
    by = "record, sample"
    value = lambda x, c: f"list(CASE WHEN good THEN round({x}.{c}, 4) END ORDER BY sample)"
    return f"""WITH sites AS {_SITES}, c AS {chains}, f AS (SELECT f.*, c.start FROM {found} f JOIN c ON c.record = f.record AND c.chain = f.heavy),
        r AS (SELECT s.*, ok AND chain = heavy AND pos >= start AND pos < start + 100 AS g, ok AND chain = peptide AS p FROM sites s JOIN f USING (record)),
        g AS {_fit_sql('r', by, 'g')}, p AS {_fit_sql('r', by, 'p')}, a AS {_fit_sql('r', by, 'ok')}, m AS {_transfer_sql('r', by, 'g', 'p')},
        v AS (SELECT f.record, any_value(hc_len) AS hc_len, any_value(pep_len) AS pep_len, any_value(n_protein_chains) AS n_protein_chains, any_value(start) AS start,
                     bool_or(odd) AS odd, min(g.n) AS ng, min(p.n) AS np, min(a.n) AS na, {value('m', 'moved')} AS pep, {value('p', 'rmsd')} AS own, {value('g', 'rmsd')} AS groove, {value('a', 'rmsd')} AS ca, {value('a', 'rmsd_mirror')} AS mirror
              FROM (SELECT *, heavy = peptide OR hc_len <= 5 OR pep_len > 8 AS odd FROM f) f JOIN (SELECT *, n >= 3 AS good FROM g) g USING (record) JOIN p USING (record, sample) JOIN a USING (record, sample) JOIN m USING (record, sample) GROUP BY f.record),
        w AS (SELECT *, CASE WHEN odd THEN 'no long chain with a short one' WHEN start IS NULL THEN 'heavy chain unresolved' WHEN ng < 3 OR np < 3 THEN 'fewer than three resolved residues' END AS reason FROM v)
        SELECT record, hc_len, pep_len, n_protein_chains, CASE WHEN NOT odd THEN start END AS groove_start, CASE WHEN NOT odd THEN ng END AS n_groove_ca, CASE WHEN NOT odd THEN np END AS n_pep_ca, CASE WHEN NOT odd THEN na END AS n_all_ca, reason,
               {', '.join(f"CASE WHEN reason IS NULL THEN array_to_string(list_transform({x}, lambda y: printf('%.4f', y)), ',') END AS {name}" for x, name in zip(('pep', 'own', 'groove', 'ca', 'mirror'), geometry.SCORES))},
               CASE WHEN reason IS NULL THEN list_min(pep) END AS pep_rmsd_best, CASE WHEN reason IS NULL THEN round(list_avg(pep), 4) END AS pep_rmsd_mean FROM w"""


@query(_scores_sql())
def geo_structure_scores(spark, d):
    e = t(spark, d, "embeddings").withColumn("sample", F.explode(F.sequence(F.lit(0), F.lit(2))))
    at = lambda k: F.get("embedding", k).cast("double") * 50
    site = F.col("vec_id") % 200
    sites = e.select(
        (F.col("label") * 100000 + F.floor(F.col("vec_id") / 200)).cast("long").alias("record"), "sample", F.when(site < 40, "P").otherwise("H").alias("chain"), site.alias("pos"), (F.col("vec_id") % 7 > 0).alias("ok"),
        *[at(3 * F.col("sample") + k).alias("p" + c) for k, c in enumerate("xyz")], *[at(F.lit(19 + k)).alias("t" + c) for k, c in enumerate("xyz")],
    )
    out = geometry.score_rows(sites, "record", "sample", "chain", "pos", "ok", min_heavy=5, max_peptide=8, groove=100)
    return out.withColumns({c: F.array_join(F.transform(c, lambda x: F.format_string("%.4f", x)), ",") for c in geometry.SCORES})


@query(f"SELECT label, n >= 20 AND lo > 0 AND hi > 0 AS ok, CASE WHEN n < 20 THEN 'contacts' WHEN lo = 0 OR hi = 0 THEN 'halves' END AS review FROM (SELECT l.label, coalesce(contacts, 0) AS n, coalesce(lower, 0) AS lo, coalesce(upper, 0) AS hi FROM (SELECT DISTINCT label FROM embeddings WHERE label <> 0) l LEFT JOIN ({GROOVE_SQL}) USING (label))")
def chk_groove(spark, d):
    g = t(spark, d, "embeddings").where("label <> 0").select("label").distinct().join(groove(spark, d), "label", "left").fillna(0, ["contacts"])
    review = F.when(F.col("contacts") < 20, "contacts").when(~F.coalesce("in_groove", F.lit(False)), "halves")
    return g.select("label", review.isNull().alias("ok"), review.alias("review"))


@query("SELECT (SELECT count(DISTINCT label) FROM embeddings WHERE label <> 0) - count(*) AS passed, (SELECT count(DISTINCT label) FROM embeddings WHERE label <> 0) AS total FROM (" + _SQL["geo_detached"] + ")")
def chk_connected(spark, d):
    kept = t(spark, d, "embeddings").where("label <> 0").select("label").distinct()
    lost = geo_detached(spark, d).withColumn("lost", F.lit(1))
    return kept.join(lost, "label", "left").agg(F.count_if(F.col("lost").isNull()).alias("passed"), F.count("*").alias("total"))


_CHAINS_SQL = """c AS (SELECT k, row_number() OVER w - 1 AS i, CASE WHEN k % 5 = 0 THEN -l ELSE l END AS number, kept, q AS atom_num, coalesce(sum(q) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS atom_idx
 FROM (SELECT l_orderkey AS k, l_linenumber AS l, bool_or(l_returnflag <> 'N') AS kept, sum(l_quantity)::bigint AS q FROM lineitem GROUP BY 1, 2) WINDOW w AS (PARTITION BY k ORDER BY l)),
 s AS (SELECT k, count(*) + (k % 13 = 0)::int AS n_mask, list(i + 99 * (k % 7 = 0)::int) FILTER (kept) AS keep, sum(atom_num) + (k % 9 = 0)::int AS n_atoms, count(*) + (k % 11 = 0)::int AS n_residues FROM c GROUP BY k)"""


@query(f"""WITH {_CHAINS_SQL}, r AS (SELECT k, bool_and(coalesce(number > before, true)) AS rise FROM (SELECT k, number, lag(number) OVER (PARTITION BY k ORDER BY i) AS before FROM c WHERE kept) GROUP BY 1),
 g AS (SELECT k, count(*) AS n, count(*) FILTER (kept) AS n_kept, arg_max(atom_idx + atom_num, i) AS atoms, max(i) + 1 AS res FROM c GROUP BY 1),
 o AS (SELECT k, n_mask = n AS count_ok, n_kept = coalesce(len(keep), 0) AND len(list_filter(coalesce(keep, []), lambda x: x < 0 OR x >= n)) = 0 AS keep_ok, coalesce(rise, true) AS order_ok, atoms = n_atoms AS atoms_ok, res = n_residues AS residues_ok FROM s JOIN g USING (k) LEFT JOIN r USING (k))
 SELECT *, count_ok AND keep_ok AND order_ok AND atoms_ok AND residues_ok AS passed FROM o""")
def chk_integrity(spark, d):
    lines = t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("l"))
    c = lines.agg(F.bool_or(F.col("l_returnflag") != "N").alias("kept"), F.sum("l_quantity").cast("long").alias("atom_num"))
    w = Window.partitionBy("k").orderBy("l")
    before = F.coalesce(F.sum("atom_num").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    i = F.row_number().over(w) - 1
    c = c.withColumns({"i": i, "number": F.when(F.col("k") % 5 == 0, -F.col("l")).otherwise(F.col("l")), "atom_idx": before, "res_idx": i, "res_num": F.lit(1)})
    one = lambda n: F.when(F.col("k") % n == 0, 1).otherwise(0)
    keep = F.collect_list(F.when(F.col("kept"), F.col("i") + 99 * one(7)))
    s = c.groupBy("k").agg((F.count("*") + one(13)).alias("n_mask"), keep.alias("keep"), (F.sum("atom_num") + one(9)).alias("n_atoms"), (F.count("*") + one(11)).alias("n_residues"))
    return checks.integrity(c, s, "k", "i", "number", "kept")


_KEPT3_SQL = """(SELECT l_orderkey, coalesce(list_sort(list_distinct(list(i) FILTER (l_returnflag <> 'N'))), []) AS keep, coalesce(list_sort(list_distinct(list(i) FILTER (l_linestatus = 'F'))), []) AS mask,
 coalesce(list_sort(list_distinct(list(i) FILTER (l_returnflag <> 'N' AND l_quantity > 2))), []) AS valid, list({'i': i, 'v': (l_returnflag <> 'N') <> (l_quantity > 49)}) AS itf FROM (SELECT *, l_linenumber - 1 AS i FROM lineitem) GROUP BY 1)"""


@query(f"SELECT l_orderkey, keep = mask AS mask_ok, keep = valid AS chains_ok, ok AS interfaces_ok, keep = mask AND keep = valid AND ok AS passed FROM (SELECT *, len(list_filter(itf, lambda x: x.v <> list_contains(keep, x.i))) = 0 AS ok FROM {_KEPT3_SQL})")
def chk_flag_consistency(spark, d):
    l = t(spark, d, "lineitem").withColumn("i", (F.col("l_linenumber") - 1).cast("int"))
    lists = lambda c: F.collect_set(F.when(c, F.col("i")))
    kept = F.col("l_returnflag") != "N"
    g = l.groupBy("l_orderkey").agg(
        lists(kept).alias("keep"), lists(F.col("l_linestatus") == "F").alias("m"),
        F.collect_list(F.struct(F.col("i").alias("chain_id"), (kept & (F.col("l_quantity") > 2)).alias("valid"))).alias("chains"),
        F.collect_list(F.struct(F.col("i").alias("chain_1"), F.col("i").alias("chain_2"), (kept != (F.col("l_quantity") > 49)).alias("valid"))).alias("interfaces"),
    )
    mask = F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: F.array_contains("m", i))
    return checks.flag_consistency(g.withColumn("mask", mask), "l_orderkey", "keep", "mask", "chains", "interfaces")


_CAPS = [8, 4, 2, 1]


@query(f"SELECT epoch, {_CAPS}[least(epoch, 3) + 1] AS cap, count(*) AS rows, count(*) FILTER (n <> {_CAPS}[least(epoch, 3) + 1]) AS n_off FROM (SELECT conv_id % 6 AS epoch, count(*) AS n FROM conversations GROUP BY conv_id) GROUP BY epoch")
def chk_schedule_depth(spark, d):
    seen = t(spark, d, "conversations").withColumn("epoch", F.col("conv_id") % 6).groupBy("epoch", "conv_id").agg(F.count("*").alias("n"))
    return windows.schedule_check(seen, "epoch", "n", _CAPS)


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'A' OR l_linenumber IN (1, 2)")
def sink_fixed_width(spark, d):
    path = tables.shared_path(spark)
    tables.write_fixed_width(t(spark, d, "lineitem"), path, (F.col("l_returnflag") == "A") | F.col("l_linenumber").isin(1, 2), [("l_orderkey", "%12d"), ("l_linenumber", "%4d"), ("l_quantity", "%10.3f")])
    cut = lambda at, n, kind: F.trim(F.substring("value", at, n)).cast(kind)
    return spark.read.text(path).select(cut(1, 12, "long").alias("l_orderkey"), cut(13, 4, "int").alias("l_linenumber"), cut(17, 10, "double").alias("l_quantity"))


@query(f"""WITH r AS (SELECT split, o_orderkey, CASE WHEN o_totalprice < 50000 THEN 'small' WHEN o_orderstatus = 'P' THEN 'pending' END AS reason FROM {SPLITS_SQL})
 SELECT count(*) AS rows, count(*) FILTER (reason IS NULL) AS kept, count(reason) AS dropped,
 count(*) FILTER (split = 'train' AND reason IS NULL) AS train, count(*) FILTER (split = 'test' AND reason IS NULL) AS test,
 count(*) FILTER (split = 'train' AND reason = 'small') AS train_small, count(*) FILTER (split = 'test' AND reason = 'pending') AS test_pending,
 array_to_string((list(o_orderkey ORDER BY o_orderkey) FILTER (split = 'train' AND reason = 'small'))[1:3], ',') AS first_small,
 count(reason) AS listed FROM r""")
def sink_stage_report(spark, d):
    reason = F.when(F.col("o_totalprice") < 50000, "small").when(F.col("o_orderstatus") == "P", "pending")
    line, lost = tables.write_stage_report(split_orders(spark, d).withColumn("reason", reason), tables.shared_path(spark), "split", "reason", "o_orderkey")
    cell = "map<string, struct<n: long, first: array<long>>>"
    report = spark.read.schema(f"rows long, kept long, dropped long, by map<string, long>, reasons map<string, {cell}>").json(line)
    small = F.col("reasons")["small"]["train"]
    counts = [F.col("by")["train"].alias("train"), F.col("by")["test"].alias("test"), small["n"].alias("train_small"), F.col("reasons")["pending"]["test"]["n"].alias("test_pending")]
    listed = spark.read.schema("o_orderkey long").json(lost).agg(F.count("o_orderkey").alias("listed"))
    return report.select("rows", "kept", "dropped", *counts, F.array_join(F.transform(small["first"], lambda x: x.cast("string")), ",").alias("first_small")).join(listed)


# partners, tables, coverage, pockets


@query("SELECT l_orderkey, CASE WHEN n > 0 THEN l_partkey END AS l_partkey, CASE WHEN n <= 0 THEN 'present_but_not_contacting' END AS flag FROM (SELECT *, l_quantity - 25 AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_partkey) AS r FROM lineitem) WHERE r = 1")
def win_best_partner(spark, d):
    return windows.best_partner(t(spark, d, "lineitem").withColumn("n", F.col("l_quantity") - 25), "l_orderkey", "l_partkey", "n")


@query(f"SELECT user_id, {', '.join(f"round(avg(value) FILTER (event_type = '{r}'), 6) AS {r}" for r in _RUNS)} FROM events GROUP BY 1")
def ord_record_table(spark, d):
    e = t(spark, d, "events")
    runs = stats.distinct_runs(e, "event_type")
    return _rounded(stats.record_table(e, "user_id", "event_type", "value", runs, runs[0]), *runs)


@query("SELECT metric, weight, want FROM (SELECT l_returnflag || l_linestatus AS metric, count(*) AS want, count(*) FILTER (l_quantity < 50) AS weight FROM lineitem GROUP BY 1) WHERE weight <> want")
def agg_coverage_check(spark, d):
    x = t(spark, d, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("metric"), "l_quantity")
    count = lambda df, name: df.groupBy("metric").agg(F.count("*").alias(name))
    return stats.coverage_check(count(x.where("l_quantity < 50"), "weight"), count(x, "want"), "metric", "weight", "want")


@query("SELECT l_orderkey, round(avg(q), 6) AS mean, min(q) AS min, CASE WHEN count(q) > 0 THEN count(*) FILTER (q < 8) END AS n_low, CASE WHEN count(q) > 0 THEN count(*) FILTER (q > 40) END AS n_high, CASE WHEN count(q) > 0 THEN count(*) FILTER (q < 20) END AS n_partial FROM (SELECT l_orderkey, CASE WHEN l_returnflag = 'A' THEN l_quantity END AS q FROM lineitem) GROUP BY 1")
def agg_residue_quality(spark, d):
    v = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.when(F.col("l_returnflag") == "A", F.col("l_quantity"))).alias("v"))
    return stats.residue_quality(v, "l_orderkey", "v", 8, 40, 20).withColumn("mean", F.round("mean", 6))


@query("SELECT conv_id, count(*) AS rows, count(DISTINCT text) AS distinct_rows, count(*) FILTER (i >= 0.9) AS n90, count(*) FILTER (i >= 0.8) AS n80, round(avg(i), 6) AS identity FROM (SELECT c.conv_id, c.text, len(list_filter(list_zip(string_split(c.text, ''), string_split(q.text, '')), lambda z: z[1] = z[2])) / greatest(length(q.text), 1)::double AS i FROM conversations c JOIN conversations q ON q.conv_id = c.conv_id AND q.turn = 0 WHERE c.turn < 6) GROUP BY 1")
def msa_redundancy(spark, d):
    return stats.redundancy(t(spark, d, "conversations"), "conv_id", "turn", "text", 6).withColumn("identity", F.round("identity", 6)).withColumnRenamed("distinct", "distinct_rows")


@query(f"WITH c AS (SELECT id % 10 AS chain, id % 2 AS entity, count(*) AS n, avg(x) AS x, avg(y) AS y, avg(z) AS z FROM {POINTS_SQL} GROUP BY 1, 2) SELECT a.chain AS kept_chain, b.chain AS twin, round(sqrt(power(a.x-b.x,2)+power(a.y-b.y,2)+power(a.z-b.z,2)), 6) AS dist FROM c a JOIN c b USING (entity, n) WHERE a.chain < 2 AND b.chain >= 2")
def join_twin_copies(spark, d):
    p = points(spark, d).withColumns({"chain": F.col("id") % 10, "entity": F.col("id") % 2})
    return geometry.twin_copies(p, "entity", "chain", F.col("chain") < 2).withColumn("dist", F.round("dist", 6))


@query("SELECT l_orderkey, h AS heavy, p AS peptide, CASE WHEN h = p OR hn <= 150 OR pn > 30 THEN 'no long chain with a short one' END AS reason FROM (SELECT l_orderkey, arg_max(l_linenumber, {'n': l_quantity * 4, 'c': l_linenumber}) AS h, max(l_quantity * 4) AS hn, arg_min(l_linenumber, {'n': l_quantity * 4, 'c': l_linenumber}) AS p, min(l_quantity * 4) AS pn FROM lineitem GROUP BY 1)")
def geo_chain_by_length(spark, d):
    return geometry.chain_by_length(t(spark, d, "lineitem").withColumn("n", F.col("l_quantity") * 4), "l_orderkey", "l_linenumber", "n")


@query("SELECT l_orderkey, count(*) FILTER (p) AS n_predicted, count(*) FILTER (o) AS n_observed, count(*) FILTER (p AND o) AS overlap FROM (SELECT l_orderkey, l_suppkey % 10 AS r, bool_or(l_returnflag <> 'N') AS p, bool_or(l_quantity > 15) AS o FROM lineitem WHERE l_returnflag <> 'N' OR l_quantity > 15 GROUP BY 1, 2) GROUP BY 1")
def geo_pocket_overlap(spark, d):
    x = t(spark, d, "lineitem").withColumn("r", F.col("l_suppkey") % 10)
    return geometry.pocket_overlap(x.where("l_returnflag <> 'N'"), x.where("l_quantity > 15"), "l_orderkey", "r")


def point_pairs(spark, d):
    e = t(spark, d, "embeddings")
    return e.select("label", (F.col("vec_id") % 3 > 0).alias("fit"), *[(F.get("embedding", F.lit(k)).cast("double") * 50).alias(c) for k, c in enumerate(["px", "py", "pz", "tx", "ty", "tz"])])


@query(f"SELECT label, n, round(rmsd, 6) AS rmsd, round(least(rmsd, rmsd_mirror), 6) AS rmsd_reflect, rmsd > 5 * rmsd_mirror AS mirrored FROM {_fit_sql(_PAIRS_SQL, 'label', 'true')}")
def geo_superpose_reflect(spark, d):
    return _rounded(geometry.superpose_reflect(point_pairs(spark, d), "label"), "rmsd", "rmsd_reflect")


@query(f"SELECT label, a.n AS n_fit, m AS n_scored, CASE WHEN a.n >= 3 THEN round(rmsd, 6) END AS fit_rmsd, CASE WHEN a.n >= 3 THEN round(moved, 6) END AS transfer_rmsd, CASE WHEN a.n < 3 THEN 'too few points' WHEN m > 0 AND moved IS NULL THEN 'fit points on a line' END AS reason FROM {_fit_sql(_PAIRS_SQL, 'label', 'fit')} a JOIN {_transfer_sql(_PAIRS_SQL, 'label', 'fit', 'NOT fit')} USING (label)")
def geo_transfer_rmsd(spark, d):
    return _rounded(geometry.transfer_rmsd(point_pairs(spark, d), "label", "fit"), "fit_rmsd", "transfer_rmsd")


@query(f"SELECT label, n, CASE WHEN n >= 3 THEN round(rmsd, 6) END AS deviation, CASE WHEN n >= 3 THEN rmsd > 5 END AS swapped FROM {_fit_sql(_PAIRS_SQL, 'label', 'true')}")
def geo_truth_deviation(spark, d):
    return _rounded(geometry.truth_deviation(point_pairs(spark, d), "label"), "deviation")


@query()
def seq_reference_mapping(spark, d):
    x = t(spark, d, "customer").select(F.regexp_replace("c_name", "[^A-Za-z0-9]", "").alias("s"))
    return alignment.reference_mapping(x, "s", "Customer000000500", [0, 3, 7, 10, 14, 16])


@query()
def seq_pair_identity_sample(spark, d):
    return alignment.pair_identity_sample(t(spark, d, "orders").select("o_orderkey", F.concat_ws("", "o_orderpriority", "o_orderdate").alias("s")), "o_orderkey", "s", 200, 7)
