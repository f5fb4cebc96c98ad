"""Counts, order statistics, paired tests and mergeable metrics."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import ranks


def counter(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count("*").alias("n"))


def duplicate_ids(df: DataFrame, key: str) -> DataFrame:
    return counter(df, key).where("n > 1")


def entry_role_flags(df: DataFrame, key: str, role: str, roles: list[str]) -> DataFrame:
    return df.groupBy(key).agg(*[F.bool_or(F.col(role) == r).alias(f"has_{r.lower()}") for r in roles])


def split_counts(df: DataFrame, split: str, order: list[str]) -> DataFrame:
    """Rows of each split named in ``order``, zero where there are none."""
    names = df.sparkSession.createDataFrame([(s,) for s in order], f"{split} string")
    return names.join(counter(df, split), split, "left").select(split, F.coalesce("n", F.lit(0)).alias("n"))


def pair_groups(df: DataFrame, keys: list[str], split: str) -> DataFrame:
    """One row: groups of equal keys with two rows or more, their rows, groups within and across splits."""
    g = df.groupBy(*keys).agg(F.count("*").alias("n"), F.min(split).alias("a"), F.max(split).alias("b")).where("n > 1")
    return g.agg(
        F.count("*").alias("groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(F.col("a") == F.col("b")).alias("within"), F.count_if(F.col("a") != F.col("b")).alias("across")
    )


def leakage_check(df: DataFrame, keys: list[str], split: str) -> DataFrame:
    g = df.groupBy(*keys).agg(F.min(split).alias("a"), F.max(split).alias("b"))
    return g.agg(F.count("*").alias("total"), F.count_if(F.col("a") == F.col("b")).alias("passed"))


def check_suite(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check, passed, total) in long form from one pass; a null outcome does not count."""
    sums = [x for k, c in checks.items() for x in (F.count_if(c).alias(f"p_{k}"), F.count(c).alias(f"t_{k}"))]
    rows = F.array(*[F.struct(F.lit(k).alias("check"), F.col(f"p_{k}").alias("passed"), F.col(f"t_{k}").alias("total")) for k in checks])
    return df.agg(*sums).select(F.inline(rows))


def failure_examples(df: DataFrame, checks: dict[str, Column], key: str, k: int = 2) -> DataFrame:
    """For each check: failures and the k smallest keys among them. Sorted keys are cut in each
    partial result's window, so no check gathers all its failures."""
    outcome = F.array(*[F.struct(F.lit(n).alias("check"), c.alias("ok")) for n, c in checks.items()])
    bad = df.select(F.col(key).alias("k"), F.inline(outcome)).where("not ok")
    first = bad.withColumn("r", F.row_number().over(W.partitionBy("check").orderBy("k"))).where(F.col("r") <= k)
    names = first.groupBy("check").agg(F.array_join(F.transform(F.array_sort(F.collect_list("k")), lambda x: x.cast("string")), ",").alias("examples"))
    return bad.groupBy("check").agg(F.count("*").alias("failed")).join(names, "check")


def order_stats(df: DataFrame, by: str, x: str) -> DataFrame:
    """min, p05 at index int(0.05 (n - 1)), upper median (index n // 2) and max by rank."""
    ends = df.where(F.col(x).isNotNull()).groupBy(by).agg(F.min(x).alias("min"), F.max(x).alias("max"))
    at = ranks.at_ranks(df, [by], x, {"p05": lambda n: F.floor((n - 1) * 0.05), "upper_median": ranks.UPPER_MIDDLE})
    return ranks.same_groups(ends, at, [by]).select(by, "min", "p05", "upper_median", "max")


def depth_by_kind(df: DataFrame, kind: str, depth: str) -> DataFrame:
    """(kind, n, min, median, p90, max) of the depths; between two ranks p90 is taken in proportion."""
    ends = df.where(F.col(depth).isNotNull()).groupBy(kind).agg(F.count("*").alias("n"), F.min(depth).alias("min"), F.max(depth).alias("max"))
    ninth = lambda n: (n - 1) * 0.9
    wanted = {"lo": ranks.LOWER_MIDDLE, "hi": ranks.UPPER_MIDDLE, "below": lambda n: F.floor(ninth(n)), "above": lambda n: F.ceil(ninth(n))}
    out = ranks.same_groups(ends, ranks.at_ranks(df, [kind], depth, wanted), [kind])
    share = ninth(F.col("n")) - F.floor(ninth(F.col("n")))
    p90 = F.round(F.col("below") + (F.col("above") - F.col("below")) * share, 6)
    return out.select(kind, "n", "min", ((F.col("lo") + F.col("hi")) / 2).alias("median"), p90.alias("p90"), "max")


def median_mean(df: DataFrame, by: str, x: str) -> DataFrame:
    means = df.groupBy(by).agg(F.round(F.avg(x), 6).alias("mean"), F.count(x).alias("n"))
    out = ranks.same_groups(means, ranks.medians(df, [by], {"median": F.col(x)}), [by])
    return out.select(by, F.round("median", 6).alias("median"), "mean", "n")


def weighted_merge(states: DataFrame, metric: str, value: str, weight: str) -> DataFrame:
    """Exact merge of partial means; metrics of no weight go."""
    g = states.groupBy(metric).agg(F.sum(F.col(value) * F.col(weight)).alias("s"), F.sum(weight).alias("weight")).where("weight > 0")
    return g.select(metric, F.round(F.col("s") / F.col("weight"), 6).alias("value"), F.col("weight"))


def category_weighted(values: DataFrame, category: str, value: str, weights: dict[str, float]) -> DataFrame:
    """Mean under fixed weights where an absent category counts 0, with the attainable maximum."""
    table = values.sparkSession.createDataFrame(list(weights.items()), "category string, w double")
    x = table.join(values.select(F.col(category).alias("category"), F.col(value).alias("v")), "category", "left")
    return x.agg(F.round(F.sum(F.coalesce("v", F.lit(0.0)) * F.col("w")) / F.sum("w"), 6).alias("value"), F.round(F.sum(F.when(F.col("v").isNotNull(), F.col("w")).otherwise(0.0)) / F.sum("w"), 6).alias("attainable"))


def reproduction_gate(values: DataFrame, reference: DataFrame, key: str, tol: float) -> DataFrame:
    """(key, value, ref) that are missing on either side or differ by more than ``tol``."""
    both = values.join(reference, key, "full")
    return both.where(F.col("value").isNull() | F.col("ref").isNull() | (F.abs(F.col("value") - F.col("ref")) > tol)).select(key, "value", "ref")


def interval_length(df: DataFrame, by: str, beg: str, end: str) -> DataFrame:
    """Total length of closed intervals; one without an end is its first position alone."""
    return df.groupBy(by).agg(F.sum(F.coalesce(F.col(end), F.col(beg)) - F.col(beg) + 1).alias("length"))


def paired_runs(rows: DataFrame, run: str, a: str, b: str, record: str, value: str) -> DataFrame:
    """Records of both runs: a, b and b - a. One shuffle, no self join."""
    g = rows.where(F.col(run).isin(a, b)).groupBy(record).agg(F.avg(F.when(F.col(run) == a, F.col(value))).alias("a"), F.avg(F.when(F.col(run) == b, F.col(value))).alias("b"))
    return g.where("a is not null and b is not null").withColumn("diff", F.col("b") - F.col("a"))


#: Up to this n the coefficients C(n, i) are whole numbers below 2^53, so the sum is exact.
EXACT_N = 56
#: ln gamma(x) = (x - 1/2) ln x - x + ln(2 pi)/2 + sum of c / x^k over odd k (Stirling's series).
STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680)


def _log_factorial(n: Column) -> Column:
    """ln n!, by Stirling's series beyond a table."""
    x = n.cast("double") + 1
    series = sum(F.lit(c) / F.pow(x, F.lit(float(k))) for c, k in zip(STIRLING, (1, 3, 5, 7)))
    small = F.element_at(F.array(*[F.lit(math.lgamma(k + 1)) for k in range(32)]), (F.least(n, F.lit(31)) + 1).cast("int"))
    return F.when(n < 32, small).otherwise((x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + series)


def _tail_by_fraction(m: Column, n: Column) -> Column:
    """P(X <= m) of a fair binomial for m below n / 2: its largest term times the continued fraction of
    the incomplete beta function (from the far end; 200 steps settle it), no array of m."""
    a, b, half = (n - m).cast("double"), (m + 1).cast("double"), 0.5

    def down(acc: Column, i: Column) -> Column:
        k = F.lit(201.0) - i.cast("double")
        even = k * (b - k) * half / ((a + 2 * k - 1) * (a + 2 * k))
        odd = -(a + k) * (a + b + k) * half / ((a + 2 * k) * (a + 2 * k + 1))
        return 1 + even / (1 + odd / acc)

    inner = F.aggregate(F.sequence(F.lit(1), F.lit(200)), F.lit(1.0), down)
    first = -(a + b) * half / (a + 1)
    front = F.exp(_log_factorial(n) - _log_factorial(n - m - 1) - _log_factorial(m) - (n + 1) * math.log(2)) / a
    return front / (1 + first / inner)


def sign_test(df: DataFrame, k: str, n: str) -> DataFrame:
    """Exact two-sided binomial sign test from (improved, n): ``p``.

    Up to EXACT_N the coefficients are summed as whole numbers, so p is exact; beyond, the tail is the
    incomplete beta function by its continued fraction, whose cost does not grow with n. Null gives null."""
    m = F.when(F.col(k).isNotNull() & F.col(n).isNotNull(), F.least(F.col(k), F.col(n) - F.col(k))).cast("long")

    def step(acc: Column, i: Column) -> Column:
        c = (acc["c"] * (F.col(n) - i + 1) / i).cast("double")
        return F.struct(c.alias("c"), (acc["s"] + c).alias("s"))

    start = F.struct(F.lit(1.0).alias("c"), F.lit(1.0).alias("s"))
    small = F.when((m > 0) & (F.col(n) <= EXACT_N), F.sequence(F.lit(1).cast("long"), m)).otherwise(F.array().cast("array<bigint>"))
    exact = F.aggregate(small, start, step, lambda acc: acc["s"]) * F.pow(F.lit(2.0), -F.col(n))
    tail = F.when(F.col(n) <= EXACT_N, exact).when(2 * m == F.col(n), F.lit(0.5)).otherwise(_tail_by_fraction(m, F.col(n)))
    return df.withColumn("p", F.when(m.isNotNull(), F.least(F.lit(1.0), 2 * tail)))


def noise_floor(pairs: DataFrame) -> DataFrame:
    """Medians of two draws, median and p90 (index int(0.9 n)) of absolute differences."""
    at = {"lo": ranks.LOWER_MIDDLE, "hi": ranks.UPPER_MIDDLE, "p90": lambda n: F.floor(n * 0.9)}
    q = ranks.series_at_ranks(pairs, [], {"a": F.col("a"), "b": F.col("b"), "d": F.abs("diff")}, at)
    of = lambda series, x: F.round(F.max(F.when(F.col("series") == series, x)), 6)
    mid = (F.col("lo") + F.col("hi")) / 2
    return q.agg(of("a", mid).alias("median_a"), of("b", mid).alias("median_b"), of("d", mid).alias("median_abs"), of("d", F.col("p90")).alias("p90_abs"))


def rank_trend(df: DataFrame, x: str, y: str, by: str) -> DataFrame:
    """Spearman correlation (mean ranks of ties) and slope of y over x in each group, over the rows
    that have both; null where either is constant."""
    pairs = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(by, x, y).agg(F.count("*").alias("__pairs"))
    full = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    centred = F.col("below") + (F.col("n") - F.col("size")) / 2
    for c, r in ((x, "__rx"), (y, "__ry")):
        pairs = ranks.same_groups(pairs, ranks.ranked(full, [by], c).select(by, c, centred.alias(r)), [by, c])
    s = lambda a, b: F.sum(F.col("__pairs") * F.col(a) * F.col(b))
    rho = pairs.groupBy(by).agg(F.round(s("__rx", "__ry") / F.nullif(F.sqrt(s("__rx", "__rx") * s("__ry", "__ry")), F.lit(0.0)), 6).alias("rho"))
    slope = full.groupBy(by).agg(F.round(F.regr_slope(y, x), 6).alias("slope"))
    return ranks.same_groups(rho, slope, [by]).select(by, "rho", "slope")


def argmax_constraint(df: DataFrame, arg: str, peak: str, capacity: float, frac: float = 0.85) -> DataFrame:
    ok = df.groupBy(arg).agg(F.max(peak).alias("peak")).where(F.col("peak") < frac * capacity)
    return ok.agg(F.max(arg).alias(arg), F.max_by("peak", arg).alias("peak"))


def seeded_subset(df: DataFrame, key: str, k: int, seed: str) -> DataFrame:
    """k rows, the same on every cluster."""
    return df.orderBy(F.md5(F.concat(F.lit(seed), F.col(key).cast("string"))), key).limit(k)


def progress_buckets(df: DataFrame, step: str, value: str, rate: str, secs: str) -> DataFrame:
    """A curve over eighths, quarters and halves of the steps: (bucket, n, mean, non_finite, rate, secs).

    Half-open buckets between the distinct integer edges; the last step is a bucket of its own. Only
    the last step reaches the driver."""
    last = df.agg(F.max(step)).first()[0] or 0
    edges = sorted({0, last // 8, last // 4, last // 2, 3 * last // 4, last, last + 1})
    bucket = F.lit(None).cast("long")
    for lo, hi in zip(edges[:-1], edges[1:]):
        bucket = F.when((F.col(step) >= lo) & (F.col(step) < hi), lo).otherwise(bucket)
    good = F.col(value).isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    rows = df.withColumn("bucket", bucket.cast("long"))
    out = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.avg(F.when(good, F.col(value))).alias("mean"), F.count_if(~good).alias("non_finite"), F.max_by(rate, step).alias("rate"))
    return ranks.same_groups(out, ranks.medians(rows, ["bucket"], {"secs": F.col(secs)}), ["bucket"])


def _finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def distinct_runs(rows: DataFrame, run: str, most: int = 1000) -> list:
    """The names of the runs, in order, for the columns of a pivot. More than ``most`` is an error: a
    table cannot have so many columns."""
    found = [r[0] for r in rows.where(F.col(run).isNotNull()).select(run).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} runs")
    return sorted(found)


def validation_curve(samples: DataFrame, reference: DataFrame, step: str, record: str, sample: str, value: str, deviation: str | None = None, limit: float = 5.0) -> DataFrame:
    """For each step: the pooled median, the medians of the first and the best sample of a record, the
    mean, records with values (ok) and without (failed), values that are no finite number, swaps
    (``deviation`` above ``limit``), and against ``reference`` (record, ref): records in both (paired),
    how many have a lower mean (improved), and the median difference of record means (delta).

    Only finite values enter medians and means; a null value is none, not a failure to be finite."""
    x = F.col(value).cast("double")
    rows = samples.withColumns({"__v": F.when(_finite(x), x), "__odd": x.isNotNull() & ~_finite(x), "__swap": F.lit(False) if deviation is None else F.coalesce(F.col(deviation) > limit, F.lit(False))})
    first = F.min_by(F.struct("__v"), sample)["__v"]
    per = rows.groupBy(step, record).agg(F.min("__v").alias("best"), F.avg("__v").alias("m"), first.alias("first"), F.count(value).alias("__some")).join(reference, record, "left")
    per = per.withColumn("__d", F.col("m") - F.col("ref"))
    records = per.groupBy(step).agg(F.count_if(F.col("__some") > 0).alias("ok"), F.count_if(F.col("__some") == 0).alias("failed"), F.count("__d").alias("paired"), F.count_if(F.col("__d") < 0).alias("improved"))
    middle = ranks.medians(per, [step], {"first_median": F.col("first"), "best_median": F.col("best"), "delta": F.col("__d")})
    pooled = ranks.medians(rows, [step], {"pooled_median": F.col("__v")})
    out = rows.groupBy(step).agg(F.avg("__v").alias("mean"), F.count_if("__odd").alias("non_finite"), F.count_if("__swap").alias("swaps"))
    for part in (pooled, records, middle):
        out = ranks.same_groups(out, part, [step])
    return out.select(step, "pooled_median", "mean", "ok", "failed", "first_median", "best_median", "non_finite", "swaps", "paired", "improved", "delta")


def eval_table(samples: DataFrame, reference: DataFrame, run: str, record: str, sample: str, value: str, held: str, bucket: str, buckets: list) -> DataFrame:
    """For each run: records (n), pooled median and mean, median of first samples, and against
    ``reference`` (record, ref) the median difference of record means, how many are lower and of how
    many, over all records and over those ``held`` out; then the pooled median of each bucket."""
    x = F.col(value).cast("double")
    rows = samples.withColumn("__v", F.when(_finite(x), x))
    per = rows.groupBy(run, record).agg(F.avg("__v").alias("m"), F.min_by(F.struct("__v"), sample)["__v"].alias("first"), F.bool_or(held).alias("__h")).join(reference, record, "left")
    d, h = F.col("m") - F.col("ref"), F.col("__h")
    counts = per.groupBy(run).agg(F.count("*").alias("n"), F.count_if(d < 0).alias("improved"), F.count(d).alias("paired"), F.count_if((d < 0) & h).alias("held_improved"), F.count(F.when(h, d)).alias("held_paired"))
    middle = ranks.medians(per, [run], {"first_median": F.col("first"), "delta": d, "held_delta": F.when(h, d)})
    pooled = ranks.medians(rows, [run], {"median": F.col("__v")} | {f"m_{b}": F.when(F.col(bucket) == b, F.col("__v")) for b in buckets})
    out = rows.groupBy(run).agg(F.avg("__v").alias("mean"))
    for part in (counts, middle, pooled):
        out = ranks.same_groups(out, part, [run])
    return out


def bucket_pivot(records: DataFrame, bucket: str, run: str, value: str, runs: list) -> DataFrame:
    """The median of each bucket, one column for each run."""
    series = {r: F.when(F.col(run) == r, F.col(value)) for r in runs}
    return ranks.same_groups(records.select(bucket).distinct(), ranks.medians(records, [bucket], series), [bucket])


def pooled_draws(draws: list[DataFrame], arm: str, record: str, value: str) -> DataFrame:
    """(arm, record, mean, n): record means over the samples of all draws of an arm."""
    rows = draws[0]
    for d in draws[1:]:
        rows = rows.unionByName(d)
    return rows.groupBy(arm, record).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))


def compare_arms(pooled: DataFrame, arm: str, record: str, base) -> DataFrame:
    """(arm, paired, improved, delta, p) of each arm but ``base``: records of both, how many have a lower
    mean, the median difference, and the sign test of it. ``pooled`` as :func:`pooled_draws` gives it."""
    ref = pooled.where(F.col(arm) == base).select(record, F.col("mean").alias("__ref"))
    both = pooled.where(F.col(arm) != base).join(ref, record).withColumn("__d", F.col("mean") - F.col("__ref")).where("__d is not null")
    counts = both.groupBy(arm).agg(F.count("*").alias("paired"), F.count_if(F.col("__d") < 0).alias("improved"))
    out = ranks.same_groups(counts, ranks.medians(both, [arm], {"delta": F.col("__d")}), [arm])
    return sign_test(out, "improved", "paired").select(arm, "paired", "improved", "delta", "p")


def valid_totals(records: DataFrame, lists: dict[str, str]) -> DataFrame:
    """One row: for each name the elements of the list column (structs with ``valid``) of all records
    that are valid and that are not: <name>_valid, <name>_invalid. Null lists have none."""
    size = lambda c, want: F.coalesce(F.size(F.filter(c, lambda x: F.coalesce(x["valid"], F.lit(False)) == want)), F.lit(0))
    return records.agg(*[F.coalesce(F.sum(F.greatest(size(c, want), F.lit(0))), F.lit(0)).alias(f"{name}_{label}") for name, c in lists.items() for label, want in (("valid", True), ("invalid", False))])


def distinct_refs(records: DataFrame, items: str, field: str, sentinels: tuple = ("", "-1")) -> DataFrame:
    """The distinct references in a nested list's field, but null and ``sentinels``."""
    refs = records.select(F.explode(items).alias("item")).select(F.col(f"item.{field}").alias(field))
    return refs.where(F.col(field).isNotNull() & ~F.col(field).cast("string").isin(*sentinels)).distinct()


def sample_stats(arr: Column, places: int = 4) -> Column:
    """struct(min, mean, first) of an array of samples, the mean rounded; nulls where it is null or empty."""
    n = F.nullif(F.size(arr), F.lit(0))
    mean = F.round(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x) / n, places)
    return F.struct(F.array_min(arr).alias("min"), mean.alias("mean"), F.get(arr, F.lit(0)).alias("first"))


def top_rows(df: DataFrame, x: str, key: str, k: int = 6) -> DataFrame:
    """The k rows of the largest ``x``, of equals the smallest key first: the limit is the feature."""
    return df.orderBy(F.desc_nulls_last(x), key).limit(k)


def coverage_check(states: DataFrame, expected: DataFrame, metric: str, weight: str, want: str) -> DataFrame:
    """The metrics whose weight is not the expected one; a metric without a state is left out."""
    return states.join(expected, metric).where(F.col(weight).isNotNull() & (F.col(weight) != F.col(want))).select(metric, weight, want)


def residue_quality(df: DataFrame, id_col: str, values: str, low: float, high: float, full: float) -> DataFrame:
    """mean, min and counts below ``low``, above ``high`` and below ``full`` of a row's array; an
    absent or empty array gives nulls, not zeros."""
    v = F.when(F.size(values) > 0, F.col(values))
    count = lambda test: F.when(v.isNotNull(), F.size(F.filter(v, test))).cast("long")
    mean = F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / F.size(v)
    return df.select(id_col, mean.alias("mean"), F.array_min(v).alias("min"), count(lambda x: x < low).alias("n_low"), count(lambda x: x > high).alias("n_high"), count(lambda x: x < full).alias("n_partial"))


def record_table(rows: DataFrame, record: str, run: str, x: str, runs: list[str], first: str) -> DataFrame:
    """record x run means, the record with the largest mean in run ``first`` first."""
    return rows.groupBy(record).pivot(run, runs).agg(F.avg(x)).orderBy(F.desc_nulls_last(first), record)


def redundancy(rows: DataFrame, group: str, idx: str, seq: str, first_n: int) -> DataFrame:
    """(group, rows, distinct, n90, n80, identity) of the first rows of each alignment: how many are
    at least 90 or 80 % identical, place by place, to row 0, and the mean identity to it."""
    head = rows.where(F.col(idx) < first_n)
    query = rows.where(F.col(idx) == 0).select(F.col(group), F.col(seq).alias("__q"))
    both = head.join(query, group)
    same = F.zip_with(F.split(seq, ""), F.split("__q", ""), lambda a, b: a == b)
    identity = F.size(F.filter(same, lambda x: x)) / F.greatest(F.length("__q"), F.lit(1))
    out = both.withColumn("__i", identity).groupBy(group)
    return out.agg(F.count("*").alias("rows"), F.count_distinct(seq).alias("distinct"), F.count_if(F.col("__i") >= 0.9).alias("n90"), F.count_if(F.col("__i") >= 0.8).alias("n80"), F.avg("__i").alias("identity"))
