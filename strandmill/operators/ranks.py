"""Exact ranks, order statistics and medians of groups of any size.

Values are counted first, so that ties and repeats cost one row. A value's place in its group is
found by radix: how many rows have a smaller power of two, how many of those of its power have a
smaller leading part (one of 2^16), and how many of its part are smaller. The first two are sums by
partial aggregation with a window over at most some thousand and 65,536 rows; the last is a window
over the distinct values of one part. Nothing is sorted as a whole, stored or run before the result
is asked for.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def same_groups(left: DataFrame, right: DataFrame, by: list[str], how: str = "left") -> DataFrame:
    """``left`` joined with ``right`` on ``by``, where a null group is a group as well."""
    right = right.withColumnsRenamed({c: f"__{c}" for c in by})
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by])
    return left.join(right, on, how).drop(*[f"__{c}" for c in by])


#: Parts of a power of two.
PARTS = 1 << 16


def _radix(df: DataFrame, x: str) -> tuple[Column, Column]:
    """(power, part): two columns by which values are in order, equal ones together; by both only
    values of one part are left to tell apart. Values that are no numbers are all of one part."""
    if dict(df.dtypes)[x] not in ("tinyint", "smallint", "int", "bigint", "float", "double") and not dict(df.dtypes)[x].startswith("decimal"):
        return F.lit(0).cast("long"), F.lit(0).cast("long")
    v = F.col(x).cast("double")
    size = F.abs(v)
    finite = ~F.isnan(v) & (size < float("inf"))
    power = F.floor(F.log2(F.when(finite & (size > 0), size)))
    sign = F.when(v < 0, -1).otherwise(1)
    outside = F.when(F.isnan(v), 10_000).when(v > 0, 9_000).otherwise(-9_000)  # NaN is the largest
    first = F.when(~finite, outside).when(size == 0, 0).otherwise(sign * (power + 2_000)).cast("long")
    # halved twice, since the powers at both ends of the doubles have no reciprocal
    part = F.floor(size / F.pow(F.lit(2.0), F.floor(power / 2)) / F.pow(F.lit(2.0), power - F.floor(power / 2)) * PARTS)
    return first, F.coalesce(F.when(finite & (size > 0), sign * part), F.lit(0)).cast("long")


def _counted(df: DataFrame, by: list[str], x: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Distinct values (by, x, __c, __p, __q) with their count, power and part; powers (by, __p, __n,
    __before) and parts (by, __p, __q, __s, __inside): rows of the group, and rows of smaller ones."""
    values = df.where(F.col(x).isNotNull()).groupBy(*by, x).agg(F.count("*").alias("__c"))
    p, q = _radix(df, x)
    values = values.withColumns({"__p": p, "__q": q})
    w = W.partitionBy(*by)
    powers = values.groupBy(*by, "__p").agg(F.sum("__c").alias("__s")).withColumn("__n", F.sum("__s").over(w))
    powers = powers.withColumn("__before", F.sum("__s").over(w.orderBy("__p")) - F.col("__s")).drop("__s")
    parts = values.groupBy(*by, "__p", "__q").agg(F.sum("__c").alias("__s"))
    parts = parts.withColumn("__inside", F.sum("__s").over(W.partitionBy(*by, "__p").orderBy("__q")) - F.col("__s"))
    return values, powers, parts


def _below(values: DataFrame, parts: DataFrame, by: list[str], x: str) -> DataFrame:
    """Values of the given parts (by, __p, __q, __n, __start) with the rows of the group below each."""
    key = [*by, "__p", "__q"]
    rows = same_groups(values, parts, key, "inner")
    return rows.withColumn("__below", F.col("__start") + F.sum("__c").over(W.partitionBy(*key).orderBy(x)) - F.col("__c"))


def ranked(df: DataFrame, by: list[str], x: str) -> DataFrame:
    """(by, x, n, below, size) for each distinct value of a group: how many rows have it, how many
    have a smaller one, and how many there are. Null values have no rank."""
    values, powers, parts = _counted(df, by, x)
    all_parts = same_groups(parts, powers, [*by, "__p"]).withColumn("__start", F.col("__before") + F.col("__inside"))
    rows = _below(values, all_parts.select(*by, "__p", "__q", "__n", "__start"), by, x)
    return rows.select(*by, x, F.col("__c").alias("n"), F.col("__below").alias("below"), F.col("__n").alias("size"))


def at_ranks(df: DataFrame, by: list[str], x: str, ranks: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """(by, one column for each name): the value at a rank from 0, given as a function of the number
    of values in the group. Only parts that hold such a rank are looked into."""
    values, powers, parts = _counted(df, by, x)
    at = {name: f(F.col("__n")).cast("long") for name, f in ranks.items()}
    found = same_groups(parts, powers, [*by, "__p"]).withColumn("__start", F.col("__before") + F.col("__inside"))
    held = reduce(lambda a, b: a | b, [(r >= F.col("__start")) & (r < F.col("__start") + F.col("__s")) for r in at.values()])
    rows = _below(values, found.where(held).select(*by, "__p", "__q", "__n", "__start"), by, x)
    pick = lambda r: F.max(F.when((r >= F.col("__below")) & (r < F.col("__below") + F.col("__c")), F.col(x)))
    return rows.groupBy(*by).agg(*[pick(r).alias(name) for name, r in at.items()])


LOWER_MIDDLE = lambda n: F.floor((n - 1) / 2)
UPPER_MIDDLE = lambda n: F.floor(n / 2)


def series_at_ranks(df: DataFrame, by: list[str], series: dict[str, Column], ranks: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """:func:`at_ranks` of several columns at once: (by, series, one column for each rank)."""
    long = df.select(*by, F.inline(F.array(*[F.struct(F.lit(k).alias("series"), v.cast("double").alias("__x")) for k, v in series.items()])))
    return at_ranks(long, [*by, "series"], "__x", ranks)


def medians(df: DataFrame, by: list[str], series: dict[str, Column]) -> DataFrame:
    """(by, one column for each series): exact medians; null where a group has no value of it. A
    group without any value has no row."""
    q = series_at_ranks(df, by, series, {"lo": LOWER_MIDDLE, "hi": UPPER_MIDDLE})
    return q.groupBy(*by).agg(*[F.max(F.when(F.col("series") == k, (F.col("lo") + F.col("hi")) / 2)).alias(k) for k in series])
