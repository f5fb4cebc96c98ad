"""Joins: left with defaults, intervals, spatial radius, cross checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def metadata_left(df: DataFrame, meta: DataFrame, on: str, defaults: dict) -> DataFrame:
    return df.join(meta, on, "left").fillna(defaults)


def anti_missing(wanted: DataFrame, have: DataFrame, on: str) -> DataFrame:
    return wanted.join(have, on, "left_anti")


def semi_available(df: DataFrame, have: DataFrame, on: str) -> DataFrame:
    return df.join(have, on, "left_semi")


def cross_pairs(df: DataFrame, entry: str, item: str, role: str, a: str, b: str) -> DataFrame:
    """All pairs of an item of role a and one of role b within each entry."""
    left = df.where(F.col(role) == a).select(entry, F.col(item).alias("a"))
    return left.join(df.where(F.col(role) == b).select(entry, F.col(item).alias("b")), entry)


def dyadic_cover(start: Column, count: Column) -> Column:
    """Array of (level, place): the fewest blocks [place * 2^level, (place + 1) * 2^level) that make up
    [start, start + count), two a level at most. Empty for no or a negative count, null for nulls. Only
    the levels of blocks that are no longer than the range are looked at."""
    lo, hi = start.cast("long"), (start + count).cast("long")

    def blocks(k: Column) -> Column:
        first, end = -F.call_function("shiftright", -lo, k), F.call_function("shiftright", hi, k)
        odd = lambda x: x.bitwiseAND(F.lit(1)) == 1
        one = lambda cond, at: F.when((first < end) & cond, F.struct(k.alias("level"), at.alias("place")))
        return F.array_compact(F.array(one(odd(first), first), one(odd(end), end - 1)))

    top = F.length(F.bin(F.greatest(hi - lo, F.lit(1)))) - 1
    return F.when(hi > lo, F.flatten(F.transform(F.sequence(F.lit(0), top), blocks))).when(hi <= lo, F.array().cast("array<struct<level:int,place:bigint>>"))


def interval_join(points: DataFrame, ranges: DataFrame, pos: str, start: str, count: str) -> DataFrame:
    """Each point with the ranges [start, start + count) it lies in, by equi-join of dyadic blocks.

    A range is the fewest blocks of powers of two that cover it (under 64 up to a length of 2^32,
    124 at most); a point lies in one block of each level. So long and nested ranges cost as little
    as short ones. Only levels that some range has are looked up; they, 63 at most, are asked for
    when this is called. Rows with a null position, start or count, or a count below 1, match nothing.
    """
    cover = ranges.withColumn("__block", F.explode(dyadic_cover(F.col(start), F.col(count))))
    cover = cover.select(*ranges.columns, F.col("__block.level").alias("__level"), F.col("__block.place").alias("__place"))
    levels = sorted(r[0] for r in cover.select("__level").distinct().collect())
    looked = points.withColumn("__level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>")))
    looked = looked.withColumn("__place", F.call_function("shiftright", F.col(pos).cast("long"), F.col("__level")))
    return looked.join(cover, ["__level", "__place"]).drop("__level", "__place")


#: Points of one cell that a task compares with those around it; cells with more are dealt in slices.
DENSE = 4096


def radius_join(a: DataFrame, b: DataFrame, r: float, group: list[str] = (), inclusive: bool = True, dense: int = DENSE) -> DataFrame:
    """Pairs of points (id, x, y, z) of ``a`` and ``b`` within r: (group, a_id, b_id, dist2).

    Space is cut into cells of side 2 r; the ball around a point of ``a`` meets two of them along each
    axis at most, so eight copies of it meet each point of ``b`` once. A cell with more than ``dense``
    points of ``b`` is dealt in slices of its points, and the points of ``a`` go to each: all points
    may lie in one cell. Points without a coordinate match nothing.
    """
    cells = [*group, "cx", "cy", "cz"]
    cell = lambda c: F.floor(c / (2.0 * r)).cast("long")
    left = a.select(*group, F.col("id").alias("a_id"), *[F.col(c).cast("double").alias("a" + c) for c in "xyz"])
    for c in "xyz":
        left = left.withColumn("c" + c, F.explode(F.sequence(cell(F.col("a" + c) - r), cell(F.col("a" + c) + r))))
    right = b.select(*group, F.col("id").alias("b_id"), *[F.col(c).cast("double").alias("b" + c) for c in "xyz"], *[cell(F.col(c)).alias("c" + c) for c in "xyz"])
    full = right.groupBy(*cells).agg(F.count("*").alias("__n")).where(F.col("__n") > dense).select(*cells, F.ceil(F.col("__n") / dense).alias("__slices"))
    one = F.coalesce("__slices", F.lit(1).cast("long"))
    left = left.join(full, cells, "left").withColumn("__slice", F.explode(F.sequence(F.lit(0).cast("long"), one - 1))).drop("__slices")
    right = right.join(full, cells, "left").withColumn("__slice", F.pmod(F.xxhash64("b_id", "bx", "by", "bz"), one)).drop("__slices")
    d2 = sum((F.col("a" + c) - F.col("b" + c)) ** 2 for c in "xyz")
    hits = left.join(right, [*cells, "__slice"]).withColumn("dist2", d2)
    return hits.where(F.col("dist2") <= r * r if inclusive else F.col("dist2") < r * r).select(*group, "a_id", "b_id", "dist2")


def source_crosscheck(a: DataFrame, b: DataFrame, key: str, field: str, derive: Callable[[Column], Column] | None = None) -> DataFrame:
    """Keys whose field differs between the sources or is missing in one; with ``derive`` (as the split
    that follows from a date) also whether what is derived ``changes``."""
    x, y = a.select(key, F.col(field).alias("a")), b.select(key, F.col(field).alias("b"))
    out = x.join(y, key, "full").where(~F.col("a").eqNullSafe(F.col("b")))
    return out if derive is None else out.withColumn("changes", ~derive(F.col("a")).eqNullSafe(derive(F.col("b"))))


def name_crosscheck(df: DataFrame, name: Column, ids: str) -> DataFrame:
    """(n, n_match, rate): rows with a name and ids, how many names are among their row's ids, and the share."""
    rows = df.where(name.isNotNull() & F.col(ids).isNotNull())
    return rows.agg(F.count("*").alias("n"), F.count_if(F.array_contains(ids, name)).alias("n_match")).withColumn("rate", F.try_divide("n_match", "n"))


#: Parts of a reference's users, each in one task.
PARTS = 32


def reference_exists(refs: DataFrame, ref: str, user: str, have: DataFrame, key: str, k: int = 3) -> DataFrame:
    """References to nothing, with their number of users and the k first of them.

    Users of a reference are dealt to PARTS parts, which are made distinct and leave their number and
    their k first; so a reference that many rows name is many tasks' work. Both shuffles keep the
    session's number of partitions: the pairs compress so well that adaptive execution would gather
    those of a large table in a few tasks.
    """
    from pyspark.sql import Window as W

    n = int(refs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lost = refs.where(F.col(ref).isNotNull()).join(have.select(F.col(key).alias(ref)), ref, "left_anti")
    pairs = lost.select(ref, F.pmod(F.xxhash64(user), F.lit(PARTS)).alias("__part"), F.col(user).alias("__user")).repartition(n, ref, "__part").distinct()
    nth = pairs.withColumn("__nth", F.row_number().over(W.partitionBy(ref, "__part").orderBy("__user")))
    # a null user is one, comes first and has no name
    first = [F.max(F.when(F.col("__nth") == i, F.col("__user"))).alias(f"__{i}") for i in range(1, k + 1)]
    part = nth.groupBy(ref, "__part").agg(F.count("*").alias("__n"), F.bool_or(F.col("__user").isNull()).alias("__null"), *first)
    names = F.array_sort(F.flatten(F.collect_list(F.array_compact(F.array(*[f"__{i}" for i in range(1, k + 1)])))))
    whole = part.repartition(n, ref).groupBy(ref).agg(F.sum("__n").alias("users"), names.alias("__names"), F.bool_or("__null").alias("__null"))
    kept = F.slice("__names", F.lit(1), k - F.col("__null").cast("int"))
    return whole.select(ref, "users", F.array_join(F.transform(kept, lambda x: x.cast("string")), ",").alias("used_by"))


def exact_sequence(chains: DataFrame, entities: DataFrame, entry: str, seq: str, order: str) -> DataFrame:
    """Chains with the entity of their entry and sequence, the last by ``order`` of equals (a partial
    aggregation); the entities' other columns come along. Null and empty sequences match nothing."""
    rest = [c for c in entities.columns if c not in (entry, seq)]
    last = entities.where(F.col(seq) != "").groupBy(entry, seq).agg(F.max_by(F.struct(*rest), order).alias("__e"))
    return chains.join(last, [entry, seq]).select(*chains.columns, *[F.col(f"__e.{c}").alias(c) for c in rest])


def union_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct ids of both sides."""
    return a.select(key).union(b.select(key)).distinct()


def difference_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct ids of ``a`` that ``b`` lacks."""
    return a.select(key).subtract(b.select(key))


def intersect_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct ids of both sides alike."""
    return a.select(key).intersect(b.select(key))


def overlap(a: Column, b: Column) -> Column:
    """The number of distinct values that two arrays share; null counts as an empty array."""
    return F.when(a.isNull() | b.isNull(), 0).otherwise(F.size(F.array_intersect(a, b)))
