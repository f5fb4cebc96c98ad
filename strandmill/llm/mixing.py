"""Mixing sources to target weights: every document is taken as often as its source's rate says.

Only DataFrame operations. Words are summed by source (partial aggregation, so that a source with a
third of all rows is no single task), targets follow from weights and a limit, and a document is
emitted floor(rate) times plus one more time with probability equal to the fraction, decided by a
hash of its id: reruns agree, and no document looks at another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, stored

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code-point order, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix over words of all sources; the most that a source is repeated.
SHARE, LIMIT = 1.5, 2.0
#: Hashes that a source may draw with: four 32-bit numbers of each digest.
DIGESTS = 8


def sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, size): words of each row; null text has none."""
    size = F.regexp_count(F.coalesce(text_col, F.lit("")), F.lit(WORD)).cast("long")
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"))


def placed(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``, from 0 by code point, null last: a range's rows are numbered from
    the count of the ranges before it, so that many sources are no single task."""
    laid = stored(sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()))
    ends = laid.groupBy("part").agg(F.count("*").alias("n"))
    # a row a range, as many as shuffle partitions at most
    before = ends.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return laid.join(before, "part").withColumn("place", F.col("before") + inside - 1).drop("part", "before")


def targets(sources: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """(source, source_size, target) of (source, source_size): ``share`` of all words by weight. A
    target stops at ``limit`` times its source's size, and what is above is shared again by weight
    until none is above; each round is one sum over the sources."""
    table = F.array(*[F.lit(float(w)) for w in weights])
    full = F.lit(float(limit)) * F.col("source_size")
    weighed = stored(placed(sources).select("source", "source_size", F.get(table, F.pmod(F.col("place"), F.lit(len(weights))).cast("int")).alias("weight")))
    total = weighed.agg(F.sum("source_size").alias("n"), F.sum("weight").alias("w")).first()
    rest, weight = share * (total.n or 0), total.w or 0.0
    while weight:
        over = full * weight <= F.col("weight") * rest
        found = weighed.agg(F.sum(F.when(over, full)).alias("full"), F.sum(F.when(~over, F.col("weight"))).alias("w")).first()
        now = share * total.n - (found.full or 0.0), found.w or 0.0
        if now == (rest, weight):
            break
        rest, weight = now
    target = F.least(full, F.col("weight") * rest / weight) if weight else full
    return weighed.select("source", "source_size", target.alias("target"))


def _number(seed: int, draw: Column, id_col: Column) -> Column:
    """A number from 0 to below 1 by the hash of the id."""
    text = F.md5(F.concat(F.lit(f"{seed}:"), (draw / 4).cast("int").cast("string"), F.lit(":"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(text, (draw % 4) * 8 + 1, F.lit(8)), 16, 10).cast("long") / F.lit(float(1 << 32))


def _copies(seed: int, draw: Column, id_col: Column, rate: Column) -> Column:
    return F.floor(rate) + F.when(_number(seed, draw, id_col) < rate - F.floor(rate), 1).otherwise(0)


def rates(sized: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, limit: float = LIMIT, seed: int = 11) -> DataFrame:
    """(source, source_size, target, rate, draw) of rows (id, source, size).

    A source may hold few documents, or one long one, so a single hash could miss its target by far.
    The same copies are therefore counted under 4 * DIGESTS hashes in one pass (a partial
    aggregation), and a source draws with the one that comes nearest to its target, of equals the
    first. A source without words has the rate 0.
    """
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, limit)
    rated = stored(sources.withColumn("rate", F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))))
    both = sized.join(rated.select(F.col("source").alias("of"), "rate"), F.col("source").eqNullSafe(F.col("of")))
    draws = range(4 * DIGESTS)
    sums = both.groupBy("source").agg(*[F.sum(F.col("size") * _copies(seed, F.lit(k), F.col("id"), F.col("rate"))).alias(f"s{k}") for k in draws])
    away = rated.join(sums.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    away = away.withColumn("away", F.array(*[F.abs(F.col(f"s{k}") - F.col("target")) for k in draws]))
    return stored(away.select("source", "source_size", "target", "rate", (F.array_position("away", F.array_min("away")) - 1).cast("int").alias("draw")))


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 11, **shares) -> DataFrame:
    """One row per row of ``docs``: id, source, size, source_size, target, rate, copies.

    Rows of one id and source get as many copies each. A null id is hashed as empty text, a null
    source is a source of its own (the last), null and empty texts have size 0 and are copied like
    others of their source; where a source has no words its rows are taken 0 times. An empty table
    gives no row. Other columns are not read. Texts are read once; the shared folder gets (id,
    source, size). ``shares``: weights, share and limit of :func:`rates`.
    """
    sized = stored(sizes(docs, id_col, text_col, source_col))
    found = rates(sized, seed=seed, **shares).withColumnRenamed("source", "of")
    rows = sized.join(found, F.col("source").eqNullSafe(F.col("of")))
    return rows.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "rate", _copies(seed, F.col("draw"), F.col("id"), F.col("rate")).alias("copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 11, **shares) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as :func:`plan_mix` says, all its columns and
    ``copy`` (from 1; with underscores before it where ``docs`` has such a column)."""
    found = rates(stored(sizes(docs, id_col, text_col, source_col)), seed=seed, **shares)
    names = {c: free_name(docs, f"mix_{c}") for c in ("source", "rate", "draw")}
    found = found.select(*[F.col(c).alias(n) for c, n in names.items()])
    rows = docs.join(found, F.col(source_col).eqNullSafe(F.col(names["source"])))
    copies = _copies(seed, F.col(names["draw"]), F.col(id_col), F.col(names["rate"])).cast("int")
    return rows.withColumn(free_name(docs, "copy"), F.explode(F.filter(F.sequence(F.lit(1), F.greatest(copies, F.lit(1))), lambda k: k <= copies))).drop(*names.values())
