"""Window operators: best, runner-up, leakage removal, islands, caps, marks.

Running operators (high water, islands, monotonic) are carried scans: a group's rows are cut into
chunks of its order, each chunk is reduced to one small state, a window goes over the states of a
group, and what comes before a chunk is carried into it. A group of any size is as many keys as it
has chunks, and nothing is run or stored before the result is asked for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ranks import same_groups


#: Values of an integer order, or seconds of a time, that make a chunk.
CHUNK, CHUNK_SECONDS = 4096, 3600


def chunk_of(df: DataFrame, order: str, chunk: Column | None = None) -> Column:
    """The chunk of a row: any column that never falls as the order rises. By itself CHUNK values of an
    integer or CHUNK_SECONDS of a time; of another kind of order all rows are one chunk. The result
    does not depend on it, only how a large group is spread."""
    if chunk is not None:
        return chunk
    kind = dict(df.dtypes)[order]
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.floor(F.col(order) / CHUNK)
    if kind in ("timestamp", "timestamp_ntz", "date"):
        return F.floor(F.unix_timestamp(F.col(order).cast("timestamp")) / CHUNK_SECONDS)
    return F.lit(0).cast("long")


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def best_pair(pairs: DataFrame, entry: str, order: list[Column]) -> DataFrame:
    return pairs.withColumn("__r", F.row_number().over(W.partitionBy(entry).orderBy(*order))).where("__r = 1").drop("__r")


def runner_up(pairs: DataFrame, entry: str, score: str, order: list[Column], ratio: float = 0.5) -> DataFrame:
    """(entry, best, rival, ambiguous): whether the best rival has more than ratio x the winner's score.
    ``order`` says who wins; the rival is the highest score of the others. Spark keeps two rows of an
    entry in each task before it shuffles, if the order begins with the score."""
    window = W.partitionBy(entry)
    first = pairs.withColumn("__r", F.row_number().over(window.orderBy(*order))).where("__r <= 1")
    high = pairs.withColumn("__r", F.row_number().over(window.orderBy(F.desc_nulls_last(score)))).where("__r <= 2")
    best = first.groupBy(entry).agg(F.max(score).alias("best"))
    two = high.groupBy(entry).agg(F.count("*").alias("__n"), F.max(score).alias("__top"), F.min(F.when(F.col("__r") == 2, F.col(score))).alias("__next"))
    # the winner is one of the two highest scores, or the rival is the highest of all
    rival = F.when(F.col("__n") == 1, None).when(F.col("best").eqNullSafe(F.col("__top")), F.col("__next")).otherwise(F.col("__top"))
    g = same_groups(best, two, [entry]).select(entry, "best", rival.alias("rival"))
    return g.withColumn("ambiguous", F.coalesce(F.col("rival") > ratio * F.col("best"), F.lit(False)))


def keep_split(df: DataFrame, keys: list[str], split: str, ranks: dict[str, int]) -> DataFrame:
    """Leakage removal: action and kept_in, the most protected split of the row's key.

    Rows of another split are marked ``drop``. A split that has no rank (as of a row without a date)
    is ``undated``: it neither protects nor leaks, and is for the caller to see to. The best split
    of a key is a partial aggregation joined back, so a frequent key is no single task; null keys
    are a group of their own.
    """
    name = {v: k for k, v in ranks.items()}
    table = F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv])
    back = F.create_map(*[F.lit(x) for kv in name.items() for x in kv])
    ranked = df.withColumn("__rank", table[F.col(split)])
    best = ranked.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.min("__rank").alias("__best"))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    action = F.when(F.col("__rank").isNull(), "undated").when(F.col("__rank") == F.col("__best"), "keep").otherwise("drop")
    return ranked.join(best, same, "left").withColumns({"action": action, "kept_in": back[F.col("__best")]}).select(*df.columns, "action", "kept_in")


def last_per_record(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("__r", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("__r = 1").drop("__r")


def anchor_window(df: DataFrame, group: str, pos: str, ok: str, size: int = 180) -> DataFrame:
    """Resolved rows of the ``size`` positions from each group's first resolved one. The first is a
    partial aggregation joined back, so a large group is no single task; its join is left to adaptive
    execution, which broadcasts the starts or splits a hot group."""
    starts = df.where(F.col(ok)).groupBy(group).agg(F.min(pos).alias("start"))
    return same_groups(df, starts, [group]).where(F.col(ok) & (F.col(pos) < F.col("start") + size))


def depth_cap(df: DataFrame, group: str, row_idx: str, schedule: list[int], epoch: int) -> DataFrame:
    """The first rows of each group as many as the epoch's cap, whose last value holds on."""
    cap = schedule[min(epoch, len(schedule) - 1)]
    return df.withColumn("__r", F.row_number().over(W.partitionBy(group).orderBy(row_idx))).where(F.col("__r") <= cap).drop("__r")


def islands(df: DataFrame, group: str, n: str, chunk: Column | None = None) -> DataFrame:
    """Consecutive integers as ``a-b`` spans joined by ``+``. Spans of a chunk come first; those that
    touch across chunks are joined, a row a span."""
    d = df.where(F.col(n).isNotNull()).select(group, n, chunk_of(df, n, chunk).alias("__chunk")).distinct()
    d = d.withColumn("__run", F.col(n) - F.row_number().over(W.partitionBy(group, "__chunk").orderBy(n)))
    part = d.groupBy(group, "__chunk", "__run").agg(F.min(n).alias("__a"), F.max(n).alias("__b"))
    w = W.partitionBy(group).orderBy("__a")
    new = F.when(F.col("__a") == F.lag("__b").over(w) + 1, 0).otherwise(1)
    s = part.withColumn("__new", new).withColumn("__run", F.sum("__new").over(w)).groupBy(group, "__run").agg(F.min("__a").alias("a"), F.max("__b").alias("b"))
    text = F.when(F.col("a") == F.col("b"), F.col("a").cast("string")).otherwise(F.concat_ws("-", F.col("a").cast("string"), F.col("b").cast("string")))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("a"), text.alias("t"))))
    return s.groupBy(group).agg(F.array_join(F.transform(ordered, lambda x: x["t"]), "+").alias("spans"))


def monotonic(df: DataFrame, group: str, order: str, value: str, end: Column | None = None, size: Column | None = None, chunk: Column | None = None) -> DataFrame:
    """(group, ok[, end_ok]): whether the value strictly rises within each group in ``order``, and, with
    ``end`` and ``size``, whether the last row's ``end`` (as offset + count) is the ``size``. A comparison
    with null counts as rising, an end or size of null as wrong. A chunk is reduced to whether it rises
    and its first and last row; ``order`` is one of a kind within a group."""
    row = F.struct(F.col(order), F.col(value).alias("v"), (F.lit(None) if end is None else end).alias("end"), (F.lit(None) if size is None else size).alias("size"))
    rows = df.select(group, order, value, chunk_of(df, order, chunk).alias("__chunk"), row.alias("__row"))
    before = F.lag(value).over(W.partitionBy(group, "__chunk").orderBy(order))
    ends = rows.withColumn("__ok", F.coalesce(F.col(value) > before, F.lit(True))).groupBy(group, "__chunk")
    ends = ends.agg(F.bool_and("__ok").alias("__ok"), F.min_by("__row", order).alias("__first"), F.max_by("__row", order).alias("__last"))
    joint = F.coalesce(F.col("__first.v") > F.lag("__last.v").over(W.partitionBy(group).orderBy("__chunk")), F.lit(True))
    out = ends.withColumn("__joint", joint).groupBy(group).agg(F.bool_and(F.col("__ok") & F.col("__joint")).alias("ok"), F.max_by("__last", "__chunk").alias("__last"))
    if end is None:
        return out.select(group, "ok")
    return out.select(group, "ok", F.coalesce(F.col("__last.end") == F.col("__last.size"), F.lit(False)).alias("end_ok"))


def high_water(df: DataFrame, group: str, order: list[str], x: str, eps: float = 0.05, chunk: Column | None = None) -> DataFrame:
    """Rows that pass the highest value before them by more than eps, and that value as peak_before.
    The peaks of the chunks before a row's own are carried into it."""
    rows = df.withColumn("__chunk", chunk_of(df, order[0], chunk))
    peaks = rows.groupBy(group, "__chunk").agg(F.max(x).alias("__peak"))
    ahead = W.partitionBy(group).orderBy("__chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = peaks.select(group, "__chunk", F.max("__peak").over(ahead).alias("__ahead"))
    here = F.max(x).over(W.partitionBy(group, "__chunk").orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    out = same_groups(rows.withColumn("__here", here), carried, [group, "__chunk"])
    out = out.select(*df.columns, F.greatest("__here", "__ahead").alias("peak_before"))
    return out.where(F.col("peak_before").isNull() | (F.col(x) > F.col("peak_before") + eps))


def best_partner(pairs: DataFrame, anchor: str, partner: str, contacts: str) -> DataFrame:
    """(anchor, partner, flag): the partner with most contacts, the smallest of equals; none has any: a flag."""
    best = pairs.groupBy(anchor).agg(F.min(F.struct((-F.col(contacts)).alias("n"), F.col(partner))).alias("b"))
    some = F.col("b.n") < 0
    return best.select(anchor, F.when(some, F.col(f"b.{partner}")).alias(partner), F.when(~F.coalesce(some, F.lit(False)), "present_but_not_contacting").alias("flag"))


def schedule_check(observed: DataFrame, epoch: str, depth: str, schedule: list[int]) -> DataFrame:
    """(epoch, cap, rows, n_off): how many observed depths differ from the cap the schedule sets for
    their epoch; its last value holds on. Depths are taken as observed, not cut to the cap."""
    caps = F.array(*map(F.lit, schedule))
    cap = F.element_at(caps, (F.least(F.col(epoch), F.lit(len(schedule) - 1)) + 1).cast("int"))
    return observed.groupBy(epoch).agg(F.first(cap).alias("cap"), F.count("*").alias("rows"), F.count_if(F.col(depth) != cap).alias("n_off"))
