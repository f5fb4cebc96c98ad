"""Projections, filters and ordered rules over records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def temporal_split(df: DataFrame, date: str, train_end: str, val_end: str, out: str = "split") -> DataFrame:
    """train / validation / test by two inclusive bounds; a null date is ``unknown``."""
    d = F.to_date(F.col(date))
    call = F.when(d.isNull(), "unknown").when(d <= F.lit(train_end).cast("date"), "train").when(d <= F.lit(val_end).cast("date"), "validation")
    return df.withColumn(out, call.otherwise("test"))


def key_normalize(col: Column) -> Column:
    return F.upper(F.replace(F.coalesce(col, F.lit("")), F.lit(" "), F.lit("")))


def null_sentinel(col: Column, sentinels=("", "NONE", "---", "-1")) -> Column:
    return F.when(F.upper(F.trim(col)).isin(*sentinels), None).otherwise(col)


def first_or_null(col: Column) -> Column:
    return F.get(col, F.lit(0))


def name_split(df: DataFrame, name: str) -> DataFrame:
    """prefix and trailing number of a name; without digits at its end the whole name, null."""
    digits = F.regexp_extract(name, r"(\d+)$", 1)
    return df.withColumns({"prefix": F.regexp_extract(name, r"^(.*?)(\d*)$", 1), "oper": F.when(digits != "", digits)})


def bucket(col: Column, edges: list[tuple[float, str]], last: str) -> Column:
    """The label of the first edge that is not below the value; null is ``?``."""
    out = F.when(col.isNull(), "?")
    for edge, label in edges:
        out = out.when(col <= edge, label)
    return out.otherwise(last)


def category_sequence(df: DataFrame, group: str, pos: str, code: str, mapping: dict[str, str], default: str = "X") -> DataFrame:
    """One string per group: the mapped codes in order of position."""
    table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    mapped = df.select(group, pos, F.coalesce(table[F.col(code)], F.lit(default)).alias("c"))
    ordered = F.array_sort(F.collect_list(F.struct(pos, "c")))
    return mapped.groupBy(group).agg(F.array_join(F.transform(ordered, lambda x: x["c"]), "").alias("seq"))


def multiregex(text: Column, any_of: list[str], none_of: list[str], length: Column, bounds: tuple[int, int]) -> Column:
    hit = F.lit(False)
    for p in any_of:
        hit = hit | text.rlike("(?i)" + p)
    for p in none_of:
        hit = hit & ~text.rlike("(?i)" + p)
    return hit & length.between(*bounds)


def first_rule(rules: list[tuple[Column, str, Column]], default: str) -> Column:
    """struct(role, evidence) of the first rule that holds."""
    out = None
    for cond, role, why in rules:
        pair = F.struct(F.lit(role).alias("role"), why.alias("evidence"))
        out = F.when(cond, pair) if out is None else out.when(cond, pair)
    return out.otherwise(F.struct(F.lit(default).alias("role"), F.lit("default").alias("evidence")))


def flags_sorted(flags: Column) -> Column:
    return F.array_sort(F.array_distinct(flags))


def finite(arr: Column) -> Column:
    return F.filter(arr, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def valid_flags(items: Column, keep: Column, key: str) -> Column:
    """Each nested element with ``valid`` set to whether its key is among those kept."""
    return F.transform(items, lambda c: c.withField("valid", F.array_contains(keep, c[key])))


def valid_interfaces(items: Column, keep: Column, a: str = "chain_1", b: str = "chain_2") -> Column:
    """Each nested interface with ``valid`` set to whether both its ends are among those kept."""
    return F.transform(items, lambda i: i.withField("valid", F.coalesce(F.array_contains(keep, i[a]) & F.array_contains(keep, i[b]), F.lit(False))))


def bool_mask(n: Column, keep: Column) -> Column:
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.array_contains(keep, i.cast("int")))).otherwise(F.array().cast("array<boolean>"))


def sub_role(text: Column, patterns: list[tuple[str, str]], default: str = "unknown") -> Column:
    """The role of the first pattern that the text holds, in any case; null text has the default."""
    out = F.lit(default)
    for pattern, role in reversed(patterns):
        out = F.when(text.rlike(f"(?i){pattern}"), role).otherwise(out)
    return out


def homology_role(score: Column, length: Column, fused: Column, call: float = 0.25, ambiguous: float = 0.10, bounds=(150, 400), fusion_from: int = 320) -> Column:
    """struct(role, evidence, flags) by bands of the score; role null where none holds.

    From ``call`` on: ``fusion`` if longer than the upper bound, or than ``fusion_from`` with fused
    partners named; ``heavy`` within the bounds; shorter ones stay unset. Below it, from
    ``ambiguous`` on: ``other`` with a flag. A null score or length sets nothing.
    """
    of = lambda role, text, *flags: F.struct(F.lit(role).alias("role"), text.alias("evidence"), F.array(*map(F.lit, flags)).cast("array<string>").alias("flags"))
    high = score >= call
    fusion = high & ((length > bounds[1]) | ((length > fusion_from) & F.coalesce(fused, F.lit(False))))
    return (
        F.when(fusion, of("fusion", F.format_string("kmer_containment=%.3f, length=%d", score, length), "single_chain_fusion"))
        .when(high & length.between(*bounds), of("heavy", F.format_string("kmer_containment=%.3f", score)))
        .when((score >= ambiguous) & (score < call), of("other", F.format_string("ambiguous homology=%.3f", score), "ambiguous_homology"))
        .otherwise(of(None, F.lit(None).cast("string")))
    )


def tagged_recovery(df: DataFrame, role: str, named: Column, length: Column, score: Column, to: str, call: float = 0.25, bounds=(80, 260)) -> DataFrame:
    """Second pass over rows whose role is unset or ``other``: those that are named so, of a length
    within the bounds and of a score below ``call`` (null counts as 0), get the role ``to``, evidence
    and a flag; others stay as they are. ``df`` has the columns evidence and flags."""
    s = F.coalesce(score, F.lit(0.0))
    hit = F.coalesce((F.col(role).isNull() | (F.lower(role) == "other")) & named & length.between(*bounds) & (s < call), F.lit(False))
    why = F.format_string("named + length %d (tagged construct), homology %.3f", length, s)
    flags = F.coalesce("flags", F.array().cast("array<string>"))
    return df.withColumns({role: F.when(hit, to).otherwise(F.col(role)), "evidence": F.when(hit, why).otherwise(F.col("evidence")), "flags": F.when(hit, F.array_append(flags, "expression_tag")).otherwise(flags)})


def default_evidence(df: DataFrame, role: str, score: Column, default: str = "other") -> DataFrame:
    """Rows without a role get the default and say so, with the score where there is one."""
    tail = F.when(score.isNotNull(), F.format_string("; homology=%.3f", score)).otherwise("")
    why = F.when(F.col(role).isNull(), F.concat(F.lit("no rule matched"), tail)).otherwise(F.col("evidence"))
    return df.withColumns({"evidence": why, role: F.coalesce(role, F.lit(default))})


def scored(sanity: Column, key: Column, values: Column) -> Column:
    """Whether a row is no warm-up row, and has an id and a finite value."""
    return ~F.coalesce(sanity, F.lit(False)) & key.isNotNull() & (F.size(finite(F.coalesce(values, F.array().cast("array<double>")))) > 0)
