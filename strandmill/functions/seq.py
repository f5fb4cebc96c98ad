"""Sequence functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def kmers(s: Column, k: int = 5) -> Column:
    """Distinct k-mers in order of their first place; an empty array if the string is shorter than k.
    One pass over the string: a place is matched by what follows it, so its cost is linear."""
    every = F.regexp_extract_all(s, F.lit(f"(?s)(?=(.{{{k}}}))."), F.lit(1))
    return F.when(F.length(s) >= k, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def kmer_containment(df: DataFrame, key: str, s: str, panel: DataFrame, k: int = 5) -> DataFrame:
    """(key, score): the share of each row's distinct k-mers that the panel (kmer) has; 0 without any.

    Only k-mers are shuffled, and Spark broadcasts the panel where its size allows."""
    mine = df.select(key, F.explode_outer(kmers(F.col(s), k)).alias("kmer"))
    hit = mine.join(panel.select("kmer", F.lit(1.0).alias("hit")), "kmer", "left")
    return hit.groupBy(key).agg(F.avg(F.coalesce("hit", F.lit(0.0))).alias("score"))


def wildcard_identity(a: Column, b: Column) -> Column:
    """Identity over positions without ``X`` of strings of equal length; null if none are usable."""
    pairs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    used = F.filter(pairs, lambda p: (p["x"] != "X") & (p["y"] != "X"))
    same = F.size(F.filter(used, lambda p: p["x"] == p["y"]))
    return F.when((F.length(a) == F.length(b)) & (F.size(used) > 0), same / F.size(used))


def clean(s: Column) -> Column:
    """A sequence as metadata should have it: without line ends and blanks, in upper case."""
    return F.upper(F.regexp_replace(s, r"\s+", ""))


def prefix_identity(a: Column, b: Column) -> Column:
    """Identity over the common length of both strings' beginnings; null if either is empty."""
    n = F.least(F.length(a), F.length(b))
    x, y = F.split(F.substring(a, F.lit(1), n), ""), F.split(F.substring(b, F.lit(1), n), "")
    return F.when(n > 0, F.size(F.filter(F.zip_with(x, y, lambda p, q: p == q), lambda t: t)) / n)


def agrees(s: Column, full: Column, least: float = 0.9) -> Column:
    """Whether ``s`` without X is part of ``full`` without X, or is identical to its beginning in a
    share ``least`` or more of the positions where ``s`` has no X."""
    part = F.contains(F.replace(full, F.lit("X"), F.lit("")), F.replace(s, F.lit("X"), F.lit("")))
    n = F.least(F.length(s), F.length(full))
    pairs = F.arrays_zip(F.split(F.substring(s, F.lit(1), n), "").alias("x"), F.split(F.substring(full, F.lit(1), n), "").alias("y"))
    used = F.filter(pairs, lambda p: p["x"] != "X")
    same = F.size(F.filter(used, lambda p: p["x"] == p["y"]))
    return part | F.coalesce((F.size(used) > 0) & (n > 0) & (same >= least * F.size(used)), F.lit(False))
