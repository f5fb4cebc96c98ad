"""JSON lines that may be cut short, as of a log whose writer was killed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str, schema: str, corrupt: str = "_corrupt") -> tuple[DataFrame, Observation]:
    """(rows, counts) of JSON-lines files below ``path``.

    ``rows`` has the fields of ``schema`` and the line itself in ``corrupt`` where it is no whole JSON of
    that schema; blank lines are passed over. Fields of a corrupt line are null. ``counts`` is an
    observation of the same pass: after any action over ``rows``, ``counts.get`` has ``lines``, ``good`` and
    ``bad``. Nothing is read twice. Take ``where(corrupt is null)`` of ``rows`` for the good ones.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path).where(F.trim("value") != "")
    parsed = F.from_json("value", f"{schema}, {corrupt} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    rows = lines.select(parsed.alias("x"), "value").select("x.*", "value")
    bad = F.col(corrupt).isNotNull()
    rows = rows.withColumn(corrupt, F.when(bad, F.col("value"))).drop("value")
    counts = Observation(f"json_lines_{uuid.uuid4().hex}")
    return rows.observe(counts, F.count(F.lit(1)).alias("lines"), F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad")), counts


def dynamic_metrics(df: DataFrame, id_col: str, json: str, prefixes: tuple[str, ...] = ("train/",), names: tuple[str, ...] = ("lr",)) -> DataFrame:
    """(id, name, value): the numbers of a JSON object's open keys that begin with one of ``prefixes`` or
    are one of ``names``. Values that are no numbers, and lines that are no object, give no row."""
    found = F.from_json(json, "map<string,string>")
    wanted = lambda k: F.expr("false") if not prefixes and not names else _any([*[k.startswith(p) for p in prefixes], *([k.isin(*names)] if names else [])])
    rows = df.select(id_col, F.explode(F.map_filter(found, lambda k, v: wanted(k))).alias("name", "text"))
    number = F.col("text").try_cast("double")
    return rows.select(id_col, "name", number.alias("value")).where(F.col("value").isNotNull())


def _any(conditions: list):
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out
