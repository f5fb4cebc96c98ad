"""Sources and sinks: conformed schemas, nested entries, member indexes, split outputs, snapshots."""

from __future__ import annotations

import io
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.seq import clean
from . import json_array


def shared_path(spark: SparkSession) -> str:
    """A new path in the folder that all executors share. Where none is set, a local one if Spark
    runs in one process, else an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-shared-')}"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = shared_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def conform(df: DataFrame, target: StructType, default=0) -> DataFrame:
    """The target's fields in its order, by name; a field that ``df`` lacks gets ``default``."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(default)).cast(f.dataType).alias(f.name) for f in target])


def flatten(df: DataFrame, key: str, items: str) -> DataFrame:
    """One row for each struct of a nested list, with its entry's key; an empty or null list gives one null row."""
    return df.select(key, F.explode_outer(items).alias("item")).select(key, "item.*")


def polymer_entities(entries: DataFrame, key: str, items: str, seq: str, lists: tuple[str, ...]) -> DataFrame:
    """One row for each polymer entity of an entry (:func:`flatten`): its sequence without line ends and
    in upper case, its length, and each of ``lists`` sorted and distinct, without nulls (null: empty)."""
    rows = flatten(entries, key, items).withColumn(seq, clean(F.col(seq))).withColumn("length", F.length(seq))
    tidy = lambda c: F.array_sort(F.array_distinct(F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda x: x.isNotNull())))
    return rows.withColumns({c: tidy(F.col(c)) for c in lists})


def member_index(rows: DataFrame, wanted: DataFrame, name: str = "name", file_no: str = "file_no") -> DataFrame:
    """Wanted names with the offset and size that the last file gives, or found = false.

    Rows without a name or with a negative offset or size are malformed and dropped.
    """
    good = rows.where(F.col(name).isNotNull() & (F.col("offset") >= 0) & (F.col("size") >= 0))
    last = good.groupBy(name).agg(F.max(F.struct(file_no, "offset", "size")).alias("m"))
    return wanted.join(last, name, "left").select(name, "m.offset", "m.size", F.col("m").isNotNull().alias("found"))


def write_splits(df: DataFrame, path: str, split: str, held_out: str) -> tuple[str, str]:
    """The held-out split and the others in separate tables, so that a reader of one cannot meet the other.

    Rows without a split are not held out: they are in the open table, in a partition of their own.
    """
    open_path, held_path = f"{path}/open", f"{path}/{held_out}"
    df.where(~F.col(split).eqNullSafe(held_out)).write.partitionBy(split).parquet(open_path)
    df.where(F.col(split) == held_out).write.parquet(held_path)
    return open_path, held_path


def write_id_lists(df: DataFrame, path: str, split: str, key: str) -> None:
    """Text files of ids for each split, range-sorted: read by file name, each split's list is in order."""
    df.select(split, F.col(key).cast("string").alias("value"), key).repartitionByRange(split, key).sortWithinPartitions(split, key).select(split, "value").write.partitionBy(split).text(path)


def write_snapshots(df: DataFrame, path: str, by: list[str]) -> None:
    """Rewrites whole only the partitions of ``by`` that ``df`` holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def last_wins(left: DataFrame, right: DataFrame, on: list[str], order: str) -> DataFrame:
    """Equi-join; of the right rows that match one key, the last by ``order``."""
    w = Window.partitionBy(*on).orderBy(F.desc(order))
    return left.join(right.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r"), on)


def write_fixed_width(df: DataFrame, path: str, keep, columns: list[tuple[str, str]]) -> None:
    """One fixed-width line for each row that ``keep`` holds for; columns as (name, printf format)."""
    df.where(keep).select(F.format_string("".join(f for _, f in columns), *[F.col(c) for c, _ in columns]).alias("value")).write.text(path)


def write_stage_report(df: DataFrame, path: str, by: str, reason: str, key: str, k: int = 3) -> tuple[str, str]:
    """The report of a stage as one JSON line, and the table of all rows it took out as JSON lines; their paths.

    The line has rows, kept and dropped; ``by``: the kept rows of each value; ``reasons``: for each
    reason and each value of ``by`` the dropped rows and the ``k`` smallest keys. A row is kept if its
    ``reason`` is null. Both names stand in the line as text, null as "". Only counts and ``k`` keys a
    cell are gathered, so the line grows with the reasons and values, never with the rows."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = df.select(text(by).alias("by"), F.col(reason).cast("string").alias("reason"), F.col(key).alias("key"))
    cells = rows.groupBy("by", "reason").agg(F.count("*").alias("n"))
    nth = F.row_number().over(Window.partitionBy("by", "reason").orderBy(F.col("key").asc_nulls_last()))
    first = rows.where("reason is not null").withColumn("nth", nth).where(F.col("nth") <= k)
    first = first.groupBy("by", "reason").agg(F.array_sort(F.collect_list("key")).alias("first"))
    cells = cells.join(first, ["by", "reason"], "left")
    listed = lambda *cols: F.sort_array(F.collect_list(F.struct(*cols)))
    by_reason = cells.groupBy("reason").agg(F.sum("n").alias("n"), listed("by", F.struct("n", "first").alias("cell")).alias("cells"))
    kept = F.flatten(F.collect_list(F.when(F.col("reason").isNull(), F.col("cells"))))
    dropped = F.filter(listed("reason", "cells"), lambda r: r["reason"].isNotNull())
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    line = by_reason.agg(
        total(F.lit(True)).alias("rows"), total(F.col("reason").isNull()).alias("kept"), total(F.col("reason").isNotNull()).alias("dropped"),
        F.map_from_entries(F.transform(kept, lambda c: F.struct(c["by"], c["cell"]["n"]))).alias("by"),
        F.map_from_entries(F.transform(dropped, lambda r: F.struct(r["reason"], F.map_from_entries(r["cells"])))).alias("reasons"),
    )
    report, lost = f"{path}/report", f"{path}/dropped"
    line.coalesce(1).write.json(report)
    df.where(F.col(reason).isNotNull()).write.json(lost)
    return report, lost


def html_json_array(pages: DataFrame, id_col: str, html: str, pattern: str, schema: str) -> DataFrame:
    """One row for each element of the JSON array that ``pattern``'s first group finds in a page,
    with the fields of ``schema`` and error null; a page without such an array is one row with an error."""
    found = F.regexp_extract(F.coalesce(html, F.lit("")), pattern, 1)
    rows = pages.select(id_col, F.from_json(found, f"array<struct<{schema}>>").alias("items"))
    error = F.when(F.col("items").isNull(), "no array")
    return rows.select(id_col, error.alias("error"), F.explode_outer("items").alias("item")).select(id_col, "item.*", "error")


def write_manifest(df: DataFrame, path: str, part: str, order: str) -> None:
    """JSON files of one array of records each, in ``order``, a file for each value of ``part``. Rows are
    sorted once and written one after another; no task gathers a file."""
    body = F.to_json(F.struct(*[c for c in df.columns if c != part]))
    w = Window.partitionBy(part).orderBy(order)
    begin = F.when(F.row_number().over(w) == 1, "[").otherwise(",")
    end = F.when(F.lead(F.lit(1)).over(w).isNull(), "]").otherwise("")
    lines = df.select(part, F.concat(begin, body, end).alias("value"), F.col(order).alias("at"))
    lines.sortWithinPartitions(part, "at").select(part, "value").write.partitionBy(part).text(path)


def read_manifest(spark: SparkSession, path: str, schema: str, wanted: DataFrame, key: str, range_bytes: int = json_array.RANGE_BYTES) -> DataFrame:
    """The wanted records of JSON files that are one array each, read by ranges of bytes side by side
    (:mod:`json_array`). Corrupt records have no key and are left out; write the result as Parquet to
    read it again."""
    return json_array.read_array(spark, path, schema, range_bytes, wanted, key).where("_corrupt is null").drop("_corrupt")


ATOMS = "path string, chain string, residue int, atom int, x double, y double, z double, present boolean"


def structure_atoms(files: DataFrame) -> DataFrame:
    """The atoms of structure files, from rows (path, content) as ``binaryFile`` gives them.

    A file is an NPZ of the arrays chain, residue, coords, present (one entry an atom) and, if it has
    an ensemble, models: those coordinates of model 0 are taken if they are as many as the atoms.
    Files are small beside a partition; each is one row, and none is opened on the driver.
    """

    def read(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with np.load(io.BytesIO(content), allow_pickle=False) as f:
                    chain, residue, present, xyz = f["chain"], f["residue"], f["present"], f["coords"]
                    if "models" in f and len(f["models"]) and f["models"][0].shape == xyz.shape:
                        xyz = f["models"][0]
                n = len(chain)
                cols = [pa.array([path] * n, pa.string()), pa.array(chain.astype(str).tolist(), pa.string()), pa.array(residue.astype(np.int32)), pa.array(np.arange(n, dtype=np.int32)), *(pa.array(xyz[:, k].astype(float)) for k in range(3)), pa.array(present.astype(bool))]
                yield pa.RecordBatch.from_arrays(cols, ["path", "chain", "residue", "atom", "x", "y", "z", "present"])

    return files.select("path", "content").mapInArrow(read, ATOMS)
