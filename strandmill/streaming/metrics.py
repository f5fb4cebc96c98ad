"""Append-only telemetry as streams: running means, running peaks, rows with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def running_metrics(rows: DataFrame, metric: str, value: str, weight: Column) -> DataFrame:
    """Sums from which the mean of each metric follows; finite values only. For :func:`run_updates`."""
    x = F.col(value).cast("double")
    ok = rows.where(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return ok.groupBy(metric).agg(F.sum(x * weight).alias("total"), F.sum(weight).alias("weight"), F.count("*").alias("rows"))


def running_peak(rows: DataFrame, run: str, value: str) -> DataFrame:
    return rows.groupBy(run).agg(F.max(value).alias("peak"))


def with_reason(rows: DataFrame, failed: list[tuple[Column, str]]) -> DataFrame:
    """Every row, with the first reason it fails for, or null."""
    return rows.withColumn("reason", F.coalesce(*[F.when(c, F.lit(r)) for c, r in failed]))


def run_updates(stream: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Runs a stream of aggregates by ``keys`` over what is there and returns their table, see
    :func:`latest`.

    Each batch writes only the keys that it changed, as a partition of its own below ``path`` and
    whole in place of what it left before. State and batch numbers come from the checkpoint, so a run
    that is killed between a write and the commit, and started again, counts every row once.
    ``maxFilesPerTrigger`` of the stream sets the size of batches.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/table/batch={number}")

    writer = stream.writeStream.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
    writer.outputMode("update").foreachBatch(write).start().awaitTermination()
    return latest(stream.sparkSession, path, stream.schema, keys)


def latest(spark: SparkSession, path: str, schema: StructType, keys: list[str], batch: int | None = None) -> DataFrame:
    """The rows that :func:`run_updates` left last for each key, with the number of the batch that
    changed it in ``batch``; those as of an earlier ``batch`` if one is given. A null key is a key."""
    rows = spark.read.schema(StructType([*schema.fields]).add("batch", "long")).parquet(f"{path}/table")
    if batch is not None:
        rows = rows.where(F.col("batch") <= batch)
    rest = [f.name for f in schema.fields if f.name not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest, "batch"), "batch").alias("last"))
    return last.select(*keys, "last.*")


def append_once(stream: DataFrame, path: str, bad: Column) -> tuple[DataFrame, DataFrame]:
    """Appends what is there to two tables below ``path`` and returns them: good rows, and to the side
    those for which ``bad`` holds; each with the number of its batch in ``batch``.

    A batch is a partition of its own in both and is written whole in place of what it left before. The
    checkpoint gives a batch that was not committed the same rows and number again, so a run that is
    killed between a write and the commit, and started again, leaves every row once. Null of ``bad``
    counts as good. ``maxFilesPerTrigger`` of the stream sets the size of batches.
    """
    spark, fields = stream.sparkSession, stream.schema
    side = F.coalesce(bad, F.lit(False))

    def write(batch: DataFrame, number: int) -> None:
        for name, rows in (("table", batch.where(~side)), ("side", batch.where(side))):
            rows.write.mode("overwrite").parquet(f"{path}/{name}/batch={number}")

    writer = stream.writeStream.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
    writer.foreachBatch(write).start().awaitTermination()
    schema = StructType([*fields.fields]).add("batch", "long")
    table, aside = (spark.read.schema(schema).parquet(f"{path}/{name}") for name in ("table", "side"))
    return table, aside
