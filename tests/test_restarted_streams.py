"""Appended rows survive a kill between write and commit, each once."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from strandmill.streaming import metrics


def test_a_killed_run_is_started_again(spark, tmp_path, monkeypatch):
    rows = spark.range(40).select("id", F.when(F.col("id") % 7 != 0, F.col("id") * 1.5).alias("v"))
    for k in range(4):
        rows.where(F.col("id") % 4 == k).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    source = lambda: spark.readStream.schema("id long, v double").option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    real, writes = DataFrameWriter.parquet, []

    def dies(self, path, *a, **b):
        real(self, path, *a, **b)
        writes.append(path)
        if len(writes) == 4:  # the second batch is written whole, and not committed
            raise RuntimeError("killed")

    out = f"file://{tmp_path}/out"
    monkeypatch.setattr(DataFrameWriter, "parquet", dies)
    with pytest.raises(Exception, match="killed"):
        metrics.append_once(source(), out, F.col("v").isNull())
    good, aside = metrics.append_once(source(), out, F.col("v").isNull())
    assert sorted(r.id for r in good.collect()) == [k for k in range(40) if k % 7]
    assert sorted(r.id for r in aside.collect()) == [k for k in range(40) if k % 7 == 0]
    assert sorted({r.batch for r in good.collect()}) == [0, 1, 2, 3] and len(writes) == 10
    good, _ = metrics.append_once(source(), out, F.col("v").isNull())  # nothing new
    assert good.count() == 34 and len(writes) == 10


def test_running_sums_and_peaks_count_every_row_once(spark, tmp_path, monkeypatch):
    value = F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 11 == 0, float("inf")).when(F.col("id") % 13 == 0, float("nan")).otherwise(F.col("id") * 1.5)
    rows = spark.range(40).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("m"), F.col("id") % 3)).alias("m"), value.alias("v"))
    for k in range(4):
        rows.where(F.col("id") % 4 == k).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    source = lambda: spark.readStream.schema("id long, m string, v double").option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    sums = lambda: metrics.running_metrics(source(), "m", "v", F.col("id") + 1)
    real, writes = DataFrameWriter.parquet, []

    def dies(self, path, *a, **b):
        real(self, path, *a, **b)
        writes.append(path)
        if len(writes) == 2:  # the second batch is written whole, and not committed
            raise RuntimeError("killed")

    out = f"file://{tmp_path}/out"
    monkeypatch.setattr(DataFrameWriter, "parquet", dies)
    with pytest.raises(Exception, match="killed"):
        metrics.run_updates(sums(), out, ["m"])
    left = metrics.run_updates(sums(), out, ["m"])
    finite = [r for r in rows.collect() if r.v is not None and r.v < float("inf")]
    want = {m: (sum(r.v * (r.id + 1) for r in finite if r.m == m), sum(r.id + 1 for r in finite if r.m == m), sum(r.m == m for r in finite)) for m in (None, "m1", "m2")}
    assert {r.m: (r.total, r.weight, r.rows) for r in left.collect()} == want
    assert len(writes) == 5 and {r.batch for r in left.collect()} == {3}
    first = metrics.latest(spark, out, sums().schema, ["m"], batch=0).collect()  # a step's snapshot stays correct
    assert sum(r.rows for r in first) in {sum(r.id % 4 == k for r in finite) for k in range(4)} and {r.batch for r in first} == {0}
    assert {r.m: r.rows for r in metrics.run_updates(sums(), out, ["m"]).collect()} == {m: x[2] for m, x in want.items()} and len(writes) == 5
    peaks = metrics.run_updates(metrics.running_peak(source().where("v < 1000"), "m", "v"), f"{out}-peaks", ["m"])
    assert {r.m: r.peak for r in peaks.collect()} == {m: max(r.v for r in finite if r.m == m) for m in want}
