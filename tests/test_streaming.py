from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from gaugeflow.session import staging_path
from gaugeflow.streaming import incremental

SCHEMA = "ds_id string, phen_start timestamp, value double, seq long"


def observations(batch):
    return batch.select(
        F.lit("D").alias("kind"), "ds_id", "phen_start", F.lit("decimal").alias("result_kind"),
        F.col("value").cast("decimal(38,12)").alias("result_num"), "seq",
    )


def rows(spark, *items):
    return spark.createDataFrame([(d, dt.datetime(2024, 1, day), float(x), s) for d, day, x, s in items], SCHEMA)


def held(df):
    return sorted((r["ds_id"], r["phen_start"].day, float(r["result_num"])) for r in df.collect())


def test_later_runs_see_what_earlier_ones_stored(spark):
    source, table, checkpoint = (staging_path(spark, n) for n in ("src", "table", "check"))
    rows(spark, ("a", 1, 1, 0), ("a", 2, 2, 1)).write.parquet(source)
    base = observations(rows(spark, ("z", 1, 9, 0))).withColumn("obs_id", F.lit("base"))

    def run():
        incremental.run_incremental(spark, source, SCHEMA, observations, table, checkpoint, base=base)
        return held(incremental.current(spark, table, base))

    assert run() == [("a", 1, 1.0), ("a", 2, 2.0), ("z", 1, 9.0)]
    assert run() == [("a", 1, 1.0), ("a", 2, 2.0), ("z", 1, 9.0)]
    rows(spark, ("a", 2, 5, 0), ("a", 3, 3, 1), ("z", 1, 9, 2)).write.mode("append").parquet(source)
    want = [("a", 1, 1.0), ("a", 2, 5.0), ("a", 3, 3.0), ("z", 1, 9.0)]
    assert run() == want
    incremental.compact(spark, table, base)
    assert held(incremental.current(spark, table)) == want


def log_files(spark, table):
    """The log files a reader opens."""
    opened = incremental._versions(spark, table, None, None).select(F.input_file_name().alias("f")).distinct().collect()
    return {r["f"].split("/batch=")[1][0] for r in opened if "/log/" in r["f"]}


def test_the_log_is_folded_into_the_days_it_touches(spark):
    source, table, checkpoint = (staging_path(spark, n) for n in ("src", "table", "check"))

    def run():
        incremental.run_incremental(spark, source, SCHEMA, observations, table, checkpoint)

    rows(spark, ("a", 1, 1, 0), ("a", 2, 2, 1), ("b", 3, 3, 2)).write.parquet(source)
    run()
    first = incremental.compact(spark, table)
    assert sorted(str(d) for d in first.days) == ["2024-01-01", "2024-01-02", "2024-01-03"] and first.folded == 0
    assert log_files(spark, table) == set()  # folded batches are not read
    rows(spark, ("a", 2, 7, 0), ("c", 9, 4, 1)).write.mode("append").parquet(source)
    run()
    want = [("a", 1, 1.0), ("a", 2, 7.0), ("b", 3, 3.0), ("c", 9, 4.0)]
    assert held(incremental.current(spark, table)) == want
    assert log_files(spark, table) == {"1"}
    second = incremental.compact(spark, table, drop=True)
    kept = {d for d in first.days if first.days[d] == second.days.get(d)}
    assert sorted(str(d) for d in kept) == ["2024-01-01", "2024-01-03"]  # untouched days were not written anew
    assert held(incremental.current(spark, table)) == want
    assert held(spark.read.parquet(f"{table}/days/gen={first.days[dt.date(2024, 1, 1)]}")) == [("a", 1, 1.0), ("b", 3, 3.0)]
    run()  # nothing new
    assert incremental.compact(spark, table).version == second.version
    rows(spark, ("a", 2, 8, 0)).write.mode("append").parquet(source)
    lost = staging_path(spark, "check")  # a new checkpoint reads everything again, as later batches
    incremental.run_incremental(spark, source, SCHEMA, observations, table, lost)
    assert [r for r in held(incremental.current(spark, table)) if r[0] != "a"] == [("b", 3, 3.0), ("c", 9, 4.0)]
    assert incremental.compact(spark, table).folded > second.folded


def test_a_repeated_batch_replaces_its_own_rows(spark):
    """Losing the checkpoint repeats batch 0; the table does not double."""
    source, table = staging_path(spark, "src"), staging_path(spark, "table")
    rows(spark, ("a", 1, 1, 0), ("b", 1, 2, 1)).write.parquet(source)
    for _ in range(2):
        incremental.run_incremental(spark, source, SCHEMA, observations, table, staging_path(spark, "check"))
    assert held(incremental.current(spark, table)) == [("a", 1, 1.0), ("b", 1, 2.0)]
