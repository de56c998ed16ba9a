"""A job that copies observations between two stores, stream by stream of the same name.

``plan_copy`` matches the streams, gives each its own time range and cuts that into slices of N days; slices are
gathered into batches of about equal numbers of rows, so that a batch is a unit of work whatever the streams look
like. ``run_copy`` reads the planned range once, re-points it and sends it through the validators into a change set.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions.times import bound_ago, now_literal
from gaugeflow.operators import bounds, lookup
from gaugeflow.operators.skew import running_total, salted_lookup
from gaugeflow.plans.ingest import change_set, results
from gaugeflow.session import stage

DAYS = 30
BATCH_ROWS = 1_000_000
DAY = 86_400_000_000


def match_streams(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source streams with the target's stream of the same name: ``source_kind, source_ds_id, kind, ds_id, reason``."""
    names = lookup.match_by_name(
        source.select(F.struct("kind", "ds_id").alias("s"), "name"), target.select(F.struct("kind", "ds_id").alias("t"), "name"), "s", "t"
    )
    reason = F.when(F.col("status") != "ok", F.concat(F.lit("Datastream "), "status"))
    return names.select(
        F.col("s.kind").alias("source_kind"), F.col("s.ds_id").alias("source_ds_id"), F.col("target_id.kind").alias("kind"),
        F.col("target_id.ds_id").alias("ds_id"), reason.alias("reason"),
    )


def _slice(time: Column, first: Column, days: int) -> Column:
    return F.floor((F.unix_micros(time) - F.unix_micros(first)) / F.lit(days * DAY)).cast("bigint")


def plan_copy(
    streams: DataFrame, source: Mapping[str, DataFrame], target: Mapping[str, DataFrame], start: Mapping[str, Any], now, days: int = DAYS
) -> DataFrame:
    """The range of every matched stream: the columns of ``match_streams`` with ``first`` and ``last_slice``.

    ``start`` is ``{"type": "from", "time": ...}``, ``{"type": "ago", "amount": n, "unit": "DAYS"}`` or ``{"type": "newer", "default": ...}``;
    newer means just after what the target holds of the stream. A range ends with the slice that holds the end of
    the source stream's extent, or now where it has none; one that starts behind that has no slice.
    """
    planned = streams.filter(F.col("reason").isNull()).drop("reason")
    if start["type"] == "newer":
        held = bounds.bound_newer(target["datastreams"], target["observations"], start["default"])
        planned = planned.join(held.withColumnRenamed("bound", "first"), ["kind", "ds_id"])
    elif start["type"] == "ago":
        planned = planned.withColumn("first", bound_ago(now, start["amount"], start["unit"]))
    else:
        planned = planned.withColumn("first", F.lit(start["time"]).cast("timestamp"))
    extent = source["datastreams"].select(
        F.col("kind").alias("source_kind"), F.col("ds_id").alias("source_ds_id"), F.coalesce("phen_end", "phen_start", now_literal(now)).alias("until")
    )
    ranged = planned.join(extent, ["source_kind", "source_ds_id"])
    last = F.when(F.col("until") >= F.col("first"), _slice(F.col("until"), F.col("first"), days)).otherwise(F.lit(-1).cast("bigint"))
    return ranged.withColumn("last_slice", last).drop("until")


def select_planned(observations: DataFrame, plan: DataFrame, days: int = DAYS) -> DataFrame:
    """Source observations in the planned ranges, re-pointed, with ``source_ds_id`` and ``slice``."""
    lowest = plan.filter(F.col("last_slice") >= 0).agg(F.min("first")).scalar()
    # The lowest bound of all streams is a scalar that reaches the scan; each stream's own range follows in the join.
    near = observations.filter(F.col("phen_start") >= lowest)
    if "phen_date" in observations.columns:
        near = near.filter(F.col("phen_date") >= F.to_date(lowest))
    near = near.withColumnsRenamed({"kind": "source_kind", "ds_id": "source_ds_id"})
    joined = salted_lookup(near, plan, ["source_kind", "source_ds_id"], "obs_id", how="inner")
    cut = joined.withColumn("slice", _slice(F.col("phen_start"), F.col("first"), days))
    return cut.filter(F.col("slice").between(F.lit(0), F.col("last_slice"))).drop("first", "last_slice", "source_kind", "phen_date")


def balance(copied: DataFrame, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Slices with their row counts and the ``batch`` each is in: about ``batch_rows`` rows, whole slices."""
    slices = copied.groupBy("source_ds_id", "ds_id", "slice").agg(F.count(F.lit(1)).alias("rows"))
    summed = running_total(slices, ["source_ds_id", "ds_id", "slice"], "rows", "before")
    return summed.withColumn("batch", F.floor(F.col("before") / F.lit(batch_rows)).cast("bigint")).drop("before")


def run_copy(
    spark: SparkSession, spec: Mapping[str, Any], source: Mapping[str, DataFrame], target: Mapping[str, DataFrame], dry_run: bool = False
) -> dict[str, DataFrame]:
    """The whole job.

    ``source`` and ``target`` hold ``datastreams`` and ``observations``; ``spec`` has ``start`` (see ``plan_copy``),
    ``now``, optional ``days`` and ``batch_rows``, ``validator`` and ``uploader``. Gives ``streams`` (with ``reason`` where
    none or several match), ``slices``, ``changes``, ``metrics`` and, unless it is a dry run, ``observations`` and
    ``data_arrays``.
    """
    days = spec.get("days", DAYS)
    streams = stage(match_streams(source["datastreams"], target["datastreams"]), "copy-streams")
    plan = stage(plan_copy(streams, source, target, spec["start"], spec["now"], days), "copy-plan")
    copied = stage(select_planned(source["observations"], plan, days), "copy-rows")
    # Later rows of one time win in a batch: by the number the source gave them.
    number = F.col("obs_id").cast("string").try_cast("bigint")
    rows = copied.withColumn("seq", F.coalesce(number, F.xxhash64("obs_id"))).withColumn("reason", F.lit(None).cast("string"))
    changes = change_set(rows, spec.get("validator", []), target)
    out = {"streams": streams, "slices": balance(copied, spec.get("batch_rows", BATCH_ROWS))}
    return out | results(changes, spec, target, dry_run)


def in_batches(rows: DataFrame, slices: DataFrame) -> DataFrame:
    """Rows of a copy with their ``batch``, dealt by it and in source order inside, for writing."""
    keys = ["source_ds_id", "ds_id", "slice"]
    placed = salted_lookup(rows, slices.select(*keys, "batch"), keys, "seq")
    return placed.repartition("batch").sortWithinPartitions("batch", "source_ds_id", "phen_start")
