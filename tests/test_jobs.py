"""Jobs: what one run creates the next run knows; validators in order; lookups by different keys; balanced copies."""

from __future__ import annotations

from functools import partial

import pytest
from pyspark.sql import functions as F
from test_changes import actions, frame

from gaugeflow.operators import convert, entities, validate
from gaugeflow.plans import copy
from gaugeflow.plans.catalog import jobs
from gaugeflow.plans.catalog.base import datastreams, obs, stored

SF = "/root/testdata/sf0.001"


def test_a_second_run_of_the_service_has_nothing_to_do(spark):
    first = jobs.service_job(spark, SF, dry_run=False)
    assert first["changes"].filter("action = 'insert'").count() > 0
    tables = {n: first[n].drop("local_id") for n in ("locations", "things", "sensors", "features", "observed_properties", "datastreams")}
    held, jobs._held_entities = jobs._held_entities, lambda *_: {**tables, "observations": first["observations"]}
    try:
        second = jobs.service_job(spark, SF, dry_run=True)
    finally:
        jobs._held_entities = held
    for name in tables:
        assert {r["action"] for r in second[f"{name}_changes"].select("action").distinct().collect()} == {"skip"}, name
    assert second["unit_changes"].count() == 0
    found = {r["action"]: r["count"] for r in second["changes"].groupBy("action").count().collect()}
    assert set(found) == {"skip", "reject"} and found["skip"] == first["changes"].filter("action <> 'reject'").count()


def test_entities_keep_what_an_update_does_not_carry(spark):
    held = spark.createDataFrame([("1", "a", "x", "kept"), ("2", "b", "y", "z")], "thing_id string, name string, description string, note string")
    changes = spark.createDataFrame(
        [("update", "1", "a", "new"), ("skip", "2", "b", "ignored"), ("insert", "3", "c", "n"), ("reject", None, "d", "n")],
        "action string, thing_id string, name string, description string",
    )
    out = sorted(tuple(r) for r in entities.apply_entities(held, changes, "thing_id").collect())
    assert out == [("1", "a", "new", "kept"), ("2", "b", "y", "z"), ("3", "c", "n", None)]


def test_validators_in_order(spark):
    target = frame(spark, ("a", 1, None, "1", 5, {"f": "x"}, 0), ("a", 2, None, "2", 5, {"f": "y"}, 1))
    new = frame(
        spark,
        ("a", 9, None, None, 7, {"f": "x"}, 0),  # an update by its parameter, new by its time
        ("a", 2, None, None, 8, {"f": "x2"}, 1),  # new by its parameter, an update by its time
        ("a", 1, None, None, 5, {"f": "y"}, 2),  # an update of 2 by its parameter, but 1 has it already by time
        ("a", 20, None, None, 1, {"f": "z"}, 3),  # out of bounds
        ("a", 3, None, None, 1, {}, 4),  # without the parameter
        ("a", 4, None, None, 1, {"f": "w"}, 5),
    )
    by_parameters = validate.asking(partial(validate.validate_by_parameters, target=target, names=["f"], update=True))
    by_time = validate.asking(partial(validate.validate_by_time, target=target))
    bound = partial(validate.validate_before, now="2024-01-15 00:00:00", days=0)
    out = validate.validate_in_order(new, [by_parameters, bound, by_time])
    want = [
        ("a", 1, "skip", "1"), ("a", 2, "update", "2"), ("a", 20, "reject", None), ("a", 3, "reject", None), ("a", 4, "insert", None), ("a", 9, "update", "1"),
    ]
    assert actions(out) == sorted(want, key=str)
    reasons = {r["phen_start"].day: r["reason"] for r in out.collect()}
    assert reasons == {1: "Same result", 2: "Changed result", 20: "Not before the bound", 3: "Missing parameter", 4: None, 9: "Same parameters"}
    assert "obs_id" in out.columns and not [c for c in out.columns if c.startswith("_")]


def test_one_validator_in_order_is_that_validator(spark):
    target, new = stored(spark, SF, "hour"), obs(spark, SF, "hour").withColumn("obs_id", F.lit(None).cast("string"))
    one = validate.validate_by_time(new, target)
    chained = validate.validate_in_order(new, [validate.asking(partial(validate.validate_by_time, target=target))])
    columns = ["action", "reason", "obs_id", "ds_id", "phen_start", "seq"]
    assert one.select(columns).exceptAll(chained.select(columns)).count() == 0
    assert chained.count() == one.count()


def test_lookups_of_all_converters_are_one_join(spark):
    unit = "struct<name:string,symbol:string,definition:string>"
    streams = spark.createDataFrame(
        [("D", "s7", "a", 7, None), ("D", "s8", "a", 8, None), ("D", "s9", "b", None, None)], f"kind string, ds_id string, name string, code int, uom {unit}"
    )
    rows = spark.createDataFrame([("2024-01-01T00:00:00Z", "1", "07", "a", 1), ("2024-01-01T00:00:00Z", "2", "x", "b", 2)], "t string, v string, c string, n string, seq long")
    specs = [
        convert.Converter(result="v", phen_time=["t"], keys={"code": "{c}"}),
        convert.Converter(result="v", phen_time=["t"], keys={"name": "{n}"}),
        convert.Converter(result="v", phen_time=["t"], ds_id="given"),
    ]
    out = {(r["branch"], r["seq"]): (r["ds_id"], r["reject"]) for r in convert.fan_out(rows, specs, streams).collect()}
    assert out == {
        (0, 1): ("s7", None), (0, 2): (None, "No Datastream"), (1, 1): (None, "More than one Datastream"), (1, 2): ("s9", None),
        (2, 1): ("given", None), (2, 2): ("given", None),
    }
    plan = convert.fan_out(rows, specs, streams)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
    with pytest.raises(ValueError, match="give keys"):
        convert.fan_out(rows, [convert.Converter(result="v", phen_time=["t"], ds_id="x", unit="c")], streams)


def test_copied_slices_are_balanced_and_a_second_copy_skips(spark):
    source = {"datastreams": datastreams(spark, SF).select("kind", "ds_id", "name", *[F.lit(None).cast("timestamp").alias(c) for c in ("phen_start", "phen_end")])}
    source["observations"] = obs(spark, SF)
    target = {"datastreams": source["datastreams"], "observations": obs(spark, SF).filter(F.lit(False))}
    spec = {"start": {"type": "newer", "default": "2024-01-05"}, "now": "2024-02-15 00:00:00", "days": 3, "batch_rows": 100, "validator": [{"type": "by_time"}]}
    out = copy.run_copy(spark, spec, source, target)
    known = datastreams(spark, SF).select("ds_id")
    expected = obs(spark, SF).join(known, "ds_id", "left_semi").filter("phen_start >= '2024-01-05'").count()
    assert out["observations"].count() == expected > 0
    slices = out["slices"].collect()
    assert sum(r["rows"] for r in slices) == expected
    sizes = {}
    for r in slices:
        sizes[r["batch"]] = sizes.get(r["batch"], 0) + r["rows"]
    assert sorted(sizes) == list(range(len(sizes))) and max(sizes.values()) < 100 + max(r["rows"] for r in slices)
    batches = copy.in_batches(out["changes"].withColumnRenamed("source_ds_id", "source_ds_id"), out["slices"])
    assert batches.filter("batch IS NULL").count() == 0
    again = copy.run_copy(spark, {**spec, "start": {"type": "from", "time": "2024-01-05"}}, source, {**target, "observations": out["observations"]}, dry_run=True)
    assert [r["action"] for r in again["changes"].select("action").distinct().collect()] == ["skip"]
