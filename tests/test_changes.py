"""Change sets: what goes in comes out, applying twice is applying once."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal
from functools import partial

import pytest
from pyspark.sql import functions as F

from gaugeflow.operators import aggregate, apply, days, entities, lookup, validate
from gaugeflow.plans.catalog.base import incoming, obs, stored
from gaugeflow.plans.catalog.streams import flagship
from gaugeflow.session import staging_path

SF = "/root/testdata/sf0.001"
SCHEMA = (
    "kind string, ds_id string, phen_start timestamp, phen_end timestamp, obs_id string, result_kind string, "
    "result_num decimal(38,12), result_text string, result_arr array<string>, parameters map<string,string>, seq long"
)


def frame(spark, *rows):
    """Rows of (ds_id, day, end day or None, obs_id, number, parameters, seq)."""
    return spark.createDataFrame(
        [
            ("D", ds, dt.datetime(2024, 1, d), e and dt.datetime(2024, 1, e), o, "decimal", Decimal(str(n)), str(n), None, p, s)
            for ds, d, e, o, n, p, s in rows
        ],
        SCHEMA,
    )


def actions(df):
    rows = [(r["ds_id"], r["phen_start"].day, r["action"], r["obs_id"] if r["action"] != "insert" else None) for r in df.collect()]
    return sorted(rows, key=str)


def test_interval_and_instant_are_different_times(spark):
    target = frame(spark, ("a", 1, None, "1", 5, {}, 0), ("a", 1, 2, "2", 6, {}, 1))
    new = frame(spark, ("a", 1, None, None, 5, {}, 0), ("a", 1, 2, None, 7, {}, 1), ("a", 1, 3, None, 7, {}, 2))
    assert actions(validate.validate_by_time(new, target)) == [("a", 1, "insert", None), ("a", 1, "skip", "1"), ("a", 1, "update", "2")]


def test_update_can_be_off(spark):
    target = frame(spark, ("a", 1, None, "1", 5, {}, 0))
    new = frame(spark, ("a", 1, None, None, 6, {}, 0))
    assert actions(validate.validate_by_time(new, target, update=False)) == [("a", 1, "skip", "1")]


def test_last_in_batch_wins_and_the_highest_stored_id_survives(spark):
    target = frame(spark, ("a", 1, None, "9", 1, {}, 0), ("a", 1, None, "10", 2, {}, 1))
    new = frame(spark, ("a", 1, None, None, 7, {}, 0), ("a", 1, None, None, 2, {}, 1))
    out = validate.validate_by_time(new, target, report_superseded=True)
    assert actions(out) == [("a", 1, "skip", "10"), ("a", 1, "skip", None)]
    assert {r["reason"] for r in out.collect()} == {"Same result", "Superseded in batch"}
    assert [r["obs_id"] for r in validate.find_duplicates(target).collect()] == ["9"]


def test_every_incoming_row_is_accounted_for(spark):
    new = incoming(spark, SF, "hour")
    marked = validate.validate_multi(new, [partial(validate.validate_after, now="2024-01-10 00:00:00", days=0)])
    out = validate.validate_by_time(marked, stored(spark, SF, "hour"), report_superseded=True)
    counts = {r["action"]: r["count"] for r in out.groupBy("action").count().collect()}
    assert sum(counts.values()) == new.count()
    assert counts["reject"] == marked.filter("reason is not null").count() > 0


def test_applying_twice_changes_nothing(spark):
    target = stored(spark, SF)
    changes = validate.validate_by_time(incoming(spark, SF), target)
    once = apply.apply_changes(target, changes)
    twice = apply.apply_changes(once, changes)
    key = ["obs_id", "ds_id", "phen_start", "result_num"]
    assert once.count() == obs(spark, SF).count()
    assert once.select(key).exceptAll(twice.select(key)).count() == 0
    assert twice.select(key).exceptAll(once.select(key)).count() == 0
    again = validate.validate_by_time(incoming(spark, SF), once)
    assert {r["action"] for r in again.select("action").distinct().collect()} == {"skip"}


def test_parameters(spark):
    target = frame(spark, ("a", 1, None, "2", 5, {"f": "x", "g": "1"}, 0), ("a", 2, None, "1", 5, {"f": "x", "g": "1"}, 1))
    new = frame(
        spark, ("a", 5, None, None, 5, {"f": "x", "g": "1"}, 0), ("a", 6, None, None, 5, {"f": "y", "g": "1"}, 1), ("a", 7, None, None, 5, {"f": "x"}, 2)
    )
    out = {r["phen_start"].day: (r["action"], r["reason"], r["obs_id"]) for r in validate.validate_by_parameters(new, target, ["f", "g"]).collect()}
    assert out[5] == ("skip", "Same parameters", "1")
    assert out[6][:2] == ("insert", None)
    assert out[7] == ("reject", "Missing parameter", None)


def test_interval_period(spark):
    new = frame(spark, ("a", 1, 2, None, 1, {}, 0), ("a", 1, 3, None, 1, {}, 1), ("a", 1, None, None, 1, {}, 2))
    got = [r["reason"] for r in validate.validate_interval(new, "P1D").orderBy("seq").collect()]
    assert got == [None, "Wrong interval", "Not an interval"]
    with pytest.raises(ValueError):
        validate.validate_interval(new, "one day")


def test_strict_lookup_fails_the_job(spark):
    ds = spark.createDataFrame([("M", "m1", "x", None)], "kind string, ds_id string, key string, uom struct<symbol:string>")
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "seq long, k string")
    with pytest.raises(Exception, match="no single datastream"):
        lookup.map_datastream(rows, ds, {"key": F.col("k")}, kind="M", strict=True).collect()
    with pytest.raises(Exception, match="no datastream D nope"):
        lookup.map_fixed(rows, ds, "nope").collect()


def test_suffix_match_against_brute_force(spark):
    things = spark.createDataFrame([(i, f"NS.{i}", "p" if i % 2 else "q") for i in range(60)], "id int, local_id string, prop string")
    codes = spark.createDataFrame([(str(i), "p") for i in range(12)] + [("", "p"), ("NS.7", "p")], "code string, p string")
    got = {(r["code"], r["id"]) for r in lookup.match_suffix(codes, things, "code", "local_id", {"p": "prop"}).collect()}
    want = {(c["code"], t["id"]) for c in codes.collect() for t in things.collect() if c["code"] and t["prop"] == c["p"] and t["local_id"].endswith(c["code"])}
    assert got == want
    hot = codes.unionByName(codes.filter("code = '7'").withColumn("code", F.explode(F.array_repeat("code", 50))))  # one code many times
    found = lookup.match_suffix(hot, things, "code", "local_id", {"p": "prop"}, hot=10)
    assert found.filter("code = '7'").count() == 51 * len([1 for c, _ in want if c == "7"])
    assert {(r["code"], r["id"]) for r in found.collect()} == want and found.columns == ["code", "p", "id", "local_id", "prop"]


def test_reconcile_latest_incoming_wins(spark):
    existing = spark.createDataFrame([("7", "n", "old", {"a": "1"})], "id string, name string, description string, properties map<string,string>")
    new = spark.createDataFrame(
        [("n", "first", {"a": "1"}, 1), ("n", "second", {"b": "2"}, 2), ("m", "x", {"a": "1"}, 3)],
        "name string, description string, properties map<string,string>, seq long",
    )
    out = {r["name"]: r for r in entities.reconcile(new, existing, ["name"], "id", ["description"]).collect()}
    assert out["n"]["action"] == "update" and out["n"]["id"] == "7" and out["n"]["description"] == "second"
    assert out["n"]["changed"] == ["description", "properties"] and out["n"]["properties"] == {"a": "1", "b": "2"}
    assert out["m"]["action"] == "insert" and len(out["m"]["id"]) == 64


def test_data_arrays_list_the_defined_columns(spark):
    rows = frame(spark, ("a", 1, None, None, 1, None, 0), ("a", 2, 3, None, 2, {"k": "v"}, 1), ("b", 1, None, None, 3, None, 2))
    rows = rows.withColumn("foi_id", F.when(F.col("ds_id") == "b", "f1"))
    out = {r["ds_id"]: r for r in apply.to_data_arrays(rows, 10).collect()}
    assert out["a"]["components"] == ["result", "phenomenonTime", "parameters"]
    assert out["b"]["components"] == ["result", "phenomenonTime", "featureOfInterest"]
    assert out["a"]["n"] == 2 and "2024-01-02T00:00:00.000000Z/2024-01-03T00:00:00.000000Z" in out["a"]["data_array"]


def test_observed_counts_come_with_the_write(spark):
    changes = validate.validate_by_time(incoming(spark, SF), stored(spark, SF))
    watched, watch = aggregate.observed(changes, "run")
    watched.write.format("noop").mode("overwrite").save()
    plain = aggregate.run_metrics(changes).first()
    assert watch.get["inserted"] == plain["inserted"] and watch.get["updated"] == plain["updated"]


def test_by_datastream_keeps_order_and_splits_long_streams(spark):
    rows = spark.range(4000).select(
        F.lit("D").alias("kind"), F.when(F.col("id") < 3000, "hot").otherwise("cold").alias("ds_id"), F.col("id").alias("seq")
    )
    laid = aggregate.by_datastream(rows, 4).withColumn("part", F.spark_partition_id()).collect()
    parts: dict[int, list] = {}
    for r in laid:
        parts.setdefault(r["part"], []).append((r["ds_id"], r["seq"]))
    assert all(p == sorted(p) for p in parts.values()) and len(laid) == 4000
    assert sum(any(d == "hot" for d, _ in p) for p in parts.values()) >= 2


def test_full_run_gives_table_errors_and_arrays(spark):
    out = flagship(spark, SF, dry_run=False)
    metrics = out["metrics"].first()
    changes = out["changes"].count()
    assert metrics["read"] == changes and metrics["errors"] > 0 and metrics["inserted"] > 0
    assert out["data_arrays"].agg(F.sum("n")).first()[0] == metrics["inserted"]
    errors = out["errors"].collect()
    assert all(r["lines"] and r["total"] > 0 for r in errors) and len({r["type"] for r in errors}) >= 2
    held = out["observations"]
    assert held.filter(F.col("ds_id").endswith(":click") & (F.col("obs_id").rlike("^[0-9a-f]{64}$"))).count() > 0


def test_snapshot_round_trip(spark):
    from gaugeflow.session import staging_path

    path = apply.write_snapshot(stored(spark, SF).drop("parameters"), staging_path(spark, "snapshot"))
    back = spark.read.parquet(path)
    assert back.count() == stored(spark, SF).count() and "phen_date" in back.columns


def test_an_update_keeps_what_it_does_not_set(spark):
    target = frame(spark, ("a", 1, 2, "1", 5, {"k": "v"}, 0), ("b", 1, None, "2", 6, None, 1), ("c", 1, None, "3", 7, None, 2))
    target = target.withColumns({"foi_id": F.lit("f"), "phen_date": F.to_date("phen_start")})
    changes = frame(spark, ("a", 3, None, "1", 8, None, 0), ("a", 4, None, "1", 9, None, 1), ("b", 1, None, "2", 0, None, 2), ("d", 5, None, "n", 4, None, 3))
    action = F.when(F.col("ds_id") == "b", "delete").when(F.col("ds_id") == "d", "insert").otherwise("update")
    out = {r["obs_id"]: r for r in apply.apply_changes(target, changes.withColumn("action", action)).collect()}
    assert sorted(out) == ["1", "3", "n"]
    one = out["1"]
    assert (one["foi_id"], one["parameters"], float(one["result_num"]), one["phen_start"].day, one["phen_end"]) == ("f", {"k": "v"}, 9.0, 4, None)
    assert one["phen_date"] == dt.date(2024, 1, 4) and out["n"]["phen_date"] == dt.date(2024, 1, 5) and out["n"]["foi_id"] is None
    assert out["3"]["foi_id"] == "f" and float(out["3"]["result_num"]) == 7.0


def test_ids_stay_unique_by_parameters(spark):
    target = frame(spark, ("a", 1, None, "1", 5, {"f": "x"}, 0))
    new = frame(spark, ("a", 5, None, None, 1, {"f": "x"}, 0), ("a", 6, None, None, 2, {"f": "x"}, 1), ("a", 7, None, None, 3, {"f": "y"}, 2), ("a", 7, None, None, 4, {"f": "z"}, 3))
    changes = validate.validate_by_parameters(new, target, ["f"], update=True)
    assert sorted((r["action"], r["reason"] or "") for r in changes.collect()) == [
        ("insert", ""), ("insert", ""), ("skip", "Superseded in batch"), ("update", "Same parameters"),
    ]
    table = apply.apply_changes(target, changes)
    assert table.count() == table.select("obs_id").distinct().count() == 3


def test_stored_days_before_the_batch_are_not_opened(spark, tmp_path):
    target = frame(spark, *[("a", d, None, str(d), d, {}, d) for d in range(1, 11)])
    held = spark.read.parquet(apply.write_snapshot(target, str(tmp_path / "t")))
    out = validate.validate_by_time(frame(spark, ("a", 9, None, None, 0, {}, 0)), held)
    assert actions(out) == [("a", 9, "update", "9")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(phen_date" in plan


def test_upload_batches_hold_json_values(spark):
    rows = frame(spark, ("a", 1, None, None, 1.5, {"k": 'a"b'}, 0), ("b", 1, None, None, 2, None, 1), ("c", 1, None, None, 3, None, 2))
    rows = rows.withColumn("result_arr", F.when(F.col("ds_id") == "b", F.array(F.lit("1"), F.lit(None), F.lit("x"))))
    text = F.col("ds_id") == "c"
    rows = rows.withColumn("result_num", F.when(~text, F.col("result_num"))).withColumn("result_text", F.when(text, 'q"r').otherwise(F.col("result_text")))
    out = {r["ds_id"]: json.loads(r["data_array"]) for r in apply.to_data_arrays(rows, 10).collect()}
    assert out["a"] == [[1.5, "2024-01-01T00:00:00.000000Z", {"k": 'a"b'}]]
    assert out["b"][0][0] == [1, None, "x"] and out["c"][0][0] == 'q"r'


def test_lowest_id_is_numeric(spark):
    df = spark.createDataFrame([("9", "k"), ("10", "k"), ("x", "k")], "ds_id string, name string")
    assert {r["main_id"] for r in entities.with_main_id(df, ["name"]).collect()} == {"9"}


def test_changes_read_and_write_only_the_days_they_touch(spark):
    """The table by day equals the whole table after the same changes, also where an update moves to another day."""
    root = staging_path(spark, "days")
    rows = [("a", d, None, str(d), d, {"f": str(d)}, d) for d in range(1, 11)]
    table = frame(spark, *rows)
    first = days.create_days(table, root)
    schema = table.schema
    changes = frame(spark, ("a", 4, None, "4", 40, {}, 0), ("a", 12, None, "6", 60, {}, 1), ("b", 9, None, "n", 1, {}, 2), ("a", 2, None, "2", 0, {}, 3))
    action = F.when(F.col("obs_id") == "n", "insert").when(F.col("obs_id") == "2", "delete").otherwise("update")
    changes = changes.withColumn("action", action)
    assert {d.day for d in days.touched_days(days.read_days(spark, root, schema, first), changes)} == {2, 4, 6, 9, 12}
    assert {d.day for d in days.touched_days(days.read_days(spark, root, schema, first), changes, same_time=True)} == {2, 4, 9, 12}
    second = days.apply_by_day(spark, root, changes, schema)
    whole = apply.apply_changes(table, changes)
    key = ["obs_id", "ds_id", "phen_start", "result_num"]
    assert days.read_days(spark, root, schema).select(key).exceptAll(whole.select(key)).count() == 0
    assert whole.count() == days.read_days(spark, root, schema).count() == 10
    assert {d.day for d in first.days if second.days.get(d) == first.days[d]} == {1, 3, 5, 7, 8, 10}
    assert {d.day for d in second.days} == {1, 3, 4, 5, 7, 8, 9, 10, 12}  # days 2 and 6 are empty now
    assert days.read_days(spark, root, schema, first).count() == 10  # readers of the earlier version still have it
    days.retire(spark, root, [first])
    assert days.read_days(spark, root, schema).count() == 10 and days.read_pointer(spark, root).version == second.version
    same = days.apply_by_day(spark, root, changes.filter("false"), schema)
    assert same.days == second.days


def test_an_empty_table_by_day(spark):
    root = staging_path(spark, "days")
    table = frame(spark, ("a", 1, None, "1", 1, {}, 0)).filter("false")
    assert days.create_days(table, root).days == {}
    assert days.read_days(spark, root, table.schema).count() == 0
    new = frame(spark, ("a", 1, None, "1", 1, {}, 0)).withColumn("action", F.lit("insert"))
    days.apply_by_day(spark, root, new, table.schema)
    assert days.read_days(spark, root, table.schema).count() == 1
    days.apply_by_day(spark, root, new.withColumn("action", F.lit("delete")), table.schema)
    assert days.read_days(spark, root, table.schema).count() == 0
