"""Hot keys: results against brute force, and the plans that keep them even."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gaugeflow.operators import skew
from gaugeflow.operators.skew import keep_first, positions, salted_lookup
from gaugeflow.operators.validate import batch_dedupe, find_duplicates, validate_by_time
from gaugeflow.session import staging_path


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def hot(spark):
    """3000 rows, a third of them with one key."""
    key = F.when(F.col("id") < 1000, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") / 7).cast("int").cast("string")))
    return spark.range(3000).select(key.alias("key"), F.col("id").alias("seq"))


def test_positions_match_brute_force(hot):
    got = {(r["key"], r["seq"]): r["pos"] for r in positions(hot, ["key"], chunk=64).collect()}
    groups: dict[str, list[int]] = {}
    for r in hot.collect():
        groups.setdefault(r["key"], []).append(r["seq"])
    want = {(k, s): i for k, seqs in groups.items() for i, s in enumerate(sorted(seqs), 1)}
    assert got == want


def test_positions_never_sort_a_whole_group(hot):
    assert "windowspecdefinition(key#" in plan(positions(hot, ["key"], chunk=64)) and "_chunk#" in plan(positions(hot, ["key"], chunk=64))


def test_salted_lookup(spark, hot):
    small = hot.groupBy("key").agg(F.max("seq").alias("top"))
    got = sorted((r["seq"], r["top"]) for r in salted_lookup(hot, small, ["key"]).collect())
    assert got == sorted((r["seq"], r["top"]) for r in hot.join(small, "key").select("seq", "top").collect())


def test_salted_lookup_keeps_unmatched_and_null_keys(spark):
    big = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "seq long, key string")
    small = spark.createDataFrame([("a", 10), (None, 20)], "key string, v int")
    plain = {r["seq"]: r["v"] for r in salted_lookup(big, small, ["key"]).collect()}
    safe = {r["seq"]: r["v"] for r in salted_lookup(big, small, ["key"], null_safe=["key"]).collect()}
    assert plain == {1: 10, 2: None, 3: None}
    assert safe == {1: 10, 2: 20, 3: None}


def test_keep_first_prunes_before_the_shuffle(hot):
    df = keep_first(hot, ["key"], [F.col("seq").desc()], 2)
    text = plan(df)
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text
    assert df.filter("key = 'hot'").count() == 2


def test_large_lookup_is_cut_by_adaptive_execution(spark, hot):
    """With broadcasting off, the hot partitions of a salted lookup are split at run time."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        # Identical copies apart from their number; the aggregate on the other side shares the join key.
        big = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("key"), F.col("id").alias("seq"),
            F.sha2(F.col("id").cast("string"), 256).alias("body"),
        )
        latest = big.groupBy("key").agg(F.max("seq").alias("top"))
        joined = salted_lookup(big, latest, ["key"])
        assert joined.filter("top is null").count() == 0
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "skew" in plan(joined).lower()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _observations(spark, rows):
    schema = (
        "kind string, ds_id string, phen_start timestamp, phen_end timestamp, obs_id string, result_kind string, "
        "result_num decimal(38,12), result_text string, result_arr array<string>, seq long"
    )
    return spark.createDataFrame(rows, schema)


def test_time_bound_reaches_the_stored_scan(spark):
    import datetime as dt
    from decimal import Decimal

    rows = [("D", "a", dt.datetime(2024, 1, d), None, str(d), "int", Decimal(d), str(d), None, d) for d in range(1, 11)]
    path = staging_path(spark, "stored")
    _observations(spark, rows).write.parquet(path)
    target = spark.read.parquet(path)
    df = _observations(spark, [r[:4] + (None,) + r[5:] for r in rows[7:]])
    out = validate_by_time(df, target)
    assert out.filter("action = 'skip'").count() == 3
    assert "scalar-subquery" in plan(out) and "PushedFilters: [IsNotNull(phen_start)" in plan(out).replace("IsNotNull(kind), ", "")


def test_many_copies_of_one_observation(spark):
    """A third of all rows are copies of one key: one survivor, all others are found."""
    base = spark.range(900).select(
        F.lit("D").alias("kind"), F.when(F.col("id") < 300, "hot").otherwise(F.col("id").cast("string")).alias("ds_id"),
        F.lit("2024-01-01").cast("timestamp").alias("phen_start"), F.lit(None).cast("timestamp").alias("phen_end"),
        F.col("id").cast("string").alias("obs_id"), F.col("id").alias("seq"),
    )
    copies = find_duplicates(base)
    assert {int(r["obs_id"]) for r in copies.collect()} == set(range(299))
    assert batch_dedupe(base).count() == 601


def _limited(spark, limit, make):
    """The physical plan that ``make`` gives under a limit for broadcasts, before any of it has run."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(limit))
    try:
        return make()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_copies_of_a_lookup_count_in_its_size(spark):
    """A table below the limit for broadcasts whose copies, one per salt, are above it is not broadcast."""
    path = staging_path(spark, "small")
    spark.range(20000).select(F.xxhash64("id").alias("key"), F.col("id").alias("v")).write.parquet(path)
    small, big = spark.read.parquet(path), spark.range(100).select(F.xxhash64("id").alias("key"), F.col("id").alias("seq"))
    size = int(str(small._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))

    def make():
        return salted_lookup(big, small, ["key"])

    assert "BroadcastHashJoin" not in _limited(spark, 2 * size, make)
    assert "BroadcastHashJoin" in _limited(spark, 20 * size, make)
    assert sorted((r["seq"], r["v"]) for r in make().collect()) == [(i, i) for i in range(100)]


def test_measured_lookup_is_not_sized_by_files(spark, monkeypatch):
    """A table that is small in its compressed file and large in rows is shuffled; one small in both is broadcast once."""
    path = staging_path(spark, "text")
    spark.range(20000).select(F.concat(F.lit("x" * 200), "id").alias("value")).coalesce(1).write.option("compression", "gzip").text(path)
    texts = spark.read.text(path).select(F.col("value").alias("key"), F.substring("value", 201, 9).cast("int").alias("v"))
    size = int(str(texts._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    limit = 8 * size
    assert limit < 20000 * 200
    big = spark.range(50).select(F.concat(F.lit("x" * 200), F.col("id") * 1000).alias("key"), F.col("id").alias("seq"))
    big = big.unionByName(spark.createDataFrame([(None, 50)], "key string, seq bigint"))
    assert "BroadcastHashJoin" in _limited(spark, limit, lambda: salted_lookup(big, texts, ["key"]))
    monkeypatch.setattr(skew, "MEASURED", 0)
    found = lambda limit, small: _limited(spark, limit, lambda: skew.measured_lookup(big, small, ["key"], "seq", "texts"))
    assert "BroadcastHashJoin" not in found(limit, texts) and "SortMergeJoin" in found(limit, texts)
    few = texts.filter("v % 4000 = 0")
    assert "BroadcastHashJoin" in found(limit, few) and "BroadcastHashJoin" not in found(-1, few)
    for limit in (0, 1 << 30):
        monkeypatch.setattr(skew, "MEASURED", limit)
        rows = skew.measured_lookup(big, texts, ["key"], "seq", "texts").collect()
        assert sorted((r["seq"], r["v"]) for r in rows if r["seq"] < 50) == [(i, i * 1000 if i < 20 else None) for i in range(50)]
        assert [r["v"] for r in rows if r["seq"] == 50] == [None]
