"""What keeps the work of large inputs in proportion: what is shuffled, written and compiled."""

from __future__ import annotations

import datetime as dt
import gzip
import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from gaugeflow.operators import convert, entities, skew
from gaugeflow.operators.skew import SALTS, salted_lookup
from gaugeflow.plans import service
from gaugeflow.plans.catalog import sources
from gaugeflow.session import tune
from gaugeflow.sources import documents, features

COMPILED = 8000  # the JVM interprets methods of more bytes


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def method_sizes(spark, df) -> list[int]:
    """Sizes of the generated methods, one per stage of the plan."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        text = df.select("*")._jdf.queryExecution().explainString(mode)
    finally:
        tune(spark)
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]


@pytest.fixture
def tables(spark):
    """Orders of which two have the same number, one has none, and customers."""
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    day = dt.datetime(2024, 1, 1)
    rows = [(1, 10, "O", 5.5, day, "1"), (2, 11, "F", 7.25, day, "1"), (2, 12, "O", 7.25, day, "1"), (None, 10, "O", 1.0, day, "1")]
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/orders.parquet")
    return folder


def test_texts_are_compressed_and_cut(spark, tables, monkeypatch):
    monkeypatch.setattr(sources, "_PER_TEXT_FILE", 10)
    xml = F.concat(F.lit('<a:AQD_Sample xmlns:a="urn:a" id="SAM.'), F.col("id").cast("string"), F.lit('"></a:AQD_Sample>'))
    path = sources._write_text(spark, tables, "samples", spark.range(95).select(xml.alias("value")).repartition(3), dealt=True)
    files = [os.path.join(path, f) for f in os.listdir(path) if f.startswith("part-")]
    assert files and all(f.endswith(".gz") for f in files)
    assert max(gzip.open(f).read().count(b"\n") for f in files) <= 10
    found = features.read_features(spark, path, "a:AQD_Sample", features.SAMPLE)
    assert sorted(r["_id"] for r in found.collect()) == sorted(f"SAM.{i}" for i in range(95))


def test_documents_are_built_after_the_join(spark, tables):
    """Same rows as a join of the documents, but no document is shuffled."""
    owner = sources.table(spark, tables, "orders").select("o_orderkey", F.col("o_custkey").alias("ds_id"))
    docs = sources._swe_docs(spark, tables, owner)
    late = sources._swe_docs(spark, tables).join(owner, "o_orderkey").select(*docs.columns)
    assert sorted(docs.collect()) == sorted(late.collect()) and docs.count() == 5
    lines = optimized(docs).splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    assert not any("DataArray" in line for line in lines[join:])


def test_documents_are_parsed_once(spark, tables):
    """Filters on parsed values stay above the parser, where the documents were dealt out."""
    owner = sources.table(spark, tables, "orders").select("o_orderkey", F.col("o_custkey").alias("ds_id"))
    docs = sources._swe_docs(spark, tables, owner).withColumnRenamed("o_orderkey", "seq")
    streams = spark.createDataFrame([(10, None), (11, None), (12, None)], "ds_id long, uom struct<name:string,symbol:string,definition:string>")
    filled = entities.backfill_units(streams, documents.explode_swe(docs))
    assert optimized(filled).count("from_xml") == 1
    found = {r["ds_id"]: r for r in filled.collect()}
    assert found[10]["uom"]["symbol"] == "mg.m-3" and sorted(found) == [10, 11, 12] and all(r["unit_set"] for r in found.values())
    good = documents.explode_swe(docs).filter("reject IS NULL")
    assert not any("Filter" in line and "try_cast" in line for line in optimized(good).splitlines())
    assert good.count() == 10


def test_conversion_is_compiled(spark):
    rows = spark.createDataFrame([(1, "2024-01-01T00:00:00", "1.50", "a", "7%"), (2, "x", "0", "b", "99999999999%")], "seq long, t string, v string, k string, w string")
    streams = spark.createDataFrame([("D", "s", "a", ("u", "u", "u"))], "kind string, ds_id string, k string, uom struct<name:string,symbol:string,definition:string>")
    common = {"phen_time": ["t"], "time_format": "yyyy-MM-dd'T'HH:mm:ss", "zone": "+1", "missing": "0"}
    one = convert.to_observations_by_name(rows, convert.Converter(result="v", ds_id="v", **common))
    both = [convert.Converter(result="v", keys={"k": "{k}"}, **common), convert.Converter(result="w", ds_id="w", **common)]
    many = convert.fan_out(rows, both, streams)
    for df in (one, many):
        assert max(method_sizes(spark, df)) < COMPILED
    got = {(r["branch"], r["seq"]): (r["ds_id"], r["result_kind"], r["result_text"], r["reject"]) for r in many.collect()}
    assert got == {
        (0, 1): ("s", "decimal", "1.50", None), (0, 2): (None, "int", "0", "Missing value"),
        (1, 1): ("w", "string", "7%", None), (1, 2): ("w", "long", "99999999999%", "Could not parse time"),
    }


def test_null_keys_are_dealt_out(spark):
    """Rows without a key go to more tasks than there are salts."""
    settings = {k: "-1" for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    settings |= {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        big = spark.range(4000).select(F.col("id").alias("seq"), F.when(F.col("id") == 5, "a").alias("key"))
        small = spark.createDataFrame([("a", 1)], "key string, v int")
        sizes = salted_lookup(big, small, ["key"]).groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(r["count"] for r in sizes) == 4000
    assert len(sizes) > 4 * SALTS and max(r["count"] for r in sizes) < 400


def test_elements_are_cut_once(spark):
    """The pattern that cuts an element runs once, and only where a longer tag comes first."""
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    with open(f"{folder}/a.xml", "w", encoding="utf-8") as f:
        f.write('<?xml?>é\U0001d11e <a:Sx id="0"/><a:S id="1"><n>é\U0001d11e</n></a:S>\n<a:S\nid="2"/></a:S><a:S><n>3</n></a:S> <a:Sy/></a:S><a:S id="4"><n>')
    cut = features._elements(spark, folder, "a:S")
    assert optimized(cut).count("regexp_extract") == 1
    texts = ['<a:S id="1"><n>é\U0001d11e</n></a:S>', '<a:S\nid="2"/></a:S>', "<a:S><n>3</n></a:S>", '<a:S id="4"><n></a:S>']
    assert [r["element"] for r in cut.collect()] == texts
    checked = features.check_features(spark, folder, "a:S", "_id string, n string")
    read = features.read_features(spark, folder, "a:S", "_id string, n string")
    assert checked.select("feature.*").collect() == read.collect()
    assert [(r["local_id"], r["reject"]) for r in checked.collect()][2:] == [(None, "Element without id"), ("4", "Unreadable element")]


def test_points_meet_parents_that_are_large_in_rows_only(spark, tables, monkeypatch):
    """Parents from compressed text are many rows in a small file: they are measured, and shuffled where they are large."""
    xml = F.concat(F.lit('<a:AQD_Sample xmlns:a="urn:a" id="SAM.'), F.col("id").cast("string"), F.lit('"></a:AQD_Sample>'))
    path = sources._write_text(spark, tables, "many-samples", spark.range(5000).select(xml.alias("value")).coalesce(1), dealt=True)
    many = features.read_features(spark, path, "a:AQD_Sample", "_id string").select(F.col("_id").alias("local_id"))
    foi = many.withColumn("foi_id", F.col("local_id"))
    few = spark.createDataFrame([("1", "one"), ("SPP.1.A1.7.1", "two"), ("STA.1", "three")], "local_id string, name string")
    dims = [few.select("local_id", F.col("local_id").alias(c), "name") for c in ("op_id", "sensor_id", "thing_id")]
    existing = foi.select(F.concat(F.lit("P"), F.substring("local_id", 5, 9)).alias("local_id"), F.struct(F.lit("u").alias("name")).alias("uom"))
    href = lambda name, value: f'<{name} a="1" xlink:href="x/{value}"/>'
    texts = []
    for point, (sample, prop, process, station) in {"P1": ("SAM.1", "1", "SPP.1.A1.7.1.1.1", "STA.1"), "P2": ("SAM.5000", "1", "SPP.1.A1.7.1.1.1", "STA.1"), "Q3": ("SAM.3", "2", "x", "y"), "P4": ("SAM.4", "1", "x", "y"), "P5": ("SAM.4", "1", "SPP.1.A1.7.1.1.1", "y")}.items():
        capability = href("featureOfInterest", sample) + href("observedProperty", prop) + href("procedure", process)
        texts.append((f'<p id="{point}"><operationalActivityPeriod><OperationalActivityPeriod><activityTime><TimePeriod><endPosition indeterminatePosition="unknown"/></TimePeriod></activityTime></OperationalActivityPeriod></operationalActivityPeriod><observingCapability><ObservingCapability>{capability}</ObservingCapability></observingCapability>{href("broader", station)}</p>'.replace("xlink:href", "href"),))
    feats = spark.createDataFrame(texts, "x string").select(F.from_xml("x", features.SAMPLING_POINT).alias("f")).select("f.*")
    for measured in (0, 32 << 20):
        monkeypatch.setattr(skew, "MEASURED", measured)
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
        try:
            out = features.read_sampling_points(feats, *dims, foi, existing)
            plan = out._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        assert plan.count("SortMergeJoin") == (0 if measured else 2) and plan.count("BroadcastHashJoin") == (5 if measured else 3)
        got = {r["local_id"]: (r["op_id"], r["sensor_id"], r["thing_id"], r["foi_id"], r["foi_missing"], r["uom"] and r["uom"]["name"], r["reject"], r["description"]) for r in out.collect()}
        assert got == {
            "P1": ("1", "SPP.1.A1.7.1", "STA.1", "SAM.1", False, "u", None, "one as three"),
            "P2": ("1", "SPP.1.A1.7.1", "STA.1", None, True, "u", None, "one as three"),
            "Q3": (None, None, None, "SAM.3", False, None, "ObservedProperty not found", None),
            "P4": ("1", None, None, "SAM.4", False, "u", "Sensor not found", None),
            "P5": ("1", "SPP.1.A1.7.1", None, "SAM.4", False, "u", "Thing not found", None),
        }


def test_service_parses_elements_once(spark, tables):
    """Rejects are read from the table the rows are read from."""
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    with open(f"{folder}/a.xml", "w") as f:
        f.write('<a xmlns:aqd="urn:a"><aqd:AQD_Sample id="1"></aqd:AQD_Sample><aqd:AQD_Sample></aqd:AQD_Sample><aqd:AQD_Sample id="3"><b></aqd:AQD_Sample></a>')
    text = "name string, description string, properties map<string,string>"
    extra = {
        "observed_properties": "definition string", "locations": "lon double, lat double", "things": "location_id string",
        "sensors": "encoding string, metadata string", "features": "lon double, lat double", "datastreams": "kind string",
    }
    held = {name: spark.createDataFrame([], f"{key} string, {text}, {extra[name]}") for name, key in service.IDS.items()}
    found = service.reconcile_network(spark, {"samples": folder}, held).rejects[0]
    assert "from_xml" not in optimized(found)
    got = sorted((r["entity"], r["local_id"] or "", r["reason"]) for r in found.collect())
    assert got == [("samples element", "", "Element without id"), ("samples element", "3", "Unreadable element")]


def test_responses_are_read_in_one_pass(spark, tables):
    """Failed responses take the way of the others, and give the same one row. Order 2 has two responses per owner."""
    owner = sources.table(spark, tables, "orders").select("o_orderkey", "o_custkey")
    head = F.concat(F.lit('<om:featureOfInterest xlink:href="x/'), F.col("o_custkey").cast("string"), F.lit('"/>'))
    docs = sources._swe_docs(spark, tables, owner).select(
        F.col("o_orderkey").cast("string").alias("local_id"), F.col("o_orderkey").alias("seq"), F.concat(head, "xml").alias("xml")
    )
    broken = spark.createDataFrame([("1", 5, '<om:featureOfInterest href="x/10"/>'), ("9", 6, None)], "local_id string, seq long, xml string")
    streams = spark.createDataFrame([("1", "D", "d1"), ("2", "D", "d2")], "local_id string, kind string, ds_id string")
    foi = spark.createDataFrame([("10", "f"), ("11", "g")], "local_id string, foi_id string")
    rows = service.read_responses(docs.unionByName(broken), streams, foi)
    assert len([line for line in optimized(rows).splitlines() if "Union" in line]) == 1
    got = sorted((str(r["ds_id"]), r["local_id"], r["seq"] >> 32, str(r["pos"]), str(r["unit_href"] is None), r["reason"] or "") for r in rows.collect())
    good = [("d1", "1", 1, "0", "False", ""), ("d1", "1", 1, "1", "False", ""), *[("d2", "2", 2, str(i // 2), "False", "") for i in range(4)]]
    failed = [
        ("d1", "1", 5, "None", "False", "No readable data array"), *[("d2", "2", 2, "None", "True", "FeatureOfInterest not found")] * 2,
        ("None", "9", 6, "None", "True", "No Datastream"),
    ]
    assert got == sorted(good + failed)


def test_first_data_array_is_read(spark):
    """The text up to the first end tag, as a pattern that stops there finds it."""
    one = "<s:DataArray><s:values>1</s:values></s:DataArray>"
    texts = [
        one, f"a{one}b{one}", f'<DataArray id="1"></DataArray>{one}', f"{one}<DataArray>", "<s:DataArray>", "", None, "<s:DataArrayX></s:DataArrayX>",
        f"<DataArray>{one}</DataArray>", f'<DataArray\na="1">{one}</DataArray>', f"<XDataArray>{one}</XDataArray>", "</DataArray><DataArray ></DataArray>",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "seq int, xml string")
    parsed = F.from_xml(F.regexp_extract("xml", documents._ARRAY_TO_FIRST, 0), documents._SWE_ARRAY, {"ignoreNamespace": "true"})
    expected = docs.select("seq", parsed.alias("_a")).collect()
    assert documents._data_array(docs, "xml", ["seq"]).collect() == expected
    assert sum(r["_a"] is not None and r["_a"]["values"] == "1" for r in expected) >= 4
