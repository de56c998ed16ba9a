from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from gaugeflow.functions import times
from gaugeflow.functions import values as v
from gaugeflow.operators import convert
from gaugeflow.sources import documents, features, manifest, records


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def write(folder, name, text, encoding="utf-8"):
    path = os.path.join(folder, name)
    with open(path, "w", encoding=encoding, newline="") as handle:
        handle.write(text)
    return path


def test_quotes_comments_and_unnamed_columns(spark, folder):
    write(folder, "a.csv", '# note\na,b,\n1,"x, ""y""",3\n\n2,,\n')
    rows = records.read_records(spark, folder, header=True, comment="#").orderBy("row_id").collect()
    assert [tuple(r)[:3] for r in rows] == [("1", 'x, "y"', "3"), ("2", "", "")]
    assert rows[0]["src_file"].endswith("a.csv")


def test_quoted_line_breaks_and_tabs(spark, folder):
    write(folder, "a.tsv", 'a\tb\n1\t"x\ny"\n')
    assert records.read_records(spark, folder, tab=True, header=True, multiline=True).first()["b"] == "x\ny"


def test_lines_of_files_that_are_split(spark, folder):
    """Files cut into many splits: lines per file, order over files, skip and limit are exact."""
    for name, n in (("a.csv", 3000), ("b.csv", 50), ("c.csv", 2000)):
        write(folder, name, "v\n" + "".join(f"{name[0]}{i:06d}\n" for i in range(n)))
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[0], "4096")
        spark.conf.set(keys[1], "1")
        raw = records.read_records(spark, folder, header=True)
        assert raw.select("src_file", "src_block").distinct().count() > 5
        numbered = records.number_lines(raw)
        rows = numbered.collect()
        expected = [f"{f}{i:06d}" for f, n in (("a", 3000), ("b", 50), ("c", 2000)) for i in range(n)]
        assert [r["v"] for r in sorted(rows, key=lambda r: r["seq"])] == expected
        assert all(r["src_line"] == int(r["v"][1:]) + 1 for r in rows)
        kept = records.limit_rows(records.skip_rows(numbered, 10), 3015, skipped=10).collect()
        want = [x for x in expected if int(x[1:]) >= 10][:3015]
        assert sorted(r["v"] for r in kept) == sorted(want)
    finally:
        for k, value in before.items():
            spark.conf.set(k, value)


def test_manifest_order_decides_over_path_order(spark, folder):
    a, b = write(folder, "a.csv", "v\n1\n"), write(folder, "b.csv", "v\n2\n")
    raw = records.read_records(spark, folder, header=True)
    order = spark.createDataFrame([("file://" + b, 0), ("file://" + a, 1)], "src_file string, file_ord int")
    assert {r["v"]: r["seq"] for r in records.number_lines(raw, order).collect()} == {"2": 0, "1": 1}


@pytest.mark.parametrize("encoding, found", [("utf-16", "UTF-16LE"), ("utf-16-be", "UTF-16BE"), ("utf-8-sig", "UTF-8"), ("utf-8", "UTF-8")])
def test_charsets(spark, folder, encoding, found):
    text = "naïve,µ\n1,2\n"
    write(folder, "a.csv", ("﻿" if encoding == "utf-16-be" else "") + text, encoding)
    assert records.detect_charset(records.file_heads(spark, folder)).first()["charset"] == found
    rows = records.read_detected(spark, folder, header=True)
    assert records.data_columns(rows) == ["naïve", "µ"] and rows.first()["µ"] == "2"


def test_manifest_combinations(spark):
    sets = [("A", manifest.values_static(["1", "2"])), ("B", manifest.values_static(["x", "y"]))]
    out = manifest.manifest_combinations(spark.range(1), F.lit("A-B"), sets, block=3)
    assert [(r["url"], r["ord"]) for r in out.orderBy("ord").collect()] == [("1-x", 0), ("2-x", 1), ("1-y", 2), ("2-y", 3)]


def test_manifest_expand(spark):
    text = " b c.csv \n\nsub/a.csv;/root.csv\n<a href=http://o.example/z.csv\nreadme.txt"
    listing = spark.createDataFrame([("http://h.example/dir/list.txt", text)], "parent string, text string")
    out = manifest.manifest_expand(listing, "\\n;", r".*\.csv", sort=False).orderBy("pos").collect()
    assert [r["url"] for r in out] == [
        "http://h.example/dir/b%20c.csv", "http://h.example/dir/sub/a.csv", "http://h.example/root.csv", "http://o.example/z.csv",
    ]
    ordered = manifest.manifest_expand(listing, "\\n;", r".*\.csv", sort=True).orderBy("pos").collect()
    assert ordered[0]["url"] == "http://h.example/root.csv"
    removed = manifest.manifest_expand(listing, "\\n;", r".*\.csv", remove=True).collect()
    assert [r["url"] for r in removed] == ["http://h.example/dir/readme.txt"]


SWE = """<r xmlns:swe="urn:s" xmlns:xlink="urn:x"><swe:DataArray><swe:elementCount><swe:Count><swe:value>4</swe:value></swe:Count></swe:elementCount>
<swe:elementType name="Components"><swe:DataRecord><swe:field name="EndTime"><swe:Time/></swe:field><swe:field name="StartTime"><swe:Time/></swe:field>
<swe:field name="Value"><swe:Quantity><swe:uom xlink:href="http://u.example/ug.m-3"/></swe:Quantity></swe:field></swe:DataRecord></swe:elementType>
<swe:encoding><swe:TextEncoding decimalSeparator="," blockSeparator="^]" tokenSeparator="|"/></swe:encoding>
<swe:values>2024-01-01T01:00:00Z|2024-01-01T00:00:00Z|1,5^]2024-01-01T02:00:00Z||2024-01-01T01:00:00Z|2^]2024-01-01T02:00:00Z|3^]bad|2024-01-01T01:00:00Z|2^]2024-01-01T02:00:00Z|2024-01-01T01:00:00Z|x</swe:values>
</swe:DataArray></r>"""


def test_swe(spark):
    df = spark.createDataFrame([("d", SWE)], "id string, xml string")
    rows = documents.explode_swe(df).orderBy("pos").collect()
    assert [None if r["result_num"] is None else float(r["result_num"]) for r in rows[:2]] == [1.5, 2.0]
    assert rows[0]["phen_start"].hour == 0 and rows[0]["phen_end"].hour == 1
    assert [r["reject"] for r in rows] == [None, None, "Wrong number of fields in block", "Could not parse time", "Could not parse number"]
    assert rows[0]["unit_symbol"] == "ug.m-3"
    assert documents.swe_counts(df, ["id"]).first()["element_count"] == 4


def test_feature_of_a_response(spark):
    point = (
        '<om:parameter><om:NamedValue><om:name xlink:href="http://v.example/aq/processparameter/SamplingPoint"/>'
        '<om:value xlink:href="http://x.example/SPO.1"/></om:NamedValue></om:parameter>'
    )
    feature = "<om:featureOfInterest xlink:href='http://x.example/{}'/>"
    df = spark.createDataFrame(
        [(1, "SPO.1", point + feature.format("SAM.1")), (2, "SPO.2", point + feature.format("SAM.9")), (3, "SPO.1", point)],
        "seq long, ds string, xml string",
    )
    foi = spark.createDataFrame([("SAM.1", "f1")], "local_id string, foi_id string")
    out = {r["seq"]: r for r in documents.attach_feature(df, foi, "ds").collect()}
    assert (out[1]["foi_id"], out[1]["response_reject"], out[1]["point_differs"]) == ("f1", None, False)
    assert out[2]["response_reject"] == "FeatureOfInterest not found" and out[2]["point_differs"]
    assert out[3]["response_reject"] == "FeatureOfInterest not found"


def test_json_documents(spark):
    docs = [
        ("g", 0, '{"rows":[{"T":"2024-01-01T00:00:00Z","V":1},{"T":"2024-01-02T00:00:00Z","V":2},{"T":"2024-01-01T00:00:00Z","V":3}]}'),
        ("g", 1, '{"rows":[{"T":"2024-01-01T00:00:00Z","V":10},{"T":"2024-01-03T00:00:00Z","V":30}]}'),
    ]
    df = spark.createDataFrame(docs, "g string, doc_no int, doc string")
    flat = documents.explode_json_observations(df, ["g", "doc_no"], "rows", "T", "V", times.parse_iso, v.parse_number)
    assert flat.count() == 5
    out = documents.zip_json_documents(flat, ["g"], "doc_no", 2).collect()
    assert [[float(x) for x in r["results"]] for r in out] == [[3.0, 10.0]]


def test_column_arrays_in_parts_and_together(spark):
    df = spark.createDataFrame([(i, str(i), "", "" if i % 2 else "7") for i in range(5)], "seq long, a string, b string, c string")
    df = df.withColumn("doc", F.lit("d"))
    out = documents.columns_to_arrays(df, ["doc"], ["a", "b", "c"], [v.parse_decimal], ["s1", "s2"], skip=1, part_size=3).collect()
    got = {(r["ds_id"], r["part"]): [None if x is None else int(x) for x in r["values"]] for r in out}
    assert got == {("s1", 0): [1, 2, 3], ("s1", 1): [4], ("s2", 0): [None, 7, None], ("s2", 1): [7]}
    one = documents.columns_to_arrays(df, ["doc"], ["a", "b", "c"], [v.parse_decimal], ["m"], together=True).collect()
    assert len(one) == 1 and [len(x) for x in one[0]["values"]] == [5, 5] and one[0]["ds_id"] == "m"


STATION = """<aqd:AQD_Station gml:id="S{i}"><ef:inspireId><base:Identifier><base:namespace>AT.x</base:namespace></base:Identifier></ef:inspireId>
<ef:name>N &amp; {i}</ef:name><ef:operationalActivityPeriod><ef:OperationalActivityPeriod><ef:activityTime><gml:TimePeriod><gml:beginPosition>b</gml:beginPosition>
<gml:endPosition indeterminatePosition="{end}"/></gml:TimePeriod></ef:activityTime></ef:OperationalActivityPeriod></ef:operationalActivityPeriod>
<ef:geometry><gml:Point srsName="EPSG:25832"><gml:pos>350779.28125 5815166.0</gml:pos></gml:Point></ef:geometry></aqd:AQD_Station>"""


def test_features_of_one_document(spark, folder):
    """A whole collection in one root element with the namespaces declared there."""
    members = "".join(f"<wfs:member>{STATION.format(i=i, end='unknown' if i < 3 else 'now')}</wfs:member>\n" for i in range(5))
    head = '<?xml version="1.0"?><wfs:FeatureCollection xmlns:wfs="w" xmlns:aqd="a" xmlns:ef="e" xmlns:gml="g" xmlns:base="b">'
    path = write(folder, "a.xml", head + members + "</wfs:FeatureCollection>")
    out = features.read_stations(features.read_features(spark, path, "aqd:AQD_Station", features.STATION)).orderBy("local_id").collect()
    assert [r["local_id"] for r in out] == ["S0", "S1", "S2"]
    assert out[0]["name"] == "N & 0" and (out[0]["lon"], out[0]["lat"]) == (6.803341, 52.466243)
    assert out[0]["properties"]["countryCode"] == "AT" and "endTime" not in out[0]["properties"]


def test_converters_with_different_settings(spark):
    rows = spark.createDataFrame([("2024-01-01T00:00:00Z", "1,5", "n/a", 1), ("x", "2", "3", 2)], "t string, a string, b string, seq long")
    specs = [
        convert.Converter(result="a", phen_time=["t"], decimal="DETECT", ds_id="A"),
        convert.Converter(result="b", phen_time=["t", "PT1H"], missing="n/a", ds_id="B"),
    ]
    out = {(r["ds_id"], r["seq"]): r for r in convert.fan_out(rows, specs).collect()}
    assert float(out["A", 1]["result_num"]) == 1.5 and out["A", 1]["reject"] is None
    assert out["B", 1]["reject"] == "Missing value" and out["A", 2]["reject"] == "Could not parse time"
    assert out["B", 1]["phen_end"].hour == 1 and out["A", 1]["phen_end"] is None
    assert convert.accepted(convert.fan_out(rows, specs)).count() == 1 and convert.rejected(convert.fan_out(rows, specs)).count() == 3


def test_column_beyond_the_record_is_a_missing_result(spark):
    rows = spark.createDataFrame([("2024-01-01T00:00:00Z", 1)], "t string, seq long")
    out = convert.to_observations_by_index(rows, convert.Converter(result=5, phen_time=[0], ds_id="A")).first()
    assert out["reject"] == "No result"


def test_result_time_pattern_is_used_by_name_only(spark):
    rows = spark.createDataFrame([("2024-01-01 00:00:00", "5", 1)], "t string, a string, seq long")
    by_name = convert.Converter(result="a", phen_time=["t"], result_time="t", time_format="yyyy-MM-dd HH:mm:ss", ds_id="A")
    by_index = convert.Converter(result=1, phen_time=[0], result_time=0, time_format="yyyy-MM-dd HH:mm:ss", ds_id="A")
    assert convert.to_observations_by_name(rows, by_name).first()["reject"] is None
    assert convert.to_observations_by_index(rows, by_index).first()["reject"] == "Could not parse time"


def test_custom_python_converter(spark):
    import pandas as pd

    def halves(batches):
        for b in batches:
            yield pd.DataFrame({"seq": b["seq"].repeat(2), "v": (b["v"] / 2).repeat(2)})

    df = spark.createDataFrame([(1, 4.0), (2, 6.0)], "seq long, v double")
    assert sorted(tuple(r) for r in convert.convert_batches(df, halves, "seq long, v double").collect()) == [(1, 2.0), (1, 2.0), (2, 3.0), (2, 3.0)]


def test_swe_without_an_array_is_a_reject(spark):
    df = spark.createDataFrame([("d", "<r/>"), ("e", SWE.replace("2024-01-01T00:00:00Z", "12:00"))], "id string, xml string")
    rows = documents.explode_swe(df).orderBy("id", "pos").collect()
    assert (rows[0]["pos"], rows[0]["reject"]) == (None, "No readable data array")
    assert rows[1]["reject"] == "Could not parse time"


def test_each_file_has_its_own_header(spark, tmp_path):
    for name, text in (("a b.csv", "a,b\n1,2\n"), ("c.csv", "b,a\n20,10\n"), ("d.csv", "a,c\n5,\n"), ("e.csv", "")):
        (tmp_path / name).write_text(text)
    rows = records.read_records(spark, str(tmp_path), header=True)
    assert sorted((r["a"], r["b"], r["c"]) for r in rows.collect()) == [("1", "2", ""), ("10", "20", ""), ("5", "", "")]
    assert rows.select("row_id").distinct().count() == 3
    numbered = records.number_lines(rows)
    assert sorted((r["src_line"], r["seq"]) for r in numbered.collect()) == [(1, 0), (1, 1), (1, 2)]


def test_charsets_of_an_empty_folder(spark, tmp_path):
    assert records.read_detected(spark, str(tmp_path)).count() == 0


def test_cells_by_number_follow_each_file(spark, folder):
    write(folder, "a.csv", "t,a,b\n2024-01-01T00:00:00Z,1,x\n")
    write(folder, "b.csv", "b,a,t\n20,10,2024-01-02T00:00:00Z\n")
    rows = records.read_records(spark, str(folder), header=True)
    by_name = convert.Converter(result="a", phen_time=["t"], ds_id="x")
    assert sorted(float(r["result_num"]) for r in convert.to_observations_by_name(rows, by_name).collect()) == [1.0, 10.0]
    by_number = convert.Converter(result=0, phen_time=[2], ds_id="x")
    out = {r["result_text"]: r["reject"] for r in convert.to_observations_by_index(rows, by_number).collect()}
    assert out["20"] is None and out["2024-01-01T00:00:00Z"] == "Could not parse time"


def test_no_cell_is_lost(spark, folder):
    write(folder, "a.csv", 'seq,src_file\n1,2\n3,4,5\n6\n7,8,"a,""b""",\n')
    rows = records.number_lines(records.strip_nulls(records.read_records(spark, str(folder), header=True)))
    got = [(r["seq_"], r["src_file_"], r["cells"], r["src_line"]) for r in rows.orderBy("seq").collect()]
    assert got == [("1", "2", ["1", "2"], 1), ("3", "4", ["3", "4", "5"], 2), ("6", "", ["6", ""], 3), ("7", "8", ["7", "8", 'a,"b"', ""], 4)]
    assert records.data_columns(rows) == ["seq_", "src_file_"] and len(set(rows.columns)) == len(rows.columns)
    third = convert.to_observations_by_index(rows, convert.Converter(result=2, phen_time=[0], ds_id="x"))
    assert [r["result_text"] for r in third.orderBy("seq").collect()][1] == "5"


@pytest.mark.parametrize("skip, limit", [(0, 0), (2, 0), (0, 7), (3, 5), (1, 1000), (50, 3)])
def test_taken_rows(spark, folder, skip, limit):
    files = {f"{k}.csv": [f"{k}{i}" for i in range(n)] for k, n in (("a", 4), ("b", 1), ("c", 9), ("d", 3))}
    for name, lines in files.items():
        write(folder, name, "h\n" + "\n".join(lines) + "\n")
    rows = records.take_rows(records.read_records(spark, str(folder), header=True), skip, limit)
    kept = [v for lines in files.values() for v in lines[skip:]]
    assert [r["h"] for r in rows.orderBy("seq").collect()] == (kept[:limit] if limit else kept)
    if limit == 7:
        assert {r["src_file"][-5:] for r in rows.select("src_file").distinct().collect()} == {"a.csv", "b.csv", "c.csv"}
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("] csv") <= 1  # the counting scan is done; the records are read once


def test_a_product_of_ten_million_is_cut_into_many_tasks(spark):
    row = spark.createDataFrame([(1, [str(i) for i in range(1000)], [str(i) for i in range(100)], ["x"] * 100)], "id int, a array<string>, b array<string>, c array<string>")
    sets = [("{a}", F.col("a")), ("{b}", F.col("b")), ("{c}", F.col("c"))]
    out = manifest.manifest_combinations(row, F.lit("{a}/{b}/{c}"), sets).drop("a", "b", "c")
    counts = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(counts) == 10_000_000 and len(counts) > 4 and max(counts) < 5_000_000
    assert [r["url"] for r in out.filter("ord IN (0, 1, 1001, 9999999)").orderBy("ord").collect()] == ["0/0/x", "1/0/x", "1/1/x", "999/99/x"]
    empty = manifest.manifest_combinations(row, F.lit("{a}"), [("{a}", F.array().cast("array<string>"))])
    assert empty.count() == 0


def test_unreadable_elements_are_told(spark, folder):
    good = '<a:X xmlns:a="a" xmlns:g="g" g:id="1"><a:shape/></a:X>'
    write(folder, "a.xml", f'<all>{good}<a:X xmlns:a="a" xmlns:g="g" g:id="2"><a:shape></a:X>\n<a:X xmlns:a="a"><a:shape/></a:X></all>')
    write(folder, "b.xml", f'<all>{good.replace("1", "3", 1)}<a:X xmlns:a="a" xmlns:g="g" g:id="4"><a:sha')
    out = features.feature_rejects(spark, str(folder), "a:X", features.SAMPLE)
    got = sorted((r["local_id"] or "", r["reject"], r["src_file"][-5:]) for r in out.collect())
    assert got == [("", "Element without id", "a.xml"), ("2", "Unreadable element", "a.xml"), ("4", "Unreadable element", "b.xml")]
