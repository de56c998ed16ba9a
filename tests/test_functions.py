from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gaugeflow.functions import geo, props, templates, times
from gaugeflow.functions import values as v

UTC = dt.datetime


@pytest.mark.parametrize(
    "cell, kind, number",
    [
        ("5", "int", 5), ("+5", "int", 5), ("-7", "int", -7), ("3000000000", "long", 3000000000), ("1.50", "decimal", 1.5),
        ("1e5", "decimal", 100000), (".5", "decimal", 0.5), ("5.", "decimal", 5), (" 5", "string", None), ("50%", "string", None),
        ("50.5%", "string", None), ("3000000000%", "long", 3000000000), ("abc", "string", None), ("12345678901234567890", "decimal", 12345678901234567890),
    ],
)
def test_parse_result(values, cell, kind, number):
    row = values(v.parse_result(F.col("x")), x=cell)
    assert row["kind"] == kind and row["text"] == cell
    assert row["num"] == (None if number is None else Decimal(str(number)))


@pytest.mark.parametrize("cell", ["", "null", "NULL", "Null"])
def test_parse_result_empty(values, cell):
    assert values(v.parse_result(F.col("x")), x=cell) is None


def test_parse_result_numeric_percent(values):
    assert values(v.parse_result(F.col("x"), "numeric"), x="50%")["num"] == 50
    assert values(v.parse_result(F.col("x"), "numeric"), x="50.5%")["kind"] == "decimal"
    assert values(v.parse_result(F.col("x"), "numeric"), x="x%")["kind"] == "string"


@pytest.mark.parametrize(
    "cell, separator, expected",
    [
        ("1.234,5", "DETECT", "1234.5"), ("1,234.5", "DETECT", None), ("3,25", "DETECT", "3.25"), ("3.25", "DETECT", "3.25"),
        (" 3.25 ", "POINT", "3.25"), ("1.234,5", "COMMA", "1234.5"), ("1,5", "POINT", None), ("x", "DETECT", None), ("", "DETECT", None),
    ],
)
def test_parse_decimal(values, cell, separator, expected):
    assert values(v.decimal_text(F.col("x"), separator), x=cell) == expected


def test_strip_zeros(values):
    assert values(v.strip_zeros(F.col("x")), x="1.500") == "1.5"
    assert values(v.strip_zeros(F.col("x")), x="100.00") == "100"
    assert values(v.strip_zeros(F.col("x")), x="100") == "100"


def test_parse_number_fails_the_job(values):
    with pytest.raises(Exception, match="not a number: abc"):
        values(v.parse_number(F.col("x")), x="abc")


def test_convert_unit(values):
    conversions = [("mg", "ug", "1"), ("mg", "ug", "1000"), ("y", "x", "3")]

    def run(amount, source, target):
        value = F.lit(amount).cast("decimal(38,12)")
        return values(v.convert_unit(value, F.lit(source), F.lit(target), conversions))

    assert run("1.5", "mg", "ug") == Decimal("1500")
    assert run("1500", "ug", "mg") == Decimal("1.5")
    assert run("10", "x", "y") == Decimal("3.333333333333")
    assert run("2", "kg", "kg") == 2
    assert run("2", "kg", "mg") is None


def _result(kind, num=None, text=None, arr=None):
    return F.struct(
        F.lit(kind).cast("string").alias("kind"), F.lit(num).cast("decimal(38,12)").alias("num"), F.lit(text).cast("string").alias("text"),
        (F.array(*[F.lit(a).cast("string") for a in arr]) if arr is not None else F.lit(None).cast("array<string>")).alias("arr"),
    )


def test_result_equals(values):
    def same(a, b):
        return values(v.result_equals(a, b))

    assert same(_result("int", "1", "1"), _result("long", "1", "1"))
    assert same(_result("decimal", "1.0", "1.0"), _result("decimal", "1.00", "1.00"))
    assert not same(_result("int", "1", "1"), _result("string", None, "1"))
    assert same(_result("string", None, "a"), _result("string", None, "a"))
    assert same(_result("array", arr=["1", "x", None]), _result("array", arr=["1.0", "x", None]))
    assert not same(_result("array", arr=["1"]), _result("array", arr=["1", "2"]))
    assert not same(_result("decimal", "0", "0.0000000000001"), _result("decimal", "0", "0.0000000000002"))
    assert same(_result("decimal", "0", "+00.00000000000010"), _result("decimal", "0", ".0000000000001"))
    assert same(_result("decimal", "0", "1e-13"), _result("decimal", "0", "0.0000000000001"))
    assert not same(_result("decimal", "0", "1e-13"), _result("decimal", "0", "2e-13"))
    assert not same(_result("array", arr=["0.0000000000001"]), _result("array", arr=["0.0000000000002"]))
    assert same(_result(None), _result(None)) and not same(_result(None), _result("int", "1", "1"))


def test_epoch_range(values):
    assert values(times.parse_epoch(F.col("x")).cast("bigint"), x="9223372036853") == 9223372036853
    assert values(times.parse_epoch(F.col("x")).cast("bigint"), x="-1000000000000") == -1000000000000
    assert values(times.parse_epoch(F.col("x")).cast("bigint"), x="99999999999999") is None
    assert values(times.parse_epoch(F.col("x")).cast("bigint"), x="9" * 30) is None


def test_camel_case(values):
    assert values(v.camel_case(F.col("x")), x="AIR__quality_STATION") == "airQualityStation"


def test_templates(values):
    columns = ["a", "b", "c"]
    cells = {"a": "N'1", "b": "", "c": 'q"\n\\'}
    assert values(templates.template("{a}-{b|d}-{2}", columns), **cells) == "N'1-d-" + cells["c"]
    assert values(templates.template("x eq '{a}'", columns, templates.URL), **cells) == "x eq 'N''1'"
    assert values(templates.template("{c}", columns, templates.JSON), **cells) == 'q\\"\\n\\\\'
    assert values(templates.template("a", columns), **cells) == "N'1"
    assert values(templates.template("x\ny", columns, strip_newlines=True), **cells) == "xy"
    with pytest.raises(ValueError):
        templates.template("{nope}", columns)


def test_path_templates(values):
    kinds = {"a": "string", "b": "string"}
    assert values(templates.path_template("{a}{b}", kinds), a="x", b="") == ""
    assert values(templates.path_template("{a}{b|q}{c|r}", kinds), a="x", b="") == "xqr"
    assert values(templates.path_template("plain", kinds), a="x", b="") == "plain"


def test_replace_in_is_single_pass(values):
    assert values(templates.replace_in(F.lit("{a}{z}"), {"a": "{b}", "b": "no"})) == "{b}null"


def test_time_with_offset(values):
    parsed = values(times.parse_time(F.col("x"), "yyyy-MM-dd HH:mm:ssXXX"), x="2020-03-29 00:00:00+01:00")
    assert parsed == UTC(2020, 3, 28, 23)


@pytest.mark.parametrize(
    "cell, expected",
    [
        ("20200101120000", UTC(2020, 1, 1, 11)), ("2020-01-01T00:00Z", UTC(2020, 1, 1)), ("1577836800", UTC(2020, 1, 1)),
        ("2020-01-01T00:00:00.5+01:00[Europe/Berlin]", UTC(2019, 12, 31, 23, 0, 0, 500000)), ("12345", UTC(1970, 1, 1, 3, 25, 45)), ("x", None),
    ],
)
def test_time_ladder(values, cell, expected):
    assert values(times.parse_time_ladder(F.col("x"), "yyyyMMddHHmmss", "+1"), x=cell) == expected


def test_time_object(values):
    a, b = F.col("a"), F.col("b")
    cells = {"a": "2020-01-31T00:00:00Z", "b": ""}
    assert tuple(values(times.time_object([a, b]), **cells)) == (UTC(2020, 1, 31), None, None)
    assert values(times.time_object([a, "PT90M"]), **cells)["end"] == UTC(2020, 1, 31, 1, 30)
    assert values(times.time_object(["P1D", a]), **cells)["start"] == UTC(2020, 1, 30)
    late = values(times.time_object([a, b]), a="2020-01-02T00:00:00Z", b="2020-01-01T00:00:00Z")
    assert late["error"] == "Interval starts after its end" and late["start"] is None
    assert values(times.time_object([a, b]), a="2020-01-02T00:00:00Z", b="x")["error"] == "Could not parse time"
    with pytest.raises(ValueError):
        times.time_object(["P1D", "P2D"])


def test_periods():
    assert times.Period.parse("P1Y2M3W4DT5H6M7.5S") == times.Period(1, 2, 3, 4, 5, 6, 7.5)
    for bad in ("P", "PT", "1D", "P1H", ""):
        assert times.Period.parse(bad) is None


def test_month_period_is_calendar_aware(values):
    end = F.lit("2024-01-31").cast("timestamp") + times.Period.parse("P1M").interval()
    assert values(end) == UTC(2024, 2, 29)


def test_coordinates(values):
    def place(*args, **kw):
        return tuple(values(geo.to_wgs84(*args, **kw)))

    assert place(F.lit(350779.28125), F.lit(5815166.0), "EPSG:25832")[:2] == (6.803341, 52.466243)
    assert place(F.lit(350779.28125), F.lit(5815166.0), "25832")[:2] == (6.803341, 52.466243)
    assert place(F.lit(48.145), F.lit(16.51111), "EPSG:4326")[:2] == (16.51111, 48.145)
    assert place(F.lit(16.51111), F.lit(48.145), "EPSG:4326", flip=True)[:2] == (16.51111, 48.145)
    assert place(F.lit(48.145), F.lit(16.51111), None)[:2] == (16.51111, 48.145)
    assert place(F.lit(1.0), F.lit(2.0), "EPSG:3857") == (None, None, "Unsupported coordinate system EPSG:3857")
    assert tuple(values(geo.position_to_wgs84(F.lit("350779.28125 5815166.0"), "urn:ogc:def:crs:EPSG::25832")))[:2] == (6.803341, 52.466243)


def test_southern_utm_mirrors_northern(values):
    north = values(geo.to_wgs84(F.lit(400000.0), F.lit(5000000.0), "32632"))
    south = values(geo.to_wgs84(F.lit(400000.0), F.lit(10000000.0 - 5000000.0), "32732"))
    assert south["lon"] == north["lon"] and south["lat"] == -north["lat"]


def _map(**items):
    return props.build_map({k.replace("__", "/"): x for k, x in items.items()})


def test_merge_properties(values):
    def merged(target, source, depth=5):
        row = values(props.merge_properties(target, source, depth))
        return row["properties"], row["changed"]

    base = _map(a="1", b__x="2")
    assert merged(base, _map(a="1.0", b__x="2")) == ({"a": "1", "b/x": "2"}, False)
    assert merged(base, _map(a="2")) == ({"a": "2", "b/x": "2"}, True)
    assert merged(base, _map(n="")) == ({"a": "1", "b/x": "2"}, False)
    assert merged(base, _map(a="")) == ({"a": "", "b/x": "2"}, True)
    assert merged(base, _map(b="flat")) == ({"a": "1", "b": "flat"}, True)
    assert merged(base, _map(a__y="3")) == ({"a/y": "3", "b/x": "2"}, True)
    assert merged(base, _map(b__x="9", b__new="8"), depth=0) == ({"a": "1", "b/x": "2"}, False)
    assert merged(F.lit(None).cast(props.MAP), _map(a="1")) == ({"a": "1"}, True)


def test_set_path(values):
    assert values(props.set_path(_map(a="1", b__x="2"), "b", "3")) == {"a": "1", "b": "3"}
    assert values(props.set_path(_map(a="1"), "a/b/c", "3")) == {"a/b/c": "3"}


def test_parameters(values):
    assert values(props.parameters(F.lit('{"a": 1'))) == {}
    assert values(props.parameters(F.lit('{"a": 1, "b": "x"}'))) == {"a": "1", "b": "x"}


def test_append_local_id(values):
    ids = F.array(F.lit("a"))
    assert values(props.append_local_id(ids, F.lit("a"))) == ["a"]
    assert values(props.append_local_id(ids, F.lit("b"))) == ["a", "b"]
    assert values(props.append_local_id(F.lit(None).cast("array<string>"), F.lit("b"))) == ["b"]
