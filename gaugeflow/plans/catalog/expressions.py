"""Templates, values, times, coordinates, properties and record conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions import geo, props, templates, times, values
from gaugeflow.model import RESULT_DECIMAL, result_struct
from gaugeflow.operators import convert
from gaugeflow.plans.catalog.base import (
    REGISTERED,
    SQL_INTERVALS,
    datastreams,
    events_csv,
    incoming,
    intervals,
    num,
    obs,
    query,
    sql_ts,
    stored,
    table,
    ts,
    with_views,
)
from gaugeflow.session import spread
from gaugeflow.sources import records

_SECOND = sql_ts("date_trunc('second', ts)")

# Templates ------------------------------------------------------------------------------------


@query(
    "template_plain",
    """SELECT p_partkey, concat(p_brand, ' / ', CASE WHEN p_type = 'SMALL' THEN 'none' ELSE p_type END, ' #', p_partkey) AS filled
       FROM part""",
)
def template_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(
        F.col("p_partkey"), "p_brand", F.when(F.col("p_type") == "SMALL", "").otherwise(F.col("p_type")).alias("p_type")
    )
    text = templates.template("{p_brand} /\n {p_type|none} #{0}", p.columns, strip_newlines=True)
    return p.select("p_partkey", text.alias("filled"))


@query(
    "template_json",
    r"""SELECT doc_id, lang, text AS body FROM (SELECT doc_id, lang, replace(replace(text, chr(13), ''), chr(9), ' ') AS text FROM documents)""",
)
def template_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts put into a JSON template read back unchanged."""
    d = table(spark, sf_dir, "documents")
    text = F.replace(F.replace("text", F.lit("\r"), F.lit("")), F.lit("\t"), F.lit(" "))
    d = d.select("doc_id", "lang", text.alias("text"))
    filled = templates.template('{"lang": "{lang}", "body": "{text}"}', d.columns, templates.JSON)
    parsed = F.from_json(filled, "lang string, body string")
    return d.select("doc_id", parsed["lang"].alias("lang"), parsed["body"].alias("body"))


@query(
    "template_url",
    "SELECT p_partkey, concat('name eq ''', replace(p_name, 'e', ''''''), ''' and brand eq ''', p_brand, '''') AS filled FROM part",
)
def template_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").withColumn("p_name", F.replace("p_name", F.lit("e"), F.lit("'")))
    text = templates.template("name eq '{p_name}' and brand eq '{p_brand}'", p.columns, templates.URL)
    return p.select("p_partkey", text.alias("filled"))


@query(
    "template_path",
    """SELECT event_id, CASE WHEN event_type = 'click' THEN '' ELSE concat(event_type, '=', json_extract_string(props, '$.k'), '?') END AS filled,
              concat('x', CASE WHEN event_type = 'click' THEN 'none' ELSE json_extract_string(props, '$.k') END) AS filled_default
       FROM events""",
)
def template_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.when(F.col("event_type") != "click", F.get_json_object("props", "$.k"))
    e = e.select("event_id", F.struct(F.col("event_type").alias("name"), F.struct(k.alias("a/b")).alias("inner")).alias("rec"))
    kinds = templates.column_types(e)
    return e.select(
        "event_id",
        templates.path_template("{rec/name}={rec/inner/a~1b}?", kinds).alias("filled"),
        templates.path_template("x{rec/inner/a~1b|none}", kinds).alias("filled_default"),
    )


_TRANSLATION = {"click": "Klick", "view": "Ansicht", "error": "Fehler"}


@query(
    "translate_values",
    "SELECT event_id, CASE event_type WHEN 'click' THEN 'Klick' WHEN 'view' THEN 'Ansicht' WHEN 'error' THEN 'Fehler' ELSE event_type END AS label FROM events",
)
def translate_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", templates.translate_values(F.col("event_type"), _TRANSLATION).alias("label"))


@query(
    "replace_in",
    """SELECT event_id, concat('a/', CASE event_type WHEN 'click' THEN 'Klick & mehr' ELSE 'null' END, '/z') AS plain,
              CASE WHEN event_type = 'click' THEN 'a/Klick+%26+mehr/z' END AS encoded FROM events""",
)
def replace_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    text = F.concat(F.lit("a/{"), "event_type", F.lit("}/z"))
    mapping = {"click": "Klick & mehr"}
    return e.select(
        "event_id", templates.replace_in(text, mapping).alias("plain"), templates.replace_in(text, mapping, True).alias("encoded")
    )


@query("after_last_slash", "SELECT page_id, regexp_extract(url, '[^/]*$') AS tail FROM pages")
def after_last_slash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", values.after_last_slash(F.col("url")).alias("tail"))


@query(
    "camel_case",
    """SELECT p_partkey, concat(lower(string_split(p_name, ' ')[1]), upper(string_split(p_name, ' ')[2][1]),
              lower(substr(string_split(p_name, ' ')[2], 2)), p_type[1], lower(substr(p_type, 2))) AS camel FROM part""",
)
def camel_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    snake = F.concat_ws("_", F.replace("p_name", F.lit(" "), F.lit("_")), F.lit(""), "p_type")
    return table(spark, sf_dir, "part").select("p_partkey", values.camel_case(snake).alias("camel"))


@query("first_column", "SELECT p_partkey, trim(p_brand) AS unit FROM part")
def first_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit(" "), "p_brand", F.lit(" ")).alias("value_unit"))
    return p.select("p_partkey", values.first_column(p, ["UNIT", "value_unit", "UnitOfMeasurement"], trim=True).alias("unit"))


# Values ---------------------------------------------------------------------------------------


# The same text runs in Spark and in DuckDB.
_WAY = (
    "CASE event_type WHEN 'click' THEN CASE WHEN value >= 20 THEN 5 ELSE 0 END "
    "WHEN 'view' THEN CASE WHEN value >= 20 THEN 6 ELSE 1 END WHEN 'error' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END"
)


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each value written in one of seven ways, by event type and size."""
    e = table(spark, sf_dir, "events")
    two = F.col("value").cast("decimal(18,2)").cast("string")
    whole = F.floor("value").cast("bigint").cast("string")
    n = F.expr(_WAY)
    cell = (
        F.when(n == 0, whole)
        .when(n == 1, two)
        .when(n == 2, F.concat(whole, F.lit("%")))
        .when(n == 3, F.replace(two, F.lit("."), F.lit(",")))
        .when(n == 4, F.lit(""))
        .when(n == 5, F.lit("NULL"))
        .otherwise(F.concat(F.lit("70000"), F.lpad(whole, 7, "0")))
    )
    return e.select("event_id", "value", cell.alias("cell"))


_TWO = "CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)"
_WHOLE = "CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)"


@query(
    "parse_result",
    f"""SELECT event_id,
          CASE ({_WAY}) WHEN 0 THEN 'int' WHEN 1 THEN 'decimal' WHEN 2 THEN 'string' WHEN 3 THEN 'string' WHEN 6 THEN 'long' END AS kind,
          CASE ({_WAY}) WHEN 0 THEN floor(value) WHEN 1 THEN round(value, 2)
                            WHEN 6 THEN 700000000000 + floor(value) END AS num,
          CASE ({_WAY}) WHEN 2 THEN concat({_WHOLE}, '%') WHEN 3 THEN replace({_TWO}, '.', ',') END AS text
        FROM events""",
)
def parse_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _cells(spark, sf_dir).select("event_id", values.parse_result(F.col("cell")).alias("r"))
    text = F.when(F.col("r.kind") == "string", F.col("r.text"))
    return r.select("event_id", F.col("r.kind").alias("kind"), num("r.num").alias("num"), text.alias("text"))


@query(
    "parse_decimal",
    f"""SELECT event_id, CASE ({_WAY}) WHEN 0 THEN floor(value) WHEN 1 THEN round(value, 2) WHEN 3 THEN round(value, 2)
                            WHEN 6 THEN 700000000000 + floor(value) END AS num,
          CASE ({_WAY}) WHEN 0 THEN {_WHOLE} WHEN 6 THEN CAST(CAST(700000000000 + floor(value) AS BIGINT) AS VARCHAR)
               WHEN 1 THEN rtrim(rtrim({_TWO}, '0'), '.') WHEN 3 THEN rtrim(rtrim({_TWO}, '0'), '.') END AS text
        FROM events""",
)
def parse_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = F.col("cell")
    return _cells(spark, sf_dir).select(
        "event_id", num(values.parse_decimal(cell)).alias("num"),
        values.strip_zeros(values.decimal_text(cell)).alias("text"),
    )


@query(
    "parse_number",
    f"""SELECT event_id, CASE ({_WAY}) WHEN 0 THEN floor(value) WHEN 1 THEN round(value, 2)
                        WHEN 6 THEN 700000000000 + floor(value) END AS num FROM events""",
)
def parse_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(spark, sf_dir).select("event_id", num(values.parse_number(F.col("cell"), "null")).alias("num"))


@query("missing_exact", f"SELECT event_id FROM events WHERE ({_WAY}) <> 5")
def missing_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return values.drop_missing(_cells(spark, sf_dir), "cell", equals="NULL").select("event_id")


@query("missing_regex", f"SELECT event_id FROM events WHERE ({_WAY}) NOT IN (2, 4)")
def missing_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return values.drop_missing(_cells(spark, sf_dir), "cell", regex="[0-9]+%|").select("event_id")


_CONVERSIONS = [("mg/m3", "ug/m3", "1000"), ("g/kg", "mg/m3", "3"), ("mg/m3", "g/kg", "8")]


@query(
    "convert_unit",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, round(CASE WHEN unit = goal THEN result_num
              WHEN unit = 'mg/m3' AND goal = 'ug/m3' THEN result_num * 1000
              WHEN unit = 'ug/m3' AND goal = 'mg/m3' THEN result_num / 1000
              WHEN unit = 'mg/m3' AND goal = 'g/kg' THEN result_num * 8 END, 6) AS value
        FROM (SELECT *, CASE l_linenumber WHEN 1 THEN 'mg/m3' WHEN 2 THEN 'ug/m3' ELSE 'g/kg' END AS goal FROM ({SQL_INTERVALS}))""",
)
def convert_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    goal = F.when(F.col("l_linenumber") == 1, "mg/m3").when(F.col("l_linenumber") == 2, "ug/m3").otherwise("g/kg")
    converted = values.convert_unit(F.col("result_num"), F.col("unit"), goal, _CONVERSIONS)
    return intervals(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", num(converted).alias("value"))


@query(
    "result_equals",
    with_views("SELECT i.ds_id, i.seq, i.result_num = s.result_num AS same FROM incoming i JOIN stored s ON i.seq = s.seq"),
)
def result_equals(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = incoming(spark, sf_dir)
    s = stored(spark, sf_dir).select("seq", result_struct().alias("other"))
    return i.join(s, "seq").select("ds_id", "seq", values.result_equals(result_struct(), F.col("other")).alias("same"))


# Times ----------------------------------------------------------------------------------------


@query("parse_time", f"SELECT event_id, {_SECOND} AS t FROM events")
def parse_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone-less text in +01:00, or text with its offset."""
    e = table(spark, sf_dir, "events")
    local = F.date_format(F.from_utc_timestamp("ts", "+01:00"), "yyyyMMddHHmmss")
    offset = F.concat(F.date_format(F.from_utc_timestamp("ts", "+02:00"), "yyyy-MM-dd HH:mm:ss"), F.lit("+02:00"))
    plain = F.col("event_type").isin("click", "view")
    parsed = F.when(plain, times.parse_time(local, "yyyyMMddHHmmss", "+1")).otherwise(
        times.parse_time(offset, "yyyy-MM-dd HH:mm:ssXXX")
    )
    return e.select("event_id", ts(parsed).alias("t"))


@query(
    "time_ladder",
    f"SELECT event_id, CASE WHEN event_type <> 'error' THEN {_SECOND} END AS t FROM events",
)
def time_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    cell = (
        F.when(F.col("event_type") == "click", F.date_format(F.from_utc_timestamp("ts", "+01:00"), "yyyy/MM/dd HH:mm:ss"))
        .when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(F.col("event_type") == "error", F.lit("yesterday"))
        .otherwise(F.unix_seconds("ts").cast("string"))
    )
    e = e.select("event_id", cell.alias("cell"))
    return e.select("event_id", ts(times.parse_time_ladder(F.col("cell"), "yyyy/MM/dd HH:mm:ss", "+1")).alias("t"))


def _interval_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line item intervals as text; line 7 has no end, line 6 ends before it starts."""
    i = intervals(spark, sf_dir)
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    end = (
        F.when(F.col("l_linenumber") == 7, F.lit(""))
        .when(F.col("l_linenumber") == 6, F.date_format(F.col("phen_start") - F.make_dt_interval(F.lit(1)), iso))
        .otherwise(F.date_format("phen_end", iso))
    )
    return i.select("l_orderkey", "l_linenumber", "l_partkey", F.date_format("phen_start", iso).alias("a"), end.alias("b"))


@query(
    "time_object",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber <> 6 THEN {sql_ts("phen_start")} END AS t0,
               CASE WHEN l_linenumber < 6 THEN {sql_ts("phen_end")} END AS t1,
               CASE WHEN l_linenumber = 6 THEN 'Interval starts after its end' END AS error FROM ({SQL_INTERVALS})""",
)
def time_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = times.time_object([F.col("a"), F.col("b")])
    return _interval_cells(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", made.alias("t")).select(
        "l_orderkey", "l_linenumber", "l_partkey", ts("t.start").alias("t0"), ts("t.end").alias("t1"), F.col("t.error").alias("error")
    )


@query(
    "time_duration",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {sql_ts("phen_start")} AS a0, {sql_ts("phen_start + INTERVAL 90 MINUTE")} AS a1,
               {sql_ts("phen_start - INTERVAL 1 DAY")} AS b0, {sql_ts("phen_start")} AS b1 FROM ({SQL_INTERVALS})""",
)
def time_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    after, before = times.time_object([F.col("a"), "PT1H30M"]), times.time_object(["P1D", F.col("a")])
    return _interval_cells(spark, sf_dir).select(*keys, after.alias("x"), before.alias("y")).select(
        *keys, ts("x.start").alias("a0"), ts("x.end").alias("a1"), ts("y.start").alias("b0"), ts("y.end").alias("b1")
    )


@query("time_start", f"SELECT l_orderkey, l_linenumber, l_partkey, {sql_ts('phen_start')} AS t FROM ({SQL_INTERVALS})")
def time_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", ts(times.time_start()).alias("t"))


@query(
    "time_mid",
    f"SELECT l_orderkey, l_linenumber, l_partkey, {sql_ts('phen_start + to_minutes(30 * l_linenumber)')} AS t FROM ({SQL_INTERVALS})",
)
def time_mid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", ts(times.time_mid()).alias("t"))


@query(
    "timestamp_zone",
    f"SELECT event_id, {sql_ts('ts - INTERVAL 2 HOUR')} AS t0, {sql_ts('ts - INTERVAL 1 HOUR')} AS t1 FROM events",
)
def timestamp_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone-less event times read as +02:00."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    later = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(1))
    return e.select("event_id", times.to_time_object(F.col("ts"), later, "+02:00").alias("t")).select(
        "event_id", ts("t.start").alias("t0"), ts("t.end").alias("t1")
    )


# Coordinates ----------------------------------------------------------------------------------

_N = geo.FLATTENING / (2 - geo.FLATTENING)
_A = geo.SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = [_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240]
_E = 2 * _N**0.5 / (1 + _N)


def _utm_forward(lon: str, lat: str) -> str:
    """SQL of the forward projection to UTM 32N: what the inverse has to undo."""
    t = f"sinh(atanh(sin(radians({lat}))) - {_E} * atanh({_E} * sin(radians({lat}))))"
    xi = f"atan2({t}, cos(radians({lon} - 9)))"
    eta = f"atanh(sin(radians({lon} - 9)) / sqrt(1 + pow({t}, 2)))"
    x = " + ".join([eta, *[f"{a} * cos({2 * j} * {xi}) * sinh({2 * j} * {eta})" for j, a in enumerate(_ALPHA, 1)]])
    y = " + ".join([xi, *[f"{a} * sin({2 * j} * {xi}) * cosh({2 * j} * {eta})" for j, a in enumerate(_ALPHA, 1)]])
    k = geo.UTM_SCALE * _A
    return f"{geo.FALSE_EASTING} + {k} * ({x}) AS x, {k} * ({y}) AS y"


_LON, _LAT = "(6 + (l_partkey % 600) / 100)", "(46 + (l_orderkey % 900) / 100)"


@query(
    "wgs84_utm",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, round(CAST({_LON} AS DOUBLE), 5) AS lon,
               round(CAST({_LAT} AS DOUBLE), 5) AS lat FROM lineitem""",
)
def wgs84_utm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points projected to UTM by the forward formula come back to their degrees."""
    grid = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", f"{_LON} AS lon0", f"{_LAT} AS lat0"
    )
    points = grid.selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", f"inline(array({_as_struct(_utm_forward('lon0', 'lat0'))}))"
    )
    place = geo.to_wgs84(F.col("x"), F.col("y"), "EPSG:25832")
    return points.select("l_orderkey", "l_linenumber", "l_partkey", place.alias("p")).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round("p.lon", 5).alias("lon"), F.round("p.lat", 5).alias("lat")
    )


def _as_struct(two: str) -> str:
    x, y = two.split(" AS x, ")
    return f"struct({x} AS x, {y})"


@query(
    "wgs84_latlon",
    """SELECT c_custkey, CAST(c_nationkey + 0.25 AS DOUBLE) AS lon, CAST(c_nationkey + 40.5 AS DOUBLE) AS lat,
              CASE WHEN c_mktsegment = 'BUILDING' THEN 'Unsupported coordinate system EPSG:3857' END AS error
       FROM (SELECT *, c_mktsegment = 'BUILDING' AS other FROM customer) WHERE NOT other
       UNION ALL SELECT c_custkey, NULL, NULL, 'Unsupported coordinate system EPSG:3857' FROM customer WHERE c_mktsegment = 'BUILDING'""",
)
def wgs84_latlon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geographic input in both axis orders, without CRS, and in an unsupported one."""
    c = table(spark, sf_dir, "customer")
    lat, lon = F.col("c_nationkey") + 40.5, F.col("c_nationkey") + 0.25
    segment = F.col("c_mktsegment")
    place = (
        F.when(segment == "BUILDING", geo.to_wgs84(lat, lon, "EPSG:3857"))
        .when(segment == "MACHINERY", geo.to_wgs84(lat, lon, None))
        .when(segment == "FURNITURE", geo.to_wgs84(lon, lat, "4326", flip=True))
        .otherwise(geo.to_wgs84(lat, lon, "http://www.opengis.net/def/crs/EPSG/0/4326"))
    )
    return c.select("c_custkey", place.alias("p")).select("c_custkey", "p.lon", "p.lat", "p.error")


# Properties -----------------------------------------------------------------------------------


@query(
    "parameters_json",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k') END AS k,
              CASE WHEN event_type <> 'error' THEN event_type END AS type, CASE WHEN event_type = 'error' THEN 0 ELSE 2 END AS n
       FROM events""",
)
def parameters_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Templates that fill to broken JSON give an empty map."""
    e = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k"))
    good = templates.template('{"k": "{k}", "type": "{event_type}"}', e.columns, templates.JSON)
    broken = F.concat(good, F.lit("}{"))
    text = F.when(F.col("event_type") == "error", F.replace(broken, F.lit(":"), F.lit(""))).otherwise(good)
    e = e.select("event_id", props.parameters(text).alias("p"))
    return e.select(
        "event_id", F.element_at("p", F.lit("k")).alias("k"), F.element_at("p", F.lit("type")).alias("type"), F.size("p").alias("n")
    )


@query(
    "json_walk",
    "SELECT event_id, json_extract_string(props, '$.k') AS k, event_type AS second, CAST(NULL AS VARCHAR) AS third FROM events",
)
def json_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    doc = F.concat(F.lit('{"a/x": {"list": ['), "props", F.lit(', "'), "event_type", F.lit('"]}}'))
    return e.select("event_id", doc.alias("doc")).select(
        "event_id",
        props.json_walk(F.col("doc"), "a~1x/list/0/k").alias("k"),
        props.json_walk(F.col("doc"), "a~1x/list/1").alias("second"),
        props.json_walk(F.col("doc"), "a~1x/list/2").alias("third"),
    )


@query(
    "property_paths",
    """SELECT event_id, json_extract_string(props, '$.k') AS k, event_type AS inner, CAST(NULL AS VARCHAR) AS party,
              concat('k=', json_extract_string(props, '$.k'), ';other=1;party/name=', event_type) AS everything FROM events""",
)
def property_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    p = props.build_map({"k": F.get_json_object("props", "$.k"), "party": "old", "none": F.lit(None).cast("string")})
    p = props.set_path(props.set_path(p, "party/name", F.col("event_type")), "other", "1")
    e = e.select("event_id", p.alias("p"))
    text = F.array_join(F.transform(props.entries(F.col("p")), lambda x: F.concat_ws("=", x["key"], x["value"])), ";")
    return e.select(
        "event_id", props.get_path(F.col("p"), "k").alias("k"), props.get_path(F.col("p"), "party/name").alias("inner"),
        props.get_path(F.col("p"), "party").alias("party"), text.alias("everything"),
    )


# Record conversion ----------------------------------------------------------------------------


def _observations(df: DataFrame) -> DataFrame:
    return df.select(
        "ds_id", ts("phen_start").alias("phen_start"), "result_kind", num("result_num").alias("result_num"),
        F.element_at("parameters", F.lit("kind")).alias("param"), "reject",
    )


_KNOWN = f"(SELECT DISTINCT concat(user_id, ':', event_type) AS ds_id FROM events WHERE ts < TIMESTAMP '{REGISTERED}')"
_CONVERTED = f"""
  SELECT k.ds_id, {sql_ts("ts")} AS phen_start,
         'decimal' AS result_kind, round(value, 2) AS result_num,
         event_type AS param, CASE WHEN k.ds_id IS NULL THEN 'No Datastream' END AS reject
  FROM events e LEFT JOIN {_KNOWN} k ON k.ds_id = concat(e.user_id, ':', e.event_type)"""


@query("convert_by_index", _CONVERTED)
def convert_by_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by column number; values are written with a decimal point, so all are decimals."""
    rows = records.read_records(spark, events_csv(spark, sf_dir), header=True).withColumnRenamed("row_id", "seq")
    spec = convert.Converter(
        result=4, phen_time=[1], time_format="yyyy-MM-dd HH:mm:ss.SSSSSS", missing="-1",
        parameters='{"kind": "{3}"}', keys={"thing": "{2}", "property": "{event_type}"},
    )
    return _observations(convert.to_observations_by_index(rows.drop("src_block"), spec, datastreams(spark, sf_dir)))


@query("convert_by_name", _CONVERTED)
def convert_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = records.read_records(spark, events_csv(spark, sf_dir), header=True).withColumnRenamed("row_id", "seq")
    spec = convert.Converter(
        result="{value}", phen_time=["ts"], time_format="yyyy-MM-dd HH:mm:ss.SSSSSS", missing="-1|none", decimal="DETECT",
        parameters='{"kind": "{event_type}"}', keys={"ds_id": "{user_id}:{event_type}"},
    )
    return _observations(convert.to_observations_by_name(rows.drop("src_block"), spec, datastreams(spark, sf_dir)))


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _measure_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spread(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")
    return li.select(
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("data"),
        *[F.col(m).cast("decimal(18,2)").cast("string").alias(m) for m in _MEASURES],
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
    )


def _measure_spec(measure: str) -> convert.Converter:
    return convert.Converter(
        result=measure, phen_time=["data"], time_format="yyyy-MM-dd'T'HH:mm:ss", zone="+1", ds_id=measure, missing="0.00"
    )


_FANOUT_SQL = " UNION ALL ".join(
    f"SELECT '{m}' AS ds_id, l_orderkey * 10 + l_linenumber AS seq, {sql_ts('l_shipdate - INTERVAL 1 HOUR')} AS phen_start, "
    f"round({m}, 2) AS result_num, CASE WHEN round({m}, 2) = 0 THEN 'Missing value' END AS reject FROM lineitem"
    for m in _MEASURES
)


def _measures_out(df: DataFrame) -> DataFrame:
    return df.select("ds_id", "seq", ts("phen_start").alias("phen_start"), num("result_num").alias("result_num"), "reject")


@query("converter_fanout", _FANOUT_SQL)
def converter_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four converters over one scan."""
    return _measures_out(convert.fan_out(_measure_records(spark, sf_dir), [_measure_spec(m) for m in _MEASURES]))


@query("union_converters", _FANOUT_SQL)
def union_converters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _measure_records(spark, sf_dir)
    return _measures_out(
        convert.union_observations([convert.to_observations_by_name(rows, _measure_spec(m)) for m in _MEASURES])
    )


@query(
    "unpivot_years",
    f"""SELECT o_orderstatus AS unit, o_orderpriority AS region, {sql_ts("make_timestamp(y, 1, 1, 0, 0, 0)")} AS t0,
               {sql_ts("make_timestamp(y + 1, 1, 1, 0, 0, 0)")} AS t1, CAST(n AS DOUBLE) AS result_num
        FROM (SELECT o_orderstatus, o_orderpriority, CAST(year(o_orderdate) AS BIGINT) AS y, count(*) AS n FROM orders GROUP BY ALL)
        WHERE y IS NOT NULL""",
)
def unpivot_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders counted into a wide table by year; absent combinations are ``:``."""
    o = table(spark, sf_dir, "orders")
    # One column per year that occurs: the years are the table's header.
    found = o.select(F.year("o_orderdate").alias("y")).filter("y IS NOT NULL").distinct().collect()
    years = sorted(str(r["y"]) for r in found)
    counts = [F.count_if(F.year("o_orderdate") == int(y)).alias(y) for y in years]
    wide = o.groupBy("o_orderstatus", "o_orderpriority").agg(*counts)
    wide = wide.select(
        F.concat("o_orderstatus", F.lit(", "), "o_orderpriority").alias("key"),
        *[F.when(F.col(f"`{y}`") > 0, F.col(f"`{y}`").cast("string")).otherwise(":").alias(f"{y} ") for y in years],
    )
    out = convert.unpivot_years(wide, [f"{y} " for y in years], ["unit", "region"])
    return out.select("unit", "region", ts("phen_start").alias("t0"), ts("phen_end").alias("t1"), num("result_num").alias("result_num"))


@query(
    "custom_converter",
    """SELECT event_id AS seq, 'value' AS ds_id, round(value, 6) AS result_num FROM events UNION ALL
       SELECT event_id, 'k', CAST(json_extract_string(props, '$.k') AS DOUBLE) FROM events WHERE event_type = 'purchase'""",
)
def custom_converter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's converter: one or two observations per record."""

    def convert_event(df: DataFrame, second: str) -> DataFrame:
        value = F.struct(F.lit("value").alias("ds_id"), F.col("value").cast(RESULT_DECIMAL).alias("result_num"))
        k = F.struct(F.lit("k").alias("ds_id"), F.get_json_object("props", "$.k").cast(RESULT_DECIMAL).alias("result_num"))
        found = F.when(F.col("event_type") == second, F.array(value, k)).otherwise(F.array(value))
        return df.select(F.col("event_id").alias("seq"), F.explode(found).alias("o")).select("seq", "o.*")

    out = convert.convert_with(table(spark, sf_dir, "events"), convert_event, second="purchase")
    return out.select("seq", "ds_id", num("result_num").alias("result_num"))


def _double(batches):
    for batch in batches:
        yield batch[["seq", "ds_id"]].assign(result_num=batch["result_num"].astype(float) * 2)


@query("custom_converter_batches", with_views("SELECT seq, ds_id, round(result_num * 2, 6) AS result_num FROM obs"))
def custom_converter_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's converter in Python over Arrow batches."""
    rows = obs(spark, sf_dir).select("seq", "ds_id", F.col("result_num").cast("double").alias("result_num"))
    out = convert.convert_batches(rows, _double, "seq bigint, ds_id string, result_num double")
    return out.withColumn("result_num", num("result_num"))
