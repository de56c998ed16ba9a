"""Whole jobs: XML service, copy between stores, validators in order, generated datastreams, lookups by different keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions.props import build_map
from gaugeflow.operators import convert
from gaugeflow.plans.catalog.base import (
    datastreams,
    events_csv,
    incoming,
    num,
    obs,
    query,
    sql_ts,
    stored,
    table,
    ts,
    with_views,
)
from gaugeflow.plans.catalog.sources import _NS, _activity, _swe_docs, _write_text, process_files, sample_files, station_files
from gaugeflow.plans.copy import run_copy
from gaugeflow.plans.ingest import change_set, run_ingest
from gaugeflow.plans.service import run_service
from gaugeflow.sources.features import MEDIA_AIR, REGIME_CONTINUOUS

# Validators in order ---------------------------------------------------------------------------

_ORDER_NOW = "2024-01-25 00:00:00"


@query(
    "ingest_multi",
    with_views(
        f"""SELECT * FROM (WITH sets AS (SELECT ds_id, k, CAST(min(CAST(obs_id AS BIGINT)) AS VARCHAR) AS obs_id FROM stored_hour GROUP BY ds_id, k),
            one AS (SELECT i.*, s.obs_id AS found, i.seq < max(i.seq) OVER (PARTITION BY i.ds_id, i.k) AND s.obs_id IS NOT NULL AS late
                    FROM incoming_hour i LEFT JOIN sets s ON s.ds_id = i.ds_id AND s.k = i.k),
            two AS (SELECT *, CASE WHEN k IS NULL THEN 'reject' WHEN late THEN 'skip'
                                   WHEN NOT phen_start < TIMESTAMP '{_ORDER_NOW}' THEN 'reject' END AS closed,
                           CASE WHEN k IS NULL THEN 'Missing parameter' WHEN late THEN 'Superseded in batch'
                                WHEN NOT phen_start < TIMESTAMP '{_ORDER_NOW}' THEN 'Not before the bound' END AS why FROM one),
            last AS (SELECT * FROM two WHERE closed IS NULL QUALIFY row_number() OVER (PARTITION BY ds_id, phen_start ORDER BY seq DESC) = 1),
            kept AS (SELECT * FROM stored_hour QUALIFY row_number() OVER (PARTITION BY ds_id, phen_start ORDER BY CAST(obs_id AS BIGINT) DESC) = 1)
            SELECT seq, closed AS action, why AS reason, CASE WHEN closed = 'skip' THEN found END AS stored_id FROM two WHERE closed IS NOT NULL
            UNION ALL
            SELECT l.seq, CASE WHEN t.obs_id IS NULL THEN CASE WHEN l.found IS NULL THEN 'insert' ELSE 'update' END
                               WHEN t.result_num = l.result_num THEN 'skip' ELSE 'update' END,
                   CASE WHEN t.obs_id IS NULL THEN CASE WHEN l.found IS NOT NULL THEN 'Same parameters' END
                        WHEN t.result_num = l.result_num THEN 'Same result' ELSE 'Changed result' END,
                   coalesce(t.obs_id, l.found)
            FROM last l LEFT JOIN kept t ON t.ds_id = l.ds_id AND t.phen_start = l.phen_start)"""
    ),
)
def ingest_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records are first matched by a parameter, then bounded in time, then matched by their time."""
    rows = incoming(spark, sf_dir, "hour").withColumn("reason", F.lit(None).cast("string"))
    validators = [
        {"type": "by_parameters", "names": ["k"], "update": True},
        {"type": "before", "now": _ORDER_NOW, "days": 0},
        {"type": "by_time", "update": True},
    ]
    out = change_set(rows, validators, {"observations": stored(spark, sf_dir, "hour")})
    return out.select("seq", "action", "reason", F.when(F.col("action").isin("update", "skip"), F.col("obs_id")).alias("stored_id"))


# Lookups by different keys ---------------------------------------------------------------------

_KEYED = [
    convert.Converter(
        result="l_quantity", phen_time=["t"], keys={"supplier": "{l_suppkey}", "flag": "{l_returnflag}"},
        unit="unit", conversions=[("mg", "ug", "1000")],
    ),
    convert.Converter(result="l_discount", phen_time=["t"], keys={"part": "{l_partkey}"}),
    convert.Converter(result="l_tax", phen_time=["t"], keys={"flag": "{l_returnflag}", "supplier": "{l_linenumber}"}),
    convert.Converter(result="l_extendedprice", phen_time=["t"], ds_id="prices"),
]


def _keyed_datastreams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streams per supplier and flag (not N), with numbers as text, and per part of small size, with numbers."""
    unit = F.struct(F.lit("microgram").alias("name"), F.lit("ug").alias("symbol"), F.lit("").alias("definition")).alias("uom")
    none = F.lit(None)
    flags = F.explode(F.array(F.lit("A"), F.lit("R"))).alias("flag")
    per_supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("supplier"), flags, none.cast("bigint").alias("part"))
    per_part = table(spark, sf_dir, "part").filter("p_size < 30").select(
        none.cast("string").alias("supplier"), none.cast("string").alias("flag"), F.col("p_partkey").cast("bigint").alias("part")
    )
    both = per_supplier.unionByName(per_part)
    name = F.when(F.col("part").isNull(), F.concat_ws("-", F.lit("S"), "supplier", "flag")).otherwise(F.concat(F.lit("P-"), F.col("part").cast("string")))
    return both.select(F.lit("D").alias("kind"), name.alias("ds_id"), "supplier", "flag", "part", unit)


@query(
    "fanout_keys",
    """WITH s AS (SELECT concat('S-', s_suppkey, '-', f) AS ds_id, CAST(s_suppkey AS VARCHAR) AS supplier, f
                  FROM supplier, (VALUES ('A'), ('R')) AS t(f)),
            li AS (SELECT *, l_orderkey * 10 + l_linenumber AS seq FROM lineitem)
       SELECT 0 AS branch, seq, s.ds_id, round(CASE WHEN l_linestatus = 'O' OR s.ds_id IS NULL THEN l_quantity ELSE l_quantity * 1000 END, 2) AS result_num,
              CASE WHEN s.ds_id IS NULL THEN 'No Datastream' END AS reject
       FROM li LEFT JOIN s ON s.supplier = CAST(l_suppkey AS VARCHAR) AND s.f = l_returnflag
       UNION ALL SELECT 1, seq, CASE WHEN p_partkey IS NOT NULL THEN concat('P-', p_partkey) END, round(l_discount, 2),
              CASE WHEN p_partkey IS NULL THEN 'No Datastream' END FROM li LEFT JOIN part ON p_partkey = l_partkey AND p_size < 30
       UNION ALL SELECT 2, seq, s.ds_id, round(l_tax, 2), CASE WHEN s.ds_id IS NULL THEN 'No Datastream' END
       FROM li LEFT JOIN s ON s.supplier = CAST(l_linenumber AS VARCHAR) AND s.f = l_returnflag
       UNION ALL SELECT 3, seq, 'prices', round(l_extendedprice, 2), NULL FROM li""",
)
def fanout_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four converters over one scan: three look up by different columns, one has its stream."""
    li = table(spark, sf_dir, "lineitem")
    cells = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
    rows = li.select(
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("t"),
        *[F.col(c).cast("decimal(18,2)").cast("string").alias(c) for c in cells],
        *[F.col(c).cast("string").alias(c) for c in ("l_suppkey", "l_partkey", "l_linenumber", "l_returnflag")],
        F.when(F.col("l_linestatus") == "O", "ug").otherwise("mg").alias("unit"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
    )
    out = convert.fan_out(rows, _KEYED, _keyed_datastreams(spark, sf_dir))
    return out.select("branch", "seq", "ds_id", num("result_num", 2).alias("result_num"), "reject")


# Generated datastreams -------------------------------------------------------------------------

_GENERATED = {
    "importer": {
        "header": True,
        "parents": {"thing": {"custkey": "{user_id}"}, "sensor": {"type": "{event_type}"}, "property": {"type": "{event_type}"}},
        "converters": [
            {
                "result": "value", "phen_time": ["ts"], "time_format": "yyyy-MM-dd HH:mm:ss.SSSSSS",
                "keys": {"thing": "{user_id}", "property": "{event_type}"},
                "generate": {"name": "{event_type} of {user_id}", "description": "From event {event_id}", "uom_symbol": "unit"},
            },
            {
                "result": "event_id", "phen_time": ["ts"], "time_format": "yyyy-MM-dd HH:mm:ss.SSSSSS",
                "keys": {"thing": "{user_id}", "property": "number"},
                "generate": {"name": "numbers of {user_id}", "description": "{event_type}", "uom_symbol": "1"},
            },
        ],
    },
    "validator": [{"type": "by_time"}],
}


@query(
    "ingest_generated",
    with_views(
        """SELECT * FROM (WITH known AS (SELECT DISTINCT ds_id FROM registered),
            keys AS (SELECT event_id, user_id, event_type, concat(user_id, ':', event_type) AS key, concat(event_type, ' of ', user_id) AS name,
                            concat('From event ', event_id) AS description, value, ts FROM events
                     UNION ALL SELECT event_id, user_id, event_type, concat(user_id, ':number'), concat('numbers of ', user_id), event_type, event_id, ts FROM events),
            made AS (SELECT k.*, c.c_custkey IS NULL AS orphan FROM keys k LEFT JOIN customer c ON c.c_custkey = k.user_id AND c.c_acctbal >= 0
                     WHERE key NOT IN (SELECT ds_id FROM known) QUALIFY row_number() OVER (PARTITION BY key ORDER BY event_id) = 1)
            SELECT 'datastream' AS what, name, CASE WHEN orphan THEN 'Thing not found' END AS reason, description AS detail, 1 AS n FROM made
            UNION ALL
            SELECT CASE WHEN r.orphan THEN 'reject' ELSE 'insert' END, CASE WHEN NOT r.orphan THEN r.key END, CASE WHEN r.orphan THEN 'No Datastream' END, NULL, count(*)
            FROM (SELECT k.key, k.ts, k.event_id, coalesce(m.orphan, false) AS orphan FROM keys k LEFT JOIN made m ON m.key = k.key
                  QUALIFY coalesce(m.orphan, false) OR row_number() OVER (PARTITION BY k.key, k.ts ORDER BY k.event_id DESC) = 1) r
            GROUP BY ALL)"""
    ),
)
def ingest_generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job whose two converters create the streams they miss, below the customer of the user's number."""
    any_event = table(spark, sf_dir, "events").select("event_type").distinct()
    types = any_event.select(F.col("event_type").alias("type"), F.concat(F.lit("S"), "event_type").alias("id"))
    customers = table(spark, sf_dir, "customer").filter("c_acctbal >= 0")
    tables = {
        "datastreams": datastreams(spark, sf_dir),
        "observations": obs(spark, sf_dir).filter(F.lit(False)),
        "things": customers.select(F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("thing_id"), F.col("c_custkey").alias("custkey")),
        "sensors": types.withColumnRenamed("id", "sensor_id"),
        "observed_properties": types.withColumnRenamed("id", "op_id"),
    }
    spec = {**_GENERATED, "importer": {**_GENERATED["importer"], "paths": events_csv(spark, sf_dir)}}
    out = run_ingest(spark, spec, tables, dry_run=True)
    made = out["generated"].select(
        F.lit("datastream").alias("what"), "name", F.col("parent_error").alias("reason"), F.col("description").alias("detail"), F.lit(1).cast("bigint").alias("n")
    )
    streams = out["generated"].filter("ds_id IS NOT NULL").select("ds_id", F.concat_ws(":", "thing", "property").alias("key"))
    streams = streams.unionByName(datastreams(spark, sf_dir).select("ds_id", F.col("ds_id").alias("key")))
    counted = out["changes"].join(streams, "ds_id", "left")
    counted = counted.groupBy(F.col("action").alias("what"), F.col("key").alias("name"), "reason").agg(F.count(F.lit(1)).alias("n"))
    return made.unionByName(counted.withColumn("detail", F.lit(None).cast("string")))


# Copy between stores ---------------------------------------------------------------------------

_COPY = {"start": {"type": "from", "time": "2024-01-03"}, "now": "2024-01-20 00:00:00", "days": 7, "batch_rows": 1000, "validator": [{"type": "by_time"}]}


@query(
    "ingest_copy",
    with_views(
        f"""SELECT * FROM (WITH src AS (SELECT ds_id, phen_start, result_num, seq, CAST(split_part(ds_id, ':', 1) AS BIGINT) AS user FROM incoming_hour),
            ext AS (SELECT ds_id, CASE WHEN min(user) % 3 <> 0 THEN max(phen_start) ELSE TIMESTAMP '2024-01-20' END AS until FROM src GROUP BY ds_id),
            plan AS (SELECT ds_id, until FROM ext JOIN registered USING (ds_id) WHERE until >= TIMESTAMP '2024-01-03'),
            cut AS (SELECT s.*, date_diff('microsecond', TIMESTAMP '2024-01-03', phen_start) // 604800000000 AS slice,
                           date_diff('microsecond', TIMESTAMP '2024-01-03', until) // 604800000000 AS last_slice
                    FROM src s JOIN plan USING (ds_id) WHERE phen_start >= TIMESTAMP '2024-01-03'),
            last AS (SELECT * FROM cut WHERE slice <= last_slice QUALIFY row_number() OVER (PARTITION BY ds_id, phen_start ORDER BY seq DESC) = 1),
            kept AS (SELECT * FROM stored_hour QUALIFY row_number() OVER (PARTITION BY ds_id, phen_start ORDER BY CAST(obs_id AS BIGINT) DESC) = 1)
            SELECT CASE WHEN k.obs_id IS NULL THEN 'insert' WHEN k.result_num = l.result_num THEN 'skip' ELSE 'update' END AS action,
                   l.ds_id AS source_ds_id, concat('t-', l.ds_id) AS ds_id, {sql_ts("l.phen_start")} AS phen_start, l.slice,
                   round(l.result_num, 6) AS result_num, k.obs_id AS stored_id
            FROM last l LEFT JOIN kept k ON k.ds_id = l.ds_id AND k.phen_start = l.phen_start)"""
    ),
)
def ingest_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store with corrected results is copied to one that knows some of its streams and holds an older state."""
    ids = obs(spark, sf_dir, "hour").select("obs_id", "seq")
    source_rows = incoming(spark, sf_dir, "hour").drop("obs_id").join(ids, "seq").drop("seq")
    user = F.split("ds_id", ":")[0].cast("bigint")
    extents = source_rows.groupBy("kind", "ds_id").agg(F.max("phen_start").alias("phen_start"))
    # Every third user's streams state no extent: they are copied up to the slice that holds the present.
    source_streams = extents.select(
        "kind", "ds_id", F.concat(F.lit("Stream "), "ds_id").alias("name"), F.when(user % 3 != 0, F.col("phen_start")).alias("phen_start"),
        F.lit(None).cast("timestamp").alias("phen_end"),
    )
    renamed = F.concat(F.lit("t-"), "ds_id")
    target = {
        "datastreams": datastreams(spark, sf_dir).withColumn("ds_id", renamed),
        "observations": stored(spark, sf_dir, "hour").withColumn("ds_id", renamed),
    }
    out = run_copy(spark, _COPY, {"datastreams": source_streams, "observations": source_rows}, target, dry_run=True)["changes"]
    return out.select(
        "action", "source_ds_id", "ds_id", ts("phen_start").alias("phen_start"), "slice", num("result_num").alias("result_num"),
        F.when(F.col("action") != "insert", F.col("obs_id")).alias("stored_id"),
    )


# XML service -----------------------------------------------------------------------------------

_SERVICE = {
    "owner": "owner",
    "metadata": "link",
    "now": "2024-06-01 00:00:30",
    "start": "2024-01-01 00:00:00",
    "request": "http://service.example/{datastreamLocalId}?time={phenomenonTimeInterval}",
    "validator": [{"type": "interval", "period": "PT1H"}, {"type": "by_time"}],
}
_SAMPLES = 20


def _order_points(spark: SparkSession, sf_dir: str) -> str:
    """Orders as sampling points: station and process by the customer's number, property by the order's status."""
    o = table(spark, sf_dir, "orders")
    customer = F.col("o_custkey").cast("string")
    code = F.when(F.col("o_orderstatus") == "O", "1").when(F.col("o_orderstatus") == "F", "5").otherwise("99")
    xml = F.concat(
        F.lit(f'<aqd:AQD_SamplingPoint {_NS} gml:id="SPO.'), F.col("o_orderkey").cast("string"),
        F.lit('"><ef:inspireId><base:Identifier><base:namespace>AT.</base:namespace></base:Identifier></ef:inspireId>'),
        _activity(F.lit("unknown")),
        F.lit('<ef:observingCapability><ef:ObservingCapability><ef:featureOfInterest xlink:href="http://x.example/SAM.'),
        (F.col("o_custkey") % _SAMPLES).cast("string"), F.lit('"/><ef:observedProperty xlink:href="http://x.example/'), code,
        F.lit('"/><ef:procedure xlink:href="http://x.example/SPP.1.A'), customer,
        F.lit('.7.1.1.1"/></ef:ObservingCapability></ef:observingCapability><ef:broader xlink:href="http://x.example/STA.'),
        customer, F.lit('"/></aqd:AQD_SamplingPoint>'),
    )
    return _write_text(spark, sf_dir, "order_points_xml", o.select(xml.alias("value")))


def _held_entities(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """What the target holds: places and stations of even customers, one in two out of date, and every third order's stream."""
    c = table(spark, sf_dir, "customer").filter("c_acctbal >= 0 AND c_custkey % 2 = 0")
    key = F.col("c_custkey").cast("string")
    local, name = F.concat(F.lit("STA."), key), F.col("c_name")
    common = {"owner": "owner", "countryCode": "AT", "localId": local, "namespace": "AT.", "metadata": "link"}
    thing = {**common, "mediaMonitored": MEDIA_AIR, "measurementRegime": REGIME_CONTINUOUS, "mobile": "false", "beginTime": "2010-01-01"}
    about = F.concat(F.lit("Air quality station "), name)
    locations = c.select(
        F.concat(F.lit("L"), key).alias("location_id"), name.alias("name"), F.concat(F.lit("Location of air quality station "), name).alias("description"),
        build_map(common).alias("properties"), (F.col("c_nationkey") + F.lit(0.654321)).cast("double").alias("lon"),
        (F.col("c_nationkey") + F.lit(40.123456)).cast("double").alias("lat"),
    )
    things = c.select(
        F.concat(F.lit("T"), key).alias("thing_id"), name.alias("name"),
        F.when(F.col("c_custkey") % 4 == 0, about).otherwise("out of date").alias("description"), build_map(thing).alias("properties"),
        F.concat(F.lit("L"), key).alias("location_id"),
    )
    order = F.col("o_orderkey").cast("string")
    streams = table(spark, sf_dir, "orders").filter("o_orderkey % 3 = 0").select(
        F.lit("D").alias("kind"), F.concat(F.lit("D"), order).alias("ds_id"), F.concat(F.lit("SPO."), order).alias("name"), F.lit("").alias("description"),
        F.lit(None).cast("struct<name:string,symbol:string,definition:string>").alias("uom"), F.lit("T").alias("thing_id"), F.lit("S").alias("sensor_id"),
        F.lit("P").alias("op_id"), build_map({"localId": F.concat(F.lit("SPO."), order)}).alias("properties"),
        F.lit(None).cast("timestamp").alias("phen_start"), F.lit(None).cast("timestamp").alias("phen_end"),
    )
    text = "name string, description string, properties map<string,string>"
    return {
        "locations": locations,
        "things": things,
        "datastreams": streams,
        "sensors": spark.createDataFrame([], f"sensor_id string, {text}, encoding string, metadata string"),
        "features": spark.createDataFrame([], f"foi_id string, {text}, lon double, lat double"),
        "observed_properties": spark.createDataFrame([], f"op_id string, {text}, definition string"),
        "observations": _held_observations(spark, sf_dir),
    }


def _held_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first hour of every third order's stream, with another result for odd orders."""
    o = table(spark, sf_dir, "orders").filter("o_orderkey % 3 = 0")
    number = (F.col("o_totalprice").cast("decimal(18,2)") + F.col("o_orderkey") % 2).cast("decimal(38,12)")
    return o.select(
        F.col("o_orderkey").cast("string").alias("obs_id"), F.lit("D").alias("kind"), F.concat(F.lit("D"), F.col("o_orderkey").cast("string")).alias("ds_id"),
        F.col("o_orderdate").alias("phen_start"), (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(1))).alias("phen_end"),
        F.lit("decimal").alias("result_kind"), number.alias("result_num"), number.cast("string").alias("result_text"),
        F.lit(None).cast("array<string>").alias("result_arr"), F.col("o_orderkey").alias("seq"),
    )


_SERVICE_SQL = f"""
WITH st AS (SELECT * FROM customer WHERE c_acctbal >= 0),
sensors AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN '1' WHEN 1 THEN '5' WHEN 2 THEN '8' ELSE '99' END AS code FROM part),
points AS (
  SELECT o.*, concat('SPO.', o_orderkey) AS id, CASE WHEN o_orderstatus NOT IN ('O', 'F') THEN 'ObservedProperty not found'
         WHEN s.p_partkey IS NULL THEN 'Sensor not found' WHEN st.c_custkey IS NULL THEN 'Thing not found' END AS reject, o_orderkey % 3 = 0 AS held
  FROM orders o LEFT JOIN sensors s ON s.p_partkey = o_custkey AND s.code = '1' LEFT JOIN st ON st.c_custkey = o_custkey),
responses AS (
  SELECT p.*, CASE WHEN NOT held AND reject IS NOT NULL THEN 'No Datastream' WHEN f.s_suppkey IS NULL THEN 'FeatureOfInterest not found' END AS failed
  FROM points p LEFT JOIN supplier f ON f.s_suppkey = o_custkey % {_SAMPLES}),
blocks AS (SELECT r.*, i, o_orderdate + to_hours(CAST(i AS BIGINT)) AS t, round(o_totalprice, 2) + i AS v FROM responses r, range(2) AS b(i) WHERE failed IS NULL)
SELECT 'thing' AS what, CASE WHEN c_custkey % 2 = 1 THEN 'insert' WHEN c_custkey % 4 = 0 THEN 'skip' ELSE 'update' END AS action,
       concat('STA.', c_custkey) AS key, concat('Air quality station ', c_name) AS detail, CAST(NULL AS DOUBLE) AS value FROM st
UNION ALL SELECT 'location', CASE WHEN c_custkey % 2 = 1 THEN 'insert' ELSE 'skip' END, concat('STA.', c_custkey), c_name, round(c_nationkey + 0.654321, 6) FROM st
UNION ALL SELECT 'sensor', 'insert', concat('SPP.1.A', p_partkey, '.7.', code), NULL, NULL FROM sensors WHERE code <> '99'
UNION ALL SELECT 'feature', 'insert', concat('SAM.', s_suppkey), NULL, round(s_nationkey + 0.25, 6) FROM supplier
UNION ALL SELECT 'property', 'insert', code, name, NULL FROM (VALUES ('1', 'SO2'), ('5', 'PM10'), ('7', 'O3'), ('8', 'NO2'), ('9', 'NOX as NO2'),
          ('10', 'CO'), ('38', 'NO'), ('71', 'CO2'), ('6001', 'PM2.5')) AS v(code, name)
UNION ALL SELECT 'datastream', CASE WHEN held THEN 'update' ELSE 'insert' END, id,
          concat(CASE o_orderstatus WHEN 'O' THEN 'SO2' ELSE 'PM10' END, ' as ', c_name), NULL FROM points JOIN st ON c_custkey = o_custkey WHERE reject IS NULL
UNION ALL SELECT 'reject', 'sampling point', id, reject, NULL FROM points WHERE reject IS NOT NULL
UNION ALL SELECT 'request', 'D', id, concat('http://service.example/', id, '?time=',
          strftime(CASE WHEN held THEN date_trunc('minute', o_orderdate + INTERVAL 1 HOUR) ELSE TIMESTAMP '2024-01-01' END, '%Y-%m-%dT%H:%M:%SZ'),
          '/2024-06-01T00:00:00Z'), NULL FROM points WHERE held OR reject IS NULL
UNION ALL SELECT 'unit', 'update', id, CASE WHEN o_orderstatus = 'O' THEN 'mg.m-3' ELSE 'ug.m-3' END, NULL FROM responses WHERE failed IS NULL
UNION ALL SELECT 'observation', CASE WHEN i = 1 OR NOT held THEN 'insert' WHEN o_orderkey % 2 = 0 THEN 'skip' ELSE 'update' END, id, {sql_ts("t")}, round(v, 2) FROM blocks
UNION ALL SELECT 'observation', 'reject', id, failed, NULL FROM responses WHERE failed IS NOT NULL
"""


def service_job(spark: SparkSession, sf_dir: str, dry_run: bool = True) -> dict[str, DataFrame]:
    sources = {
        "stations": station_files(spark, sf_dir),
        "processes": process_files(spark, sf_dir),
        "samples": sample_files(spark, sf_dir),
        "points": _order_points(spark, sf_dir),
    }
    feature = F.concat(F.lit('<om:featureOfInterest xlink:href="http://x.example/SAM.'), (F.col("o_custkey") % _SAMPLES).cast("string"), F.lit('"/>'))
    owners = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    answers = _swe_docs(spark, sf_dir, owners).select(
        F.concat(F.lit("SPO."), F.col("o_orderkey").cast("string")).alias("local_id"), F.col("o_orderkey").alias("seq"), F.concat(feature, "xml").alias("xml")
    )
    return run_service(spark, _SERVICE, sources, _held_entities(spark, sf_dir), answers, dry_run)


@query("ingest_service", _SERVICE_SQL)
def ingest_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything one run over a service decides: entities, rejects, requests, units and observations."""
    out = service_job(spark, sf_dir)
    none = F.lit(None)

    def rows(what: str, df: DataFrame, action, key, detail, value=none) -> DataFrame:
        return df.select(F.lit(what).alias("what"), action.alias("action"), key.alias("key"), detail.cast("string").alias("detail"), value.cast("double").alias("value"))

    action, key = F.col("action"), F.col("local_id")
    streams = out["datastreams"].select("ds_id", F.col("local_id").alias("point"))
    seen = out["changes"].filter(action != "reject").join(streams, "ds_id")
    parts = [
        rows("thing", out["things_changes"], action, key, F.col("description")),
        rows("location", out["locations_changes"], action, key, F.col("name"), F.round("lon", 6)),
        rows("sensor", out["sensors_changes"], action, key, none),
        rows("feature", out["features_changes"], action, key, none, F.round("lon", 6)),
        rows("property", out["observed_properties_changes"], action, key, F.col("name")),
        rows("datastream", out["datastreams_changes"], action, key, F.col("description")),
        rows("reject", out["rejects"], F.col("entity"), key, F.col("reason")),
        rows("request", out["requests"], F.col("kind"), key, F.col("url")),
        rows("unit", out["unit_changes"], F.lit("update"), key, F.col("uom.symbol")),
        rows("observation", seen, action, F.col("point"), ts("phen_start"), num("result_num", 2)),
        rows("observation", out["changes"].filter(action == "reject"), action, key, F.col("reason")),
    ]
    all_rows = parts[0]
    for part in parts[1:]:
        all_rows = all_rows.unionByName(part)
    return all_rows
