"""Datastream lookups, generation, name matches and copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.operators import apply, lookup
from gaugeflow.plans.catalog.base import datastreams, num, obs, query, sql_ts, table, ts, with_views

_KNOWN = "known AS (SELECT DISTINCT ds_id, split_part(ds_id, ':', 1) AS thing, split_part(ds_id, ':', 2) AS property FROM registered)"


def _with_known(body: str) -> str:
    return with_views("").rstrip() + f", {_KNOWN} " + body


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("seq"), F.col("user_id").cast("string").alias("user"), "event_type")


@query(
    "map_datastream",
    _with_known(
        """SELECT e.event_id AS seq, k.ds_id, CASE WHEN k.ds_id IS NULL THEN 'not_found' ELSE 'ok' END AS ds_status
           FROM events e LEFT JOIN known k ON k.thing = CAST(e.user_id AS VARCHAR) AND k.property = e.event_type"""
    ),
)
def map_datastream(spark: SparkSession, sf_dir: str) -> DataFrame:
    on = {"thing": F.col("user"), "property": F.col("event_type")}
    out = lookup.map_datastream(_records(spark, sf_dir), datastreams(spark, sf_dir), on)
    return out.select("seq", "ds_id", "ds_status")


@query(
    "map_ambiguous",
    _with_known(
        """, k AS (SELECT thing, count(*) AS n, min(ds_id) AS ds_id FROM known GROUP BY thing)
           SELECT e.event_id AS seq, CASE WHEN n = 1 THEN k.ds_id END AS ds_id,
                  CASE WHEN n IS NULL THEN 'not_found' WHEN n > 1 THEN 'ambiguous' ELSE 'ok' END AS ds_status
           FROM events e LEFT JOIN k ON k.thing = CAST(e.user_id AS VARCHAR)""".lstrip()
    ),
)
def map_ambiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup by thing alone finds several datastreams for most records."""
    out = lookup.map_datastream(_records(spark, sf_dir), datastreams(spark, sf_dir), {"thing": F.col("user")})
    return out.select("seq", "ds_id", "ds_status")


@query("map_fixed", "SELECT event_id AS seq, 'D' AS kind, 'purchase' AS ds_id FROM events")
def map_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = datastreams(spark, sf_dir).select("kind", F.col("property").alias("ds_id"))
    return lookup.map_fixed(_records(spark, sf_dir), dim, "purchase").select("seq", "kind", "ds_id")


@query("map_multi_strict", "SELECT event_id AS seq, concat('multi-', event_type) AS ds_id FROM events")
def map_multi_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-datastreams by event type; a missing one would end the job."""
    multi = table(spark, sf_dir, "events").select("event_type").distinct().select(
        F.lit("M").alias("kind"), F.concat(F.lit("multi-"), "event_type").alias("ds_id"), "event_type",
        F.lit(None).cast("struct<name:string,symbol:string,definition:string>").alias("uom"),
    )
    out = lookup.map_datastream(_records(spark, sf_dir), multi, {"event_type": F.col("event_type")}, kind="M", strict=True)
    return out.select("seq", "ds_id")


@query(
    "unmatched_keys",
    _with_known(
        """SELECT CAST(e.user_id AS VARCHAR) AS thing, e.event_type AS property, count(*) AS records FROM events e
           WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.ds_id = concat(e.user_id, ':', e.event_type)) GROUP BY 1, 2"""
    ),
)
def unmatched_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    on = {"thing": F.col("user"), "property": F.col("event_type")}
    return lookup.unmatched_keys(_records(spark, sf_dir), datastreams(spark, sf_dir), on)


def _parent_tables(spark: SparkSession, sf_dir: str):
    """Things from customers, sensors from part brands, properties from order priorities."""
    things = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") >= 0).select(
        F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("thing_id"), F.col("c_custkey").alias("custkey")
    )
    sensors = table(spark, sf_dir, "part").select("p_brand").distinct().select(
        F.concat(F.lit("S"), "p_brand").alias("sensor_id"), F.col("p_brand").alias("brand")
    )
    # Statuses with several names: one status gives more than one property.
    ops = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority").distinct().filter(
        (F.col("o_orderstatus") == "F") | (F.col("o_orderpriority") == "1-URGENT")
    ).select(F.concat(F.lit("P"), "o_orderstatus", "o_orderpriority").alias("op_id"), F.col("o_orderstatus").alias("status"))
    return things, sensors, ops


_PARENTS_SQL = """
  SELECT l_orderkey, l_linenumber, l_partkey, t.thing_id, concat('S', p_brand) AS sensor_id,
         CASE WHEN o_orderstatus <> 'F' THEN concat('P', o_orderstatus, '1-URGENT') END AS op_id,
         CASE WHEN t.thing_id IS NULL THEN 'Thing not found'
              WHEN o_orderstatus = 'F' THEN 'More than one ObservedProperty' END AS parent_error
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  LEFT JOIN (SELECT concat('T', c_custkey) AS thing_id, c_custkey FROM customer WHERE c_acctbal >= 0) t ON c_custkey = o_custkey"""


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, o, p = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "part"))
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(p, F.col("l_partkey") == F.col("p_partkey"))
    return j.withColumn("seq", F.col("l_orderkey") * 10 + F.col("l_linenumber"))


@query("resolve_parents", _PARENTS_SQL)
def resolve_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    things, sensors, ops = _parent_tables(spark, sf_dir)
    out = lookup.resolve_parents(
        _order_lines(spark, sf_dir), things, sensors, ops, {"custkey": F.col("o_custkey")}, {"brand": F.col("p_brand")},
        {"status": F.col("o_orderstatus")},
    )
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "thing_id", "sensor_id", "op_id", "parent_error")


@query(
    "generate_datastreams",
    _with_known(
        """, first AS (SELECT user_id, event_type, min(event_id) AS seq FROM events GROUP BY 1, 2)
           SELECT concat(f.event_type, ' of ', f.user_id) AS name, concat('From event ', f.seq) AS description,
                  'unit' AS symbol, f.event_type AS prop,
                  CASE WHEN c.c_custkey IS NOT NULL THEN concat('T', c.c_custkey) END AS thing_id,
                  CASE WHEN c.c_custkey IS NULL THEN 'Thing not found' END AS parent_error, c.c_custkey IS NOT NULL AS made
           FROM first f LEFT JOIN customer c ON c.c_custkey = f.user_id AND c.c_acctbal >= 0
           WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.ds_id = concat(f.user_id, ':', f.event_type))""".lstrip()
    ),
)
def generate_datastreams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streams for users and event types that have none; the thing is the customer of that number."""
    things, _, _ = _parent_tables(spark, sf_dir)
    e = table(spark, sf_dir, "events")
    rows = e.select(F.col("event_id").alias("seq"), F.col("user_id").cast("string").alias("user"), "event_type")
    any_event = rows.select("event_type").distinct()
    sensors = any_event.select(F.concat(F.lit("S"), "event_type").alias("sensor_id"), F.col("event_type").alias("type"))
    ops = any_event.select(F.concat(F.lit("P"), "event_type").alias("op_id"), F.col("event_type").alias("type"))

    def parents(df: DataFrame) -> DataFrame:
        return lookup.resolve_parents(
            df, things, sensors, ops, {"custkey": F.col("user").cast("bigint")}, {"type": F.col("event_type")},
            {"type": F.col("event_type")},
        )

    texts = {
        "name": "{event_type} of\n {user}", "description": "From event {seq}", "properties": '{"prop": "{event_type}"}',
        "uom_name": "unit", "uom_symbol": "unit", "uom_definition": "",
    }
    made = lookup.generate_datastreams(
        rows, datastreams(spark, sf_dir), {"thing": F.col("user"), "property": F.col("event_type")}, texts, parents
    )
    return made.select(
        "name", "description", F.col("uom.symbol").alias("symbol"), F.element_at("properties", F.lit("prop")).alias("prop"),
        "thing_id", "parent_error", F.col("ds_id").isNotNull().alias("made"),
    )


@query(
    "match_by_name",
    """WITH tgt AS (SELECT p_name AS name, count(*) AS n, min(p_partkey) AS id FROM part WHERE p_size < 3 GROUP BY p_name)
       SELECT p_partkey AS src, p_name AS name, CASE WHEN n = 1 THEN tgt.id END AS target_id,
              CASE WHEN n IS NULL THEN 'not_found' WHEN n > 1 THEN 'ambiguous' ELSE 'ok' END AS status
       FROM part LEFT JOIN tgt ON tgt.name = p_name""",
)
def match_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("src"), F.col("p_name").alias("name"), "p_size")
    tgt = p.filter(F.col("p_size") < 3).select(F.col("src").alias("id"), "name")
    return lookup.match_by_name(p.select("src", "name"), tgt, "src", "id")


@query("entity_index", "SELECT p_name, max(p_partkey) AS p_partkey, arg_max(p_brand, p_partkey) AS p_brand FROM part GROUP BY p_name")
def entity_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.entity_index(table(spark, sf_dir, "part"), "p_name", "p_partkey").select("p_name", "p_partkey", "p_brand")


@query(
    "suffix_join",
    """SELECT o.o_orderkey, c.c_custkey FROM (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS code, o_custkey FROM orders) o
       JOIN customer c ON ends_with(concat('AT-', c.c_custkey), o.code)""",
)
def suffix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders find the customers whose local id ends with the order's customer number."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("code"), F.lit("AT").alias("country"))
    things = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("AT-"), F.col("c_custkey").cast("string")).alias("local_id"), F.lit("AT").alias("c_country")
    )
    return lookup.match_suffix(o, things, "code", "local_id", {"country": "c_country"}).select("o_orderkey", "c_custkey")


@query(
    "copy_by_name",
    with_views(
        f"""SELECT o.obs_id, o.ds_id AS source_ds_id, CASE WHEN s.ds_id IS NOT NULL THEN concat('t-', s.ds_id) END AS ds_id,
                   {sql_ts("o.phen_start")} AS phen_start, CAST(date_diff('day', DATE '2024-01-03', CAST(o.phen_start AS DATE)) // 7 AS BIGINT) AS slice,
                   round(o.result_num, 6) AS result_num,
                   CASE WHEN s.ds_id IS NULL THEN 'reject' ELSE 'copy' END AS action
            FROM obs o LEFT JOIN registered s ON s.ds_id = o.ds_id
            WHERE o.phen_start >= TIMESTAMP '2024-01-03' AND o.phen_start < TIMESTAMP '2024-01-29'"""
    ),
)
def copy_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = obs(spark, sf_dir).select("ds_id").distinct().withColumn("name", F.concat(F.lit("Stream "), "ds_id"))
    tgt = datastreams(spark, sf_dir).select(
        F.concat(F.lit("t-"), "ds_id").alias("ds_id"), F.concat(F.lit("Stream "), "ds_id").alias("name")
    )
    out = apply.copy_observations(obs(spark, sf_dir), src, tgt, "2024-01-03", "2024-01-29", days_per_batch=7)
    return out.select(
        "obs_id", "source_ds_id", "ds_id", ts("phen_start").alias("phen_start"), "slice", num("result_num").alias("result_num"), "action"
    )
