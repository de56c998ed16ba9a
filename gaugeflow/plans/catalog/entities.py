"""Entity reconciliation.

Each query compares a later delivery of a table with what is stored: stored entities lack the
segment that is new, and the later delivery renames or changes another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions import props
from gaugeflow.operators import entities
from gaugeflow.plans.catalog.base import datastreams, obs, query, table, with_views
from gaugeflow.plans.catalog.sources import _swe_docs
from gaugeflow.sources import documents


def _text(c: str):
    return F.col(c).cast("string")


def _flags(df: DataFrame) -> DataFrame:
    return df.withColumn("changed", F.array_join("changed", ","))


def _customer_changes(changed: str, extra: str = "") -> str:
    """Segments: HOUSEHOLD is new, MACHINERY has another description, BUILDING another property value."""
    return f"""SELECT c_name AS name, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'insert' WHEN 'MACHINERY' THEN 'update'
                 WHEN 'BUILDING' THEN 'update' ELSE 'skip' END AS action,
                 CASE c_mktsegment WHEN 'HOUSEHOLD' THEN NULL WHEN 'MACHINERY' THEN '{changed}' WHEN 'BUILDING' THEN 'properties' ELSE '' END AS changed,
                 CASE c_mktsegment WHEN 'BUILDING' THEN 'b2' ELSE c_mktsegment END AS segment{extra} FROM customer"""


def _customers(spark: SparkSession, sf_dir: str, id_col: str) -> tuple[DataFrame, DataFrame]:
    c = table(spark, sf_dir, "customer")
    base = c.select(
        F.concat(F.lit("id-"), _text("c_custkey")).alias(id_col), F.col("c_name").alias("name"),
        F.concat(F.lit("Customer "), _text("c_nationkey")).alias("description"),
        *([] if id_col == "location_id" else [F.concat(F.lit("L"), _text("c_nationkey")).alias("location_id")]), "c_mktsegment", F.col("c_custkey").alias("seq"),
        (F.col("c_nationkey") + 0.5).cast("double").alias("lon"), (F.col("c_nationkey") + 40.5).cast("double").alias("lat"),
        props.build_map({"segment": F.col("c_mktsegment"), "nested/kept": "1"}).alias("properties"),
    )
    existing = base.filter(F.col("c_mktsegment") != "HOUSEHOLD")
    segment = F.col("c_mktsegment")
    later = base.withColumn(
        "description", F.when(segment == "MACHINERY", F.concat("description", F.lit("!"))).otherwise(F.col("description"))
    ).withColumn("properties", props.build_map({"segment": F.when(segment == "BUILDING", "b2").otherwise(segment), "empty": ""}))
    return later, existing


def _segment(df: DataFrame, *more: str) -> DataFrame:
    return _flags(df).select("name", "action", "changed", F.element_at("properties", F.lit("segment")).alias("segment"), *more)


@query("reconcile_entities", _customer_changes("description"))
def reconcile_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    later, existing = _customers(spark, sf_dir, "id")
    return _segment(entities.reconcile(later, existing, ["name"], "id", ["description"]))


@query(
    "reconcile_ambiguous",
    """SELECT p_name AS name, CASE WHEN n IS NULL THEN 'insert' WHEN n > 1 THEN 'reject' ELSE 'skip' END AS action
       FROM (SELECT DISTINCT p_name FROM part) LEFT JOIN
            (SELECT p_name, count(*) AS n FROM part WHERE p_size < 3 GROUP BY p_name) USING (p_name)""",
)
def reconcile_ambiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names: several stored parts of one name make it ambiguous."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), "p_size", F.col("p_partkey").alias("seq"))
    out = entities.reconcile(p, p.filter(F.col("p_size") < 3), ["name"], "id", ["name"], properties=False)
    return out.select("name", "action")


@query(
    "reconcile_things",
    _customer_changes(
        "description,location_id", ", CASE c_mktsegment WHEN 'MACHINERY' THEN 'moved' ELSE concat('L', c_nationkey) END AS location_id"
    ),
)
def reconcile_things(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Machinery customers moved; furniture ones come without a location and keep theirs."""
    later, existing = _customers(spark, sf_dir, "thing_id")
    segment = F.col("c_mktsegment")
    moved = F.when(segment == "MACHINERY", "moved").when(segment != "FURNITURE", F.col("location_id"))
    return _segment(entities.reconcile_things(later.withColumn("location_id", moved), existing), "location_id")


@query(
    "reconcile_sensors",
    """SELECT p_brand AS name, CASE WHEN p_brand LIKE '%1' THEN 'insert' WHEN p_brand LIKE '%2' THEN 'update' ELSE 'skip' END AS action,
              CASE WHEN p_brand LIKE '%1' THEN NULL WHEN p_brand LIKE '%2' THEN 'encoding,metadata' ELSE '' END AS changed, max(p_partkey) AS n
       FROM part GROUP BY p_brand""",
)
def reconcile_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("name")).agg(F.max("p_partkey").alias("seq"))
    base = brands.select(
        F.concat(F.lit("S"), "name").alias("sensor_id"), "name", F.lit("d").alias("description"), F.lit("text/html").alias("encoding"),
        F.lit("m").alias("metadata"), props.build_map({"n": F.col("seq").cast("string")}).alias("properties"), "seq",
    )
    two = F.col("name").endswith("2")
    later = base.withColumn("encoding", F.when(two, "application/pdf").otherwise(F.col("encoding"))).withColumn(
        "metadata", F.when(two, "other").otherwise(F.col("metadata"))
    )
    out = entities.reconcile_sensors(later, base.filter(~F.col("name").endswith("1")))
    return _flags(out).select("name", "action", "changed", F.element_at("properties", F.lit("n")).cast("bigint").alias("n"))


@query("reconcile_features", _customer_changes("lon", ", c_nationkey + CASE c_mktsegment WHEN 'MACHINERY' THEN 1.5 ELSE 0.5 END AS lon"))
def reconcile_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    later, existing = _customers(spark, sf_dir, "foi_id")
    later = later.withColumn("description", F.regexp_replace("description", "!$", ""))
    moved = F.when(F.col("c_mktsegment") == "MACHINERY", F.col("lon") + 1).otherwise(F.col("lon"))
    return _segment(entities.reconcile_features(later.withColumn("lon", moved), existing), "lon")


@query("reconcile_ops", _customer_changes("description", ", CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'new' ELSE 'old' END AS definition"))
def reconcile_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The definition of a property that exists is left alone."""
    later, existing = _customers(spark, sf_dir, "op_id")
    out = entities.reconcile_properties(later.withColumn("definition", F.lit("new")), existing.withColumn("definition", F.lit("old")))
    return _segment(out, "definition")


@query("reconcile_locations", _customer_changes("description,lat", ", c_nationkey + CASE c_mktsegment WHEN 'MACHINERY' THEN 41.0 ELSE 40.5 END AS lat"))
def reconcile_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    later, existing = _customers(spark, sf_dir, "location_id")
    moved = F.when(F.col("c_mktsegment") == "MACHINERY", F.col("lat") + 0.5).otherwise(F.col("lat"))
    return _segment(entities.reconcile_locations(later.withColumn("lat", moved), existing), "lat")


_STREAM_CHANGES = with_views(
    """, r AS (SELECT split_part(ds_id, ':', 1) AS thing_id, split_part(ds_id, ':', 2) AS name FROM registered),
         i AS (SELECT DISTINCT split_part(ds_id, ':', 1) AS thing_id, split_part(ds_id, ':', 2) AS name FROM obs)
       SELECT thing_id, name, CASE WHEN r.name IS NULL THEN 'insert' WHEN name IN ('click', 'view') THEN 'update' ELSE 'skip' END AS action,
              CASE WHEN r.name IS NULL THEN NULL WHEN name = 'click' THEN '%s' WHEN name = 'view' THEN '%s' ELSE '' END AS changed
       FROM i LEFT JOIN r USING (thing_id, name)""".lstrip()
)


def _streams(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    none = F.lit(None).cast("string")
    unit = F.struct(F.lit("u").alias("name"), F.lit("u").alias("symbol"), none.alias("definition"))

    def of(df: DataFrame, id_prefix: str) -> DataFrame:
        parts = F.split("ds_id", ":")
        return df.select("ds_id").distinct().select(
            F.concat(F.lit(id_prefix), "ds_id").alias("ds_id"), parts[0].alias("thing_id"), parts[1].alias("name"),
            F.lit("d").alias("description"), unit.alias("uom"), F.lit("op").alias("op_id"), F.lit("s").alias("sensor_id"),
            props.build_map({"p": "1"}).alias("properties"), F.lit(0).alias("seq"),
        )

    return of(obs(spark, sf_dir), "new-"), of(datastreams(spark, sf_dir), "")


@query("reconcile_datastreams", _STREAM_CHANGES.replace("'%s'", "'uom'", 1).replace("'%s'", "'op_id'", 1))
def reconcile_datastreams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Within its thing, the click stream has a new unit and the view stream a new property; the sensor stays."""
    later, existing = _streams(spark, sf_dir)
    none = F.lit(None).cast("string")
    unit = F.struct(F.lit("v").alias("name"), F.lit("v").alias("symbol"), none.alias("definition"))
    later = later.withColumn("uom", F.when(F.col("name") == "click", unit).otherwise(F.col("uom")))
    later = later.withColumn("op_id", F.when(F.col("name") == "view", "other").otherwise(F.col("op_id")))
    out = entities.reconcile_datastreams(later.withColumn("sensor_id", F.lit("another")), existing)
    return _flags(out).select("thing_id", "name", "action", "changed")


@query("reconcile_multi", _STREAM_CHANGES.replace("'%s'", "'description'", 1).replace("'%s'", "'properties'", 1))
def reconcile_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    later, existing = _streams(spark, sf_dir)
    existing = existing.withColumn("uoms", F.array("uom")).withColumn("op_ids", F.array("op_id"))
    later = later.withColumn("uoms", F.array("uom", "uom")).withColumn("op_ids", F.array("op_id", "op_id"))
    later = later.withColumn("description", F.when(F.col("name") == "click", "x").otherwise(F.col("description")))
    later = later.withColumn("properties", F.when(F.col("name") == "view", props.build_map({"p": "2"})).otherwise(F.col("properties")))
    return _flags(entities.reconcile_multi(later, existing)).select("thing_id", "name", "action", "changed")


@query(
    "merge_properties",
    """SELECT event_id, event_type <> 'click' AS changed,
              CASE event_type WHEN 'view' THEN concat('a/b=new;k=', k, ';only=t')
                   WHEN 'error' THEN concat('a=flat;k=', k, ';only=t')
                   WHEN 'purchase' THEN concat('a/b=1;k=', k, ';new/x=9;only=t')
                   WHEN 'signup' THEN concat('a/b=1;k=other;only=t') ELSE concat('a/b=1;k=', k, ';only=t') END AS merged
       FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events)""",
)
def merge_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One kind of change per event type; numbers equal in value and empty unknown entries change nothing."""
    e = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k"))
    target = props.build_map({"a/b": "1", "k": F.col("k"), "only": "t"})
    kind = F.col("event_type")
    source = (
        F.when(kind == "view", props.build_map({"a/b": "new"}))
        .when(kind == "error", props.build_map({"a": "flat"}))
        .when(kind == "purchase", props.build_map({"new/x": "9", "blank": ""}))
        .when(kind == "signup", props.build_map({"k": "other"}))
        .otherwise(props.build_map({"k": F.concat("k", F.lit(".0")), "a/b": "1.00", "blank": ""}))
    )
    out = e.select("event_id", props.merge_properties(target, source).alias("m"))
    text = F.array_join(F.transform(props.entries(F.col("m.properties")), lambda x: F.concat_ws("=", x["key"], x["value"])), ";")
    return out.select("event_id", F.col("m.changed").alias("changed"), text.alias("merged"))


@query(
    "append_local_id",
    """SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN p_brand WHEN p_brand = 'Brand#1' THEN concat('Brand#1,', p_name)
                              ELSE concat('Brand#1,', p_name, ',', p_brand) END AS ids FROM part""",
)
def append_local_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    ids = F.when(F.col("p_type") != "SMALL", F.array(F.lit("Brand#1"), "p_name"))
    return p.select("p_partkey", F.array_join(props.append_local_id(ids, F.col("p_brand")), ",").alias("ids"))


def _duplicate_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as datastreams: those of one brand and type are duplicates of each other."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("ds_id"), "p_brand", "p_type", F.col("p_name").alias("name"), F.array("p_name").alias("local_ids"))


_MERGE_CTE = "WITH m AS (SELECT p_partkey AS ds_id, min(p_partkey) OVER (PARTITION BY p_brand, p_type) AS main_id, p_name, p_brand, p_type FROM part)"


@query(
    "merge_datastreams",
    f"""{_MERGE_CTE} SELECT ds_id, main_id, CASE WHEN ds_id <> main_id THEN 'delete' ELSE 'update' END AS action,
          CASE WHEN ds_id <> main_id THEN p_name ELSE concat(p_type, ' at ', p_brand) END AS name,
          CASE WHEN ds_id <> main_id THEN p_name ELSE concat(p_name, ',', p_brand) END AS ids FROM m""",
)
def merge_datastreams(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes, _ = entities.merge_datastreams(
        _duplicate_streams(spark, sf_dir), _part_observations(spark, sf_dir), ["p_brand", "p_type"],
        F.concat("p_type", F.lit(" at "), "p_brand"), F.col("p_brand"),
    )
    return changes.select("ds_id", "main_id", "action", "name", F.array_join("local_ids", ",").alias("ids"))


def _part_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").alias("ds_id"), F.concat_ws(".", _text("l_orderkey"), _text("l_linenumber")).alias("obs_id"))


@query(
    "merge_observations",
    f"""{_MERGE_CTE} SELECT concat(l_orderkey, '.', l_linenumber) AS obs_id, l_partkey AS old_ds_id, main_id AS ds_id
        FROM lineitem JOIN m ON m.ds_id = l_partkey WHERE main_id <> m.ds_id""",
)
def merge_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, updates = entities.merge_datastreams(
        _duplicate_streams(spark, sf_dir), _part_observations(spark, sf_dir), ["p_brand", "p_type"], F.col("p_type"), F.col("p_brand")
    )
    return updates.select("obs_id", "old_ds_id", "ds_id")


@query(
    "backfill_units",
    """WITH first AS (SELECT o_custkey, arg_min(CASE WHEN o_orderstatus = 'O' THEN 'mg.m-3' ELSE 'ug.m-3' END, o_orderkey) AS unit
                      FROM orders GROUP BY o_custkey)
       SELECT c_custkey AS ds_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'own' ELSE unit END AS unit,
              c_mktsegment <> 'BUILDING' AND unit IS NOT NULL AS unit_set
       FROM customer LEFT JOIN first ON o_custkey = c_custkey""",
)
def backfill_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as datastreams, their orders' data arrays as responses."""
    c = table(spark, sf_dir, "customer")
    own = F.struct(F.lit("own").alias("name"), F.lit("own").alias("symbol"), F.lit("own").alias("definition"))
    streams = c.select(F.col("c_custkey").alias("ds_id"), F.when(F.col("c_mktsegment") == "BUILDING", own).alias("uom"))
    owner = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("ds_id"))
    docs = _swe_docs(spark, sf_dir, owner).select("ds_id", F.col("o_orderkey").alias("seq"), "xml")
    out = entities.backfill_units(streams, documents.explode_swe(docs))
    return out.select("ds_id", F.col("uom.symbol").alias("unit"), "unit_set")
