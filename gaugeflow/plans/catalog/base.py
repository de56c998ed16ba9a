"""Registry and the shared inputs of the registered queries.

``stored`` is what a target already holds: all observations before a cut-off day. ``incoming``
is a later delivery of the whole table in which the results of one event type were corrected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.model import RESULT_DECIMAL
from gaugeflow.session import staging_path, tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

CUT = "2024-01-21"
REGISTERED = "2024-01-05"
CORRECTED = "purchase"
ROWS_PER_FILE = 1_000_000


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with its zone-less timestamps read as UTC instants."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    for column, dtype in df.dtypes:
        if dtype == "timestamp_ntz":
            df = df.withColumn(column, F.col(column).cast("timestamp"))
    return df


_STAGED: dict[tuple[str, str, str], str] = {}


def staged(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Path of files Spark wrote from the tables, once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STAGED:
        path = staging_path(spark, name)
        write(path)
        _STAGED[key] = path
    return _STAGED[key]


def ts(column: Column | str) -> Column:
    """Timestamp as text with microseconds."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def sql_ts(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"


def num(column: Column | str, digits: int = 6) -> Column:
    return F.round((F.col(column) if isinstance(column, str) else column).cast("double"), digits)


def obs(spark: SparkSession, sf_dir: str, truncate: str | None = None) -> DataFrame:
    """Events as observations: one stream per user and event type; times optionally truncated."""
    e = table(spark, sf_dir, "events")
    start = F.date_trunc(truncate, "ts") if truncate else F.col("ts")
    number = F.col("value").cast(RESULT_DECIMAL)
    return e.select(
        F.col("event_id").cast("string").alias("obs_id"),
        F.lit("D").alias("kind"),
        F.concat(F.col("user_id").cast("string"), F.lit(":"), "event_type").alias("ds_id"),
        start.alias("phen_start"),
        F.lit(None).cast("timestamp").alias("phen_end"),
        F.lit("decimal").alias("result_kind"),
        number.alias("result_num"),
        number.cast("string").alias("result_text"),
        F.lit(None).cast("array<string>").alias("result_arr"),
        F.from_json("props", "map<string,string>").alias("parameters"),
        F.col("event_id").alias("seq"),
    )


def stored(spark: SparkSession, sf_dir: str, truncate: str | None = None) -> DataFrame:
    return obs(spark, sf_dir, truncate).filter(F.col("phen_start") < F.lit(CUT).cast("timestamp"))


def corrected(df: DataFrame) -> DataFrame:
    """A later delivery: other ids, results of one event type one higher."""
    fixed = F.col("result_num") + F.when(F.col("ds_id").endswith(":" + CORRECTED), 1).otherwise(0)
    return df.withColumn("result_num", fixed.cast(RESULT_DECIMAL)).withColumn("obs_id", F.lit(None).cast("string"))


def incoming(spark: SparkSession, sf_dir: str, truncate: str | None = None) -> DataFrame:
    return corrected(obs(spark, sf_dir, truncate))


def _sql_obs(start: str) -> str:
    return (
        "SELECT CAST(event_id AS VARCHAR) AS obs_id, concat(user_id, ':', event_type) AS ds_id, "
        f"{start} AS phen_start, value AS result_num, json_extract_string(props, '$.k') AS k, event_id AS seq FROM events"
    )


def with_views(body: str) -> str:
    """The same inputs as common table expressions in front of a SQL text."""
    fixed = f"result_num + CASE WHEN ds_id LIKE '%:{CORRECTED}' THEN 1 ELSE 0 END AS result_num"
    hourly = _sql_obs("date_trunc('hour', ts)")
    return (
        f"WITH obs AS ({_sql_obs('ts')}), obs_hour AS ({hourly}), "
        f"registered AS (SELECT DISTINCT ds_id FROM obs WHERE phen_start < TIMESTAMP '{REGISTERED}'), "
        f"stored AS (SELECT * FROM obs WHERE phen_start < TIMESTAMP '{CUT}'), "
        f"stored_hour AS (SELECT * FROM obs_hour WHERE phen_start < TIMESTAMP '{CUT}'), "
        f"incoming AS (SELECT ds_id, phen_start, {fixed}, k, seq FROM obs), "
        f"incoming_hour AS (SELECT ds_id, phen_start, {fixed}, k, seq FROM obs_hour) " + body
    )


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as interval observations: l_linenumber hours long, unit from the line status."""
    li = table(spark, sf_dir, "lineitem")
    number = F.col("l_quantity").cast(RESULT_DECIMAL)
    return li.select(
        F.lit("D").alias("kind"),
        F.concat(F.col("l_suppkey").cast("string"), F.lit(":"), "l_returnflag").alias("ds_id"),
        F.col("l_shipdate").alias("phen_start"),
        (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_linenumber"))).alias("phen_end"),
        number.alias("result_num"),
        F.when(F.col("l_linestatus") == "O", "mg/m3").otherwise("ug/m3").alias("unit"),
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
    )


SQL_INTERVALS = (
    "SELECT concat(l_suppkey, ':', l_returnflag) AS ds_id, l_shipdate AS phen_start, "
    "l_shipdate + to_hours(l_linenumber) AS phen_end, l_quantity AS result_num, "
    "CASE WHEN l_linestatus = 'O' THEN 'mg/m3' ELSE 'ug/m3' END AS unit, l_orderkey, l_partkey, l_linenumber FROM lineitem"
)


def datastreams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known datastreams: those with observations before the day they were registered."""
    early = obs(spark, sf_dir).filter(F.col("phen_start") < F.lit(REGISTERED).cast("timestamp"))
    s = early.select("ds_id").distinct()
    parts = F.split("ds_id", ":")
    return s.select(
        F.lit("D").alias("kind"),
        "ds_id",
        F.concat(F.lit("Stream "), "ds_id").alias("name"),
        parts[0].alias("thing"),
        parts[1].alias("property"),
        F.struct(
            F.lit("microgram per cubic metre").alias("name"), F.lit("ug/m3").alias("symbol"), F.lit("").alias("definition")
        ).alias("uom"),
    )


def events_csv(spark: SparkSession, sf_dir: str) -> str:
    """Events as CSV with header: one file per day and million event ids, in id order."""

    def write(path: str) -> None:
        e = table(spark, sf_dir, "events")
        out = e.select(
            F.to_date("ts").alias("day"),
            F.lpad(F.floor(F.col("event_id") / ROWS_PER_FILE).cast("string"), 9, "0").alias("chunk"),
            "event_id",
            ts("ts").alias("ts"),
            "user_id",
            "event_type",
            "value",
            "props",
        )
        (
            out.repartition("day", "chunk").sortWithinPartitions("day", "chunk", "event_id")
            .write.partitionBy("day", "chunk").option("header", True).option("escape", '"').csv(path)
        )

    return staged(spark, sf_dir, "events_csv", write)


FILE_OF_EVENT = f"CAST(ts AS DATE), event_id // {ROWS_PER_FILE}"
