"""Streams and the flagship ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.plans.catalog.base import num, obs, query, sql_ts, staged, stored, table, ts, with_views
from gaugeflow.plans.ingest import run_ingest
from gaugeflow.session import staging_path
from gaugeflow.streaming.incremental import current, run_incremental, stream_dedupe

_EVENT_SCHEMA = "ds_id string, phen_start timestamp, value double, seq bigint"


def _event_files(spark: SparkSession, sf_dir: str) -> str:
    """Hourly observations as parquet files by day, so all rows of a stream and time arrive together."""

    def write(path: str) -> None:
        o = obs(spark, sf_dir, "hour").select("ds_id", "phen_start", F.col("result_num").cast("double").alias("value"), "seq")
        o.repartitionByRange(6, "phen_start").write.parquet(path)

    return staged(spark, sf_dir, "stream_source", write)


def _to_observations(batch: DataFrame) -> DataFrame:
    return batch.select(
        F.lit("D").alias("kind"), "ds_id", "phen_start", F.lit("decimal").alias("result_kind"),
        F.col("value").cast("decimal(38,12)").alias("result_num"), "seq",
    )


@query(
    "stream_upsert",
    with_views(
        f"""SELECT ds_id, {sql_ts("phen_start")} AS phen_start, round(arg_max(result_num, seq), 6) AS result_num
            FROM obs_hour GROUP BY ds_id, phen_start"""
    ),
)
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the same files; the second finds nothing to do."""
    source = _event_files(spark, sf_dir)
    target, checkpoint = staging_path(spark, "stream_target"), staging_path(spark, "stream_checkpoint")
    for _ in range(2):
        run_incremental(spark, source, _EVENT_SCHEMA, _to_observations, target, checkpoint, max_files_per_trigger=3)
    return current(spark, target).select("ds_id", ts("phen_start").alias("phen_start"), num("result_num").alias("result_num"))


@query("stream_dedupe", with_views(f"SELECT DISTINCT ds_id, {sql_ts('phen_start')} AS phen_start FROM obs_hour"))
def stream_dedupe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = spark.readStream.schema(_EVENT_SCHEMA).option("maxFilesPerTrigger", 3).parquet(_event_files(spark, sf_dir))
    unique = stream_dedupe(source, ["ds_id", "phen_start"], "phen_start", "40 days")
    out, checkpoint = staging_path(spark, "dedupe"), staging_path(spark, "dedupe_checkpoint")
    query_ = (
        unique.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    )
    query_.awaitTermination()
    return spark.read.schema(_EVENT_SCHEMA).parquet(out).select("ds_id", ts("phen_start").alias("phen_start"))


# The flagship: air-quality style records from CSV ---------------------------------------------

_UNIT = "CASE event_type WHEN 'click' THEN 'mg/m3' WHEN 'view' THEN 'ppb' ELSE 'ug/m3' END"


def _flagship_files(spark: SparkSession, sf_dir: str) -> str:
    """Events as hourly measurements: local time at +01:00, missing values as -1, comma decimals for errors."""

    def write(path: str) -> None:
        e = table(spark, sf_dir, "events")
        two = F.col("value").cast("decimal(18,2)").cast("string")
        number = F.when(F.col("value") < 1, "-1").when(F.col("event_type") == "error", F.replace(two, F.lit("."), F.lit(","))).otherwise(two)
        start = F.date_trunc("hour", "ts")
        hours = F.when(F.col("event_type") == "signup", 2).otherwise(1)

        def local(t):
            return F.date_format(F.from_utc_timestamp(t, "+01:00"), "yyyyMMddHHmmss")

        rows = e.select(
            F.col("user_id").alias("STATIONCODE"), F.col("event_type").alias("PROPERTY"),
            F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("SAMPLINGPOINT_LOCALID"), number.alias("VALUE_NUMERIC"),
            F.expr(_UNIT).alias("UNIT"), local(start).alias("DATETIME_BEGIN"),
            local(start + F.make_dt_interval(F.lit(0), hours)).alias("DATETIME_END"), "event_id",
        )
        files = max(spark.sparkContext.defaultParallelism, 1)
        rows.repartitionByRange(files, "event_id").sortWithinPartitions("event_id").write.option("header", True).csv(path)

    return staged(spark, sf_dir, "flagship_csv", write)


FLAGSHIP = {
    "importer": {
        "header": True,
        "converters": [
            {
                "result": "VALUE_NUMERIC",
                "missing": "-1",
                "decimal": "DETECT",
                "phen_time": ["DATETIME_BEGIN", "DATETIME_END"],
                "time_format": "yyyyMMddHHmmss",
                "zone": "+01:00",
                "unit": "UNIT",
                "conversions": [("mg/m3", "ug/m3", "1000")],
                "parameters": '{"point": "{SAMPLINGPOINT_LOCALID}"}',
                "keys": {"thing": "{STATIONCODE}", "property": "{PROPERTY}"},
            }
        ],
    },
    "validator": [{"type": "interval", "period": "PT1H"}, {"type": "by_time", "update": True}],
    "uploader": {"max_batch": 1000},
}


def _flagship_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    parts = F.split("ds_id", ":")
    known = stored(spark, sf_dir).select("ds_id").distinct()
    streams = known.select(
        F.lit("D").alias("kind"), "ds_id", parts[0].alias("thing"), parts[1].alias("property"),
        F.struct(F.lit("microgram").alias("name"), F.lit("ug/m3").alias("symbol"), F.lit("").alias("definition")).alias("uom"),
    )
    held = stored(spark, sf_dir, "hour").withColumn("phen_end", F.col("phen_start") + F.make_dt_interval(F.lit(0), F.lit(1)))
    return {"datastreams": streams, "observations": held}


_FLAGSHIP_SQL = f""", r AS (
      SELECT e.event_id AS seq, concat(user_id, ':', event_type) AS ds_id, date_trunc('hour', ts) AS phen_start,
             CASE WHEN event_type = 'click' THEN value * 1000 ELSE value END AS result_num,
             CASE WHEN k.ds_id IS NULL THEN 'No Datastream'
                  WHEN event_type = 'view' THEN 'Failed unit conversion from ppb to ug/m3'
                  WHEN event_type = 'signup' THEN 'Wrong interval' END AS reason
      FROM events e LEFT JOIN (SELECT DISTINCT ds_id FROM stored) k ON k.ds_id = concat(user_id, ':', event_type)
      WHERE value >= 1),
    last AS (SELECT * FROM r WHERE reason IS NULL QUALIFY row_number() OVER (PARTITION BY ds_id, phen_start ORDER BY seq DESC) = 1),
    kept AS (SELECT * FROM stored_hour QUALIFY row_number() OVER (PARTITION BY ds_id, phen_start ORDER BY CAST(obs_id AS BIGINT) DESC) = 1),
    changes AS (
      SELECT CASE WHEN k.obs_id IS NULL THEN 'insert' WHEN round(k.result_num, 6) = round(l.result_num, 6) THEN 'skip' ELSE 'update' END AS action,
             CASE WHEN k.obs_id IS NULL THEN NULL WHEN round(k.result_num, 6) = round(l.result_num, 6) THEN 'Same result' ELSE 'Changed result' END AS reason,
             l.ds_id, l.phen_start, l.result_num, l.seq
      FROM last l LEFT JOIN kept k ON k.ds_id = l.ds_id AND k.phen_start = l.phen_start
      UNION ALL SELECT 'reject', reason, CASE WHEN reason <> 'No Datastream' THEN ds_id END, phen_start, NULL, seq FROM r WHERE reason IS NOT NULL)"""


def flagship(spark: SparkSession, sf_dir: str, dry_run: bool = True) -> dict[str, DataFrame]:
    spec = {**FLAGSHIP, "importer": {**FLAGSHIP["importer"], "paths": _flagship_files(spark, sf_dir)}}
    return run_ingest(spark, spec, _flagship_tables(spark, sf_dir), dry_run)


def _flagship_sql(body: str) -> str:
    return with_views("").rstrip() + _FLAGSHIP_SQL + " " + body


@query(
    "ingest_flagship",
    _flagship_sql(
        f"""SELECT action, reason, ds_id, {sql_ts("phen_start")} AS phen_start,
                   CASE WHEN action <> 'reject' THEN round(result_num, 6) END AS result_num FROM changes"""
    ),
)
def ingest_flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = flagship(spark, sf_dir)["changes"]
    return out.select(
        "action", "reason", "ds_id", ts("phen_start").alias("phen_start"),
        F.when(F.col("action") != "reject", num("result_num")).alias("result_num"),
    )


@query("ingest_metrics", _flagship_sql(
    """SELECT count(*) AS read, count(*) FILTER (action <> 'reject') AS validated, count(*) FILTER (action = 'insert') AS inserted,
              count(*) FILTER (action = 'update') AS updated, 0 AS deleted, count(*) FILTER (action = 'skip') AS skipped,
              count(*) FILTER (action = 'reject') AS errors FROM changes"""
))
def ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagship(spark, sf_dir)["metrics"].drop("rows_per_second")
