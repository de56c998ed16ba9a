"""Validators, change sets and their sinks."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.operators import aggregate, apply, days, validate
from gaugeflow.plans.catalog.base import (
    SQL_INTERVALS,
    incoming,
    intervals,
    num,
    obs,
    query,
    sql_ts,
    staged,
    stored,
    ts,
    with_views,
)
from gaugeflow.session import stage

_NOW = "2024-01-20 12:30:00"


def _marked(df: DataFrame) -> DataFrame:
    return df.select("seq", "reason")


@query("validate_all", "SELECT event_id AS seq, CAST(NULL AS VARCHAR) AS reason FROM events")
def validate_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _marked(validate.validate_all(obs(spark, sf_dir)))


@query(
    "validate_after",
    f"""SELECT event_id AS seq, CASE WHEN NOT ts > TIMESTAMP '{_NOW}' - INTERVAL 2 DAY - INTERVAL 30 MINUTE
             THEN 'Not after the bound' END AS reason FROM events""",
)
def validate_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _marked(validate.validate_after(obs(spark, sf_dir), _NOW, days=2, minutes=30))


@query(
    "validate_before",
    f"""SELECT event_id AS seq, CASE WHEN NOT ts < TIMESTAMP '{_NOW}' - INTERVAL 1 DAY
             THEN 'Not before the bound' END AS reason FROM events""",
)
def validate_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _marked(validate.validate_before(obs(spark, sf_dir), _NOW))


@query(
    "validate_newer",
    with_views(
        """SELECT i.seq, CASE WHEN l.t IS NOT NULL AND NOT i.phen_start > l.t THEN 'Not newer' END AS reason
           FROM incoming i LEFT JOIN (SELECT ds_id, max(phen_start) AS t FROM stored GROUP BY ds_id) l ON l.ds_id = i.ds_id"""
    ),
)
def validate_newer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _marked(validate.validate_newer(incoming(spark, sf_dir), stored(spark, sf_dir)))


@query(
    "validate_interval",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber = 7 THEN 'Not an interval'
             WHEN phen_end <> phen_start + INTERVAL 2 HOUR THEN 'Wrong interval' END AS reason FROM ({SQL_INTERVALS})""",
)
def validate_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = intervals(spark, sf_dir).withColumn("phen_end", F.when(F.col("l_linenumber") < 7, F.col("phen_end")))
    return validate.validate_interval(i, "PT2H").select("l_orderkey", "l_linenumber", "l_partkey", "reason")


@query(
    "validate_multi",
    with_views(
        f"""SELECT i.seq, CASE WHEN NOT i.phen_start > TIMESTAMP '{_NOW}' - INTERVAL 3 DAY THEN 'Not after the bound'
                   WHEN l.t IS NOT NULL AND NOT i.phen_start > l.t THEN 'Not newer'
                   WHEN NOT i.phen_start < TIMESTAMP '{_NOW}' + INTERVAL 5 DAY THEN 'Not before the bound' END AS reason
            FROM incoming i LEFT JOIN (SELECT ds_id, max(phen_start) AS t FROM stored GROUP BY ds_id) l ON l.ds_id = i.ds_id"""
    ),
)
def validate_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    chain = [
        partial(validate.validate_after, now=_NOW, days=3),
        partial(validate.validate_newer, target=stored(spark, sf_dir)),
        partial(validate.validate_before, now=_NOW, days=-5),
    ]
    return _marked(validate.validate_multi(incoming(spark, sf_dir), chain))


@query(
    "batch_dedupe",
    with_views(
        f"""SELECT ds_id, {sql_ts("phen_start")} AS phen_start, max(seq) AS seq, round(arg_max(result_num, seq), 6) AS result_num
            FROM incoming_hour GROUP BY ds_id, phen_start"""
    ),
)
def batch_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = validate.batch_dedupe(incoming(spark, sf_dir, "hour"))
    return out.select("ds_id", ts("phen_start").alias("phen_start"), "seq", num("result_num").alias("result_num"))


@query(
    "superseded",
    with_views("SELECT seq, seq < max(seq) OVER (PARTITION BY ds_id, phen_start) AS superseded FROM incoming_hour"),
)
def superseded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.flag_superseded(incoming(spark, sf_dir, "hour")).select("seq", "superseded")


# Hour-long batches against hourly stored data: one action per stream and time.
_UPSERT = """last AS (SELECT * FROM incoming_hour QUALIFY row_number() OVER (PARTITION BY ds_id, phen_start ORDER BY seq DESC) = 1),
  kept AS (SELECT * FROM stored_hour QUALIFY row_number() OVER (PARTITION BY ds_id, phen_start ORDER BY CAST(obs_id AS BIGINT) DESC) = 1),
  changes AS (SELECT CASE WHEN k.obs_id IS NULL THEN 'insert' WHEN k.result_num = l.result_num THEN 'skip' ELSE 'update' END AS action,
                     k.obs_id AS stored_id, l.* FROM last l LEFT JOIN kept k ON k.ds_id = l.ds_id AND k.phen_start = l.phen_start)"""


def _upsert_sql(body: str) -> str:
    return with_views("").rstrip() + ", " + _UPSERT + " " + body


def upsert_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validate_by_time(incoming(spark, sf_dir, "hour"), stored(spark, sf_dir, "hour"))


@query(
    "upsert_by_time",
    _upsert_sql(
        f"SELECT action, stored_id, ds_id, {sql_ts('phen_start')} AS phen_start, round(result_num, 6) AS result_num, seq FROM changes"
    ),
)
def upsert_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = upsert_changes(spark, sf_dir)
    return out.select(
        "action", F.when(F.col("action") != "insert", F.col("obs_id")).alias("stored_id"), "ds_id",
        ts("phen_start").alias("phen_start"), num("result_num").alias("result_num"), "seq",
    )


@query(
    "delete_duplicates",
    with_views(
        """SELECT obs_id FROM stored_hour WHERE phen_start >= (SELECT min(phen_start) FROM incoming_hour)
           QUALIFY row_number() OVER (PARTITION BY ds_id, phen_start ORDER BY CAST(obs_id AS BIGINT) DESC) > 1"""
    ),
)
def delete_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.find_duplicates(stored(spark, sf_dir, "hour"), incoming(spark, sf_dir, "hour")).select("obs_id")


@query(
    "upsert_by_params",
    with_views(
        """SELECT CASE WHEN s.obs_id IS NULL THEN 'insert' WHEN i.seq < max(i.seq) OVER (PARTITION BY s.obs_id) THEN 'skip'
                   ELSE 'update' END AS action, s.obs_id AS stored_id, i.seq
           FROM incoming i LEFT JOIN (SELECT ds_id, k, CAST(min(CAST(obs_id AS BIGINT)) AS VARCHAR) AS obs_id FROM stored GROUP BY ds_id, k) s
           ON s.ds_id = i.ds_id AND s.k = i.k"""
    ),
)
def upsert_by_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = validate.validate_by_parameters(incoming(spark, sf_dir), stored(spark, sf_dir), ["k"], update=True)
    return out.select("action", F.when(F.col("action") != "insert", F.col("obs_id")).alias("stored_id"), "seq")


@query(
    "params_and_time",
    with_views(
        """SELECT CASE WHEN s.obs_id IS NULL THEN 'insert' ELSE 'skip' END AS action, s.obs_id AS stored_id, i.seq
           FROM incoming_hour i LEFT JOIN (SELECT ds_id, k, phen_start, CAST(min(CAST(obs_id AS BIGINT)) AS VARCHAR) AS obs_id
                                           FROM stored_hour GROUP BY ds_id, k, phen_start) s
           ON s.ds_id = i.ds_id AND s.k = i.k AND s.phen_start = i.phen_start"""
    ),
)
def params_and_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = validate.validate_by_parameters(
        incoming(spark, sf_dir, "hour"), stored(spark, sf_dir, "hour"), ["k"], check_time=True
    )
    return out.select("action", F.when(F.col("action") != "insert", F.col("obs_id")).alias("stored_id"), "seq")


_APPLIED_SQL = _upsert_sql(
    f"""SELECT obs_id AS stored_id, ds_id, {sql_ts("phen_start")} AS phen_start, round(result_num, 6) AS result_num, k, seq FROM stored_hour
          WHERE obs_id NOT IN (SELECT stored_id FROM changes WHERE action = 'update')
        UNION ALL SELECT stored_id, ds_id, {sql_ts("phen_start")}, round(result_num, 6), k, seq FROM changes WHERE action <> 'skip'"""
)


def _applied(df: DataFrame) -> DataFrame:
    """The table after a change set; ids made for inserts are hashes and shown as NULL."""
    return df.select(
        F.when(F.length("obs_id") < 64, F.col("obs_id")).alias("stored_id"), "ds_id", ts("phen_start").alias("phen_start"),
        num("result_num").alias("result_num"), F.element_at("parameters", F.lit("k")).alias("k"), "seq",
    )


@query("apply_changes", _APPLIED_SQL)
def apply_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(apply.apply_changes(stored(spark, sf_dir, "hour"), upsert_changes(spark, sf_dir)))


@query("apply_by_day", _APPLIED_SQL)
def apply_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a stored table, of which only the days the changes touch are read and written."""
    held = stored(spark, sf_dir, "hour")
    root = staged(spark, sf_dir, "day_table", lambda path: days.create_days(held, path))
    first = days.read_pointer(spark, root, 0)
    # The deliveries of a whole table correct only some days' results: those days are touched.
    table_then = days.read_days(spark, root, held.schema, first)
    changes = stage(validate.validate_by_time(incoming(spark, sf_dir, "hour"), table_then), "day-changes")
    after = days.apply_by_day(spark, root, changes, held.schema, first, same_time=True)
    return _applied(days.read_days(spark, root, held.schema, after))


@query("apply_dry_run", _upsert_sql("SELECT action, count(*) AS n FROM changes GROUP BY action"))
def apply_dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply.apply_changes(stored(spark, sf_dir, "hour"), upsert_changes(spark, sf_dir), dry_run=True)


@query(
    "run_metrics",
    _upsert_sql(
        """SELECT count(*) AS read, count(*) AS validated, count(*) FILTER (action = 'insert') AS inserted,
                  count(*) FILTER (action = 'update') AS updated, 0 AS deleted, count(*) FILTER (action = 'skip') AS skipped,
                  0 AS errors, count(*) / 10.0 AS rows_per_second FROM changes"""
    ),
)
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.run_metrics(upsert_changes(spark, sf_dir), seconds=10.0)


@query(
    "data_array_batches",
    with_views(
        """, n AS (SELECT ds_id, seq, row_number() OVER (PARTITION BY ds_id ORDER BY seq) AS pos FROM obs)
           SELECT ds_id, CAST((pos - 1) // 5 AS BIGINT) AS batch, count(*) AS n, min(seq) AS first_seq,
                  'result,phenomenonTime,parameters' AS components FROM n GROUP BY 1, 2""".lstrip()
    ),
)
def data_array_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small batches; the first row of each array leads back to the event it came from."""
    rows = obs(spark, sf_dir).withColumn("result_text", F.col("seq").cast("string"))
    out = apply.to_data_arrays(rows, max_batch=5)
    first = F.get_json_object("data_array", "$[0][0]").cast("bigint")
    return out.select("ds_id", "batch", "n", first.alias("first_seq"), F.array_join("components", ",").alias("components"))
