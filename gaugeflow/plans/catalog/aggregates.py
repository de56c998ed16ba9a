"""Aggregations, time bounds and requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions import times
from gaugeflow.operators import aggregate, bounds
from gaugeflow.plans.catalog.base import num, obs, query, sql_ts, stored, table, ts, with_views


@query(
    "group_by_datastream",
    with_views(
        "SELECT ds_id, count(*) AS n, min(seq) AS first_seq, max(seq) AS last_seq, CAST(ceil(count(*) / 10.0) AS BIGINT) AS flushes "
        "FROM obs GROUP BY ds_id"
    ),
)
def group_by_datastream(spark: SparkSession, sf_dir: str) -> DataFrame:
    laid = aggregate.by_datastream(obs(spark, sf_dir))
    return aggregate.datastream_counts(laid, flush=10).select("ds_id", "n", "first_seq", "last_seq", "flushes")


@query(
    "latest_per_ds",
    with_views(
        f"""SELECT ds_id, arg_max(obs_id, (phen_start, seq)) AS obs_id, {sql_ts("max(phen_start)")} AS phen_start,
                   round(arg_max(result_num, (phen_start, seq)), 6) AS result_num, {sql_ts("min(phen_start)")} AS extent_start
            FROM obs_hour GROUP BY ds_id"""
    ),
)
def latest_per_ds(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = aggregate.latest_per_datastream(obs(spark, sf_dir, "hour"))
    return out.select(
        "ds_id", "obs_id", ts("phen_start").alias("phen_start"), num("result_num").alias("result_num"),
        ts("extent_start").alias("extent_start"),
    )


@query(
    "error_summary",
    """WITH e AS (SELECT concat(l_returnflag, l_linestatus) AS type, concat('file-', l_suppkey) AS src_file, l_linenumber AS src_line,
                         l_orderkey * 1000000 + l_linenumber * 100000 + l_partkey % 100000 AS seq FROM lineitem),
            u AS (SELECT type, src_file, seq, max(src_line) AS src_line FROM e GROUP BY ALL),
            f AS (SELECT type, src_file, row_number() OVER (PARTITION BY type ORDER BY min(seq), src_file) AS file_no FROM u GROUP BY type, src_file),
            l AS (SELECT *, row_number() OVER (PARTITION BY type, src_file ORDER BY seq) AS no FROM u)
       SELECT l.type, t.total, l.src_file, file_no, string_agg(CAST(src_line AS VARCHAR), ',' ORDER BY no) AS lines
       FROM l JOIN f USING (type, src_file) JOIN (SELECT type, count(*) AS total FROM u GROUP BY type) t ON t.type = l.type
       WHERE file_no <= 20 AND no <= 5 GROUP BY l.type, t.total, l.src_file, file_no""",
)
def error_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as errors: the type from their flags, the file from the supplier."""
    li = table(spark, sf_dir, "lineitem")
    seq = F.col("l_orderkey") * 1000000 + F.col("l_linenumber") * 100000 + F.col("l_partkey") % 100000
    errors = li.select(
        F.concat("l_returnflag", "l_linestatus").alias("type"), F.concat(F.lit("file-"), F.col("l_suppkey").cast("string")).alias("src_file"),
        F.col("l_linenumber").alias("src_line"), seq.alias("seq"),
    ).groupBy("type", "src_file", "seq").agg(F.max("src_line").alias("src_line"))
    out = aggregate.error_summary(errors)
    text = F.array_join(F.transform("lines", lambda x: x.cast("string")), ",")
    return out.select("type", "total", "src_file", "file_no", text.alias("lines"))


@query(
    "upload_summary",
    """SELECT o_custkey, count(*) FILTER (o_orderstatus = 'P') AS errors, count(*) FILTER (o_orderstatus <> 'P') AS inserted,
              arg_min(concat('error: order ', o_orderkey), o_orderkey) FILTER (o_orderstatus = 'P') AS first_error
       FROM orders GROUP BY o_custkey""",
)
def upload_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    location = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("error: order "), key)).otherwise(
        F.concat(F.lit("/Observations("), key, F.lit(")"))
    )
    rows = o.select("o_custkey", location.alias("location"), F.col("o_orderkey").alias("seq"))
    return aggregate.upload_summary(rows, ["o_custkey"])


def _catalog_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("ds_id"), F.col("p_name").alias("name"), F.col("p_type").alias("description"),
        F.col("p_brand").alias("op_name"), F.lit("mg").alias("uom_symbol"),
    )


@query(
    "aggregate_catalog",
    """SELECT CAST(p_partkey AS VARCHAR) AS base_ds_id, l.level, concat(p_name, l.suffix) AS name, concat(p_type, l.txt) AS description,
              CASE l.level WHEN 'hourly' THEN concat('/Datastreams(', p_partkey, ')') ELSE 'hourly stream' END AS aggregate_for,
              concat_ws(',', p_brand, concat(p_brand, ' Min'), concat(p_brand, ' Max'), concat(p_brand, ' Dev')) AS op_names
       FROM part, (VALUES ('hourly', ' [1 hour]', ' Aggregated hourly'), ('daily', ' [1 day]', ' Aggregated daily')) AS l(level, suffix, txt)""",
)
def aggregate_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = aggregate.aggregate_catalog(_catalog_input(spark, sf_dir))
    source = F.when(F.col("aggregate_for").startswith("/Multi"), "hourly stream").otherwise(F.col("aggregate_for"))
    return out.select(
        "base_ds_id", "level", "name", "description", source.alias("aggregate_for"), F.array_join("op_names", ",").alias("op_names")
    )


@query(
    "aggregate_properties",
    """SELECT CAST(p_partkey AS VARCHAR) AS base_op_id, concat(p_name, ' ', k.n) AS name, concat(p_type, ' ', k.d) AS description
       FROM part, (VALUES ('Min', 'Minimum'), ('Max', 'Maximum'), ('Dev', 'Standard deviation')) AS k(n, d)""",
)
def aggregate_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("op_id"), F.col("p_name").alias("name"), F.col("p_type").alias("description"),
        F.lit("").alias("definition"),
    )
    return aggregate.aggregate_properties(ops).select("base_op_id", "name", "description")


def _rollup_sql(unit: str) -> str:
    return with_views(
        f"""SELECT ds_id, {sql_ts(f"date_trunc('{unit}', phen_start)")} AS phen_start, round(avg(result_num), 6) AS mean,
                   round(min(result_num), 6) AS min, round(max(result_num), 6) AS max, round(stddev_samp(result_num), 6) AS dev, count(*) AS n
            FROM obs GROUP BY ds_id, date_trunc('{unit}', phen_start)"""
    )


def _rolled(df: DataFrame) -> DataFrame:
    return df.select("ds_id", ts("phen_start").alias("phen_start"), *[num(c).alias(c) for c in ("mean", "min", "max", "dev")], "n")


@query("rollup_hourly", _rollup_sql("hour"))
def rollup_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolled(aggregate.rollup(obs(spark, sf_dir), "hourly"))


@query("rollup_daily", _rollup_sql("day"))
def rollup_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolled(aggregate.rollup(obs(spark, sf_dir), "daily"))


@query(
    "rollup_vectors",
    with_views(
        f"""SELECT {sql_ts("date_trunc('day', phen_start)")} AS phen_start, {sql_ts("date_trunc('day', phen_start) + INTERVAL 1 DAY")} AS phen_end,
                   round(min(result_num), 6) AS lowest, round(max(result_num), 6) AS highest, 4 AS n FROM obs GROUP BY ds_id, date_trunc('day', phen_start)"""
    ),
)
def rollup_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = aggregate.rollup_vector(aggregate.rollup(obs(spark, sf_dir), "daily"), "daily")
    value = [num(F.get("result_arr", F.lit(i)).try_cast("double")) for i in (1, 2)]
    return out.select(
        ts("phen_start").alias("phen_start"), ts("phen_end").alias("phen_end"), value[0].alias("lowest"), value[1].alias("highest"),
        F.size("result_arr").alias("n"),
    )


# Time bounds ----------------------------------------------------------------------------------


@query("bound_from", with_views("SELECT seq FROM obs WHERE phen_start >= TIMESTAMP '2024-01-15 06:00:00'"))
def bound_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs(spark, sf_dir).filter(F.col("phen_start") >= times.bound_from("2024-01-15 06:00:00")).select("seq")


@query(
    "bound_ago",
    with_views(f"SELECT seq, {sql_ts('phen_start - INTERVAL 36 HOUR')} AS t, {sql_ts('phen_start - to_seconds(2629746)')} AS m FROM obs"),
)
def bound_ago(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bound a run at each observation's time would use."""
    now = F.col("phen_start")
    return obs(spark, sf_dir).select(
        "seq", ts(times.bound_ago(now, 3, "HALF_DAYS")).alias("t"), ts(times.bound_ago(now, 1, "MONTHS")).alias("m")
    )


def _bound_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Streams of clicks have an extent, views and errors only observations, others neither; signups are multi-datastreams."""
    o = obs(spark, sf_dir)
    s = stored(spark, sf_dir)
    is_type = lambda t: F.col("ds_id").endswith(":" + t)
    kind = F.when(is_type("signup"), "M").otherwise("D")
    extent = s.groupBy("ds_id").agg(F.min("phen_start").alias("lo"), F.max("phen_start").alias("hi"))
    ds = o.select("ds_id").distinct().join(extent, "ds_id", "left")
    has_extent = is_type("click") | is_type("signup")
    streams = ds.select(
        kind.alias("kind"), "ds_id", F.when(has_extent, F.col("lo")).alias("phen_start"), F.when(has_extent, F.col("hi")).alias("phen_end")
    )
    hour = F.make_dt_interval(F.lit(0), F.lit(1))
    held = s.filter(is_type("view") | is_type("error")).withColumn(
        "phen_end", F.when(is_type("error"), F.col("phen_start") + hour)
    )
    return streams, held


_BOUND_SQL = """SELECT d.ds_id, CASE WHEN l.t IS NULL THEN TIMESTAMP '2017-01-01'
                  WHEN d.ds_id LIKE '%:click' OR d.ds_id LIKE '%:view' THEN l.t + INTERVAL 1 SECOND
                  WHEN d.ds_id LIKE '%:error' THEN l.t + INTERVAL 1 HOUR
                  WHEN d.ds_id LIKE '%:signup' THEN l.t ELSE TIMESTAMP '2017-01-01' END AS b
                FROM (SELECT DISTINCT ds_id FROM obs) d LEFT JOIN (SELECT ds_id, max(phen_start) AS t FROM stored GROUP BY ds_id) l USING (ds_id)"""


@query("bound_newer", with_views(f"SELECT ds_id, {sql_ts('b')} AS bound FROM ({_BOUND_SQL})"))
def bound_newer(spark: SparkSession, sf_dir: str) -> DataFrame:
    streams, held = _bound_inputs(spark, sf_dir)
    return bounds.bound_newer(streams, held, "2017-01-01 00:00:00").select("ds_id", ts("bound").alias("bound"))


@query(
    "request_intervals",
    with_views(
        f"""SELECT ds_id, {sql_ts("date_trunc('minute', b)")} AS req_start, '2024-02-01 10:15:00.000000' AS req_end,
                   concat('http://x.example/obs?id=', ds_id, '&time=', strftime(date_trunc('minute', b), '%Y-%m-%dT%H:%M:%SZ'),
                          '/2024-02-01T10:15:00Z') AS url FROM ({_BOUND_SQL})"""
    ),
)
def request_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    streams, held = _bound_inputs(spark, sf_dir)
    found = bounds.bound_newer(streams, held, "2017-01-01 00:00:00")
    out = bounds.request_intervals(
        found, "2024-02-01 10:15:42", "http://x.example/obs?id={datastreamLocalId}&time={phenomenonTimeInterval}"
    )
    return out.select("ds_id", ts("req_start").alias("req_start"), ts("req_end").alias("req_end"), "url")


