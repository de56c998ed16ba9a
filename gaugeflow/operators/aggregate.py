"""Aggregations over observations, errors, changes and uploads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.model import STREAM_KEY, stable_id
from gaugeflow.operators.skew import keep_first

# The aggregation levels, their name suffix and description.
LEVELS = [
    ("hourly", "[1 hour]", "Aggregated hourly", "hour"),
    ("daily", "[1 day]", "Aggregated daily", "day"),
]
# The derived observed properties and their description.
DERIVED = [("Min", "Minimum"), ("Max", "Maximum"), ("Dev", "Standard deviation")]


def by_datastream(observations: DataFrame, partitions: int | None = None) -> DataFrame:
    """Observations laid out per datastream in source order.

    Range partitioning on stream and order keeps streams together but splits one that is larger
    than a partition, which hashing on the stream could not.
    """
    order = [*STREAM_KEY, "seq"]
    laid = observations.repartitionByRange(partitions, *order) if partitions else observations.repartitionByRange(*order)
    return laid.sortWithinPartitions(*order)


def datastream_counts(observations: DataFrame, flush: int = 100_000) -> DataFrame:
    """Observations per datastream and the number of upload groups of at most ``flush`` they make."""
    return (
        observations.groupBy(*STREAM_KEY)
        .agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))
        .withColumn("flushes", F.ceil(F.col("n") / F.lit(flush)).cast("bigint"))
    )


def latest_per_datastream(observations: DataFrame) -> DataFrame:
    """Latest observation and time extent per datastream; equal times are settled by ``seq``."""
    order = F.struct("phen_start", "seq")
    row = F.struct("obs_id", "phen_start", "phen_end", "result_num")
    return (
        observations.groupBy(*STREAM_KEY)
        .agg(
            F.max_by(row, order).alias("_l"),
            F.min("phen_start").alias("extent_start"),
            F.max(F.coalesce("phen_end", "phen_start")).alias("extent_end"),
        )
        .select(
            *STREAM_KEY,
            F.col("_l.obs_id").alias("obs_id"),
            F.col("_l.phen_start").alias("phen_start"),
            F.col("_l.phen_end").alias("phen_end"),
            F.col("_l.result_num").alias("result_num"),
            "extent_start",
            "extent_end",
        )
    )


def error_summary(errors: DataFrame, max_files: int = 20, max_lines: int = 5) -> DataFrame:
    """``type, total, src_file, file_no, lines``: the first files per type and their first lines.

    Input: ``type, src_file, src_line, seq``. Files count in the order they first show an error.
    The rankings keep a fixed number of rows per group before anything is shuffled.
    """
    totals = errors.groupBy("type").agg(F.count(F.lit(1)).alias("total"))
    seen = errors.groupBy("type", "src_file").agg(F.min("seq").alias("first_seq"))
    files = keep_first(seen, ["type"], [F.col("first_seq").asc(), F.col("src_file").asc()], max_files, rank="file_no")
    first = keep_first(errors, ["type", "src_file"], [F.col("seq").asc()], max_lines, rank="_line_no")
    lines = first.groupBy("type", "src_file").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_line_no", "src_line"))), lambda x: x["src_line"]).alias("lines")
    )
    return (
        files.drop("first_seq").join(lines, ["type", "src_file"]).join(totals, "type")
        .select("type", "total", "src_file", "file_no", "lines")
    )


def run_metrics(changes: DataFrame, seconds: float | None = None) -> DataFrame:
    """One row of counts: read, validated, inserted, updated, deleted, skipped, errors, rows per second."""

    def count(action: str):
        return F.count_if(F.col("action") == action).cast("bigint")

    validated = F.count_if(F.col("action").isin("insert", "update", "skip")).cast("bigint")
    rate = (validated / F.lit(seconds)) if seconds else F.lit(None).cast("double")
    return changes.agg(
        F.count_if(F.col("action") != "delete").cast("bigint").alias("read"),
        validated.alias("validated"),
        count("insert").alias("inserted"),
        count("update").alias("updated"),
        count("delete").alias("deleted"),
        count("skip").alias("skipped"),
        count("reject").alias("errors"),
        rate.alias("rows_per_second"),
    )


def observed(changes: DataFrame, name: str):
    """Changes with the same counts collected while they are written: ``(changes, Observation)``."""
    from pyspark.sql import Observation

    watch = Observation(name)
    counts = [
        F.count_if(F.col("action") == a).alias(n)
        for a, n in (("insert", "inserted"), ("update", "updated"), ("delete", "deleted"), ("reject", "errors"))
    ]
    return changes.observe(watch, F.count(F.lit(1)).alias("read"), *counts), watch


def upload_summary(results: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per upload: accepted and failed locations and the first error. Input: ``location, seq``."""
    failed = F.col("location").startswith("error")
    return results.groupBy(*(keys or [])).agg(
        F.count_if(failed).cast("bigint").alias("errors"),
        F.count_if(~failed).cast("bigint").alias("inserted"),
        F.min_by("location", F.when(failed, F.col("seq"))).alias("first_error"),
    )


def aggregate_properties(ops: DataFrame) -> DataFrame:
    """For each observed property its Min, Max and Dev property."""
    kinds = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(d).alias("d"), F.lit(i).alias("ord")) for i, (n, d) in enumerate(DERIVED)])
    return ops.select("*", F.explode(kinds).alias("k")).select(
        F.col("op_id").alias("base_op_id"),
        F.col("k.ord").alias("ord"),
        F.concat("name", F.lit(" "), "k.n").alias("name"),
        F.col("definition"),
        F.concat("description", F.lit(" "), "k.d").alias("description"),
    )


def aggregate_catalog(datastreams: DataFrame) -> DataFrame:
    """The hourly and daily streams of each datastream, each pointing at the one it aggregates.

    ``kind, ds_id, level, name, description, aggregate_for, op_names, uoms``. Input carries
    ``ds_id, name, description, op_name, uom_symbol``.
    """
    hourly = stable_id(F.lit("hourly"), F.col("ds_id"))
    chain = [F.concat(F.lit("/Datastreams("), F.col("ds_id"), F.lit(")")), F.concat(F.lit("/MultiDatastreams("), hourly, F.lit(")"))]
    levels = F.array(
        *[
            F.struct(
                F.lit(level).alias("level"),
                stable_id(F.lit(level), F.col("ds_id")).alias("mds_id"),
                F.concat("name", F.lit(" " + suffix)).alias("name"),
                F.concat("description", F.lit(" " + text)).alias("description"),
                source.alias("aggregate_for"),
            )
            for (level, suffix, text, _), source in zip(LEVELS, chain)
        ]
    )
    names = F.array("op_name", *[F.concat("op_name", F.lit(" " + n)) for n, _ in DERIVED])
    return datastreams.select("*", F.explode(levels).alias("l")).select(
        F.lit("M").alias("kind"),
        F.col("l.mds_id").alias("ds_id"),
        F.col("ds_id").alias("base_ds_id"),
        "l.level",
        F.col("l.name").alias("name"),
        F.col("l.description").alias("description"),
        "l.aggregate_for",
        names.alias("op_names"),
        F.array_repeat("uom_symbol", 4).alias("uoms"),
    )


def rollup(observations: DataFrame, level: str) -> DataFrame:
    """Mean, minimum, maximum and deviation per datastream and hour or day.

    Partial aggregation: at most one row per task, stream and window is shuffled.
    """
    unit = {name: unit for name, _, _, unit in LEVELS}[level]
    value = F.col("result_num").cast("double")
    start = F.date_trunc(unit, "phen_start")
    return observations.groupBy(*STREAM_KEY, start.alias("phen_start")).agg(
        F.avg(value).alias("mean"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.stddev_samp(value).alias("dev"),
        F.count(value).alias("n"),
    )


def rollup_vector(rolled: DataFrame, level: str) -> DataFrame:
    """Roll-up rows as vector observations of the aggregate streams."""
    unit = {name: unit for name, _, _, unit in LEVELS}[level]
    length = F.make_dt_interval(F.lit(1)) if unit == "day" else F.make_dt_interval(F.lit(0), F.lit(1))
    return rolled.select(
        F.lit("M").alias("kind"),
        stable_id(F.lit(level), F.col("ds_id")).alias("ds_id"),
        "phen_start",
        (F.col("phen_start") + length).alias("phen_end"),
        F.lit("array").alias("result_kind"),
        F.transform(F.array("mean", "min", "max", "dev"), lambda x: x.cast("string")).alias("result_arr"),
    )
