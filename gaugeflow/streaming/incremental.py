"""Repeated ingest as a stream: each new set of files is validated against what is stored."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.model import OBSERVATIONS, observations
from gaugeflow.operators import days
from gaugeflow.operators.skew import keep_one
from gaugeflow.operators.validate import validate_by_time
from gaugeflow.session import delete_path, discard, path_exists, stage


def _log(table_dir: str) -> str:
    return f"{table_dir.rstrip('/')}/log"


def _held(spark: SparkSession, table_dir: str, base: DataFrame | None) -> tuple[DataFrame, int]:
    """The folded part of the table and the last batch it contains: the days, or ``base`` before the first ``compact``."""
    root = table_dir.rstrip("/")
    if days.has_pointer(spark, root):
        pointer = days.read_pointer(spark, root)
        return days.read_days(spark, root, OBSERVATIONS, pointer), pointer.folded
    return (spark.createDataFrame([], OBSERVATIONS) if base is None else base), -1


def _logged(spark: SparkSession, table_dir: str, after: int) -> DataFrame:
    """The batches written after the high-water mark; older ones are not even listed for reading."""
    log = spark.read.schema(f"{OBSERVATIONS}, batch bigint").option("basePath", _log(table_dir))
    return log.parquet(_log(table_dir)).filter(F.col("batch") > after)


def _versions(spark: SparkSession, table_dir: str, base: DataFrame | None, before: int | None, since=None) -> DataFrame:
    """All versions of the observations that a batch may look at, with the ``batch`` that wrote them.

    ``since`` prunes by time where the files are read: by day in the folded part, by row group in the log.
    """
    held, folded = _held(spark, table_dir, base)
    if since is not None and "phen_date" in held.columns:
        held = held.filter(F.col("phen_date") >= F.to_date(F.lit(since)))
    versions = observations(held).withColumn("batch", F.lit(-1).cast("bigint"))
    if path_exists(spark, _log(table_dir)):
        written = _logged(spark, table_dir, folded)
        versions = versions.unionByName(written if before is None else written.filter(F.col("batch") < before))
    return versions if since is None else versions.filter(F.col("phen_start") >= F.lit(since))


def current(spark: SparkSession, table_dir: str, base: DataFrame | None = None) -> DataFrame:
    """The observations as of now: the newest version of each id.

    The log holds only what each batch inserted or updated, so a batch costs what it changes and not
    the size of the table. ``compact`` folds it into the days of the table.
    """
    return keep_one(_versions(spark, table_dir, base, None), ["obs_id"], F.col("batch").desc()).drop("batch")


def _batches(spark: SparkSession, table_dir: str, after: int) -> list[int]:
    if not path_exists(spark, _log(table_dir)):
        return []
    return sorted(r["batch"] for r in _logged(spark, table_dir, after).select("batch").distinct().collect())


def _first_number(spark: SparkSession, table_dir: str, checkpoint: str) -> int:
    """The number of a stream's batch 0, kept beside the log for as long as its checkpoint lives."""
    record = f"{table_dir.rstrip('/')}/streams/{hashlib.sha256(checkpoint.encode()).hexdigest()}"
    if not (path_exists(spark, checkpoint) and path_exists(spark, record)):
        folded = days.read_pointer(spark, table_dir.rstrip("/")).folded if days.has_pointer(spark, table_dir.rstrip("/")) else -1
        start = max([folded, *_batches(spark, table_dir, folded)]) + 1
        spark.createDataFrame([(start,)], "first bigint").coalesce(1).write.mode("overwrite").parquet(record)
    return spark.read.schema("first bigint").parquet(record).first()[0]


def run_incremental(
    spark: SparkSession,
    source_dir: str,
    schema: str,
    to_observations: Callable[[DataFrame], DataFrame],
    table_dir: str,
    checkpoint: str,
    base: DataFrame | None = None,
    max_files_per_trigger: int | None = None,
    update: bool = True,
    source_format: str = "parquet",
) -> None:
    """Process all files not yet seen, then stop; call again for the next run.

    Each micro-batch is validated against the table as it was before the batch and writes its
    inserts and updates below its own batch number, replacing them when the batch is repeated. A batch that
    ``compact`` has folded already finds all its rows stored when it is repeated. Numbers go on where the log
    ended when a stream starts with a new checkpoint.
    """
    first = _first_number(spark, table_dir, checkpoint)
    reader = spark.readStream.format(source_format).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        incoming = stage(observations(to_observations(batch)), "stream-batch")
        number = first + batch_id
        path = f"{_log(table_dir)}/batch={number}"
        # An update keeps its time, so versions before the batch's first time can't matter.
        since = incoming.agg(F.min("phen_start")).first()[0]
        if since is None:  # nothing to compare: still leave the batch's (empty) log entry
            incoming.write.mode("overwrite").parquet(path)
        else:
            stored = _versions(batch.sparkSession, table_dir, base, number, since)
            changes = validate_by_time(incoming, stored, update, prune=False, version="batch")
            kept = observations(changes.filter(F.col("action").isin("insert", "update")))
            kept.sortWithinPartitions("phen_start").write.mode("overwrite").parquet(path)
        discard(incoming)

    query = (
        reader.load(source_dir)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def compact(spark: SparkSession, table_dir: str, base: DataFrame | None = None, drop: bool = False) -> days.Pointer:
    """Fold the log into the table's days, reading and writing only the days the log touches.

    The new days, and with them the high-water mark up to which the log is folded, count from the moment their
    pointer is written; a run that dies before leaves everything as it was. ``base`` is folded in the first time and
    not read after that. ``drop`` deletes the folded batches and the days they replaced, which no reader may be using.
    """
    root = table_dir.rstrip("/")
    first = not days.has_pointer(spark, root)
    before = None if first else days.read_pointer(spark, root)
    after = -1 if first else before.folded
    batches = _batches(spark, table_dir, after)
    if first:
        return days.create_days(current(spark, table_dir, base), root, batches[-1] if batches else -1)
    if not batches:
        return before
    log = _logged(spark, table_dir, after)
    newest = stage(keep_one(log, ["obs_id"], F.col("batch").desc()).withColumn("action", F.lit("update")).drop("batch"), "folded")
    # Updates keep their time, so a changed row's day is the day of its stored version.
    pointer = days.apply_by_day(spark, root, newest, OBSERVATIONS, before, same_time=True, folded=batches[-1])
    discard(newest)
    if drop:
        for batch in batches:
            delete_path(spark, f"{_log(table_dir)}/batch={batch}")
        days.retire(spark, root, [before])
    return pointer


def stream_dedupe(df: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """First row per key within a lateness bound; works on streams."""
    timed = df.withColumn(time, F.col(time).cast("timestamp"))
    return timed.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)
