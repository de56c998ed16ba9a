"""A stored table by day: changes read and rewrite the days they touch, and nothing else.

Below ``root``, ``days/gen=.../phen_date=...`` holds each writing of a day and ``pointer/v=...`` one small file per version
of the table that says which writing of each day counts. A change writes new folders for its days and then the
next pointer; until that file is there, and for everybody who reads an earlier version, nothing has changed.
A pointer also carries ``folded``, the last batch of a stream's log that the days contain. ``retire`` deletes what the
newest version no longer names.

One job at a time writes a table. Only pointers reach the driver: one row per day.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugeflow.model import OBSERVATIONS
from gaugeflow.operators.apply import apply_changes
from gaugeflow.session import delete_path, path_exists

POINTER = "phen_date date, gen string, folded bigint"
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"  # Fixed value: the folder of rows without a time

Day = dt.date | None


class Pointer:
    """One version of a table: the folder of each day and the last batch folded into it."""

    def __init__(self, version: int, days: dict[Day, str], folded: int):
        self.version, self.days, self.folded = version, days, folded


def has_pointer(spark: SparkSession, root: str) -> bool:
    return path_exists(spark, f"{root}/pointer")


def read_pointer(spark: SparkSession, root: str, version: int | None = None) -> Pointer:
    """The given version of a table, or the newest."""
    rows = spark.read.schema(f"{POINTER}, v bigint").parquet(f"{root}/pointer")
    number = rows.agg(F.max("v")).first()[0] if version is None else version
    found = rows.filter(F.col("v") == number).collect()
    return Pointer(number, {r["phen_date"]: r["gen"] for r in found if r["gen"]}, max(r["folded"] for r in found))


def _write_pointer(spark: SparkSession, root: str, pointer: Pointer) -> None:
    rows = [(day, gen, pointer.folded) for day, gen in pointer.days.items()] + [(None, None, pointer.folded)]
    # A single file: it is there or it isn't.
    spark.createDataFrame(rows, POINTER).coalesce(1).write.parquet(f"{root}/pointer/v={pointer.version}")


def _write_rows(rows: DataFrame, root: str) -> tuple[str, list[Day]]:
    """Write rows by day into a folder of their own; gives its name and the days in it."""
    gen = f"g{uuid.uuid4().hex}"
    folder = f"{root}/days/gen={gen}"
    daily = rows.withColumn("phen_date", F.to_date("phen_start"))
    # Rebalancing lets adaptive execution cut a busy day into several files and join quiet days.
    ordered = daily.hint("rebalance", "phen_date").sortWithinPartitions("phen_date", "ds_id", "phen_start")
    ordered.write.partitionBy("phen_date").parquet(folder)
    written = rows.sparkSession.read.schema("phen_date date").option("basePath", folder).parquet(folder)
    return gen, [r["phen_date"] for r in written.select("phen_date").distinct().collect()]


def create_days(rows: DataFrame, root: str, folded: int = -1) -> Pointer:
    """Write the first version of a table."""
    gen, days = _write_rows(rows.drop("phen_date"), root)
    pointer = Pointer(0, dict.fromkeys(days, gen), folded)
    _write_pointer(rows.sparkSession, root, pointer)
    return pointer


def read_days(
    spark: SparkSession, root: str, schema: str | StructType = OBSERVATIONS, pointer: Pointer | None = None, days: Iterable[Day] | None = None
) -> DataFrame:
    """The table as of a version, or only some of its days, with ``phen_date``."""
    pointer = pointer or read_pointer(spark, root)
    wanted = pointer.days if days is None else {d: pointer.days[d] for d in days if d in pointer.days}
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = StructType([f for f in fields.fields if f.name not in ("phen_date", "gen")]).add("phen_date", "date").add("gen", "string")
    if not wanted:
        return spark.createDataFrame([], whole).drop("gen")
    paths = [f"{root}/days/gen={gen}/phen_date={_NO_DAY if day is None else day}" for day, gen in wanted.items()]
    return spark.read.schema(whole).option("basePath", f"{root}/days").parquet(*paths).drop("gen")


def touched_days(table: DataFrame, changes: DataFrame, same_time: bool = False) -> list[Day]:
    """Days that a change set reads or writes: those its rows fall into and those its stored rows lie in.

    For the latter only ids and days of the table are scanned. ``same_time`` says that changed rows keep their time, as
    with validators by time; then nothing is scanned.
    """
    real = changes.filter(F.col("action").isin("insert", "update", "delete"))
    days = real.select(F.to_date("phen_start").alias("day"))
    if not same_time:
        kind = table.schema["obs_id"].dataType
        ids = real.filter(F.col("action") != "insert").select(F.col("obs_id").cast(kind).alias("obs_id")).distinct()
        days = days.unionByName(table.select("obs_id", F.col("phen_date").alias("day")).join(ids, "obs_id", "left_semi").select("day"))
    return [r["day"] for r in days.distinct().collect()]


def apply_by_day(
    spark: SparkSession,
    root: str,
    changes: DataFrame,
    schema: str | StructType = OBSERVATIONS,
    pointer: Pointer | None = None,
    same_time: bool = False,
    folded: int | None = None,
) -> Pointer:
    """The next version of a table. ``changes`` is read twice: stage it.

    Rows of the touched days are joined with the changes by id, as ``apply_changes`` states, and written anew;
    all other days stay where they are and are not opened.
    """
    pointer = pointer or read_pointer(spark, root)
    days = touched_days(read_days(spark, root, schema, pointer), changes, same_time)
    kept = {day: gen for day, gen in pointer.days.items() if day not in days}
    if days:
        new = apply_changes(read_days(spark, root, schema, pointer, days), changes)
        gen, written = _write_rows(new.drop("phen_date"), root)
        kept |= dict.fromkeys(written, gen)
    latest = read_pointer(spark, root).version
    following = Pointer(latest + 1, kept, pointer.folded if folded is None else folded)
    _write_pointer(spark, root, following)
    return following


def retire(spark: SparkSession, root: str, older: Iterable[Pointer]) -> None:
    """Delete the days that only the given earlier versions name, and their pointers. Nobody may read these any more."""
    newest = read_pointer(spark, root)
    live = set(newest.days.items())
    for pointer in older:
        if pointer.version == newest.version:
            continue
        for day, gen in pointer.days.items():
            if (day, gen) not in live:
                delete_path(spark, f"{root}/days/gen={gen}/phen_date={_NO_DAY if day is None else day}")
        delete_path(spark, f"{root}/pointer/v={pointer.version}")
