"""Sinks: apply a change set, group observations into upload batches, copy between stores."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.model import RESULT_COLUMNS, STREAM_KEY
from gaugeflow.operators.lookup import match_by_name
from gaugeflow.operators.skew import keep_one, positions, salted_lookup


# Columns that describe one thing together: an update that sets one of them replaces all.
_TOGETHER = (RESULT_COLUMNS, ["phen_start", "phen_end"], ["valid_start", "valid_end"])


def apply_changes(target: DataFrame, changes: DataFrame, dry_run: bool = False) -> DataFrame:
    """The new table: deleted rows leave it, inserts enter it, updates replace the fields they set.

    A field an update lacks, or has as NULL, keeps its stored value; result, time and valid time are replaced
    as a whole. Several changes of one id count as the last write by ``seq``. ``phen_date``, where the table has
    it, follows the time. A dry run gives the counts per action instead. Applying the same changes twice
    changes nothing. Both sides are shuffled once, by id.
    """
    if dry_run:
        return changes.groupBy("action").agg(F.count(F.lit(1)).alias("n"))
    present = [f for f in target.schema.fields if f.name in changes.columns and f.name not in ("obs_id", "phen_date")]
    wanted = changes.filter(F.col("action").isin("insert", "update", "delete")).select(
        F.col("obs_id").cast(target.schema["obs_id"].dataType).alias("_id"),
        "action",
        *([F.col("seq").alias("_seq")] if "seq" in changes.columns else []),
        F.struct(F.lit(1).alias("_"), *[F.col(f.name).cast(f.dataType).alias(f.name) for f in present]).alias("_new"),
    )
    order = [F.col("action") == "delete", *([F.col("_seq").desc_nulls_last()] if "seq" in changes.columns else [])]
    wanted = keep_one(wanted, ["_id"], *order).drop("_seq")
    old = target.select("obs_id", F.struct(*[F.col(f.name) for f in target.schema.fields]).alias("_old"))
    joined = old.join(wanted, F.col("obs_id") == F.col("_id"), "full_outer").filter(~F.col("action").eqNullSafe("delete"))
    names = {f.name for f in present}
    group = {c: [m for m in g if m in names] for g in _TOGETHER for c in g}

    def field(name: str) -> Column:
        if name == "obs_id":
            return F.coalesce("_old.obs_id", "_id")
        stored = F.col("_old").getField(name)
        if name not in names:
            return stored
        set_by = group.get(name, [name])
        is_set = reduce(or_, [F.col("_new").getField(c).isNotNull() for c in set_by])
        return F.when(F.col("action").isNotNull() & is_set, F.col("_new").getField(name)).otherwise(stored)

    out = joined.select(*[field(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields])
    if "phen_date" in target.columns:
        day = F.to_date("phen_start").cast(target.schema["phen_date"].dataType)
        out = out.withColumn("phen_date", day)
    return out


def write_snapshot(observations: DataFrame, path: str) -> str:
    """Write a table partitioned by day, the column later runs prune by."""
    daily = observations.withColumn("phen_date", F.to_date("phen_start"))
    # Rebalancing lets adaptive execution cut a busy day into several files and join quiet days.
    daily.hint("rebalance", "phen_date").sortWithinPartitions("phen_date", "ds_id", "phen_start").write.partitionBy(
        "phen_date"
    ).parquet(path)
    return path


_JSON_NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"

# Optional observation fields and the name each has in an upload.
_OPTIONAL = {
    "phenomenonTime": "phen_start",
    "resultTime": "result_time",
    "resultQuality": "result_quality",
    "parameters": "parameters",
    "validTime": "valid_start",
    "featureOfInterest": "foi_id",
}


def to_data_arrays(changes: DataFrame, max_batch: int = 1000) -> DataFrame:
    """Observations per datastream in batches of at most ``max_batch``:
    ``kind, ds_id, batch, components, n, data_array`` (JSON).

    The components are the result plus each optional field that some row of the batch has. Numbers stay
    numbers, vectors become arrays and parameters objects; other values are texts, absent ones null.
    """
    numbered = positions(changes, STREAM_KEY, "seq", "_pos")
    batch = F.floor((F.col("_pos") - 1) / F.lit(max_batch)).cast("bigint")
    optional = {n: c for n, c in _OPTIONAL.items() if c in changes.columns}
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

    def span(first: str, last: str):
        start, end = F.date_format(first, iso), F.date_format(last, iso)
        return F.when(F.col(last).isNull(), start).otherwise(F.concat_ws("/", start, end))

    def text(value: Column) -> Column:
        """A text as JSON: the only element of an array, without its brackets."""
        return F.regexp_extract(F.to_json(F.array(value)), r"(?s)^\[(.*)\]$", 1)

    def number(value: Column) -> Column:
        return value.rlike(_JSON_NUMBER)

    vector = F.transform("result_arr", lambda v: F.when(v.isNull(), "null").when(number(v), v).otherwise(text(v)))
    single = F.coalesce("result_text", F.col("result_num").cast("string"))
    is_number = F.col("result_num").isNotNull() & number(single)
    result = F.when(F.col("result_arr").isNotNull(), F.concat(F.lit("["), F.array_join(vector, ","), F.lit("]"))).when(
        is_number, single
    )
    rendered = {"result": result.otherwise(text(single))}
    for name, column in optional.items():
        if name == "phenomenonTime":
            rendered[name] = text(span("phen_start", "phen_end"))
        elif name == "validTime":
            rendered[name] = text(span("valid_start", "valid_end"))
        elif name == "resultTime":
            rendered[name] = text(F.date_format("result_time", iso))
        elif name == "parameters":
            rendered[name] = F.to_json("parameters")
        else:
            rendered[name] = text(F.col(column).cast("string"))
    flags = [F.bool_or(F.col(c).isNotNull()).alias(f"_has_{n}") for n, c in optional.items()]
    grouped = numbered.groupBy(*STREAM_KEY, batch.alias("batch")).agg(
        F.count(F.lit(1)).alias("n"),
        F.array_sort(
            F.collect_list(F.struct(F.col("_pos").alias("pos"), *[v.alias(k) for k, v in rendered.items()]))
        ).alias("_rows"),
        *flags,
    )
    names = F.array(F.lit("result"), *[F.when(F.col(f"_has_{n}"), F.lit(n)) for n in optional])
    components = F.array_compact(names)
    cells = F.transform(
        "_rows",
        lambda r: F.transform(
            F.filter(
                F.array(
                    F.struct(F.lit(True).alias("on"), r["result"].alias("v")),
                    *[F.struct(F.col(f"_has_{n}").alias("on"), r[n].alias("v")) for n in optional],
                ),
                lambda c: c["on"],
            ),
            lambda c: F.when(c["v"] != "", c["v"]).otherwise("null"),
        ),
    )
    rows = F.transform(cells, lambda r: F.concat(F.lit("["), F.array_join(r, ","), F.lit("]")))
    data = F.concat(F.lit("["), F.array_join(rows, ","), F.lit("]"))
    return grouped.select(*STREAM_KEY, "batch", components.alias("components"), "n", data.alias("data_array"))


def copy_observations(
    observations: DataFrame,
    src_datastreams: DataFrame,
    tgt_datastreams: DataFrame,
    min_time,
    end_time,
    days_per_batch: int = 30,
) -> DataFrame:
    """Source observations re-pointed to the target datastream of the same name.

    Times from ``min_time`` up to ``end_time`` are copied in full; ``slice`` is the number of the
    ``days_per_batch`` window they fall into. Streams without a single match are rejects.
    """
    first = F.lit(min_time).cast("timestamp")
    window = observations.filter(
        (F.col("phen_start") >= first) & (F.col("phen_start") < F.lit(end_time).cast("timestamp"))
    )
    names = match_by_name(src_datastreams, tgt_datastreams, "ds_id", "ds_id")
    matched = names.select("ds_id", F.col("target_id"), F.col("status"))
    joined = salted_lookup(window, matched, ["ds_id"], "obs_id")
    step = days_per_batch * 86_400_000_000
    number = F.floor((F.unix_micros("phen_start") - F.unix_micros(first)) / F.lit(step)).cast("bigint")
    ok = F.col("status") == "ok"
    rest = [c for c in observations.columns if c != "ds_id"]
    return joined.select(
        F.when(F.coalesce(ok, F.lit(False)), "copy").otherwise("reject").alias("action"),
        F.when(F.coalesce(ok, F.lit(False)), F.lit(None))
        .otherwise(F.concat(F.lit("Datastream "), F.coalesce("status", F.lit("not_found"))))
        .alias("reason"),
        F.col("ds_id").alias("source_ds_id"),
        F.col("target_id").alias("ds_id"),
        number.alias("slice"),
        *rest,
    )


def in_source_order(copied: DataFrame) -> DataFrame:
    """Ordered by stream and time for writing; range partitioning also cuts very long streams."""
    order = ["ds_id", "phen_start"]
    return copied.repartitionByRange(*order).sortWithinPartitions(*order)
