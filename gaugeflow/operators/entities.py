"""Entity reconciliation: find or create, and what has to change in the ones that exist."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions import props
from gaugeflow.functions.values import after_last_slash
from gaugeflow.model import stable_id
from gaugeflow.operators.skew import keep_one, salted_lookup


def reconcile(
    incoming: DataFrame,
    existing: DataFrame,
    on: Sequence[str],
    id_col: str,
    compare: Sequence[str],
    properties: bool = True,
    depth: int = 5,
    create_only: Sequence[str] = (),
    keep_when_null: Sequence[str] = (),
    order: str = "seq",
) -> DataFrame:
    """Change rows for entities: ``action, reason, <on>, <id_col>, changed, <values>``.

    No match inserts with a key-derived id, one match updates when a compared field or a property
    differs, several matches are rejected. Of several incoming rows with one key the last counts.
    ``create_only`` fields are set on insert and kept on update; ``keep_when_null`` fields keep the
    stored value when the incoming one is NULL.
    """
    fields = [*compare, *create_only, *(["properties"] if properties else [])]
    latest = keep_one(incoming, on, F.col(order).desc())
    stored = existing.groupBy(*on).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min_by(F.struct(id_col, *fields), F.col(id_col)).alias("_s"),
    )
    joined = latest.join(
        stored.select(*[F.col(k).alias(f"_s_{k}") for k in on], "_n", "_s"),
        on=[latest[k].eqNullSafe(F.col(f"_s_{k}")) for k in on],
        how="left",
    )
    found = F.col("_n") == 1

    def stored_value(name: str) -> Column:
        return F.col("_s").getField(name)

    changed: list[Column] = []
    values: list[Column] = []
    for name in compare:
        new = F.coalesce(F.col(name), stored_value(name)) if name in keep_when_null else F.col(name)
        changed.append(F.when(found & ~new.eqNullSafe(stored_value(name)), F.lit(name)))
        values.append(new.alias(name))
    for name in create_only:
        values.append(F.when(found, stored_value(name)).otherwise(F.col(name)).alias(name))
    if properties:
        merged = props.merge_properties(stored_value("properties"), F.col("properties"), depth)
        changed.append(F.when(found & merged["changed"], F.lit("properties")))
        values.append(F.when(found, merged["properties"]).otherwise(F.col("properties")).alias("properties"))
    with_changes = joined.withColumn("_changed", F.array_compact(F.array(*changed)))
    action = (
        F.when(F.col("_n").isNull(), "insert")
        .when(F.col("_n") > 1, "reject")
        .when(F.size("_changed") > 0, "update")
        .otherwise("skip")
    )
    return with_changes.select(
        action.alias("action"),
        F.when(F.col("_n") > 1, "More than one entity found").alias("reason"),
        *[F.col(k) for k in on if k not in fields],
        F.when(F.col("_n").isNull(), stable_id(*on)).when(found, stored_value(id_col).cast("string")).alias(id_col),
        F.when(found, F.col("_changed")).alias("changed"),
        *values,
    )


def apply_entities(existing: DataFrame, changes: DataFrame, id_col: str) -> DataFrame:
    """The entity table after the changes of ``reconcile``, in its own columns: one row per id of either side.

    An update replaces the fields the changes carry and keeps the others; rows that were skipped or rejected
    change nothing. Both sides are shuffled once, by id.
    """
    carried = [c for c in existing.columns if c in changes.columns and c != id_col]
    made = changes.filter(F.col("action").isin("insert", "update")).select(
        F.col(id_col).cast(existing.schema[id_col].dataType).alias("_id"), F.struct(*carried).alias("_new")
    )
    old = existing.select(id_col, F.struct(*[c for c in existing.columns if c != id_col]).alias("_old"))
    joined = old.join(made, F.col(id_col) == F.col("_id"), "full_outer")

    def field(name: str) -> Column:
        if name == id_col:
            return F.coalesce(id_col, "_id").alias(name)
        stored = F.col("_old").getField(name)
        if name in carried:
            new = F.col("_new").getField(name).cast(existing.schema[name].dataType)
            return F.when(F.col("_new").isNotNull(), new).otherwise(stored).alias(name)
        return stored.alias(name)

    return joined.select(*[field(c) for c in existing.columns])


def reconcile_things(incoming: DataFrame, existing: DataFrame, on: Sequence[str] = ("name",), **kw) -> DataFrame:
    """Name, description, properties; the location is added or replaced when one is given."""
    return reconcile(
        incoming, existing, list(on), "thing_id", ["name", "description", "location_id"],
        keep_when_null=["location_id"], **kw,
    )


def reconcile_sensors(incoming: DataFrame, existing: DataFrame, on: Sequence[str] = ("name",), **kw) -> DataFrame:
    return reconcile(incoming, existing, list(on), "sensor_id", ["name", "description", "encoding", "metadata"], **kw)


def reconcile_features(incoming: DataFrame, existing: DataFrame, on: Sequence[str] = ("name",), **kw) -> DataFrame:
    return reconcile(incoming, existing, list(on), "foi_id", ["name", "description", "lon", "lat"], **kw)


def reconcile_properties(incoming: DataFrame, existing: DataFrame, on: Sequence[str] = ("name",), **kw) -> DataFrame:
    """The definition is set on creation only."""
    return reconcile(
        incoming, existing, list(on), "op_id", ["name", "description"], create_only=["definition"], **kw
    )


def reconcile_locations(incoming: DataFrame, existing: DataFrame, on: Sequence[str] = ("name",), **kw) -> DataFrame:
    return reconcile(
        incoming, existing, list(on), "location_id", ["name", "description", "lon", "lat"], depth=10, **kw
    )


def reconcile_datastreams(
    incoming: DataFrame, existing: DataFrame, on: Sequence[str] = ("thing_id", "name"), **kw
) -> DataFrame:
    """Searched within the thing; unit and observed property are re-linked, the sensor is not."""
    return reconcile(
        incoming, existing, list(on), "ds_id", ["name", "description", "uom", "op_id"],
        create_only=["sensor_id"], **kw,
    )


def reconcile_multi(
    incoming: DataFrame, existing: DataFrame, on: Sequence[str] = ("thing_id", "name"), **kw
) -> DataFrame:
    """The lists of units and observed properties are set on creation only."""
    return reconcile(
        incoming, existing, list(on), "ds_id", ["name", "description"], create_only=["uoms", "op_ids"], **kw
    )


def with_main_id(datastreams: DataFrame, key: Sequence[str]) -> DataFrame:
    """Datastreams with ``main_id``: the lowest id of a key stands for all of its datastreams.

    Ids that are numbers compare as numbers and come before others.
    """
    number = F.col("ds_id").cast("string").try_cast("decimal(38,0)")
    rank = F.struct(number.isNull().alias("is_text"), number.alias("n"), F.col("ds_id").alias("id"))
    lowest = datastreams.groupBy(*key).agg(F.min(F.when(F.col("ds_id").isNotNull(), rank)).alias("_low"))
    lowest = lowest.select(*key, F.col("_low.id").alias("main_id"))
    return salted_lookup(datastreams, lowest, list(key), "ds_id", null_safe=list(key))


def merge_datastreams(
    datastreams: DataFrame, observations: DataFrame, key: Sequence[str], name: Column, local_id: Column
) -> tuple[DataFrame, DataFrame]:
    """Changes that merge the duplicates of a key: ``(datastream changes, observation updates)``.

    The canonical datastream gets ``name`` and ``local_id`` added to its list; the others are
    deleted and their observations re-pointed. ``name``/``local_id`` are over the datastream's row.
    """
    joined = with_main_id(datastreams, key)
    is_main = F.col("ds_id") == F.col("main_id")
    ids = props.append_local_id(F.col("local_ids"), local_id)
    differs = (name != F.col("name")) | (ids != F.coalesce("local_ids", F.array().cast("array<string>")))
    changes = joined.select(
        F.when(~is_main, "delete").when(differs, "update").otherwise("skip").alias("action"),
        "ds_id",
        "main_id",
        F.when(is_main, name).otherwise(F.col("name")).alias("name"),
        F.when(is_main, ids).otherwise(F.col("local_ids")).alias("local_ids"),
    )
    moved_ids = joined.filter(F.col("ds_id") != F.col("main_id")).select("ds_id", "main_id")
    moved = salted_lookup(observations, moved_ids, ["ds_id"], "obs_id", how="inner")
    rest = [c for c in observations.columns if c != "ds_id"]
    updates = moved.select(
        F.lit("update").alias("action"), F.col("ds_id").alias("old_ds_id"), F.col("main_id").alias("ds_id"), *rest
    )
    return changes, updates


def backfill_units(datastreams: DataFrame, swe: DataFrame) -> DataFrame:
    """Units from the first data array where a datastream has none; ``unit_set`` marks the changed.

    ``swe`` is the output of ``explode_swe`` with ``ds_id`` and ``seq`` kept.
    """
    named = swe.filter(F.col("unit_href") != "").select(
        "ds_id", "unit_href", F.struct("seq", "pos").alias("_order")
    )
    first = named.groupBy("ds_id").agg(F.min_by("unit_href", "_order").alias("_href"))
    # One row per datastream on both sides.
    joined = datastreams.join(first, "ds_id", "left")
    short = after_last_slash(F.col("_href"))
    unit = F.struct(short.alias("name"), short.alias("symbol"), F.col("_href").alias("definition"))
    missing = F.col("uom").isNull() | F.col("uom.symbol").isNull()
    fill = missing & F.col("_href").isNotNull()
    return joined.select(
        *[F.when(fill, unit).otherwise(F.col("uom")).alias("uom") if c == "uom" else F.col(c) for c in datastreams.columns],
        fill.alias("unit_set"),
    )
