"""Lookups of datastreams and their parents: every distinct key is resolved once, by a join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions import templates
from gaugeflow.functions.props import parameters
from gaugeflow.model import stable_id
from gaugeflow.operators.skew import keep_one, salted_lookup


def _by_key(dim: DataFrame, keys: Sequence[str], carry: Mapping[str, str], order: str, prefix: str = "") -> DataFrame:
    """One row per key of a dimension: match count ``_n`` and the values of its first row."""
    picked = F.min_by(F.struct(*[F.col(c).alias(n) for n, c in carry.items()]), F.col(order))
    grouped = dim.groupBy(*[F.col(k).alias(f"{prefix}{k}") for k in keys]).agg(
        F.count(F.lit(1)).alias("_n"), picked.alias("_p")
    )
    return grouped.select(*[f"{prefix}{k}" for k in keys], "_n", *[F.col(f"_p.{n}").alias(n) for n in carry])


def _status(n: Column) -> Column:
    return F.when(n.isNull(), "not_found").when(n > 1, "ambiguous").otherwise("ok")


def map_datastream(
    df: DataFrame,
    datastreams: DataFrame,
    on: Mapping[str, Column],
    kind: str | None = None,
    strict: bool = False,
    spread: str | Column = "seq",
) -> DataFrame:
    """Attach ``kind, ds_id, ds_uom, ds_status`` by equality of dimension columns with expressions.

    ``ds_status`` is ``ok`` for exactly one match, ``not_found`` or ``ambiguous`` otherwise (no id
    is attached then). ``strict`` makes anything but one match an error of the job.
    """
    dim = datastreams if kind is None else datastreams.filter(F.col("kind") == kind)
    keys = list(on)
    carry = {"kind": "kind", "ds_id": "ds_id", "ds_uom": "uom"}
    resolved = _by_key(dim, keys, carry, "ds_id", prefix="_k_")
    keyed = df.select("*", *[e.cast(datastreams.schema[k].dataType.simpleString()).alias(f"_k_{k}") for k, e in on.items()])
    joined = salted_lookup(keyed, resolved, [f"_k_{k}" for k in keys], spread)
    one = F.col("_n") == 1
    status = _status(F.col("_n"))
    if strict:
        message = F.concat(F.lit("lookup gave no single datastream: "), F.to_json(F.struct(*[f"_k_{k}" for k in keys])))
        status = F.when(F.coalesce(one, F.lit(False)), F.lit("ok")).otherwise(F.raise_error(message).cast("string"))
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[F.when(one, F.col(c)).alias(c) for c in carry],
        status.alias("ds_status"),
    )


def map_fixed(df: DataFrame, datastreams: DataFrame, ds_id: str, kind: str = "D") -> DataFrame:
    """Attach one given datastream to all records; an id that doesn't exist is an error of the job."""
    found = datastreams.filter((F.col("kind") == kind) & (F.col("ds_id") == ds_id)).agg(F.count(F.lit(1)))
    # A scalar subquery: one number, evaluated once.
    exists = found.scalar() >= 1
    checked = F.when(exists, F.lit(ds_id)).otherwise(F.raise_error(F.lit(f"no datastream {kind} {ds_id}")).cast("string"))
    return df.withColumn("kind", F.lit(kind)).withColumn("ds_id", checked)


def unmatched_keys(df: DataFrame, datastreams: DataFrame, on: Mapping[str, Column]) -> DataFrame:
    """The distinct keys no datastream has, with how many records name them."""
    keys = list(on)
    named = df.groupBy(*[e.cast(datastreams.schema[k].dataType).alias(k) for k, e in on.items()]).agg(
        F.count(F.lit(1)).alias("records")
    )
    return named.join(datastreams.select(*keys).distinct(), keys, "left_anti")


def resolve_parents(
    df: DataFrame,
    things: DataFrame,
    sensors: DataFrame,
    ops: DataFrame,
    on_thing: Mapping[str, Column],
    on_sensor: Mapping[str, Column],
    on_op: Mapping[str, Column],
    spread: str | Column = "seq",
) -> DataFrame:
    """Attach ``thing_id, sensor_id, op_id`` and ``parent_error`` (the first missing or ambiguous one)."""
    out, errors = df, []
    for label, dim, id_col, on in (
        ("Thing", things, "thing_id", on_thing),
        ("Sensor", sensors, "sensor_id", on_sensor),
        ("ObservedProperty", ops, "op_id", on_op),
    ):
        keys = list(on)
        prefix = f"_{id_col}_"
        resolved = _by_key(dim, keys, {f"{prefix}id": id_col}, id_col, prefix).withColumnRenamed("_n", f"{prefix}n")
        keyed = out.select("*", *[e.alias(f"{prefix}{k}") for k, e in on.items()])
        joined = salted_lookup(keyed, resolved, [f"{prefix}{k}" for k in keys], spread)
        n = F.col(f"{prefix}n")
        out = joined.select(*[F.col(c) for c in out.columns], F.when(n == 1, F.col(f"{prefix}id")).alias(id_col), n)
        errors.append(F.when(n.isNull(), f"{label} not found").when(n > 1, f"More than one {label}"))
    keep = [c for c in out.columns if not c.endswith("_id_n")]
    return out.select(*keep, F.coalesce(*errors).alias("parent_error"))


def generate_datastreams(
    df: DataFrame,
    existing: DataFrame,
    on: Mapping[str, Column],
    texts: Mapping[str, str],
    parents=None,
    spread: str | Column = "seq",
) -> DataFrame:
    """New datastreams for the keys that none has: one per key, from the first record naming it.

    ``texts`` holds templates for ``name, description, obs_type, properties, uom_name, uom_symbol,
    uom_definition``. ``parents`` is a function adding ``thing_id, sensor_id, op_id, parent_error``
    (see ``resolve_parents``); keys with an error are returned with it and without a ``ds_id``.
    """
    keys = list(on)
    keyed = df.select("*", *[e.alias(f"_k_{k}") for k, e in on.items()])
    key_cols = [f"_k_{k}" for k in keys]
    order = F.col(spread).asc() if isinstance(spread, str) else spread.asc()
    first = keep_one(keyed, key_cols, order)
    known = existing.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    missing = first.join(known, key_cols, "left_anti")
    if parents is not None:
        missing = parents(missing)
    columns = df.columns

    def fill(name: str, mode: str = templates.PLAIN) -> Column:
        return templates.template(texts.get(name, ""), columns, mode, strip_newlines=mode == templates.PLAIN)

    ok = F.col("parent_error").isNull() if parents is not None else F.lit(True)
    parent_cols = ["thing_id", "sensor_id", "op_id"]
    return missing.select(
        *[F.col(c).alias(k) for c, k in zip(key_cols, keys)],
        F.lit("D").alias("kind"),
        F.when(ok, stable_id(*key_cols)).alias("ds_id"),
        fill("name").alias("name"),
        fill("description").alias("description"),
        fill("obs_type").alias("obs_type"),
        F.struct(
            fill("uom_name").alias("name"), fill("uom_symbol").alias("symbol"), fill("uom_definition").alias("definition")
        ).alias("uom"),
        parameters(fill("properties", templates.JSON)).alias("properties"),
        *([F.col(c) for c in (*parent_cols, "parent_error")] if parents is not None else []),
    )


def match_by_name(src: DataFrame, tgt: DataFrame, src_id: str, tgt_id: str, spread: str | None = None) -> DataFrame:
    """Source ids with the target id of the same name: ``<src_id>, name, target_id, status``."""
    resolved = _by_key(tgt, ["name"], {"target_id": tgt_id}, tgt_id)
    joined = salted_lookup(src.select(src_id, "name"), resolved, ["name"], spread or src_id)
    return joined.select(
        src_id, "name", F.when(F.col("_n") == 1, F.col("target_id")).alias("target_id"), _status(F.col("_n")).alias("status")
    )


def entity_index(df: DataFrame, by: str, order: str) -> DataFrame:
    """One entity per key, the last one wins, numbers by value and after texts; entities without that key are left out."""
    number = F.col(order).cast("string").try_cast("decimal(38,0)")
    return keep_one(df.filter(F.col(by).isNotNull()), [by], number.desc_nulls_last(), F.col(order).desc())


HOT_CODE = 10_000
CODE_SALTS = 16


def match_suffix(
    df: DataFrame, things: DataFrame, code: str, local_id: str, equal: Mapping[str, str], min_length: int = 1, hot: int = HOT_CODE
) -> DataFrame:
    """Join on ``local_id`` ending with ``code`` plus equality of the ``equal`` columns.

    Each local id is listed with its endings of the lengths that occur among the codes, so the match is an equality
    join on the ending: only true matches are produced, never all pairs that share a property. Records whose code occurs
    more than ``hot`` times are dealt to ``CODE_SALTS`` cells, and only the things with such an ending go to all of
    these. Empty codes match nothing.
    """
    named = df.filter(F.length(code) >= min_length)
    # Distinct lengths: a scalar of at most as many numbers as the longest code has characters.
    lengths = named.agg(F.collect_set(F.length(code))).scalar()
    keys = [f"_e_{i}" for i in range(len(equal) + 1)]
    counts = named.groupBy(code, *equal).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot)
    counts = counts.select(*[F.col(c).alias(k) for c, k in zip([code, *equal], keys, strict=True)])

    def with_heat(frame: DataFrame, on: Sequence[Column], salts: Column) -> DataFrame:
        keyed = frame.select("*", *[c.alias(f"{k}x") for c, k in zip(on, keys, strict=True)])
        same = reduce(and_, [F.col(f"{k}x") == F.col(k) for k in keys])
        joined = keyed.join(counts.withColumn("_hot", F.lit(True)), same, "left").drop(*keys)
        return joined.withColumn("_salt", F.explode(F.when(F.col("_hot"), salts).otherwise(F.array(F.lit(0)))))

    one = F.array(F.pmod(F.xxhash64(*[c for c, t in df.dtypes if not t.startswith("map")], F.monotonically_increasing_id()), F.lit(CODE_SALTS)).cast("int"))
    left = with_heat(named, [F.col(c) for c in (code, *equal)], one).drop("_hot")
    listed = things.withColumn("_n", F.explode(lengths)).filter(F.col("_n") <= F.length(local_id))
    listed = listed.withColumn("_ending", F.right(F.col(local_id), F.col("_n"))).drop("_n")
    right = with_heat(listed, [F.col("_ending"), *[F.col(c) for c in equal.values()]], F.sequence(F.lit(0), F.lit(CODE_SALTS - 1)))
    right = right.drop("_hot", "_ending").withColumnsRenamed({"_salt": "_r_salt"} | {f"{k}x": f"{k}y" for k in keys})
    condition = reduce(and_, [F.col(f"{k}x") == F.col(f"{k}y") for k in keys]) & (F.col("_salt") == F.col("_r_salt"))
    return left.join(right, condition).drop("_salt", "_r_salt", *[f"{k}{s}" for k in keys for s in "xy"])
