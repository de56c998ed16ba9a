"""A described ingest job composed from the operators: read, convert, validate, change set."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial, reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions.templates import template
from gaugeflow.model import TIME_KEY, stable_id
from gaugeflow.operators import aggregate, apply, convert, lookup, validate
from gaugeflow.session import stage
from gaugeflow.sources import records


def _records(spark: SparkSession, spec: Mapping[str, Any]) -> DataFrame:
    options = {k: spec[k] for k in ("delimiter", "tab", "header", "comment", "charset", "multiline") if k in spec}
    if options.get("charset") == "detect":
        options.pop("charset")
        rows = records.read_detected(spark, spec["paths"], **options)
    else:
        rows = records.read_records(spark, spec["paths"], **options)
    if spec.get("strip_nulls", True):
        rows = records.strip_nulls(rows, records.data_columns(rows))
    skip, limit = spec.get("skip", 0), spec.get("limit", 0)
    if not (spec.get("ordered", True) or skip or limit):
        return rows.withColumnRenamed("row_id", "seq")
    return records.take_rows(rows, skip, limit)


def validators_of(specs, tables) -> list:
    """The validators of a job in the order given."""
    out = []
    for spec in specs:
        kind = spec["type"]
        if kind == "all":
            out.append(validate.validate_all)
        elif kind in ("after", "before"):
            fn = validate.validate_after if kind == "after" else validate.validate_before
            out.append(partial(fn, now=spec["now"], days=spec.get("days", 1), minutes=spec.get("minutes", 0)))
        elif kind == "interval":
            out.append(partial(validate.validate_interval, period=spec["period"]))
        elif kind == "newer":
            out.append(partial(validate.validate_newer, target=tables["observations"]))
        elif kind == "by_time":
            options = {k: spec[k] for k in ("update", "report_superseded") if k in spec}
            out.append(validate.asking(partial(validate.validate_by_time, target=tables["observations"], **options)))
        elif kind == "by_parameters":
            options = {k: spec[k] for k in ("names", "check_time", "update") if k in spec}
            out.append(validate.asking(partial(validate.validate_by_parameters, target=tables["observations"], **options)))
        else:
            raise ValueError(f"unknown validator {kind!r}")
    return out


def change_set(rows: DataFrame, validators, tables: Mapping[str, DataFrame], staged: bool = True) -> DataFrame:
    """Change rows of converted observations (``reason`` set where they failed already)."""
    rows = rows.withColumn("obs_id", F.lit(None).cast("string"))
    if "result_arr" not in rows.columns:
        rows = rows.withColumn("result_arr", F.lit(None).cast("array<string>"))
    steps = validators_of(validators, tables)
    # Parsed once; the time bound, the comparison and the reports all read this table.
    changes = validate.validate_in_order(rows, steps, (lambda df: stage(df, "ingest")) if staged else lambda df: df)
    if not any(getattr(s, "asks_target", False) for s in steps):
        # Nothing makes the time a key here, so the record itself is part of the id.
        source = [c for c in ("src_file", "seq") if c in rows.columns]
        changes = changes.withColumn("obs_id", F.when(F.col("action") == "insert", stable_id(*TIME_KEY, *source)))
    if any(v["type"] == "by_time" and v.get("delete_duplicates") for v in validators):
        gone = validate.find_duplicates(tables["observations"], changes.filter(F.col("action") != "reject"))
        changes = changes.unionByName(
            gone.select(F.lit("delete").alias("action"), F.lit("Duplicate").alias("reason"), *gone.columns),
            allowMissingColumns=True,
        )
    return changes


def results(changes: DataFrame, spec: Mapping[str, Any], tables: Mapping[str, DataFrame], dry_run: bool) -> dict[str, DataFrame]:
    """What a job gives for its change rows; these are stored once if several outputs read them."""
    if not dry_run and spec.get("stage", True):
        changes = stage(changes, "changes")
    out = {"changes": changes, "metrics": aggregate.run_metrics(changes)}
    if {"src_file", "src_line", "seq"} <= set(changes.columns):
        errors = changes.filter(F.col("action") == "reject")
        out["errors"] = aggregate.error_summary(errors.select(F.col("reason").alias("type"), "src_file", "src_line", "seq"))
    if not dry_run:
        out["observations"] = apply.apply_changes(tables["observations"], changes)
        batch = spec.get("uploader", {}).get("max_batch", 1000)
        out["data_arrays"] = apply.to_data_arrays(changes.filter(F.col("action") == "insert"), batch)
    return out


def _parents(spec: Mapping[str, Mapping[str, str]], columns, tables: Mapping[str, DataFrame]):
    """Function that attaches the thing, sensor and observed property the record's cells name."""
    dims = {"thing": "things", "sensor": "sensors", "property": "observed_properties"}
    frames = [tables[name] for name in dims.values()]
    on = [
        {k: template(t, columns).try_cast(frame.schema[k].dataType) for k, t in spec[part].items()}
        for part, frame in zip(dims, frames, strict=True)
    ]
    return lambda df: lookup.resolve_parents(df, *frames, *on)


def generate(
    rows: DataFrame, spec: Mapping[str, Any], converters: list[convert.Converter], texts: list, tables: Mapping[str, DataFrame]
) -> DataFrame | None:
    """Datastreams for the keys no datastream has, for every converter that has ``generate`` texts.

    Converters that look up by the same columns and describe their datastreams alike share one pass over the
    records; what one group creates the next one knows. A key whose parents are missing or ambiguous is returned
    with ``parent_error`` and without an id.
    """
    columns, known, made = records.data_columns(rows), tables["datastreams"], []
    groups: dict[tuple, list[convert.Converter]] = {}
    for converter, own in zip(converters, texts, strict=True):
        if own and converter.keys:
            groups.setdefault((tuple(sorted(converter.keys)), tuple(sorted(own.items()))), []).append(converter)
    for (names, own), members in groups.items():
        keys = F.array(
            *[F.struct(F.lit(i).alias("branch"), *[template(c.keys[k], columns).alias(f"key_{k}") for k in names]) for i, c in enumerate(members)]
        )
        named = rows.select(*columns, "seq", F.explode(keys).alias("named")).select(*columns, "seq", "named.*")
        on = {k: F.col(f"key_{k}").try_cast(known.schema[k].dataType) for k in names}
        parents = _parents(spec["parents"], columns, tables) if spec.get("parents") else None
        new = stage(lookup.generate_datastreams(named, known, on, dict(own), parents, F.struct("seq", "branch")), "generated")
        made.append(new)
        usable = [c for c in new.columns if c in known.columns]
        known = known.unionByName(new.filter(F.col("ds_id").isNotNull()).select(*usable), allowMissingColumns=True)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), made) if made else None


def convert_records(
    spark: SparkSession, rows: DataFrame, spec: Mapping[str, Any], tables: Mapping[str, DataFrame]
) -> tuple[DataFrame, DataFrame | None]:
    """Observations (with ``reject``) and the datastreams generated for unknown keys."""
    described = [dict(c) for c in spec["converters"]]
    texts = [c.pop("generate", spec.get("generate")) for c in described]
    converters = [convert.Converter(**c) for c in described]
    by_index = spec.get("by", "name") == "index"
    datastreams = tables.get("datastreams")
    generated = generate(rows, spec, converters, texts, tables) if any(texts) else None
    if generated is not None:
        usable = [c for c in generated.columns if c in datastreams.columns]
        new = generated.filter(F.col("ds_id").isNotNull()).select(*usable)
        datastreams = datastreams.unionByName(new, allowMissingColumns=True)
    if len(converters) == 1:
        fn = convert.to_observations_by_index if by_index else convert.to_observations_by_name
        return fn(rows, converters[0], datastreams), generated
    return convert.fan_out(rows, converters, datastreams, by_index), generated


def run_ingest(
    spark: SparkSession, spec: Mapping[str, Any], tables: Mapping[str, DataFrame], dry_run: bool = False
) -> dict[str, DataFrame]:
    """Run a described job.

    ``spec``: ``importer`` (scan options, ``converters``, optional ``generate`` texts for all converters or in
    single ones, optional ``parents``: templates for the keys of ``thing``, ``sensor`` and ``property``),
    ``validator`` (list, in order) and ``uploader``. ``tables``: ``datastreams`` and ``observations``, for parents
    also ``things``, ``sensors`` and ``observed_properties``.
    Gives ``changes``, ``errors``, ``metrics``, ``generated`` and, unless it is a dry run,
    ``observations`` (the new table) and ``data_arrays``. No target is written by this function;
    unless ``stage`` is false it puts the converted records into the shared staging folder.
    ``importer.ordered=False`` skips the line numbering when neither lines nor file order matter.
    """
    importer = spec["importer"]
    converted, generated = convert_records(spark, _records(spark, importer), importer, tables)
    rows = converted.withColumnRenamed("reject", "reason")
    rows = rows.filter(~F.col("reason").eqNullSafe("Missing value"))
    changes = change_set(rows, spec.get("validator", []), tables, spec.get("stage", True))
    out = results(changes, spec, tables, dry_run)
    if generated is not None:
        out["generated"] = generated
    return out
