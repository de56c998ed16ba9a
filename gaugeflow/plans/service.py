"""A job over the XML service of a monitoring network: features to entities, requests, responses to observations.

The service is read from landed files. ``reconcile_network`` brings the target's entities up to date, in the order in
which they refer to each other: each new table is stored once and feeds the lookups of the next. ``plan_requests``
says what to fetch for every datastream. ``run_service`` does both, turns the responses that have landed into
observations, fills in units that datastreams lack, and ends like any other job: validators, change set, tables.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions.steps import step
from gaugeflow.operators import bounds, entities, lookup
from gaugeflow.operators.skew import salted_lookup
from gaugeflow.plans.ingest import change_set, results
from gaugeflow.session import stage
from gaugeflow.sources import documents, features, stations

# The element of each feature collection.
TAGS = {
    "stations": ("aqd:AQD_Station", features.STATION),
    "processes": ("aqd:AQD_SamplingPointProcess", features.PROCESS),
    "samples": ("aqd:AQD_Sample", features.SAMPLE),
    "points": ("aqd:AQD_SamplingPoint", features.SAMPLING_POINT),
}
IDS = {
    "observed_properties": "op_id",
    "locations": "location_id",
    "things": "thing_id",
    "sensors": "sensor_id",
    "features": "foi_id",
    "datastreams": "ds_id",
}


def _with_local_id(df: DataFrame) -> DataFrame:
    return df.withColumn("local_id", F.element_at("properties", F.lit("localId")))


def _ordered(df: DataFrame) -> DataFrame:
    """Elements of one local id have no order of their own: their content decides, in every run alike."""
    texts = [F.to_json(c) if t.startswith("map") else F.col(c).cast("string") for c, t in df.dtypes if not t.startswith("struct")]
    return df.withColumn("seq", F.xxhash64(*texts))


class _Tables:
    """The target's entity tables, the changes made to them so far and what was rejected."""

    def __init__(self, tables: Mapping[str, DataFrame]):
        self.tables = {name: _with_local_id(tables[name]) for name in IDS}
        self.changes: dict[str, DataFrame] = {}
        self.rejects: list[DataFrame] = []

    def reject(self, what: str, df: DataFrame) -> None:
        failed = df.filter(F.col("reject").isNotNull())
        self.rejects.append(failed.select(F.lit(what).alias("entity"), "local_id", F.col("reject").alias("reason")))

    def merge(self, name: str, incoming: DataFrame, **how) -> None:
        """Reconcile by local id and let later lookups see the result."""
        existing = self.tables[name]
        known = existing.filter(F.col("local_id").isNotNull())
        changes = stage(entities.reconcile(_ordered(incoming), known, ["local_id"], IDS[name], **how), f"service-{name}")
        self.changes[name] = changes
        self.tables[name] = stage(entities.apply_entities(existing, changes, IDS[name]), f"service-{name}")

    def by_local_id(self, name: str, *columns: str) -> DataFrame:
        """One entity per local id; where the target holds several the highest id stands for it."""
        return lookup.entity_index(self.tables[name], "local_id", IDS[name]).select("local_id", IDS[name], *columns)


def reconcile_network(
    spark: SparkSession, sources: Mapping[str, Any], tables: Mapping[str, DataFrame], owner: str = "", metadata: str = ""
) -> _Tables:
    """Entities of the features in ``sources`` (paths per name of ``TAGS``), merged into the target's tables."""
    # Each element is parsed once, for its row and for its reject.
    parsed = {
        name: stage(features.check_features(spark, path, *TAGS[name]).select("feature", "local_id", "reject"), f"service-{name}-elements")
        for name, path in sources.items()
    }
    read = {name: elements.select("feature.*") for name, elements in parsed.items()}
    held = _Tables(tables)
    for name, elements in parsed.items():
        held.reject(f"{name} element", elements)
    pollutants = stations.pollutant_dim(spark).drop("op_id")
    held.merge("observed_properties", pollutants, compare=["name", "description"], create_only=["definition"])
    if "stations" in read:
        found = stage(features.read_stations(read["stations"], owner, metadata), "service-stations")
        held.reject("station", found)
        good = found.filter(F.col("reject").isNull())
        places = good.select(
            "local_id", "name", F.col("location_description").alias("description"), F.col("location_properties").alias("properties"), "lon", "lat"
        )
        held.merge("locations", places, compare=["name", "description", "lon", "lat"], depth=10)
        # One row per station on both sides.
        things = good.select("local_id", "name", "description", "properties").join(held.by_local_id("locations"), "local_id", "left")
        held.merge("things", things, compare=["name", "description", "location_id"], keep_when_null=["location_id"])
    if "processes" in read:
        sensors = features.read_processes(read["processes"], held.by_local_id("observed_properties"), owner, metadata)
        held.merge("sensors", sensors, compare=["name", "description", "encoding", "metadata"])
    if "samples" in read:
        samples = stage(features.read_samples(read["samples"], owner, metadata), "service-samples")
        held.reject("sample", samples)
        held.merge("features", samples.filter(F.col("reject").isNull()).drop("reject"), compare=["name", "description", "lon", "lat"])
    if "points" in read:
        points = features.read_sampling_points(
            read["points"],
            held.by_local_id("observed_properties", "name"),
            held.by_local_id("sensors"),
            held.by_local_id("things", "name"),
            held.by_local_id("features"),
            held.by_local_id("datastreams", "uom"),
            owner,
            metadata,
        )
        points = stage(points, "service-points")
        held.reject("sampling point", points)
        wanted = points.filter(F.col("reject").isNull()).drop("reject", "foi_missing", "foi_id").withColumn("kind", F.lit("D"))
        held.merge("datastreams", wanted, compare=["name", "description", "uom", "op_id"], create_only=["sensor_id", "thing_id", "kind"])
    return held


def plan_requests(datastreams: DataFrame, observations: DataFrame, now, default, template: str) -> DataFrame:
    """What to fetch: one request per datastream with a local id, from just after what is stored up to now."""
    named = datastreams.filter(F.col("local_id").isNotNull())
    starts = bounds.bound_newer(named, observations, default).join(named.select("kind", "ds_id", "local_id"), ["kind", "ds_id"])
    requests = bounds.request_intervals(starts, now, template, "local_id")
    return requests.join(named.select("kind", "ds_id", "local_id"), ["kind", "ds_id"])


def read_responses(responses: DataFrame, datastreams: DataFrame, foi: DataFrame, fields: Mapping[str, str] | None = None) -> DataFrame:
    """Observations of landed responses ``(local_id, seq, xml)``, with ``reason`` where one fails.

    A response for an unknown datastream or feature gives one row with the reason, a bad block one of its own.
    """
    known = lookup.entity_index(datastreams, "local_id", "ds_id").select("local_id", "kind", "ds_id")
    # A station may have answered for a large share of the requests.
    matched = salted_lookup(responses.select("local_id", "seq", "xml"), known, ["local_id"])
    matched = documents.attach_feature(matched, foi, "local_id")
    failed = F.coalesce(F.when(F.col("ds_id").isNull(), "No Datastream"), F.col("response_reject"))
    checked = step(matched, {"failed": failed}, [c for c in matched.columns if c != "response_reject"])
    # One pass over the responses: a failed one has no text to read and keeps its one row.
    readable = F.when(F.col("failed").isNull(), F.col("xml"))
    rows = documents.explode_swe(checked.withColumn("xml", readable), **(fields or {}))
    rows = rows.withColumn("reason", F.coalesce("failed", "reject"))
    rows = rows.withColumn("unit_href", F.when(F.col("failed").isNull(), F.col("unit_href")))
    number = F.col("seq") * F.lit(1 << 32) + F.coalesce("pos", F.lit(0))
    return rows.select(
        F.lit("D").alias("kind"),
        "ds_id",
        "local_id",
        "phen_start",
        "phen_end",
        F.when(F.col("result_num").isNotNull(), "decimal").alias("result_kind"),
        "result_num",
        F.col("result_num").cast("string").alias("result_text"),
        F.lit(None).cast("array<string>").alias("result_arr"),
        "foi_id",
        "unit_href",
        "point_differs",
        number.alias("seq"),
        "pos",
        "reason",
    )


def run_service(
    spark: SparkSession,
    spec: Mapping[str, Any],
    sources: Mapping[str, Any],
    tables: Mapping[str, DataFrame],
    responses: DataFrame | None = None,
    dry_run: bool = False,
) -> dict[str, DataFrame]:
    """The whole job.

    ``spec``: ``owner``, ``metadata``, ``now``, ``start`` (where nothing is stored), ``request`` (template),
    optional ``fields`` of the arrays, ``validator`` and ``uploader`` as for any job. ``sources``: paths per name of
    ``TAGS``; without any the target's entities stay as they are. ``tables``: the entity tables and ``observations``.
    Gives per entity its ``<name>_changes`` and new table, ``rejects``, ``requests``, and with responses
    ``changes``, ``metrics`` and, unless it is a dry run, ``observations`` and ``data_arrays``.
    """
    held = reconcile_network(spark, sources, tables, spec.get("owner", ""), spec.get("metadata", ""))
    out = {f"{name}_changes": changes for name, changes in held.changes.items()} | dict(held.tables)
    if held.rejects:
        rejects = held.rejects[0]
        for more in held.rejects[1:]:
            rejects = rejects.unionAll(more)
        out["rejects"] = rejects
    datastreams = held.tables["datastreams"]
    out["requests"] = plan_requests(datastreams, tables["observations"], spec["now"], spec["start"], spec["request"])
    if responses is None:
        return out
    rows = stage(read_responses(responses, datastreams, held.by_local_id("features"), spec.get("fields")), "service-rows")
    filled = entities.backfill_units(datastreams, rows.filter(F.col("ds_id").isNotNull() & F.col("unit_href").isNotNull()))
    filled = stage(filled, "service-datastreams")
    out["unit_changes"] = filled.filter("unit_set").drop("unit_set")
    out["datastreams"] = filled.drop("unit_set")
    changes = change_set(rows.drop("unit_href", "point_differs", "pos"), spec.get("validator", []), tables)
    return out | results(changes, spec, tables, dry_run)
