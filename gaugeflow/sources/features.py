"""XML feature collections of a monitoring network, read element by element."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions import props
from gaugeflow.functions.geo import position_to_wgs84
from gaugeflow.functions.steps import step
from gaugeflow.functions.values import after_last_slash
from gaugeflow.operators.skew import keep_one, measured_lookup

# The process id form, and the links put into the property maps.
PROCESS_ID = r"^(SPP\.[0-9]+\.[0-9A-Za-z]+\.[0-9]+\.([0-9]+))\.([0-9]+)\.([0-9]+)$"
MEDIA_AIR = "http://inspire.ec.europa.eu/codelist/MediaValue/air"
REGIME_CONTINUOUS = "http://inspire.ec.europa.eu/codelist/MeasurementRegimeValue/continuousDataCollection"
PROCESS_TYPE = "http://inspire.ec.europa.eu/codeList/ProcessTypeValue/process"
RESULT_NATURE = "http://inspire.ec.europa.eu/codeList/ResultNatureValue/primary"

_IDENTIFIER = "inspireId struct<Identifier:struct<namespace:string>>"
_POINT = "struct<Point:struct<_srsName:string,pos:string>>"
_ACTIVITY = (
    "operationalActivityPeriod struct<OperationalActivityPeriod:struct<activityTime:struct<TimePeriod:struct<"
    "beginPosition:string,endPosition:struct<_VALUE:string,_indeterminatePosition:string>>>>>"
)
_HREF = "struct<_href:string>"

STATION = f"_id string, {_IDENTIFIER}, name string, {_ACTIVITY}, geometry {_POINT}"
SAMPLE = f"_id string, {_IDENTIFIER}, shape {_POINT}"
SAMPLING_POINT = (
    f"_id string, {_IDENTIFIER}, {_ACTIVITY}, broader {_HREF}, observingCapability struct<ObservingCapability:struct<"
    f"featureOfInterest:{_HREF},observedProperty:{_HREF},procedure:{_HREF}>>"
)
_ADDRESS = (
    "address struct<AddressRepresentation:struct<adminUnit:struct<GeographicalName:struct<spelling:struct<"
    "SpellingOfName:struct<text:string>>>>,locatorDesignator:string,postCode:string>>"
)
PROCESS = (
    f"_id string, {_IDENTIFIER}, measurementType {_HREF}, "
    f"measurementEquipment struct<MeasurementEquipment:struct<equipment:{_HREF}>>, "
    f"samplingEquipment struct<SamplingEquipment:struct<equipment:{_HREF},otherEquipment:string>>, "
    f"measurementMethod struct<MeasurementMethod:struct<measurementMethod:{_HREF}>>, "
    "equivalenceDemonstration struct<EquivalenceDemonstration:struct<demonstrationReport:string>>, "
    "responsibleParty struct<RelatedParty:struct<individualName:struct<LocalisedCharacterString:string>,"
    "organisationName:struct<LocalisedCharacterString:string>,"
    f"contact:struct<Contact:struct<{_ADDRESS.replace('address struct', 'address:struct', 1)},"
    "electronicMailAddress:string,telephoneVoice:string,website:string>>>>"
)

_PERIOD = "operationalActivityPeriod.OperationalActivityPeriod.activityTime.TimePeriod"
_NAMESPACE = "inspireId.Identifier.namespace"


def read_features(spark: SparkSession, paths: str | list[str], tag: str, schema: str) -> DataFrame:
    """One row per element ``tag`` (with its prefix); prefixes below it are ignored.

    The text is cut at the element's end tag, which lets Spark split a file of any size over tasks;
    each piece is then parsed on its own.
    """
    # A generator, so that filters on the fields stay above it and each piece is parsed once.
    parsed = F.from_xml(F.col("element"), schema, {"ignoreNamespace": "true"})
    return _elements(spark, paths, tag).select(F.inline(F.array(parsed)))


def _elements(spark: SparkSession, paths: str | list[str], tag: str) -> DataFrame:
    """The text of each element ``tag``; one that the file ends in is closed, and will not parse."""
    pieces = spark.read.option("lineSep", f"</{tag}>").option("recursiveFileLookup", True).text(paths)
    # Mostly the first "<tag" is the element's; a pattern is needed where a longer tag begins alike.
    found = F.substring("value", F.instr("value", f"<{tag}"), F.lit(0x7FFFFFFF))
    opening = F.when(F.instr("value", f"<{tag}") == 0, "").when(
        F.substring(found, len(tag) + 2, 1).rlike(r"[\s>]"), found
    ).otherwise(F.regexp_extract("value", rf"(?s)<{re.escape(tag)}[\s>].*", 0))
    pieces = pieces.select("value", F.col("_metadata.file_path").alias("src_file"))
    elements = step(pieces, {"element": opening}, ["src_file"]).filter(F.col("element") != "")
    return elements.withColumn("element", F.concat("element", F.lit(f"</{tag}>")))


def check_features(spark: SparkSession, paths: str | list[str], tag: str, schema: str) -> DataFrame:
    """What ``read_features`` and ``feature_rejects`` give, from one parse: ``feature, src_file, local_id, reject, element``.

    ``feature`` holds the fields; the last two columns are NULL for a usable element.
    """
    whole = f"{schema}, _unreadable string"
    parsed = F.from_xml(F.col("element"), whole, {"ignoreNamespace": "true", "columnNameOfCorruptRecord": "_unreadable"})
    rows = _elements(spark, paths, tag).select("src_file", "element", F.explode(F.array(parsed)).alias("p"))
    named = F.nullif(F.regexp_extract("element", r"""^<[^>]*?[\s:]id\s*=\s*["']([^"']*)["']""", 1), F.lit(""))
    no_id = F.coalesce(F.trim("p._id"), F.lit("")) == ""
    reject = F.when(F.col("p._unreadable").isNotNull(), "Unreadable element").when(no_id, "Element without id")
    return rows.select(
        F.col("p").dropFields("_unreadable").alias("feature"),
        "src_file",
        F.coalesce("p._id", named).alias("local_id"),
        reject.alias("reject"),
        F.when(reject.isNotNull(), F.col("element")).alias("element"),
    )


def feature_rejects(spark: SparkSession, paths: str | list[str], tag: str, schema: str) -> DataFrame:
    """Elements that ``read_features`` gives no usable row for: ``src_file, local_id, reject, element``.

    An element that is no XML, or whose parts don't fit the schema, is unreadable; its id is taken from its text
    where it has one. One without an id can't be referred to.
    """
    return check_features(spark, paths, tag, schema).filter("reject IS NOT NULL").select("src_file", "local_id", "reject", "element")


def _text(path: str) -> Column:
    return F.coalesce(F.col(path), F.lit(""))


def _active() -> Column:
    return F.col(f"{_PERIOD}.endPosition._indeterminatePosition") == "unknown"


def read_stations(features: DataFrame, owner: str = "", metadata: str = "") -> DataFrame:
    """Active stations as Thing and Location in one row each."""
    place = position_to_wgs84(F.col("geometry.Point.pos"), F.col("geometry.Point._srsName"))
    common = {
        "owner": owner,
        "countryCode": F.left(F.col(_NAMESPACE), F.lit(2)),
        "localId": F.col("_id"),
        "namespace": F.col(_NAMESPACE),
        "metadata": metadata,
    }
    thing = {
        **common,
        "mediaMonitored": MEDIA_AIR,
        "measurementRegime": REGIME_CONTINUOUS,
        "mobile": "false",
        "beginTime": F.col(f"{_PERIOD}.beginPosition"),
        "endTime": F.nullif(_text(f"{_PERIOD}.endPosition._VALUE"), F.lit("")),
    }
    name = _text("name")
    return features.filter(_active()).select(
        F.col("_id").alias("local_id"),
        name.alias("name"),
        F.concat(F.lit("Air quality station "), name).alias("description"),
        F.concat(F.lit("Location of air quality station "), name).alias("location_description"),
        props.build_map(thing).alias("properties"),
        props.build_map(common).alias("location_properties"),
        place["lon"].alias("lon"),
        place["lat"].alias("lat"),
        place["error"].alias("reject"),
    )


def read_processes(
    features: DataFrame, observed_properties: DataFrame, owner: str = "", metadata: str = ""
) -> DataFrame:
    """Sensors from process features: known pollutants only, one per process id.

    ``observed_properties`` has a ``local_id``. The first feature by its own id stands for a process.
    """
    parts = features.select(
        "*",
        F.regexp_extract("_id", PROCESS_ID, 1).alias("process_id"),
        F.regexp_extract("_id", PROCESS_ID, 2).alias("pollutant"),
        F.regexp_extract("_id", PROCESS_ID, 3).try_cast("bigint").alias("sequence"),
    ).filter((F.col("process_id") != "") & (F.col("sequence") <= 1))
    known = observed_properties.select(F.col("local_id").cast("string").alias("pollutant")).distinct()
    parts = keep_one(parts.join(known, "pollutant", "left_semi"), ["process_id"], F.col("_id").asc())
    measuring = _text("measurementEquipment.MeasurementEquipment.equipment._href")
    sampling = _text("samplingEquipment.SamplingEquipment.equipment._href")
    other = _text("samplingEquipment.SamplingEquipment.otherEquipment")
    party = "responsibleParty.RelatedParty"
    contact = f"{party}.contact.Contact"
    address = f"{contact}.address.AddressRepresentation"
    properties = {
        "owner": owner,
        "localId": F.col("process_id"),
        "namespace": _text(_NAMESPACE),
        "metadata": metadata,
        "measurementtype": _text("measurementType._href"),
        "method": _text("measurementMethod.MeasurementMethod.measurementMethod._href"),
        "responsibleParty/individualName": _text(f"{party}.individualName.LocalisedCharacterString"),
        "responsibleParty/organisationName": _text(f"{party}.organisationName.LocalisedCharacterString"),
        "responsibleParty/adminUnit": _text(f"{address}.adminUnit.GeographicalName.spelling.SpellingOfName.text"),
        "responsibleParty/locatorDesignator": _text(f"{address}.locatorDesignator"),
        "responsibleParty/postCode": _text(f"{address}.postCode"),
        "responsibleParty/electronicMailAddress": _text(f"{contact}.electronicMailAddress"),
        "responsibleParty/telephoneVoice": _text(f"{contact}.telephoneVoice"),
        "responsibleParty/website": _text(f"{contact}.website"),
    }
    return parts.select(
        F.col("process_id").alias("local_id"),
        F.when(measuring != "", after_last_slash(measuring))
        .when(other != "", other)
        .otherwise(after_last_slash(sampling))
        .alias("name"),
        F.when(measuring != "", measuring).otherwise(sampling).alias("description"),
        F.lit("application/pdf").alias("encoding"),
        _text("equivalenceDemonstration.EquivalenceDemonstration.demonstrationReport").alias("metadata"),
        props.build_map(properties).alias("properties"),
    )


def read_samples(features: DataFrame, owner: str = "", metadata: str = "") -> DataFrame:
    """Features of interest; the source gives its axes in the other order."""
    place = position_to_wgs84(F.col("shape.Point.pos"), F.col("shape.Point._srsName"), flip=True)
    properties = {
        "owner": owner,
        "localId": F.col("_id"),
        "namespace": _text(_NAMESPACE),
        "metadata": metadata,
    }
    return features.select(
        F.col("_id").alias("local_id"),
        F.col("_id").alias("name"),
        F.concat(F.lit("Air quality sample "), F.col("_id")).alias("description"),
        props.build_map(properties).alias("properties"),
        place["lon"].alias("lon"),
        place["lat"].alias("lat"),
        place["error"].alias("reject"),
    )


def read_sampling_points(
    features: DataFrame,
    observed_properties: DataFrame,
    sensors: DataFrame,
    things: DataFrame,
    foi: DataFrame,
    existing: DataFrame,
    owner: str = "",
    metadata: str = "",
) -> DataFrame:
    """Datastreams of active sampling points, with ``reject`` naming the missing parent.

    The dimension frames carry ``local_id`` (unique), their id and ``name``; ``existing`` carries
    ``local_id`` and ``uom``. A missing feature of interest is only flagged.
    """
    capability = "observingCapability.ObservingCapability"
    points = features.filter(_active()).select(
        F.col("_id").alias("local_id"),
        _text(_NAMESPACE).alias("namespace"),
        after_last_slash(_text(f"{capability}.featureOfInterest._href")).alias("foi_local_id"),
        after_last_slash(_text(f"{capability}.observedProperty._href")).alias("op_local_id"),
        F.regexp_extract(after_last_slash(_text(f"{capability}.procedure._href")), PROCESS_ID, 1).alias("sensor_local_id"),
        after_last_slash(_text("broader._href")).alias("thing_local_id"),
    )

    def parent(frame: DataFrame, key: str, id_col: str, name_col: str | None = None) -> DataFrame:
        cols = [F.col("local_id").alias(key), F.col(id_col)]
        return frame.select(*cols, *([F.col("name").alias(name_col)] if name_col else []))

    # One property, station or process may serve a large share of all points. Names are joined last, and an id's
    # absence is kept beside it, so a caller that doesn't ask for the id doesn't carry it through the lookups after it.
    lookups = [
        (existing.select("local_id", "uom"), "local_id", None),
        (parent(foi, "foi_local_id", "foi_id"), "foi_local_id", "foi_id"),
        (parent(sensors, "sensor_local_id", "sensor_id"), "sensor_local_id", "sensor_id"),
        (parent(things, "thing_local_id", "thing_id", "thing_name"), "thing_local_id", "thing_id"),
        (parent(observed_properties, "op_local_id", "op_id", "op_name"), "op_local_id", "op_id"),
    ]
    joined = points
    for dimension, key, found in lookups:
        joined = measured_lookup(joined, dimension, [key], "local_id", f"sampling-{key}")
        if found:
            joined = joined.withColumn(f"no_{found}", F.col(found).isNull())
    properties = {
        "owner": owner,
        "localId": F.col("local_id"),
        "namespace": F.col("namespace"),
        "metadata": metadata,
        "processType": PROCESS_TYPE,
        "resultNature": RESULT_NATURE,
        "featureOfInterestLocalId": F.col("foi_local_id"),
    }
    reject = (
        F.when(F.col("no_op_id"), "ObservedProperty not found")
        .when(F.col("no_sensor_id"), "Sensor not found")
        .when(F.col("no_thing_id"), "Thing not found")
    )
    return joined.select(
        "local_id",
        F.col("local_id").alias("name"),
        F.concat(F.col("op_name"), F.lit(" as "), F.col("thing_name")).alias("description"),
        "op_id",
        "sensor_id",
        "thing_id",
        "foi_id",
        F.col("no_foi_id").alias("foi_missing"),
        "uom",
        props.build_map(properties).alias("properties"),
        reject.alias("reject"),
    )
