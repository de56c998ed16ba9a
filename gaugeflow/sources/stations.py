"""Air-quality station metadata and the entities derived from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions import props
from gaugeflow.functions.templates import quoted
from gaugeflow.functions.values import after_last_slash
from gaugeflow.model import RESULT_DECIMAL, stable_id
from gaugeflow.operators.skew import keep_one, salted_lookup
from gaugeflow.session import stage

# Pollutant code, name, recommended unit, definition.
POLLUTANTS = [
    ("1", "SO2", "µg/m3", "http://dd.eionet.europa.eu/vocabulary/aq/pollutant/1"),
    ("5", "PM10", "µg/m3", "http://dd.eionet.europa.eu/vocabulary/aq/pollutant/5"),
    ("7", "O3", "µg/m3", "http://dd.eionet.europa.eu/vocabularyconcept/aq/pollutant/7"),
    ("8", "NO2", "µg/m3", "http://dd.eionet.europa.eu/vocabulary/aq/pollutant/8"),
    ("9", "NOX as NO2", "µg/m3", "http://dd.eionet.europa.eu/vocabulary/aq/pollutant/9"),
    ("10", "CO", "mg/m3", "http://dd.eionet.europa.eu/vocabulary/aq/pollutant/10"),
    ("38", "NO", "µg/m3", "http://dd.eionet.europa.eu/vocabulary/aq/pollutant/38"),
    ("71", "CO2", "ppmv", "http://dd.eionet.europa.eu/vocabulary/aq/pollutant/71"),
    ("6001", "PM2.5", "µg/m3", "http://dd.eionet.europa.eu/vocabulary/aq/pollutant/6001"),
]
OWNER = "http://dd.eionet.europa.eu"
MEDIUM_AIR = "http://inspire.ec.europa.eu/codelist/MediaValue/air"
UNIT_COLUMNS = ["UNIT", "value_unit", "UnitOfMeasurement"]

# The columns of a station metadata table, and the fields of its JSON form.
STATION_COLUMNS = [
    "Countrycode", "Timezone", "Namespace", "AirQualityNetwork", "AirQualityStation", "AirQualityStationEoICode",
    "AirQualityStationNatCode", "SamplingPoint", "SamplingProces", "Sample", "AirPollutantCode",
    "ObservationDateBegin", "ObservationDateEnd", "Projection", "Longitude", "Latitude", "Altitude",
    "MeasurementType", "AirQualityStationType", "AirQualityStationArea", "EquivalenceDemonstrated",
    "MeasurementEquipment", "InletHeight", "BuildingDistance", "KerbDistance",
]
JSON_UNQUOTED = [
    "Country", "Timezone", "B2G_Namespace", "AirQualityNetwork", "AirQualityNetworkName", "AirQualityStationEoICode",
    "AirQualityStationNatCode", "ProcessId", "AssessmentMethodId", "OperationalActivityBegin",
    "OperationalActivityEnd", "AQStationName",
]
JSON_TEXT = [
    "MeasurementType", "AirQualityStationType", "AirQualityStationArea", "EquivalenceDemonstrated",
    "MeasurementEquipment", "InletHeightUnit", "BuilldingDistanceUnit", "KerbDistanceUnit", "SamplingMethod",
]
_JSON_ENTITY_FIELDS = [
    "AirQualityStationEoICode", "AQStationName", "AssessmentMethodId", "ProcessId", "MeasurementEquipment", "Longitude",
    "Latitude", "Countrycode", "B2G_Namespace", "AirQualityStationArea", "AirQualityNetwork", "AirQualityNetworkName",
    "OperationalActivityBegin", "OperationalActivityEnd", "SamplingMethod",
]
_ENTITY_FIELDS = [
    "AirQualityStation", "SamplingProces", "SamplingPoint", "MeasurementEquipment", "Longitude", "Latitude",
    "Countrycode", "Namespace", "AirQualityStationArea", "ObservationDateBegin", "ObservationDateEnd",
]
JSON_NUMBERS = ["Longitude", "Latitude", "Altitude", "InletHeight", "BuildingDistance", "KerbDistance"]


def pollutant_dim(spark: SparkSession) -> DataFrame:
    """The nine known pollutants with their properties; fixed size."""
    rows = [(stable[0], stable[1], stable[3], stable[1], stable[2]) for stable in POLLUTANTS]
    frame = spark.createDataFrame(
        rows, "local_id string, name string, definition string, description string, recommended_unit string"
    )
    properties = props.build_map(
        {"localId": F.col("local_id"), "owner": OWNER, "recommendedUnit": F.col("recommended_unit")}
    )
    return frame.select(
        F.col("local_id").alias("op_id"), "name", "definition", "description", properties.alias("properties"), "local_id"
    )


def with_pollutant(df: DataFrame, code: Column, spark: SparkSession | None = None) -> DataFrame:
    """Attach the pollutant of a code or of a vocabulary link; ``op_id`` is NULL when unknown."""
    dim = pollutant_dim(spark or df.sparkSession).select(
        F.col("local_id").alias("_code"), "op_id", F.col("name").alias("op_name"),
        F.element_at("properties", F.lit("recommendedUnit")).alias("op_unit"),
    )
    # Nine fixed rows: safe to broadcast.
    return df.withColumn("_code", F.trim(after_last_slash(code))).join(F.broadcast(dim), "_code", "left").drop("_code")


def read_station_metadata(records: DataFrame, keys: Sequence[str], order: str = "seq") -> DataFrame:
    """Station rows, the last one per key; an empty process is ``Unknown``.

    The table is read by position: its first 25 columns are the fixed ones whatever their titles.
    """
    names = records.columns[: len(STATION_COLUMNS)]
    renamed = records.select(
        *[quoted(n).alias(s) for n, s in zip(names, STATION_COLUMNS)], F.col(order).alias("seq")
    )
    process = F.when(F.col("SamplingProces") == "", "Unknown").otherwise(F.col("SamplingProces"))
    return keep_one(renamed.withColumn("SamplingProces", process), list(keys), F.col("seq").desc())


def read_station_json(docs: DataFrame, keys: Sequence[str], json_col: str = "doc") -> DataFrame:
    """First entry of each document's ``Rows``: texts without quotes, numbers as decimals.

    A text field holding something else is ``''``; an absent one is NULL.
    """
    row = F.get(F.from_json(F.get_json_object(json_col, "$.Rows"), "array<string>"), F.lit(0))
    first = docs.select(*keys, row.alias("_row")).filter(F.col("_row").isNotNull())
    raw = F.from_json(F.col("_row"), "map<string,string>")
    variant = F.try_parse_json(F.col("_row"))

    def text(name: str) -> Column:
        kind = F.schema_of_variant(F.try_variant_get(variant, f"$['{name}']", "variant"))
        value = F.element_at(raw, F.lit(name))
        return F.when(kind == "STRING", value).when(kind.isNotNull(), F.lit(""))

    def number(name: str) -> Column:
        return F.element_at(raw, F.lit(name)).try_cast(RESULT_DECIMAL)

    return first.select(
        *keys,
        F.left(F.translate(text("AirQualityStationEoICode"), '"', ""), F.lit(2)).alias("Countrycode"),
        *[F.translate(text(n), '"', "").alias(n) for n in JSON_UNQUOTED],
        *[text(n).alias(n) for n in JSON_TEXT],
        *[number(n).alias(n) for n in JSON_NUMBERS],
    )


def lookup_station(
    records: DataFrame, stations: DataFrame, station: str, point: str, process: str, spread: str = "seq"
) -> DataFrame:
    """Attach the station of a record as struct ``station``: by sampling point, else by all three ids.

    ``stations`` has one row per (AirQualityStation, SamplingPoint, SamplingProces); of several
    stations of one sampling point the last by ``seq`` counts.
    """
    info = F.struct(*[c for c in stations.columns if c != "seq"])
    by_point = keep_one(stations, ["SamplingPoint"], F.col("seq").desc()).select(
        F.col("SamplingPoint").alias(point), info.alias("_by_point")
    )
    by_all = keep_one(
        stations, ["AirQualityStation", "SamplingPoint", "SamplingProces"], F.col("seq").desc()
    ).select(
        F.col("AirQualityStation").alias(station),
        F.col("SamplingPoint").alias(point),
        F.col("SamplingProces").alias(process),
        info.alias("_by_all"),
    )
    joined = salted_lookup(records, by_point, [point], spread)
    joined = salted_lookup(joined, by_all, [station, point, process], spread)
    return joined.withColumn("station", F.coalesce("_by_point", "_by_all")).drop("_by_point", "_by_all")


def _six_digits(value: Column) -> Column:
    return F.bround(value.try_cast("decimal(20,12)"), 6).cast("double")


def derive_station_entities(joined: DataFrame, unit: Column, metadata: str = "", order: str = "seq") -> dict[str, DataFrame]:
    """Location, Thing, Sensor and Datastream rows for records with their ``station`` struct.

    Returns frames keyed ``locations, things, sensors, datastreams, rejects``. Each entity appears
    once, built from the last record that names it. A record without station, with an unknown
    pollutant or without a unit goes to ``rejects``.
    """
    s = {f: F.col(f"station.{f}") for f in STATION_COLUMNS if f in joined.schema["station"].dataType.names}
    reject = (
        F.when(F.col("station").isNull(), "Station not found")
        .when(F.col("op_id").isNull(), "ObservedProperty not found")
        .when(F.coalesce(unit, F.lit("")) == "", "Could not find unit in record")
    )
    checked = with_pollutant(joined, s["AirPollutantCode"]).withColumn("reject", reject)
    good = checked.filter(F.col("reject").isNull()).select(
        F.col(order).alias("seq"), unit.alias("unit"), "op_id", "op_name",
        *[s[n].alias(n) for n in _ENTITY_FIELDS],
    )
    # The records shrink to one per entity combination, computed once for all four results.
    entities = stage(
        keep_one(good, ["AirQualityStation", "SamplingProces", "SamplingPoint"], F.col("seq").desc()), "station_entities"
    )
    base = {
        "countryCode": F.col("Countrycode"),
        "owner": OWNER,
        "namespace": F.col("Namespace"),
        "metadata": metadata,
    }
    station_id = F.col("AirQualityStation")
    place = {**base, "localId": station_id, "AirQualityStationArea": F.col("AirQualityStationArea")}
    thing = {
        **place,
        "mediaMonitored": MEDIUM_AIR,
        "beginTime": F.col("ObservationDateBegin"),
        "endTime": F.nullif("ObservationDateEnd", F.lit("")),
    }
    flat = entities.select(
        "seq",
        station_id.alias("station_id"),
        F.col("SamplingProces").alias("process_id"),
        F.col("SamplingPoint").alias("point_id"),
        F.col("MeasurementEquipment").alias("equipment"),
        _six_digits(F.col("Longitude")).alias("lon"),
        _six_digits(F.col("Latitude")).alias("lat"),
        "op_id",
        "op_name",
        "unit",
        props.build_map(place).alias("place_props"),
        props.build_map(thing).alias("thing_props"),
        props.build_map({**base, "localId": F.col("SamplingProces")}).alias("sensor_props"),
        props.build_map({**base, "localId": F.col("SamplingPoint")}).alias("ds_props"),
    )

    def once(key: str) -> DataFrame:
        return keep_one(flat, [key], F.col("seq").desc())

    def text(prefix: str, col: str) -> Column:
        return F.concat(F.lit(prefix), F.col(col))

    locations = once("station_id").select(
        stable_id("station_id").alias("location_id"), F.col("station_id").alias("name"),
        text("Location of station ", "station_id").alias("description"), F.col("place_props").alias("properties"),
        "lon", "lat",
    )
    things = once("station_id").select(
        stable_id("station_id").alias("thing_id"), F.col("station_id").alias("name"),
        text("Measurement station ", "station_id").alias("description"), F.col("thing_props").alias("properties"),
        stable_id("station_id").alias("location_id"),
    )
    sensors = once("process_id").select(
        stable_id("process_id").alias("sensor_id"), F.col("process_id").alias("name"),
        text("Sensor ", "process_id").alias("description"), F.lit("text/html").alias("encoding"),
        F.col("equipment").alias("metadata"), F.col("sensor_props").alias("properties"),
    )
    datastreams = once("point_id").select(
        F.lit("D").alias("kind"), stable_id("point_id").alias("ds_id"), F.col("point_id").alias("name"),
        F.concat("op_name", F.lit(" at "), "station_id").alias("description"),
        F.struct(F.col("unit").alias("name"), F.col("unit").alias("symbol"), F.col("unit").alias("definition")).alias("uom"),
        stable_id("station_id").alias("thing_id"), stable_id("process_id").alias("sensor_id"), "op_id",
        F.col("ds_props").alias("properties"), F.array("point_id").alias("local_ids"),
    )
    rejects = checked.filter(F.col("reject").isNotNull()).select(F.col(order).alias("seq"), "reject")
    return {
        "locations": locations, "things": things, "sensors": sensors, "datastreams": datastreams, "rejects": rejects,
    }


def derive_json_station_entities(joined: DataFrame, metadata: str = "", order: str = "seq") -> dict[str, DataFrame]:
    """The same from the JSON station form (``station`` as given by ``read_station_json``).

    The record brings ``SAMPLINGPOINT_LOCALID``, ``PROPERTY`` (a pollutant name) and a unit column.
    Things are named after the station name and keyed by the station code.
    """
    unit_name = next((c for c in UNIT_COLUMNS if c in joined.columns), None)
    if unit_name is None:
        raise ValueError("the record has no unit column")
    s = {f: F.col(f"station.{f}") for f in joined.schema["station"].dataType.names}
    dim = pollutant_dim(joined.sparkSession).select(F.col("name").alias("_name"), "op_id", F.col("name").alias("op_name"))
    records = joined.withColumn("_name", F.trim("PROPERTY")).join(F.broadcast(dim), "_name", "left").drop("_name")
    checked = records.withColumn(
        "reject",
        F.when(F.col("station").isNull(), "Station not found").when(F.col("op_id").isNull(), "ObservedProperty not found"),
    )
    good = checked.filter(F.col("reject").isNull()).select(
        F.col(order).alias("seq"), "op_id", "op_name", F.trim(quoted(unit_name)).alias("unit"),
        F.trim("SAMPLINGPOINT_LOCALID").alias("point_id"), *[s[n].alias(n) for n in _JSON_ENTITY_FIELDS],
    )
    entities = stage(
        keep_one(good, ["AirQualityStationEoICode", "AssessmentMethodId", "point_id"], F.col("seq").desc()),
        "station_entities",
    )
    base = {
        "countryCode": F.col("Countrycode"),
        "owner": OWNER,
        "namespace": F.col("B2G_Namespace"),
        "metadata": metadata,
    }
    code = F.col("AirQualityStationEoICode")
    place = {**base, "localId": code, "AirQualityStationArea": F.col("AirQualityStationArea")}
    thing = {
        **place,
        "AirQualityNetwork": F.col("AirQualityNetwork"),
        "AirQualityNetworkName": F.col("AirQualityNetworkName"),
        "mediaMonitored": MEDIUM_AIR,
        "beginTime": F.col("OperationalActivityBegin"),
        "endTime": F.nullif("OperationalActivityEnd", F.lit("")),
    }
    sensor = {**base, "localId": F.col("AssessmentMethodId"), "samplingMethod": F.col("SamplingMethod")}
    flat = entities.select(
        "seq", code.alias("code"), F.col("AQStationName").alias("station_name"), F.col("AssessmentMethodId").alias("method_id"),
        F.col("ProcessId").alias("process_id"), "point_id", F.col("MeasurementEquipment").alias("equipment"),
        _six_digits(F.col("Longitude")).alias("lon"), _six_digits(F.col("Latitude")).alias("lat"), "op_id", "op_name", "unit",
        props.build_map(place).alias("place_props"), props.build_map(thing).alias("thing_props"),
        props.build_map(sensor).alias("sensor_props"),
        props.build_map({**base, "localId": F.to_json(F.array("point_id"))}).alias("ds_props"),
    )

    def once(key: str) -> DataFrame:
        return keep_one(flat, [key], F.col("seq").desc())

    ds_name = F.concat("op_name", F.lit(" at "), "station_name")
    return {
        "locations": once("code").select(
            stable_id("code").alias("location_id"), F.col("station_name").alias("name"),
            F.concat(F.lit("Location of station "), "code").alias("description"),
            F.col("place_props").alias("properties"), "lon", "lat",
        ),
        "things": once("code").select(
            stable_id("code").alias("thing_id"), F.col("station_name").alias("name"),
            F.concat(F.lit("Measurement station "), "station_name").alias("description"),
            F.col("thing_props").alias("properties"), stable_id("code").alias("location_id"),
        ),
        "sensors": once("method_id").select(
            stable_id("method_id").alias("sensor_id"), F.col("process_id").alias("name"),
            F.concat(F.lit("Sensor "), "process_id").alias("description"), F.lit("text/html").alias("encoding"),
            F.col("equipment").alias("metadata"), F.col("sensor_props").alias("properties"),
        ),
        "datastreams": once("point_id").select(
            F.lit("D").alias("kind"), stable_id("point_id").alias("ds_id"), ds_name.alias("name"),
            ds_name.alias("description"),
            F.struct(F.col("unit").alias("name"), F.col("unit").alias("symbol"), F.col("unit").alias("definition")).alias("uom"),
            stable_id("code").alias("thing_id"), stable_id("method_id").alias("sensor_id"), "op_id",
            F.col("ds_props").alias("properties"), F.array("point_id").alias("local_ids"),
        ),
        "rejects": checked.filter(F.col("reject").isNotNull()).select(F.col(order).alias("seq"), "reject"),
    }
