"""Table schemas shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RESULT_DECIMAL = "decimal(38,12)"

OBSERVATIONS = f"""
  obs_id string, kind string, ds_id string, phen_start timestamp, phen_end timestamp,
  result_kind string, result_num {RESULT_DECIMAL}, result_text string, result_arr array<string>,
  result_time timestamp, valid_start timestamp, valid_end timestamp, result_quality string,
  parameters map<string,string>, foi_id string, src_file string, src_line bigint, seq bigint
"""

DATASTREAMS = """
  kind string, ds_id string, name string, description string, obs_type string,
  uom struct<name:string,symbol:string,definition:string>, thing_id string, sensor_id string, op_id string,
  properties map<string,string>, phen_start timestamp, phen_end timestamp, local_ids array<string>
"""

THINGS = "thing_id string, name string, description string, properties map<string,string>, location_id string"
LOCATIONS = "location_id string, name string, description string, properties map<string,string>, lon double, lat double"
SENSORS = (
    "sensor_id string, name string, description string, encoding string, metadata string, properties map<string,string>"
)
OBSERVED_PROPERTIES = (
    "op_id string, name string, definition string, description string, properties map<string,string>"
)
FEATURES = "foi_id string, name string, description string, properties map<string,string>, lon double, lat double"

# An observation is identified by its stream and its time; phen_end is NULL for an instant.
STREAM_KEY = ["kind", "ds_id"]
TIME_KEY = ["kind", "ds_id", "phen_start", "phen_end"]
RESULT_COLUMNS = ["result_kind", "result_num", "result_text", "result_arr"]


def _fields(ddl: str) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in StructType.fromDDL(ddl).fields]


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Project to a schema, adding typed NULLs for the columns that are absent."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(name) if name in present else F.lit(None)).cast(dtype).alias(name)
            for name, dtype in _fields(ddl)
        ]
    )


def observations(df: DataFrame) -> DataFrame:
    return conform(df, OBSERVATIONS)


def result_struct(prefix: str = "") -> Column:
    """The tagged result columns as one struct, for comparisons."""
    return F.struct(
        F.col(f"{prefix}result_kind").alias("kind"),
        F.col(f"{prefix}result_num").alias("num"),
        F.col(f"{prefix}result_text").alias("text"),
        F.col(f"{prefix}result_arr").alias("arr"),
    )


def stable_id(*cols: Column | str) -> Column:
    """Content-derived id, equal for every retry and every re-run."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("\u0002")) for c in cols]
    return F.sha2(F.concat_ws("\u0001", *parts), 256)
