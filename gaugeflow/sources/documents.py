"""Documents that hold many observations: JSON lists, column files, SWE data arrays."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.props import json_walk
from gaugeflow.functions.steps import step
from gaugeflow.functions.templates import quoted
from gaugeflow.functions.times import parse_iso
from gaugeflow.functions.values import DECIMAL, after_last_slash
from gaugeflow.model import RESULT_DECIMAL
from gaugeflow.operators.skew import keep_one, positions, salted_lookup

Parser = Callable[[Column], Column]


def explode_json_observations(
    docs: DataFrame,
    keys: Sequence[str],
    list_path: str,
    time_path: str,
    result_path: str,
    time_parser: Parser,
    result_parser: Parser,
    json_col: str = "doc",
) -> DataFrame:
    """One row per element of the array at ``list_path``: ``*keys, pos, phen_start, result``."""
    listed = F.from_json(json_walk(F.col(json_col), list_path), "array<string>") if list_path else F.from_json(
        F.col(json_col), "array<string>"
    )
    elements = docs.select(*keys, F.posexplode(listed).alias("pos", "element"))
    return elements.select(
        *keys,
        "pos",
        time_parser(json_walk(F.col("element"), time_path)).alias("phen_start"),
        result_parser(json_walk(F.col("element"), result_path)).alias("result"),
    )


def zip_json_documents(
    observations: DataFrame, group: Sequence[str], doc_no: str, documents: int, time: str = "phen_start"
) -> DataFrame:
    """Vectors for the times that all N documents of a group hold: ``*group, time, results``.

    Input is the output of ``explode_json_observations`` with a document number 0..N-1. Within a
    document the last element of a time counts. After that each time has at most N rows, so the
    grouping stays small whatever the documents hold.
    """
    last = keep_one(observations, [*group, time, doc_no], F.col("pos").desc())
    vectors = last.groupBy(*group, time).agg(
        F.count(F.lit(1)).alias("_n"),
        F.array_sort(F.collect_list(F.struct(F.col(doc_no).alias("doc"), F.col("result").alias("v")))).alias("_v"),
    )
    return vectors.filter(F.col("_n") == documents).select(
        *group, time, F.transform("_v", lambda e: e["v"]).alias("results")
    )


def columns_to_arrays(
    df: DataFrame,
    doc: Sequence[str],
    columns: Sequence[str],
    parsers: Sequence[Parser],
    targets: Sequence[str],
    skip: int = 0,
    order: str = "seq",
    part_size: int = 100_000,
    together: bool = False,
) -> DataFrame:
    """Each column of a document as one array value: ``*doc, ds_id, part, values``.

    Empty cells are NULL; a column without any value is dropped and does not use up a target. The
    last parser serves all further columns. Arrays are cut into parts of ``part_size`` elements in
    order, so a document of any length is built piece by piece; a shorter one is a single part 0.
    ``together`` gives one array of arrays per part for the first target instead.
    """
    numbered = positions(df, doc, order, "_line").filter(F.col("_line") > skip)
    part = F.floor((F.col("_line") - 1 - skip) / F.lit(part_size)).cast("bigint")
    cells = F.array(
        *[
            F.struct(
                F.lit(i).alias("col"),
                F.when(quoted(c) != "", parsers[min(i, len(parsers) - 1)](quoted(c))).alias("v"),
                (F.coalesce(quoted(c), F.lit("")) != "").alias("filled"),
            )
            for i, c in enumerate(columns)
        ]
    )
    long = numbered.select(*doc, part.alias("part"), "_line", F.explode(cells).alias("cell")).select(
        *doc, "part", "_line", "cell.*"
    )
    parts = long.groupBy(*doc, "col", "part").agg(
        F.array_sort(F.collect_list(F.struct(F.col("_line").alias("line"), F.col("v").alias("v")))).alias("vs"),
        F.max("filled").alias("filled"),
    )
    # Which columns have data: one row per document, holding the column numbers.
    used = long.filter("filled").groupBy(*doc).agg(F.array_sort(F.collect_set("col")).alias("used"))
    joined = parts.join(used, list(doc)).filter(F.array_contains("used", F.col("col")))
    values = F.transform("vs", lambda e: e["v"])
    if together:
        return (
            joined.groupBy(*doc, "part")
            .agg(F.array_sort(F.collect_list(F.struct("col", values.alias("values")))).alias("cols"))
            .select(*doc, F.lit(targets[0]).alias("ds_id"), "part", F.transform("cols", lambda e: e["values"]).alias("values"))
        )
    ds_id = F.get(F.array(*[F.lit(t) for t in targets]), F.array_position("used", F.col("col")).cast("int") - 1)
    return joined.select(*doc, ds_id.alias("ds_id"), "part", values.alias("values")).filter(F.col("ds_id").isNotNull())


# The parts of a SWE data array that are read; prefixes are ignored.
_UOM = "struct<uom:struct<_href:string>>"
_SWE_ARRAY = (
    "elementCount struct<Count:struct<value:int>>, elementType struct<DataRecord:struct<field:array<struct<_name:string,"
    f"Quantity:{_UOM},QuantityRange:{_UOM},Count:{_UOM},CountRange:{_UOM},Time:{_UOM},TimeRange:{_UOM}>>>>, "
    "encoding struct<TextEncoding:struct<_decimalSeparator:string,_blockSeparator:string,_tokenSeparator:string>>, "
    "values string"
)


# A data array up to its first end tag, and up to the last one, which is found faster.
_ARRAY_TO_FIRST = r"(?s)<(?:[\w.-]+:)?DataArray[\s>].*?</(?:[\w.-]+:)?DataArray>"
_ARRAY_TO_LAST = r"(?s)<(?:[\w.-]+:)?DataArray[\s>].*</(?:[\w.-]+:)?DataArray>"


def _data_array(df: DataFrame, xml: str, keep: Sequence[str]) -> DataFrame:
    """``*keep, _a``: the first SWE data array of a response, parsed once."""
    found = step(df, {"_found": F.regexp_extract(xml, _ARRAY_TO_LAST, 0)}, [*keep, *([] if xml in keep else [xml])])
    text = F.col("_found")
    ends = (F.length(text) - F.length(F.replace(text, F.lit("DataArray>"), F.lit("")))) / len("DataArray>")
    ends = ends - F.when(text.rlike(r"^<(?:[\w.-]+:)?DataArray>"), 1).otherwise(0)
    # With one end tag the first is the last.
    first = F.when(ends <= 1, text).otherwise(F.regexp_extract(xml, _ARRAY_TO_FIRST, 0))
    # A generator, so that filters on what was parsed stay above it and each document is parsed once.
    return found.select(*keep, F.explode(F.array(F.from_xml(first, _SWE_ARRAY, {"ignoreNamespace": "true"}))).alias("_a"))


def _separator_class(sep: Column) -> Column:
    """Pattern for a run of any of the separator characters; every character escaped."""
    return F.concat(F.lit("["), F.regexp_replace(sep, r"([^A-Za-z0-9\s])", r"\\$1"), F.lit("]+"))


def explode_swe(
    df: DataFrame, xml: str = "xml", start: str = "StartTime", end: str = "EndTime", value: str = "Value"
) -> DataFrame:
    """Rows of a SWE data array: the input's other columns plus
    ``pos, phen_start, phen_end, result_num, unit_href, unit_symbol, reject``.

    Fields are found by name; separators come from the document. A block with a wrong token count
    or unreadable values gives a row with a reject reason, and so does a response without a readable array
    (its ``pos`` is NULL). Times are ISO with an offset.
    """
    keep = [c for c in df.columns if c != xml]
    arrays = _data_array(df, xml, keep)
    fields = F.col("_a.elementType.DataRecord.field")
    encoding = "_a.encoding.TextEncoding"
    parsed = arrays.select(
        *keep,
        fields["_name"].alias("_names"),
        F.filter(fields, lambda f: f["_name"] == value)[0].alias("_field"),
        F.col(f"{encoding}._decimalSeparator").alias("_decimal"),
        _separator_class(F.col(f"{encoding}._blockSeparator")).alias("_block"),
        _separator_class(F.col(f"{encoding}._tokenSeparator")).alias("_token"),
        F.col("_a.values").alias("_values"),
    )
    href = F.coalesce(
        *[F.col(f"_field.{t}.uom._href") for t in ("Quantity", "QuantityRange", "Count", "CountRange", "Time", "TimeRange")],
        F.lit(""),
    )
    blocks = F.filter(F.split(F.col("_values"), F.col("_block")), lambda b: F.trim(b) != "")
    rows = parsed.select(
        *keep, "_names", "_decimal", "_token", href.alias("unit_href"), F.posexplode_outer(blocks).alias("pos", "_text")
    )
    tokens = F.filter(F.split(F.col("_text"), F.col("_token")), lambda t: t != "")
    cut = step(rows, {"_tokens": tokens}, [*keep, "pos", "_names", "_decimal", "unit_href"])

    def token(name: str) -> Column:
        at = F.array_position("_names", F.lit(name)).cast("int")
        return F.trim(F.get(F.col("_tokens"), at - 1))

    found = step(
        cut,
        {
            "_miscounted": F.size("_tokens") != F.size("_names"),
            "_start": token(start),
            "_end": token(end),
            "_number": F.replace(token(value), F.col("_decimal"), F.lit(".")),
        },
        [*keep, "pos", "unit_href"],
    )
    number = F.col("_number")
    read = step(
        found,
        {
            "phen_start": parse_iso(F.col("_start")),
            "phen_end": parse_iso(F.col("_end")),
            "result_num": F.when(number.rlike(DECIMAL), number.try_cast(RESULT_DECIMAL)),
        },
        [*keep, "pos", "unit_href", "_miscounted"],
    )
    reject = (
        F.when(F.col("pos").isNull(), "No readable data array")
        .when(F.col("_miscounted"), "Wrong number of fields in block")
        .when(F.col("result_num").isNull(), "Could not parse number")
        .when(F.col("phen_start").isNull() | F.col("phen_end").isNull(), "Could not parse time")
        .when(F.col("phen_start") > F.col("phen_end"), "Interval starts after its end")
    )
    return read.select(
        *keep,
        "pos",
        "phen_start",
        "phen_end",
        "result_num",
        "unit_href",
        after_last_slash(F.col("unit_href")).alias("unit_symbol"),
        reject.alias("reject"),
    )


def swe_counts(df: DataFrame, keys: Sequence[str], xml: str = "xml") -> DataFrame:
    """The element count each document states: ``*keys, element_count``."""
    return _data_array(df, xml, keys).select(*keys, F.col("_a.elementCount.Count.value").alias("element_count"))


# Where a response names its feature of interest and its sampling point.
_FEATURE_HREF = r"""(?s)<(?:[\w.-]+:)?featureOfInterest\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""
_POINT_HREF = (
    r"""(?s)<(?:[\w.-]+:)?name\b[^>]*?\bhref\s*=\s*["'][^"']*/processparameter/SamplingPoint["'][^>]*>.*?"""
    r"""<(?:[\w.-]+:)?value\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""
)


def attach_feature(df: DataFrame, features: DataFrame, expected: str, xml: str = "xml", spread: str = "seq") -> DataFrame:
    """Responses with ``foi_id``, ``response_reject`` and ``point_differs``.

    ``features`` has ``local_id`` (unique) and ``foi_id``. A response without a known feature of
    interest gives no observations; one for another sampling point than ``expected`` is flagged.
    """
    local_id = after_last_slash(F.regexp_extract(xml, _FEATURE_HREF, 1))
    # The pattern is tried only where its fixed part is.
    point = F.when(~F.col(xml).contains("/processparameter/SamplingPoint"), "").otherwise(F.regexp_extract(xml, _POINT_HREF, 1))
    named = df.withColumn("_foi", local_id).withColumn("point_differs", ~point.endswith(F.col(expected)))
    known = features.select(F.col("local_id").alias("_foi"), "foi_id")
    joined = salted_lookup(named, known, ["_foi"], spread)
    reject = F.when(F.col("foi_id").isNull(), "FeatureOfInterest not found")
    return joined.drop("_foi").withColumn("response_reject", reject)
