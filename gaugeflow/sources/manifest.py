"""Manifests: which inputs to read, as DataFrames of ``url`` and order columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions.times import zone_name


def manifest_fixed(spark: SparkSession, url: str) -> DataFrame:
    return spark.createDataFrame([(url, 0)], "url string, ord int")


def fixed_url(url: Column) -> Column:
    """The manifest entry of a configuration row that names a single input."""
    return F.struct(F.trim(url).alias("url"), F.lit(0).alias("ord"))


def values_static(values: Sequence[str]) -> Column:
    """A configured list of values."""
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def values_time_strings(
    now: Column, minus: int = 0, count: int = 1, delta: int = 1, zone: str = "Z", pattern: str = "yyyyMMddHHmmss"
) -> Column:
    """``count`` formatted times, ``delta`` hours apart, from ``minus`` hours before the full hour of now."""
    if count <= 0:
        return F.array().cast("array<string>")
    start = F.date_trunc("hour", now) - F.make_dt_interval(F.lit(0), F.lit(minus))
    steps = F.sequence(F.lit(0), F.lit(count - 1))
    return F.transform(
        steps,
        lambda i: F.date_format(
            F.from_utc_timestamp(start + F.make_dt_interval(F.lit(0), i * F.lit(delta)), zone_name(zone)), pattern
        ),
    )


def manifest_combinations(df: DataFrame, base: Column, sets: Sequence[tuple[str, Column]], block: int = 100_000) -> DataFrame:
    """Every combination of replacement values: the columns of ``df`` with ``url`` and ``ord``.

    ``sets`` pairs a text to replace in ``base`` with an array of values. The first set varies fastest. A combination is
    a number in mixed radix, and its values are found from the number alone: the numbers of a row are cut into
    blocks of ``block`` that are dealt over the cluster, so no task holds a whole product. A set without values
    has no combination.
    """
    total = reduce(lambda x, y: x * y, [F.size(v).cast("bigint") for _, v in sets], F.lit(1).cast("bigint"))
    rows = df.select("*", base.alias("_base"), *[v.alias(f"_v{i}") for i, (_, v) in enumerate(sets)], total.alias("_total"))
    last = F.floor((F.col("_total") - 1) / F.lit(block)).cast("bigint")
    blocks = rows.filter("_total > 0").withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    # A fixed number of partitions: blocks are few bytes but much work, so they must not be coalesced.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = blocks.repartition(tasks, F.xxhash64("_base", "_block"))
    first = F.col("_block") * block
    numbers = spread.withColumn("ord", F.explode(F.sequence(first, F.least(first + block, F.col("_total")) - 1)))
    url, rest = F.col("_base"), F.col("ord")
    for i, (key, _) in enumerate(sets):
        size = F.size(f"_v{i}").cast("bigint")
        url = F.replace(url, F.lit(key), F.get(f"_v{i}", (rest % size).cast("int")))
        rest = F.floor(rest / size).cast("bigint")
    return numbers.select(*df.columns, url.alias("url"), "ord")


def _character_class(chars: str) -> str:
    return "[" + "".join("\\" + c if not c.isalnum() and c not in "\n\r\t" else c for c in chars) + "]+"


def _resolve(parent: Column, item: Column) -> Column:
    """Absolute link of a listing item: as is, from the host root, or beside the listing."""
    origin = F.regexp_extract(parent, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(parent, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*[^?#]*/|[^?#]*/)", 1)
    joined = F.concat(F.when(folder == "", F.concat(origin, F.lit("/"))).otherwise(folder), item)
    return F.when(item.startswith("http"), item).when(item.startswith("/"), F.concat(origin, item)).otherwise(joined)


def manifest_expand(
    listings: DataFrame, splitter: str = "\n", regex: str | None = None, remove: bool = False, sort: bool = False
) -> DataFrame:
    """Links named in listing texts ``(parent, text)``: ``parent, pos, url``.

    Text is cut at any of the splitter characters, items are trimmed, blanks become ``%20``. The
    pattern has to cover the whole item; ``remove`` drops matches instead of keeping them.
    ``sort`` orders the items of each listing by text instead of by appearance.
    """
    splitter = splitter.replace("\\n", "\n").replace("\\r", "\r").replace("\\t", "\t")
    items = F.split(F.col("text"), _character_class(splitter))
    items = F.transform(items, lambda x: F.replace(F.trim(F.regexp_replace(x, r"^\s+|\s+$", "")), F.lit(" "), F.lit("%20")))
    items = F.filter(items, lambda x: x != "")
    if regex:
        items = F.filter(items, lambda x: x.rlike(f"^(?:{regex})$") != F.lit(remove))
    if sort:
        items = F.array_sort(items)
    exploded = listings.select("parent", F.posexplode(items).alias("pos", "item"))
    at = F.instr("item", "http")
    link = F.when(at > 0, F.substring(F.col("item"), at, F.length("item"))).otherwise(F.col("item"))
    return exploded.select("parent", "pos", _resolve(F.trim(F.col("parent")), link).alias("url"))
