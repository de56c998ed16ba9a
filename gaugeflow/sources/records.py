"""Delimited records: scan, line numbers, skip and limit, character sets."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import WindowSpec

from gaugeflow.functions.templates import quoted
from gaugeflow.session import stage

PROVENANCE = ["src_file", "src_block", "row_id"]
CELLS = "cells"
# Names the library gives to columns of its own.
RESERVED = (*PROVENANCE, CELLS, "src_line", "seq", "file_ord")
_WHOLE = "_whole_record"


def read_records(
    spark: SparkSession,
    paths: str | Sequence[str],
    delimiter: str = ",",
    tab: bool = False,
    header: bool = False,
    comment: str | None = None,
    charset: str = "UTF-8",
    multiline: bool = False,
) -> DataFrame:
    """Records as text columns plus where they came from.

    Cells are never NULL: an empty cell is ``''``. Files are split over tasks; ``multiline`` reads
    quoted line breaks but gives each file to one task, and UTF-16 needs it as well.
    With ``header`` each file's own first line names its cells; columns a file lacks are ``''`` there, and a
    title that is one of ``RESERVED`` gets an underscore at its end.
    ``cells`` holds the cells of each record in its file's own order, also those beyond the titles: reading by
    number goes by it. Nothing is parsed for it where no later step asks for it.
    ``src_block``/``row_id`` give the order inside a file; ``number_lines`` turns them into lines.
    """
    separator = "\t" if tab else (delimiter or ",")[0]
    options = {
        "sep": separator,
        "header": header,
        "escape": '"',
        "encoding": charset,
        "recursiveFileLookup": True,
        "multiLine": multiline or charset.upper().startswith("UTF-16"),
        "columnNameOfCorruptRecord": _WHOLE,
    }
    if comment:
        options["comment"] = comment[0]
    paths = [paths] if isinstance(paths, str) else list(paths)
    groups = _by_header(spark, paths, comment) if header else [paths]
    scans = [_scan(spark, group, options) for group in groups]
    records = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), scans)
    if len(scans) > 1:
        own = (*PROVENANCE, CELLS)
        records = records.select(
            *[F.coalesce(quoted(c), F.lit("")).alias(c) for c in records.columns if c not in own],
            *[c for c in own if c in records.columns],
        )
    return records.withColumn("row_id", F.monotonically_increasing_id())


def _title(name: str) -> str:
    name = name.removeprefix("\ufeff")
    return f"{name}_" if name in RESERVED else name


def _scan(spark: SparkSession, paths: list[str], options: dict) -> DataFrame:
    """Files that share one list of titles. Records of another length come with their text as well."""
    names = spark.read.options(**options).csv(paths).columns
    schema = StructType([StructField(c, StringType()) for c in [*names, _WHOLE]])
    scan = spark.read.options(**options).schema(schema).csv(paths)
    titled = [F.coalesce(quoted(c), F.lit("")) for c in names]
    beyond = F.slice(_tokens(F.col(_WHOLE), options["sep"]), len(names) + 1, F.lit(1 << 30))
    cells = F.array(*titled) if titled else F.array().cast("array<string>")
    return scan.select(
        *[cell.alias(_title(c)) for c, cell in zip(names, titled, strict=True)],
        F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_block_start").alias("src_block"),
        F.when(F.col(_WHOLE).isNull(), cells).otherwise(F.concat(cells, beyond)).alias(CELLS),
    )


def _tokens(record: Column, separator: str) -> Column:
    """The cells of a record's text: between separators, or quoted with doubled quotes inside."""
    sep = re.escape(separator)
    found = F.regexp_extract_all(F.concat(F.lit(separator), record), F.lit(rf'(?s){sep}("[^"]*(?:""[^"]*)*"|[^{sep}]*)'), F.lit(1))
    plain = lambda t: F.replace(F.substring(t, F.lit(2), F.length(t) - 2), F.lit('""'), F.lit('"'))
    return F.transform(found, lambda t: F.when(t.startswith('"'), plain(t)).otherwise(t))


def _by_header(spark: SparkSession, paths: list[str], comment: str | None) -> list[list[str]]:
    """The files grouped by their first line, as Spark lays one header over all files of a scan.

    One text pass over the first block of each file; a path and a hash per file reach the driver, which
    lists the files of any scan. Files without a line are left out.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(paths)
    if len(lines.inputFiles()) < 2:
        return [paths]
    told = F.trim("value") != ""
    if comment:
        told = told & ~F.col("value").startswith(comment[0])
    at = F.monotonically_increasing_id()
    first = lines.filter(told & (F.col("_metadata.file_block_start") == 0)).select(
        F.col("_metadata.file_path").alias("path"), F.xxhash64("value").alias("header"), at.alias("at")
    )
    groups: dict[int, list[str]] = {}
    for row in first.groupBy("path").agg(F.min_by("header", "at").alias("header")).collect():
        groups.setdefault(row["header"], []).append(unquote(row["path"]))
    if len(groups) < 2:
        return [paths]
    return sorted(sorted(group) for group in groups.values())


def data_columns(records: DataFrame) -> list[str]:
    return [c for c in records.columns if c not in RESERVED]


def strip_nulls(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Remove NUL characters from the text columns and from ``cells``."""
    wanted = set(columns) if columns is not None else {c for c, t in df.dtypes if t == "string"}

    def cleaned(c: str) -> Column:
        if c == CELLS and dict(df.dtypes)[c] == "array<string>":
            return F.transform(CELLS, lambda t: F.translate(t, "\u0000", "")).alias(c)
        return F.translate(quoted(c), "\u0000", "").alias(c) if c in wanted else quoted(c)

    return df.select(*[cleaned(c) for c in df.columns])


def _plain_path(column: str) -> Column:
    """A path in one spelling, whether or not a local one carries its scheme."""
    return F.regexp_replace(column, "^file:/+", "/")


def number_lines(records: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """Add ``src_line`` (1-based, per file) and ``seq`` (0-based, over all files).

    Files follow ``manifest(src_file, file_ord)``, or their path order. A first pass over the files
    counts the rows of each block, which is one row per input split; those counts give every block
    its first line, so no file, however large, has to be ordered in one place.
    """
    return _numbered(records, _block_starts(_counted_blocks(records), manifest))


def _counted_blocks(records: DataFrame) -> DataFrame:
    """How many records each input split has: one scan, one row per split."""
    spark = records.sparkSession
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        # Both passes must cut the files into the same blocks, also when executors come and go.
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return records.groupBy("src_file", "src_block").agg(F.min("row_id").alias("first_row"), F.count(F.lit(1)).alias("n"))


def _block_starts(blocks: DataFrame, manifest: DataFrame | None) -> DataFrame:
    """Blocks with the records before each, ``in_file`` and ``overall``."""
    if manifest is None:
        blocks = blocks.withColumn("file_ord", F.col("src_file"))
    else:
        listed = manifest.select(_plain_path("src_file").alias("_path"), "file_ord")
        blocks = blocks.withColumn("_path", _plain_path("src_file")).join(listed, "_path", "left").drop("_path")
    # One row per input split: totals before each split, in its file and overall.
    in_file = Window.partitionBy("src_file").orderBy("src_block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(
        "src_file",
        "src_block",
        "first_row",
        "n",
        "file_ord",
        F.coalesce(F.sum("n").over(in_file), F.lit(0)).alias("in_file"),
        F.coalesce(F.sum("n").over(_overall()), F.lit(0)).alias("overall"),
    )


def _overall() -> WindowSpec:
    return Window.orderBy("file_ord", "src_file", "src_block").rowsBetween(Window.unboundedPreceding, -1)


def _numbered(records: DataFrame, starts: DataFrame, *more: str) -> DataFrame:
    numbered = records.join(starts.select("src_file", "src_block", "first_row", "in_file", "overall", *more), ["src_file", "src_block"])
    inside = F.col("row_id") - F.col("first_row")
    return numbered.select(
        *[quoted(c) for c in records.columns],
        (F.col("in_file") + inside + 1).cast("bigint").alias("src_line"),
        (F.col("overall") + inside).cast("bigint").alias("seq"),
        *more,
    )


def take_rows(records: DataFrame, skip: int = 0, limit: int = 0, manifest: DataFrame | None = None) -> DataFrame:
    """``number_lines``, then ``skip`` records of every file left out and the first ``limit`` of the rest kept (0: all).

    Counts per split decide all of it: after the one counting scan, splits of which nothing is wanted drop out and
    files without a wanted split are not opened again.
    """
    starts = _block_starts(_counted_blocks(records), manifest)
    if skip <= 0 and limit <= 0:
        return _numbered(records, starts)
    left_out = F.least(F.greatest(F.lit(skip) - F.col("in_file"), F.lit(0)), F.col("n"))
    starts = starts.withColumn("wanted", F.col("n") - left_out)
    starts = starts.withColumn("wanted_before", F.coalesce(F.sum("wanted").over(_overall()), F.lit(0)))
    starts = starts.filter(F.col("wanted") > 0)
    if limit > 0:
        starts = stage(starts.filter(F.col("wanted_before") < limit), "wanted-blocks")
        # The files that are read: at most as many as hold the first ``limit`` records.
        files = [r["src_file"] for r in starts.select("src_file").distinct().collect()]
        records = records.filter(F.col("src_file").isin(files))
    numbered = _numbered(records, starts, "wanted_before", "in_file")
    kept = numbered.filter(F.col("src_line") > skip)
    if limit > 0:
        # Position among the wanted: those of earlier splits, and the lines of this one after the skipped.
        kept = kept.filter(F.col("wanted_before") + F.col("src_line") - F.greatest(F.lit(skip), F.col("in_file")) <= limit)
    return kept.drop("wanted_before", "in_file")


def skip_rows(records: DataFrame, n: int) -> DataFrame:
    """Drop the first n records of every file (the header is not a record). Needs ``number_lines``."""
    return records.filter(F.col("src_line") > n) if n > 0 else records


def limit_rows(records: DataFrame, n: int, skipped: int = 0) -> DataFrame:
    """First n records over all files, counted after ``skip_rows(skipped)``; 0 keeps everything.

    Without skipping the running number already is the position. With skipping, each file's
    position moves up by the records skipped in it and in the files before it.
    """
    if n <= 0:
        return records
    if skipped <= 0:
        return records.filter(F.col("seq") < n)
    # seq - src_line is constant per file: its start. One row per file.
    files = records.withColumn("file_start", F.col("seq") - F.col("src_line") + 1)
    kept = files.groupBy("src_file", "file_start").agg(F.count(F.lit(1)).alias("kept"))
    earlier = Window.orderBy("file_start", "src_file").rowsBetween(Window.unboundedPreceding, -1)
    kept = kept.select("src_file", F.coalesce(F.sum("kept").over(earlier), F.lit(0)).alias("kept_before"))
    position = F.col("kept_before") + F.col("src_line") - skipped
    return records.join(kept, "src_file").filter(position <= n).drop("kept_before")


def _read_heads(batches):
    """First bytes of each file; only those bytes are fetched."""
    from pyarrow import fs

    for batch in batches:
        heads = []
        for path in batch["path"]:
            system, inner = fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if "://" not in path else path)
            with system.open_input_file(inner) as handle:
                heads.append(handle.read(3).hex().upper())
        yield pd.DataFrame({"path": batch["path"], "head": heads})


def file_heads(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``path, head``: the first three bytes of every file, in hexadecimal."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load([paths] if isinstance(paths, str) else list(paths)).select("path")
    return listing.mapInPandas(_read_heads, "path string, head string")


def detect_charset(heads: DataFrame, default: str = "UTF-8") -> DataFrame:
    """``path, charset`` from the byte order mark."""
    head = F.col("head")
    charset = (
        F.when(head.startswith("FFFE"), "UTF-16LE")
        .when(head.startswith("FEFF"), "UTF-16BE")
        .when(head == "EFBBBF", "UTF-8")
        .otherwise(default)
    )
    return heads.withColumn("charset", charset).drop("head")


def read_detected(spark: SparkSession, paths: str | Sequence[str], default: str = "UTF-8", **options) -> DataFrame:
    """Scan files of mixed character sets: one scan per charset, appended by column name."""
    # The list of input paths is driver data in any scan; only paths and charsets are fetched here.
    found = detect_charset(file_heads(spark, paths), default).groupBy("charset").agg(F.collect_list("path").alias("p"))
    scans = []
    for row in sorted(found.collect()):
        scan = read_records(spark, sorted(row["p"]), charset=row["charset"], **options)
        first = scan.columns[0]
        if first.startswith("﻿"):
            scan = scan.withColumnRenamed(first, first[1:])
        scans.append(scan)
    if not scans:
        return spark.createDataFrame([], "src_file string, src_block bigint, row_id bigint")
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), scans)
