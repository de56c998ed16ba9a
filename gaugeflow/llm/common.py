"""Column helpers shared by the corpus operators.

White space is the six ASCII characters of ``SPACES``; a word is a maximal run of other characters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.session import stage

SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
FOLDS, HELD_OUT = 4, 2


def words(text: Column) -> Column:
    """Words of a text as an array; null text gives an empty array."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE_RUN)
    return F.filter(parts, lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words: the pieces between runs of white space, less the empty ones at both ends."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACE_RUN))).cast("bigint")


def held_out(doc_id: Column) -> Column:
    """True for the quarter of documents no classifier may learn from; a null id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(FOLDS)) == HELD_OUT


def text_key(text: Column) -> Column:
    """64-bit key that tells texts of one document id apart; null and empty text differ."""
    return F.xxhash64(text, text.isNull())


def ranked(df: DataFrame, order: Sequence[Column], name: str, stage_name: str) -> DataFrame:
    """``df`` staged, with its 0-based rank in a total order.

    Rows are dealt by ranges and counted per range; the only window over everything has one row per
    partition. Columns that the order names must be columns of ``df``.
    """
    dealt = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    staged = stage(dealt, stage_name)
    counts = staged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_range").orderBy(*order)
    return (
        staged.withColumn("_row", F.row_number().over(inside))
        .join(offsets, F.col("_range") == F.col("_r"))
        .withColumn(name, (F.col("_before") + F.col("_row") - 1).cast("bigint"))
        .drop("_range", "_row", "_r", "_before")
    )


def packed(docs: DataFrame, *needed: str) -> DataFrame:
    """``text``, the ``needed`` columns and all columns but the text in one struct ``row``.

    Whatever else the input calls its columns, a step that works on these names can't meet them.
    """
    rest = [F.col(f"`{c}`").alias(c) for c in docs.columns if c != "text"]
    return docs.select("text", *needed, F.struct(*rest).alias("row"))


def unpacked(df: DataFrame, docs: DataFrame, **changed: Column) -> list[Column]:
    """The columns of ``docs`` out of ``packed`` rows, some with new values."""
    own = lambda c: F.col("text") if c == "text" else F.col("row").getField(c)
    return [changed.get(c, own(c)).alias(c) for c in docs.columns]
