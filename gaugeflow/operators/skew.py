"""Building blocks that stay even when one key holds a large share of the rows.

* ``keep_one`` / ``keep_first``: ``row_number() <= k`` filters, which Spark prunes per map task
  (WindowGroupLimit) before the shuffle, so at most k rows per key and task travel.
* ``salted_lookup``: join against a table that is unique per key; the big side is spread over salts.
* ``measured_lookup``: the same against a table that Spark can't size, which is stored and measured.
* ``positions``: exact row numbers inside groups of any size, counted in bounded chunks.
* ``running_total``: sums over all rows before each row, in a total order, by ranges.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.session import stage

SALTS = 4
UNMATCHED_SALTS = 1 << 16
ROW_BYTES = 32  # of a row in memory besides its values
MEASURED = 32 << 20  # bytes of rows that are broadcast once they are measured
CHUNK = 1 << 20


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], k: int = 1, rank: str | None = None):
    """First k rows per key in the given order; optionally keeps the rank column."""
    name = rank or "_rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.filter(F.col(name) <= k)
    return kept if rank else kept.drop(name)


def keep_one(df: DataFrame, keys: Sequence[str | Column], *order: Column) -> DataFrame:
    return keep_first(df, keys, list(order), 1)


def salted_lookup(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    spread: str | Column = "seq",
    how: str = "left",
    null_safe: Sequence[str] = (),
    salts: int = SALTS,
) -> DataFrame:
    """Join ``big`` to ``small`` (one row per key) without piling a hot key on one task.

    The salt is a hash of ``spread``, a column that differs between rows, so a retried task sends
    each row to the same place. ``small`` is repeated once per salt, by an operator whose copies Spark
    counts (of an explode it counts one row each). A small table by Spark's own size check is broadcast instead. Beyond that the salt does two things: it divides a hot key,
    and it gives both sides their own exchange, which is what adaptive execution needs to cut the
    remaining large partitions into pieces of the advisory size (``skewJoin`` in ``session.tune``).
    Rows with a NULL key match nothing: they get salts that ``small`` doesn't have, as many as keep them even.
    """
    spread_col = F.xxhash64(F.col(spread) if isinstance(spread, str) else spread)
    salt = F.pmod(spread_col, F.lit(salts)).cast("int")
    nullable = [F.col(key).isNull() for key in on if key not in null_safe]
    if nullable:
        salt = F.when(reduce(or_, nullable), (-1 - F.pmod(spread_col, F.lit(UNMATCHED_SALTS))).cast("int")).otherwise(salt)
    left = big.withColumn("_salt", salt)
    for key in on:  # here, as filters aren't moved below the copies
        small = small if key in null_safe else small.filter(F.col(f"`{key}`").isNotNull())
    copies = [f"_salt{i}" for i in range(salts)]
    right = small.select("*", *[F.lit(i).alias(c) for i, c in enumerate(copies)]).unpivot([f"`{c}`" for c in small.columns], copies, "_copy", "_salt").drop("_copy")
    keys = [*on, "_salt"]
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = None
    for key in keys:
        test = left[key].eqNullSafe(renamed[f"_r_{key}"]) if key in null_safe else left[key] == renamed[f"_r_{key}"]
        condition = test if condition is None else condition & test
    joined = left.join(renamed, condition, how)
    return joined.drop("_salt", *[f"_r_{key}" for key in keys])


def measured_lookup(big: DataFrame, small: DataFrame, on: Sequence[str], spread: str | Column, name: str) -> DataFrame:
    """Left ``salted_lookup`` against a table whose size can't be told from its files, as one cut from compressed text.

    ``small`` is stored and its rows are measured: up to ``MEASURED`` bytes, or Spark's limit where that is higher, they
    are broadcast, once and not per salt; beyond it both sides are shuffled, whatever Spark expects of the files.
    Where broadcasts are switched off, nothing is broadcast.
    """
    kept = stage(small, name)
    size = F.sum(F.octet_length(F.to_json(F.struct(*kept.columns))).cast("bigint") + ROW_BYTES)
    limit = kept.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if limit >= 0 and (kept.agg(size).first()[0] or 0) <= max(limit, MEASURED):
        return salted_lookup(big, F.broadcast(kept), on, spread, salts=1)
    return salted_lookup(big, kept.hint("merge"), on, spread)


def positions(
    df: DataFrame, group: Sequence[str], order: str = "seq", name: str = "pos", chunk: int = CHUNK
) -> DataFrame:
    """Exact 1-based position of each row in its group, ordered by a unique integer column.

    Rows are counted per (group, order div chunk): a chunk never holds more than ``chunk`` rows,
    whatever the size of the group. Chunk totals (one row per chunk) give each chunk's offset.
    """
    chunked = df.withColumn("_chunk", F.floor(F.col(order) / F.lit(chunk)).cast("bigint"))
    totals = chunked.groupBy(*group, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(g).alias(f"_o_{g}") for g in group],
        F.col("_chunk").alias("_o_chunk"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
    )
    condition = chunked["_chunk"] == offsets["_o_chunk"]
    for g in group:
        condition = condition & chunked[g].eqNullSafe(offsets[f"_o_{g}"])
    inside = Window.partitionBy(*group, "_chunk").orderBy(order)
    return (
        chunked.join(offsets, condition, "left")
        .withColumn(name, F.col("_offset") + F.row_number().over(inside))
        .drop("_chunk", "_offset", "_o_chunk", *[f"_o_{g}" for g in group])
    )


def running_total(df: DataFrame, order: Sequence[str], value: str, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over all rows before the row in the order of unique columns.

    Rows are dealt by ranges and stored; the only window over everything has one row per range.
    """
    dealt = stage(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "running-total")
    sums = dealt.groupBy("_range").agg(F.sum(value).alias("_sum"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("_range").alias("_r"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum(value).over(inside), F.lit(0))
    joined = dealt.withColumn("_own", own).join(offsets, F.col("_range") == F.col("_r"))
    return joined.withColumn(name, F.col("_before") + F.col("_own")).drop("_range", "_r", "_before", "_own")
