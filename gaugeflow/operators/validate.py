"""Validators: observations against a time bound, their own shape, or what the target holds.

Simple validators add a ``reason`` column (NULL means accepted) and keep every row, so they can be
chained. The target-based ones return change rows with ``action`` and ``reason``; ``validate_in_order``
chains validators of both kinds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions import times, values
from gaugeflow.model import STREAM_KEY, TIME_KEY, result_struct, stable_id
from gaugeflow.operators.skew import keep_one, salted_lookup

DEFAULT_PARAMETERS = ("importFileId", "importFileBase")

Validator = Callable[[DataFrame], DataFrame]


def _reject_when(df: DataFrame, condition: Column, reason: str) -> DataFrame:
    earlier = F.col("reason") if "reason" in df.columns else F.lit(None).cast("string")
    failed = F.when(F.coalesce(condition, F.lit(True)), F.lit(reason))
    return df.withColumn("reason", F.coalesce(earlier, failed))


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reason").isNull())


def validate_all(df: DataFrame) -> DataFrame:
    return _reject_when(df, F.lit(False), "")


def _bound(now, days: int, minutes: int) -> Column:
    base = now if isinstance(now, Column) else times.now_literal(now)
    return base - F.make_dt_interval(F.lit(days), F.lit(0), F.lit(minutes))


def validate_after(df: DataFrame, now, days: int = 1, minutes: int = 0) -> DataFrame:
    """Start strictly later than now minus days and minutes."""
    return _reject_when(df, ~(F.col("phen_start") > _bound(now, days, minutes)), "Not after the bound")


def validate_before(df: DataFrame, now, days: int = 1, minutes: int = 0) -> DataFrame:
    """Start strictly earlier than now minus days and minutes."""
    return _reject_when(df, ~(F.col("phen_start") < _bound(now, days, minutes)), "Not before the bound")


def validate_interval(df: DataFrame, period: str) -> DataFrame:
    """The time is an interval whose end is its start plus the ISO period."""
    parsed = times.Period.parse(period)
    if parsed is None:
        raise ValueError(f"{period!r} is not an ISO period")
    df = _reject_when(df, F.col("phen_end").isNull(), "Not an interval")
    wrong = F.col("phen_end") != F.col("phen_start") + parsed.interval()
    return _reject_when(df, F.col("phen_end").isNotNull() & wrong, "Wrong interval")


def validate_newer(df: DataFrame, target: DataFrame, spread: str = "seq") -> DataFrame:
    """Start strictly later than the stream's latest stored start; streams without any accept all."""
    latest = target.groupBy(*STREAM_KEY).agg(F.max("phen_start").alias("_latest"))
    joined = salted_lookup(df, latest, STREAM_KEY, spread)
    stale = F.col("_latest").isNotNull() & ~(F.col("phen_start") > F.col("_latest"))
    return _reject_when(joined, stale, "Not newer").drop("_latest")


def validate_multi(df: DataFrame, validators: Sequence[Validator]) -> DataFrame:
    """All validators in order; the first reason stays."""
    for validator in validators:
        df = validator(df)
    return df if "reason" in df.columns else validate_all(df)


def batch_dedupe(df: DataFrame) -> DataFrame:
    """One observation per stream and time: the last by ``seq``."""
    return keep_one(df, TIME_KEY, F.col("seq").desc())


def flag_superseded(df: DataFrame) -> DataFrame:
    """All observations with ``superseded``: a later one in the batch has the same stream and time."""
    last = df.groupBy(*TIME_KEY).agg(F.max("seq").alias("_last"))
    return (
        salted_lookup(df, last, TIME_KEY, "seq", null_safe=["phen_end"])
        .withColumn("superseded", F.col("seq") < F.col("_last"))
        .drop("_last")
    )


def _id_order(col: str) -> list[Column]:
    """Highest numeric id first; ids that are no numbers come last, by text."""
    return [F.col(col).cast("string").try_cast("decimal(38,0)").desc_nulls_last(), F.col(col).desc()]


def _stored_since(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Only the stored rows from the first incoming time on.

    The bound is a scalar subquery over the batch, so it reaches the target's scan as a pushed filter.
    """
    since = incoming.agg(F.min("phen_start")).scalar()
    kept = target.filter(F.col("phen_start") >= since)
    # Tables written by day have that column: whole days are left out before any file is opened.
    return kept.filter(F.col("phen_date") >= F.to_date(since)) if "phen_date" in target.columns else kept


def _with_end_key(df: DataFrame) -> DataFrame:
    """Add ``_end``, the interval end as a number that is never NULL (instants get their own).

    Windows and the join then share plain equality keys, hence one shuffle per side.
    """
    return df.withColumn("_end", F.coalesce(F.unix_micros("phen_end"), F.lit(-(1 << 63))))


_MATCH = ["kind", "ds_id", "phen_start", "_end"]


def survivors(target: DataFrame, version: str | None = None) -> DataFrame:
    """One stored observation per stream and time: the newest version, then the highest id."""
    order = ([F.col(version).desc()] if version else []) + _id_order("obs_id")
    return keep_one(_with_end_key(target), _MATCH, *order)


def _attach_stored(last: DataFrame, stored: DataFrame) -> DataFrame:
    s = stored.select(
        *[F.col(k).alias(f"_s_{k}") for k in _MATCH],
        F.col("obs_id").alias("_s_obs_id"),
        result_struct().alias("_s_result"),
    )
    condition = F.lit(True)
    for k in _MATCH:
        condition = condition & (last[k] == s[f"_s_{k}"])
    # Both sides hold one row per stream and time, so no key is hot here.
    return last.join(s, condition, "left")


def new_obs_id() -> Column:
    """Id of an inserted observation: the same for every re-run."""
    return stable_id(*TIME_KEY)


def _changes(
    joined: DataFrame, action: Column, reason: Column, columns: Sequence[str], new_id: Column | None = None
) -> DataFrame:
    rest = [c for c in columns if c not in ("obs_id", "action", "reason")]
    return (
        joined.withColumn("action", action)
        .withColumn("reason", reason)
        .select(
            "action",
            "reason",
            F.when(F.col("action") == "insert", new_obs_id() if new_id is None else new_id)
            .when(F.col("action") != "reject", F.col("_s_obs_id").cast("string"))
            .alias("obs_id"),
            *rest,
        )
    )


def _reason(df: DataFrame) -> Column:
    """The reason earlier validators gave, or NULL."""
    return F.col("reason") if "reason" in df.columns else F.lit(None).cast("string")


def _rejects(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c not in ("obs_id", "action", "reason")]
    return df.filter(F.col("reason").isNotNull()).select(
        F.lit("reject").alias("action"), "reason", F.lit(None).cast("string").alias("obs_id"), *rest
    )


def validate_by_time(
    df: DataFrame,
    target: DataFrame,
    update: bool = True,
    prune: bool = True,
    report_superseded: bool = False,
    version: str | None = None,
) -> DataFrame:
    """Change rows by stream and time: insert what is new, update what differs, skip what is equal.

    Rows carrying a ``reason`` from earlier validators become rejects; they are read off the input
    on their own, so it pays to have it staged. In a batch the last row of a time counts;
    ``report_superseded`` lists the others as skips. ``version`` names a target column by which
    several stored versions of an observation are ordered.
    """
    columns = df.columns
    good = accepted(df).drop("reason") if "reason" in columns else df
    last = keep_one(_with_end_key(good), _MATCH, F.col("seq").desc())
    stored = survivors(_stored_since(target, good) if prune else target, version)
    joined = _attach_stored(last, stored)
    same = values.result_equals(result_struct(), F.col("_s_result"))
    absent = F.col("_s_obs_id").isNull()
    action = F.when(absent, "insert").when(same, "skip").otherwise("update" if update else "skip")
    reason = F.when(absent, F.lit(None)).when(same, "Same result").otherwise("Changed result")
    out = _changes(joined, action, reason.cast("string"), columns)
    if report_superseded:
        rest = [c for c in columns if c not in ("obs_id", "reason")]
        out = out.unionByName(
            flag_superseded(good).filter("superseded").select(
                F.lit("skip").alias("action"), F.lit("Superseded in batch").alias("reason"),
                F.lit(None).cast("string").alias("obs_id"), *rest,
            )
        )
    return out.unionByName(_rejects(df)) if "reason" in columns else out


def find_duplicates(target: DataFrame, incoming: DataFrame | None = None) -> DataFrame:
    """Stored observations to delete: same stream and time as one with a higher id.

    With ``incoming`` only the range from its first time on is looked at. Every key's highest id
    comes from a partial aggregation; the copies then find it by a salted lookup, so a key with
    very many copies is neither sorted nor gathered in one task.
    """
    scope = target if incoming is None else _stored_since(target, incoming)
    number = F.col("obs_id").cast("string").try_cast("decimal(38,0)")
    rank = F.struct(F.coalesce(number, F.lit(-1).cast("decimal(38,0)")).alias("n"), F.col("obs_id").alias("id"))
    best = scope.groupBy(*TIME_KEY).agg(F.max(rank).alias("_best"), F.count(F.lit(1)).alias("_n"))
    best = best.filter(F.col("_n") > 1).drop("_n")
    joined = salted_lookup(scope, best, TIME_KEY, F.col("obs_id"), how="inner", null_safe=["phen_end"])
    return joined.filter(rank != F.col("_best")).drop("_best")


def validate_by_parameters(
    df: DataFrame,
    target: DataFrame,
    names: Sequence[str] = DEFAULT_PARAMETERS,
    check_time: bool = False,
    update: bool = False,
    spread: str = "seq",
) -> DataFrame:
    """Change rows by the values of named parameters: insert, or skip/update the first stored match.

    A record without one of the parameters is rejected. Many records may share one set of
    parameters, so the stored side is reduced to its first row per set before the lookup. Of several
    updates of one stored row the last by ``seq`` counts, the others are skips. Ids of inserts come from
    time, parameters and ``seq``, as several records may share a time.
    """
    columns = df.columns
    names = [n.strip() for n in names]
    params = {f"_p_{i}": F.element_at("parameters", F.lit(n)) for i, n in enumerate(names)}
    keys = [*STREAM_KEY, *params]
    null_safe: list[str] = []
    if check_time:
        keys += ["phen_start", "phen_end"]
        null_safe = ["phen_end"]
    number = F.col("obs_id").cast("string").try_cast("decimal(38,0)")
    stored = target.select("*", *[c.alias(n) for n, c in params.items()])
    complete = F.lit(True)
    for n in params:
        complete = complete & F.col(n).isNotNull()
    stored = keep_one(stored.filter(complete), keys, number.asc_nulls_last(), F.col("obs_id").asc())
    stored = stored.select(*keys, F.col("obs_id").alias("_s_obs_id"))
    lacking = F.when(~complete_flag(params), "Missing parameter")
    keyed = df.select(
        "*", *[c.alias(n) for n, c in params.items()], F.coalesce(_reason(df), lacking).alias("_reason")
    )
    if update:
        # A set of parameters has one stored row, so the last record of the set is that of the row; it is
        # found by partial aggregation and joined to the stored side, which the one lookup then carries along.
        last = keyed.filter(F.col("_reason").isNull()).groupBy(*keys).agg(F.max("seq").alias("_last"))
        last = last.select(*[F.col(k).alias(f"_l_{k}") for k in keys], "_last")
        same = [stored[k].eqNullSafe(last[f"_l_{k}"]) if k in null_safe else stored[k] == last[f"_l_{k}"] for k in keys]
        stored = stored.join(last, reduce(and_, same), "left").drop(*[f"_l_{k}" for k in keys])
    joined = salted_lookup(keyed, stored, keys, spread, null_safe=null_safe)
    late = F.coalesce(F.col("seq") < F.col("_last"), F.lit(False)) if update else F.lit(False)
    rejected, found = F.col("_reason").isNotNull(), F.col("_s_obs_id").isNotNull()
    action = F.when(rejected, "reject").when(~found, "insert").when(late, "skip").otherwise("update" if update else "skip")
    reason = F.when(rejected, F.col("_reason")).when(late, "Superseded in batch").when(found, "Same parameters")
    return _changes(joined, action, reason, columns, stable_id(*TIME_KEY, *params, "seq"))


def validate_in_order(
    df: DataFrame, steps: Sequence[Validator], before_target: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> DataFrame:
    """Change rows by any validators in the order given, also several that ask the target.

    A step either marks rows with a ``reason`` or, asking the target, gives change rows. What a step rejects or
    skips is closed: later steps see it no more, its first reason stays. What it accepts goes on, with the id of the
    stored observation it is an update of; a later step that finds another one replaces that id. At the end an
    accepted row is an update where some step found an observation, else an insert with the id of the last step
    that asked. Every row leaves once, but for those of one time that a validator by time leaves out.

    ``before_target`` is applied to the rows before each step that asks the target, which reads them several
    times: put ``stage`` there.
    """
    columns = [c for c in df.columns if c not in ("obs_id", "reason", "action")]
    none = F.lit(None).cast("string")
    state = ("_closed", "_why", "_found", "_fresh")
    rows = df.select(*columns, _reason(df).alias("reason"), none.alias("obs_id"), *[none.alias(c) for c in state])
    closed = F.when(F.col("reason").isNotNull(), "reject")
    rows = rows.withColumn("_closed", closed)
    for step in steps:
        asks = getattr(step, "asks_target", False)
        out = step(before_target(rows) if asks else rows)
        if not asks:
            rows = out.withColumn("_closed", F.coalesce("_closed", closed))
            continue
        action = F.col("action")
        now_closed = F.coalesce("_closed", F.when(action.isin("skip", "reject"), action))
        rows = out.select(
            *columns,
            F.when(now_closed.isNotNull(), F.col("reason")).alias("reason"),
            none.alias("obs_id"),
            now_closed.alias("_closed"),
            F.when(action == "update", F.col("reason")).otherwise(F.col("_why")).alias("_why"),
            F.when(action.isin("update", "skip"), F.col("obs_id")).otherwise(F.col("_found")).alias("_found"),
            F.when(action == "insert", F.col("obs_id")).otherwise(F.col("_fresh")).alias("_fresh"),
        )
    action = F.coalesce("_closed", F.when(F.col("_found").isNotNull(), "update").otherwise("insert"))
    done = rows.withColumn("action", action)
    return done.select(
        "action",
        F.coalesce("reason", F.when(F.col("action") == "update", F.col("_why"))).alias("reason"),
        F.when(F.col("action") == "insert", F.coalesce("_fresh", new_obs_id()))
        .when(F.col("action") != "reject", F.col("_found"))
        .alias("obs_id"),
        *columns,
    )


def asking(step: Validator) -> Validator:
    """Mark a step of ``validate_in_order`` that gives change rows."""

    def run(df: DataFrame) -> DataFrame:
        return step(df)

    run.asks_target = True
    return run


def complete_flag(params: dict[str, Column]) -> Column:
    flag = F.lit(True)
    for column in params.values():
        flag = flag & column.isNotNull()
    return flag


