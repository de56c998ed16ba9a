"""Instants, intervals, ISO durations and the time bounds of incremental runs.

Sessions run in UTC (``session.tune``), so wall-clock parsing and calendar arithmetic are UTC.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO instant with offset, epoch seconds, ISO duration.
ISO_ZONED = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?(Z|[+-][0-9]{2}(:[0-9]{2})?)(\[[^\]]+\])?$"
EPOCH_SECONDS = r"^[+-]?[0-9]+$"
EPOCH_LIMIT = (1 << 63) // 1_000_000 - 1  # a timestamp holds that many seconds either side of 1970
ISO_DURATION = re.compile(
    r"([+-])?P(?:(\d+)Y)?(?:(\d+)M)?(?:(\d+)W)?(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?)?"
)


def zone_name(zone: str) -> str:
    """``+1``, ``+0130`` and the like in the form Spark accepts; region names unchanged."""
    match = re.fullmatch(r"([+-])(\d{1,2})(?::?(\d{2}))?", zone)
    if not match:
        return "UTC" if zone == "Z" else zone
    return f"{match.group(1)}{int(match.group(2)):02d}:{match.group(3) or '00'}"


def _has_zone(pattern: str) -> bool:
    return bool(re.search(r"[XxZVzO]", re.sub(r"'[^']*'", "", pattern)))


def parse_time(cell: Column, pattern: str, zone: str = "UTC") -> Column:
    """Instant from text; ``zone`` applies when the pattern carries none. NULL when it doesn't parse."""
    parsed = F.try_to_timestamp(cell, F.lit(pattern))
    return parsed if _has_zone(pattern) else F.to_utc_timestamp(parsed, zone_name(zone))


def parse_iso(cell: Column) -> Column:
    bare = F.regexp_replace(cell, r"\[[^\]]+\]$", "")
    bare = F.regexp_replace(bare, r"(T[0-9]{2}:[0-9]{2})(Z|[+-])", "$1:00$2")
    return F.when(cell.rlike(ISO_ZONED), bare.try_cast("timestamp"))


def parse_epoch(cell: Column) -> Column:
    """Whole seconds since 1970, as far as a timestamp reaches; NULL beyond that."""
    seconds = F.when(cell.rlike(EPOCH_SECONDS), cell.try_cast("bigint"))
    return F.when(seconds.between(-EPOCH_LIMIT, EPOCH_LIMIT), F.timestamp_seconds(seconds))


def parse_time_ladder(cell: Column, pattern: str | None = None, zone: str = "UTC") -> Column:
    """Configured pattern, then ISO with offset, then epoch seconds; NULL when none fits."""
    rungs = [parse_time(cell, pattern, zone)] if pattern else []
    return F.coalesce(*rungs, parse_iso(cell), parse_epoch(cell))


@dataclass(frozen=True)
class Period:
    """An ISO-8601 duration split into its calendar and clock parts."""

    years: int = 0
    months: int = 0
    weeks: int = 0
    days: int = 0
    hours: int = 0
    minutes: int = 0
    seconds: float = 0
    sign: int = 1

    @staticmethod
    def parse(text: str) -> "Period | None":
        match = ISO_DURATION.fullmatch(text)
        if not match or text.endswith(("P", "T")):
            return None
        whole = [int(g or 0) for g in match.groups()[1:7]]
        return Period(*whole, float(match.group(8) or 0), -1 if match.group(1) == "-" else 1)

    def interval(self, sign: int = 1) -> Column:
        s = sign * self.sign
        parts = [self.years, self.months, self.weeks, self.days, self.hours, self.minutes]
        return F.make_interval(*[F.lit(s * p) for p in parts], F.lit(s * self.seconds).cast("decimal(18,6)"))


def _interval(start: Column, end: Column, problem: Column) -> Column:
    """struct(start, end, error); a start after the end is an error, and so is a missing start."""
    error = F.coalesce(
        problem,
        F.when(start.isNull(), "Could not parse time"),
        F.when(start > end, "Interval starts after its end"),
    )
    return F.struct(
        F.when(error.isNull(), start).alias("start"),
        F.when(error.isNull(), end).alias("end"),
        error.alias("error"),
    )


def endpoints(cells: Sequence[Column | str], pattern: str | None = None, zone: str = "UTC") -> list[Column | Period]:
    """The endpoints of a time, parsed: a timestamp Column, or the Period a Python text names."""
    out: list[Column | Period] = []
    for cell in cells:
        if isinstance(cell, str):
            period = Period.parse(cell)
            if period is None:
                raise ValueError(f"{cell!r} is neither a column nor an ISO duration")
            out.append(period)
        else:
            out.append(parse_time_ladder(cell, pattern, zone))
    periods = sum(isinstance(e, Period) for e in out)
    if not 1 <= len(out) <= 2 or periods == len(out):
        raise ValueError("a time needs one or two endpoints, and at most one of two may be a duration")
    return out


def combine(ends: Sequence[Column | Period], end_given: Column | None = None) -> Column:
    """``struct(start, end, error)`` from parsed endpoints; ``end_given`` is false for an empty end cell."""
    no_problem = F.lit(None).cast("string")
    if len(ends) == 1:
        return _interval(ends[0], F.lit(None).cast("timestamp"), no_problem)
    first, second = ends
    if isinstance(first, Period):
        return _interval(second + first.interval(-1), second, no_problem)
    if isinstance(second, Period):
        return _interval(first, first + second.interval(), no_problem)
    given = F.lit(True) if end_given is None else end_given
    return _interval(first, second, F.when(given & second.isNull(), "Could not parse time"))


def is_given(cell: Column) -> Column:
    return F.coalesce(cell, F.lit("")) != ""


def time_object(cells: Sequence[Column | str], pattern: str | None = None, zone: str = "UTC") -> Column:
    """Instant or interval from one or two endpoints as ``struct(start, end, error)``.

    An endpoint is a text Column, or an ISO duration given as Python text that is measured from
    the other endpoint. An empty end makes the time an instant.
    """
    given = is_given(cells[1]) if len(cells) == 2 and not isinstance(cells[1], str) else None
    return combine(endpoints(cells, pattern, zone), given)


def to_time_object(start: Column, end: Column | None = None, zone: str = "UTC") -> Column:
    """Time object from timestamp columns; zone-less ones are read in ``zone``."""

    def instant(value: Column) -> Column:
        return F.convert_timezone(F.lit(zone_name(zone)), F.lit("UTC"), value).cast("timestamp")

    none = F.lit(None).cast("timestamp")
    return _interval(instant(start), none if end is None else instant(end), F.lit(None).cast("string"))


def time_start(start: Column | str = "phen_start") -> Column:
    """The instant a time object is compared by."""
    return F.col(start) if isinstance(start, str) else start


def time_mid(start: Column | str = "phen_start", end: Column | str = "phen_end") -> Column:
    """Middle of an interval; an instant is its own middle."""
    first = time_start(start)
    last = F.coalesce(F.col(end) if isinstance(end, str) else end, first)
    half = F.shiftright(F.unix_micros(last) - F.unix_micros(first), 1)
    return F.timestamp_micros(F.unix_micros(first) + half)


def now_literal(now: dt.datetime | str) -> Column:
    """An explicit 'now': runs are reproducible because nothing reads the clock."""
    text = now.isoformat(sep=" ") if isinstance(now, dt.datetime) else str(now)
    return F.lit(text).cast("timestamp")


def bound_from(instant: dt.datetime | str) -> Column:
    return now_literal(instant)


# The length of each unit as a fixed duration in seconds.
UNIT_SECONDS = {
    "SECONDS": 1,
    "MINUTES": 60,
    "HOURS": 3600,
    "HALF_DAYS": 43200,
    "DAYS": 86400,
    "WEEKS": 604800,
    "MONTHS": 2629746,
    "YEARS": 31556952,
}


def bound_ago(now: dt.datetime | str | Column, amount: int, unit: str) -> Column:
    """``amount`` units before now, each unit taken at its estimated fixed length."""
    base = now if isinstance(now, Column) else now_literal(now)
    seconds = amount * UNIT_SECONDS[unit.upper()]
    return base - F.make_dt_interval(F.lit(seconds // 86400), F.lit(0), F.lit(0), F.lit(seconds % 86400))
