"""Where the next incremental request of each datastream starts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.times import now_literal
from gaugeflow.model import STREAM_KEY


def bound_newer(datastreams: DataFrame, target: DataFrame, default) -> DataFrame:
    """``kind, ds_id, bound``: just after what is stored.

    A datastream starts one second after its extent's end; without an extent at the end of its
    last interval, or one second after its last instant; else at the default. A multi-datastream
    starts at its extent's end itself.
    """
    last = target.groupBy(*STREAM_KEY).agg(
        F.max_by(F.struct("phen_start", "phen_end"), F.struct("phen_start", F.coalesce("phen_end", "phen_start"))).alias("_l")
    )
    # Both sides hold one row per datastream.
    joined = datastreams.join(last, STREAM_KEY, "left")
    second = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(1))
    extent = F.coalesce(F.col("phen_end"), F.col("phen_start"))
    observed = F.coalesce(F.col("_l.phen_end"), F.col("_l.phen_start") + second)
    multi = F.coalesce(extent, F.col("_l.phen_start") + second)
    single = F.coalesce(extent + second, observed)
    return joined.select(
        *STREAM_KEY, F.coalesce(F.when(F.col("kind") == "M", multi).otherwise(single), now_literal(default)).alias("bound")
    )


def request_intervals(bounds: DataFrame, now, template: str, local_id: str = "ds_id") -> DataFrame:
    """``kind, ds_id, req_start, req_end, url`` truncated to minutes and filled into a template."""
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    start = F.date_trunc("minute", "bound")
    base = now if isinstance(now, Column) else now_literal(now)
    end = F.date_trunc("minute", base)
    interval = F.concat(F.date_format(start, iso), F.lit("/"), F.date_format(end, iso))
    url = F.replace(F.lit(template), F.lit("{datastreamLocalId}"), F.col(local_id))
    url = F.replace(url, F.lit("{phenomenonTimeInterval}"), interval)
    return bounds.select(*STREAM_KEY, start.alias("req_start"), end.alias("req_end"), url.alias("url"))
