"""OHLC candles from ticks, rollups of candles, real-time union and refresh.

A candle per ``(keys, bucket)``: ``open`` = price at the earliest ``time``,
``high``/``low`` = max/min price, ``close`` = price at the latest ``time``,
``volume_24h`` = the latest reading (a rolling 24 h figure, never summed; a
null latest reading stays null), ``ticks`` = row count.

All aggregates are partially aggregable, so every candle job is one
map-side-combined hash aggregate and one exchange on ``(keys, bucket)``:
a hot asset is spread over many buckets instead of landing in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import micros, width_micros

# Calendar grains re-bucket with date_trunc (weeks start on Monday);
# anything else is a fixed width floored on the microsecond clock (epoch aligned).
CALENDAR_GRAINS = ("hour", "day", "week", "month", "quarter", "year")


def bucket_of(time: str | Column, width: str) -> Column:
    """Start of the bucket holding ``time``: a calendar grain or a fixed width."""
    t = F.col(time) if isinstance(time, str) else time
    if width in CALENDAR_GRAINS:
        return F.date_trunc(width, t)
    w = F.lit(width_micros(width))
    us = micros(t)
    return F.timestamp_micros(us - F.pmod(us, w))


def candles(ticks: DataFrame, width: str = "1 minute", keys: Sequence[str] = ("asset_id",),
            time: str = "ingested_at", value: str = "price",
            volume: str | None = "volume_24h") -> DataFrame:
    """Candles at any bucket width from raw ticks."""
    aggs = [
        F.min_by(value, time).alias("open"),
        F.max(value).alias("high"),
        F.min(value).alias("low"),
        F.max_by(value, time).alias("close"),
    ]
    if volume is not None:
        aggs.append(F.max_by(volume, time).alias("volume_24h"))
    aggs.append(F.count(F.lit(1)).alias("ticks"))
    return ticks.groupBy(*keys, bucket_of(time, width).alias("bucket")).agg(*aggs)


def rollup_candles(candle_df: DataFrame, grain: str, keys: Sequence[str] = ("asset_id",)) -> DataFrame:
    """Coarser candles from finer ones; equal to candles from raw ticks
    whenever every fine bucket lies inside one coarse bucket."""
    aggs = [
        F.min_by("open", "bucket").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "bucket").alias("close"),
    ]
    if "volume_24h" in candle_df.columns:
        aggs.append(F.max_by("volume_24h", "bucket").alias("volume_24h"))
    aggs.append(F.sum("ticks").alias("ticks"))
    return candle_df.groupBy(*keys, bucket_of("bucket", grain).alias("bucket")).agg(*aggs)


def realtime_candles(rollup: DataFrame, ticks: DataFrame, completed_through,
                     width: str = "1 minute", keys: Sequence[str] = ("asset_id",),
                     time: str = "ingested_at") -> DataFrame:
    """Materialised buckets before ``completed_through`` plus buckets
    computed live from raw ticks at or after it (the mark is bucket-aligned).

    ``completed_through=None`` means nothing is materialised yet: all from raw.
    Both filters reach the scans, so the live branch reads only recent files.
    """
    if completed_through is None:
        return candles(ticks, width, keys, time)
    hi = F.lit(completed_through).cast("timestamp")
    old = rollup.where(F.col("bucket") < hi)
    live = candles(ticks.where(F.col(time) >= hi), width, keys, time)
    return old.unionByName(live.select(*old.columns))


def refresh_window(now, start_offset: str, end_offset: str, width: str) -> tuple[Column, Column]:
    """Bucket-aligned ``[lo, hi)`` of a refresh: buckets fully inside
    ``[now - start_offset, now - end_offset)``."""
    n = F.lit(now).cast("timestamp")
    start = n - F.expr(f"INTERVAL {start_offset}")
    end = n - F.expr(f"INTERVAL {end_offset}")
    lo_floor = bucket_of(start, width)
    step = F.expr(f"INTERVAL 1 {width}") if width in CALENDAR_GRAINS else F.expr(f"INTERVAL {width}")
    lo = F.when(lo_floor < start, lo_floor + step).otherwise(lo_floor)
    hi = bucket_of(end, width)
    return lo, hi


def refresh(rollup: DataFrame, ticks: DataFrame, now, start_offset: str, end_offset: str,
            width: str = "1 minute", keys: Sequence[str] = ("asset_id",),
            time: str = "ingested_at", full: bool = False) -> DataFrame:
    """Recompute the buckets fully inside the refresh window from raw
    ticks and keep every other stored bucket as is.

    Our definition: ticks landing later than ``start_offset`` do not change
    the rollup; ``full=True`` rebuilds everything from raw.
    """
    if full:
        return candles(ticks, width, keys, time)
    lo, hi = refresh_window(now, start_offset, end_offset, width)
    in_window = (F.col("bucket") >= lo) & (F.col("bucket") < hi)
    kept = rollup.where(~in_window)
    fresh = candles(ticks.where((F.col(time) >= lo) & (F.col(time) < hi)), width, keys, time)
    return kept.unionByName(fresh.select(*kept.columns))
