"""Time conversions and the size-checked broadcast used across operators."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Dimension sides at or below this estimate are broadcast explicitly; above it
# the join stays a shuffle join and AQE may still broadcast from runtime sizes.
# The estimate is of compressed, pruned bytes, so the limit is low.
DEFAULT_BROADCAST_BYTES = 1024 * 1024


_UNIT_MICROS = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000, "week": 7 * 86_400_000_000,
}


def width_micros(width: str | int | float) -> int:
    """Fixed bucket width in microseconds: ``"5 minutes"``, ``"1 hour"`` or seconds."""
    if isinstance(width, (int, float)):
        return int(round(width * 1_000_000))
    m = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", width.lower())
    if not m or m.group(2) not in _UNIT_MICROS:
        raise ValueError(f"not a fixed width: {width!r}")
    return int(m.group(1)) * _UNIT_MICROS[m.group(2)]


def micros(col: str | Column) -> Column:
    """Microseconds since the epoch of a TIMESTAMP (or TIMESTAMP_NTZ read as UTC)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_micros(c.cast(T.TimestampType()))


def from_micros(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_micros(c)


def to_ntz(df: DataFrame) -> DataFrame:
    """Cast every TIMESTAMP column to TIMESTAMP_NTZ (UTC wall clock) for export."""
    cols = [
        F.col(f.name).cast(T.TimestampNTZType()).alias(f.name)
        if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of ``df`` (compressed bytes for file scans)."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(str(size))  # py4j hands back an int or a BigInt proxy
    except Exception:  # noqa: BLE001 -- no JVM handle (e.g. Spark Connect)
        return None


def partitions_for(df: DataFrame, part_bytes: int) -> int:
    """Partitions for an exchange of ``df``: the session's, or up to eight times as
    many so that each has about ``part_bytes`` of the estimated (compressed)
    size. Give the number to ``repartition``: AQE merges partitions by their
    compressed bytes, a small part of what sorts and hash tables hold of them."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(max(least, (estimated_bytes(df) or 0) // part_bytes), 8 * least)


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when the side's estimated size is proven small."""
    est = estimated_bytes(df)
    if est is not None and est <= max_bytes:
        return F.broadcast(df)
    return df
