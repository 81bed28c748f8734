"""Alert serialisation as Column expressions (B5 JSON record, B6 console line)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def iso_ts(ts: str | Column) -> Column:
    """ISO-8601 with offset, as Python's ``isoformat`` of a UTC datetime:
    microseconds are printed only when non-zero."""
    t = F.col(ts) if isinstance(ts, str) else ts
    frac = F.unix_micros(t) % F.lit(1_000_000) != 0
    return F.when(frac, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")) \
            .otherwise(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ssxxx"))


def alert_json(alerts: DataFrame) -> DataFrame:
    """One JSON object per alert with the nine record fields;
    ``change_pct`` rounded to 6 places only here. Output column ``value``."""
    rec = F.struct(
        "asset_id", "metric", "value", "baseline",
        F.round("change_pct", 6).alias("change_pct"),
        "threshold", "window_s", "samples", iso_ts("ts").alias("ts"))
    return alerts.select(F.to_json(rec).alias("value"))


def _pyformat(spec: str):
    """Arrow-batched ``format(value, spec)`` with Python's rounding.

    Java's ``%.4g`` / ``%.2f`` round half-up on the shortest decimal form
    (164.45 -> 164.5) while Python rounds the exact binary value (164.4) and
    strips trailing zeros under ``g``; the alert line must read as the
    reference prints it. Alerts are rare rows, so this stays cheap.
    """
    import pandas as pd

    def fmt(v):
        return v.map(lambda x: None if pd.isna(x) else format(float(x), spec))

    # real (not postponed) annotations tell Spark this is a Series -> Series UDF
    fmt.__annotations__ = {"v": pd.Series, "return": pd.Series}
    return F.pandas_udf(fmt, "string")


def g4(x: str | Column) -> Column:
    """Python's ``format(x, '.4g')``."""
    return _pyformat(".4g")(F.col(x) if isinstance(x, str) else x)


def alert_text(alerts: DataFrame) -> DataFrame:
    """``ALERT ▲ bitcoin price +5.00% vs 5m avg (value=105, baseline=100, n=16)``.
    Output column ``value``."""
    arrow = F.when(F.col("change_pct") > 0, F.lit("▲")).otherwise(F.lit("▼"))
    line = F.concat(
        F.lit("ALERT "), arrow, F.lit(" "), F.col("asset_id"), F.lit(" "), F.col("metric"), F.lit(" "),
        _pyformat("+.2%")(F.col("change_pct")), F.lit(" vs "),
        F.expr("window_s div 60").cast("string"), F.lit("m avg (value="), g4("value"),
        F.lit(", baseline="), g4("baseline"), F.lit(", n="), F.col("samples").cast("string"), F.lit(")"))
    return alerts.select(line.alias("value"))
