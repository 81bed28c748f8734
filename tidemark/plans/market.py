"""Queries over ``events`` read as ticks: candles, rollups, alerts, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import formatting as FMT
from tidemark.operators import alerts as A
from tidemark.operators import candles as C
from tidemark.operators import marts as M
from tidemark.plans.registry import register
from tidemark.sources.fixtures import event_ticks, sql_ticks

# Gaps between ticks of one event type average about 20 minutes at sf0.01,
# so the fixture uses a 6 h window and 30 min warm-up; a 2 % threshold would
# flag nearly every row, so the alert fixtures use 100 %.
FIX_WINDOW_S = 6 * 3600
FIX_WARMUP_S = 1800
FIX_THRESHOLD = 1.0


def _r9(df, *cols):
    return df.select(*[F.round(c, 9).alias(c) if c in cols else F.col(c) for c in df.columns])


_CANDLE_SQL = """
SELECT asset_id, {bucket} AS bucket,
       arg_min_null(price, ingested_at) AS open, max(price) AS high, min(price) AS low,
       arg_max_null(price, ingested_at) AS close,
       arg_max_null(volume_24h, ingested_at) AS volume_24h, count(*) AS ticks
FROM ({ticks}) t
GROUP BY ALL
"""


def _candle_sql(bucket: str) -> str:
    return _CANDLE_SQL.format(bucket=bucket, ticks=sql_ticks())


@register("candles_1m", _candle_sql("time_bucket(INTERVAL '1 minute', ingested_at)"))
def candles_1m(spark, sf):
    return C.candles(event_ticks(spark, sf), "1 minute")


@register("candles_5m", _candle_sql("time_bucket(INTERVAL '5 minutes', ingested_at)"))
def candles_5m(spark, sf):
    return C.candles(event_ticks(spark, sf), "5 minutes")


@register("candles_1h", _candle_sql("date_trunc('hour', ingested_at)"))
def candles_1h(spark, sf):
    return C.candles(event_ticks(spark, sf), "1 hour")


@register("candles_daily_from_hourly", _candle_sql("date_trunc('day', ingested_at)"))
def candles_daily_from_hourly(spark, sf):
    return C.rollup_candles(C.candles(event_ticks(spark, sf), "1 hour"), "day")


@register("candles_weekly", _candle_sql("date_trunc('week', ingested_at)"))
def candles_weekly(spark, sf):
    return C.rollup_candles(C.candles(event_ticks(spark, sf), "1 hour"), "week")


_DEFAULT_SQL_METRICS = (("price", "price"), ("volume", "volume_24h"))


def _alert_sql(hourly: bool, windows=(FIX_WINDOW_S,), threshold=FIX_THRESHOLD,
               warmup=FIX_WARMUP_S, metrics=_DEFAULT_SQL_METRICS) -> str:
    parts = []
    cols = list(dict.fromkeys(c for _, c in metrics))
    avgs = ", ".join(f"avg(b.{c}) AS base_{c}" for c in cols)
    acols = ", ".join(f"a.{c}" for c in cols)
    for w in windows:
        parts.append(f"""
SELECT a.asset_id, a.ts, {acols}, {w} AS window_s,
       count(b.asset_id) AS samples, {avgs}, min(b.ts) AS oldest
FROM t a LEFT JOIN t b
  ON b.asset_id = a.asset_id AND b.ingested_at < a.ingested_at
 AND b.ts >= a.ts - INTERVAL {w} SECOND
GROUP BY a.asset_id, a.ts, a.ingested_at, {acols}""")
    stats = " UNION ALL ".join(parts)
    per_metric = "\n  UNION ALL\n".join(
        f"  SELECT asset_id, ts, window_s, samples, oldest, '{name}' AS metric, {c} AS value, "
        f"base_{c} AS baseline FROM w" for name, c in metrics)
    return f"""
WITH t AS ({sql_ticks(hourly)}),
w AS ({stats}),
c AS (
{per_metric}
)
SELECT asset_id, metric, value, round(baseline, 9) AS baseline,
       round((value - baseline) / baseline, 9) AS change_pct,
       CAST({threshold} AS DOUBLE) AS threshold, CAST(window_s AS INTEGER) AS window_s,
       samples, ts
FROM c
WHERE samples > 0 AND ts - oldest >= INTERVAL {warmup} SECOND
  AND value IS NOT NULL AND baseline IS NOT NULL AND baseline <> 0
  AND abs((value - baseline) / baseline) > {threshold} AND NOT isnan((value - baseline) / baseline)
"""


@register("trailing_alerts", _alert_sql(hourly=False))
def trailing_alerts(spark, sf):
    """Flagship: price and volume deviation from the trailing 6 h mean."""
    out = A.trailing_alerts(event_ticks(spark, sf), FIX_WINDOW_S, FIX_THRESHOLD, FIX_WARMUP_S)
    return _r9(out, "baseline", "change_pct")


@register("trailing_alerts_ties", _alert_sql(hourly=True))
def trailing_alerts_ties(spark, sf):
    """Source time frozen per hour: many ticks share one ``ts`` (design P1)."""
    out = A.trailing_alerts(event_ticks(spark, sf, hourly_ts=True), FIX_WINDOW_S,
                            FIX_THRESHOLD, FIX_WARMUP_S)
    return _r9(out, "baseline", "change_pct")


@register("trailing_alerts_multi_window",
          _alert_sql(hourly=True, windows=(3 * 3600, FIX_WINDOW_S, 24 * 3600)))
def trailing_alerts_multi_window(spark, sf):
    out = A.multi_window_alerts(event_ticks(spark, sf, hourly_ts=True),
                                (3 * 3600, FIX_WINDOW_S, 24 * 3600), FIX_THRESHOLD, FIX_WARMUP_S)
    return _r9(out, "baseline", "change_pct")


@register("trailing_alerts_dense", _alert_sql(hourly=False, windows=(24 * 3600,)))
def trailing_alerts_dense(spark, sf):
    """E1 with a 24 h window (many readings per window)."""
    out = A.trailing_alerts(event_ticks(spark, sf), 24 * 3600, FIX_THRESHOLD, FIX_WARMUP_S)
    return _r9(out, "baseline", "change_pct")


# one huge and one infinite reading a day, which must leave no trace once evicted
_ODD_PRICE = "CASE WHEN hour({ts}) = 1 AND minute({ts}) < 20 THEN {inf} WHEN hour({ts}) = 2 AND minute({ts}) < 20 THEN 1e17 ELSE {p} END"


def _digits_sql(x: str) -> str:
    """Nine decimals, of large numbers nine significant digits."""
    return f"CASE WHEN isinf({x}) THEN {x} WHEN abs({x}) < 1e6 THEN round({x}, 9) ELSE CAST(printf('%.8e', {x}) AS DOUBLE) END"


def _digits(c: str):
    x, large = F.col(c), F.format_string("%.8e", c).cast("double")
    return F.when(F.abs(x) == float("inf"), x).when(F.abs(x) < 1e6, F.round(x, 9)).otherwise(large).alias(c)


@register("trailing_alerts_outlier", _alert_sql(hourly=False, metrics=(("price", "price"),)).replace(
    "value AS price", _ODD_PRICE.format(ts="ts", inf="'inf'::DOUBLE", p="value") + " AS price")
    .replace("round(baseline, 9)", _digits_sql("baseline"))
    .replace("round((value - baseline) / baseline, 9)", _digits_sql("((value - baseline) / baseline)")))
def trailing_alerts_outlier(spark, sf):
    """E1 with huge and infinite readings: they alert, readings beside a huge
    one do as well, and once it has left the window the baseline is what it
    would be without it."""
    odd = F.expr(_ODD_PRICE.format(ts="ingested_at", inf="double('inf')", p="price"))
    ticks = event_ticks(spark, sf).withColumn("price", odd)
    out = A.trailing_alerts(ticks, FIX_WINDOW_S, FIX_THRESHOLD, FIX_WARMUP_S, metrics=["price"])
    return out.select(*[_digits(c) if c in ("baseline", "change_pct") else c for c in out.columns])


_ANY = (("market_cap", "market_cap"), ("change_24h", "change_24h"))


@register("trailing_alerts_any_metric", _alert_sql(hourly=True, metrics=_ANY))
def trailing_alerts_any_metric(spark, sf):
    """Alerts on market cap and on the signed 24 h change (a negative
    baseline flips the sign of ``change_pct``, as in the sequential rule)."""
    out = A.trailing_alerts(event_ticks(spark, sf, hourly_ts=True), FIX_WINDOW_S, FIX_THRESHOLD,
                            FIX_WARMUP_S, metrics=dict(_ANY))
    return _r9(out, "baseline", "change_pct")


def _zscore_sql(ticks: str, digits: int) -> str:
    """Large scores are compared in tens: doubles hold no more of them."""
    return f"""
WITH t AS ({ticks}),
w AS (
  SELECT a.asset_id, a.ts, a.price, a.volume_24h, count(b.asset_id) AS samples,
         avg(b.price) AS m_price, stddev_pop(b.price) AS sd_price,
         avg(b.volume_24h) AS m_volume, stddev_pop(b.volume_24h) AS sd_volume, min(b.ts) AS oldest
  FROM t a LEFT JOIN t b
    ON b.asset_id = a.asset_id AND b.ingested_at < a.ingested_at
   AND b.ts >= a.ts - INTERVAL {FIX_WINDOW_S} SECOND
  GROUP BY a.asset_id, a.ts, a.ingested_at, a.price, a.volume_24h),
c AS (
  SELECT asset_id, ts, samples, oldest, 'price' AS metric, price AS value, m_price AS mean, sd_price AS sd FROM w
  UNION ALL
  SELECT asset_id, ts, samples, oldest, 'volume', volume_24h, m_volume, sd_volume FROM w)
SELECT asset_id, metric, value, round(mean, {digits}) AS mean, round(sd, {digits}) AS stddev,
       CASE WHEN abs((value - mean) / sd) < 1000 THEN round((value - mean) / sd, {digits})
            ELSE round((value - mean) / sd, -1) END AS zscore, CAST(2.0 AS DOUBLE) AS k,
       CAST({FIX_WINDOW_S} AS INTEGER) AS window_s, samples, ts
FROM c
WHERE samples > 0 AND ts - oldest >= INTERVAL {FIX_WARMUP_S} SECOND AND value IS NOT NULL
  AND sd > 0 AND abs(value - mean) > 2.0 * sd
"""


def _zscores(ticks, digits):
    out = A.zscore_alerts(ticks, FIX_WINDOW_S, 2.0, FIX_WARMUP_S)
    z = F.when(F.abs("zscore") < 1000, F.round("zscore", digits)).otherwise(F.round("zscore", -1))
    return out.withColumn("zscore", z).select(
        *[F.round(c, digits).alias(c) if c in ("mean", "stddev") else F.col(c) for c in out.columns])


@register("zscore_alerts", _zscore_sql(sql_ticks(True), 6))
def zscore_alerts(spark, sf):
    """|value - mean| above 2 standard deviations of the trailing 6 h."""
    return _zscores(event_ticks(spark, sf, hourly_ts=True), 6)


# a price that jumps from 1 to 60000 at noon of every day, with a small jitter
_SHIFT = "CASE WHEN hour({ts}) < 12 THEN 1.0D ELSE 60000.0D END + {p} / 1000.0D"


@register("zscore_alerts_shift", _zscore_sql(
    "SELECT * REPLACE (" + _SHIFT.replace("0D", "0").format(ts="ingested_at", p="price")
    + f" AS price) FROM ({sql_ticks(True)}) s", 3))
def zscore_alerts_shift(spark, sf):
    """E7 across a shift of level far above the jitter on either side."""
    ticks = event_ticks(spark, sf, hourly_ts=True)
    return _zscores(ticks.withColumn("price", F.expr(_SHIFT.format(ts="ingested_at", p="price"))), 3)


@register("late_ticks", """
WITH t AS (
  SELECT event_type AS asset_id, ts AS ingested_at,
         ts - to_minutes(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS ts
  FROM events),
m AS (
  SELECT *, max(ts) OVER (PARTITION BY asset_id ORDER BY ingested_at
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_max_ts
  FROM t)
SELECT asset_id, ts, ingested_at, prior_max_ts,
       (epoch_us(prior_max_ts) - epoch_us(ts)) / 1000000.0 AS lag_s
FROM m WHERE ts < prior_max_ts
""")
def late_ticks(spark, sf):
    """Source times running behind earlier arrivals of the same asset
    (arrival = event time, the source clock lagging by ``props.k`` minutes)."""
    out = A.late_ticks(event_ticks(spark, sf, source_lag=True))
    return out.select("asset_id", "ts", "ingested_at", "prior_max_ts", "lag_s")


@register("newest_n", f"""
SELECT * FROM ({sql_ticks()}) t ORDER BY ingested_at DESC, asset_id LIMIT 10
""")
def newest_n(spark, sf):
    """the ten newest ticks."""
    return M.newest(event_ticks(spark, sf), 10)


@register("latest_per_asset", f"""
SELECT * FROM ({sql_ticks()}) t
QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY ingested_at DESC) = 1
""")
def latest_per_asset(spark, sf):
    """last price per asset."""
    return M.latest_per_asset(event_ticks(spark, sf))


@register("recent_n_per_asset", f"""
SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY ingested_at DESC) AS rank
FROM ({sql_ticks()}) t
QUALIFY rank <= 25
""")
def recent_n_per_asset(spark, sf):
    """the 25 newest ticks of every asset."""
    return M.recent_per_asset(event_ticks(spark, sf), 25).withColumn("rank", F.col("rank").cast("long"))


@register("realtime_candles", _candle_sql("date_trunc('hour', ingested_at)"))
def realtime_candles(spark, sf):
    """Hourly rollup materialised through 2024-01-20 plus live buckets."""
    ticks = event_ticks(spark, sf)
    mark = "2024-01-20 00:00:00"
    stored = C.candles(ticks.where(F.col("ingested_at") < F.lit(mark).cast("timestamp")), "1 hour")
    return C.realtime_candles(stored, ticks, mark, "1 hour")


@register("refresh_candles", _candle_sql("date_trunc('hour', ingested_at)").replace(
    "GROUP BY ALL", "WHERE ingested_at < TIMESTAMP '2024-01-15 23:00:00' GROUP BY ALL"))
def refresh_candles(spark, sf):
    """A rollup last computed at 12:30 on 2024-01-15 (its 12:00 bucket is
    partial) refreshed at midnight with a 1 day / 1 hour policy."""
    ticks = event_ticks(spark, sf)
    stale = C.candles(ticks.where(F.col("ingested_at") < F.lit("2024-01-15 12:30:00").cast("timestamp")),
                      "1 hour")
    return C.refresh(stale, ticks, "2024-01-16 00:00:00", "1 day", "1 hour", "1 hour")


def _alert_fields_sql() -> str:
    return _alert_sql(hourly=True).replace(
        "SELECT asset_id, metric, value, round(baseline, 9) AS baseline,\n       round((value - baseline) / baseline, 9) AS change_pct,",
        "SELECT asset_id, metric, value, baseline,\n       round((value - baseline) / baseline, 6) AS change_pct,")


@register("alert_json", f"""
SELECT asset_id, metric, value, round(baseline, 9) AS baseline, change_pct, threshold, window_s, samples,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS ts
FROM ({_alert_fields_sql()}) a
""")
def alert_json(spark, sf):
    """Alert records serialised to JSON and read back field by field."""
    alerts = A.trailing_alerts(event_ticks(spark, sf, hourly_ts=True), FIX_WINDOW_S,
                               FIX_THRESHOLD, FIX_WARMUP_S)
    fields = "asset_id string, metric string, value double, baseline double, change_pct double, " \
             "threshold double, window_s int, samples long, ts string"
    parsed = FMT.alert_json(alerts).select(F.from_json("value", fields).alias("r")).select("r.*")
    return parsed.withColumn("baseline", F.round("baseline", 9))


@register("alert_text", f"""
SELECT 'ALERT ' || CASE WHEN change_pct > 0 THEN '▲' ELSE '▼' END || ' ' || asset_id || ' ' || metric
       || ' ' || printf('%+.2f%%', change_pct * 100) || ' vs ' || CAST(window_s // 60 AS VARCHAR)
       || 'm avg (value=' || printf('%.4g', value) || ', baseline=' || printf('%.4g', baseline)
       || ', n=' || CAST(samples AS VARCHAR) || ')' AS value
FROM ({_alert_sql(hourly=True)}) a
""")
def alert_text(spark, sf):
    """Console lines of the alerts (9-place values, as in the alert queries)."""
    return FMT.alert_text(trailing_alerts_ties(spark, sf))
