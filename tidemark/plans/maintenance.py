"""Table jobs on a tick store written from ``events`` (A7, K4, K5, D7 persisted).

Each query first writes the store to a fresh folder under the session's
``spark.checkpoint.dir`` and then returns a lazy read of the result.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import candles as C
from tidemark.plans.ingest import _MARKETS_SQL
from tidemark.plans.market import _candle_sql
from tidemark.plans.registry import register
from tidemark.sources import erasure as ER
from tidemark.sources import store as S
from tidemark.sources import fixtures as FX
from tidemark.sources.fixtures import event_ticks, sql_ticks
from tidemark.sources.payloads import write_landed


def _store(spark, sf):
    path = S.scratch_path(spark, "ticks")
    S.append_ticks(event_ticks(spark, sf), path)
    return path


@register("time_range_scan", f"""
SELECT *, CAST(ingested_at AS DATE) AS ingest_date FROM ({sql_ticks()}) t
WHERE ingested_at >= TIMESTAMP '2024-01-10 00:00:00' AND ingested_at < TIMESTAMP '2024-01-12 06:00:00'
  AND asset_id IN ('click', 'view')
""")
def time_range_scan(spark, sf):
    """Two assets over 2.25 days; only three day folders are read."""
    return S.scan_ticks(spark, _store(spark, sf), "2024-01-10 00:00:00", "2024-01-12 06:00:00",
                        ["click", "view"])


@register("compacted_equals_raw", f"""
SELECT *, CAST(ingested_at AS DATE) AS ingest_date,
       CASE WHEN CAST(ingested_at AS DATE) < DATE '2024-01-24' THEN true END AS in_order
FROM ({sql_ticks()}) t""")
def compacted_equals_raw(spark, sf):
    """K4: days older than a week before 2024-01-31 compacted; the table
    still holds exactly the raw ticks, and every row of a compacted file
    follows the one before it by asset, newest first."""
    path = _store(spark, sf)
    S.compact(spark, path, 7, "2024-01-31 00:00:00")
    rows = spark.read.parquet(path).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    before = Window.partitionBy("_file").orderBy("_row")
    asset, at = F.lag("asset_id").over(before), F.lag("ingested_at").over(before)
    follows = asset.isNull() | (asset < F.col("asset_id")) | ((asset == F.col("asset_id")) & (at >= F.col("ingested_at")))
    return rows.withColumn("in_order", F.when(F.col(S.PART) < F.lit("2024-01-24").cast("date"), follows)) \
        .drop("_file", "_row")


@register("after_retention", f"""
SELECT *, CAST(ingested_at AS DATE) AS ingest_date FROM ({sql_ticks()}) t
WHERE CAST(ingested_at AS DATE) >= DATE '2024-01-21'
""")
def after_retention(spark, sf):
    """K5: raw days older than 10 days before 2024-01-31 dropped once the
    hourly rollup covers them."""
    path = _store(spark, sf)
    rollup = C.candles(spark.read.parquet(path), "1 hour")
    S.apply_retention(spark, path, 10, "2024-01-31 00:00:00", dry_run=False, rollup=rollup)
    return spark.read.parquet(path)


@register("refresh_persisted", _candle_sql("date_trunc('hour', ingested_at)").replace(
    "GROUP BY ALL", "WHERE ingested_at < TIMESTAMP '2024-01-15 23:00:00' GROUP BY ALL"))
def refresh_persisted(spark, sf):
    """D7 on disk: a stale hourly rollup table refreshed in place; only the
    touched day partitions are rewritten."""
    ticks = event_ticks(spark, sf)
    path = S.scratch_path(spark, "rollup")
    stale = C.candles(ticks.where(F.col("ingested_at") < F.lit("2024-01-15 12:30:00").cast("timestamp")),
                      "1 hour")
    stale.withColumn("bucket_date", F.to_date("bucket")).write.partitionBy("bucket_date").parquet(path)
    S.refresh_table(spark, path, ticks, "2024-01-16 00:00:00", "1 day", "1 hour", "1 hour")
    return spark.read.parquet(path).drop("bucket_date")


@register("refresh_emptied_day", _candle_sql("date_trunc('hour', ingested_at)").replace(
    "GROUP BY ALL", """WHERE ingested_at < TIMESTAMP '2024-01-16 23:00:00'
  AND CAST(ingested_at AS DATE) <> DATE '2024-01-15' GROUP BY ALL"""))
def refresh_emptied_day(spark, sf):
    """All ticks of a day inside the window were removed; its candles go."""
    ticks = event_ticks(spark, sf)
    path = S.scratch_path(spark, "rollup")
    stale = C.candles(ticks.where(F.col("ingested_at") < F.lit("2024-01-16 00:00:00").cast("timestamp")), "1 hour")
    stale.withColumn("bucket_date", F.to_date("bucket")).write.partitionBy("bucket_date").parquet(path)
    left = ticks.where(F.to_date("ingested_at") != F.lit("2024-01-15").cast("date"))
    S.refresh_table(spark, path, left, "2024-01-17 00:00:00", "2 days", "1 hour", "1 hour")
    return spark.read.parquet(path).drop("bucket_date")


@register("realtime_persisted", _candle_sql("date_trunc('hour', ingested_at)"))
def realtime_persisted(spark, sf):
    """D6 on disk: the refreshed rollup up to its stored mark, live after it."""
    ticks = event_ticks(spark, sf)
    path = S.scratch_path(spark, "rollup")
    stale = C.candles(ticks.where(F.col("ingested_at") < F.lit("2024-01-15 12:30:00").cast("timestamp")),
                      "1 hour")
    stale.withColumn("bucket_date", F.to_date("bucket")).write.partitionBy("bucket_date").parquet(path)
    S.refresh_table(spark, path, ticks, "2024-01-16 00:00:00", "1 day", "1 hour", "1 hour")
    return S.realtime_table(spark, path, ticks, "1 hour")


@register("seed_assets", f"""
SELECT id, symbol, 'Renamed' || substr(name, 9) AS name, image_url, max_supply,
       TIMESTAMP '2024-03-01 00:00:00' AS created_at, TIMESTAMP '2024-03-02 00:00:00' AS updated_at
FROM ({_MARKETS_SQL}) m
""")
def seed_assets(spark, sf):
    """C2 + A3: market payloads that list each asset twice, under an old and
    a new name, seed the asset table; the last row wins. A second run updates."""
    old = FX.customer_market_payloads(spark, sf)
    new = F.replace("payload", F.lit('"name":"Customer'), F.lit('"name":"Renamed'))
    twice = F.concat(F.expr("substr(payload, 1, length(payload) - 1)"), F.lit(","), F.substring(new, 2, 2**31 - 1))
    landing, assets = S.scratch_path(spark, "markets"), S.scratch_path(spark, "assets")
    write_landed(old.withColumn("payload", twice), landing)
    S.seed_assets(spark, landing, assets, "2024-03-01 00:00:00")
    return S.seed_assets(spark, landing, assets, "2024-03-02 00:00:00")


@register("erase_undated", f"""
SELECT t.*, CASE WHEN hour(ingested_at) <> 5 THEN CAST(t.ingested_at AS DATE) END AS ingest_date FROM ({sql_ticks()}) t
WHERE asset_id NOT IN ('click', 'view')
""")
def erase_undated(spark, sf):
    """Two assets erased from a store that also holds rows without a date."""
    path = S.scratch_path(spark, "ticks")
    dated = F.when(F.hour("ingested_at") != 5, F.to_date("ingested_at"))
    event_ticks(spark, sf).withColumn(S.PART, dated).write.partitionBy(S.PART).parquet(path)
    subjects = spark.createDataFrame([("click",), ("view",)], "asset_id string")
    S.erase_in_store(spark, path, subjects, "asset_id")
    return spark.read.parquet(path)


@register("erase_in_store", f"""
SELECT t.*, CAST(t.ingested_at AS DATE) AS ingest_date FROM ({sql_ticks()}) t
WHERE t.ingested_at NOT IN (SELECT ts FROM events WHERE user_id = 7)
""")
def erase_in_store(spark, sf):
    """L15 on the tick store: every poll of user 7 erased, rewriting only the
    day partitions that held one."""
    path = _store(spark, sf)
    subjects = FX.load(spark, sf, "events").where(F.col("user_id") == 7) \
        .select(F.col("ts").cast("timestamp").alias("ingested_at"))
    S.erase_in_store(spark, path, subjects, "ingested_at")
    return spark.read.parquet(path)


@register("erase_everywhere", f"""
SELECT 'store' AS layer, asset_id, ingested_at AS time, price AS value FROM ({sql_ticks()}) t WHERE asset_id <> 'click'
UNION ALL
SELECT 'candles', asset_id, bucket, high FROM ({_candle_sql("date_trunc('hour', ingested_at)")}) c WHERE asset_id <> 'click'
UNION ALL
SELECT 'market', 'all', time_bucket(INTERVAL '1 hour', ingested_at), max(price) FROM ({sql_ticks()}) t
WHERE asset_id <> 'click' GROUP BY 3
UNION ALL
SELECT 'alerts', event_type, ts, value FROM events WHERE event_type <> 'click' AND value > 300
UNION ALL
SELECT 'bronze', event_type, ts, NULL FROM events WHERE event_type <> 'click'
UNION ALL
SELECT 'audit', 'store', NULL, count(*) FROM events WHERE event_type = 'click'
UNION ALL
SELECT 'audit', 'alerts', NULL, count(*) FROM events WHERE event_type = 'click' AND value > 300
UNION ALL
SELECT 'audit', 'bronze', NULL, count(*) FROM events WHERE event_type = 'click'
""")
def erase_everywhere(spark, sf):
    """L15 through all layers: one asset is gone from the tick store, its
    candles, the market-wide candles (recomputed), the alert log and the landed
    payloads; the audit tells how many rows went where."""
    ticks = event_ticks(spark, sf)
    store, hourly, market, alerts, bronze, audit = (
        S.scratch_path(spark, n) for n in ("ticks", "candles", "market", "alerts", "bronze", "audit"))
    S.append_ticks(ticks, store)
    dated = lambda df: df.withColumn("bucket_date", F.to_date("bucket")).write.partitionBy("bucket_date")
    dated(C.candles(ticks, "1 hour")).parquet(hourly)
    whole = ticks.withColumn("asset_id", F.lit("all"))
    dated(C.candles(whole, "1 hour", keys=())).parquet(market)
    end = "2024-02-10 00:00:00"
    S.refresh_table(spark, market, ticks, end, "1 day", "1 hour", "1 hour", keys=())
    ticks.where("price > 300").select(F.to_json(F.struct(
        "asset_id", F.col("ingested_at").cast("string").alias("ingested_at"), "price")).alias("value")).write.text(alerts)
    write_landed(FX.event_price_payloads(spark, sf), bronze, "parquet")
    layers = [
        ER.Layer("market", "rollup", market, width="1 hour", keys=(), source="store"),
        ER.Layer("store", "table", store), ER.Layer("candles", "table", hourly, partition="bucket_date"),
        ER.Layer("alerts", "lines", alerts), ER.Layer("bronze", "payloads", bronze)]
    subjects = spark.createDataFrame([("click",)], "asset_id string")
    done = ER.erase_everywhere(spark, layers, subjects, "r1", "2024-03-01 00:00:00", audit)
    none = F.lit(None)
    line = F.from_json("value", "asset_id string, ingested_at string, price double")
    said = lambda layer, df, *c: df.select(F.lit(layer).alias("layer"), *[x.alias(n) for x, n in zip(c, ("asset_id", "time", "value"))])
    col = F.col
    parts = [
        said("store", spark.read.parquet(store), col("asset_id"), col("ingested_at"), col("price")),
        said("candles", spark.read.parquet(hourly), col("asset_id"), col("bucket"), col("high")),
        said("market", spark.read.parquet(market), F.lit("all"), col("bucket"), col("high")),
        said("alerts", spark.read.text(alerts).select(line.alias("r")).select("r.*"), col("asset_id"), col("ingested_at").cast("timestamp"), col("price")),
        said("bronze", spark.read.parquet(bronze).select("ingested_at", F.explode(F.map_keys(F.from_json(
            "payload", "map<string,string>"))).alias("asset_id")), col("asset_id"), col("ingested_at"), none.cast("double")),
        said("audit", done.where("layer IN ('store', 'alerts', 'bronze')"), col("layer"), none.cast("timestamp"), col("rows_removed").cast("double")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
