"""Fixed schemas of the engine's tables (tick, asset, alert, candle, landed payload)."""

from __future__ import annotations

from pyspark.sql import types as T

TICK = T.StructType([
    T.StructField("asset_id", T.StringType(), False),
    T.StructField("ts", T.TimestampType(), False),
    T.StructField("ingested_at", T.TimestampType(), False),
    T.StructField("price", T.DoubleType(), False),
    T.StructField("volume_24h", T.DoubleType(), True),
    T.StructField("market_cap", T.DoubleType(), True),
    T.StructField("change_24h", T.DoubleType(), True),
])
TICK_COLUMNS = [f.name for f in TICK.fields]
TICK_KEY = ("asset_id", "ingested_at")

ASSET = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("symbol", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("image_url", T.StringType(), True),
    T.StructField("max_supply", T.DoubleType(), True),
    T.StructField("created_at", T.TimestampType(), False),
    T.StructField("updated_at", T.TimestampType(), False),
])

ALERT = T.StructType([
    T.StructField("asset_id", T.StringType(), False),
    T.StructField("metric", T.StringType(), False),
    T.StructField("value", T.DoubleType(), False),
    T.StructField("baseline", T.DoubleType(), False),
    T.StructField("change_pct", T.DoubleType(), False),
    T.StructField("threshold", T.DoubleType(), False),
    T.StructField("window_s", T.IntegerType(), False),
    T.StructField("samples", T.LongType(), False),
    T.StructField("ts", T.TimestampType(), False),
])
ALERT_COLUMNS = [f.name for f in ALERT.fields]

CANDLE = T.StructType([
    T.StructField("asset_id", T.StringType(), False),
    T.StructField("bucket", T.TimestampType(), False),
    T.StructField("open", T.DoubleType(), False),
    T.StructField("high", T.DoubleType(), False),
    T.StructField("low", T.DoubleType(), False),
    T.StructField("close", T.DoubleType(), False),
    T.StructField("volume_24h", T.DoubleType(), True),
    T.StructField("ticks", T.LongType(), False),
])

# A landed poll: the raw response body plus our poll wall-clock time.
PAYLOAD = T.StructType([
    T.StructField("payload", T.StringType(), True),
    T.StructField("ingested_at", T.TimestampType(), True),
])

# /simple/price body parsed to strings first, so one malformed number only
# loses its own asset instead of nulling the whole payload.
PRICE_PAYLOAD = T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType()))

MARKET_ROW = T.StructType([
    T.StructField("id", T.StringType(), True),
    T.StructField("symbol", T.StringType(), True),
    T.StructField("name", T.StringType(), True),
    T.StructField("image", T.StringType(), True),
    T.StructField("max_supply", T.StringType(), True),
])
MARKET_PAYLOAD = T.ArrayType(MARKET_ROW)
