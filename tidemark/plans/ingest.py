"""Queries over landed payloads built from the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.registry import register
from tidemark.sources import fixtures as FX
from tidemark.sources import payloads as P

# Expected ticks of the event price payloads, straight from ``events``.
_PARSED_SQL = """
SELECT event_type AS asset_id,
       CASE WHEN event_type = 'view' THEN ts
            ELSE make_timestamp((CAST(floor(epoch(ts)) AS BIGINT)
                                 - CAST(json_extract_string(props, '$.k') AS BIGINT)) * 1000000) END AS ts,
       ts AS ingested_at, value AS price,
       nullif(CAST(json_extract_string(props, '$.k') AS DOUBLE), 0) AS volume_24h,
       value * 1000.0 AS market_cap,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) - 50.0 AS change_24h
FROM events
WHERE event_type <> 'error' AND value <= 480
"""


@register("parse_prices", _PARSED_SQL)
def parse_prices(spark, sf):
    return P.parse_prices(FX.event_price_payloads(spark, sf), vs="usd")


@register("unpriced_assets", "SELECT event_type AS asset_id, ts AS ingested_at FROM events WHERE event_type = 'error'")
def unpriced_assets(spark, sf):
    return P.unpriced(FX.event_price_payloads(spark, sf), vs="usd")


@register("price_rejects", """
SELECT event_type AS asset_id, ts AS ingested_at, 'malformed number' AS reason
FROM events WHERE event_type <> 'error' AND value > 480
""")
def price_rejects(spark, sf):
    return P.price_rejects(FX.event_price_payloads(spark, sf)).drop("payload")


@register("price_rejects_nan", """
SELECT event_type AS asset_id, ts AS ingested_at, 'malformed number' AS reason
FROM events WHERE event_type <> 'error' AND (value > 480 OR json_extract_string(props, '$.k') = '0')
""")
def price_rejects_nan(spark, sf):
    """Prices and volumes sent as NaN are no numbers; no tick holds one."""
    payloads = FX.event_price_payloads(spark, sf)
    odd = F.replace(F.replace("payload", F.lit('"n/a"'), F.lit('"NaN"')), F.lit('_24h_vol": null'), F.lit('_24h_vol": "nan"'))
    payloads = payloads.withColumn("payload", odd)
    held = P.parse_prices(payloads).where(F.isnan("price") | F.isnan("volume_24h"))
    return P.price_rejects(payloads).drop("payload").unionByName(
        held.select("asset_id", "ingested_at", F.lit("stored").alias("reason")))


@register("silver_conform", _PARSED_SQL)
def silver_conform(spark, sf):
    """L1 + L2: payloads landed twice (a replay), parsed, first landing wins."""
    payloads = FX.event_price_payloads(spark, sf)
    bronze = (P.land_bronze(payloads, "prices", "2024-02-01 00:00:00")
              .unionByName(P.land_bronze(payloads, "prices", "2024-02-02 00:00:00")))
    ticks, _ = P.conform(bronze, vs="usd", order=("landed_at",))
    return ticks


_MARKETS_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS id, lower(c_mktsegment) AS symbol, c_name AS name,
       CASE WHEN c_acctbal >= 0 THEN 'img/' || CAST(c_custkey AS VARCHAR) || '.png' END AS image_url,
       c_acctbal AS max_supply,
       TIMESTAMP '2024-01-01 00:00:00' + to_hours(c_nationkey) AS created_at,
       TIMESTAMP '2024-01-01 00:00:00' + to_hours(c_nationkey) AS updated_at
FROM customer WHERE c_mktsegment <> 'BUILDING'
"""


@register("parse_markets", _MARKETS_SQL)
def parse_markets(spark, sf):
    return P.parse_markets(FX.customer_market_payloads(spark, sf))


@register("market_rejects", """
SELECT TIMESTAMP '2024-01-01 00:00:00' + to_hours(c_nationkey) AS ingested_at, count(*) AS rejected
FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY 1
""")
def market_rejects(spark, sf):
    return (P.market_rejects(FX.customer_market_payloads(spark, sf))
            .groupBy("ingested_at").agg(F.count(F.lit(1)).alias("rejected")))


EVENT_CONTRACT_V1 = T.StructType([
    T.StructField("event_id", T.LongType(), False),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("props", T.StructType([T.StructField("k", T.IntegerType(), True)]), True),
])


@register("contract_rejects", """
SELECT event_id AS record_id, 'does not match contract' AS reason FROM events WHERE value > 480
""")
def contract_rejects(spark, sf):
    _, rejects = P.contract(FX.event_records(spark, sf), EVENT_CONTRACT_V1)
    return rejects.select("record_id", "reason")


@register("contract_accepts", """
SELECT event_id AS record_id, event_id, event_type, value,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events WHERE value <= 480
""")
def contract_accepts(spark, sf):
    good, _ = P.contract(FX.event_records(spark, sf), EVENT_CONTRACT_V1)
    return good.select("record_id", "event_id", "event_type", "value", F.col("props.k").alias("k"))
