"""Mapping of the shared synthetic tables onto the engine's data model.

``events`` stands in for the tick feed:

=============  ==========================================================
tick column    events expression
=============  ==========================================================
asset_id       ``event_type`` (five heavy keys: the skew case)
ingested_at    ``ts`` read as UTC
ts             ``ts``, or ``date_trunc('hour', ts)`` for a slowly refreshing
               source, which creates the ties the trailing baseline handles
price          ``value``
volume_24h     ``props.k`` as double, 0 read as missing (gives nulls)
market_cap     ``value * 1000``
change_24h     ``props.k - 50`` (signed)
=============  ==========================================================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import pin_utc

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one shared table; column pruning and filters push into the scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    pin_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").cast(T.DoubleType())


def event_ticks(spark: SparkSession, sf_dir: str, hourly_ts: bool = False,
                asset: str = "event_type", source_lag: bool = False) -> DataFrame:
    """``events`` as ticks (see the module table). ``source_lag=True`` makes
    the source clock run ``props.k`` minutes behind the poll (late ticks)."""
    ev = load(spark, sf_dir, "events")
    ingested = F.col("ts").cast(T.TimestampType())
    src_ts = F.date_trunc("hour", ingested) if hourly_ts else ingested
    if source_lag:
        src_ts = src_ts - F.make_interval(mins=_k().cast(T.IntegerType()))
    return ev.select(
        F.col(asset).cast(T.StringType()).alias("asset_id"),
        src_ts.alias("ts"),
        ingested.alias("ingested_at"),
        F.col("value").alias("price"),
        F.nullif(_k(), F.lit(0.0)).alias("volume_24h"),
        (F.col("value") * F.lit(1000.0)).alias("market_cap"),
        (_k() - F.lit(50.0)).alias("change_24h"),
    )


def event_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a poll log: one row per poll of a feed (``user_id``),
    ``event_type = 'error'`` marking a failed poll."""
    ev = load(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("feed_id"),
        F.col("ts").cast(T.TimestampType()).alias("polled_at"),
        (F.col("event_type") != F.lit("error")).alias("ok"),
    )


# SQL fragments giving the same mapping inside DuckDB oracles.
SQL_TICKS = """
SELECT event_type AS asset_id, {ts} AS ts, ts AS ingested_at, value AS price,
       nullif(CAST(json_extract_string(props, '$.k') AS DOUBLE), 0) AS volume_24h,
       value * 1000.0 AS market_cap,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) - 50.0 AS change_24h
FROM events
"""


def sql_ticks(hourly_ts: bool = False) -> str:
    return SQL_TICKS.format(ts="date_trunc('hour', ts)" if hourly_ts else "ts")


# ---------------------------------------------------------------------------
# Landed payloads built from the shared tables
# ---------------------------------------------------------------------------
def event_price_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ``/simple/price``-shaped poll per event, keyed by ``event_type``:

    * ``error`` events are quoted in ``eur`` only (no ``usd`` price: skipped);
    * ``view`` events carry no ``last_updated_at`` (time falls back to the poll);
    * ``last_updated_at`` is the poll second minus ``props.k`` seconds;
    * ``k = 0`` gives a JSON null volume; ``value > 480`` a malformed price.
    """
    ev = load(spark, sf_dir, "events").withColumn("_k", _k().cast(T.LongType()))  # parsed once
    ts = F.col("ts").cast(T.TimestampType())
    k = F.col("_k")
    cur = F.when(F.col("event_type") == "error", F.lit("eur")).otherwise(F.lit("usd"))
    price = F.when(F.col("value") > 480, F.lit('"n/a"')).otherwise(F.col("value").cast("string"))
    vol = F.when(k == 0, F.lit("null")).otherwise(k.cast("double").cast("string"))
    last = F.when(F.col("event_type") != "view",
                  F.concat(F.lit(', "last_updated_at": '), (F.unix_seconds(ts) - k).cast("string")))
    body = F.concat(
        F.lit('{"'), F.col("event_type"), F.lit('": {"'), cur, F.lit('": '), price,
        F.lit(', "'), cur, F.lit('_market_cap": '), (F.col("value") * F.lit(1000.0)).cast("string"),
        F.lit(', "'), cur, F.lit('_24h_vol": '), vol,
        F.lit(', "'), cur, F.lit('_24h_change": '), (k.cast("double") - F.lit(50.0)).cast("string"),
        F.coalesce(last, F.lit("")), F.lit("}}"))
    return ev.select(body.alias("payload"), ts.alias("ingested_at"))


def customer_market_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``/coins/markets``-shaped arrays built from ``customer``: one payload
    per nation and block of 100 customer keys (payloads stay bounded), polled
    at 2024-01-01 plus the nation key in hours. ``BUILDING`` customers lack a
    ``symbol`` (rejected); a negative balance gives no image."""
    c = load(spark, sf_dir, "customer")
    row = F.struct(
        F.col("c_custkey").cast("string").alias("id"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.lower("c_mktsegment")).alias("symbol"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_acctbal") >= 0,
               F.concat(F.lit("img/"), F.col("c_custkey").cast("string"), F.lit(".png"))).alias("image"),
        F.col("c_acctbal").alias("max_supply"))
    polled = (F.lit("2024-01-01 00:00:00").cast(T.TimestampType())
              + F.make_interval(hours=F.col("c_nationkey")))
    return (c.groupBy("c_nationkey", F.floor(F.col("c_custkey") / 100).alias("_blk"))
             .agg(F.to_json(F.collect_list(row)).alias("payload"))
             .select("payload", polled.alias("ingested_at")))


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON records for the contract check: ``value`` above 480 is
    sent as the string ``"n/a"`` (a type breach)."""
    ev = load(spark, sf_dir, "events")
    value = F.when(F.col("value") > 480, F.lit('"n/a"')).otherwise(F.col("value").cast("string"))
    rec = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"),
                   F.lit(', "event_type": "'), F.col("event_type"), F.lit('", "value": '), value,
                   F.lit(', "props": '), F.col("props"), F.lit("}"))
    return ev.select(F.col("event_id").alias("record_id"), rec.alias("payload"))
