"""A hot asset holding a third of all ticks must not land in one task."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.alerts import trailing_stats


def _ticks(spark, n=120_000):
    # a third of the rows belong to "hot" (one tick per second), the rest to 400 assets
    ids = spark.range(n)
    hot = F.col("id") % 3 == 0
    asset = F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("a"), (F.col("id") % 400).cast("string")))
    t = F.timestamp_seconds(F.lit(1_700_000_000) + F.when(hot, F.col("id") / 3).otherwise(F.col("id") % 40_000))
    return ids.select(asset.alias("asset_id"), t.alias("ts"), t.alias("ingested_at"),
                      (F.col("id") % 97 + 1).cast("double").alias("price"))


def _partition_loads(df):
    counts = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    sizes = [r["count"] for r in counts]
    return max(sizes), sum(sizes) / len(sizes)


def test_time_buckets_spread_a_hot_asset(spark):
    ticks = _ticks(spark)
    spread = trailing_stats(ticks, [300], ["price"], bucket_s="auto")
    whole = trailing_stats(ticks, [300], ["price"], bucket_s=None)
    # small test data: keep AQE from merging every partition into one
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        top_b, mean_b = _partition_loads(spread)
        top_w, mean_w = _partition_loads(whole)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    # without buckets the hot asset's 40,000 rows sit in one task
    assert top_w >= 40_000
    assert top_b < 0.6 * top_w and top_b < 2.0 * mean_b


def test_each_window_has_buckets_of_its_own_width(spark):
    """A day of one asset beside three hours of it: the widest window's bucket must not hold the whole month."""
    ids = spark.range(30 * 24 * 60)
    t = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60)
    ticks = ids.select(F.lit("hot").alias("asset_id"), t.alias("ts"), t.alias("ingested_at"),
                       (F.col("id") % 97 + 1).cast("double").alias("price"))
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        top, _ = _partition_loads(trailing_stats(ticks, [3 * 3600, 24 * 3600], ["price"]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert top < 6 * 2 * 24 * 60  # less than six days of both windows; buckets of the widest held twelve
