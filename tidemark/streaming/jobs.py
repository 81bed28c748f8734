"""Streaming jobs and sinks.

All sinks are exactly-once given a checkpoint: file sinks through Spark's
metadata log, the tick store through an idempotent ``foreachBatch``
(insert-ignore on the key, so a replayed micro-batch writes nothing new).
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

import contextlib

from tidemark.functions.formatting import alert_json, alert_text
from tidemark.operators.keyed import insert_ignore
from tidemark.schemas import TICK_COLUMNS
from tidemark.sources import store as S


@contextlib.contextmanager
def state_partitions(spark: SparkSession, n: int | None):
    """Start a stateful query with ``n`` state partitions. Structured
    Streaming records the count in the checkpoint at the first start (later
    restarts keep it), so it should match the key count and throughput, not
    the session's batch default."""
    if not n:
        yield
        return
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(int(n)))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def stream_candles(ticks: DataFrame, width: str = "1 minute", watermark: str = "10 minutes",
                   keys: Sequence[str] = ("asset_id",), time: str = "ingested_at") -> DataFrame:
    """I4: candles kept incrementally up to date. ``update`` output mode
    emits changed buckets each trigger; ``append`` emits a bucket once the
    watermark passes its end (the last open bucket is held back)."""
    win = F.window(F.col(time), width)
    agg = ticks.withWatermark(time, watermark).groupBy(*keys, win.alias("_w")).agg(
        F.min_by("price", time).alias("open"), F.max("price").alias("high"),
        F.min("price").alias("low"), F.max_by("price", time).alias("close"),
        F.max_by("volume_24h", time).alias("volume_24h"), F.count(F.lit(1)).alias("ticks"))
    return agg.select(*keys, F.col("_w.start").alias("bucket"), "open", "high", "low", "close",
                      "volume_24h", "ticks")


def stream_dedup_unchanged(ticks: DataFrame, delay: str = "10 minutes",
                           keys: Sequence[str] = ("asset_id", "ts"),
                           time: str = "ingested_at") -> DataFrame:
    """B7 streaming: drop repeated polls of an unchanged source reading.
    State is kept only while the watermark is within ``delay``; which of the
    duplicates inside one micro-batch survives is not defined (use the batch
    ``dedup_unchanged`` in ``foreachBatch`` when the first must win), and a
    reading frozen for longer than ``delay`` is emitted again."""
    return ticks.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def start_update_log(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                     name: str | None = None, partitions: int | None = None) -> StreamingQuery:
    """Persist an ``update``-mode stream as (rows, ``_batch``) Parquet; the
    current value of a key is its row of the highest batch (see
    :func:`current_from_log`)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite")
              .parquet(f"{path}/_batch={batch_id}"))

    w = stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint) \
        .foreachBatch(write)
    if name:
        w = w.queryName(name)
    with state_partitions(stream.sparkSession, partitions):
        return w.trigger(**(trigger or {"availableNow": True})).start()


def start_candle_table(candles_stream: DataFrame, path: str, checkpoint: str,
                       keys: Sequence[str] = ("asset_id",), trigger: dict | None = None,
                       partitions: int | None = None) -> StreamingQuery:
    """I4 as a table: each ``update``-mode micro-batch replaces its candles in
    a Parquet table partitioned by ``bucket_date``; only the days it touches
    are rewritten (stored rows of those days minus the updated keys, plus
    the updates), via staging and dynamic partition overwrite. Replaying a
    batch replaces the same rows again, so the table stays exact."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("bucket_date", F.to_date("bucket")).persist()
        try:
            days = [r[0] for r in batch.select("bucket_date").distinct().collect()]  # a few per batch
            if not days:
                return
            spark = batch.sparkSession
            new = batch
            if S.list_partitions_of(spark, path, "bucket_date"):
                stored = spark.read.parquet(path).where(F.col("bucket_date").isin(days))
                kept = stored.join(batch.select(*keys, "bucket"), [*keys, "bucket"], "left_anti")
                new = kept.unionByName(batch)
            S.overwrite_partitions(new, path, S.scratch_path(spark, "candles"), "bucket_date")
        finally:
            batch.unpersist()

    with state_partitions(candles_stream.sparkSession, partitions):
        return (candles_stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
                              .foreachBatch(write).trigger(**(trigger or {"availableNow": True})).start())


def current_from_log(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    from tidemark.operators.keyed import last_per_key
    logged = spark.read.parquet(path)
    return last_per_key(logged, list(keys), "_batch").drop("_batch")


QUARANTINE = "_quarantine"


def start_tick_store(ticks: DataFrame, path: str, checkpoint: str, key=("asset_id", "ingested_at"),
                     order: Sequence[str] = ("ingested_at",), trigger: dict | None = None,
                     rollups: dict[str, str] | None = None) -> StreamingQuery:
    """Every micro-batch is made durable at once with insert-ignore
    semantics: first row per key in the batch, keys already stored dropped,
    then appended. ``order`` says which row of a batch came first: give it the
    landing sequence of ``read_payloads(sequence=...)``, carried through
    ``parse_prices(keep=...)``; rows it leaves level go by their place in the
    batch, that is in their file. The stored side is read only for the batch's days
    (partition pruning) and its ``ingested_at`` range (Parquet statistics
    skip the rest), so a trigger never rescans the table. Rows that lack a part
    of the key can't be stored under it; they go to ``path/_quarantine`` (a
    folder that reads of the table skip), one folder per micro-batch.
    ``rollups`` (path to bucket width) are told which of their completed
    buckets the stored ticks fall into (:func:`tidemark.sources.store.refresh_invalidated`)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        extra = [c for c in order if c not in TICK_COLUMNS]
        place = F.monotonically_increasing_id().alias("_place")
        cached = batch = S.with_partition(batch.select(*TICK_COLUMNS, *extra, place)).persist()
        try:
            keyless = F.lit(False)
            for k in dict.fromkeys([*key, "ingested_at"]):
                keyless = keyless | F.col(k).isNull()
            span = batch.agg(F.min("ingested_at").alias("lo"), F.max("ingested_at").alias("hi"),
                             F.collect_set(S.PART).alias("days"), F.count_if(keyless).alias("keyless")).collect()[0]
            if span["keyless"]:
                (batch.where(keyless).select(*TICK_COLUMNS).write.mode("overwrite")
                      .parquet(f"{path}/{QUARANTINE}/batch={batch_id}"))
            batch = batch.where(~keyless)
            if span["lo"] is None:
                return
            stored = None
            if S.list_partitions(batch.sparkSession, path):
                # only the folders of the batch's days are listed and read
                days = set(S.list_partitions(batch.sparkSession, path)) & set(span["days"])
                folders = [f"{path}/{S.PART}={d.isoformat()}" for d in sorted(days)]
                stored = (batch.sparkSession.read.schema(batch.select(*TICK_COLUMNS, S.PART).schema)
                          .option("basePath", path).parquet(*folders) if folders
                          else batch.select(*TICK_COLUMNS, S.PART).limit(0))
                stored = (stored
                          .where(F.col("ingested_at").between(span["lo"], span["hi"])))
            new = insert_ignore(stored, batch, list(key), [*order, "_place"], partition_col=S.PART)
            for rollup, width in (rollups or {}).items():
                S.record_invalidated(new, rollup, f"batch={batch_id}", width)
            new.select(*TICK_COLUMNS, S.PART).write.mode("append").option("compression", "zstd") \
                .partitionBy(S.PART).parquet(path)
        finally:
            cached.unpersist()

    return (ticks.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
                 .trigger(**(trigger or {"availableNow": True})).start())


def start_alert_log(alerts: DataFrame, path: str, checkpoint: str, fmt: str = "json",
                    trigger: dict | None = None, partitions: int | None = None) -> StreamingQuery:
    """K2/K3: append alerts as text lines (JSON records or console lines);
    exactly-once through the file sink's log."""
    lines = alert_json(alerts) if fmt == "json" else alert_text(alerts)
    with state_partitions(alerts.sparkSession, partitions):
        return (lines.writeStream.format("text").option("path", path)
                     .option("checkpointLocation", checkpoint).outputMode("append")
                     .trigger(**(trigger or {"availableNow": True})).start())


def replay_alerts(spark: SparkSession, source: str, out: str, checkpoint: str,
                  fmt: str = "parquet", max_files_per_trigger: int = 1, partitions: int | None = None,
                  **detector) -> DataFrame:
    """I3 over history: the exact arrival-order alerts of stored ticks, by
    running the streaming detector over the files (oldest first, a bounded
    number per trigger) to completion. Returns the alerts written to ``out``."""
    from tidemark.schemas import TICK
    from tidemark.streaming.detector import _out_schema, stream_alerts

    ticks = (spark.readStream.schema(TICK).format(fmt)
             .option("maxFilesPerTrigger", max_files_per_trigger).load(source))
    with state_partitions(spark, partitions):
        q = (stream_alerts(ticks, **detector).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(_out_schema(detector.get("key", "asset_id"))).parquet(out)


def start_alert_console(alerts: DataFrame, checkpoint: str, trigger: dict | None = None,
                        partitions: int | None = None) -> StreamingQuery:
    """K3: each alert's console line on the driver's standard output, however
    many a micro-batch has. One parallel job makes the lines; the driver then
    fetches them a partition at a time. A replayed micro-batch prints again."""
    def write(batch: DataFrame, batch_id: int) -> None:
        lines = batch.persist()
        try:
            if lines.count():  # runs the detector in every partition at once
                for r in lines.toLocalIterator():
                    print(r["value"])
                sys.stdout.flush()
        finally:
            lines.unpersist()

    with state_partitions(alerts.sparkSession, partitions):
        return (alert_text(alerts).writeStream.option("checkpointLocation", checkpoint).outputMode("append")
                     .foreachBatch(write).trigger(**(trigger or {"availableNow": True})).start())


def start_feed(spark: SparkSession, landing: str, store_path: str, alert_path: str,
               checkpoint_root: str, vs: str = "usd", detector: dict | None = None,
               trigger: dict | None = None, fmt: str = "parquet", max_files_per_trigger: int = 100,
               partitions: int | None = None, console: bool = False) -> list[StreamingQuery]:
    """One landed payload feed fanned out to persistence and alerting as
    queries with their own checkpoints (one failing never stops the others).
    A backlog is worked off ``max_files_per_trigger`` files at a time."""
    from tidemark.sources.payloads import parse_prices, read_payloads
    from tidemark.streaming.detector import stream_alerts

    def ticks(*keep: str):
        polls = read_payloads(spark, landing, streaming=True, fmt=fmt,
                              max_files_per_trigger=max_files_per_trigger, sequence=keep[0] if keep else None)
        return parse_prices(polls, vs=vs, keep=keep)

    def alerts():
        return stream_alerts(ticks(), **(detector or {}))

    started = [
        start_tick_store(ticks("_landed"), store_path, f"{checkpoint_root}/store", order=("_landed",),
                         trigger=trigger),
        start_alert_log(alerts(), alert_path, f"{checkpoint_root}/alerts", trigger=trigger,
                        partitions=partitions),
    ]
    if console:
        started.append(start_alert_console(alerts(), f"{checkpoint_root}/console", trigger, partitions))
    return started
