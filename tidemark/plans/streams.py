"""Streaming jobs run to completion over ``events`` landed as files.

Each query lands its input in a fresh folder under ``spark.checkpoint.dir``,
runs the streaming job with an ``availableNow`` trigger and its own
checkpoint, and returns a lazy read of what the sink wrote.
"""

from __future__ import annotations

import time

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark.operators import alerts as A
from tidemark.operators import candles as C
from tidemark.operators.quality import in_range
from tidemark.plans.ingest import _PARSED_SQL
from tidemark.plans.market import FIX_THRESHOLD, FIX_WARMUP_S, FIX_WINDOW_S, _alert_sql, _candle_sql, _r9
from tidemark.plans.registry import ORACLES, register
from tidemark.schemas import TICK
from tidemark.sources import fixtures as FX
from tidemark.sources import store as S
from tidemark.sources.payloads import parse_prices, price_rejects, read_payloads, write_landed
from tidemark.streaming import candle_log as CL
from tidemark.streaming import enrichment as E
from tidemark.streaming import gates as G
from tidemark.streaming import health as H
from tidemark.streaming import jobs as J
from tidemark.streaming.detector import stream_alerts


# state partitions of the fixture streams (five assets): one per local core
STATE_PARTITIONS = 8
DETECTOR = dict(window_s=FIX_WINDOW_S, threshold=FIX_THRESHOLD, warmup_s=FIX_WARMUP_S)


def _land_in_order(spark, df, fmt="parquet", path=None):
    """Land rows as files that each hold a contiguous time range (one
    parallel write, range-partitioned on time). File sources take the oldest
    files first, so the fixture's files are stamped in range order: the
    stream sees the rows in time order, and no micro-batch holds more than
    its files. In a ``path`` that holds files already, the new ones come later."""
    path = path or S.scratch_path(spark, "landing")
    fs, root = S._fs(spark, path)
    landed = {st.getPath().getName(): st.getModificationTime()
              for st in (fs.listStatus(root) if fs.exists(root) else ())}
    files = max(4, spark.sparkContext.defaultParallelism)
    write_landed(df.repartitionByRange(files, "ingested_at").sortWithinPartitions("ingested_at"), path, fmt)
    parts = sorted((st.getPath() for st in fs.listStatus(root)
                    if st.getPath().getName().startswith("part-") and st.getPath().getName() not in landed),
                   key=lambda q: q.getName())
    first = max([int(time.time() * 1000) - 1000 * len(parts), *(t + 1000 for t in landed.values())])
    for i, part in enumerate(parts):  # part-00000 holds the earliest range
        fs.setTimes(part, first + 1000 * i, -1)
    return path


def _landed_ticks(spark, sf):
    path = _land_in_order(spark, FX.event_ticks(spark, sf, hourly_ts=True))
    return spark.readStream.schema(TICK).option("maxFilesPerTrigger", 1).parquet(path)


def _detector_run(spark, ticks):
    return J.replay_alerts(spark, _land_in_order(spark, ticks), S.scratch_path(spark, "alerts"),
                           S.scratch_path(spark, "ckpt"), partitions=STATE_PARTITIONS, **DETECTOR)


def _arrival_sql(ticks: str) -> str:
    """The detector's rule in arrival order: a reading leaves once all earlier
    ones have left and a tick's window starts behind it. ``h`` is the place of
    the oldest reading that is left when tick ``i`` comes."""
    return f"""
WITH RECURSIVE t AS (
  SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY ingested_at) AS i FROM ({ticks}) x
), s AS (
  SELECT asset_id, CAST(1 AS BIGINT) AS i, CAST(1 AS BIGINT) AS h FROM t WHERE t.i = 1
  UNION ALL
  SELECT s.asset_id, n.i, min(b.i)
  FROM s JOIN t n ON n.asset_id = s.asset_id AND n.i = s.i + 1
  JOIN t b ON b.asset_id = s.asset_id AND b.i BETWEEN s.h AND n.i
          AND (b.i = n.i OR b.ts >= n.ts - INTERVAL {FIX_WINDOW_S} SECOND)
  GROUP BY s.asset_id, n.i
), w AS (
  SELECT a.asset_id, a.ts, a.price, a.volume_24h, a.i - s.h AS samples, min_by(b.ts, b.i) AS oldest,
         avg(b.price) AS base_price, avg(b.volume_24h) AS base_volume
  FROM t a JOIN s ON s.asset_id = a.asset_id AND s.i = a.i
  JOIN t b ON b.asset_id = a.asset_id AND b.i >= s.h AND b.i < a.i
  GROUP BY a.asset_id, a.i, a.ts, a.price, a.volume_24h, s.h
), c AS (
  SELECT asset_id, ts, samples, oldest, 'price' AS metric, price AS value, base_price AS baseline FROM w
  UNION ALL SELECT asset_id, ts, samples, oldest, 'volume', volume_24h, base_volume FROM w
)
SELECT asset_id, metric, value, round(baseline, 9) AS baseline, round((value - baseline) / baseline, 9) AS change_pct,
       CAST({FIX_THRESHOLD} AS DOUBLE) AS threshold, CAST({FIX_WINDOW_S} AS INTEGER) AS window_s, samples, ts
FROM c
WHERE ts - oldest >= INTERVAL {FIX_WARMUP_S} SECOND AND value IS NOT NULL AND baseline <> 0
  AND abs((value - baseline) / baseline) > {FIX_THRESHOLD}
"""


@register("stream_alerts", _alert_sql(hourly=True))
def stream_alerts_q(spark, sf):
    """The stateful streaming detector; equal to the batch operator
    since source times never decrease in arrival order here."""
    return _r9(_detector_run(spark, FX.event_ticks(spark, sf, hourly_ts=True)), "baseline", "change_pct")


_LATE_TICKS_SQL = """
SELECT event_type AS asset_id, ts - to_minutes(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS ts,
       ts AS ingested_at, value AS price,
       nullif(CAST(json_extract_string(props, '$.k') AS DOUBLE), 0) AS volume_24h
FROM events
"""


@register("stream_alerts_late", _arrival_sql(_LATE_TICKS_SQL))
def stream_alerts_late(spark, sf):
    """Source times behind earlier arrivals, neither dropped nor reordered."""
    return _r9(_detector_run(spark, FX.event_ticks(spark, sf, source_lag=True)), "baseline", "change_pct")


@register("arrival_alerts", _arrival_sql(_LATE_TICKS_SQL))
def arrival_alerts(spark, sf):
    """I3 over stored ticks: the arrival-order alerts as one batch plan."""
    out = A.arrival_alerts(FX.event_ticks(spark, sf, source_lag=True), **DETECTOR)
    return _r9(out, "baseline", "change_pct")


_NAN_SQL = _alert_sql(hourly=True).replace("FROM events", """FROM (
  SELECT ts, event_type, props, CASE WHEN minute(ts) % 10 <> 3 THEN value END AS value FROM events) e""")


def _with_nan(ticks):
    """Every tenth minute's prices are not a number."""
    return ticks.withColumn("price", F.when(F.minute("ingested_at") % 10 != 3, F.col("price"))
                            .otherwise(F.lit(float("nan"))))


@register("alerts_nan", _NAN_SQL)
def alerts_nan(spark, sf):
    """A price that is NaN is missing: no alert, no part of a baseline."""
    out = A.trailing_alerts(_with_nan(FX.event_ticks(spark, sf, hourly_ts=True)), **DETECTOR)
    return _r9(out, "baseline", "change_pct")


@register("stream_alerts_nan", _NAN_SQL)
def stream_alerts_nan(spark, sf):
    """The same rule for NaN in the streaming detector."""
    return _r9(_detector_run(spark, _with_nan(FX.event_ticks(spark, sf, hourly_ts=True))), "baseline", "change_pct")


@register("stream_alerts_restart", _alert_sql(hourly=True))
def stream_alerts_restart(spark, sf):
    """The job is stopped half-way and started again; the window's
    readings are still there, so no alert is missed, repeated or warmed up for."""
    ticks = FX.event_ticks(spark, sf, hourly_ts=True)
    half = F.col("ingested_at") < F.lit("2024-01-16 00:00:00").cast("timestamp")
    landing, out, ck = (S.scratch_path(spark, n) for n in ("landing", "alerts", "ckpt"))
    for part in (ticks.where(half), ticks.where(~half)):
        _land_in_order(spark, part, path=landing)
        alerts = J.replay_alerts(spark, landing, out, ck, partitions=STATE_PARTITIONS, **DETECTOR)
    return _r9(alerts, "baseline", "change_pct")


@register("stream_candles", _candle_sql("date_trunc('hour', ingested_at)"))
def stream_candles_q(spark, sf):
    """I4: hourly candles maintained by a watermarked streaming aggregate in
    update mode; the current candle is the last update of each bucket."""
    out, ck = S.scratch_path(spark, "candles"), S.scratch_path(spark, "ckpt")
    candles = J.stream_candles(_landed_ticks(spark, sf), "1 hour", "2 hours")
    J.start_update_log(candles, out, ck, partitions=STATE_PARTITIONS).awaitTermination()
    return J.current_from_log(spark, out, ["asset_id", "bucket"])


@register("stream_candle_table", _candle_sql("date_trunc('hour', ingested_at)"))
def stream_candle_table(spark, sf):
    """I4: an hourly candle table kept current by the stream, one bounded
    micro-batch at a time (each merges its updated buckets)."""
    out, ck = S.scratch_path(spark, "candle-table"), S.scratch_path(spark, "ckpt")
    candles = J.stream_candles(_landed_ticks(spark, sf), "1 hour", "2 hours")
    J.start_candle_table(candles, out, ck, partitions=STATE_PARTITIONS).awaitTermination()
    return spark.read.parquet(out).drop("bucket_date")


@register("stream_candle_log", _candle_sql("date_trunc('hour', ingested_at)"))
def stream_candle_log(spark, sf):
    """I4: hourly candles as a log of partial candles, folded in mid-stream;
    the second half of the stream brings late ticks of days long folded."""
    landing, log, ck = (S.scratch_path(spark, n) for n in ("landing", "candle-log", "ckpt"))
    ticks = FX.event_ticks(spark, sf)
    late = F.minute("ingested_at") % 7 == 3
    half = (F.col("ingested_at") < F.lit("2024-01-16 00:00:00").cast("timestamp")) & ~late
    for part in (ticks.where(half), ticks.where(~half)):
        _land_in_order(spark, part, path=landing)
        stream = spark.readStream.schema(TICK).option("maxFilesPerTrigger", 2).parquet(landing)
        CL.start_candle_log(stream, log, ck, "1 hour").awaitTermination()
        if not CL.S.list_partitions_of(spark, f"{log}/{CL.BASE}", CL.DAY):
            CL.fold(spark, log)
    return CL.read_candles(spark, log)


@register("refresh_invalidated", _candle_sql("date_trunc('hour', ingested_at)").replace(
    "GROUP BY ALL", "WHERE ingested_at < TIMESTAMP '2024-01-20 23:00:00' GROUP BY ALL"))
def refresh_invalidated(spark, sf):
    """Ticks streamed into the store long after their hours were rolled up.
    The sink notes the hours; a refresh of one day's window recomputes these
    too and ends like a full rebuild."""
    landing, store, rollup, ck = (S.scratch_path(spark, n) for n in ("landing", "store", "rollup", "ckpt"))
    ticks = FX.event_ticks(spark, sf)
    late = F.minute("ingested_at") % 7 == 3
    cut = F.col("ingested_at") < F.lit("2024-01-16 00:00:00").cast("timestamp")

    def land(part):
        _land_in_order(spark, part, path=landing)
        stream = spark.readStream.schema(TICK).option("maxFilesPerTrigger", 3).parquet(landing)
        J.start_tick_store(stream, store, ck, rollups={rollup: "1 hour"}).awaitTermination()

    land(ticks.where(cut & ~late))
    spark.createDataFrame([], C.candles(ticks, "1 hour").withColumn("bucket_date", F.to_date("bucket")).schema) \
        .write.parquet(rollup)
    S.refresh_invalidated(spark, rollup, spark.read.parquet(store), "2024-01-16 00:00:00", "30 days", "1 hour", "1 hour")
    land(ticks.where(~(cut & ~late)))
    S.refresh_invalidated(spark, rollup, spark.read.parquet(store), "2024-01-21 00:00:00", "6 days", "1 hour", "1 hour")
    return spark.read.parquet(rollup).drop("bucket_date")


@register("stream_enrich", """
SELECT CAST(e.event_id AS VARCHAR) AS key, e.event_id, e.user_id, e.value, c.c_mktsegment, c.c_nationkey
FROM events e JOIN customer c ON c.c_custkey = e.user_id
""")
def stream_enrich(spark, sf):
    """C4 live: events enriched with their customer and written back. Half of
    the customers land after the first half of the events, whose records wait
    for them; records of customers that never come stay in the buffer."""
    landing, dims, out, ck = (S.scratch_path(spark, n) for n in ("landing", "dims", "enriched", "ckpt"))
    events = FX.load(spark, sf, "events").select("event_id", "user_id", "value", F.col("ts").cast("timestamp").alias("ingested_at"))
    customers = FX.load(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment", "c_nationkey")
    table = E.VersionedTable(spark, dims)
    table.put(customers.where("user_id % 2 = 0"))
    half = F.col("ingested_at") < F.lit("2024-01-16 00:00:00").cast("timestamp")
    schema = events.schema
    for part in (events.where(half), events.where(~half)):
        _land_in_order(spark, part, path=landing)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(landing)
        E.start_enrichment(stream, dims, out, ck, "user_id", "event_id").awaitTermination()
        if table.newest() == 1:
            table.put(customers.where("user_id % 4 <> 1"))
    table.put(customers)
    E.settle(spark, dims, out, schema, "user_id", "event_id")
    fields = "event_id long, user_id long, value double, c_mktsegment string, c_nationkey int"
    return E.sent_records(spark, out).select("key", F.from_json("value", fields).alias("r")).select("key", "r.*")


@register("stream_first_readings", f"""
SELECT * FROM ({FX.sql_ticks(True)}) t QUALIFY row_number() OVER (PARTITION BY asset_id, ts ORDER BY ingested_at) = 1
""")
def stream_first_readings(spark, sf):
    """B7 exact: whole rows, as the batch operator gives them. Readings are known
    for ten minutes behind the watermark, and renewed by each poll."""
    out, ck = S.scratch_path(spark, "first"), S.scratch_path(spark, "ckpt")
    with J.state_partitions(spark, STATE_PARTITIONS):
        q = (H.stream_first_readings(_landed_ticks(spark, sf), "1 hour").writeStream.format("parquet")
              .option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(TICK).parquet(out)


@register("stream_outages", """
WITH p AS (SELECT user_id AS feed_id, ts AS polled_at, event_type <> 'error' AS ok FROM events),
c AS (SELECT *, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (
         PARTITION BY feed_id ORDER BY polled_at ROWS UNBOUNDED PRECEDING) AS c FROM p),
r AS (SELECT *, CASE WHEN ok THEN c - 1 ELSE c END AS run FROM c),
o AS (SELECT feed_id, min(polled_at) FILTER (WHERE NOT ok) AS outage_start,
             max(polled_at) FILTER (WHERE NOT ok) AS outage_end, count(*) FILTER (WHERE NOT ok) AS skipped_polls,
             min(polled_at) FILTER (WHERE ok) AS recovered_at
      FROM r GROUP BY feed_id, run HAVING count(*) FILTER (WHERE NOT ok) > 0)
SELECT feed_id, 'closed' AS event, * EXCLUDE (feed_id) FROM o WHERE recovered_at IS NOT NULL
UNION ALL
SELECT feed_id, 'opened', outage_start, NULL, NULL, NULL FROM o
""")
def stream_outages(spark, sf):
    """A5 live: what opened and what closed, each once; the closed ones are the
    batch report's."""
    landing, out, ck = (S.scratch_path(spark, n) for n in ("polls", "outages", "ckpt"))
    polls = FX.event_polls(spark, sf).withColumn("ingested_at", F.col("polled_at"))
    _land_in_order(spark, polls, path=landing)
    stream = spark.readStream.schema(polls.schema).option("maxFilesPerTrigger", 2).parquet(landing)
    # state is spread by feed, of which there are many: a partition for every core
    with J.state_partitions(spark, max(STATE_PARTITIONS, spark.sparkContext.defaultParallelism)):
        q = (H.stream_outages(stream).writeStream.format("parquet").option("path", out)
              .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out).drop("reason")


@register("stream_gate", """
WITH e AS (SELECT event_id, event_type, value, ts, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10' THEN -value ELSE value END AS v
           FROM events),
t AS (SELECT *, CASE WHEN v < 0 OR v > 400 THEN 'range:value' END AS reason, CAST(ts AS DATE) = DATE '2024-01-10' AS held FROM e)
SELECT CASE WHEN held OR reason IS NOT NULL THEN 'reject' ELSE 'good' END AS part, event_id, v AS value,
       CASE WHEN reason IS NOT NULL THEN reason WHEN held THEN 'batch held back' END AS reasons
FROM t
""")
def stream_gate(spark, sf):
    """L6/L8 in flight: a file per day; the values of one day are negative, far
    more than the rule tolerates. The stream stops there, with nothing of that
    day stored; told to go on, it leaves the day out. A replay changes nothing."""
    landing, out, ck = (S.scratch_path(spark, n) for n in ("days", "gated", "ckpt"))
    bad = F.to_date("ingested_at") == F.lit("2024-01-10").cast("date")
    rows = FX.load(spark, sf, "events").select("event_id", "value", F.col("ts").cast("timestamp").alias("ingested_at"))
    rows = rows.withColumn("value", F.when(bad, -F.col("value")).otherwise(F.col("value")))
    for part in (rows.where(F.col("ingested_at") < F.lit("2024-01-10").cast("timestamp")), rows.where(bad),
                 rows.where(F.col("ingested_at") >= F.lit("2024-01-11").cast("timestamp"))):
        _land_in_order(spark, part, path=landing)
        stream = spark.readStream.schema(rows.schema).parquet(landing)
        for how in ("halt", "divert"):
            try:
                G.start_gated_store(stream, [in_range("value", 0, 400, max_rate=0.5)], out, ck, how).awaitTermination()
                break
            except StreamingQueryException:
                continue
    schema = "event_id long, value double, reasons array<string>"
    good, rejects = (G.gated(spark, out, part, schema) for part in (G.GOOD, G.REJECTS))
    return good.select(F.lit("good").alias("part"), "event_id", "value", F.lit(None).cast("string").alias("reasons")).unionByName(
        rejects.select(F.lit("reject").alias("part"), "event_id", "value", F.concat_ws(",", "reasons").alias("reasons")))


@register("stream_insert_ignore",
          f"SELECT *, CAST(ingested_at AS DATE) AS ingest_date FROM ({_PARSED_SQL}) p")
def stream_insert_ignore(spark, sf):
    """Price payloads landed twice, the second time with other prices,
    streamed into the tick store: the first landing wins, also where both
    meet in one micro-batch."""
    landing, store = S.scratch_path(spark, "payloads"), S.scratch_path(spark, "store")
    payloads = FX.event_price_payloads(spark, sf)  # parallel write; file order does not matter here
    other = F.regexp_replace("payload", '"usd": ([0-9])', '"usd": 9$1')
    write_landed(payloads, landing)  # polls land as JSON lines
    write_landed(payloads.withColumn("payload", other), landing)
    polls = read_payloads(spark, landing, streaming=True, fmt="json", max_files_per_trigger=3, sequence="_landed")
    ticks = parse_prices(polls, keep=["_landed"])
    J.start_tick_store(ticks, store, S.scratch_path(spark, "ckpt"), order=("_landed",)).awaitTermination()
    return spark.read.parquet(store)


@register("stream_poison_row", f"""
SELECT 'store' AS part, asset_id, ingested_at, price FROM ({_PARSED_SQL}) p
UNION ALL
SELECT 'reject', event_type, NULL, NULL FROM events WHERE event_type <> 'error' AND value <= 480 AND minute(ts) = 7
UNION ALL
SELECT 'quarantine', event_type, NULL, value FROM events WHERE minute(ts) = 11
""")
def stream_poison_row(spark, sf):
    """Polls that landed without a poll time among the others. The
    parser rejects them; ticks that reach the store without one are
    quarantined there; the stream runs on, and the store can be maintained."""
    landing, store, ck = (S.scratch_path(spark, n) for n in ("payloads", "store", "ckpt"))
    payloads = FX.event_price_payloads(spark, sf)
    untimed = payloads.where(F.minute("ingested_at") == 7).withColumn("ingested_at", F.lit(None).cast("timestamp"))
    write_landed(untimed, landing, "parquet")
    write_landed(payloads, landing, "parquet")
    polls = read_payloads(spark, landing, streaming=True, fmt="parquet", max_files_per_trigger=3, sequence="_landed")
    keep = ["_landed"]
    J.start_tick_store(parse_prices(polls, keep=keep), store, ck, order=keep).awaitTermination()
    # ticks from elsewhere, keyless ones among them, through the same sink
    ticks, other = FX.event_ticks(spark, sf), S.scratch_path(spark, "ticks")
    ticks.where(F.minute("ingested_at") == 11).withColumn("ingested_at", F.lit(None).cast("timestamp")).write.parquet(other)
    more = spark.readStream.schema(TICK).parquet(other)
    J.start_tick_store(more, store, f"{ck}-more").awaitTermination()
    S.compact(spark, store, 7, "2024-01-31 00:00:00")
    none = F.lit(None)
    rows = spark.read.parquet(store).select(F.lit("store").alias("part"), "asset_id", "ingested_at", "price")
    rejects = price_rejects(spark.read.schema("payload string, ingested_at timestamp").parquet(landing))
    rejects = rejects.where("reason = 'missing poll time'").select(
        F.lit("reject").alias("part"), "asset_id", "ingested_at", none.cast("double").alias("price"))
    kept_back = spark.read.parquet(f"{store}/{J.QUARANTINE}").select(
        F.lit("quarantine").alias("part"), "asset_id", "ingested_at", "price")
    return rows.unionByName(rejects).unionByName(kept_back)


@register("feed_fan_out", f"""
SELECT 'store' AS part, asset_id, ingested_at AS time, 'price' AS metric, price AS value, NULL::BIGINT AS samples
FROM ({_PARSED_SQL}) p
UNION ALL
SELECT 'alert', asset_id, date_trunc('second', ts), metric, value, samples FROM ({_arrival_sql(_PARSED_SQL)}) a
""")
def feed_fan_out(spark, sf):
    """One landing fanned out to the tick store and the alert log, both
    read back (an alert line tells its time to the second)."""
    landing = _land_in_order(spark, FX.event_price_payloads(spark, sf), "json")
    store, log, ck = (S.scratch_path(spark, n) for n in ("store", "alertlog", "ckpt"))
    for q in J.start_feed(spark, landing, store, log, ck, fmt="json", detector=DETECTOR,
                          max_files_per_trigger=1, partitions=STATE_PARTITIONS):
        q.awaitTermination()
    stored = spark.read.parquet(store).select(
        F.lit("store").alias("part"), "asset_id", F.col("ingested_at").alias("time"), F.lit("price").alias("metric"),
        F.col("price").alias("value"), F.lit(None).cast("long").alias("samples"))
    line = F.from_json("value", "asset_id string, metric string, value double, samples long, ts timestamp")
    alerts = spark.read.text(log).select(line.alias("r")).select(
        F.lit("alert").alias("part"), "r.asset_id", F.date_trunc("second", "r.ts").alias("time"), "r.metric",
        "r.value", "r.samples")
    return stored.unionByName(alerts)


@register("alert_lines_stream", ORACLES["alert_text"])
def alert_lines_stream(spark, sf):
    """K3: streaming alerts as the console's lines, appended to a log."""
    out, ck = S.scratch_path(spark, "lines"), S.scratch_path(spark, "ckpt")
    alerts = _r9(stream_alerts(_landed_ticks(spark, sf), **DETECTOR), "baseline", "change_pct")
    J.start_alert_log(alerts, out, ck, fmt="text", partitions=STATE_PARTITIONS).awaitTermination()
    return spark.read.text(out)


@register("alert_log", f"""
SELECT asset_id, metric, value, round(baseline, 9) AS baseline, round((value - baseline) / baseline, 6) AS change_pct,
       threshold, window_s, samples, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS ts
FROM ({_alert_sql(hourly=True).replace("round(baseline, 9)", "baseline").replace(
        "round((value - baseline) / baseline, 9)", "(value - baseline) / baseline")}) a
""")
def alert_log(spark, sf):
    """K2: streaming alerts appended as JSON lines, read back field by field."""
    out, ck = S.scratch_path(spark, "alertlog"), S.scratch_path(spark, "ckpt")
    alerts = stream_alerts(_landed_ticks(spark, sf), FIX_WINDOW_S, FIX_THRESHOLD, FIX_WARMUP_S)
    J.start_alert_log(alerts, out, ck, fmt="json", partitions=STATE_PARTITIONS).awaitTermination()
    fields = ("asset_id string, metric string, value double, baseline double, change_pct double, "
              "threshold double, window_s int, samples long, ts string")
    parsed = spark.read.text(out).select(F.from_json("value", fields).alias("r")).select("r.*")
    return parsed.withColumn("baseline", F.round("baseline", 9))


@register("stream_dedup_unchanged", """
SELECT DISTINCT event_type AS asset_id, date_trunc('hour', ts) AS ts FROM events
""")
def stream_dedup_unchanged(spark, sf):
    """B7 streaming: repeated polls of an unchanged source reading dropped
    within the watermark; one row per (asset, source time) remains."""
    out, ck = S.scratch_path(spark, "dedup"), S.scratch_path(spark, "ckpt")
    deduped = J.stream_dedup_unchanged(_landed_ticks(spark, sf), "2 hours")
    with J.state_partitions(spark, STATE_PARTITIONS):
        q = (deduped.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
                    .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(TICK).parquet(out).select("asset_id", "ts")
