"""Streaming detector: parity with batch across micro-batches, restart from
the checkpoint, and arrival-order semantics with late ticks (I1, I3, I6)."""

from __future__ import annotations

import random

import pytest
from conftest import at, make_ticks, model_for_rows

from tidemark.operators.alerts import trailing_alerts
from tidemark.schemas import TICK
from tidemark.sources import store as S
from tidemark.streaming.detector import _out_schema, stream_alerts


def _rows(seed, n, monotone=True):
    rnd = random.Random(seed)
    rows, sec, ts = [], 0, 0
    for _ in range(n):
        sec += rnd.choice([1, 2, 5, 20])
        src = sec - rnd.choice([0, 0, 0, 7]) if not monotone else max(ts, sec - sec % rnd.choice([1, 10]))
        ts = max(ts, src)
        for a in ("a", "b"):
            vol = None if rnd.random() < 0.1 else rnd.uniform(900, 1100)
            rows.append((sec, round(rnd.uniform(90, 110), 2), vol, a, src))
    return rows


def _land(spark, rows, path, chunks):
    step = (len(rows) + chunks - 1) // chunks
    for i in range(chunks):
        part = rows[i * step:(i + 1) * step]
        if part:
            make_ticks(spark, part).coalesce(1).write.mode("append").parquet(path)


def _run(spark, landing, out, ckpt, **kw):
    src = spark.readStream.schema(TICK).option("maxFilesPerTrigger", 1).parquet(landing)
    q = (stream_alerts(src, **kw).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def _key(r):
    return (r.asset_id, r.ts, r.metric, r.value, round(r.baseline, 9), r.samples)


DET = dict(window_s=60, threshold=0.05, warmup_s=10)


def test_stream_equals_batch_over_many_micro_batches(spark):
    rows = _rows(5, 300)
    landing, out, ck = (S.scratch_path(spark, n) for n in ("land", "out", "ck"))
    _land(spark, rows, landing, 6)
    q = _run(spark, landing, out, ck, **DET)
    assert len(q.recentProgress) >= 6
    got = sorted(_key(r) for r in spark.read.schema(_out_schema("asset_id")).parquet(out).collect())
    want = sorted(_key(r) for r in trailing_alerts(make_ticks(spark, rows), bucket_s=None, **DET).collect())
    assert got == want and len(got) > 10


def test_restart_keeps_detector_state(spark):
    rows = _rows(9, 300)
    landing, out, ck = (S.scratch_path(spark, n) for n in ("land", "out", "ck"))
    half = len(rows) // 2
    _land(spark, rows[:half], landing, 3)
    _run(spark, landing, out, ck, **DET)
    _land(spark, rows[half:], landing, 3)  # more data lands while the job is down
    _run(spark, landing, out, ck, **DET)
    got = sorted(_key(r) for r in spark.read.schema(_out_schema("asset_id")).parquet(out).collect())
    want = sorted(_key(r) for r in trailing_alerts(make_ticks(spark, rows), bucket_s=None, **DET).collect())
    assert got == want


def test_late_ticks_follow_arrival_order(spark):
    rows = _rows(13, 300, monotone=False)
    landing, out, ck = (S.scratch_path(spark, n) for n in ("land", "out", "ck"))
    _land(spark, rows, landing, 4)
    _run(spark, landing, out, ck, **DET)
    got = sorted((r.asset_id, r.ts, r.metric, r.samples) for r in
                 spark.read.schema(_out_schema("asset_id")).parquet(out).collect())
    want = [(a[0], a[6], a[1], a[5]) for a in model_for_rows(rows, 60, 0.05, 10)]
    assert got == sorted(want) and len(want) > 10


def test_evicted_outliers_leave_no_trace_in_the_stream(spark):
    rows = [(0, 1e17), (1, float("inf"))] + [(100 + s, 100.0 + s % 3) for s in range(60)]
    landing, out, ck = (S.scratch_path(spark, n) for n in ("land", "out", "ck"))
    _land(spark, rows, landing, 3)
    _run(spark, landing, out, ck, window_s=60, threshold=0.05, warmup_s=1)
    assert spark.read.schema(_out_schema("asset_id")).parquet(out).where("value < 1e6").count() == 0


def test_first_landed_row_wins_within_a_batch(spark):
    from tidemark.sources.payloads import parse_prices, read_payloads, write_landed
    from tidemark.streaming.jobs import start_tick_store
    landing, store = S.scratch_path(spark, "land"), S.scratch_path(spark, "store")
    polls = [('{"a": {"usd": %d}}' % p, at(0)) for p in (100, 90, 95)]
    write_landed(spark.createDataFrame(polls, "payload string, ingested_at timestamp").coalesce(1), landing)
    write_landed(spark.createDataFrame([('{"a": {"usd": 80}}', at(0))], "payload string, ingested_at timestamp"), landing)
    ticks = parse_prices(read_payloads(spark, landing, streaming=True, sequence="_landed"), keep=["_landed"])
    start_tick_store(ticks, store, S.scratch_path(spark, "ck"), order=["_landed"]).awaitTermination()
    assert [r.price for r in spark.read.parquet(store).collect()] == [100.0]


@pytest.mark.parametrize("fmt", ["json", "text"])
def test_alert_log_sink(spark, fmt):
    from tidemark.streaming.jobs import start_alert_log
    rows = [(s, 100.0) for s in range(16)] + [(16, 105.0)]
    landing, out, ck = (S.scratch_path(spark, n) for n in ("land", "out", "ck"))
    _land(spark, rows, landing, 2)
    src = spark.readStream.schema(TICK).parquet(landing)
    start_alert_log(stream_alerts(src, 300, 0.02, 10), out, ck, fmt=fmt).awaitTermination()
    lines = [r.value for r in spark.read.text(out).collect()]
    assert len(lines) == 1
    assert ("n=16" in lines[0]) if fmt == "text" else ('"samples":16' in lines[0])


def test_feed_fan_out_to_store_and_alert_log(spark):
    import json
    from datetime import timedelta

    from conftest import BASE

    from tidemark.sources.payloads import write_landed
    from tidemark.streaming.jobs import start_feed

    polls = []
    for s in range(20):
        price = 105.0 if s == 19 else 100.0
        body = {"alpha": {"usd": price, "usd_24h_vol": 1000.0}, "beta": {"usd": 50.0}}
        polls.append((json.dumps(body), (BASE + timedelta(seconds=s)).replace(tzinfo=None)))
    landing, store, alerts, ck = (S.scratch_path(spark, n) for n in ("land", "store", "alerts", "ck"))
    df = spark.createDataFrame(polls, "payload string, ingested_at timestamp")
    write_landed(df, landing)
    write_landed(df, landing)  # a replay: the store ignores it (the detector sees it, as a poller would)
    qs = start_feed(spark, landing, store, alerts, ck, fmt="json",
                    detector=dict(window_s=300, threshold=0.02, warmup_s=10))
    for q in qs:
        q.awaitTermination()
    assert spark.read.parquet(store).count() == 40  # 20 polls x 2 assets, replay ignored
    lines = [json.loads(r.value) for r in spark.read.text(alerts).collect()]
    assert any(a["asset_id"] == "alpha" and a["metric"] == "price" for a in lines)


def test_feed_runner_once(spark):
    import json
    from datetime import timedelta

    from conftest import BASE

    from tidemark.sources.payloads import write_landed
    from tidemark.streaming.__main__ import main

    polls = [(json.dumps({"alpha": {"usd": 100.0 if s < 12 else 150.0}}),
              (BASE + timedelta(seconds=s)).replace(tzinfo=None)) for s in range(13)]
    landing, store, alerts, ck = (S.scratch_path(spark, n) for n in ("land", "store", "alerts", "ck"))
    write_landed(spark.createDataFrame(polls, "payload string, ingested_at timestamp"), landing)
    main(["--landing", landing, "--store", store, "--alerts", alerts, "--checkpoint", ck,
          "--warmup", "10", "--once"])
    assert spark.read.parquet(store).count() == 13
    lines = spark.read.text(alerts).collect()
    assert len(lines) == 1 and '"value":150.0' in lines[0].value


def test_append_mode_candles_hold_back_the_open_bucket(spark):
    from tidemark.streaming.jobs import stream_candles
    rows = [(s, float(s)) for s in range(0, 3 * 3600, 600)]  # three hourly buckets
    landing, out, ck = (S.scratch_path(spark, n) for n in ("land", "out", "ck"))
    _land(spark, rows, landing, 3)
    src = spark.readStream.schema(TICK).option("maxFilesPerTrigger", 1).parquet(landing)
    q = (stream_candles(src, "1 hour", "10 minutes").writeStream.outputMode("append")
         .format("parquet").option("path", out).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r.bucket, r.ticks) for r in spark.read.parquet(out).collect())
    assert got == [(at(0), 6), (at(3600), 6)]  # the 2:00 bucket is still open


def test_console_prints_every_alert_of_a_micro_batch(spark, capfd):
    from tidemark.streaming.jobs import start_alert_console
    rows = [(s, 105.0 if s == 16 else 100.0, 1000.0, f"coin{a}") for a in range(45) for s in range(17)]
    landing, ck = (S.scratch_path(spark, n) for n in ("land", "ck"))
    _land(spark, rows, landing, 1)
    src = spark.readStream.schema(TICK).parquet(landing)
    start_alert_console(stream_alerts(src, 300, 0.02, 10), ck, partitions=4).awaitTermination()
    lines = [x for x in capfd.readouterr().out.splitlines() if x.startswith("ALERT ")]
    assert sorted(x.split()[2] for x in lines) == sorted(f"coin{a}" for a in range(45))


def test_restart_lands_each_half_in_several_files_the_second_later(spark, monkeypatch):
    from conftest import SF001

    from tidemark.plans import streams
    seen = []

    def listed(spark, landing, *_, **__):
        fs, root = S._fs(spark, landing)
        seen.append({st.getPath().getName(): st.getModificationTime() for st in fs.listStatus(root)
                     if st.getPath().getName().startswith("part-")})
        return spark.createDataFrame([], _out_schema("asset_id"))

    monkeypatch.setattr(streams.J, "replay_alerts", listed)
    streams.stream_alerts_restart(spark, SF001)
    first, second = seen[0], {k: t for k, t in seen[1].items() if k not in seen[0]}
    assert len(first) >= 4 and len(second) >= 4
    assert min(second.values()) > max(first.values())
