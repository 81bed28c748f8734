"""Bad rows, replays and emptied days: nothing stops, nothing comes back, nothing is left behind."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import make_ticks, model_for_rows
from pyspark.sql import functions as F

from tidemark.operators import alerts as A
from tidemark.operators import candles as C
from tidemark.operators import quality as Q
from tidemark.operators.keyed import cdc_apply, cdc_versions
from tidemark.sources import payloads as P
from tidemark.sources import store as S
from tidemark.streaming import jobs as J

NOW = "2026-06-20 00:00:00"


def changes(spark, rows):
    return spark.createDataFrame(rows, "k long, v string, lsn long, op string")


def test_deleted_rows_stay_deleted(spark, tmp_path):
    path = str(tmp_path / "t")
    first = changes(spark, [(1, "a", 5, "I"), (2, "b", 5, "I")])
    apply = lambda df, **kw: sorted(tuple(r) for r in S.apply_changes(spark, path, df, "k", **kw).collect())
    assert apply(first) == [(1, "a", 5), (2, "b", 5)]
    assert apply(changes(spark, [(1, None, 10, "D"), (3, None, 4, "D")])) == [(2, "b", 5)]
    assert apply(first) == [(2, "b", 5)]  # the first batch again
    assert apply(changes(spark, [(3, "old", 3, "U"), (1, "older", 9, "U")])) == [(2, "b", 5)]
    assert apply(changes(spark, [(1, "new", 11, "I")])) == [(1, "new", 11), (2, "b", 5)]
    assert apply(changes(spark, [])) == [(1, "new", 11), (2, "b", 5)]


def test_replays_in_any_order_end_alike(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.randrange(8), f"v{i}", i, rng.choice("IUUD")) for i in range(80)]
    newest = {k: (k, v, i, op) for k, v, i, op in rows}
    want = sorted(r[:3] for r in newest.values() if r[3] != "D")
    batches = [rows[i : i + 10] for i in range(0, 80, 10)]
    for run in range(2):
        path = str(tmp_path / f"t{run}")
        rng.shuffle(batches)
        for b in batches + batches[:3]:
            out = S.apply_changes(spark, path, changes(spark, b), "k")
        assert sorted(tuple(r) for r in out.collect()) == want


def test_forgotten_deletes_are_not_undone(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in ([(1, "a", 1, "I")], [(1, None, 2, "D")], [(2, "b", 100, "I")]):
        S.apply_changes(spark, path, changes(spark, batch), "k", horizon=50)
    assert spark.read.parquet(f"{path}/{S.TOMBSTONES}").count() == 0
    out = S.apply_changes(spark, path, changes(spark, [(1, "a", 1, "I"), (3, "c", 60, "I")]), "k", horizon=50)
    assert sorted(tuple(r) for r in out.collect()) == [(2, "b", 100), (3, "c", 60)]


def test_versions_with_tombstones(spark):
    cur = spark.createDataFrame([(1, "a", 5)], "k long, v string, lsn long")
    gone = spark.createDataFrame([(2, 7)], "k long, lsn long")
    ch = changes(spark, [(2, "x", 6, "U"), (1, "z", 4, "U"), (4, "n", 1, None)])
    got = {r.k: (r.v, r.lsn, r.deleted) for r in cdc_versions(cur, ch, "k", tombstones=gone).collect()}
    assert got == {1: ("a", 5, False), 2: (None, 7, True), 4: ("n", 1, False)}
    assert sorted(r.k for r in cdc_apply(cur, ch, "k", tombstones=gone).collect()) == [1, 4]


def test_polls_without_a_time_are_rejected(spark):
    polls = spark.createDataFrame([
        ('{"a": {"usd": 1}, "b": {"eur": 1}}', None), ('{"a": {"usd": "NaN"}}', dt.datetime(2026, 1, 1)),
        ('{"a": {"usd": 2, "usd_24h_vol": "nan"}}', dt.datetime(2026, 1, 1)), ("{", None)],
        "payload string, ingested_at timestamp")
    assert P.parse_prices(polls).count() == 0 and P.parse_prices(polls, strict=True).count() == 0
    got = sorted((r.asset_id or "", r.reason) for r in P.price_rejects(polls).collect())
    assert got == [("", "unreadable payload"), ("a", "malformed number"), ("a", "malformed number"),
                   ("a", "missing poll time")]


def test_the_store_runs_on_behind_a_bad_row(spark, tmp_path):
    src, store, ck = (str(tmp_path / n) for n in ("src", "store", "ck"))
    good = make_ticks(spark, [(0, 100), (86400 * 3, 101)])
    bad = good.limit(1).withColumn("ingested_at", F.lit(None).cast("timestamp"))
    for part in (good.unionByName(bad), bad, make_ticks(spark, [(86400 * 5, 102)]), good):
        part.coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(good.schema).parquet(src)
        J.start_tick_store(stream, store, ck).awaitTermination()
    assert spark.read.parquet(store).count() == 3
    assert spark.read.parquet(f"{store}/{J.QUARANTINE}").count() == 2
    assert len(S.list_partitions(spark, store)) == 3


def test_folders_without_a_date_stop_no_maintenance(spark, tmp_path):
    path = str(tmp_path / "s")
    ticks = make_ticks(spark, [(0, 1), (86400, 2), (2 * 86400, 3)])
    S.append_ticks(ticks.unionByName(ticks.limit(1).withColumn("ingested_at", F.lit(None).cast("timestamp"))), path)
    assert S.undated_partitions(spark, path) == [f"{S.PART}={S.NO_VALUE}"]
    assert S.compact(spark, path, 1, NOW).count() == 3
    actions = {r.ingest_date: r.action for r in S.apply_retention(spark, path, 9, NOW, dry_run=False).collect()}
    assert actions[None].startswith("kept") and sorted(actions.values()).count("dropped") == 2
    report = S.erase_in_store(spark, path, spark.createDataFrame([("bitcoin",)], "asset_id string"), "asset_id")
    assert {r.ingest_date for r in report.collect()} == {None, dt.date(2026, 6, 11)}
    assert S.undated_partitions(spark, path) == [] and S.list_partitions(spark, path) == []


def test_a_refresh_drops_days_without_ticks(spark, tmp_path):
    path = str(tmp_path / "r")
    ticks = make_ticks(spark, [(d * 86400 + h * 3600, 100 + h) for d in range(3) for h in range(3)])
    C.candles(ticks, "1 hour").withColumn("bucket_date", F.to_date("bucket")).write.partitionBy("bucket_date").parquet(path)
    left = ticks.where(F.to_date("ingested_at") != F.lit("2026-06-10").cast("date"))
    S.refresh_table(spark, path, left, "2026-06-12 00:00:00", "2 days", "1 hour", "1 hour")
    days = {str(r[0]) for r in spark.read.parquet(path).select("bucket_date").distinct().collect()}
    assert days == {"2026-06-09", "2026-06-11"}
    S.refresh_table(spark, path, left.limit(0), "2026-06-12 00:00:00", "3 days", "1 hour", "1 hour")
    assert S.list_partitions_of(spark, path, "bucket_date") == []


def test_a_null_key_is_no_silence(spark):
    rows = [(None, f"2026-01-{d:02d} 00:00:00") for d in range(1, 12) for _ in range(5)] + [("a", "2026-01-11 00:00:00")]
    df = spark.createDataFrame(rows, "k string, t string").withColumn("t", F.col("t").cast("timestamp"))
    out = Q.volume_anomaly(df, "t", by=["k"]).where("k IS NULL").collect()
    assert {r.n for r in out} == {5} and len(out) == 11 and not any(r.anomaly for r in out)
    ticks = df.select(F.col("k").alias("asset_id"), F.col("t").alias("ts"), F.col("t").alias("ingested_at"))
    assert {r.polls for r in Q.feed_cadence(ticks, 1.0, "1 day").where("asset_id IS NULL").collect()} == {5}


@pytest.mark.parametrize("bucket_s", ["auto", 60, None])
def test_arrival_alerts_against_the_model(spark, bucket_s):
    rng = random.Random(9)
    for late in (0, 5, 40, 400):
        rows, sec = [], 0
        for _ in range(160):
            sec += rng.randint(1, 9)
            rows.append((sec, rng.choice([50, 100, 100, 200]), rng.choice([None, 1000.0, 1500.0]),
                         rng.choice("ab"), sec - rng.randint(0, late)))
        rows = list({(r[0], r[3]): r for r in rows}.values())
        got = A.arrival_alerts(make_ticks(spark, rows), 30, 0.02, 10, bucket_s=bucket_s).collect()
        want = model_for_rows(rows, 30, 0.02, 10)
        key = lambda a: (a[0], a[6], a[1], a[2], a[5], round(a[3], 9), round(a[4], 9))
        have = [(r.asset_id, r.metric, r.value, r.baseline, r.change_pct, r.samples, r.ts) for r in got]
        assert sorted(map(key, have)) == sorted(map(key, want)), late


def test_windows_without_a_common_scale(spark):
    """Widths whose common multiple no long holds are taken one by one."""
    windows = [86399, 86400, 86401, 100003]
    assert len(A._one_scale(sorted(windows), A.auto_bucket_s(max(windows)))) == 4
    rows = [(i * 1000, 100 + i % 7, 1000.0) for i in range(300)]
    ticks = make_ticks(spark, rows)
    many = A.multi_window_alerts(ticks, windows, 0.02, 0)
    for w in windows:
        one = A.trailing_alerts(ticks, w, 0.02, 0)
        assert sorted(map(tuple, many.where(F.col("window_s") == w).collect())) == sorted(map(tuple, one.collect()))
