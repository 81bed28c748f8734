"""Keyed table operators, candles, store jobs and quality gates on small fixtures."""

from __future__ import annotations

from datetime import datetime

import pytest
from conftest import at, make_ticks
from pyspark.sql import functions as F

from tidemark.operators import candles as C
from tidemark.operators import keyed as K
from tidemark.operators import quality as Q
from tidemark.operators.marts import newest, recent_per_asset
from tidemark.sources import store as S


def test_insert_ignore_first_wins_and_replay_is_noop(spark):
    src = spark.createDataFrame([(1, "a", 1), (1, "b", 0), (2, "c", 5)], "k int, v string, seq int")
    batch = K.insert_ignore(None, src, "k", "seq").collect()
    assert sorted((r.k, r.v) for r in batch) == [(1, "b"), (2, "c")]
    stored = spark.createDataFrame([(1, "b", 0)], "k int, v string, seq int")
    again = K.insert_ignore(stored, src, "k", "seq").collect()
    assert [(r.k, r.v) for r in again] == [(2, "c")]


def test_upsert_null_overwrites_and_created_kept(spark):
    t = spark.createDataFrame([("x", "X", 1.0, datetime(2024, 1, 1), datetime(2024, 1, 1))],
                              "id string, name string, ms double, created_at timestamp, updated_at timestamp")
    s = spark.createDataFrame([("x", "X2", None, 1), ("x", "X3", None, 2), ("y", "Y", 2.0, 1)],
                              "id string, name string, ms double, seq int")
    out = {r.id: r for r in K.upsert(t, s, "id", ["name", "ms"], "2024-02-01", order="seq").collect()}
    assert out["x"].name == "X3" and out["x"].ms is None
    assert out["x"].created_at == datetime(2024, 1, 1) and out["x"].updated_at == datetime(2024, 2, 1)
    assert out["y"].created_at == datetime(2024, 2, 1)


def test_cdc_apply_is_replay_safe(spark):
    cur = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, lsn long")
    ch = spark.createDataFrame([(1, "a2", 5, "U"), (2, None, 3, "D"), (3, "c", 1, "U")],
                               "k int, v string, lsn long, op string")
    once = K.cdc_apply(cur, ch, "k")
    twice = K.cdc_apply(once, ch, "k")
    assert sorted(tuple(r) for r in once.collect()) == [(1, "a2", 5), (3, "c", 1)]
    assert sorted(tuple(r) for r in twice.collect()) == sorted(tuple(r) for r in once.collect())
    older = spark.createDataFrame([(1, "old", 4, "U")], "k int, v string, lsn long, op string")
    assert {r.v for r in K.cdc_apply(once, older, "k").collect()} == {"a2", "c"}


def test_fk_split(spark):
    child = spark.createDataFrame([(1,), (2,), (3,)], "p int")
    parent = spark.createDataFrame([(1,), (3,)], "id int")
    valid, orphans = K.fk_split(child, parent, "p", "id")
    assert sorted(r.p for r in valid.collect()) == [1, 3]
    assert [r.p for r in orphans.collect()] == [2]


def test_candles_null_last_volume_and_rollup_equals_raw(spark):
    rows = [(0, 10.0, 5.0), (20, 12.0, 6.0), (59, 9.0, None), (61, 11.0, 7.0), (3700, 8.0, 1.0)]
    ticks = make_ticks(spark, rows)
    c1 = {r.bucket: r for r in C.candles(ticks, "1 minute").collect()}
    first = c1[at(0)]
    assert (first.open, first.high, first.low, first.close, first.volume_24h, first.ticks) == \
        (10.0, 12.0, 9.0, 9.0, None, 3)
    hourly_raw = sorted(tuple(r) for r in C.candles(ticks, "1 hour").collect())
    hourly_up = sorted(tuple(r) for r in C.rollup_candles(C.candles(ticks, "1 minute"), "hour").collect())
    assert hourly_raw == hourly_up


def test_refresh_keeps_buckets_outside_window(spark):
    ticks = make_ticks(spark, [(s, float(s)) for s in range(0, 600, 30)])
    stale = C.candles(ticks.where(F.col("ingested_at") < F.lit(at(200))), "1 minute")
    fresh = C.refresh(stale, ticks, at(400), "5 minutes", "1 minute", "1 minute").collect()
    got = sorted((r.bucket, r.ticks) for r in fresh)
    # window [now-5m, now-1m) = [1:40, 5:40) -> whole buckets [2, 5) minutes recomputed;
    # buckets 0 and 1 kept from the stale rollup; its partial bucket 3 (one tick) fixed
    assert got == [(at(0), 2), (at(60), 2), (at(120), 2), (at(180), 2), (at(240), 2)]


def test_newest_and_recent(spark):
    ticks = make_ticks(spark, [(s, 1.0, 1.0, a) for s in range(5) for a in ("x", "y")])
    top = [(r.asset_id, r.ingested_at) for r in newest(ticks, 3).collect()]
    assert top == [("x", at(4)), ("y", at(4)), ("x", at(3))]
    assert recent_per_asset(ticks, 2).count() == 4


def test_scan_prunes_partitions(spark):
    ticks = make_ticks(spark, [(d * 86400 + 5, 1.0) for d in range(5)])
    path = S.scratch_path(spark, "test-store")
    S.append_ticks(ticks, path)
    df = S.scan_ticks(spark, path, at(86400), at(2 * 86400 + 10))
    assert df.count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan


def test_compaction_is_lossless_and_retention_respects_rollups(spark):
    ticks = make_ticks(spark, [(d * 86400 + s, float(s)) for d in range(6) for s in range(0, 300, 60)])
    path = S.scratch_path(spark, "test-store")
    S.append_ticks(ticks, path)
    report = S.compact(spark, path, 2, at(6 * 86400))
    assert all(r.verified for r in report.collect()) and report.count() == 4
    assert sorted(tuple(r) for r in spark.read.parquet(path).drop("ingest_date").collect()) == \
        sorted(tuple(r) for r in ticks.collect())
    partial = C.candles(ticks.where(F.col("ingested_at") < F.lit(at(2 * 86400))), "1 hour")
    plan = {r.ingest_date.day: r.action for r in
            S.apply_retention(spark, path, 2, at(6 * 86400), dry_run=True, rollup=partial).collect()}
    # the rollup reaches 2026-06-10 12:00, so only 06-09 is fully covered
    assert plan == {9: "drop", 10: "kept: not rolled up", 11: "kept: not rolled up",
                    12: "kept: not rolled up"}
    assert len(S.list_partitions(spark, path)) == 6  # dry run changed nothing


def _files(spark, path):
    return {r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect()}


def test_second_compaction_rewrites_changed_days_only(spark):
    ticks = make_ticks(spark, [(d * 86400 + s, float(s)) for d in range(4) for s in range(0, 300, 60)])
    path = S.scratch_path(spark, "test-store")
    S.append_ticks(ticks, path)
    assert S.compact(spark, path, 1, at(4 * 86400)).count() == 3
    files = _files(spark, path)
    assert S.compact(spark, path, 1, at(4 * 86400)).count() == 0
    assert _files(spark, path) == files
    S.append_ticks(make_ticks(spark, [(86400 + 7, 1.0)]), path)  # a late row reaches a compacted day
    assert [r.ingest_date.day for r in S.compact(spark, path, 1, at(4 * 86400)).collect()] == [10]
    assert len(_files(spark, path) & files) == len(files) - 1
    assert spark.read.parquet(path).count() == 21


def test_refresh_stores_its_mark(spark):
    ticks = make_ticks(spark, [(s, float(s)) for s in range(0, 5 * 3600, 600)])
    path = S.scratch_path(spark, "rollup")
    empty = C.candles(ticks.limit(0), "1 hour")
    empty.withColumn("bucket_date", F.to_date("bucket")).write.parquet(path)
    assert S.completed_through(spark, path) is None
    want = sorted(tuple(r) for r in C.candles(ticks, "1 hour").collect())
    for hours in (3, 2):  # the mark doesn't move back
        S.refresh_table(spark, path, ticks, at(hours * 3600), "1 day", "1 second", "1 hour")
        assert S.completed_through(spark, path) == at(2 * 3600)
        assert sorted(tuple(r) for r in S.realtime_table(spark, path, ticks, "1 hour").collect()) == want


def test_quality_gate_raises(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, s string")
    report = Q.check(df, [Q.not_null("s"), Q.accepted("s", ["x"])])
    with pytest.raises(Q.GateFailed):
        Q.gate(report)
    good, bad = Q.quarantine(df, [Q.not_null("s")])
    assert good.count() == 1 and bad.collect()[0].reasons == ["not_null:s"]


def test_feed_outages_across_days(spark):
    rows = [(1, datetime(2024, 1, 1, 23, 58), True), (1, datetime(2024, 1, 1, 23, 59), False),
            (1, datetime(2024, 1, 2, 0, 0), False), (1, datetime(2024, 1, 2, 0, 1), True),
            (1, datetime(2024, 1, 3, 0, 0), False)]
    polls = spark.createDataFrame(rows, "feed_id int, polled_at timestamp, ok boolean")
    got = sorted(tuple(r)[1:] for r in Q.feed_outages(polls).collect())
    assert got == [(datetime(2024, 1, 1, 23, 59), datetime(2024, 1, 2, 0, 0), 2, datetime(2024, 1, 2, 0, 1)),
                   (datetime(2024, 1, 3, 0, 0), datetime(2024, 1, 3, 0, 0), 1, None)]


def test_erasure_and_audit(spark):
    from tidemark.operators.privacy import erase, erasure_audit, mask_text
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "doc_id int, text string")
    subjects = spark.createDataFrame([(2,), (2,)], "doc_id int")
    assert sorted(r.doc_id for r in erase(docs, subjects, "doc_id").collect()) == [1, 3]
    audit = erasure_audit(docs, subjects, "doc_id", "req-1", "2024-01-01").collect()[0]
    assert (audit.request_id, audit.rows_removed) == ("req-1", 1)
    txt = spark.createDataFrame([("mail x.y@host.example.org, card 4111111111111111, ip 10.0.0.1, "
                                  "call +1 (555) 123-4567",)], "t string")
    assert txt.select(mask_text("t").alias("m")).collect()[0].m == \
        "mail <email>, card <card>, ip <ip>, call <phone>"


def test_erase_in_store_rewrites_only_touched_days(spark):
    ticks = make_ticks(spark, [(d * 86400 + s, 1.0, 1.0, a) for d in range(3) for s in (0, 60)
                               for a in ("x", "y")])
    path = S.scratch_path(spark, "test-store")
    S.append_ticks(ticks, path)
    untouched = {f.getPath().getName() for f in S._fs(spark, path)[0].listStatus(
        spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/ingest_date=2026-06-10"))}
    subjects = spark.createDataFrame([(at(0),), (at(2 * 86400 + 60),)], "ingested_at timestamp")
    report = sorted((r.ingest_date.day, r.rows_removed) for r in
                    S.erase_in_store(spark, path, subjects, "ingested_at").collect())
    assert report == [(9, 2), (11, 2)]
    left = spark.read.parquet(path)
    assert left.count() == 8
    assert left.where(F.col("ingested_at").isin(at(0), at(2 * 86400 + 60))).count() == 0
    after = {f.getPath().getName() for f in S._fs(spark, path)[0].listStatus(
        spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/ingest_date=2026-06-10"))}
    assert after == untouched  # the day without subjects was not rewritten


def test_seed_assets_upserts_latest_poll(spark):
    import json
    from tidemark.sources.payloads import write_landed
    landing, table = S.scratch_path(spark, "markets"), S.scratch_path(spark, "assets")
    first = [{"id": "alpha", "symbol": "a", "name": "Alpha", "image": "x.png", "max_supply": 21.0}]
    second = [{"id": "alpha", "symbol": "a", "name": "Alpha 2", "image": None, "max_supply": None},
              {"id": "beta", "symbol": "b", "name": "Beta"}]
    polls = spark.createDataFrame([(json.dumps(first), datetime(2024, 1, 1)),
                                   (json.dumps(second), datetime(2024, 1, 2))],
                                  "payload string, ingested_at timestamp")
    write_landed(polls, landing)
    out = {r.id: r for r in S.seed_assets(spark, landing, table, "2024-02-01").collect()}
    assert out["alpha"].name == "Alpha 2" and out["alpha"].max_supply is None
    again = {r.id: r for r in S.seed_assets(spark, landing, table, "2024-03-01").collect()}
    assert again["alpha"].created_at == datetime(2024, 2, 1)
    assert again["alpha"].updated_at == datetime(2024, 3, 1) and set(again) == {"alpha", "beta"}


def _ticks(spark, rows):
    """(asset, 'YYYY-MM-DD HH:MM:SS', price) rows as ticks."""
    from datetime import datetime

    from tidemark.schemas import TICK

    at_ = datetime.fromisoformat
    return spark.createDataFrame([(a, at_(t), at_(t), p, None, None, None) for a, t, p in rows], TICK)


def test_erasure_drops_emptied_days_and_staging(spark, tmp_path):
    import glob

    path = str(tmp_path / "store")
    S.append_ticks(_ticks(spark, [
        ("x", "2024-01-01 00:00:00", 1.0), ("x", "2024-01-01 01:00:00", 2.0),
        ("x", "2024-01-02 00:00:00", 3.0), ("y", "2024-01-02 00:00:00", 4.0), ("y", "2024-01-03 00:00:00", 5.0)]), path)
    report = S.erase_in_store(spark, path, spark.createDataFrame([("x",)], "asset_id string"), "asset_id", request_id="r1")
    assert sorted((r.request_id, str(r.ingest_date), r.rows_removed) for r in report.collect()) == [
        ("r1", "2024-01-01", 2), ("r1", "2024-01-02", 1)]
    assert sorted((r.asset_id, r.price) for r in spark.read.parquet(path).collect()) == [("y", 4.0), ("y", 5.0)]
    S.erase_in_store(spark, path, spark.createDataFrame([("y",)], "asset_id string"), "asset_id")
    assert S.list_partitions(spark, path) == []
    from tidemark.session import checkpoint_root
    assert not glob.glob(f"{checkpoint_root(spark)}/tidemark/erase-*")


def test_retention_keeps_days_that_the_rollup_lacks(spark, tmp_path):
    from tidemark.operators.candles import candles

    path = str(tmp_path / "store")
    ticks = _ticks(spark, [(a, f"2024-01-0{d} 00:00:0{s}", 1.0) for a in "xy" for d in (1, 2, 3, 4) for s in (0, 1)])
    S.append_ticks(ticks, path)
    rollup = candles(ticks, "1 hour").where("NOT (asset_id = 'y' AND to_date(bucket) = DATE '2024-01-02')")
    got = {str(r.ingest_date): r.action for r in S.apply_retention(
        spark, path, 1, "2024-01-04 00:00:00", dry_run=False, rollup=rollup).collect()}
    assert got == {"2024-01-01": "dropped", "2024-01-02": "kept: not rolled up"}


def test_seeding_applies_rows_in_turn(spark, tmp_path):
    import json
    from datetime import datetime

    rows = [{"id": "a", "symbol": "s", "name": n} for n in ("old", "new")] + [{"id": "b", "symbol": "s", "name": "b"}]
    landing = str(tmp_path / "landing")
    spark.createDataFrame([(json.dumps(rows), datetime(2024, 1, 1))], "payload string, ingested_at timestamp").write.json(
        landing, timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    out = S.seed_assets(spark, landing, str(tmp_path / "assets"), "2024-01-02 00:00:00")
    assert {r.id: r.name for r in out.collect()} == {"a": "new", "b": "b"}
