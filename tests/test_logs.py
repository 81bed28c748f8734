"""Candle log with folding, invalidation of old buckets, live enrichment: replays and jobs that die half-way."""

from __future__ import annotations

import pytest
from conftest import make_ticks
from pyspark.sql import functions as F

from tidemark.operators import candles as C
from tidemark.sources import store as S
from tidemark.streaming import candle_log as CL
from tidemark.streaming import enrichment as E
from tidemark.streaming import jobs as J


def rows_of(df):
    return sorted(tuple(r) for r in df.select("asset_id", "bucket", "open", "high", "low", "close", "volume_24h", "ticks").collect())


PARTS = [
    [(i * 1800, 100 + i, 10.0 * i) for i in range(60)],
    [(i * 1800 + 5, 50 + i, None, "eth") for i in range(90)],
    [(i * 7200 + 60, 500 + i, 7.0) for i in range(20)],  # late, into days already folded
]


def run(spark, src, log, ck):
    CL.start_candle_log(spark.readStream.schema(make_ticks(spark, []).schema).parquet(src), log, ck, "1 hour").awaitTermination()


def test_folds_change_nothing_that_is_read(spark, tmp_path):
    src, log, ck = (str(tmp_path / n) for n in ("src", "log", "ck"))
    seen = []
    for part in PARTS:
        make_ticks(spark, part).coalesce(1).write.mode("append").parquet(src)
        run(spark, src, log, ck)
        seen += part
        want = rows_of(C.candles(make_ticks(spark, seen), "1 hour"))
        assert rows_of(CL.read_candles(spark, log)) == want
        assert CL.fold(spark, log) is not None and CL._deltas(spark, log) == []
        assert rows_of(CL.read_candles(spark, log)) == want
    assert CL.fold(spark, log) is None


def test_a_fold_only_writes_the_days_of_its_deltas(spark, tmp_path):
    src, log, ck = (str(tmp_path / n) for n in ("src", "log", "ck"))
    for part in (PARTS[0], [(40 * 1800, 1, 1.0, "x")]):
        make_ticks(spark, part).coalesce(1).write.mode("append").parquet(src)
        run(spark, src, log, ck)
        files = {r[0] for r in spark.read.parquet(f"{log}/{CL.BASE}").select("_metadata.file_path").distinct().collect()} \
            if S.list_partitions_of(spark, f"{log}/{CL.BASE}", CL.DAY) else set()
        CL.fold(spark, log)
    after = {r[0] for r in spark.read.parquet(f"{log}/{CL.BASE}").select("_metadata.file_path").distinct().collect()}
    days = len(S.list_partitions_of(spark, f"{log}/{CL.BASE}", CL.DAY))
    assert days > 1 and len({f.rsplit("/", 2)[1] for f in after - files}) == 1


@pytest.mark.parametrize("died", ["before the swap", "after some days", "after the swap", "among the drops"])
def test_a_fold_that_died_loses_and_doubles_nothing(spark, tmp_path, monkeypatch, died):
    src, log, ck = (str(tmp_path / n) for n in ("src", "log", "ck"))
    for part in PARTS[:2]:
        make_ticks(spark, part).coalesce(1).write.mode("append").parquet(src)
        run(spark, src, log, ck)
    CL.fold(spark, log)
    make_ticks(spark, PARTS[2]).coalesce(2).write.mode("append").parquet(src)
    run(spark, src, log, ck)
    want = rows_of(C.candles(make_ticks(spark, sum(PARTS, [])), "1 hour"))
    swap, drop, dropped = S.overwrite_partitions, S.drop_folder, []

    def dying_swap(df, path, staging, column):
        if died == "after some days":
            first = df.agg(F.min(column)).first()[0]
            swap(df.where(F.col(column) == first), path, staging, column)
        elif died == "after the swap":
            swap(df, path, staging, column)
        raise RuntimeError("executor lost")

    def dying_drop(spark, path):
        if "deltas" in path and dropped:
            raise RuntimeError("driver lost")
        dropped.append(path)
        drop(spark, path)

    make_ticks(spark, [(0, 1, 1.0, "later")]).coalesce(1).write.mode("append").parquet(src)
    run(spark, src, log, ck)  # a second delta, for "among the drops"
    want = rows_of(C.candles(make_ticks(spark, sum(PARTS, []) + [(0, 1, 1.0, "later")]), "1 hour"))
    with monkeypatch.context() as m:
        if died == "among the drops":
            m.setattr(S, "drop_folder", dying_drop)
        else:
            m.setattr(S, "overwrite_partitions", dying_swap)
        with pytest.raises(RuntimeError):
            CL.fold(spark, log)
    spark.catalog.refreshByPath(log)
    assert rows_of(CL.read_candles(spark, log)) == want
    make_ticks(spark, [(90, 3, 3.0, "eth")]).coalesce(1).write.mode("append").parquet(src)
    run(spark, src, log, ck)  # the stream goes on meanwhile
    want = rows_of(C.candles(make_ticks(spark, sum(PARTS, []) + [(0, 1, 1.0, "later"), (90, 3, 3.0, "eth")]), "1 hour"))
    assert rows_of(CL.read_candles(spark, log)) == want
    while CL.fold(spark, log) is not None:
        assert rows_of(CL.read_candles(spark, log)) == want
    assert CL._begun(spark, log) is None and CL._deltas(spark, log) == []


def test_old_buckets_are_refreshed_when_late_ticks_come(spark, tmp_path):
    src, store, rollup, ck = (str(tmp_path / n) for n in ("src", "store", "rollup", "ck"))
    schema = make_ticks(spark, []).schema

    def land(part):
        make_ticks(spark, part).coalesce(1).write.mode("append").parquet(src)
        J.start_tick_store(spark.readStream.schema(schema).parquet(src), store, ck, rollups={rollup: "1 hour"}).awaitTermination()

    land(PARTS[0])
    C.candles(spark.read.parquet(store), "1 hour").withColumn("bucket_date", F.to_date("bucket")) \
        .write.partitionBy("bucket_date").parquet(rollup)
    S.refresh_table(spark, rollup, spark.read.parquet(store), "2026-06-12 00:00:00", "1 day", "1 hour", "1 hour")
    # one hour that had ticks, one that had none, on days far outside the window
    land([(-86400 * 20, 7, 1.0), (600, 9, 2.0), (601, 9, 2.0, "new")])
    before = {r[0] for r in spark.read.parquet(rollup).select("_metadata.file_path").distinct().collect()}
    S.refresh_invalidated(spark, rollup, spark.read.parquet(store), "2026-06-12 00:00:00", "2 hours", "1 hour", "1 hour")
    spark.catalog.refreshByPath(rollup)
    assert rows_of(spark.read.parquet(rollup)) == rows_of(C.candles(spark.read.parquet(store), "1 hour"))
    kept = {r[0] for r in spark.read.parquet(rollup).select("_metadata.file_path").distinct().collect()} & before
    assert any("2026-06-10" in f for f in kept)  # a day between the two wasn't written
    fs, root = S._fs(spark, f"{rollup}/{S.INVALIDATED}")
    assert not fs.exists(root) or not list(fs.listStatus(root))


RECORDS = "k long, v string"


def outcome(spark, out):
    sent = E.sent_records(spark, out).select(F.from_json("value", "k long, v string, name string").alias("r")).select("r.*")
    waiting = E.waiting_records(spark, out, spark.createDataFrame([], RECORDS).schema)
    return sorted(tuple(r) for r in sent.collect()), sorted(((r.k, r.v) for r in waiting.collect()), key=str)


def test_records_wait_for_their_dimension_and_go_out_once(spark, tmp_path):
    src, dims, out, ck = (str(tmp_path / n) for n in ("src", "dims", "out", "ck"))
    schema = spark.createDataFrame([], RECORDS).schema
    table = E.VersionedTable(spark, dims)
    names = lambda *ks: spark.createDataFrame([(k, f"n{k}") for k in ks], "k long, name string")
    table.put(names(1))

    def land(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(src)

    def run():
        stream = spark.readStream.schema(schema).parquet(src)
        E.start_enrichment(stream, dims, out, ck, "k", "k").awaitTermination()

    land((1, "a"), (2, "b"), (2, "b"), (None, "x"))
    run()
    assert outcome(spark, out) == ([(1, "a", "n1")], [(2, "b"), (2, "b"), (None, "x")])
    table.put(names(1, 2))
    land((3, "c"))
    run()
    # as if the batch had died after it sent, before its buffer was written: it runs again
    S.drop_folder(spark, f"{out}/{E.WAITING}/label={1:012d}")
    for name in ("1", ".1.crc"):
        (tmp_path / "ck" / "commits" / name).unlink()
    run()
    assert outcome(spark, out) == (
        [(1, "a", "n1"), (2, "b", "n2"), (2, "b", "n2")], [(3, "c"), (None, "x")])
    table.put(names(1, 2, 3))
    E.settle(spark, dims, out, schema, "k", "k")
    E.settle(spark, dims, out, schema, "k", "k")
    land((1, "z"))
    run()
    sent, waiting = outcome(spark, out)
    assert sent == [(1, "a", "n1"), (1, "z", "n1"), (2, "b", "n2"), (2, "b", "n2"), (3, "c", "n3")] and waiting == [(None, "x")]


def test_a_settlement_that_died_sends_nothing_twice(spark, tmp_path):
    src, dims, out, ck = (str(tmp_path / n) for n in ("src", "dims", "out", "ck"))
    schema = spark.createDataFrame([], RECORDS).schema
    table = E.VersionedTable(spark, dims)
    table.put(spark.createDataFrame([(9, "n9")], "k long, name string"))
    spark.createDataFrame([(1, "a")], schema).coalesce(1).write.parquet(src)
    stream = lambda: E.start_enrichment(spark.readStream.schema(schema).parquet(src), dims, out, ck, "k", "k").awaitTermination()
    stream()
    table.put(spark.createDataFrame([(1, "n1")], "k long, name string"))
    E.settle(spark, dims, out, schema, "k", "k")
    last = E._complete(spark, f"{out}/{E.WAITING}", "label")[-1]
    S.drop_folder(spark, f"{out}/{E.WAITING}/label={last}")  # as if it had died before its buffer
    spark.createDataFrame([(1, "b")], schema).coalesce(1).write.mode("append").parquet(src)
    stream()
    assert outcome(spark, out) == ([(1, "a", "n1"), (1, "b", "n1")], [])


def test_a_version_that_was_not_written_whole_is_not_read(spark, tmp_path):
    table = E.VersionedTable(spark, str(tmp_path / "t"))
    table.put(spark.range(3))
    (tmp_path / "t" / "version=2").mkdir()
    assert table.newest() == 1 and table.get().count() == 3
    assert table.put(spark.range(4)) == 2 and table.get().count() == 4
