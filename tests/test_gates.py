"""Gates, feed health and exact dedup in streams; masks, measures and the erasure cascade."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from conftest import at, make_ticks
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark.operators import candles as C
from tidemark.operators import marts as M
from tidemark.operators import privacy as PV
from tidemark.operators.keyed import dedup_unchanged
from tidemark.operators.quality import feed_outages, in_range, not_null
from tidemark.sources import erasure as ER
from tidemark.sources import store as S
from tidemark.streaming import gates as G
from tidemark.streaming import health as H

ROW = "id long, value double"


def test_a_bad_batch_stops_the_stream_and_is_not_stored(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    rules = [in_range("value", 0, 10, max_rate=0.4), not_null("id", max_rate=0.4)]
    schema = spark.createDataFrame([], ROW).schema

    def land(*rows):
        spark.createDataFrame(list(rows), ROW).coalesce(1).write.mode("append").parquet(src)

    def run(how="halt"):
        stream = spark.readStream.schema(schema).parquet(src)
        G.start_gated_store(stream, rules, out, ck, how).awaitTermination()

    def held(part):
        df = G.gated(spark, out, part, ROW + ", reasons array<string>")
        return sorted((r.batch, r.id, tuple(r.reasons or ())) for r in df.collect())

    land((1, 1.0), (2, 2.0), (3, 99.0))
    run()
    land((4, -1.0), (5, -2.0), (6, 3.0))
    for _ in range(2):  # every restart meets it again, and changes nothing
        with pytest.raises(StreamingQueryException, match="range:value"):
            run()
    assert held(G.GOOD) == [(0, 1, ()), (0, 2, ())]
    assert held(G.REJECTS) == [(0, 3, ("range:value",)), (1, 4, ("range:value",)), (1, 5, ("range:value",)), (1, 6, (G.HELD_BACK,))]
    run("divert")
    land((7, 7.0), (8, 8.0))
    run()
    assert [r[1] for r in held(G.GOOD)] == [1, 2, 7, 8]
    report = G.gated(spark, out, G.REPORT, "rule string, violations long, total long, rate double, max_rate double, stored boolean")
    assert sorted((r.batch, r.rule, r.violations, r.total, r.stored) for r in report.collect()) == [
        (0, "not_null:id", 0, 3, True), (0, "range:value", 1, 3, True), (1, "not_null:id", 0, 3, False),
        (1, "range:value", 2, 3, False), (2, "not_null:id", 0, 2, True), (2, "range:value", 0, 2, True)]
    with pytest.raises(ValueError):
        G.start_gated_store(spark.readStream.schema(schema).parquet(src), rules, out, ck, "ignore")


def drain(spark, stream, out, ck):
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).trigger(
        availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


POLL = "feed_id string, polled_at timestamp, ok boolean"


def test_outages_are_told_once_across_restarts(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    rng = random.Random(3)
    polls = [(f, at(i * 10), rng.random() < 0.6) for f in "abc" for i in range(60)]
    schema = spark.createDataFrame([], POLL).schema
    for cut in range(0, 600, 150):
        part = [p for p in polls if at(cut) <= p[1] < at(cut + 150)]
        rng.shuffle(part)
        spark.createDataFrame(part, POLL).coalesce(1).write.mode("append").parquet(src)
        got = drain(spark, H.stream_outages(spark.readStream.schema(schema).parquet(src)), out, ck)
    want = feed_outages(spark.createDataFrame(polls, POLL)).collect()
    rows = got.collect()
    closed = sorted((r.feed_id, r.outage_start, r.outage_end, r.skipped_polls, r.recovered_at) for r in rows if r.event == "closed")
    assert closed == sorted((r.feed_id, r.outage_start, r.outage_end, r.skipped_polls, r.recovered_at)
                            for r in want if r.recovered_at is not None)
    assert sorted((r.feed_id, r.outage_start) for r in rows if r.event == "opened") == sorted((r.feed_id, r.outage_start) for r in want)


def test_outage_state_takes_one_number_a_poll(spark, tmp_path):
    """Timestamps converted for every feed and batch were most of the job's time."""
    schema = spark.createDataFrame([], POLL).schema
    stream = H.stream_outages(spark.readStream.schema(schema).parquet(str(tmp_path)))
    plan = stream._jdf.queryExecution().analyzed()
    while plan.nodeName() != "FlatMapGroupsInPandasWithState":
        plan = plan.children().head()
    types = [plan.output().apply(i).dataType().simpleString() for i in range(plan.output().size())]
    taken = plan.children().head()
    assert "timestamp" not in types and [f.dataType.simpleString() for f in stream.schema].count("timestamp") == 3
    kinds = [taken.output().apply(i).dataType().simpleString() for i in range(taken.output().size())]
    assert "timestamp" not in kinds and kinds.count("bigint") == 1


def test_a_feed_that_stops_sending_is_down(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    schema = spark.createDataFrame([], POLL).schema

    def run(*rows):
        spark.createDataFrame(list(rows), POLL).coalesce(1).write.mode("append").parquet(src)
        stream = H.stream_outages(spark.readStream.schema(schema).parquet(src), silence="30 seconds", watermark="5 seconds")
        return drain(spark, stream, out, ck)

    run(("quiet", at(0), True), ("well", at(0), True))
    run(("well", at(20), True))
    run(("well", at(60), True), (None, at(60), None))
    run(("well", at(80), True))
    run(("well", at(100), True))
    df = run(("quiet", at(120), True), ("well", at(120), True))
    rows = sorted((r.feed_id, r.event, r.outage_start, r.outage_end, r.skipped_polls, r.recovered_at, r.reason) for r in df.collect())
    # "well" itself was silent from 20 s to 60 s, but the clock only moved on with its own poll
    assert [r for r in rows if r[0] == "quiet"] == [
        ("quiet", "closed", at(30), None, 0, at(120), None), ("quiet", "opened", at(30), None, None, None, "silent")]


def test_first_readings_are_whole_and_frozen_ones_stay_known(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    schema = make_ticks(spark, []).schema
    rng = random.Random(5)
    frozen = [(s, 100 + s, 1.0 * s, "ice", 0) for s in range(0, 7200, 60)]  # two hours, polled every minute
    moving = [(s, 5 + s % 7, 2.0, rng.choice("xy"), s - s % 300) for s in range(3, 7200, 60)]
    ticks = sorted(frozen + moving)
    for i in range(0, len(ticks), 40):
        part = ticks[i : i + 40]
        rng.shuffle(part)
        make_ticks(spark, part).coalesce(1).write.mode("append").parquet(src)
        got = drain(spark, H.stream_first_readings(spark.readStream.schema(schema).parquet(src), "10 minutes"), out, ck)
    want = dedup_unchanged(make_ticks(spark, ticks))
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert got.where("asset_id = 'ice'").count() == 1


def test_masks(spark):
    said = {
        "pay 4111 1111 1111 1111 now": "pay <card> now", "4111-1111-1111-1111": "<card>", "x4111111111111111y": "x<card>y",
        "4111111111111112": "4111111111111112", "12341234123412341234123": "12341234123412341234123",
        "call (555) 123-4567": "call <phone>", "amex 3782 822463 10005.": "amex <card>.", "+49 30 123 4567": "<phone>",
        "a@b.de 1.2.3.4": "<email> <ip>", "id 41111111111111111111111": "id 41111111111111111111111",
        "4111111111111111 and 4111111111111111": "<card> and <card>", "no digits": "no digits", "": "",
        "0000 1111 2222 3333 4444": "0000 1111 2222 3333 4444",
    }
    df = spark.createDataFrame([(k,) for k in [*said, None]], "t string").select("t", PV.mask_text("t").alias("m"))
    assert {r.t: r.m for r in df.collect()} == {**said, None: None}


def test_tokens_need_a_salt(spark):
    with pytest.raises(ValueError):
        PV.tokenise(spark.range(1), ["id"], "")


def test_measures_from_one_scan_equal_an_aggregate_per_grain(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), dt.datetime(2024, rng.randint(1, 12), rng.randint(1, 28)), rng.randint(0, 9), rng.random())
            for _ in range(400)]
    df = spark.createDataFrame(rows, "g string, t timestamp, k long, x double")
    kinds = {"s": ("sum", "x", F.sum("x")), "n": ("count", None, F.count(F.lit(1))), "lo": ("min", "x", F.min("x")),
             "hi": ("max", "x", F.max("x")), "d": ("distinct", "k", F.count_distinct("k")), "c": ("count", "g", F.count("g"))}
    for grains in (["month", "year"], ["week", "month"], ["day"], ["week"]):
        new, old = [], []
        for i, (name, (kind, col, expr)) in enumerate(kinds.items()):
            g = grains[i % len(grains)]
            new.append(M.Kpi(name, 1, "o", M.Measure(kind, F.col(col) if col else None), g))
            old.append(M.Kpi(name, 1, "o", expr, g))
        read = lambda defs: sorted(((*r[:-1], round(r[-1], 9)) for r in M.kpi_report(df, defs, "t", ["g"]).collect()), key=str)
        assert read(new) == read(old)
    states = M.kpi_states(df, {"d": M.Measure("distinct", F.col("k")), "s": M.Measure("sum", F.col("x"))}, "t")
    twice = states.where("day < '2024-06-01'").unionByName(states.where("day >= '2024-06-01'"))
    r = M.kpi_rollup(twice, {"d": M.Measure("distinct", F.col("k")), "s": M.Measure("sum", F.col("x"))}, "year").first()
    assert r.d == 10 and r.s == pytest.approx(sum(x[3] for x in rows))


def test_a_kpi_report_scans_its_facts_once(spark):
    from conftest import SF001

    from tidemark.plans.registry import QUERIES, load_all

    load_all()
    plan = QUERIES["kpi_report"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 5  # one of each table of the star


def test_a_kpi_report_deals_its_facts_by_order(spark):
    """In a fixed number of parts: AQE merged them by compressed bytes, and a task held millions of orders."""
    from conftest import SF001

    from tidemark.plans.registry import QUERIES, load_all

    load_all()
    for query in ("kpi_report", "kpis"):
        plan = QUERIES[query](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert "REPARTITION_BY_NUM" in plan


def test_only_a_grain_that_counts_values_carries_them(spark):
    df = spark.range(1000).selectExpr("id", "timestamp'2024-01-01' + make_interval(0, id % 12) AS t", "1 AS g")
    defs = [M.Kpi("n", 1, "o", M.Measure("count"), "month"), M.Kpi("d", 1, "o", M.Measure("distinct", F.col("id")), "year")]
    out = M.kpi_report(df, defs, "t", ["g"])
    assert sorted((r.grain, r.period.month, r.value) for r in out.collect() if r.kpi == "d") == [("year", 1, 1000.0)]
    assert sum(r.value for r in out.collect() if r.kpi == "n") == 1000
    assert "CASE WHEN" in out._jdf.queryExecution().optimizedPlan().toString()


def test_the_erasure_reaches_every_layer(spark, tmp_path):
    store, market, log, bronze, audit = (str(tmp_path / n) for n in ("store", "market", "log", "bronze", "audit"))
    ticks = make_ticks(spark, [(i * 600, 100 + i, 1.0, "abc"[i % 3]) for i in range(300)] + [(86400 * 9, 5, 1.0, "b")])
    S.append_ticks(ticks, store)
    C.candles(ticks, "1 hour", keys=()).withColumn("bucket_date", F.to_date("bucket")).write.partitionBy("bucket_date").parquet(market)
    S.refresh_table(spark, market, ticks, "2026-07-01 00:00:00", "1 day", "1 hour", "1 hour", keys=())
    for name in "abc":
        spark.createDataFrame([(json.dumps({"asset_id": name, "v": 1}),), ("not json",)], "value string").coalesce(1) \
            .write.mode("append").text(log)
    odd = '{"b": {"usd": 1.50, "s": "x\\"y"}, "k\\"q": {"usd": 1.25}, "c": null, "n": [1, 2.0]}'
    payloads = [(odd, at(0)), ('{"b": 1}', at(1)), ('{"a": 1}', at(2)), ("{", at(3)), (None, at(4))]
    for p in payloads:
        spark.createDataFrame([p], "payload string, ingested_at timestamp").coalesce(1).write.mode("append").parquet(bronze)
    layers = [
        ER.Layer("market", "rollup", market, width="1 hour", keys=(), source="store"), ER.Layer("store", "table", store),
        ER.Layer("log", "lines", log), ER.Layer("bronze", "payloads", bronze)]
    subjects = spark.createDataFrame([("b",), ("b",)], "asset_id string")
    report = {r.layer: r.rows_removed for r in ER.erase_everywhere(
        spark, layers, subjects, "r1", "2026-07-02 00:00:00", audit).collect()}
    assert report == {"market": 51, "store": 101, "log": 1, "bronze": 2}
    left = ticks.where("asset_id <> 'b'")
    assert spark.read.parquet(store).where("asset_id = 'b'").count() == 0
    key = lambda df: sorted(tuple(r) for r in df.select("bucket", "open", "high", "low", "close", "ticks").collect())
    assert key(spark.read.parquet(market)) == key(C.candles(left, "1 hour", keys=()))
    assert sorted(r.value for r in spark.read.text(log).collect()) == sorted(
        [json.dumps({"asset_id": n, "v": 1}) for n in "ac"] + ["not json"] * 3)
    kept = {r.ingested_at: r.payload for r in spark.read.parquet(bronze).collect()}
    assert kept[at(1)] == "{}" and kept[at(2)] == '{"a": 1}' and kept[at(3)] == "{" and kept[at(4)] is None
    assert '"k\\"q":{"usd":1.25}' in kept[at(0)].replace(" ", "") and '"b"' not in kept[at(0)] and '"c":null' in kept[at(0)]
    again = ER.erase_everywhere(spark, layers, subjects, "r2", "2026-07-03 00:00:00", audit)
    assert {r.layer: r.rows_removed for r in again.collect()} == {"market": 0, "store": 0, "log": 0, "bronze": 0}
    assert spark.read.parquet(audit).count() == 8


@pytest.mark.parametrize("moved", [0, 1])
def test_an_erasure_that_died_among_its_files_is_finished(spark, tmp_path, monkeypatch, moved):
    log = str(tmp_path / "log")
    lines = [json.dumps({"asset_id": n, "v": i}) for i in range(20) for n in "abc"]
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(4).write.text(log)
    layer, subjects = ER.Layer("log", "lines", log), spark.createDataFrame([("b",)], "asset_id string")
    finish = ER._finish

    def dying(spark, path):
        fs, done = S._fs(spark, f"{path}/{ER.JOURNAL}/_SUCCESS")
        if not fs.exists(done):
            return finish(spark, path)
        staged = spark.read.parquet(f"{path}/{ER.JOURNAL}").first()["staging"]
        names = [st.getPath() for st in fs.listStatus(S._fs(spark, staged)[1]) if st.getPath().getName().startswith("part-")]
        for p in names[:moved]:
            fs.rename(p, S._fs(spark, f"{path}/{p.getName()}")[1])
        raise RuntimeError("driver lost")

    monkeypatch.setattr(ER, "_finish", dying)
    with pytest.raises(RuntimeError):
        ER._erase_files(spark, layer, subjects)
    monkeypatch.setattr(ER, "_finish", finish)
    ER._erase_files(spark, layer, subjects)
    assert sorted(r.value for r in spark.read.text(log).collect()) == sorted(x for x in lines if '"b"' not in x)
    assert not ER._left(spark, layer, subjects)
