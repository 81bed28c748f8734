"""Payload parsing (A2-A4, B1-B3), markets (A3), contract (L9), formatting."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from conftest import make_ticks
from pyspark.sql import types as T

from tidemark.functions.formatting import alert_json, alert_text
from tidemark.operators.alerts import trailing_alerts
from tidemark.sources.payloads import (
    contract,
    market_rejects,
    parse_markets,
    parse_prices,
    price_rejects,
    schema_changes,
    unpriced,
)

POLL = datetime(2026, 6, 9, 23, 0, 0)

PRICES = {
    "alpha": {"usd": 51234, "usd_market_cap": 1.5e12, "usd_24h_vol": 3.25e10,
              "usd_24h_change": -1.5, "last_updated_at": 1781046600},
    "beta": {"usd": 1234.5, "usd_market_cap": 2.0e11, "usd_24h_vol": 1.1e10,
             "usd_24h_change": 2.25, "last_updated_at": 1781046601},
    "gamma": {"usd": 0, "usd_24h_vol": None},
}


def payloads(spark, *bodies, at=POLL):
    return spark.createDataFrame([(json.dumps(b), at) for b in bodies], "payload string, ingested_at timestamp")


def ticks_of(spark, *bodies):
    return {r.asset_id: r for r in parse_prices(payloads(spark, *bodies)).collect()}


def test_all_assets_mapped(spark):
    t = ticks_of(spark, PRICES)
    assert set(t) == {"alpha", "beta", "gamma"}
    a = t["alpha"]
    assert (a.price, a.volume_24h, a.market_cap, a.change_24h) == (51234.0, 3.25e10, 1.5e12, -1.5)
    assert t["gamma"].price == 0.0  # price 0 is kept


def test_source_timestamp_used(spark):
    t = ticks_of(spark, PRICES)
    want = datetime.fromtimestamp(1781046600, tz=UTC).replace(tzinfo=None)
    assert t["alpha"].ts == want and t["alpha"].ingested_at == POLL


def test_fallback_to_poll_time_and_null_volume(spark):
    t = ticks_of(spark, {"alpha": {"usd": 100.0}})
    assert t["alpha"].ts == POLL and t["alpha"].volume_24h is None


def test_missing_currency_skipped(spark):
    assert ticks_of(spark, {"alpha": {"eur": 100.0}}) == {}
    miss = unpriced(payloads(spark, {"alpha": {"eur": 100.0}, "beta": {"usd": None}})).collect()
    assert sorted(r.asset_id for r in miss) == ["alpha", "beta"]


def test_other_currency(spark):
    t = {r.asset_id: r for r in parse_prices(payloads(spark, {"alpha": {"eur": 7.5, "eur_24h_vol": 3}}),
                                              vs="eur").collect()}
    assert t["alpha"].price == 7.5 and t["alpha"].volume_24h == 3.0


def test_malformed_number_only_loses_its_asset(spark):
    body = {"alpha": {"usd": "n/a"}, "beta": {"usd": 2.0}}
    assert set(ticks_of(spark, body)) == {"beta"}
    rej = price_rejects(payloads(spark, body)).collect()
    assert [(r.asset_id, r.reason) for r in rej] == [("alpha", "malformed number")]
    strict = parse_prices(payloads(spark, body), strict=True).collect()
    assert strict == []


def test_unreadable_and_empty_payloads(spark):
    df = spark.createDataFrame([("{not json", POLL), ("{}", POLL)], "payload string, ingested_at timestamp")
    assert parse_prices(df).count() == 0
    assert [r.reason for r in price_rejects(df).collect()] == ["unreadable payload"]


def test_markets_null_max_supply_and_missing_required(spark):
    body = [{"id": "alpha", "symbol": "a", "name": "Alpha", "image": "img/a.png", "max_supply": 21000000.0},
            {"id": "beta", "symbol": "b", "name": "Beta", "image": None, "max_supply": None},
            {"id": "gamma", "name": "Gamma"}]
    df = spark.createDataFrame([(json.dumps(body), POLL)], "payload string, ingested_at timestamp")
    got = {r.id: r for r in parse_markets(df).collect()}
    assert set(got) == {"alpha", "beta"}
    assert got["beta"].max_supply is None and got["alpha"].max_supply == 21000000.0
    assert [r.reasons for r in market_rejects(df).collect()] == [["missing symbol"]]


def test_contract_and_schema_changes(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.DoubleType())])
    df = spark.createDataFrame([(1, '{"id": 1, "v": 2.5}'), (2, '{"id": 2, "v": "x"}'), (3, "oops")],
                               "rid int, payload string")
    good, bad = contract(df, schema)
    assert [r.rid for r in good.collect()] == [1]
    assert sorted(r.rid for r in bad.collect()) == [2, 3]
    newer = T.StructType(schema.fields + [T.StructField("w", T.StringType(), True)])
    assert schema_changes(schema, newer) == []
    assert schema_changes(newer, schema) == ["removed w"]
    retyped = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.DoubleType())])
    assert schema_changes(schema, retyped) == ["retyped id: bigint -> string"]


def test_alert_json_and_text(spark):
    rows = [(s, 100.0) for s in range(16)] + [(16, 105.0)]
    alerts = trailing_alerts(make_ticks(spark, rows), 300, 0.02, 10)
    rec = json.loads(alert_json(alerts).collect()[0].value)
    assert rec == {"asset_id": "bitcoin", "metric": "price", "value": 105.0, "baseline": 100.0,
                   "change_pct": 0.05, "threshold": 0.02, "window_s": 300, "samples": 16,
                   "ts": "2026-06-09T12:00:16+00:00"}
    line = alert_text(alerts).collect()[0].value
    assert line == "ALERT ▲ bitcoin price +5.00% vs 5m avg (value=105, baseline=100, n=16)"
    down = trailing_alerts(make_ticks(spark, [(0, 61728.0), (1, 50000.0)]), 300, 0.02, 0)
    assert alert_text(down).collect()[0].value == \
        "ALERT ▼ bitcoin price -19.00% vs 5m avg (value=5e+04, baseline=6.173e+04, n=1)"


def test_from_bus_maps_kafka_shaped_records(spark):
    from tidemark.sources.payloads import from_bus
    body = json.dumps({"alpha": {"usd": 3.5}}).encode()
    recs = spark.createDataFrame([(b"k", bytearray(body), POLL)], "key binary, value binary, timestamp timestamp")
    t = parse_prices(from_bus(recs)).collect()
    assert [(r.asset_id, r.price, r.ingested_at) for r in t] == [("alpha", 3.5, POLL)]


def test_contract_requires_required_fields(spark):
    from pyspark.sql import types as T

    from tidemark.sources import payloads as P

    schema = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.StringType(), True)])
    rows = [(1, '{"a": 1}'), (2, "{}"), (3, '{"a": null, "b": "x"}'), (4, "not json"), (5, None), (6, '{"a": "x"}')]
    good, rejects = P.contract(spark.createDataFrame(rows, "i int, payload string"), schema)
    assert [r.i for r in good.collect()] == [1]
    assert {r.i: r.reason for r in rejects.collect()} == {
        2: "missing required field", 3: "missing required field", 4: "does not match contract",
        5: "does not match contract", 6: "does not match contract"}
    strict = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.StringType(), False)])
    assert P.schema_changes(schema, strict) == ["b became required"]


def test_markets_lose_nothing(spark):
    from datetime import datetime

    from tidemark.sources import payloads as P

    at_ = datetime(2024, 1, 1)
    rows = [("not json", at_), ("[]", at_), ('[{"id": "a", "symbol": "s", "name": "n", "max_supply": "n/a"},'
                                              '{"id": "b", "symbol": "s", "name": "n", "max_supply": 3}, {"id": "c"}]', at_)]
    df = spark.createDataFrame(rows, "payload string, ingested_at timestamp")
    assert sorted(r.id for r in P.parse_markets(df).collect()) == ["a", "b"]
    assert sorted(tuple(r.reasons) for r in P.market_rejects(df).collect()) == [
        ("malformed max_supply",), ("missing symbol", "missing name"), ("unreadable payload",)]


def test_a_stopped_feed_is_seen(spark):
    from tidemark.operators import quality as Q

    rows = [("x", f"2024-01-{d:02d} 0{h}:00:00") for d in range(1, 11) for h in range(3)]
    rows += [("y", f"2024-01-{d:02d} 00:00:00") for d in range(1, 21)]
    df = spark.createDataFrame(rows, "k string, t string").selectExpr("k", "cast(t AS timestamp) AS t")
    out = {(r.k, r.period.day): (r.n, r.anomaly) for r in Q.volume_anomaly(df, "t", by=["k"]).collect()}
    assert len(out) == 40 and out["x", 11] == (0, True) and out["x", 20][0] == 0
    later = Q.volume_anomaly(df, "t", by=["k"], now="2024-01-25 12:00:00")
    assert later.count() == 50


def test_cadence_reports_empty_periods(spark):
    from tidemark.operators import quality as Q

    rows = [("x", "2024-01-01 00:10:00"), ("x", "2024-01-01 03:10:00"), ("y", "2024-01-01 01:00:00")]
    df = spark.createDataFrame(rows, "asset_id string, t string").selectExpr(
        "asset_id", "cast(t AS timestamp) AS ts", "cast(t AS timestamp) AS ingested_at")
    out = {(r.asset_id, r.period_start.hour): (r.polls, r.coverage, r.stale_ratio) for r in Q.feed_cadence(df, 3600).collect()}
    assert out == {("x", 0): (1, 1.0, 0.0), ("x", 1): (0, 0.0, None), ("x", 2): (0, 0.0, None), ("x", 3): (1, 1.0, 0.0),
                   ("y", 1): (1, 1.0, 0.0), ("y", 2): (0, 0.0, None), ("y", 3): (0, 0.0, None)}


def test_no_machine_local_folder_on_a_cluster(monkeypatch):
    import pytest

    from tidemark import session

    class Conf(dict):
        get = dict.get

    class Cluster:
        conf = Conf({"spark.master": "yarn"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Cluster())
    Cluster.conf = Conf({"spark.master": "local-cluster[2,1,1024]"})
    with pytest.raises(RuntimeError):
        session.checkpoint_root(Cluster())
