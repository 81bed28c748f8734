"""Trailing-window detector: the reference's scenarios, edge cases, and a
randomized comparison with the sequential model."""

from __future__ import annotations

import random

import pytest
from conftest import at, make_ticks, model_for_rows

from tidemark.operators.alerts import late_ticks, multi_window_alerts, trailing_alerts, zscore_alerts


def run(spark, rows, window_s=300, threshold=0.02, warmup_s=0, bucket_s="auto"):
    df = trailing_alerts(make_ticks(spark, rows), window_s, threshold, warmup_s, bucket_s=bucket_s)
    return sorted((r.metric, r.value, r.baseline, r.samples, r.ts) for r in df.collect())


def test_first_tick_never_alerts(spark):
    assert run(spark, [(0, 100.0)]) == []


def test_within_threshold(spark):
    assert run(spark, [(0, 100.0), (1, 101.0)]) == []


def test_price_spike(spark):
    rows = [(s, 100.0) for s in range(16)] + [(16, 105.0)]
    out = run(spark, rows, warmup_s=10)
    assert len(out) == 1
    metric, value, base, n, _ = out[0]
    assert (metric, value, n) == ("price", 105.0, 16)
    assert abs(base - 100.0) < 1e-9


def test_volume_spike_alone(spark):
    rows = [(s, 100.0, 1000.0) for s in range(16)] + [(16, 100.0, 1050.0)]
    assert [r[0] for r in run(spark, rows, warmup_s=10)] == ["volume"]


def test_warmup_suppresses(spark):
    assert run(spark, [(0, 100.0), (5, 200.0)], warmup_s=30) == []


def test_eviction(spark):
    rows = [(s, 200.0) for s in (0, 1, 2)] + [(s, 100.0) for s in (11, 12, 13)] + [(14, 105.0)]
    out = [r for r in run(spark, rows, window_s=10) if r[4] == at(14)]
    assert len(out) == 1 and abs(out[0][2] - 100.0) < 1e-9
    # ticks 11 and 12 still see 200-valued samples (inclusive lower edge)
    all_out = run(spark, rows, window_s=10)
    assert {r[4] for r in all_out} == {at(11), at(12), at(14)}
    assert [r[2] for r in all_out if r[4] == at(12)] == [150.0]


def test_isolation(spark):
    out = run(spark, [(0, 50.0), (1, 150.0)])
    assert len(out) == 1 and out[0][2] == 50.0


def test_exactly_threshold_does_not_fire(spark):
    # 0.5 -> 0.75 is +50%, exact in binary
    assert run(spark, [(0, 0.5), (1, 0.75)], threshold=0.5) == []
    assert len(run(spark, [(0, 0.5), (1, 0.75)], threshold=0.49)) == 1


def test_sample_at_cutoff_counts(spark):
    out = run(spark, [(0, 100.0), (10, 200.0)], window_s=10)
    assert len(out) == 1 and out[0][3] == 1
    assert run(spark, [(0, 100.0), (11, 200.0)], window_s=10) == []


def test_span_exactly_warmup(spark):
    assert len(run(spark, [(0, 100.0), (30, 200.0)], warmup_s=30)) == 1


def test_ties_on_ts_count_earlier_arrivals(spark):
    # three polls with one frozen source ts: the 2nd sees the 1st, the 3rd sees both
    rows = [(0, 100.0, 1000.0, "a", 0), (1, 300.0, 1000.0, "a", 0), (2, 100.0, 1000.0, "a", 0)]
    out = run(spark, rows)
    assert sorted((r[0], r[2], r[3]) for r in out) == [("price", 100.0, 1), ("price", 200.0, 2)]


def test_null_volume_inside_window(spark):
    rows = [(0, 100.0, None), (1, 100.0, 1000.0), (2, 100.0, 2000.0)]
    out = run(spark, rows)
    assert out == [("volume", 2000.0, 1000.0, 2, at(2))]


def test_zero_baseline_never_alerts(spark):
    assert run(spark, [(0, 0.0, 0.0), (1, 5.0, 5.0)]) == []


def test_silence_longer_than_window_restarts_warmup(spark):
    rows = [(0, 100.0), (40, 100.0), (400, 300.0)]
    assert run(spark, rows, warmup_s=30) == []


def test_window_shorter_than_warmup_never_alerts(spark):
    rows = [(s, 100.0 if s < 50 else 500.0) for s in range(60)]
    assert run(spark, rows, window_s=10, warmup_s=30) == []


def _random_rows(seed, n=400, assets=3):
    rnd = random.Random(seed)
    rows, sec, ts = [], 0, 0
    for _ in range(n):
        sec += rnd.choice([1, 1, 2, 5, 30])
        # frozen source times give ties; ts never decreases in arrival order
        ts = max(ts, sec - sec % rnd.choice([1, 10, 60]))
        for a in range(assets):
            vol = None if rnd.random() < 0.1 else rnd.uniform(900, 1100)
            rows.append((sec, round(rnd.uniform(90, 110), 2), vol, f"asset{a}", ts))
    return rows


def _model(rows, window_s, threshold, warmup_s):
    return model_for_rows(rows, window_s, threshold, warmup_s)


@pytest.mark.parametrize("bucket_s", ["auto", None, 120])
def test_random_against_sequential_model(spark, bucket_s):
    rows = _random_rows(7)
    want = _model(rows, 60, 0.05, 10)
    df = trailing_alerts(make_ticks(spark, rows), 60, 0.05, 10, bucket_s=bucket_s)
    got = [(r.asset_id, r.metric, r.value, r.baseline, r.change_pct, r.samples, r.ts)
           for r in df.collect()]
    assert len(got) == len(want) > 20
    key = lambda r: (r[0], r[6], r[1], r[2])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:3] == w[:3] and g[5:] == w[5:]
        assert g[3] == pytest.approx(w[3], rel=1e-12)


def test_multi_window_equals_single_windows(spark):
    rows = _random_rows(11, n=200)
    ticks = make_ticks(spark, rows)
    multi = {tuple(r) for r in multi_window_alerts(ticks, (30, 90), 0.05, 10).collect()}
    single = set()
    for w in (30, 90):
        single |= {tuple(r) for r in trailing_alerts(ticks, w, 0.05, 10).collect()}
    assert multi == single


def test_zscore_against_model(spark):
    rows = _random_rows(3, n=150, assets=2)
    k = 1.5
    got = {(r.asset_id, r.metric, r.ts, r.samples) for r in
           zscore_alerts(make_ticks(spark, rows), 60, k, 10, bucket_s=None).collect()}
    want = set()
    samples = {}
    for sec, price, vol, asset, ts in sorted(rows, key=lambda r: (r[0], r[3])):
        t = at(ts)
        buf = [s for s in samples.get(asset, []) if s[0] >= t - (at(60) - at(0))]
        samples[asset] = buf
        if buf and t - buf[0][0] >= at(10) - at(0):
            for metric, idx, v in (("price", 1, price), ("volume", 2, vol)):
                vals = [s[idx] for s in buf if s[idx] is not None]
                if v is None or not vals:
                    continue
                m = sum(vals) / len(vals)
                sd = (sum((x - m) ** 2 for x in vals) / len(vals)) ** 0.5
                if sd > 1e-9 and abs(v - m) > k * sd:
                    want.add((asset, metric, t, len(buf)))
        buf.append((t, price, vol))
    assert got == want and len(want) > 5


def test_late_ticks(spark):
    # arrival 0..4; source ts goes 10, 20, 15 (late), 25, 5 (late)
    rows = [(0, 1.0, 1.0, "a", 10), (1, 1.0, 1.0, "a", 20), (2, 1.0, 1.0, "a", 15),
            (3, 1.0, 1.0, "a", 25), (4, 1.0, 1.0, "a", 5), (5, 1.0, 1.0, "b", 1)]
    out = sorted((r.ts, r.lag_s) for r in late_ticks(make_ticks(spark, rows)).collect())
    assert out == [(at(5), 20.0), (at(15), 5.0)]


@pytest.mark.parametrize("warmup_s", [0, 10, 90])
def test_buckets_do_not_change_the_result(spark, warmup_s):
    rows = _random_rows(21, n=300)
    ticks = make_ticks(spark, rows)
    want = _model(rows, 60, 0.05, warmup_s)
    key = lambda r: (r[0], r[6], r[1], r[2])
    for bucket in (60, 600, None):
        got = [(r.asset_id, r.metric, r.value, r.baseline, r.change_pct, r.samples, r.ts) for r in
               trailing_alerts(ticks, 60, 0.05, warmup_s, bucket_s=bucket).collect()]
        assert len(got) == len(want)
        for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
            assert g[:3] == w[:3] and g[5:] == w[5:]
            assert g[3] == pytest.approx(w[3], rel=1e-12)


@pytest.mark.parametrize("odd", [1e17, float("inf"), float("nan"), -1e300])
@pytest.mark.parametrize("bucket", ["auto", 60, None])
def test_an_evicted_reading_leaves_nothing_behind(spark, odd, bucket):
    rows = [(0, odd)] + [(s, 100.0 + s % 3 * 0.1) for s in range(100, 400, 5)]
    out = trailing_alerts(make_ticks(spark, rows), 60, 0.02, 0, bucket_s=bucket)
    assert out.count() == 0


def test_zscore_after_a_level_shift(spark):
    rows = [(0, 1.0)] + [(100 + s, 60000 + (0.3 if s % 2 else -0.3)) for s in range(60)] + [(160, 60010.0)]
    out = zscore_alerts(make_ticks(spark, rows), 60, 20.0, 0, metrics=["price"]).collect()
    assert [(r.value, round(r.zscore, 1)) for r in out] == [(60010.0, 33.3)]


def test_a_constant_window_has_no_zscore(spark):
    rows = [(s, 0.1) for s in range(130)] + [(130, 5.0)]
    assert zscore_alerts(make_ticks(spark, rows), 60, 1.0, 0, metrics=["price"]).count() == 0
