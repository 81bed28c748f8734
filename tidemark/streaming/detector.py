"""Streaming trailing-window alerts.

One state per key, updated tick by tick in ARRIVAL order, alerting on the
deviating tick at once; nothing is read back from storage. Each micro-batch
group is sorted by the arrival columns (order inside a group is not
guaranteed by Spark). Late ticks are neither dropped nor reordered: the
samples stay in arrival order and eviction pops only from the head, exactly
like the sequential detector, so an old sample behind a newer one survives
until the head leaves.

A window's sum is that of an older half, kept as running sums from its end
back to every reading, and of a younger half, a running total; when the older
half is used up, the younger one becomes it. So a tick costs O(1) on average,
and as sums only ever grow by addition, a huge or infinite reading leaves no
trace once it is evicted.

State per key is the window's samples, about ``window_s x rate`` entries
(300 at one tick per second). With a checkpoint location the state survives
restarts (the reference loses it and warms up again).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators.alerts import (
    DEFAULT_METRICS,
    DEFAULT_THRESHOLD,
    DEFAULT_WARMUP_S,
    DEFAULT_WINDOW_S,
    _metric_map,
)

_US = 1_000_000


def _state_schema(cols: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField("ts", T.ArrayType(T.LongType()))] + [
        T.StructField(f"v{i}", T.ArrayType(T.DoubleType())) for i in range(len(cols))])


def _out_schema(key: str) -> T.StructType:
    return T.StructType([
        T.StructField(key, T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("baseline", T.DoubleType()),
        T.StructField("change_pct", T.DoubleType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("window_s", T.IntegerType()),
        T.StructField("samples", T.LongType()),
        T.StructField("ts", T.TimestampType()),
    ])


def _from_the_end(values: list) -> tuple[list, list]:
    """Sum and count of the values from each place to the end, nulls left out;
    one place more than there are values, for nothing left."""
    sums = list(accumulate((x if x is not None else 0.0 for x in reversed(values)), initial=0.0))
    counts = list(accumulate((x is not None for x in reversed(values)), initial=0))
    return sums[::-1], counts[::-1]


def make_step(window_s: int, threshold: float, warmup_s: int, metrics: dict[str, str],
              key: str, arrival: Sequence[str], time: str = "ts"):
    """The per-key state function (also usable on plain pandas frames in tests)."""
    import pandas as pd

    cols = list(dict.fromkeys(metrics.values()))
    names = list(metrics.items())
    w_us, warm_us = int(window_s) * _US, int(warmup_s) * _US
    out_cols = [f.name for f in _out_schema(key).fields]

    def step(k: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            st = state.get
            ts = list(st[0])
            vals = [list(v) for v in st[1:]]
        else:
            ts, vals = [], [[] for _ in cols]
        frames = [p for p in pdfs if len(p)]
        out = []
        if frames:
            pdf = pd.concat(frames).sort_values(list(arrival), kind="stable")
            t_us = (pd.to_datetime(pdf[time]).astype("int64") // 1000).tolist()
            # NaN -> None once per batch, so the loop only tests identity
            cur = [pdf[c].astype(object).where(pdf[c].notna(), None).tolist() for c in cols]
            idx = [(name, cols.index(c)) for name, c in names]
            tvals = pdf[time].tolist()
            head, first, mid = 0, 0, 0  # the older half is first..mid, less what left
            older, younger = [], []

            def turn():
                """All readings become the older half."""
                nonlocal first, mid, older, younger
                first, mid = head, len(ts)
                older = [_from_the_end(v[head:]) for v in vals]
                younger = [(0.0, 0)] * len(cols)

            turn()
            for i, t in enumerate(t_us):
                cutoff = t - w_us
                while head < len(ts) and ts[head] < cutoff:
                    head += 1
                if head > mid:
                    turn()
                n = len(ts) - head
                if n > 0 and t - ts[head] >= warm_us:
                    for name, j in idx:
                        v = cur[j][i]
                        if v is None:
                            continue
                        total, count = older[j][0][head - first] + younger[j][0], older[j][1][head - first] + younger[j][1]
                        if not count:
                            continue
                        base = total / count
                        if base == 0:
                            continue
                        ch = (v - base) / base
                        if abs(ch) > threshold:
                            out.append((k[0], name, float(v), base, ch, float(threshold),
                                        int(window_s), n, tvals[i]))
                ts.append(t)
                for j in range(len(cols)):
                    v = cur[j][i]
                    vals[j].append(v)
                    if v is not None:
                        younger[j] = younger[j][0] + v, younger[j][1] + 1
            ts, vals = ts[head:], [v[head:] for v in vals]
            state.update(tuple([ts] + vals))
        yield pd.DataFrame(out, columns=out_cols)

    return step


def stream_alerts(ticks: DataFrame, window_s: int = DEFAULT_WINDOW_S,
                  threshold: float = DEFAULT_THRESHOLD, warmup_s: int = DEFAULT_WARMUP_S,
                  metrics=DEFAULT_METRICS, key: str = "asset_id",
                  arrival: Sequence[str] = ("ingested_at",)) -> DataFrame:
    """Streaming deviation alerts (same output columns as the batch
    operator), for streaming DataFrames. The arrival-order result over a
    stored table is this job run over its files with ``availableNow`` and a
    bounded ``maxFilesPerTrigger``."""
    mm = _metric_map(metrics)
    cols = list(dict.fromkeys(mm.values()))
    need = list(dict.fromkeys([key, "ts", *arrival, *cols]))
    step = make_step(window_s, threshold, warmup_s, mm, key, arrival)
    return (ticks.select(*need).groupBy(key)
                 .applyInPandasWithState(step, _out_schema(key), _state_schema(cols), "append",
                                         GroupStateTimeout.NoTimeout))
