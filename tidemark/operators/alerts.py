"""Trailing-window deviation alerts (batch, event-time order).

Semantics of one tick ``x`` of one key (the sequential detector's rule):

* the window holds every earlier reading ``p`` with ``p.ts >= x.ts - window``
  (lower edge inclusive); readings with the same ``ts`` that arrived earlier
  count, the tick itself and later arrivals do not;
* ready when the window holds at least one reading and
  ``x.ts - oldest.ts >= warmup`` (inclusive);
* baseline = mean of the metric over the window (nulls skipped, no values
  gives no baseline); ``change = (value - baseline) / baseline``; an alert
  fires when ``|change| > threshold`` (exactly the threshold does not) and
  never on a null or zero baseline;
* ``samples`` counts every reading in the window, also those whose metric is
  null; NaN is a missing value like null, here as in the streaming detector.

Plan (no join, one exchange):

* time is cut into blocks as wide as the window, so a window is the tail of
  the previous block and the head of its own. Heads are running aggregates;
  the tail is a running aggregate from the block's end, looked up at the last
  evicted reading. Values are only ever added, so a reading that has left the
  window, however large or infinite, leaves nothing behind, and the work is
  O(rows). Counts are differences of running integer counts.
* time is also cut into buckets, those of each window as wide as the window
  itself (an hour at least, or ``bucket_s``), and each row is copied into the
  next bucket when its window reaches it (a halo of about ``window / bucket``
  of the rows). Windows then partition by ``(key, window, bucket)``, so a task
  holds the ticks of two windows of a key at most per group, however many ticks
  the key has; only rows of their home bucket are kept.
* the exchange carries a row per tick, window and bucket, in more partitions
  than the session's when the input's size asks for it, as AQE would merge them
  by their compressed size, a small part of what the sorts hold.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import micros, partitions_for

# Reference detector defaults: 300 s window, 2 % threshold, 30 s warm-up.
DEFAULT_WINDOW_S = 300
DEFAULT_THRESHOLD = 0.02
DEFAULT_WARMUP_S = 30
# metric name -> tick column; price first, so a price alert precedes a volume alert
DEFAULT_METRICS = {"price": "price", "volume": "volume_24h"}

_US = 1_000_000
_PART_BYTES = 6 * 1024 * 1024  # of stored ticks and their copies, for a task


def auto_bucket_s(window_s: int) -> int:
    """Halo bucket width: the window, at least one hour."""
    return max(int(window_s), 3600)


def _metric_map(metrics) -> dict[str, str]:
    if isinstance(metrics, Mapping):
        return dict(metrics)
    out = {}
    for m in metrics:
        out[m] = DEFAULT_METRICS.get(m, m)
    return out


def trailing_stats(ticks: DataFrame, windows_s: Sequence[int], columns: Sequence[str],
                   keys: Sequence[str] = ("asset_id",), time: str = "ts",
                   arrival: Sequence[str] = ("ingested_at",), bucket_s: int | str | None = "auto",
                   moments: bool = False, warmup_s: int = 0, age: str | None = None) -> DataFrame:
    """Per tick and window: sum and non-null count (and moments) of each
    column over the trailing window, ``samples`` and readiness.

    Output columns (``c`` = column), one row per tick and window: ``_t``
    (micros of ``time``), ``_w`` window seconds, ``_x_c`` the tick's own value
    (NaN is a missing value like null), ``_n`` samples, ``_rdy`` ready flag,
    ``_s_c`` sum, ``_k_c`` count, and with ``moments`` ``_m_c`` (mean) and
    ``_v_c`` (sum of squared deviations). ``time`` cuts the windows and must
    order the ticks; ``age`` (the same column unless given) tells how old the
    window's first reading is.
    """
    windows = sorted({int(w) for w in windows_s})
    wmax = windows[-1]
    if bucket_s == "auto":
        bucket_s = auto_bucket_s(wmax)
    numbers = {c: F.col(c).cast(T.DoubleType()) for c in columns}
    df = ticks.withColumns({
        "_t": micros(time), "_age": micros(age or time),
        **{f"_x_{c}": F.when(~F.isnan(v), v) for c, v in numbers.items()}})
    pk = [*keys, *(["_w"] if windows[1:] else [])]
    origin = F.lit(0)
    if bucket_s and bucket_s != "auto" and int(bucket_s) < wmax:
        raise ValueError("bucket_s must be at least the largest window")
    widths = {w: (auto_bucket_s(w) if bucket_s == "auto" else int(bucket_s)) for w in windows} if bucket_s else {}
    df = df.withColumn("_w", F.explode(F.array(*map(F.lit, windows))) if windows[1:] else F.lit(windows[0]))
    if widths:
        b_us = F.lit(widths[wmax] * _US)
        for w in windows[:-1]:
            b_us = F.when(F.col("_w") == w, F.lit(widths[w] * _US)).otherwise(b_us)
        df = df.withColumn("_home", F.floor(F.col("_t") / b_us))
        reach = F.floor((F.col("_t") + F.col("_w").cast("long") * _US) / b_us)
        df = df.withColumn("_bk", F.explode(F.when(reach != F.col("_home"), F.array(F.col("_home"), reach))
                                             .otherwise(F.array(F.col("_home")))))
        pk = pk + ["_bk"]
        origin = F.col("_bk") * b_us

    # Hash on (key, window, bucket) satisfies every window distribution below: one exchange.
    copies = (2 if widths else 1) * len(windows)
    df = df.repartition(partitions_for(ticks, _PART_BYTES // copies), *pk)
    out = None
    groups = _one_scale(windows, max(widths.values()) if widths else None)
    for some in groups:
        own = df.where(F.col("_w").isin(some)) if groups[1:] else df
        part = _block_stats(own, pk, some, columns, arrival, moments, int(warmup_s) * _US, origin)
        out = part if out is None else out.unionByName(part)
    if widths:
        out = out.where(F.col("_bk") == F.col("_home")).drop("_bk", "_home")
    return out.drop("_age")


def _one_scale(windows: list[int], bucket_s: int | None) -> list[list[int]]:
    """The windows in groups that share their sorts: times are stretched until
    all windows are as wide as their common multiple, which must fit a long."""
    span = 2 * bucket_s * _US if bucket_s else 8 * 10**15  # of times from the bucket's start; else to the year 2223
    if span * (math.lcm(*windows) // windows[0]) < 2**63:
        return [windows]
    return [[w] for w in windows]


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def _block_stats(df, pk, windows, columns, arrival, moments, warm_us, origin):
    """Three sorts serve all windows: by block backwards, by block forwards and
    by (stretched) time; window functions of one order follow each other."""
    start, here = Window.unboundedPreceding, Window.currentRow
    wide = math.lcm(*windows)
    kept = df.columns
    df = df.withColumns({
        "_blk": F.expr(f"(_t - pmod(_t, _w * {_US}L)) div (_w * {_US}L)"),
        "_u": (F.col("_t") - origin) * F.expr(f"{wide}L div _w") if windows[1:] else F.col("_t")})
    block = Window.partitionBy(*pk, "_blk")
    ordered = block.orderBy("_t", *arrival)
    in_order = Window.partitionBy(*pk).orderBy("_blk", "_t", *arrival)
    # readings that have left: with times below those of the window
    gone = Window.partitionBy(*pk).orderBy("_u").rangeBetween(start, -(wide * _US + 1))

    def parts(over):
        """The aggregates of every column over one frame."""
        out = []
        for c in columns:
            v = F.col(f"_x_{c}")
            out += [F.count(v).over(over).alias(f"k_{c}"), _zero(F.sum(v).over(over)).alias(f"s_{c}")]
            if moments:
                out += [_zero(F.avg(v).over(over)).alias(f"m_{c}"),
                        _zero(F.var_pop(v).over(over) * F.count(v).over(over)).alias(f"v_{c}"),
                        F.min(v).over(over).alias(f"lo_{c}"), F.max(v).over(over).alias(f"hi_{c}")]
        return F.struct(*out)

    # all of the block's readings with a later time
    df = df.withColumn("_after", F.struct("_blk", parts(
        block.orderBy(F.col("_t").desc()).rangeBetween(start, -1)).alias("p")))
    df = (df.withColumn("_head", parts(ordered.rowsBetween(start, -1)))
            .withColumn("_all", F.struct("_blk", parts(ordered.rowsBetween(start, here)).alias("p"))))
    df = df.withColumns({
        "_un": F.count(F.lit(1)).over(in_order.rowsBetween(start, -1)),
        "_before": F.lag("_all").over(in_order),
        "_next": F.lead("_age").over(in_order),
        "_first": F.first("_age").over(in_order.rowsBetween(start, here))})
    df = df.withColumn("_before", F.first("_before").over(ordered.rowsBetween(start, here)))
    df = df.withColumns({
        "_gone": F.last("_after").over(gone),
        "_many": F.count(F.lit(1)).over(gone),
        # the reading behind the last one that left is the window's first
        "_oldest": F.max(F.struct("_un", "_next")).over(gone)})
    tail = (F.when(F.col("_gone._blk") == F.col("_blk") - 1, F.col("_gone.p"))
             .when(F.col("_before._blk") == F.col("_blk") - 1, F.col("_before.p")))
    df = df.withColumn("_tail", tail)
    oldest = F.when(F.col("_many") > 0, F.col("_oldest._next")).otherwise(F.col("_first"))
    samples = F.col("_un") - F.col("_many")
    new = {"_n": samples, "_rdy": (samples > 0) & (F.col("_age") - oldest >= warm_us)}
    for c in columns:
        ka, kb = F.col(f"_head.k_{c}"), F.coalesce(F.col(f"_tail.k_{c}"), F.lit(0))
        new[f"_k_{c}"] = ka + kb
        new[f"_s_{c}"] = F.col(f"_head.s_{c}") + _zero(F.col(f"_tail.s_{c}"))
        if moments:
            n = (ka + kb).cast(T.DoubleType())
            apart = F.when((ka > 0) & (kb > 0), F.col(f"_head.m_{c}") - F.col(f"_tail.m_{c}")).otherwise(F.lit(0.0))
            base = F.when(kb > 0, F.col(f"_tail.m_{c}")).otherwise(F.col(f"_head.m_{c}"))
            # equal readings deviate by nothing, whatever their mean rounds to
            lo = F.least(F.col(f"_head.lo_{c}"), F.col(f"_tail.lo_{c}"))
            same = lo == F.greatest(F.col(f"_head.hi_{c}"), F.col(f"_tail.hi_{c}"))
            new[f"_m_{c}"] = F.when(same, lo).otherwise(
                base + F.when(n > 0, apart * ka / n).otherwise(F.lit(0.0)))
            new[f"_v_{c}"] = F.when(same, F.lit(0.0)).otherwise(
                F.col(f"_head.v_{c}") + _zero(F.col(f"_tail.v_{c}"))
                + F.when(n > 0, apart * apart * ka * kb / n).otherwise(F.lit(0.0)))
    return df.withColumns(new).select(*kept, *new)


def trailing_alerts(ticks: DataFrame, window_s: int = DEFAULT_WINDOW_S,
                    threshold: float = DEFAULT_THRESHOLD, warmup_s: int = DEFAULT_WARMUP_S,
                    metrics=DEFAULT_METRICS, keys: Sequence[str] = ("asset_id",),
                    time: str = "ts", arrival: Sequence[str] = ("ingested_at",),
                    bucket_s: int | str | None = "auto") -> DataFrame:
    """Deviation alerts against the trailing-window mean.

    ``arrival`` orders readings sharing one ``ts`` and must be unique per key
    (the tick key ``(asset_id, ingested_at)``; deduplicate with
    ``insert_ignore`` first), otherwise the order among equal arrivals is
    undefined.

    Output: ``keys, metric, value, baseline, change_pct, threshold, window_s,
    samples, ts``. ``metrics`` maps an alert metric name to its column (any
    stored metric can be alerted on; a negative baseline flips the sign of
    ``change_pct``, as in the sequential rule).
    """
    return multi_window_alerts(ticks, (window_s,), threshold, warmup_s, metrics, keys,
                               time, arrival, bucket_s)


def multi_window_alerts(ticks: DataFrame, windows_s: Sequence[int] = (DEFAULT_WINDOW_S,),
                        threshold: float = DEFAULT_THRESHOLD, warmup_s: int = DEFAULT_WARMUP_S,
                        metrics=DEFAULT_METRICS, keys: Sequence[str] = ("asset_id",),
                        time: str = "ts", arrival: Sequence[str] = ("ingested_at",),
                        bucket_s: int | str | None = "auto") -> DataFrame:
    """The deviation rule for several windows in one pass: one exchange
    and three sorts, of a row per tick and window; long output distinguished
    by ``window_s``."""
    return _deviations(ticks, windows_s, threshold, warmup_s, metrics, keys, time, arrival, bucket_s)


def _deviations(ticks, windows_s, threshold, warmup_s, metrics, keys, time, arrival, bucket_s, clock=None):
    mm = _metric_map(metrics)
    cols = list(dict.fromkeys(mm.values()))
    stats = trailing_stats(ticks, windows_s, cols, keys, clock or time, arrival, bucket_s,
                           warmup_s=warmup_s, age=time)
    cands = []
    for name, c in mm.items():
        k = F.col(f"_k_{c}")
        base = F.when(k > 0, F.col(f"_s_{c}") / k)
        value = F.col(f"_x_{c}")
        change = F.when(base != 0, (value - base) / base)
        # an infinite baseline gives no change
        fire = F.col("_rdy") & value.isNotNull() & ~F.isnan(change) & (F.abs(change) > F.lit(float(threshold)))
        cands.append(F.struct(
            F.lit(name).alias("metric"), value.alias("value"), base.alias("baseline"),
            change.alias("change_pct"), fire.alias("fire")))
    exploded = stats.select(*keys, time, "_w", "_n", F.explode(F.array(*cands)).alias("_a"))
    return (exploded.where(F.col("_a.fire"))
            .select(*keys, F.col("_a.metric").alias("metric"), F.col("_a.value").alias("value"),
                    F.col("_a.baseline").alias("baseline"), F.col("_a.change_pct").alias("change_pct"),
                    F.lit(float(threshold)).alias("threshold"), F.col("_w").alias("window_s"),
                    F.col("_n").alias("samples"), F.col(time).alias("ts")))


def arrival_alerts(ticks: DataFrame, window_s: int = DEFAULT_WINDOW_S,
                   threshold: float = DEFAULT_THRESHOLD, warmup_s: int = DEFAULT_WARMUP_S,
                   metrics=DEFAULT_METRICS, keys: Sequence[str] = ("asset_id",),
                   time: str = "ts", arrival: Sequence[str] = ("ingested_at",),
                   bucket_s: int | str | None = "auto") -> DataFrame:
    """I3 over stored ticks: the arrival-order detector's alerts as a batch
    query, without per-key Python.

    The detector keeps readings as they arrive and only pops the first one,
    while it lies more than a window before the new tick. A reading behind
    another one in source time waits for it, and a late tick pops nothing that
    was still there; so a reading leaves exactly when the running maximum of
    source times first exceeds the maximum at the reading itself by more than a
    window. With that maximum as the clock, which never falls in arrival
    order, the window is a plain trailing one; only the warm-up looks at source
    times, the tick's and that of the window's first reading. The maximum is
    taken per (key, arrival day) and stitched by a per-day summary, so a hot
    key spreads over days and buckets; while a clock stands still (a source
    time far ahead of all others) the readings are one window, here as there.
    """
    clocked = _with_prior_max(ticks, keys, time, arrival).withColumn("_clock", F.greatest("_prior", time))
    return _deviations(clocked, (window_s,), threshold, warmup_s, metrics, keys, time, arrival, bucket_s, "_clock")


def zscore_alerts(ticks: DataFrame, window_s: int = DEFAULT_WINDOW_S, k: float = 3.0,
                  warmup_s: int = DEFAULT_WARMUP_S, metrics=DEFAULT_METRICS,
                  keys: Sequence[str] = ("asset_id",), time: str = "ts",
                  arrival: Sequence[str] = ("ingested_at",),
                  bucket_s: int | str | None = "auto") -> DataFrame:
    """E7 (our definition): over the same window samples, alert when
    ``|value - mean| > k * stddev_pop``; a zero deviation never alerts.

    Means and squared deviations of a window's two parts are merged pairwise,
    so a level that left the window takes no precision with it. Output:
    ``keys, metric, value, mean, stddev, zscore, k, window_s, samples, ts``.
    """
    mm = _metric_map(metrics)
    cols = list(dict.fromkeys(mm.values()))
    w = int(window_s)
    stats = trailing_stats(ticks, (w,), cols, keys, time, arrival, bucket_s, moments=True,
                           warmup_s=warmup_s)
    ready = F.col("_rdy")
    cands = []
    for name, c in mm.items():
        n = F.col(f"_k_{c}").cast(T.DoubleType())
        mean = F.col(f"_m_{c}")
        sd = F.when(n > 0, F.sqrt(F.col(f"_v_{c}") / n)).otherwise(F.lit(0.0))
        value = F.col(f"_x_{c}")
        dev = value - mean
        ok = ready & value.isNotNull() & (n > 0) & (sd > 0) & ~F.isnan(sd)
        fire = ok & (F.abs(dev) > F.lit(float(k)) * sd)
        cands.append(F.struct(
            F.lit(name).alias("metric"), value.alias("value"),
            F.when(n > 0, mean).alias("mean"), F.when(n > 0, sd).alias("stddev"),
            F.when(ok, dev / sd).alias("zscore"), F.col("_n").alias("samples"),
            fire.alias("fire")))
    exploded = stats.select(*keys, time, F.explode(F.array(*cands)).alias("_a"))
    return (exploded.where(F.col("_a.fire"))
            .select(*keys, F.col("_a.metric").alias("metric"), F.col("_a.value").alias("value"),
                    F.col("_a.mean").alias("mean"), F.col("_a.stddev").alias("stddev"),
                    F.col("_a.zscore").alias("zscore"), F.lit(float(k)).alias("k"),
                    F.lit(w).alias("window_s"), F.col("_a.samples").alias("samples"),
                    F.col(time).alias("ts")))


def late_ticks(ticks: DataFrame, keys: Sequence[str] = ("asset_id",), time: str = "ts",
               arrival: Sequence[str] = ("ingested_at",), day_col: str | None = None) -> DataFrame:
    """Ticks whose source time is below the running maximum of earlier
    arrivals of the same key; these are where arrival-order (streaming) and
    event-time (batch) detection can differ.

    The running maximum needs unbounded look-back, so it is computed inside
    ``(key, arrival day)`` and stitched with the maxima of all earlier days of
    the key, taken from a small per-day summary (keys x days rows) joined back
    on ``(key, day)``: no task ever holds a whole key.
    Output: the tick columns plus ``prior_max_ts`` and ``lag_s``.
    """
    prior = _with_prior_max(ticks, keys, time, arrival, day_col).withColumnRenamed("_prior", "prior_max_ts")
    out = prior.where(F.col(time) < F.col("prior_max_ts"))
    return out.withColumn("lag_s", (micros("prior_max_ts") - micros(time)) / F.lit(float(_US)))


def _with_prior_max(ticks: DataFrame, keys: Sequence[str], time: str, arrival: Sequence[str],
                    day_col: str | None = None) -> DataFrame:
    """``ticks`` with ``_prior``, the largest ``time`` of the key's earlier arrivals."""
    df = ticks.withColumn("_day", F.to_date(F.col(day_col or arrival[0])))
    day_max = df.groupBy(*keys, "_day").agg(F.max(time).alias("_dmax"))
    before = (Window.partitionBy(*keys).orderBy("_day")
              .rowsBetween(Window.unboundedPreceding, -1))
    carry = day_max.select(*keys, "_day", F.max("_dmax").over(before).alias("_carry"))
    within = (Window.partitionBy(*keys, "_day").orderBy(*arrival)
              .rowsBetween(Window.unboundedPreceding, -1))
    joined = df.join(carry, [*keys, "_day"], "left")
    prior = F.greatest(F.max(time).over(within), F.col("_carry"))
    return joined.withColumn("_prior", prior).drop("_day", "_carry")
