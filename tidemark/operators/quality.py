"""Data tests and gates between layers.

Row rules compile to ONE aggregate pass (every rule is a ``count_if``);
uniqueness is its own ``groupBy(key)``; a quarantine splits rows into good
and rejected with the reasons of each reject. Semantics of the gates are our
definition (the reference only describes them).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import micros, width_micros


# ---------------------------------------------------------------------------
# Rules
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Rule:
    """One row rule. ``kind``: not_null, range, accepted, castable, matches."""

    kind: str
    column: str
    lo: float | None = None
    hi: float | None = None
    values: tuple = field(default_factory=tuple)
    type: str | None = None
    pattern: str | None = None
    max_rate: float = 0.0  # tolerated violation rate for the batch gate

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column}"

    def violated(self) -> Column:
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "range":
            bad = F.lit(False)
            if self.lo is not None:
                bad = bad | (c < F.lit(self.lo))
            if self.hi is not None:
                bad = bad | (c > F.lit(self.hi))
            return c.isNotNull() & bad
        if self.kind == "accepted":
            return c.isNotNull() & ~c.isin(list(self.values))
        if self.kind == "castable":
            return c.isNotNull() & c.try_cast(self.type).isNull()
        if self.kind == "matches":
            return c.isNotNull() & ~c.rlike(self.pattern)
        raise ValueError(f"unknown rule kind {self.kind!r}")


def not_null(col: str, max_rate: float = 0.0) -> Rule:
    return Rule("not_null", col, max_rate=max_rate)


def in_range(col: str, lo=None, hi=None, max_rate: float = 0.0) -> Rule:
    return Rule("range", col, lo=lo, hi=hi, max_rate=max_rate)


def accepted(col: str, values: Sequence, max_rate: float = 0.0) -> Rule:
    return Rule("accepted", col, values=tuple(values), max_rate=max_rate)


def castable(col: str, type_: str, max_rate: float = 0.0) -> Rule:
    return Rule("castable", col, type=type_, max_rate=max_rate)


def check(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One aggregate pass over ``df`` for all rules; long report
    ``(rule, column, violations, total, rate, passed)``."""
    aggs = [F.count(F.lit(1)).alias("_total")]
    aggs += [F.count_if(r.violated()).alias(f"_v{i}") for i, r in enumerate(rules)]
    wide = df.agg(*aggs)
    entries = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.column).alias("column"),
                 F.col(f"_v{i}").alias("violations"), F.lit(r.max_rate).alias("max_rate"))
        for i, r in enumerate(rules)])
    rate = F.when(F.col("total") > 0, F.col("violations") / F.col("total"))
    return (wide.select(F.col("_total").alias("total"), F.inline(entries))
                .select("rule", "column", "violations", "total", rate.alias("rate"),
                        (F.coalesce(rate, F.lit(0.0)) <= F.col("max_rate")).alias("passed")))


def unique_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """L6 uniqueness: keys occurring more than once, with their row count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """L8 row gate: ``(good, rejects)``; rejects carry ``reasons`` (array of
    rule names). The rule array is evaluated once per row."""
    reasons = F.array_compact(F.array(*[F.when(r.violated(), F.lit(r.name)) for r in rules]))
    tagged = df.withColumn("reasons", reasons)
    good = tagged.where(F.size("reasons") == 0).drop("reasons")
    return good, tagged.where(F.size("reasons") > 0)


class GateFailed(RuntimeError):
    pass


def gate(report: DataFrame) -> None:
    """L8 batch gate: raise when any rule of a (small) check report failed.
    The report is one row per rule, so reading it on the driver is bounded."""
    failed = [r.rule for r in report.where(~F.col("passed")).select("rule").collect()]
    if failed:
        raise GateFailed("failed rules: " + ", ".join(failed))


def freshness(df: DataFrame, time: str, now, max_age_s: float,
              by: Sequence[str] = ()) -> DataFrame:
    """Newest ``time`` per group against ``now``: ``(by..., newest, age_s, fresh)``."""
    n = F.lit(now).cast("timestamp")
    out = df.groupBy(*by).agg(F.max(time).alias("newest"))
    age = (micros(n) - micros("newest")) / F.lit(1e6)
    return out.select(*by, "newest", age.alias("age_s"), (age <= F.lit(float(max_age_s))).alias("fresh"))


def integrity(df: DataFrame, refs: Sequence[tuple[str, DataFrame, str]] = (),
              accepted_values: dict[str, Sequence] | None = None) -> DataFrame:
    """L10 silver-to-gold tests in one pass over ``df``: for each
    ``(column, parent, parent_key)`` the rows whose non-null value has no
    parent, and for each ``column -> values`` the rows outside the accepted
    set. Each parent contributes its distinct keys with a marker through a
    left join (size-checked broadcast); one aggregate counts everything.
    Report ``(test, column, violations)``."""
    from tidemark.functions.columns import broadcast_if_small

    tests: list[tuple[str, str, Column]] = []
    cols = list(dict.fromkeys([c for c, _, _ in refs] + list(accepted_values or {})))
    base = df.select(*cols)
    for i, (col, parent, pkey) in enumerate(refs):
        marker = f"_has_{i}"
        keys = parent.select(F.col(pkey).alias(col)).distinct().withColumn(marker, F.lit(True))
        base = base.join(broadcast_if_small(keys), col, "left")
        tests.append((f"references:{col}", col, F.col(col).isNotNull() & F.col(marker).isNull()))
    for col, values in (accepted_values or {}).items():
        rule = accepted(col, values)
        tests.append((rule.name, col, rule.violated()))
    counts = base.agg(*[F.count_if(cond).alias(f"_v{i}") for i, (_, _, cond) in enumerate(tests)])
    entries = F.array(*[F.struct(F.lit(name).alias("test"), F.lit(col).alias("column"),
                                 F.col(f"_v{i}").alias("violations"))
                        for i, (name, col, _) in enumerate(tests)])
    return counts.select(F.inline(entries))


# ---------------------------------------------------------------------------
# L11 reconciliation
# ---------------------------------------------------------------------------
def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str],
              measures: dict[str, Column] | Sequence[str], tolerance: float = 0.0) -> DataFrame:
    """Aggregate each side per ``keys`` (row count plus each measure, summed
    as ``DECIMAL(38, 6)`` so totals are exact), full-outer join on null-safe
    keys, keep groups whose difference exceeds ``tolerance``.

    Output: ``keys, left_rows, right_rows, left_<m>, right_<m>, diff_<m>``.
    """
    if not isinstance(measures, dict):
        measures = {m: F.col(m) for m in measures}

    def side(df, tag):
        aggs = [F.count(F.lit(1)).alias(f"{tag}_rows")]
        aggs += [F.sum(e.cast("decimal(38,6)")).alias(f"{tag}_{m}") for m, e in measures.items()]
        return df.groupBy(*keys).agg(*aggs)

    lsum, rsum = side(left, "left"), side(right, "right")
    cond = None
    for k in keys:
        c = lsum[k].eqNullSafe(rsum[k])
        cond = c if cond is None else cond & c
    j = lsum.join(rsum, cond, "full_outer")
    out = [F.coalesce(lsum[k], rsum[k]).alias(k) for k in keys]
    out += [F.coalesce(F.col("left_rows"), F.lit(0)).alias("left_rows"),
            F.coalesce(F.col("right_rows"), F.lit(0)).alias("right_rows")]
    diffs = [F.coalesce(F.col("left_rows"), F.lit(0)) != F.coalesce(F.col("right_rows"), F.lit(0))]
    for m in measures:
        lv = F.coalesce(F.col(f"left_{m}"), F.lit(0).cast("decimal(38,6)"))
        rv = F.coalesce(F.col(f"right_{m}"), F.lit(0).cast("decimal(38,6)"))
        out += [lv.cast("double").alias(f"left_{m}"), rv.cast("double").alias(f"right_{m}"),
                (lv - rv).cast("double").alias(f"diff_{m}")]
        diffs.append(F.abs(lv - rv) > F.lit(tolerance))
    any_diff = diffs[0]
    for d in diffs[1:]:
        any_diff = any_diff | d
    sel = j.select(*out, any_diff.alias("_d"))
    return sel.where("_d").drop("_d")


# ---------------------------------------------------------------------------
# L12 volume anomaly, L13 distribution drift
# ---------------------------------------------------------------------------
def calendar_filled(per: DataFrame, by: Sequence[str], period: str, step: str, now=None) -> DataFrame:
    """``by, period`` for every period from a key's first one up to the last
    period of any key (or the one that holds ``now``): a key that stops is
    seen from then on. One row per key and period; joined, not collected."""
    span = per.groupBy(*by).agg(F.min(period).alias("_lo"))
    last = per.agg(F.max(period).alias("_hi"))  # one row
    if now is not None:
        last = last.select(F.greatest("_hi", F.lit(now).cast("timestamp")).alias("_hi"))
    return (span.crossJoin(F.broadcast(last))
            .select(*by, F.explode(F.sequence("_lo", "_hi", F.expr(f"INTERVAL {step}"))).alias(period)))


def _left_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on equal keys, where null is a key like any other."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(other, same, "left").drop(*[f"_r_{k}" for k in keys])


def volume_anomaly(df: DataFrame, time: str, grain: str = "day", lookback: int = 7,
                   k: float = 3.0, by: Sequence[str] = (), now=None) -> DataFrame:
    """Rows per period (empty periods filled from a calendar that runs to the
    last period of any key, or to ``now``, so a key that stops is seen)
    against the mean and population stddev of the ``lookback``
    preceding periods; ``anomaly`` when ``|n - mean| > k * stddev`` (a zero
    stddev flags any change). Only the small per-period summary is windowed.
    Output: ``by, period, n, mean, stddev, z, anomaly``.
    """
    period = F.date_trunc(grain, F.col(time))
    counts = df.groupBy(*by, period.alias("period")).agg(F.count(F.lit(1)).alias("n"))
    calendar = calendar_filled(counts, by, "period", f"1 {grain.upper()}", now)
    filled = _left_null_safe(calendar, counts, [*by, "period"]).select(
        *by, "period", F.coalesce("n", F.lit(0)).alias("n"))
    w = Window.partitionBy(*by).orderBy("period").rowsBetween(-lookback, -1)
    nd = F.col("n").cast("double")
    out = filled.select(*by, "period", "n", F.avg(nd).over(w).alias("mean"),
                        F.stddev_pop(nd).over(w).alias("stddev"),
                        F.count(F.lit(1)).over(w).alias("_hist"))
    z = F.when(F.col("stddev") > 0, (nd - F.col("mean")) / F.col("stddev"))
    anomaly = (F.col("_hist") >= lookback) & F.when(
        F.col("stddev") > 0, F.abs(nd - F.col("mean")) > F.lit(k) * F.col("stddev")
    ).otherwise(nd != F.col("mean"))
    return out.select(*by, "period", "n", "mean", "stddev", z.alias("z"), anomaly.alias("anomaly"))


def drift(df: DataFrame, col: str, period: Column | str, base, edges: Sequence[float],
          smoothing: float = 0.5) -> DataFrame:
    """Fixed-edge histogram of ``col`` per period and its population
    stability index against the ``base`` period:
    ``psi = sum((p - q) * ln(p / q))`` with ``p = (count + s) / (total + s * bins)``.
    Values below the first edge fall in bin 0, at or above the last in the
    last bin. Output: ``period, psi, rows``.

    One pass over ``df``: a pivoted aggregate gives one row per period with a
    count per bin (empty bins are 0); the base period's counts reach every
    row through a window over that small per-period table.
    """
    per = F.col(period) if isinstance(period, str) else period
    edges = [float(e) for e in edges]
    nb = len(edges) + 1
    b = F.lit(0)
    for e in edges:
        b = b + F.when(F.col(col) >= F.lit(e), 1).otherwise(0)
    hist = (df.where(F.col(col).isNotNull()).select(per.alias("period"), b.alias("bin"))
              .groupBy("period").pivot("bin", list(range(nb))).count())
    counts = [F.coalesce(F.col(str(i)), F.lit(0)) for i in range(nb)]
    total = sum(counts[1:], counts[0])
    s_ = F.lit(float(smoothing))
    probs = [(c + s_) / (total + s_ * F.lit(nb)) for c in counts]
    rows = hist.select("period", total.alias("rows"), *[p.alias(f"_p{i}") for i, p in enumerate(probs)])
    everything = Window.partitionBy()  # one row per period: small
    is_base = F.col("period") == F.lit(base).cast("timestamp")
    with_q = rows.select("*", *[F.max(F.when(is_base, F.col(f"_p{i}"))).over(everything).alias(f"_q{i}")
                                for i in range(nb)])
    terms = [(F.col(f"_p{i}") - F.col(f"_q{i}")) * F.log(F.col(f"_p{i}") / F.col(f"_q{i}"))
             for i in range(nb)]
    psi = sum(terms[1:], terms[0])
    return with_q.select("period", psi.alias("psi"), "rows")


# ---------------------------------------------------------------------------
# A5 feed outages, A6 feed cadence
# ---------------------------------------------------------------------------
def feed_outages(polls: DataFrame, feed: str = "feed_id", time: str = "polled_at",
                 ok: str = "ok", order: Sequence[str] | None = None) -> DataFrame:
    """A5: consecutive failed polls of a feed form one outage:
    ``(feed, outage_start, outage_end, skipped_polls, recovered_at)``;
    ``recovered_at`` is the first successful poll after it (null while down).

    A run id is the number of successes before a poll. That running count
    needs unbounded look-back, so it is taken inside ``(feed, day)`` plus
    the successes of all earlier days, read from a small per-day summary:
    no task holds a whole feed. One aggregate then closes every run.
    """
    order = list(order or [time])
    okc = F.col(ok).cast("int")
    df = polls.withColumn("_day", F.to_date(F.col(time)))
    per_day = df.groupBy(feed, "_day").agg(F.sum(okc).alias("_ok"))
    before = Window.partitionBy(feed).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_day.select(feed, "_day", F.coalesce(F.sum("_ok").over(before), F.lit(0)).alias("_off"))
    within = (Window.partitionBy(feed, "_day").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    c = F.col("_off") + F.sum(okc).over(within)
    runs = (df.join(offsets, [feed, "_day"])
              .withColumn("_run", F.when(F.col(ok), c - 1).otherwise(c)))
    failed = ~F.col(ok)
    out = runs.groupBy(feed, "_run").agg(
        F.min(F.when(failed, F.col(time))).alias("outage_start"),
        F.max(F.when(failed, F.col(time))).alias("outage_end"),
        F.count_if(failed).alias("skipped_polls"),
        F.min(F.when(F.col(ok), F.col(time))).alias("recovered_at"))
    return out.where(F.col("skipped_polls") > 0).drop("_run")


def feed_cadence(ticks: DataFrame, interval_s: float = 1.0, period: str = "1 hour",
                 keys: Sequence[str] = ("asset_id",), time: str = "ingested_at", now=None) -> DataFrame:
    """Observed polls against expected per asset and period, and the
    share of polls that repeated an unchanged source reading. Periods without
    a poll are reported with coverage 0 (and no stale ratio), up to the last
    period of any asset or ``now``.
    Output: ``keys, period_start, polls, expected, coverage, distinct_ts, stale_ratio``."""
    from tidemark.operators.candles import bucket_of

    expected = width_micros(period) / (float(interval_s) * 1e6)
    seen = ticks.groupBy(*keys, bucket_of(time, period).alias("period_start")).agg(
        F.count(F.lit(1)).alias("polls"), F.count_distinct("ts").alias("distinct_ts"))
    calendar = calendar_filled(seen, keys, "period_start", period, now)
    out = _left_null_safe(calendar, seen, [*keys, "period_start"]).na.fill(0, ["polls", "distinct_ts"])
    return out.select(*keys, "period_start", "polls", F.lit(expected).alias("expected"),
                      (F.col("polls") / F.lit(expected)).alias("coverage"), "distinct_ts",
                      F.when(F.col("polls") > 0, F.lit(1.0) - F.col("distinct_ts") / F.col("polls"))
                      .alias("stale_ratio"))
