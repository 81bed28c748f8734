"""Lookups, star joins, KPIs and bus records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import broadcast_if_small
from tidemark.operators.keyed import last_per_key


# ---------------------------------------------------------------------------
# Newest-first lookups
# ---------------------------------------------------------------------------
def newest(ticks: DataFrame, n: int = 10, time: str = "ingested_at",
           tiebreak: Sequence[str] = ("asset_id",)) -> DataFrame:
    """``ORDER BY time DESC LIMIT n``; polls share ``ingested_at`` across
    assets, so ``tiebreak`` makes the cut deterministic. Plans as a
    TakeOrderedAndProject: each task keeps its own top n, no full sort."""
    return ticks.orderBy(F.col(time).desc(), *[F.col(c).asc() for c in tiebreak]).limit(n)


def latest_per_asset(ticks: DataFrame, keys: Sequence[str] = ("asset_id",),
                     time: str = "ingested_at") -> DataFrame:
    """the last tick per asset ("last price"): a partial
    WindowGroupLimit keeps one row per asset and map task before the
    exchange, so the shuffle is tiny however hot an asset is."""
    return last_per_key(ticks, list(keys), time).select(*ticks.columns)


def recent_per_asset(ticks: DataFrame, n: int, keys: Sequence[str] = ("asset_id",),
                     time: str = "ingested_at") -> DataFrame:
    """the ``n`` newest ticks per asset. ``row_number() <= n`` plans a
    partial WindowGroupLimit before the exchange, so at most ``n`` rows per
    key and map task are shuffled however hot the key."""
    w = Window.partitionBy(*keys).orderBy(F.col(time).desc())
    return ticks.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def recent_window(ticks: DataFrame, start, end, assets: Sequence[str] | None = None,
                  time: str = "ingested_at") -> DataFrame:
    """F3 (range form): ticks of ``[start, end)`` newest first per asset."""
    out = ticks.where((F.col(time) >= F.lit(start).cast("timestamp"))
                      & (F.col(time) < F.lit(end).cast("timestamp")))
    if assets is not None:
        out = out.where(F.col("asset_id").isin(list(assets)))
    return out.orderBy("asset_id", F.col(time).desc())


# ---------------------------------------------------------------------------
# Enrichment and star joins
# ---------------------------------------------------------------------------
def enrich(facts: DataFrame, dim: DataFrame, on, how: str = "left",
           broadcast_bytes: int | None = None) -> DataFrame:
    """C4: facts (batch or streaming) joined with a dimension; the dimension
    is broadcast only when its estimated size is within the limit."""
    d = broadcast_if_small(dim, broadcast_bytes) if broadcast_bytes else broadcast_if_small(dim)
    return facts.join(d, on, how)


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, object, str]]) -> DataFrame:
    """A fact joined to each ``(dimension, on, how)`` in turn; every
    dimension goes through the size-checked broadcast."""
    out = fact
    for dim, on, how in dims:
        out = enrich(out, dim, on, how)
    return out


def build_marts(ticks: DataFrame, assets: DataFrame, width: str = "1 hour",
                grains: Sequence[str] = ("day", "week"), key: str = "asset_id",
                asset_key: str = "id") -> dict[str, DataFrame]:
    """L3 gold layer: candles at ``width`` from silver ticks, rolled up to
    each calendar grain, each joined to the asset dimension (size-checked
    broadcast). Returns ``{"candles_<width>": df, "candles_<grain>": df, ...}``."""
    from tidemark.operators.candles import candles, rollup_candles

    dim = assets.withColumnRenamed(asset_key, key)
    base = candles(ticks, width, (key,))
    out = {f"candles_{width.replace(' ', '')}": enrich(base, dim, key)}
    for g in grains:
        out[f"candles_{g}"] = enrich(rollup_candles(base, g, (key,)), dim, key)
    return out


# ---------------------------------------------------------------------------
# Named, versioned KPIs
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Measure:
    """What a KPI counts, in a form whose partial states merge: ``kind`` is sum,
    count, min, max or distinct."""

    kind: str
    column: Column | None = None

    def partial(self) -> Column:
        """The state of some rows; that of ``distinct`` is a sketch (HLL with
        4096 registers: a standard error of 1.6 percent)."""
        c = self.column
        return {
            "sum": lambda: F.sum(c), "min": lambda: F.min(c), "max": lambda: F.max(c),
            "count": lambda: F.count(F.lit(1) if c is None else c),
            "distinct": lambda: F.hll_sketch_agg(c, F.lit(12)),
        }[self.kind]()

    def merged(self, state: str) -> Column:
        return {
            "sum": lambda: F.sum(state), "min": lambda: F.min(state), "max": lambda: F.max(state),
            "count": lambda: F.sum(state),
            "distinct": lambda: F.hll_sketch_estimate(F.hll_union_agg(F.col(state))),
        }[self.kind]()


@dataclass(frozen=True)
class Kpi:
    name: str
    version: int
    owner: str
    expr: Column | Measure  # an aggregate expression, or a measure for kpi_report
    grain: str = "day"  # calendar grain of the period, for kpi_report


def kpis(df: DataFrame, definitions: Sequence[Kpi], grain: Sequence[str | Column] = ()) -> DataFrame:
    """Evaluate every KPI in ONE aggregate pass per grain and return the
    long form ``(grain..., kpi, version, owner, value)``."""
    aggs = [d.expr.cast("double").alias(f"_k{i}") for i, d in enumerate(definitions)]
    wide = df.groupBy(*grain).agg(*aggs)
    gcols = [c for c in wide.columns if not c.startswith("_k")]
    entries = F.array(*[
        F.struct(F.lit(d.name).alias("kpi"), F.lit(d.version).alias("version"),
                 F.lit(d.owner).alias("owner"), F.col(f"_k{i}").alias("value"))
        for i, d in enumerate(definitions)])
    return wide.select(*gcols, F.inline(entries))


def kpi_report(df: DataFrame, definitions: Sequence[Kpi], time: str,
               by: Sequence[str] = ()) -> DataFrame:
    """D9 registry form: every KPI at its own calendar grain, all grains in
    one long table ``(by..., grain, period, kpi, version, owner, value)``.

    KPIs that are measures read the facts once: one partial aggregate at the
    finest grain, and per distinct value that one of them counts; its rows, not
    the facts, go to the groups of every grain. Others need an aggregate per
    distinct grain.
    """
    if all(isinstance(d.expr, Measure) for d in definitions):
        return _measured_report(df, definitions, time, by)
    parts = []
    for g in dict.fromkeys(d.grain for d in definitions):
        own = [d for d in definitions if d.grain == g]
        at = [F.lit(g).alias("grain"), F.date_trunc(g, F.col(time)).alias("period")]
        parts.append(kpis(df, own, [*[F.col(b) for b in by], *at]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(*by, "grain", "period", "kpi", "version", "owner", "value")


_GRAINS = ("day", "month", "quarter", "year")


def _measured_report(df: DataFrame, definitions: Sequence[Kpi], time: str, by: Sequence[str]) -> DataFrame:
    grains = list(dict.fromkeys(d.grain for d in definitions))
    nested = all(g in _GRAINS for g in grains)
    finest = min(grains, key=_GRAINS.index) if nested else grains[0] if len(grains) == 1 else "day"
    counted = {i: d.expr.column.alias(f"_d{i}") for i, d in enumerate(definitions) if d.expr.kind == "distinct"}
    sums = [(i, d.expr) for i, d in enumerate(definitions) if i not in counted]
    base = df.groupBy(*by, F.date_trunc(finest, F.col(time)).alias("_at"), *counted.values()).agg(
        F.count(F.lit(1)).alias("_n"), *[m.partial().alias(f"_k{i}") for i, m in sums])
    periods = F.array(*[F.struct(F.lit(g).alias("grain"), F.date_trunc(g, "_at").alias("period")) for g in grains])
    # a grain carries the values that one of its own measures counts, and no others
    own = {f"_d{i}": F.when(F.col("_g.grain") == definitions[i].grain, F.col(f"_d{i}")) for i in counted}
    wide = base.withColumn("_g", F.explode(periods)).withColumns(own).groupBy(*by, "_g").agg(
        *[m.merged(f"_k{i}").cast("double").alias(f"_k{i}") for i, m in sums],
        *[F.count_distinct(f"_d{i}").cast("double").alias(f"_k{i}") for i in counted])
    entries = F.array(*[
        F.struct(F.lit(d.name).alias("kpi"), F.lit(d.version).alias("version"), F.lit(d.owner).alias("owner"),
                 F.col(f"_k{i}").alias("value"), F.lit(d.grain).alias("_of"))
        for i, d in enumerate(definitions)])
    return (wide.select(*by, "_g.grain", "_g.period", F.inline(entries)).where("_of = grain")
                .select(*by, "grain", "period", "kpi", "version", "owner", "value"))


def kpi_states(df: DataFrame, measures: dict[str, Measure], time: str, by: Sequence[str] = ()) -> DataFrame:
    """D9 as stored states: ``by, day`` and a partial state per measure. New facts
    are more rows of states; nothing is computed twice."""
    return df.groupBy(*by, F.date_trunc("day", F.col(time)).alias("day")).agg(
        *[m.partial().alias(name) for name, m in measures.items()])


def kpi_rollup(states: DataFrame, measures: dict[str, Measure], grain: str, by: Sequence[str] = ()) -> DataFrame:
    """``by, period`` and every measure's value at a calendar grain, from states
    of any number of writes."""
    return states.groupBy(*by, F.date_trunc(grain, "day").alias("period")).agg(
        *[m.merged(name).alias(name) for name, m in measures.items()])


# ---------------------------------------------------------------------------
# Batch rows as bus events
# ---------------------------------------------------------------------------
def to_bus(df: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """``(key, value)`` string pairs, ready for a ``kafka`` or file sink."""
    keys = [key] if isinstance(key, str) else list(key)
    k = F.col(keys[0]).cast("string") if len(keys) == 1 else F.to_json(F.struct(*keys))
    return df.select(k.alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))
