"""tidemark: market-tick analytics written as plain Spark DataFrame functions.

Layout
------
``sources``    landed payloads, JSON parsing, fixture mapping, the tick store
``operators``  candles, trailing alerts, keyed table operators, quality gates,
               privacy, marts
``functions``  Column-level helpers (alert formatting, checked broadcast)
``streaming``  Structured Streaming jobs (stateful detector, candles, sinks)
``plans``      the registered queries over the shared test tables and their
               DuckDB oracles

Every operator is ``DataFrame -> DataFrame`` (or a tuple of them), takes every
threshold as an argument, and never collects data to the driver.
"""

from tidemark.operators.alerts import late_ticks, multi_window_alerts, trailing_alerts, zscore_alerts
from tidemark.operators.candles import candles, realtime_candles, refresh, rollup_candles
from tidemark.operators.keyed import cdc_apply, dedup_unchanged, fk_split, insert_ignore, upsert
from tidemark.session import checkpoint_root, get_session, pin_utc
from tidemark.sources.payloads import parse_markets, parse_prices, read_payloads

__all__ = [
    "candles", "cdc_apply", "checkpoint_root", "dedup_unchanged", "fk_split", "get_session",
    "insert_ignore", "late_ticks", "multi_window_alerts", "parse_markets", "parse_prices",
    "pin_utc", "read_payloads", "realtime_candles", "refresh", "rollup_candles",
    "trailing_alerts", "upsert", "zscore_alerts",
]
