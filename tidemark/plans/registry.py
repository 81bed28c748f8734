"""Registry of named queries (Spark) and their DuckDB oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame`` over the shared tables. Its
oracle is ANSI SQL over the same tables registered as DuckDB views; column
names match, timestamps leave Spark as TIMESTAMP_NTZ (UTC wall clock).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.columns import to_ntz

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``fn`` under ``name``; ``sql=None`` marks a rows-only check."""

    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name!r}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return to_ntz(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return run

    return deco


def load_all() -> None:
    """Import every plan module so its queries register."""
    from tidemark.plans import (  # noqa: F401
        ingest,
        lakehouse,
        maintenance,
        market,
        quality,
        streams,
        tables,
    )
