"""The driver contract: entry runs, every query has an oracle, names agree."""

from __future__ import annotations

import duckdb
import pytest
from conftest import SF001

import __spark_entry__ as E
from tidemark.plans.registry import QUERIES
from tidemark.sources.fixtures import TABLES


def test_every_query_of_the_core_has_an_oracle():
    qs, oracles = E.queries(), E.oracle_sql()
    assert set(QUERIES) <= set(oracles) <= set(qs) and len(QUERIES) >= 60


def test_entry_runs_on_smallest_scale(spark):
    df = E.entry(spark)
    assert df.columns == ["asset_id", "metric", "value", "baseline", "change_pct", "threshold",
                          "window_s", "samples", "ts"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["candles_5m", "trailing_alerts_ties", "feed_outages", "cdc_apply"])
def test_oracle_columns_match(spark, name):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    rows = res.fetchall()
    df = E.queries()[name](spark, SF001)
    assert sorted(df.columns) == sorted(cols)
    assert df.count() == len(rows)
