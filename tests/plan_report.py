"""Physical-plan shape of every batch query of the core, planned without AQE.

Queries that run a job first (streams, table writes) are left out: what is left
to plan there is a read of their result.

Usage: python tests/plan_report.py [sf_dir]  -> a Markdown table on stdout.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

HEAD = "| query | scans | exchanges | broadcasts | sorts | partial agg/limit | python |"
JOBS = ("cdc_replay", "kpi_rollup")


def shape(plan: str) -> dict[str, int]:
    return {
        "scans": plan.count("FileScan") + plan.count("Scan ExistingRDD"),
        "exchanges": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "sorts": plan.count("Sort ["),
        "partial": plan.count("partial_") + plan.count(", Partial"),
        "python": plan.count("ArrowEvalPython") + plan.count("FlatMapGroupsInPandas"),
    }


def rows(spark, sf: str) -> list[str]:
    """A table row for each batch query, by name."""
    from tidemark.plans import ingest, lakehouse, market, quality, tables
    from tidemark.plans.registry import QUERIES, load_all

    load_all()
    own = {n for m in (ingest, lakehouse, market, quality, tables) for n in vars(m)}
    out = []
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the static plan Catalyst chose
    try:
        for name, fn in sorted(QUERIES.items()):
            if name in JOBS or fn.__name__ not in own:
                continue
            s = shape(fn(spark, sf)._jdf.queryExecution().executedPlan().toString())
            out.append("| " + " | ".join([name, *map(str, s.values())]) + " |")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    return out


def main(argv):
    from tidemark.session import get_session

    print(HEAD)
    print("|---|---|---|---|---|---|---|")
    print("\n".join(rows(get_session(shuffle_partitions=8), argv[1] if len(argv) > 1 else "/root/testdata/sf0.01")))


if __name__ == "__main__":
    main(sys.argv)
