"""Run the feed: landed price polls fanned out to the tick store and the
alert log (I2), as two streaming queries.

    python -m tidemark.streaming --landing DIR --store DIR --alerts DIR --checkpoint DIR \\
        [--window 300 --threshold 0.02 --warmup 30] [--once]

``--once`` processes what has landed and stops (``availableNow``); without it
the queries poll every second, like the reference's feed.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tidemark.session import ROCKSDB, pin_utc
from tidemark.streaming.jobs import start_feed


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="python -m tidemark.streaming")
    ap.add_argument("--landing", required=True)
    ap.add_argument("--store", required=True)
    ap.add_argument("--alerts", required=True)
    ap.add_argument("--checkpoint", required=True)
    ap.add_argument("--format", default="json")
    ap.add_argument("--vs", default="usd")
    ap.add_argument("--window", type=int, default=300)
    ap.add_argument("--threshold", type=float, default=0.02)
    ap.add_argument("--warmup", type=int, default=30)
    ap.add_argument("--max-files", type=int, default=100, help="landed files per trigger")
    ap.add_argument("--partitions", type=int, help="state partitions, fixed at the first start")
    ap.add_argument("--console", action="store_true", help="also print each alert's line")
    ap.add_argument("--once", action="store_true")
    a = ap.parse_args(argv)
    spark = (SparkSession.builder.appName("tidemark-feed")
             .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB).getOrCreate())
    pin_utc(spark)
    trigger = {"availableNow": True} if a.once else {"processingTime": "1 second"}
    queries = start_feed(spark, a.landing, a.store, a.alerts, a.checkpoint, vs=a.vs, fmt=a.format,
                         detector=dict(window_s=a.window, threshold=a.threshold, warmup_s=a.warmup),
                         trigger=trigger, max_files_per_trigger=a.max_files, partitions=a.partitions,
                         console=a.console)
    for q in queries:
        q.awaitTermination()


if __name__ == "__main__":
    main()
