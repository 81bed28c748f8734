"""Gates inside a stream (L6, L8): a micro-batch is tested before any of it is stored.

Rows that break a rule go to the quarantine with their reasons, the others to
the store; where a rule is broken more often than it tolerates, nothing of the
micro-batch is stored: all of it is quarantined, the report says so, and the
stream stops (or, told to, leaves the batch out and goes on). A batch is written
once, to staging, split into good rows and rejects; the rules are counted by that
write. Its parts are then moved to folders named by the batch, so a replayed batch
replaces them and changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.quality import GateFailed, Rule
from tidemark.sources import store as S

GOOD, REJECTS, REPORT = "good", "rejects", "report"
HELD_BACK = "batch held back"


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Put a staged folder in the place of ``target``."""
    fs, to = S._fs(spark, target)
    S.drop_folder(spark, target)
    fs.mkdirs(to.getParent())
    fs.rename(S._fs(spark, source)[1], to)


def start_gated_store(stream: DataFrame, rules: Sequence[Rule], path: str, checkpoint: str,
                      on_breach: str = "halt", trigger: dict | None = None) -> StreamingQuery:
    """``stream`` through ``rules`` into ``path/good`` and ``path/rejects``
    (with ``reasons``), and a row per batch and rule in ``path/report``.

    A rule broken by a larger share of a batch than its ``max_rate`` holds the
    whole batch back: with ``on_breach="halt"`` the query ends with
    :class:`GateFailed`, and every restart meets the batch again; ``"divert"``
    goes on behind it."""
    if on_breach not in ("halt", "divert"):
        raise ValueError(f"on_breach is halt or divert, not {on_breach!r}")
    names = [f"_v{i}" for i in range(len(rules))]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, seen = batch.sparkSession, Observation()
        reasons = F.array_compact(F.array(*[F.when(r.violated(), F.lit(r.name)) for r in rules]))
        tagged = batch.withColumn("reasons", reasons).withColumn("_bad", F.size("reasons") > 0)
        tagged = tagged.observe(seen, F.count(F.lit(1)).alias("total"), *[
            F.count_if(F.array_contains("reasons", r.name)).alias(n) for r, n in zip(rules, names)])
        staging = S.scratch_path(spark, "gate")
        tagged.write.partitionBy("_bad").option("compression", "zstd").parquet(staging)
        counts = seen.get
        total = counts["total"]
        rates = [counts[n] / total if total else 0.0 for n in names]
        broken = [r.name for r, rate in zip(rules, rates) if rate > r.max_rate]
        label = f"batch={batch_id}"
        if broken:
            schema = tagged.schema
            all_of_it = spark.read.schema(schema).parquet(staging)
            held = F.when(F.size("reasons") > 0, F.col("reasons")).otherwise(F.array(F.lit(HELD_BACK)))
            all_of_it.withColumn("reasons", held).drop("_bad").write.mode("overwrite").option(
                "compression", "zstd").parquet(f"{path}/{REJECTS}/{label}")
        else:
            for part, to in (("_bad=false", GOOD), ("_bad=true", REJECTS)):
                if part in {f"_bad={v}" for v in S._partition_values(spark, staging, "_bad")}:
                    _move(spark, f"{staging}/{part}", f"{path}/{to}/{label}")
        report = [(r.name, counts[n], total, rate, r.max_rate, not broken) for r, n, rate in zip(rules, names, rates)]
        fields = "rule string, violations long, total long, rate double, max_rate double, stored boolean"
        (spark.createDataFrame(report, fields).coalesce(1).write.mode("overwrite")
              .parquet(f"{path}/{REPORT}/{label}"))
        S.drop_folder(spark, staging)
        if broken and on_breach == "halt":
            raise GateFailed(f"batch {batch_id} breaks {', '.join(broken)}")

    return (stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
                  .trigger(**(trigger or {"availableNow": True})).start())


def gated(spark: SparkSession, path: str, part: str, schema) -> DataFrame:
    """``part`` (good, rejects or report) of a gated store, with its ``batch``; rows
    of ``schema``. Empty while there is nothing."""
    folders = S._partition_values(spark, f"{path}/{part}", "batch")
    if not folders:
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(None).cast("int"))
    read = spark.read.schema(schema).option("basePath", f"{path}/{part}")
    return read.parquet(*[f"{path}/{part}/batch={v}" for v in folders])
