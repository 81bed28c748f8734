"""Streaming candles as an append-only log of partial candles (I4).

A micro-batch's ticks are aggregated to partial candles (what :data:`STATE`
lists, per key and bucket) and written to a folder of their own, so a trigger
writes in proportion to its batch, whatever days its ticks belong to; a replayed
batch overwrites its folder. Partial candles of one bucket merge in any order,
so late ticks of any age count, no streaming state is held and no watermark
drops anything. A reader merges the folded base with the open deltas.

:func:`fold` is the separate job that merges deltas into the base, rewriting the
touched days only. Base rows carry the last batch that is part of them, so a
fold that died in between loses and doubles nothing: until it has been run
again, readers leave out a delta row where the base row has its batch already.

The log counts each tick that it is given: deduplicate before it (the tick
store's insert-ignore, or :func:`tidemark.streaming.jobs.stream_first_readings`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.candles import bucket_of
from tidemark.sources import store as S

BASE, DELTAS, FOLDING, DAY = "base", "deltas", "_folding", "bucket_date"
#: Columns of a partial candle beside its key and bucket.
STATE = ("open", "open_at", "high", "low", "close", "close_at", "volume_24h", "ticks")


def partial_candles(ticks: DataFrame, width: str, keys: Sequence[str] = ("asset_id",),
                    time: str = "ingested_at") -> DataFrame:
    """``keys, bucket`` and :data:`STATE`: one partial aggregate per task and bucket."""
    return ticks.groupBy(*keys, bucket_of(time, width).alias("bucket")).agg(
        F.min_by("price", time).alias("open"), F.min(time).alias("open_at"), F.max("price").alias("high"),
        F.min("price").alias("low"), F.max_by("price", time).alias("close"), F.max(time).alias("close_at"),
        F.max_by("volume_24h", time).alias("volume_24h"), F.count(F.lit(1)).alias("ticks"))


def merge_partials(parts: DataFrame, keys: Sequence[str] = ("asset_id",)) -> DataFrame:
    """Partial candles of one bucket as one; ``batch`` becomes the highest."""
    return parts.groupBy(*keys, "bucket").agg(
        F.min_by("open", "open_at").alias("open"), F.min("open_at").alias("open_at"), F.max("high").alias("high"),
        F.min("low").alias("low"), F.max_by("close", "close_at").alias("close"), F.max("close_at").alias("close_at"),
        F.max_by("volume_24h", "close_at").alias("volume_24h"), F.sum("ticks").alias("ticks"),
        F.max("batch").alias("batch"))


def start_candle_log(ticks: DataFrame, path: str, checkpoint: str, width: str = "1 minute",
                     keys: Sequence[str] = ("asset_id",), trigger: dict | None = None) -> StreamingQuery:
    """I4: each micro-batch's partial candles appended to the log in ``path``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        found = partial_candles(batch.where(F.col("ingested_at").isNotNull()), width, keys)
        (found.withColumn(DAY, F.to_date("bucket")).write.mode("overwrite").option("compression", "zstd")
              .parquet(f"{path}/{DELTAS}/batch={batch_id}"))

    return (ticks.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
                 .trigger(**(trigger or {"availableNow": True})).start())


def _deltas(spark: SparkSession, path: str) -> list[int]:
    """Batches with a complete delta folder (a listing, one per open micro-batch)."""
    fs, _ = S._fs(spark, path)
    ids = [int(v) for v in S._partition_values(spark, f"{path}/{DELTAS}", "batch")]
    return sorted(i for i in ids if fs.exists(S._fs(spark, f"{path}/{DELTAS}/batch={i}/_SUCCESS")[1]))


def _read_deltas(spark: SparkSession, path: str, batches: Sequence[int]) -> DataFrame:
    folders = [f"{path}/{DELTAS}/batch={i}" for i in batches]
    rows = spark.read.option("basePath", f"{path}/{DELTAS}").parquet(*folders)
    return rows.withColumn("batch", F.col("batch").cast("long"))


def _base(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(f"{path}/{BASE}") if S.list_partitions_of(spark, f"{path}/{BASE}", DAY) else None


def _merged(base: DataFrame | None, deltas: DataFrame | None, keys: Sequence[str], begun: int | None) -> DataFrame:
    """All partial candles of base and deltas merged, with their day. ``begun``
    is the last batch of a fold that may have got to some base rows only."""
    if base is None or deltas is None:
        return (deltas if base is None else base)
    columns = [*keys, "bucket", *STATE, "batch", DAY]
    if begun is not None:
        through = base.select(*keys, "bucket", F.col("batch").alias("_through"))
        maybe = deltas.where(F.col("batch") <= begun).alias("d").join(
            through.alias("b"), [F.col(f"d.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*keys, "bucket"]], "left")
        fresh = maybe.where(F.col("_through").isNull() | (F.col("d.batch") > F.col("_through"))).select("d.*")
        deltas = deltas.where(F.col("batch") > begun).unionByName(fresh)
    return base.select(*columns).unionByName(deltas.select(*columns))


def _begun(spark: SparkSession, path: str) -> int | None:
    """The last batch of a fold that hasn't ended."""
    marks = [int(v) for v in S._partition_values(spark, f"{path}/{FOLDING}", "through")]
    return max(marks, default=None)


def read_candles(spark: SparkSession, path: str, keys: Sequence[str] = ("asset_id",)) -> DataFrame:
    """The current candles: the folded base and the open deltas, merged."""
    open_ = _deltas(spark, path)
    deltas = _read_deltas(spark, path, open_) if open_ else None
    parts = _merged(_base(spark, path), deltas, keys, _begun(spark, path))
    if parts is None:
        raise ValueError(f"no candles in {path}")
    return merge_partials(parts, keys).drop("open_at", "close_at", "batch")


def fold(spark: SparkSession, path: str, keys: Sequence[str] = ("asset_id",)) -> int | None:
    """Merge the deltas that are there now into the base and drop them; returns
    the last batch folded. Days without a delta aren't read or written. One
    fold at a time; the stream may go on beside it."""
    open_ = _deltas(spark, path)
    begun = _begun(spark, path)
    if begun is not None:  # finish that one first: its deltas, no others
        open_ = [i for i in open_ if i <= begun]
    through = begun if begun is not None else max(open_, default=None)
    if through is None:
        return None
    fs, mark = S._fs(spark, f"{path}/{FOLDING}/through={through}")
    fs.mkdirs(mark)
    if open_:
        deltas = _read_deltas(spark, path, open_)
        days = [r[0] for r in deltas.select(DAY).distinct().collect()]  # a few days of open deltas
        base = _base(spark, path)
        if base is not None:
            base = base.where(F.col(DAY).isin(days))
        new = merge_partials(_merged(base, deltas, keys, begun), keys)
        S.overwrite_partitions(new.withColumn(DAY, F.to_date("bucket")), f"{path}/{BASE}",
                               S.scratch_path(spark, "fold"), DAY)
        for i in open_:
            S.drop_folder(spark, f"{path}/{DELTAS}/batch={i}")
    S.drop_folder(spark, f"{path}/{FOLDING}/through={through}")
    return through
