"""Live enrichment with write-back (C4): records joined to a dimension that
changes while the stream runs, sent on to a bus-shaped sink.

The dimension is a versioned table, read again by every micro-batch, so a row
that lands is used from the next trigger on. A record whose dimension row isn't
there yet waits in a buffer and goes out, once, as soon as it is. Everything is
kept in folders labelled by micro-batch: ``out`` holds what was sent, ``waiting``
the whole buffer after the batch. A replayed batch starts from the buffer before
it and overwrites its own folders, so nothing is lost or sent twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.marts import enrich, to_bus
from tidemark.sources import store as S

OUT, WAITING = "out", "waiting"


class VersionedTable:
    """Versions of a table as folders; a version is never changed, and one that
    wasn't written whole is never read."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def newest(self) -> int | None:
        return max((int(v) for v in _complete(self.spark, self.path, "version")), default=None)

    def put(self, rows: DataFrame) -> int:
        version = (self.newest() or 0) + 1
        rows.write.mode("overwrite").parquet(f"{self.path}/version={version}")
        return version

    def get(self, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/version={version or self.newest()}")


def _complete(spark: SparkSession, path: str, column: str) -> list[str]:
    """Labels of the ``column=`` folders that were written whole, in order."""
    fs, _ = S._fs(spark, path)
    values = S._partition_values(spark, path, column)
    return [v for v in values if fs.exists(S._fs(spark, f"{path}/{column}={v}/_SUCCESS")[1])]


def _step(spark: SparkSession, path: str, label: str, records: DataFrame | None, schema, dim: DataFrame, on,
          key: Sequence[str] | str, send: Callable[[DataFrame, str], None] | None) -> None:
    """Match the buffer and the new records; write what matched and the new buffer."""
    on = [on] if isinstance(on, str) else list(on)
    before = [v for v in _complete(spark, f"{path}/{WAITING}", "label") if v < label]
    for v in _complete(spark, f"{path}/{OUT}", "label"):
        if v > (before[-1] if before else "") and v < label:
            S.drop_folder(spark, f"{path}/{OUT}/label={v}")  # of a step that died before its buffer was written
    todo = records
    if before:
        held = spark.read.schema(schema).parquet(f"{path}/{WAITING}/label={before[-1]}")
        todo = held if records is None else held.unionByName(records)
    if todo is None:
        return
    marked = dim.withColumn("_known", F.lit(True))
    joined = enrich(todo, marked, on, "left").persist()
    try:
        sent = to_bus(joined.where("_known").drop("_known"), key)
        if send is not None:
            send(sent, label)
        sent.write.mode("overwrite").parquet(f"{path}/{OUT}/label={label}")
        (joined.where("_known IS NULL").select(*[f.name for f in schema.fields])
               .write.mode("overwrite").parquet(f"{path}/{WAITING}/label={label}"))
    finally:
        joined.unpersist()
    for v in before[:-1]:  # the one before stays, for a replay of this batch
        S.drop_folder(spark, f"{path}/{WAITING}/label={v}")


def start_enrichment(records: DataFrame, dims: str, path: str, checkpoint: str, on, key: Sequence[str] | str,
                     trigger: dict | None = None,
                     send: Callable[[DataFrame, str], None] | None = None) -> StreamingQuery:
    """C4 live: ``records`` joined on ``on`` to the newest version of the table in
    ``dims`` (unique per key) and written back as ``(key, value)`` records to
    ``path/out``; ``send(rows, label)`` may hand them to a bus as well (a replay
    gives the same label again). Rows with a null key wait for good."""
    schema, spark = records.schema, records.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        dim = VersionedTable(spark, dims).get()
        _step(spark, path, f"{batch_id:012d}", batch, schema, dim, on, key, send)

    return (records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
                   .trigger(**(trigger or {"availableNow": True})).start())


def settle(spark: SparkSession, dims: str, path: str, schema, on, key: Sequence[str] | str,
           send: Callable[[DataFrame, str], None] | None = None) -> None:
    """What waits, matched against the newest dimension without waiting for new
    records; run it while no micro-batch does."""
    labels = _complete(spark, f"{path}/{WAITING}", "label")
    if labels:
        batch, _, n = labels[-1].partition("-")
        # behind its batch in order, before the next one
        _step(spark, path, f"{batch}-{int(n or 0) + 1:06d}", None, schema, VersionedTable(spark, dims).get(), on, key, send)


def sent_records(spark: SparkSession, path: str) -> DataFrame:
    """The ``(key, value)`` records written back so far."""
    labels = _complete(spark, f"{path}/{OUT}", "label")
    return spark.read.schema("key string, value string").parquet(*[f"{path}/{OUT}/label={v}" for v in labels])


def waiting_records(spark: SparkSession, path: str, schema) -> DataFrame:
    """The buffer: records without a dimension row."""
    labels = _complete(spark, f"{path}/{WAITING}", "label")
    return spark.read.schema(schema).parquet(f"{path}/{WAITING}/label={labels[-1]}")
