"""Erasure of subjects through every layer that holds them (L15): the tick store
and other keyed tables, rollups that only hold them summed up, alert logs and
quarantined lines, and landed payloads with the subject inside JSON.

Each layer is rewritten by a job that swaps in staged folders or files and reads
the result again; staging is deleted. The audit is a stored table with a row per
layer and request, written once a layer is clean, so a cascade that died is run
again with the same request: layers that are clean give zero rows more.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import broadcast_if_small
from tidemark.sources import store as S

JOURNAL = "_erasing"
AUDIT = "request_id string, layer string, rows_removed long, erased_at timestamp"


@dataclass(frozen=True)
class Layer:
    """Where subjects are held. ``kind``:

    * ``table``: a table partitioned by ``partition`` with the subject in ``key``;
    * ``rollup``: candles of ``width`` without the subject, to be recomputed from
      the table named ``source`` (which comes later in the list: its rows say
      which buckets are touched);
    * ``lines``: text files of JSON records with the subject in the field ``key``;
    * ``payloads``: rows with a ``payload`` (a JSON object keyed by subject).
    """

    name: str
    kind: str
    path: str
    key: str = "asset_id"
    partition: str = S.PART
    width: str = "1 minute"
    keys: tuple[str, ...] = ("asset_id",)
    source: str | None = None
    fmt: str = "parquet"


def without_subjects(payload: Column, subjects: Column) -> Column:
    """A JSON object without the members that ``subjects`` (an array) names; the
    others keep their values (numbers as far as doubles hold them). An object
    without such a member, and a payload that can't be read, stay as they are."""
    members = F.map_entries(F.from_json(payload, "map<string,string>", {"mode": "PERMISSIVE"}))
    kept = F.filter(members, lambda m: ~F.array_contains(subjects, m["key"]))
    # to_json of a one-member map quotes the name as JSON does
    name = lambda m: F.regexp_replace(F.to_json(F.create_map(m["key"], F.lit(0))), r"^\{|:0\}$", "")
    said = F.transform(kept, lambda m: F.concat(name(m), F.lit(":"), F.coalesce(m["value"], F.lit("null"))))
    return F.when(F.size(kept) < F.size(members), F.concat(F.lit("{"), F.array_join(said, ","), F.lit("}"))).otherwise(payload)


def _files(spark: SparkSession, path: str, hits: DataFrame) -> list[str]:
    """Files of ``path`` that hold a hit: one row per file."""
    return [r[0] for r in hits.select("_file").distinct().collect()]


def _replace_files(spark: SparkSession, rows: DataFrame, path: str, files: Sequence[str], fmt: str) -> None:
    """Put ``rows``, what is kept of ``files``, in their place. Once the new files
    are staged a journal beside them (reads skip it) says what is to be moved
    and deleted; a job that dies after that is finished by the next one."""
    staging = S.scratch_path(spark, "erase-files")
    rows.write.format(fmt).save(staging)
    todo = spark.createDataFrame([(staging, f) for f in files], "staging string, old string")
    todo.coalesce(1).write.mode("overwrite").parquet(f"{path}/{JOURNAL}")
    _finish(spark, path)


def _finish(spark: SparkSession, path: str) -> None:
    """Carry out a journal that was written whole; drop one that wasn't."""
    fs, done = S._fs(spark, f"{path}/{JOURNAL}/_SUCCESS")
    if fs.exists(done):
        todo = spark.read.parquet(f"{path}/{JOURNAL}").collect()  # a row per replaced file
        for staging in {r["staging"] for r in todo}:
            folder = S._fs(spark, staging)[1]
            for st in fs.listStatus(folder) if fs.exists(folder) else ():
                name = st.getPath().getName()
                if not name.startswith(("_", ".")):
                    fs.rename(st.getPath(), S._fs(spark, f"{path}/{name}")[1])
        for r in todo:
            fs.delete(S._fs(spark, r["old"])[1], False)
        for staging in {r["staging"] for r in todo}:
            S.drop_folder(spark, staging)
    S.drop_folder(spark, f"{path}/{JOURNAL}")


def _erase_files(spark: SparkSession, layer: Layer, subjects: DataFrame) -> int:
    """Rewrite the files that hold a subject; the number of lines or payloads changed."""
    _finish(spark, layer.path)
    subj = subjects.select(F.col(layer.key).cast("string").alias("_s")).distinct()
    if layer.kind == "lines":
        rows = spark.read.text(layer.path).select("*", F.col("_metadata.file_path").alias("_file"))
        held = F.get_json_object("value", f"$.{layer.key}")
        hits = rows.withColumn("_s", held).join(broadcast_if_small(subj), "_s", "left_semi")
        files = _files(spark, layer.path, hits)
        n = hits.count()
        if files:
            whole = spark.read.text(files)
            kept = whole.withColumn("_s", F.get_json_object("value", f"$.{layer.key}")).join(
                broadcast_if_small(subj), "_s", "left_anti").select("value")
            _replace_files(spark, kept, layer.path, files, "text")
        return n
    rows = spark.read.format(layer.fmt).load(layer.path)
    columns, schema = rows.columns, rows.schema
    marked = rows.select("*", F.col("_metadata.file_path").alias("_file"))
    members = F.map_keys(F.from_json("payload", "map<string,string>"))
    hits = marked.withColumn("_s", F.explode(members)).join(broadcast_if_small(subj), "_s", "left_semi")
    files, n = _files(spark, layer.path, hits), hits.count()
    if files:
        whole = spark.read.format(layer.fmt).schema(schema).load(files)
        # the request's subjects in one row: a request list, not data
        listed = subj.agg(F.collect_list("_s").alias("_subjects"))
        kept = whole.crossJoin(F.broadcast(listed)).withColumn("payload", without_subjects(F.col("payload"), F.col("_subjects")))
        _replace_files(spark, kept.select(*columns), layer.path, files, layer.fmt)
    return n


def _left(spark: SparkSession, layer: Layer, subjects: DataFrame) -> bool:
    subj = subjects.select(F.col(layer.key).cast("string").alias("_s")).distinct()
    spark.catalog.refreshByPath(layer.path)
    if layer.kind == "lines":
        held = spark.read.text(layer.path).select(F.get_json_object("value", f"$.{layer.key}").alias("_s"))
    else:
        held = spark.read.format(layer.fmt).load(layer.path).select(
            F.explode(F.map_keys(F.from_json("payload", "map<string,string>"))).alias("_s"))
    return bool(held.join(broadcast_if_small(subj), "_s", "left_semi").take(1))


def erase_everywhere(spark: SparkSession, layers: Sequence[Layer], subjects: DataFrame, request_id: str, now,
                     audit_path: str) -> DataFrame:
    """L15 cascade: the subjects (rows with the layers' key columns) removed from
    every layer. Rollups note the touched buckets before their source is erased
    and are recomputed after it. Appends the audit rows of this request to the
    table in ``audit_path`` and returns them."""
    by_name = {layer.name: layer for layer in layers}
    removed: dict[str, int] = {}
    rollups = [layer for layer in layers if layer.kind == "rollup"]
    for layer in rollups:
        source = by_name[layer.source]
        hits = spark.read.parquet(source.path).join(
            broadcast_if_small(subjects.select(source.key).distinct()), source.key, "left_semi")
        S.record_invalidated(hits, layer.path, f"request={request_id}", layer.width)
        note = f"{layer.path}/{S.INVALIDATED}/request={request_id}"
        fs, p = S._fs(spark, note)
        removed[layer.name] = spark.read.parquet(note).count() if fs.exists(p) else 0
    for layer in layers:
        if layer.kind == "table":
            report = S.erase_in_store(spark, layer.path, subjects, layer.key, layer.partition, request_id)
            removed[layer.name] = report.agg(F.coalesce(F.sum("rows_removed"), F.lit(0))).first()[0]
        elif layer.kind != "rollup":
            removed[layer.name] = _erase_files(spark, layer, subjects)
            if _left(spark, layer, subjects):
                raise S.VerificationFailed(f"an erased subject is still in {layer.name}")
    for layer in rollups:
        source = by_name[layer.source]
        spark.catalog.refreshByPath(source.path)
        S.refresh_noted(spark, layer.path, spark.read.parquet(source.path), layer.width, layer.keys)
    rows = [(request_id, layer.name, removed[layer.name]) for layer in layers]
    audit = spark.createDataFrame(rows, "request_id string, layer string, rows_removed long").withColumn(
        "erased_at", F.lit(now).cast("timestamp"))
    audit.coalesce(1).write.mode("append").parquet(audit_path)
    return spark.read.schema(AUDIT).parquet(audit_path).where(F.col("request_id") == request_id)
