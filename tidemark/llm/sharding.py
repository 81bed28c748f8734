"""Sharding by fixed virtual slots.

A record's hash gives it one of some thousands of slots, for good. Bytes are
added up per slot, and a versioned map says which shard holds a slot. The first
map deals slots from the largest down to the lightest shard; later versions are
edits: to even out or to add shards, single slots move and all others stay. A
corpus that has grown is sharded again by the map's newest version, edited to its
new bytes, so nearly all records stay where they are.

Nulls and edge cases: a null text has 0 bytes and no checksum but the overhead;
rows without doc_id hash by their size and checksum; repeated rows go to the
same slot; shards may stay empty when there are few rows; an empty table gives
an empty table; columns that clash with the ones added are replaced.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import shared_path, written

SLOTS, SHARDS, OVERHEAD = 4096, 40, 16


def with_slots(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``docs`` with ``size``, ``text_crc32`` and ``virtual_slot``."""
    return (
        docs.withColumn("size", (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long"))
        .withColumn("text_crc32", F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
        .withColumn("virtual_slot", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(slots)).cast("int"))
    )


def slot_bytes(slotted: DataFrame) -> DataFrame:
    """``virtual_slot, bytes, n_rows``."""
    return slotted.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n_rows"))


def assign(weights: dict[int, int], shards: int, slots: int = SLOTS) -> dict[int, int]:
    """The first map, slot to shard: the heaviest slot goes to the lightest shard."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for slot in sorted(range(slots), key=lambda x: (-weights.get(x, 0), x)):
        load, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (load + weights.get(slot, 0), shard))
    return out


def rebalance(now: dict[int, int], weights: dict[int, int], shards: int, slack: float = 0.02) -> dict[int, int]:
    """An edit of ``now`` for ``shards`` shards (as many or more) and new weights.

    The heaviest shard gives the lightest one the largest slot that still evens
    them out, until none is ``slack`` above the mean or no move helps; slots of
    shards that are gone move too. All other slots stay where they are.
    """
    out, load = dict(now), [0] * shards
    held: list[set[int]] = [set() for _ in range(shards)]
    homeless = []
    for slot, shard in now.items():
        if shard < shards:
            load[shard] += weights.get(slot, 0)
            held[shard].add(slot)
        else:
            homeless.append(slot)

    def move(slot: int, to: int) -> None:
        out[slot] = to
        held[to].add(slot)
        load[to] += weights.get(slot, 0)

    for slot in sorted(homeless, key=lambda x: (-weights.get(x, 0), x)):
        move(slot, min(range(shards), key=lambda s: (load[s], s)))
    mean = sum(load) / shards
    while True:
        top, low = (f(range(shards), key=lambda s: (load[s], s)) for f in (max, min))
        fits = [x for x in held[top] if 0 < weights.get(x, 0) < load[top] - load[low]]
        if load[top] <= (1 + slack) * mean or not fits:
            return out
        half = (load[top] - load[low]) / 2
        slot = min(fits, key=lambda x: (abs(weights[x] - half), x))
        held[top].remove(slot)
        load[top] -= weights[slot]
        move(slot, low)


class SlotMap:
    """Versions of the slot-to-shard map as a table: version, virtual_slot, shard.

    Each version is a file of its own in the folder; a version is never changed,
    so readers of an older one are not disturbed. One writer edits at a time.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or shared_path(spark, "slot-map")

    def _at(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def put(self, version: int, shards: dict[int, int]) -> DataFrame:
        rows = self.spark.createDataFrame(sorted(shards.items()), "virtual_slot int, shard int")
        # what a job that died left there has no _SUCCESS and no reader
        mode = "errorifexists" if version == self.newest() else "overwrite"
        rows.coalesce(1).write.mode(mode).parquet(self._at(version))
        return self.get(version)

    def newest(self) -> int | None:
        """The highest version that was written whole; None without any."""
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return None
        names = [st.getPath().getName() for st in fs.listStatus(root)]
        versions = [int(n.split("=")[1]) for n in names if n.startswith("version=")]
        whole = [v for v in versions if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self._at(v)}/_SUCCESS"))]
        return max(whole, default=None)

    def edited(self, weights: dict[int, int], shards: int, slots: int, slack: float = 0.02) -> DataFrame:
        """The map for these bytes per slot: the newest version if it is even
        enough, else an edit of it as the next one; without any, version 1."""
        last = self.newest()
        if last is None:
            return self.put(1, assign(weights, shards, slots))
        now = {r["virtual_slot"]: r["shard"] for r in self.get(last).collect()}  # a row per slot
        if len(now) != slots:
            raise ValueError(f"the map has {len(now)} slots, not {slots}: slots are fixed for good")
        new = rebalance(now, weights, shards, slack)
        return self.get(last) if new == now else self.put(last + 1, new)

    def get(self, version: int) -> DataFrame:
        return self.spark.read.schema("virtual_slot int, shard int").parquet(self._at(version))

    def history(self) -> DataFrame:
        return self.spark.read.schema("version int, virtual_slot int, shard int").parquet(self.path)


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, path: str | None = None,
) -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot, shard, slot`` per row by the map
    in ``path``: a new one, or one that is there, edited where that is needed.

    ``slot`` is the row's place in its shard, gapless from 0: the rows of the
    shard's earlier virtual slots, then its rank among those of its own. Ranks
    are taken per virtual slot, so no task holds a shard.
    """
    spark = docs.sparkSession
    rows = written(with_slots(docs.select("doc_id", "text"), slots).drop("text"), "slotted")
    per = written(slot_bytes(rows), "slot-bytes")
    weights = {r["virtual_slot"]: r["bytes"] for r in per.collect()}  # one row per slot at most
    chosen = SlotMap(spark, path).edited(weights, shards, slots)
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = per.join(chosen, "virtual_slot").select(
        "virtual_slot", "shard", F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("start"))
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "size", "text_crc32")) - 1
    # starts has a row per slot: a fixed number
    return rows.withColumn("rank", rank).join(F.broadcast(starts), "virtual_slot").select(
        "doc_id", "size", "text_crc32", "virtual_slot", "shard", (F.col("start") + F.col("rank")).cast("long").alias("slot"))
