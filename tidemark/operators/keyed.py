"""Keyed table operators: first/last per key, insert-ignore, upsert, CDC
apply, foreign-key split, dedup of unchanged readings.

Spark enforces no keys, so each constraint of the relational design is an
operator here. Every "which row wins" rule takes an explicit total order;
plain ``dropDuplicates`` (which keeps an arbitrary row) is never used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import broadcast_if_small


def _cols(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return False
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    return True


def _pick(df: DataFrame, key, order, last: bool) -> DataFrame:
    """One row per key: the one with the smallest (or largest) ``order``
    (ties broken by the other orderable columns, so the pick never depends
    on which task saw a row first).

    ``row_number() = 1`` plans a partial WindowGroupLimit before the
    exchange: every map task forwards one row per key, so a hot key costs a
    row per task on the wire, never a whole group in one task.
    """
    key, order = _cols(key), _cols(order)
    types = {f.name: f.dataType for f in df.schema.fields}
    ties = [c for c in df.columns if c not in key and c not in order and _orderable(types[c])]
    by = [F.col(c).desc() if last else F.col(c).asc() for c in order + ties]
    w = Window.partitionBy(*key).orderBy(*by)
    return df.withColumn("_pick", F.row_number().over(w)).where(F.col("_pick") == 1).drop("_pick")


def first_per_key(df: DataFrame, key, order) -> DataFrame:
    return _pick(df, key, order, last=False)


def last_per_key(df: DataFrame, key, order) -> DataFrame:
    return _pick(df, key, order, last=True)


def dedup_unchanged(ticks: DataFrame, keys: Sequence[str] = ("asset_id", "ts"),
                    order: Sequence[str] = ("ingested_at",)) -> DataFrame:
    """Keep the first poll of each unchanged source reading ``(asset_id, ts)``."""
    return first_per_key(ticks, keys, order).select(*ticks.columns)


def insert_ignore(target: DataFrame | None, source: DataFrame, key, order,
                  partition_col: str | None = None) -> DataFrame:
    """Rows of ``source`` to append to ``target`` under
    ``ON CONFLICT (key) DO NOTHING``: the first row per key by ``order`` wins
    inside the batch, and keys already stored are dropped. Replays are no-ops.

    ``partition_col`` (a function of the key, e.g. the ingest date) joins as
    an extra key so the anti join only reads the touched partitions of
    ``target`` (dynamic partition pruning when the batch side is small).
    """
    key = _cols(key)
    batch = first_per_key(source, key, order).select(*source.columns)
    if target is None:
        return batch
    on = key + ([partition_col] if partition_col else [])
    stored = target.select(*on)
    return batch.join(stored, on, "left_anti")


def upsert(target: DataFrame, source: DataFrame, key, cols: Sequence[str], now,
           order=None, created: str = "created_at", updated: str = "updated_at") -> DataFrame:
    """``INSERT .. ON CONFLICT (key) DO UPDATE``: the new state of ``target``.

    New keys are inserted with ``created = updated = now``; a matched key
    takes every column in ``cols`` from the source (a null overwrites) and
    ``updated = now`` even when nothing changed, keeping ``created``. Several
    source rows per key apply in ``order`` (the last wins); without an order
    the source must be unique per key.
    """
    key = _cols(key)
    src = source.select(*key, *cols, *(_cols(order) if order else []))
    if order is not None:
        src = last_per_key(src, key, order)
    src = src.select(*key, *cols).withColumn("_in_src", F.lit(True))
    tgt = target.withColumn("_in_tgt", F.lit(True))
    j = tgt.alias("t").join(src.alias("s"), key, "full_outer")
    n = F.lit(now).cast("timestamp")
    hit = F.col("s._in_src").isNotNull()
    out: list[Column] = [F.col(k) for k in key]
    for c in target.columns:
        if c in key:
            continue
        if c in cols:
            out.append(F.when(hit, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        elif c == created:
            out.append(F.when(F.col("t._in_tgt").isNotNull(), F.col(f"t.{c}")).otherwise(n).alias(c))
        elif c == updated:
            out.append(F.when(hit, n).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.col(f"t.{c}").alias(c))
    return j.select(*out)


def cdc_versions(current: DataFrame, changes: DataFrame, key, order: str = "lsn", op: str = "op",
                 delete_value: str = "D", tiebreak: Sequence[str] = (), tombstones: DataFrame | None = None,
                 forgotten=None) -> DataFrame:
    """L4: the newest version of every key, ``current``'s columns and ``deleted``.

    The latest change per key (by ``order``, then ``tiebreak``) replaces the
    held version whole if it is newer. Held versions are the rows of
    ``current`` and the ``tombstones(key, order)`` of deleted keys: with them
    an older change finds the delete and changes nothing, however often and in
    whatever order batches come. Tombstones up to ``forgotten`` may have been
    dropped; a change that old of a key that isn't held could be one of theirs
    and is ignored.
    """
    key = _cols(key)
    value_cols = [c for c in current.columns if c not in key and c != order]
    tb = [c for c in tiebreak if c not in value_cols]
    latest = last_per_key(changes.select(*key, order, op, *value_cols, *tb), key, [order, *tiebreak])
    held = current.withColumn("deleted", F.lit(False))
    if tombstones is not None:
        gone = tombstones.select(*key, order, F.lit(True).alias("deleted"))
        held = held.unionByName(gone, allowMissingColumns=True)
    j = held.alias("c").join(latest.alias("x"), key, "full_outer")
    unknown = F.col("c.deleted").isNull()
    newer = F.col(f"x.{order}").isNotNull() & (
        F.col(f"c.{order}").isNull() | (F.col(f"x.{order}") > F.col(f"c.{order}")))
    if forgotten is not None:
        newer = newer & (~unknown | (F.col(f"x.{order}") > F.lit(forgotten)))
    out = [F.col(k) for k in key] + [
        F.when(newer, F.col(f"x.{c}")).otherwise(F.col(f"c.{c}")).alias(c) for c in value_cols + [order]]
    deleted = F.when(newer, F.col(f"x.{op}").eqNullSafe(F.lit(delete_value))).otherwise(F.col("c.deleted"))
    return j.where(newer | ~unknown).select(*out, deleted.alias("deleted")).select(*current.columns, "deleted")


def cdc_apply(current: DataFrame, changes: DataFrame, key, order: str = "lsn",
              op: str = "op", delete_value: str = "D", tiebreak: Sequence[str] = (),
              tombstones: DataFrame | None = None) -> DataFrame:
    """L4: merge change events into current state.

    The latest change per key (by ``order``) decides: a delete removes the
    row, anything else replaces it whole. ``current`` carries ``order`` too
    (the version it reflects); a change not newer than it is ignored. The
    state alone doesn't know what was deleted: give the ``tombstones`` of
    earlier deletes too, or let :func:`tidemark.sources.store.apply_changes`
    keep both, and replaying any older batch changes nothing. ``tiebreak``
    columns order changes sharing one ``order`` value.
    """
    merged = cdc_versions(current, changes, key, order, op, delete_value, tiebreak, tombstones)
    return merged.where(~F.col("deleted")).select(*current.columns)


def fk_split(child: DataFrame, parent: DataFrame, child_key, parent_key=None,
             broadcast_bytes: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(valid, orphans)`` of ``child`` against the parent's key.

    The parent keys are broadcast only when their estimated size is within
    ``broadcast_bytes``; otherwise both semi and anti joins shuffle (and AQE
    may still broadcast from runtime sizes).
    """
    ck = _cols(child_key)
    pk = _cols(parent_key or child_key)
    keys = parent.select(*[F.col(p).alias(c) for p, c in zip(pk, ck)]).distinct()
    keys = broadcast_if_small(keys, broadcast_bytes) if broadcast_bytes else broadcast_if_small(keys)
    return child.join(keys, ck, "left_semi"), child.join(keys, ck, "left_anti")
