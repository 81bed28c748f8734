"""Keyed table operators over the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import keyed as K
from tidemark.plans.registry import register
from tidemark.sources import store as S
from tidemark.sources.fixtures import event_ticks, load, sql_ticks

# Every lineitem row is distinct on these, so "first" is fully determined.
LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
SPLIT = "1998-01-01"


@register("dedup_unchanged", f"""
SELECT asset_id, ts, ingested_at, price, volume_24h, market_cap, change_24h
FROM ({sql_ticks(True)}) t
QUALIFY row_number() OVER (PARTITION BY asset_id, ts ORDER BY ingested_at) = 1
""")
def dedup_unchanged(spark, sf):
    """One tick per unchanged source reading (first poll wins)."""
    return K.dedup_unchanged(event_ticks(spark, sf, hourly_ts=True))


@register("insert_ignore", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY {", ".join(LINE_ORDER)}) AS rn
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '{SPLIT}') s
WHERE rn = 1 AND NOT EXISTS (
  SELECT 1 FROM lineitem t WHERE t.l_shipdate < TIMESTAMP '{SPLIT}'
   AND t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber)
""")
def insert_ignore(spark, sf):
    """Lines shipped from 1998 appended to the table of earlier lines
    under ON CONFLICT DO NOTHING (first row per key wins in the batch)."""
    li = load(spark, sf, "lineitem")
    stored = K.first_per_key(li.where(F.col("l_shipdate") < F.lit(SPLIT).cast("timestamp_ntz")),
                             LINE_KEY, LINE_ORDER)
    batch = li.where(F.col("l_shipdate") >= F.lit(SPLIT).cast("timestamp_ntz"))
    return K.insert_ignore(stored, batch, LINE_KEY, LINE_ORDER).select(*li.columns)


_CUST_COLS = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _customer_versions(spark, sf):
    c = load(spark, sf, "customer")
    target = (c.where(F.col("c_acctbal") < 6000)
               .withColumn("created_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
               .withColumn("updated_at", F.lit("2024-01-01 00:00:00").cast("timestamp")))
    changed = c.where(F.col("c_acctbal") >= 3000).select(
        "c_custkey", F.lower("c_name").alias("c_name"), "c_nationkey",
        (F.col("c_acctbal") + 1.0).alias("c_acctbal"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("c_mktsegment"),
        F.lit(1).alias("seq"))
    again = (changed.where(F.col("c_nationkey") == 3)
             .withColumn("c_acctbal", F.col("c_acctbal") + 1.0).withColumn("seq", F.lit(2)))
    return target, changed.unionByName(again)


@register("asset_upsert", """
WITH t AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
           FROM customer WHERE c_acctbal < 6000),
s1 AS (SELECT c_custkey, lower(c_name) AS c_name, c_nationkey, c_acctbal + 1.0 AS c_acctbal,
              CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS c_mktsegment, 1 AS seq
       FROM customer WHERE c_acctbal >= 3000
       UNION ALL
       SELECT c_custkey, lower(c_name), c_nationkey, c_acctbal + 1.0 + 1.0,
              CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END, 2
       FROM customer WHERE c_acctbal >= 3000 AND c_nationkey = 3),
s AS (SELECT * FROM s1 QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY seq DESC) = 1)
SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_name ELSE t.c_name END AS c_name,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_nationkey ELSE t.c_nationkey END AS c_nationkey,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment,
       CASE WHEN t.c_custkey IS NOT NULL THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-02-01' END AS created_at,
       CASE WHEN s.c_custkey IS NOT NULL THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-01-01' END AS updated_at
FROM t FULL OUTER JOIN s ON t.c_custkey = s.c_custkey
""")
def asset_upsert(spark, sf):
    """Overlapping customer versions upserted; the latest version per key
    wins, a null overwrites, ``created_at`` is kept on update."""
    target, source = _customer_versions(spark, sf)
    return K.upsert(target, source, "c_custkey", _CUST_COLS, "2024-02-01 00:00:00", order="seq")


_DESC = ", ".join(f"{c} DESC" for c in ["l_linenumber"] + LINE_ORDER)


_CDC_SQL = f"""
WITH cur AS (SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(0 AS BIGINT) AS lsn
             FROM orders WHERE o_orderstatus <> 'P'),
x AS (SELECT l_orderkey AS o_orderkey, l_linestatus AS o_orderstatus, l_extendedprice AS o_totalprice,
             CAST(l_linenumber AS BIGINT) AS lsn,
             CASE WHEN l_returnflag = 'R' THEN 'D' ELSE 'U' END AS op
      FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {_DESC}) = 1),
j AS (SELECT cur.o_orderkey AS ck, cur.o_orderstatus AS cs, cur.o_totalprice AS cp, cur.lsn AS cl,
             x.*, (x.o_orderkey IS NOT NULL AND (cur.o_orderkey IS NULL OR x.lsn > cur.lsn)) AS newer
      FROM cur FULL OUTER JOIN x ON cur.o_orderkey = x.o_orderkey)
SELECT coalesce(ck, o_orderkey) AS o_orderkey,
       CASE WHEN newer THEN o_orderstatus ELSE cs END AS o_orderstatus,
       CASE WHEN newer THEN o_totalprice ELSE cp END AS o_totalprice,
       CASE WHEN newer THEN lsn ELSE cl END AS lsn
FROM j WHERE (newer AND op <> 'D') OR (NOT newer AND ck IS NOT NULL)
"""


def _cdc(spark, sf):
    """Orders that aren't pending at lsn 0, and line items read as change events."""
    orders = load(spark, sf, "orders")
    current = (orders.where(F.col("o_orderstatus") != "P")
               .select("o_orderkey", "o_orderstatus", "o_totalprice", F.lit(0).cast("long").alias("lsn")))
    li = load(spark, sf, "lineitem")
    changes = li.select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_linestatus").alias("o_orderstatus"),
        F.col("l_extendedprice").alias("o_totalprice"), F.col("l_linenumber").cast("long").alias("lsn"),
        F.when(F.col("l_returnflag") == "R", F.lit("D")).otherwise(F.lit("U")).alias("op"),
        *LINE_ORDER)
    return current, changes


@register("cdc_apply", _CDC_SQL)
def cdc_apply(spark, sf):
    """L4: line items read as change events of their order (``R`` = delete)."""
    current, changes = _cdc(spark, sf)
    return K.cdc_apply(current, changes, "o_orderkey", "lsn", tiebreak=LINE_ORDER)


@register("cdc_replay", _CDC_SQL)
def cdc_replay(spark, sf):
    """L4 on a stored table: inserts, then the newest changes, then the older
    ones and both again. Deleted orders stay deleted, whatever comes late."""
    current, changes = _cdc(spark, sf)
    inserts = current.select("*", F.lit("I").alias("op"), *[
        F.lit(None).cast(changes.schema[c].dataType).alias(c) for c in LINE_ORDER])
    old, new = changes.where("lsn <= 3"), changes.where("lsn > 3")
    path = S.scratch_path(spark, "cdc")
    for batch in (inserts, new, old, new, old.unionByName(inserts)):
        S.apply_changes(spark, path, batch, "o_orderkey", "lsn", tiebreak=LINE_ORDER)
    return spark.read.parquet(f"{path}/{S.ROWS}")


@register("fk_orphans", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus <> 'P')
""")
def fk_orphans(spark, sf):
    """Line items whose order is missing once pending orders are removed."""
    parent = load(spark, sf, "orders").where(F.col("o_orderstatus") != "P")
    child = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    _, orphans = K.fk_split(child, parent, "l_orderkey", "o_orderkey")
    return orphans
