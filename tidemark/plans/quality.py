"""Data tests, gates and feed health over the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import quality as Q
from tidemark.plans.registry import register
from tidemark.sources import fixtures as FX
from tidemark.sources import payloads as P


@register("feed_outages", """
WITH p AS (SELECT user_id AS feed_id, ts AS polled_at, event_type <> 'error' AS ok FROM events),
c AS (SELECT *, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (
         PARTITION BY feed_id ORDER BY polled_at ROWS UNBOUNDED PRECEDING) AS c FROM p),
r AS (SELECT *, CASE WHEN ok THEN c - 1 ELSE c END AS run FROM c)
SELECT feed_id, min(polled_at) FILTER (WHERE NOT ok) AS outage_start,
       max(polled_at) FILTER (WHERE NOT ok) AS outage_end,
       count(*) FILTER (WHERE NOT ok) AS skipped_polls,
       min(polled_at) FILTER (WHERE ok) AS recovered_at
FROM r GROUP BY feed_id, run HAVING count(*) FILTER (WHERE NOT ok) > 0
""")
def feed_outages(spark, sf):
    """A5: runs of failed polls (``error`` events) per feed (``user_id``)."""
    return Q.feed_outages(FX.event_polls(spark, sf))


@register("feed_cadence", f"""
SELECT event_type AS asset_id, date_trunc('day', ts) AS period_start, count(*) AS polls,
       CAST(72.0 AS DOUBLE) AS expected, count(*) / 72.0 AS coverage,
       count(DISTINCT date_trunc('hour', ts)) AS distinct_ts,
       1.0 - count(DISTINCT date_trunc('hour', ts)) / count(*) AS stale_ratio
FROM events GROUP BY ALL
UNION ALL
SELECT asset_id, period_start, 0, 72.0, 0.0, 0, NULL FROM (
  SELECT asset_id, unnest(generate_series(lo, (SELECT date_trunc('day', max(ts)) FROM events), INTERVAL 1 DAY)) AS period_start
  FROM (SELECT event_type AS asset_id, date_trunc('day', min(ts)) AS lo FROM events GROUP BY 1))
WHERE (asset_id, period_start) NOT IN (SELECT (event_type, date_trunc('day', ts)) FROM events)
""")
def feed_cadence(spark, sf):
    """Polls per asset and day against one every 20 minutes; the source
    time frozen per hour shows as stale polls."""
    return Q.feed_cadence(FX.event_ticks(spark, sf, hourly_ts=True), interval_s=1200, period="1 day")


@register("feed_cadence_null_key", """
WITH e AS (SELECT nullif(event_type, 'error') AS asset_id, ts FROM events WHERE hour(ts) <> 9 OR event_type <> 'error'),
n AS (SELECT asset_id, date_trunc('hour', ts) AS period_start, count(*) AS polls FROM e GROUP BY ALL),
cal AS (SELECT asset_id, unnest(generate_series(lo, (SELECT max(period_start) FROM n), INTERVAL 1 HOUR)) AS period_start
        FROM (SELECT asset_id, min(period_start) AS lo FROM n GROUP BY 1))
SELECT cal.asset_id, cal.period_start, coalesce(n.polls, 0) AS polls, coalesce(n.polls, 0) / 3.0 AS coverage
FROM cal LEFT JOIN n ON n.asset_id IS NOT DISTINCT FROM cal.asset_id AND n.period_start = cal.period_start
""")
def feed_cadence_null_key(spark, sf):
    """Polls of an unknown asset (null) are counted like any other's."""
    ticks = FX.event_ticks(spark, sf).where("hour(ingested_at) <> 9 OR asset_id <> 'error'") \
        .withColumn("asset_id", F.nullif("asset_id", F.lit("error")))
    return Q.feed_cadence(ticks, interval_s=1200, period="1 hour").select("asset_id", "period_start", "polls", "coverage")


_LINE_RULES = [
    Q.not_null("l_shipdate"),
    Q.in_range("l_discount", 0.0, 0.08),
    Q.in_range("l_quantity", 1, 45, max_rate=0.2),
    Q.accepted("l_returnflag", ["A", "N", "R"]),
    Q.accepted("l_linestatus", ["O"], max_rate=0.6),
]


@register("quality_report", """
WITH a AS (
  SELECT count(*) AS total,
         count(*) FILTER (WHERE l_shipdate IS NULL) AS v0,
         count(*) FILTER (WHERE l_discount < 0.0 OR l_discount > 0.08) AS v1,
         count(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 45) AS v2,
         count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N', 'R')) AS v3,
         count(*) FILTER (WHERE l_linestatus NOT IN ('O')) AS v4
  FROM lineitem),
r AS (
  SELECT 'not_null:l_shipdate' AS rule, 'l_shipdate' AS "column", v0 AS violations, total, 0.0 AS max_rate FROM a
  UNION ALL SELECT 'range:l_discount', 'l_discount', v1, total, 0.0 FROM a
  UNION ALL SELECT 'range:l_quantity', 'l_quantity', v2, total, 0.2 FROM a
  UNION ALL SELECT 'accepted:l_returnflag', 'l_returnflag', v3, total, 0.0 FROM a
  UNION ALL SELECT 'accepted:l_linestatus', 'l_linestatus', v4, total, 0.6 FROM a)
SELECT rule, "column", violations, total, violations / total AS rate, violations / total <= max_rate AS passed
FROM r
""")
def quality_report(spark, sf):
    """Five row rules over lineitem in one aggregate pass."""
    return Q.check(FX.load(spark, sf, "lineitem"), _LINE_RULES)


@register("null_rates", """
WITH j AS (SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
a AS (SELECT count(*) AS total, count(*) FILTER (WHERE quality IS NULL) AS v0,
             count(*) FILTER (WHERE toxic IS NULL) AS v1,
             count(*) FILTER (WHERE quality NOT IN (0, 1)) AS v2 FROM j)
SELECT 'not_null:quality' AS rule, 'quality' AS "column", v0 AS violations, total,
       v0 / total AS rate, v0 / total <= 0.7 AS passed FROM a
UNION ALL SELECT 'not_null:toxic', 'toxic', v1, total, v1 / total, v1 / total <= 0.5 FROM a
UNION ALL SELECT 'accepted:quality', 'quality', v2, total, v2 / total, v2 / total <= 0.0 FROM a
""")
def null_rates(spark, sf):
    """Label coverage of the documents (null rate of each label)."""
    docs = FX.load(spark, sf, "documents").select("doc_id")
    labels = FX.load(spark, sf, "labels")
    joined = docs.join(labels, "doc_id", "left")
    return Q.check(joined, [Q.not_null("quality", 0.7), Q.not_null("toxic", 0.5),
                            Q.accepted("quality", [0, 1])])


@register("unique_violations", """
SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1
""")
def unique_violations(spark, sf):
    """Primary-key duplicates of lineitem."""
    return Q.unique_violations(FX.load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("freshness", """
SELECT event_type, max(ts) AS newest,
       (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(ts))) / 1e6 AS age_s,
       (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(ts))) / 1e6 <= 3600.0 AS fresh
FROM events GROUP BY event_type
""")
def freshness(spark, sf):
    """Newest event per type against a fixed ``now``, one hour allowed."""
    ev = FX.load(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return Q.freshness(ev, "ts", "2024-01-31 00:00:00", 3600, by=["event_type"])


_ORDER_RULES = [
    Q.in_range("o_totalprice", 1000.0, 450000.0),
    Q.accepted("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]),
    Q.accepted("o_orderstatus", ["F", "O"]),
]


@register("quarantine_rows", """
SELECT o_orderkey, concat_ws(',',
         CASE WHEN o_totalprice < 1000.0 OR o_totalprice > 450000.0 THEN 'range:o_totalprice' END,
         CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')
              THEN 'accepted:o_orderpriority' END,
         CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'accepted:o_orderstatus' END) AS reasons
FROM orders
WHERE o_totalprice < 1000.0 OR o_totalprice > 450000.0
   OR o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')
   OR o_orderstatus NOT IN ('F', 'O')
""")
def quarantine_rows(spark, sf):
    """Orders failing a row rule, with every reason."""
    _, rejects = Q.quarantine(FX.load(spark, sf, "orders"), _ORDER_RULES)
    return rejects.select("o_orderkey", F.concat_ws(",", "reasons").alias("reasons"))


@register("accepted_values", """
SELECT 'accepted:o_orderstatus' AS rule, 'o_orderstatus' AS "column",
       count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS violations, count(*) AS total,
       count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) / count(*) AS rate,
       count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) = 0 AS passed
FROM orders
""")
def accepted_values(spark, sf):
    """Order status restricted to F and O."""
    return Q.check(FX.load(spark, sf, "orders"), [Q.accepted("o_orderstatus", ["F", "O"])])


@register("reconcile_totals", """
WITH l AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n, sum(CAST(value AS DECIMAL(38, 6))) AS s
           FROM events GROUP BY 1),
r AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n, sum(CAST(value AS DECIMAL(38, 6))) AS s
      FROM events WHERE event_type <> 'error' AND value <= 480 GROUP BY 1)
SELECT coalesce(l.day, r.day) AS day, coalesce(l.n, 0) AS left_rows, coalesce(r.n, 0) AS right_rows,
       CAST(coalesce(l.s, 0) AS DOUBLE) AS left_value, CAST(coalesce(r.s, 0) AS DOUBLE) AS right_value,
       CAST(coalesce(l.s, 0) - coalesce(r.s, 0) AS DOUBLE) AS diff_value
FROM l FULL OUTER JOIN r ON l.day IS NOT DISTINCT FROM r.day
WHERE coalesce(l.n, 0) <> coalesce(r.n, 0) OR abs(coalesce(l.s, 0) - coalesce(r.s, 0)) > 0
""")
def reconcile_totals(spark, sf):
    """Bronze (landed polls) against silver (parsed ticks) per day."""
    bronze = FX.load(spark, sf, "events").select(
        F.to_date("ts").alias("day"), F.col("value"))
    silver = P.parse_prices(FX.event_price_payloads(spark, sf)).select(
        F.to_date("ingested_at").alias("day"), F.col("price").alias("value"))
    return Q.reconcile(bronze, silver, ["day"], ["value"])


_VOLUME_SQL = """
WITH n AS (SELECT event_type, date_trunc('day', ts) AS period, count(*) AS n FROM events GROUP BY ALL),
span AS (SELECT event_type, min(period) AS lo, (SELECT max(period) FROM n) AS hi FROM n GROUP BY event_type),
cal AS (SELECT event_type, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS period FROM span),
f AS (SELECT cal.event_type, cal.period, coalesce(n.n, 0) AS n
      FROM cal LEFT JOIN n ON cal.event_type = n.event_type AND cal.period = n.period),
w AS (SELECT *, avg(n) OVER h AS mean, stddev_pop(n) OVER h AS stddev, count(*) OVER h AS hist
      FROM f WINDOW h AS (PARTITION BY event_type ORDER BY period ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT event_type, period, n, round(mean, 9) AS mean, round(stddev, 9) AS stddev,
       round(CASE WHEN stddev > 0 THEN (n - mean) / stddev END, 9) AS z,
       hist >= 7 AND CASE WHEN stddev > 0 THEN abs(n - mean) > 2.0 * stddev ELSE n <> mean END AS anomaly
FROM w
"""


@register("volume_anomaly", _VOLUME_SQL)
def volume_anomaly(spark, sf):
    """Events per type and day against the 7 days before, k = 2."""
    ev = FX.load(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = Q.volume_anomaly(ev, "ts", "day", 7, 2.0, by=["event_type"])
    return out.select(*[F.round(c, 9).alias(c) if c in ("mean", "stddev", "z") else F.col(c)
                        for c in out.columns])


@register("volume_anomaly_null_key", _VOLUME_SQL.replace("FROM events", "FROM (SELECT ts, nullif(event_type, 'error') AS event_type FROM events) e")
          .replace("cal.event_type = n.event_type", "cal.event_type IS NOT DISTINCT FROM n.event_type"))
def volume_anomaly_null_key(spark, sf):
    """Rows without a key have a volume of their own, not silence."""
    ev = FX.load(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp")) \
        .withColumn("event_type", F.nullif("event_type", F.lit("error")))
    out = Q.volume_anomaly(ev, "ts", "day", 7, 2.0, by=["event_type"])
    return out.select(*[F.round(c, 9).alias(c) if c in ("mean", "stddev", "z") else F.col(c)
                        for c in out.columns])


_EDGES = [50.0, 100.0, 150.0, 200.0, 250.0, 300.0, 400.0]


@register("distribution_drift", """
WITH b AS (SELECT date_trunc('week', ts) AS period,
                  (value >= 50.0)::INT + (value >= 100.0)::INT + (value >= 150.0)::INT + (value >= 200.0)::INT
                  + (value >= 250.0)::INT + (value >= 300.0)::INT + (value >= 400.0)::INT AS bin
           FROM events),
h AS (SELECT period, bin, count(*) AS c FROM b GROUP BY ALL),
per AS (SELECT DISTINCT period FROM h),
f AS (SELECT per.period, bins.bin, coalesce(h.c, 0) AS c
      FROM per CROSS JOIN (SELECT unnest(range(0, 8)) AS bin) bins
      LEFT JOIN h ON h.period = per.period AND h.bin = bins.bin),
p AS (SELECT period, bin, c, (c + 0.5) / (sum(c) OVER (PARTITION BY period) + 0.5 * 8) AS p FROM f),
q AS (SELECT bin, p AS q FROM p WHERE period = TIMESTAMP '2024-01-01')
SELECT period, round(sum((p - q) * ln(p / q)), 9) AS psi, CAST(sum(c) AS BIGINT) AS rows
FROM p JOIN q USING (bin) GROUP BY period
""")
def distribution_drift(spark, sf):
    """Weekly histogram of event values against the first week (PSI)."""
    ev = FX.load(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = Q.drift(ev, "value", F.date_trunc("week", "ts"), "2024-01-01 00:00:00", _EDGES)
    return out.select("period", F.round("psi", 9).alias("psi"), F.col("rows").cast("long"))


@register("integrity_report", """
SELECT 'references:l_orderkey' AS test, 'l_orderkey' AS "column", count(*) AS violations
FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus <> 'P')
UNION ALL
SELECT 'references:l_partkey', 'l_partkey', count(*) FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)
UNION ALL
SELECT 'accepted:l_returnflag', 'l_returnflag', count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N'))
FROM lineitem
""")
def integrity_report(spark, sf):
    """Line items against their orders (pending ones removed) and parts,
    and the return flag restricted to A and N."""
    li = FX.load(spark, sf, "lineitem")
    orders = FX.load(spark, sf, "orders").where(F.col("o_orderstatus") != "P")
    parts = FX.load(spark, sf, "part")
    return Q.integrity(li, [("l_orderkey", orders, "o_orderkey"), ("l_partkey", parts, "p_partkey")],
                       {"l_returnflag": ["A", "N"]})
