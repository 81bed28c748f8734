"""Privacy, marts, KPIs and bus records over the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import partitions_for
from tidemark.operators import marts as M
from tidemark.operators import privacy as PV
from tidemark.plans.registry import register
from tidemark.sources import fixtures as FX
from tidemark.sources import store as S

_PART_BYTES = 1024 * 1024  # of stored lines, for a task of the facts by order


def _mask_sql(column: str, table: str) -> str:
    """The masks one after the other; of card candidates those that check."""
    x, steps = column, []
    for kind, pattern, repl in PV.PII_PATTERNS:
        if kind != "card":
            x = f"regexp_replace({x}, '{pattern}', '{repl}', 'g')"
            continue
        steps.append((x, pattern, repl))
        x = "masked"
    (before, pattern, repl), edge = steps[0], "chr(63743) || chr(57344) || chr(63743)"
    return f"""
WITH a AS (SELECT *, {before} AS _t FROM {table}),
b AS (SELECT *, string_split(regexp_replace(_t, '({pattern})', {edge} || '\\1' || {edge}, 'g'), {edge}) AS _p FROM a),
c AS (
  SELECT *, list_transform(_p, lambda x, i: CASE WHEN i % 2 = 0 AND len(regexp_replace(x, '[ -]', '', 'g')) BETWEEN 13 AND 19
    AND list_sum(list_transform(string_split(reverse(regexp_replace(x, '[ -]', '', 'g')), ''),
          lambda d, j: CASE WHEN j % 2 = 1 THEN CAST(d AS INT)
                            ELSE 2 * CAST(d AS INT) - CASE WHEN CAST(d AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0
    THEN '{repl}' ELSE x END) AS _m FROM b
), d AS (SELECT *, CASE WHEN _t IS NULL THEN NULL ELSE array_to_string(_m, '') END AS masked FROM c)
SELECT doc_id, {x} AS text FROM d
"""


@register("mask_pii", _mask_sql("text", "documents"))
def mask_pii(spark, sf):
    """E-mails, phones, card numbers and IPs masked in every document."""
    return PV.mask(FX.load(spark, sf, "documents").select("doc_id", "text"), ["text"])


_NUMBERS = """(SELECT doc_id, 'pay ' || CASE doc_id % 6
  WHEN 0 THEN '4111 1111 1111 1111' WHEN 1 THEN '4111-1111-1111-1111' WHEN 2 THEN '4111111111111112'
  WHEN 3 THEN '12341234123412341234123' WHEN 4 THEN '3782 822463 10005' ELSE '(555) 123-4567' END
  || ' or ' || (4000000000000000 + 7919 * doc_id) || ', call +49 30 123 4567' AS text FROM documents)"""


@register("mask_numbers", _mask_sql("text", _NUMBERS))
def mask_numbers(spark, sf):
    """Grouped and plain card numbers, of which the check digit decides,
    long ids, and national phone numbers."""
    FX.load(spark, sf, "documents").select("doc_id").createOrReplaceTempView("tidemark_mask_numbers")
    said = spark.sql("SELECT * FROM " + _NUMBERS.replace("FROM documents", "FROM tidemark_mask_numbers"))
    return PV.mask(said, ["text"])


@register("tokenise", """
SELECT c_custkey, sha256('s3cr3t-salt' || c_name) AS c_name, c_nationkey FROM customer
""")
def tokenise(spark, sf):
    """Customer names replaced by salted SHA-256 tokens."""
    c = FX.load(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    return PV.tokenise(c, ["c_name"], "s3cr3t-salt")


@register("erase_subjects", """
SELECT doc_id, lang, source, n_chars FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)
""")
def erase_subjects(spark, sf):
    """Documents of the subjects listed (labels marked toxic) erased."""
    docs = FX.load(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    subjects = FX.load(spark, sf, "labels").where(F.col("toxic") == 1)
    return PV.erase(docs, subjects, "doc_id")


@register("entitled_view", """
SELECT c_custkey, sha256('s3cr3t-salt' || c_name) AS c_name, c_nationkey, c_mktsegment FROM customer
""")
def entitled_view(spark, sf):
    """A reader entitled to ``segment`` data only: names tokenised,
    balances (restricted) absent."""
    c = FX.load(spark, sf, "customer")
    tags = {"c_name": "pii", "c_acctbal": "restricted", "c_mktsegment": "segment"}
    return PV.entitled_view(c, tags, ["segment"], "s3cr3t-salt")


def _star(spark, sf, by_order=False):
    li = FX.load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    if by_order:  # for aggregates per order, which need no other exchange then
        li = li.repartition(partitions_for(li, _PART_BYTES), "l_orderkey")
    orders = FX.load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = FX.load(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = FX.load(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    region = FX.load(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return M.star_join(li, [
        (orders.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey", "inner"),
        (cust.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey", "inner"),
        (nation, "c_nationkey", "inner"),
        (region, "n_regionkey", "inner"),
    ])


_STAR_SQL = """
SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice * (1 - l.l_discount) AS revenue,
       o.o_orderdate, c.c_mktsegment, n.n_name, r.r_name
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""


@register("star_join", _STAR_SQL)
def star_join(spark, sf):
    """Line items joined to orders, customers, nations and regions."""
    return _revenues(_star(spark, sf))


def _revenues(star):
    return star.select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
        "o_orderdate", "c_mktsegment", "n_name", "r_name")


def _order_facts(spark, sf):
    """The star's lines dealt by order, in as many parts as their size asks for."""
    return _revenues(_star(spark, sf, by_order=True)).withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))


@register("enrich", """
SELECT o.o_orderkey, o.o_totalprice, c.c_mktsegment, c.c_nationkey
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
""")
def enrich(spark, sf):
    """C4: orders enriched with their customer's segment and nation."""
    orders = FX.load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    cust = FX.load(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    return M.enrich(orders, cust, "o_custkey", "left").select(
        "o_orderkey", "o_totalprice", "c_mktsegment", "c_nationkey")


def _kpi_defs():
    return [
        M.Kpi("revenue", 2, "finance", F.sum(F.col("revenue").cast("decimal(38,6)"))),
        M.Kpi("order_lines", 1, "operations", F.count(F.lit(1))),
        M.Kpi("orders", 1, "operations", F.count_distinct("l_orderkey")),
        M.Kpi("max_line_revenue", 1, "finance", F.max("revenue")),
    ]


@register("kpis", f"""
WITH s AS ({_STAR_SQL}),
a AS (SELECT r_name, date_trunc('year', o_orderdate) AS year,
             CAST(sum(CAST(revenue AS DECIMAL(38, 6))) AS DOUBLE) AS k0, CAST(count(*) AS DOUBLE) AS k1,
             CAST(count(DISTINCT l_orderkey) AS DOUBLE) AS k2, max(revenue) AS k3
      FROM s GROUP BY ALL)
SELECT r_name, year, 'revenue' AS kpi, 2 AS version, 'finance' AS owner, k0 AS value FROM a
UNION ALL SELECT r_name, year, 'order_lines', 1, 'operations', k1 FROM a
UNION ALL SELECT r_name, year, 'orders', 1, 'operations', k2 FROM a
UNION ALL SELECT r_name, year, 'max_line_revenue', 1, 'finance', k3 FROM a
""")
def kpis(spark, sf):
    """Four named, versioned KPIs per region and order year in one pass."""
    facts = _order_facts(spark, sf)
    return M.kpis(facts, _kpi_defs(), [F.col("r_name"), F.date_trunc("year", "o_orderdate").alias("year")])


@register("kpi_report", f"""
WITH s AS ({_STAR_SQL}),
m AS (SELECT r_name, date_trunc('month', o_orderdate) AS period,
             CAST(sum(CAST(revenue AS DECIMAL(38, 6))) AS DOUBLE) AS k0, CAST(count(*) AS DOUBLE) AS k1
      FROM s GROUP BY ALL),
y AS (SELECT r_name, date_trunc('year', o_orderdate) AS period,
             CAST(count(DISTINCT l_orderkey) AS DOUBLE) AS k2 FROM s GROUP BY ALL)
SELECT r_name, 'month' AS grain, period, 'revenue' AS kpi, 2 AS version, 'finance' AS owner, k0 AS value FROM m
UNION ALL SELECT r_name, 'month', period, 'order_lines', 1, 'operations', k1 FROM m
UNION ALL SELECT r_name, 'year', period, 'orders', 1, 'operations', k2 FROM y
""")
def kpi_report(spark, sf):
    """A KPI registry with per-KPI grains (monthly revenue and lines,
    yearly orders) per region, one aggregate pass per grain."""
    facts = _order_facts(spark, sf)
    defs = [
        M.Kpi("revenue", 2, "finance", M.Measure("sum", F.col("revenue").cast("decimal(38,6)")), "month"),
        M.Kpi("order_lines", 1, "operations", M.Measure("count"), "month"),
        M.Kpi("orders", 1, "operations", M.Measure("distinct", F.col("l_orderkey")), "year"),
    ]
    return M.kpi_report(facts, defs, "o_orderdate", by=["r_name"])


@register("kpi_rollup", f"""
WITH s AS ({_STAR_SQL}),
g AS (SELECT r_name, 'month' AS grain, date_trunc('month', o_orderdate) AS period, * EXCLUDE (r_name) FROM s
      UNION ALL SELECT r_name, 'year', date_trunc('year', o_orderdate), * EXCLUDE (r_name) FROM s),
a AS (SELECT r_name, grain, period, CAST(sum(CAST(revenue AS DECIMAL(38, 6))) AS DOUBLE) AS revenue,
             CAST(count(*) AS DOUBLE) AS order_lines, max(revenue) AS largest, min(revenue) AS smallest FROM g GROUP BY ALL)
SELECT r_name, grain, period, revenue, order_lines, largest, smallest, true AS orders_near FROM a
""")
def kpi_rollup(spark, sf):
    """Partial states per region and day written once from the facts; the
    monthly and yearly KPIs come from them. Distinct orders are a sketch, held
    against the exact count: within 5 percent (three standard errors)."""
    facts = star_join(spark, sf).withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    measures = {
        "revenue": M.Measure("sum", F.col("revenue").cast("decimal(38,6)")), "order_lines": M.Measure("count"),
        "largest": M.Measure("max", F.col("revenue")), "smallest": M.Measure("min", F.col("revenue")),
        "orders": M.Measure("distinct", F.col("l_orderkey"))}
    path = S.scratch_path(spark, "kpi-states")
    M.kpi_states(facts, measures, "o_orderdate", ["r_name"]).write.parquet(path)
    parts = []
    for grain in ("month", "year"):
        got = M.kpi_rollup(spark.read.parquet(path), measures, grain, ["r_name"])
        exact = facts.groupBy("r_name", F.date_trunc(grain, "o_orderdate").alias("period")).agg(
            F.count_distinct("l_orderkey").alias("exact"))
        parts.append(got.join(exact, ["r_name", "period"]).withColumn("grain", F.lit(grain)))
    out = parts[0].unionByName(parts[1])
    near = F.abs(F.col("orders") - F.col("exact")) <= 0.05 * F.col("exact") + 1
    return out.select("r_name", "grain", "period", F.col("revenue").cast("double").alias("revenue"),
                      F.col("order_lines").cast("double").alias("order_lines"), "largest", "smallest",
                      near.alias("orders_near"))


@register("bus_records", """
SELECT CAST(event_id AS VARCHAR) AS key, event_type, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM events
""")
def bus_records(spark, sf):
    """Events published as (key, JSON value) records, read back by field."""
    recs = M.to_bus(FX.load(spark, sf, "events"), "event_id")
    fields = recs.select("key", F.json_tuple("value", "event_type", "value", "props")
                         .alias("event_type", "value", "props"))  # one parse per record
    return fields.select("key", "event_type", F.col("value").cast("double").alias("value"),
                         F.get_json_object("props", "$.k").cast("long").alias("k"))


@register("gold_marts", """
WITH t AS (SELECT event_type AS asset_id, ts AS ingested_at, value AS price,
                  nullif(CAST(json_extract_string(props, '$.k') AS DOUBLE), 0) AS volume_24h FROM events),
c AS (SELECT asset_id, date_trunc('day', ingested_at) AS bucket,
             arg_min_null(price, ingested_at) AS open, max(price) AS high, min(price) AS low,
             arg_max_null(price, ingested_at) AS close,
             arg_max_null(volume_24h, ingested_at) AS volume_24h, count(*) AS ticks
      FROM t GROUP BY ALL)
SELECT c.*, upper(substr(asset_id, 1, 3)) AS symbol, upper(substr(asset_id, 1, 1)) || substr(asset_id, 2) AS name
FROM c
""")
def gold_marts(spark, sf):
    """L3: daily candles of the gold layer with the asset dimension attached."""
    ticks = FX.event_ticks(spark, sf)
    assets = ticks.select(F.col("asset_id").alias("id")).distinct().select(
        "id", F.upper(F.substring("id", 1, 3)).alias("symbol"), F.initcap("id").alias("name"))
    return M.build_marts(ticks, assets, "1 hour", ("day",))["candles_day"]
