"""The registered queries of this subpackage: thin digests of its operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat,
    decontaminate,
    jaccard,
    lm_scores,
    mixing,
    periodic,
    quality_fm,
    quality_rules,
    resample,
    sharding,
    simhash,
    toxicity,
    warc,
)
from tidemark.llm.common import shared_path, table
from tidemark.llm.labelled import fold

Query = Callable[[SparkSession, str], DataFrame]


def op1_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the sources' weights by balanced sampling."""
    mixed = mixing.cube_mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes and components of all documents by shared 5-word shingles."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op3_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents by the factorisation machine."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality_fm.score_documents(docs, labels)
    return scored.select(
        "doc_id", (fold("doc_id", quality_fm.FOLDS) == quality_fm.HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= quality_fm.THRESHOLD).cast("int").alias("predicted"))


def op4_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents under the n-gram counts of all documents."""
    return lm_scores.lm_scores(table(spark, sf_dir, "documents"))


def op5_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents judged by thresholds of their language and source."""
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_upper")


def op6_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives and read back."""
    path = shared_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.read_warc(spark, path, warc.page_digest, warc.PAGE).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_edit_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a copy of a benchmark item, with the edits."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted and read back."""
    odd = "\\### Assistant: </turn> ok"
    more = spark.sql("SELECT -7L AS conv_id, t.* FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.union(more.withColumn("text", F.lit(odd)))
    back = chat.read_chats(chat.format_chats(rows.withColumn("parts", chat.text_part(F.col("text")))))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


def op9_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards by bytes, through virtual slots."""
    return sharded(table(spark, sf_dir, "documents"))


def sharded(docs: DataFrame) -> DataFrame:
    return sharding.shard_documents(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def op10_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents by the counterfactual-regularised classifier."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score_documents(docs.select("doc_id", "text"), labels)
    return scored.select(
        "doc_id", (fold("doc_id", toxicity.FOLDS) == toxicity.HELD_OUT).alias("held_out"), "score",
        toxicity.toxic().cast("int").alias("predicted"))


def op11_simhash_vp_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by fingerprints at two differing bits or fewer."""
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op12_synchronising_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of all documents, of which every tenth repeats its tail."""
    docs = with_periodic_tails(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic.collapse(docs)
    said = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n")))
    # the runs are in order: a later one only wins by a greater exponent, compared by cross products
    best = F.expr("""
        reduce(runs, CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>),
               (b, r) -> IF(b IS NULL OR r.length * b.period > b.length * r.period, r, b))""")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(said, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """``docs`` where the words of each text whose doc_id has a crc32 divisible
    by ten repeat from some word on: h = crc32, g = h / 10, of n words those
    from a = g % n with period 1 + (n - a) / (3 + g % 8). Rows without doc_id or
    words stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")
    tail = "transform(sequence(0L, n - a - 1L), i -> w[INT(a + i % (1L + (n - a) DIV (3L + g % 8L)))])"
    # w, and so all that comes of it, is null for rows that stay
    return (
        docs.withColumn("w", F.when(h % 10 == 0, words)).withColumn("w", F.when(F.size("w") > 0, F.col("w")))
        .withColumn("g", F.floor(h / 10)).withColumn("n", F.expr("CAST(size(w) AS BIGINT)"))
        .withColumn("a", F.expr("g % n"))
        .withColumn("text", F.when(F.col("w").isNull(), F.col("text")).otherwise(
            F.array_join(F.concat(F.expr("slice(w, 1, INT(a))"), F.expr(tail)), " ")))
        .select(docs.columns)
    )


def op13_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of all documents, drawn towards the benchmark's words, with ranks."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_cube_mix, op2_ngram_jaccard_join, op3_quality_fm, op4_stupid_backoff, op5_adaptive_rules,
        op6_warc_chain, op7_edit_decontamination, op8_chat_parts, op9_virtual_slots, op10_counterfactual_toxicity,
        op11_simhash_vp_trees, op12_synchronising_runs, op13_importance_resample,
    )
}

OP5_SQL = r"""
WITH t AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t
), pos AS (
  SELECT r, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM w
), tri AS (
  SELECT r, i, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c FROM pos WINDOW o AS (PARTITION BY r ORDER BY i)
), often AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM tri WHERE c IS NOT NULL
), rep AS (
  SELECT r, count(DISTINCT j) AS n_repeat_words
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM often WHERE n > 1) GROUP BY r
), c AS (
  SELECT r, doc_id, lang, source, len(ws)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
         length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_upper
  FROM w LEFT JOIN rep USING (r)
), j AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         1000 * n_symbols // greatest(n_words, 1) AS symbols, 1000 * n_dup_lines // greatest(n_lines, 1) AS dup_lines,
         1000 * n_repeat_words // greatest(n_words, 1) AS repeats, 1000 * n_upper // greatest(word_chars, 1) AS upper_,
         100 * word_chars // greatest(n_words, 1) AS word_length
  FROM c
), m AS (
  UNPIVOT (SELECT r, lang, source, symbols, dup_lines, repeats, upper_, word_length FROM j WHERE NOT base_failed)
  ON symbols, dup_lines, repeats, upper_, word_length INTO NAME metric VALUE v
), b AS (
  SELECT lang, source, metric, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS bin FROM m
), w2 AS (
  SELECT metric, bin, sum(n) OVER (PARTITION BY metric ORDER BY bin) AS c2, sum(n) OVER (PARTITION BY metric) AS n2
  FROM (SELECT metric, bin, count(*) AS n FROM b GROUP BY ALL)
), w1 AS (
  SELECT l.lang, w2.metric, w2.bin, w2.c2, w2.n2, l.n1,
         sum(coalesce(x.n, 0)) OVER (PARTITION BY l.lang, w2.metric ORDER BY w2.bin) AS c1
  FROM (SELECT lang, metric, count(*) AS n1 FROM b GROUP BY ALL) l JOIN w2 ON w2.metric = l.metric
  LEFT JOIN (SELECT lang, metric, bin, count(*) AS n FROM b GROUP BY ALL) x
    ON x.lang IS NOT DISTINCT FROM l.lang AND x.metric = l.metric AND x.bin = w2.bin
), w0 AS (
  SELECT g.lang, g.source, w1.metric, w1.bin, w1.c2, w1.n2, w1.c1, w1.n1, g.n0,
         sum(coalesce(x.n, 0)) OVER (PARTITION BY g.lang, g.source, w1.metric ORDER BY w1.bin) AS c0
  FROM (SELECT lang, source, metric, count(*) AS n0 FROM b GROUP BY ALL) g
  JOIN w1 ON w1.lang IS NOT DISTINCT FROM g.lang AND w1.metric = g.metric
  LEFT JOIN (SELECT lang, source, metric, bin, count(*) AS n FROM b GROUP BY ALL) x
    ON x.lang IS NOT DISTINCT FROM g.lang AND x.source IS NOT DISTINCT FROM g.source AND x.metric = g.metric AND x.bin = w1.bin
), f AS (
  SELECT * FROM (VALUES ('symbols', 25, false), ('dup_lines', 50, false), ('repeats', 50, false),
                        ('upper_', 20, false), ('word_length', 40, true)) AS f(metric, least_, below)
), s0 AS (
  SELECT *, 4 * (c0::HUGEINT * (n1 + 100) * n2 + 100 * (c1::HUGEINT * n2 + 100 * c2)) AS upto,
         (n0 + 100)::HUGEINT * (n1 + 100) * n2 AS total FROM w0
), lim AS (
  SELECT lang, source, s0.metric, below, least_,
         [min(bin) FILTER (upto >= total), min(bin) FILTER (upto >= 2 * total), min(bin) FILTER (upto >= 3 * total)] AS q
  FROM s0 JOIN f ON f.metric = s0.metric GROUP BY ALL
), v AS (
  SELECT m.r, bool_and(m.v <= q[2] + 8 * greatest(q[3] - q[2], least_)
                       AND (NOT below OR m.v >= q[2] - 8 * greatest(q[2] - q[1], least_))) AS ok
  FROM m JOIN lim ON m.metric = lim.metric AND m.lang IS NOT DISTINCT FROM lim.lang
                 AND m.source IS NOT DISTINCT FROM lim.source
  GROUP BY m.r
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(ok, false) AS kept, n_lines, n_upper
FROM j LEFT JOIN v USING (r)
"""

OP8_SQL = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), c AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(length('<|turn|><|text|><|end|>')
             + length(replace(replace(role, '\', '\\'), '<|', '<\|'))
             + length(replace(replace(text, '\', '\\'), '<|', '<\|'))) AS formatted_chars
  FROM rows_ GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars::BIGINT AS formatted_chars
FROM c
"""

#: DuckDB SQL where it can express a query.
ORACLES: dict[str, str] = {
    "op5_adaptive_rules": OP5_SQL.strip(),
    "op8_chat_parts": OP8_SQL.strip(),
}
