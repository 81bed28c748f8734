"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Each text gets a few counts; their rates per thousand are the metrics. A sketch
is a log-linear histogram: an integer keeps its six leading bits, so a bin is
right to about 3 %, sketches merge by adding bins in any order, and a lost task
or a rerun gives the same sketch. There is one per (language, source), merged
into one per language and one overall; a group's sketch takes a fixed weight of
its language's and that of all, which falls smoothly against its own as it grows,
so no size of a group is treated apart. Thresholds
lie ``factor`` spreads from the median, a spread being the distance of the
quartile or the metric's ``least`` one, and are joined back to the documents.

A text that fails the base rules is rejected and never enters a sketch.

Nulls and edge cases: a null or empty text has no words and fails the base
rules; null languages and sources are groups of their own; rows without doc_id
and repeated rows are judged like others; an empty table gives an empty table;
columns that clash with the ones added are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.common import words, written

#: metric: (numerator, denominator, scale, least spread, judged below too).
METRICS = {
    "symbols": ("n_symbols", "n_words", 1000, 25, False),
    "dup_lines": ("n_dup_lines", "n_lines", 1000, 50, False),
    "repeats": ("n_repeat_words", "n_words", 1000, 50, False),
    "upper": ("n_upper", "word_chars", 1000, 20, False),
    "word_length": ("word_chars", "n_words", 100, 40, True),
}
#: ``PRIOR_DOCS``: documents that a group takes from its parent's sketch.
FACTOR, PRIOR_DOCS = 8, 100
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")

_UPPER = bytes(range(65, 91))


def counts(text: str | None) -> tuple[int, ...]:
    """The numbers of :data:`COUNTS` of a whole text."""
    if not text:
        return (0,) * len(COUNTS)
    w, raw = words(text), text.encode("utf-8")
    lines = [x for x in text.split("\n") if x.strip(" \t\v\f\r")]
    seen = list(zip(w, w[1:], w[2:]))
    repeated = 0
    if len(often := Counter(seen)) < len(seen):
        end = 0
        for i, x in enumerate(seen):
            if often[x] > 1:
                repeated += i + 3 - max(i, end)
                end = i + 3
    return (
        len(w), len(text) - sum(map(text.count, " \t\n\v\f\r")), sum(map(text.count, "#*$%&|<>")),
        len(lines) - len(set(lines)), repeated, len(lines), len(raw) - len(raw.translate(None, _UPPER)),
    )


@F.pandas_udf(StructType([StructField(c, LongType()) for c in COUNTS]))
def _counts(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in parts:
        yield pd.DataFrame([counts(t) for t in texts], columns=list(COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def binned(v: str) -> Column:
    """The integer ``v`` with its six leading bits kept, the others 0."""
    low = f"greatest(length(bin({v})) - 6, 0)"
    return F.expr(f"shiftleft(shiftright({v}, {low}), {low})")


def rates() -> list[Column]:
    return [
        F.expr(f"{scale}L * {a} div greatest({b}, 1L)").alias(name)
        for name, (a, b, scale, _, _) in METRICS.items()
    ]


def sketches(judged: DataFrame) -> DataFrame:
    """``lang, source, metric, bin, n`` over the rows of ``judged``."""
    bins = F.array(*[F.struct(F.lit(m).alias("metric"), binned(m).alias("bin")) for m in METRICS])
    return (
        judged.select("lang", "source", F.explode(bins).alias("b"))
        .groupBy("lang", "source", "b.metric", "b.bin").agg(F.count("*").alias("n"))
    )


def _cumulated(grid: DataFrame, by: list[str], count: str) -> DataFrame:
    """``count`` added up over the bins of each sketch."""
    upto = Window.partitionBy(*by, "metric").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    return grid.withColumn(count, F.sum(F.coalesce(count, F.lit(0))).over(upto))


def quartiles(own: DataFrame, prior_docs: int) -> DataFrame:
    """Quartiles, as bins, of each language's and source's sketch with what it
    takes from its parents: ``lang, source, metric, q1, q2, q3``.

    A group counts as if it had ``prior_docs`` more documents, spread like its
    language's, and the language likewise takes from all; so parents decide for
    the smallest groups and matter ever less for larger ones. Counts stay whole
    numbers: both sides of a comparison are multiplied by what would divide.
    """
    k = prior_docs
    whole = own.groupBy("metric", "bin").agg(F.sum("n").alias("c2"))
    of = Window.partitionBy("metric")
    whole = _cumulated(whole.withColumn("n2", F.sum("c2").over(of)), [], "c2")
    per_lang = own.groupBy("lang", "metric", "bin").agg(F.sum("n").alias("c1"))
    langs = own.groupBy("lang", "metric").agg(F.sum("n").alias("n1"))
    a, w, x = langs.alias("a"), whole.alias("w"), per_lang.alias("x")
    grid = a.join(w, F.expr("a.metric = w.metric")).join(
        x, F.expr("a.lang <=> x.lang AND a.metric = x.metric AND w.bin = x.bin"), "left",
    ).select("a.lang", "a.metric", "w.bin", "c1", "c2", "n1", "n2")
    grid = _cumulated(grid, ["lang"], "c1")
    groups = own.groupBy("lang", "source", "metric").agg(F.sum("n").alias("n0"))
    a, w, x = groups.alias("a"), grid.alias("w"), own.withColumnRenamed("n", "c0").alias("x")
    full = a.join(w, F.expr("a.lang <=> w.lang AND a.metric = w.metric")).join(
        x, F.expr("a.lang <=> x.lang AND a.source <=> x.source AND a.metric = x.metric AND w.bin = x.bin"), "left",
    ).select("a.lang", "a.source", "a.metric", "w.bin", "c0", "c1", "c2", "n0", "n1", "n2")
    full = _cumulated(full, ["lang", "source"], "c0")
    d = {c: f"CAST({c} AS DECIMAL(38, 0))" for c in ("c0", "c1", "c2", "n0", "n1", "n2")}
    upto = f"{d['c0']} * ({d['n1']} + {k}) * {d['n2']} + {k} * ({d['c1']} * {d['n2']} + {k} * {d['c2']})"
    total = f"({d['n0']} + {k}) * ({d['n1']} + {k}) * {d['n2']}"
    return full.groupBy("lang", "source", "metric").agg(
        *[F.min(F.expr(f"CASE WHEN 4 * ({upto}) >= {i} * {total} THEN bin END")).alias(f"q{i}") for i in (1, 2, 3)])


def thresholds(judged: DataFrame, factor: int = FACTOR, prior_docs: int = PRIOR_DOCS) -> DataFrame:
    """``lang, source`` and, per metric, ``<metric>_low`` and ``<metric>_high``."""
    chosen = quartiles(written(sketches(judged), "sketches"), prior_docs)

    def pick(metric: str, low: bool) -> Column:
        least = METRICS[metric][3]
        edge = (
            F.col("q2") - factor * F.greatest(F.col("q2") - F.col("q1"), F.lit(least)) if low
            else F.col("q2") + factor * F.greatest(F.col("q3") - F.col("q2"), F.lit(least))
        )
        return F.max(F.when(F.col("metric") == metric, edge))

    return chosen.groupBy("lang", "source").agg(
        *[pick(m, low).alias(f"{m}_{'low' if low else 'high'}") for m in METRICS for low in (True, False)])


def judge(docs: DataFrame, factor: int = FACTOR, prior_docs: int = PRIOR_DOCS) -> DataFrame:
    """``doc_id, lang, source``, the counts, the metrics, ``base_failed`` and ``kept``."""
    counted = docs.select("doc_id", "lang", "source", _counts("text").alias("c")).select("doc_id", "lang", "source", "c.*")
    counted = written(counted.withColumn("base_failed", base_failed()).select("*", *rates()), "counts")
    limits = thresholds(counted.where("NOT base_failed"), factor, prior_docs)
    inside = F.lit(True)
    for m, (_, _, _, _, below) in METRICS.items():
        inside &= F.col(m) <= F.col(f"{m}_high")
        if below:
            inside &= F.col(m) >= F.col(f"{m}_low")
    d, t = counted.alias("d"), limits.alias("t")
    # a group without a judged document has no limits, and only rows that failed
    return (
        d.join(t, F.expr("d.lang <=> t.lang AND d.source <=> t.source"), "left")
        .select("d.*", (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"))
    )
