"""Mixing sources to target weights by balanced sampling (the cube method).

A source whose target is ``rate`` times its size gives every document
``floor(rate)`` times, and once more with inclusion probability
``rate - floor(rate)``. The cube method draws those: it moves the vector of
probabilities along the null space of two constraints (token total, document
total) until an entry reaches 0 or 1, so both totals stay what they were.

Documents are dealt by hash into blocks of one source, bounded in rows, and
each block runs the flight phase on three open documents at a time. At most
two per block stay undecided; they meet in the next level's blocks, and so on
until one block per source is left, whose last documents are landed by giving
up first the document total, then rounding. Hot sources are many blocks; no
task holds a source.

Nulls and edge cases: a null text has size 0, null sources form a source of
their own, listed last; sources without words get target 0 and give nothing;
documents of size 0 follow their source's rate; repeated rows and repeated
doc_ids are separate documents; an empty table gives an empty table. Columns
that clash with the names added here are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import n_words, written

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (3, 1, 2)
TINY = 1e-9


def source_targets(sized: DataFrame, weights=WEIGHTS, share=1.5, most=2.0) -> DataFrame:
    """``source, n_docs, source_size, target`` of each source.

    The sources share ``share`` times all sizes by weight. A target stops at
    ``most`` times its source's size and the excess is shared anew among the
    others, until none is above. One row per source is ranked; the rounds of
    resharing are aggregates over that small table.
    """
    per = sized.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    per = written(per.withColumn("weight", w), "sources")
    total = share * float(per.agg(F.sum("source_size")).first()[0] or 0)
    cap, level = F.col("source_size") * most, 0.0
    while True:
        full = F.col("weight") * level >= cap
        r = per.agg(
            F.sum(F.when(full, cap)).alias("given"), F.sum(F.when(~full, F.col("weight"))).alias("w"),
        ).first()
        if not r.w:
            break
        raised = (total - float(r.given or 0)) / r.w
        if raised <= level:
            break
        level = raised
    return per.withColumn("target", F.least(F.col("weight") * level, cap).cast("double"))


def flight(size: np.ndarray, p: np.ndarray, draws: np.ndarray, docs_too: bool = True) -> np.ndarray:
    """Move ``p`` until fewer open entries are left than a null space needs.

    Keeps the sums of ``p * size`` and, with ``docs_too``, of ``p``. Of the two
    directions of a null vector, ``draws`` (uniform, one per entry) picks with
    the odds that keep every entry's expectation.
    """
    p = p.copy()
    open_: list[int] = []
    need = 3 if docs_too else 2
    for i in np.flatnonzero((p > 0) & (p < 1)).tolist():
        open_.append(i)
        if len(open_) < need:
            continue
        s = [float(size[j]) for j in open_]
        if docs_too:
            u = [s[1] - s[2], s[2] - s[0], s[0] - s[1]]
            if not any(u):
                u = [1.0, -1.0, 0.0]
        else:
            u = [s[1], -s[0]] if any(s) else [1.0, 0.0]
        moving = [(j, x) for j, x in zip(open_, u) if x]
        ahead = min((1 - p[j]) / x if x > 0 else -p[j] / x for j, x in moving)
        back = min(p[j] / x if x > 0 else (p[j] - 1) / x for j, x in moving)
        move = ahead if draws[i] * (ahead + back) < back else -back
        for j, x in moving:
            q = p[j] + move * x
            p[j] = 0.0 if q < TINY else 1.0 if q > 1 - TINY else q
        open_ = [j for j in open_ if 0.0 < p[j] < 1.0]
    return p


def _fly(last: bool):
    def fly(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["order", "doc_id", "size"], kind="stable")
        size, p = pdf["size"].to_numpy(float), pdf["p"].to_numpy(float)
        rng = np.random.default_rng(pdf["order"].to_numpy(np.int64)[:1].view(np.uint64))
        p = flight(size, p, rng.random(len(p)))
        if last:
            p = np.rint(flight(size, p, rng.random(len(p)), docs_too=False))
        return pdf.assign(p=p)

    return fly


def cube_mix(
    docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0,
    block_rows: int = 2000, seed: int = 20,
) -> DataFrame:
    """``docs`` without the text's weight: ``doc_id, source, size, source_size,
    target, copies, taken`` per row, ``taken = copies * size``.

    ``block_rows`` is about how many documents one flight holds. The draw
    depends on doc_id, size and ``seed`` only, so reruns agree.
    """
    sized = docs.select("doc_id", "source", n_words("text").alias("size"))
    targets = source_targets(sized, weights, share, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # a rate that misses a whole number by rounding alone is that number
    rate = F.when(F.abs(rate - F.rint(rate)) < TINY, F.rint(rate)).otherwise(rate)
    rows = sized.join(targets, sized.source.eqNullSafe(targets.source)).select(
        "doc_id", sized.source, "size", "source_size", "target", "n_docs",
        F.floor(rate).cast("int").alias("whole"), (rate - F.floor(rate)).alias("p"),
        F.xxhash64("doc_id", "size", F.lit(seed)).alias("order"),
    )
    now, kept, level = rows, [], 0
    while True:
        blocks = F.ceil(F.col("n_docs") / block_rows)
        now = now.withColumn("block", F.pmod(F.xxhash64("order", F.lit(level)), blocks))
        last = level > 0 and not now.where(F.col("n_docs") > block_rows).take(1)
        flown = now.groupBy("source", "block").applyInPandas(_fly(last), now.schema)
        if last:
            kept.append(flown)
            break
        flown = written(flown, f"flight-{level}")
        settled = (F.col("p") == 0) | (F.col("p") == 1)
        kept.append(flown.where(settled))
        left = flown.where(~settled)
        per = left.groupBy("source").agg(F.count("*").alias("n"))
        now = left.alias("l").join(per.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source"))).select(
            "l.*", "r.n").withColumn("n_docs", F.col("n")).drop("n")
        level += 1
    out = kept[0]
    for k in kept[1:]:
        out = out.union(k.select(out.columns))
    copies = F.col("whole") + F.col("p").cast("int")
    return out.select(
        "doc_id", "source", "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"),
    )


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: ``docs`` with each row as often as :func:`cube_mix` takes it.

    Rows meet their draws on a hash of (doc_id, source, size); repeated rows are
    numbered, so each gets a draw of its own.
    """
    key = F.xxhash64("doc_id", "source", "size").alias("key")
    nth = F.row_number().over(Window.partitionBy("key").orderBy("doc_id", "copies"))
    draws = cube_mix(docs, **options).select(key, "doc_id", "copies").select("key", "copies", nth.alias("nth"))
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    rows = docs.select(row, "doc_id", "source", n_words("text").alias("size")).select("row", "doc_id", key)
    nth = F.row_number().over(Window.partitionBy("key").orderBy("doc_id"))
    rows = rows.select("row", "key", nth.alias("nth"))
    return (
        rows.alias("r").join(draws.alias("d"), F.expr("r.key = d.key AND r.nth - d.nth = 0 AND d.copies > 0"))
        .select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select("row.*")
    )
