"""Toxicity: a word classifier regularised by counterfactuals.

Features are a text's distinct words and word stems, hashed. Besides the logistic loss and an
absolute-value penalty, training takes each labelled text that names a group,
swaps its identity terms for others of the same kind, and penalises the squared
change of the score, so that naming a group by itself doesn't raise it.

The model is fitted on at most ``train_rows`` labelled documents (a bounded
sample, whole texts) and applied to every whole text of every row.

Nulls and edge cases: null, empty and wordless texts get the score of a text
without words; rows without doc_id are scored and never learnt from; repeated
rows are scored alike, and of different texts of one doc_id the smallest is
learnt from; without labelled rows, or with one label only, the score
is the smoothed rate of the label everywhere; empty tables give empty tables;
only doc_id and text are read, other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.labelled import Buckets, Weights, fold, letters, one_text, sample

BITS, STEM = 18, 5
FOLDS, HELD_OUT, THRESHOLD = 3, 1, 0.7

# Kinds of identity terms; a term is swapped within its kind.
IDENTITY_TERMS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"),
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("gay", "lesbian", "bisexual", "straight", "transgender", "queer"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("immigrant", "refugee", "foreigner", "native"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("blind", "deaf", "disabled", "autistic"),
    ("old", "young", "elderly", "teenage"),
    ("frauen", "männer", "christen", "muslime", "juden"),
    ("femmes", "hommes", "chrétiens", "musulmans", "juifs"),
    ("mujeres", "hombres", "cristianos", "musulmanes", "judíos"),
)


def swaps(terms=IDENTITY_TERMS) -> dict[bytes, list[bytes]]:
    """Each term's replacements."""
    return {
        t.encode(): [o.encode() for o in kind if o != t] for kind in terms for t in kind
    }


def counterfactual(words: set[bytes], swap: dict[bytes, list[bytes]], nth: int) -> set[bytes] | None:
    """``words`` with every identity term replaced by its nth alternative."""
    named = [w for w in words if w in swap]
    if not named:
        return None
    return {swap[w][nth % len(swap[w])] if w in swap else w for w in words}


def tokens(ws: set[bytes]) -> set[bytes]:
    """Distinct words, and the stems of the longer ones."""
    return ws | {w[:STEM] + b"-" for w in ws if len(w) > STEM}


def strength(n1: np.ndarray, n0: np.ndarray, docs1: float, docs0: float) -> np.ndarray:
    """Root of the likelihood ratio with which a feature's counts in the two
    classes differ from the classes' sizes."""
    n = n1 + n0
    with np.errstate(divide="ignore", invalid="ignore"):
        g1 = np.where(n1 > 0, n1 * np.log(n1 * (docs1 + docs0) / (n * docs1)), 0.0)
        g0 = np.where(n0 > 0, n0 * np.log(n0 * (docs1 + docs0) / (n * docs0)), 0.0)
    return np.sqrt(np.maximum(2 * (g1 + g0), 0.0))


def fit(
    rows: list[np.ndarray], y: np.ndarray, changes: tuple[np.ndarray, np.ndarray, np.ndarray], bits: int = BITS,
    l1: float = 1e-3, counter: float = 1.0, steps: int = 200, rate: float = 0.5, least: float = 3.0,
) -> tuple[np.ndarray, float]:
    """Weights and offset: full-batch AdaGrad with soft thresholding.

    A feature counts as much as its :func:`strength`, so the penalty weighs less
    on those that tell the classes apart; below ``least`` it has no weight.
    ``changes`` are what texts and their counterfactuals don't share: number of
    the pair, hashed token, and 1 where the text has it or -1.
    """
    prior = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))) if len(y) else 0.0
    w = np.zeros(2**bits)
    if not len(y) or not 0 < y.sum() < len(y):
        return w, prior
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    ids = np.concatenate([np.asarray(r, np.int64) for r in rows])
    n1 = np.bincount(ids, y[doc], 2**bits)
    scale = strength(n1, np.bincount(ids, minlength=2**bits) - n1, y.sum(), len(y) - y.sum())
    used = np.flatnonzero(scale >= least)
    place = np.full(2**bits, -1)
    place[used] = np.arange(len(used))
    scale = scale[used]
    doc, ids = doc[place[ids] >= 0], place[ids[place[ids] >= 0]]
    d_pair, d_ids, d_x = (x[place[changes[1]] >= 0] for x in changes)
    d_ids, n_pairs = place[d_ids], int(d_pair.max(initial=-1)) + 1
    d_x = d_x * scale[d_ids]
    x = scale[ids]
    v, b, n = np.zeros(len(used)), prior, len(rows)
    g2, b2 = np.full(len(used), 1e-8), 1e-8
    for _ in range(steps):
        z = np.bincount(doc, v[ids] * x, n) + b
        e = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / n
        g = np.bincount(ids, e[doc] * x, len(used))
        if n_pairs:
            change = np.bincount(d_pair, v[d_ids] * d_x, n_pairs)
            g += 2 * counter / n * np.bincount(d_ids, change[d_pair] * d_x, len(used))
        g2 += g * g
        step = rate / np.sqrt(g2)
        v = v - step * g
        v = np.sign(v) * np.maximum(np.abs(v) - step * l1, 0)
        b2 += e.sum() ** 2
        b -= rate / np.sqrt(b2) * e.sum() * 0.1
    w[used] = v * scale
    return w, float(b)


def train(
    docs: DataFrame, labels: DataFrame, train_rows: int = 20_000, bits: int = BITS,
    terms=IDENTITY_TERMS, n_swaps: int = 3, **options,
) -> tuple[np.ndarray, float]:
    """Fit on at most ``train_rows`` labelled documents outside the held-out fold."""
    known = sample(labels, "toxic", fold("doc_id", FOLDS) != HELD_OUT, train_rows)
    swap = swaps(terms)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = Buckets(bits)
        for b in batches:
            ids, swapped, gone, come = [], [], [], []
            for t in b.column("text").to_pylist():
                ws = set(letters(t))
                own = {bucket[w] for w in tokens(ws)}
                ids.append(sorted(own))
                for out in (swapped, gone, come):
                    out.append([])
                for nth in range(n_swaps):
                    if (other := counterfactual(ws, swap, nth)) is not None:
                        changed = {bucket[w] for w in tokens(other)}
                        a, b_ = sorted(own - changed), sorted(changed - own)
                        swapped[-1] += [nth] * (len(a) + len(b_))
                        gone[-1] += a + b_
                        come[-1] += [1] * len(a) + [-1] * len(b_)
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), b.column("y").cast(pa.int32()),
                 *(pa.array(c, kind) for c in (ids, swapped, gone, come))],
                names=["doc_id", "y", "ids", "nth", "token", "side"],
            )

    # known has train_rows rows of two numbers at most
    rows = (
        one_text(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("doc_id", "text", "y"))
        .mapInArrow(extract, "doc_id long, y int, ids array<int>, nth array<int>, token array<int>, side array<int>")
        .toArrow().sort_by("doc_id")
    )
    ids = [r.values.to_numpy() for r in rows.column("ids")]
    flat = {c: rows.column(c).combine_chunks().flatten().to_numpy() for c in ("nth", "token", "side")}
    sizes = pc.list_value_length(rows.column("nth")).to_numpy()
    pair = np.repeat(np.arange(len(ids)), sizes) * n_swaps + flat["nth"]
    changes = pair, flat["token"], flat["side"].astype(float)
    return fit(ids, np.asarray(rows.column("y").to_pylist(), float), changes, bits, **options)


def scorer(spark, model: tuple[np.ndarray, float]):
    """A column function ``text -> score`` (0 to 1)."""
    shared = spark.sparkContext.broadcast(model)  # 2**bits numbers

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, offset = shared.value
        of = Weights(weights).__getitem__
        for texts in parts:
            z = np.array([sum(map(of, sorted(tokens(set(letters(t))))), offset) for t in texts], float)
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -40, 40))))

    return score


def score_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` with ``score`` added (replaced if there)."""
    score = scorer(docs.sparkSession, train(docs, labels, **options))
    return docs.withColumn("score", score(F.col("text")))


def toxic(score: str | Column = "score", threshold: float = THRESHOLD) -> Column:
    return (F.col(score) if isinstance(score, str) else score) >= threshold


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """``docs`` without the rows that the classifier rejects."""
    score = scorer(docs.sparkSession, train(docs, labels, **options))
    return docs.where(~toxic(score(F.col("text")), threshold))
