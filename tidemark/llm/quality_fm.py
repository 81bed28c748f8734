"""Quality classifier: a factorisation machine in linear time.

``z = w0 + sum w_i x_i + 1/2 sum_f [ (sum v_if x_i)^2 - sum v_if^2 x_i^2 ]``:
the sum-of-squares identity gives all pairwise interactions for the cost of the
features. Features are hashed words, structure statistics in logarithmic bins,
and metadata (the stated n_chars: its bin, and whether it agrees with the text).

The model is fitted on at most ``train_rows`` labelled documents (a bounded
sample, whole texts) and applied to every whole text of every row.

Nulls and edge cases: null and empty texts have no words and the bins of zero;
a null n_chars, or none at all, has a bin of its own; rows without doc_id are
scored and never learnt from; repeated rows are scored alike, and of different
texts of one doc_id the smallest is learnt from; without labelled rows, or with one
label only, the score is the smoothed rate of the label; empty tables give empty
tables; other columns are left alone, and a clashing ``score`` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import log2

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.labelled import Buckets, fold, letters, one_text, sample

BITS, FACTORS, BINS = 15, 8, 24
FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3

_UPPER, _DIGIT = bytes(range(65, 91)), bytes(range(48, 58))
_SYMBOL, _POINT, _SPACE = b"#*$%&|<>{}[]=+~^_\\/@", b"!?", b" \t\n\r\x0b\x0c"
N_STATS = 15
SCORED_AT_ONCE = 256


def structure(text: str | None, n_chars: int | None) -> list[int]:
    """One bin for each structure statistic and piece of metadata."""
    text = text or ""
    raw = text.encode("utf-8")
    n, w, lines = len(raw) or 1, raw.split(), [x for x in text.split("\n") if x.strip()]
    k, m = len(w) or 1, len(lines) or 1

    def without(cut: bytes) -> int:
        return len(raw) - len(raw.translate(None, cut))

    shares = [
        without(_UPPER) / n, without(_DIGIT) / n, without(_SYMBOL) / n, without(_POINT) / n,
        without(b".,;:") / n, without(_SPACE) / n, len(set(w)) / k, len(set(lines)) / m,
        sum(len(x) <= 2 for x in w) / k, raw.count(b"http") / k, raw.count(b"|") / k, m / k,
    ]
    # steps of half an octave from 1 down to 1/2048
    bins = [min(BINS - 1, int(-2 * log2(s)) + 1) if s > 0 else 0 for s in (min(x, 1.0) for x in shares)]
    bins.append(min(BINS - 1, int(2 * log2(1 + len(raw) / k))))
    bins.append(min(BINS - 1, int(log2(1 + len(text)))))
    bins.append(BINS - 1 if n_chars is None else BINS - 2 if n_chars != len(text) else min(BINS - 3, int(log2(1 + max(0, n_chars)))))
    return bins


def features(text: str | None, n_chars: int | None, bucket: Buckets, bits: int) -> tuple[np.ndarray, int]:
    """Feature numbers, and how many of them are words (they come first)."""
    ids = sorted({bucket[w] for w in set(letters(text))})
    at = 2**bits
    stats = [at + i * BINS + b for i, b in enumerate(structure(text, n_chars))]
    return np.array(ids + stats, np.int32), len(ids)


def values(n: int, n_words: int) -> np.ndarray:
    """Words share a length of 1; each statistic counts 1."""
    x = np.ones(n)
    x[:n_words] /= max(1, n_words) ** 0.5
    return x


def raw_score(w0, w, v, ids, x, starts):
    """The machine over documents whose features start at ``starts``; also the
    factor sums, which the gradient needs."""
    vx = v[ids] * x[:, None]
    s = np.add.reduceat(vx, starts, axis=0)
    q = np.add.reduceat(vx * vx, starts, axis=0)
    return w0 + np.add.reduceat(w[ids] * x, starts) + 0.5 * (s * s - q).sum(axis=1), s


def fit(
    rows: list[tuple[np.ndarray, int]], y: np.ndarray, bits: int = BITS, factors: int = FACTORS,
    epochs: int = 12, batch: int = 128, rate: float = 0.08, l2: float = 1e-5, seed: int = 3,
):
    """AdaGrad over mini-batches of the logistic loss; features are never empty,
    as every document has its statistics."""
    rng = np.random.default_rng(seed)
    dim = 2**bits + N_STATS * BINS
    w0 = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))) if len(y) else 0.0
    w, v = np.zeros(dim), rng.normal(0, 0.03, (dim, factors))
    if not len(y) or not 0 < y.sum() < len(y):
        return w0, w, np.zeros_like(v)
    gw, gv, g0 = np.full(dim, 1e-6), np.full((dim, factors), 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            pick = order[at : at + batch]
            ids = np.concatenate([rows[i][0] for i in pick])
            lens = np.array([len(rows[i][0]) for i in pick])
            x = np.concatenate([values(len(rows[i][0]), rows[i][1]) for i in pick])
            starts = np.concatenate([[0], np.cumsum(lens)[:-1]])
            z, s = raw_score(w0, w, v, ids, x, starts)
            e = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[pick]) / len(pick)
            ex = np.repeat(e, lens) * x
            used, place = np.unique(ids, return_inverse=True)
            dw = np.bincount(place, ex) + l2 * w[used]
            grow = ex[:, None] * (np.repeat(s, lens, axis=0) - v[ids] * x[:, None])
            dv = np.stack([np.bincount(place, grow[:, f]) for f in range(factors)], axis=1) + l2 * v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            g0 += e.sum() ** 2
            w[used] -= rate * dw / np.sqrt(gw[used])
            v[used] -= rate * dv / np.sqrt(gv[used])
            w0 -= rate * e.sum() / np.sqrt(g0)
    return w0, w, v


def train(docs: DataFrame, labels: DataFrame, train_rows: int = 10_000, bits: int = BITS, **options):
    """Fit on at most ``train_rows`` labelled documents outside the held-out fold."""
    known = sample(labels, "quality", fold("doc_id", FOLDS) != HELD_OUT, train_rows)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = Buckets(bits)
        for b in batches:
            got = [features(t, c, bucket, bits) for t, c in zip(
                b.column("text").to_pylist(), b.column("n_chars").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), b.column("y").cast(pa.int32()),
                 pa.array([g[0] for g in got], pa.list_(pa.int32())), pa.array([g[1] for g in got], pa.int32())],
                names=["doc_id", "y", "ids", "n"],
            )

    # known has train_rows rows of two numbers at most
    rows = (
        one_text(docs.select("doc_id", "text", _n_chars(docs).alias("n_chars")).join(F.broadcast(known), "doc_id"))
        .mapInArrow(extract, "doc_id long, y int, ids array<int>, n int").toArrow().sort_by("doc_id")
    )
    ids = [np.asarray(r.values, np.int32) for r in rows.column("ids")]
    return fit(list(zip(ids, rows.column("n").to_pylist())), np.asarray(rows.column("y").to_pylist(), float), bits, **options)


def _n_chars(docs: DataFrame) -> Column:
    return F.col("n_chars") if "n_chars" in docs.columns else F.lit(None).cast("long")


def score_texts(model, texts: Iterable[str | None], n_chars: Iterable[int | None], bucket: Buckets, bits: int) -> np.ndarray:
    """Scores (0 to 1) of texts under the machine ``(w0, w, v)``."""
    got = [features(t, c, bucket, bits) for t, c in zip(texts, n_chars)]
    out = [np.empty(0)]
    for at in range(0, len(got), SCORED_AT_ONCE):
        part = got[at : at + SCORED_AT_ONCE]
        ids = np.concatenate([i for i, _ in part])
        x = np.concatenate([values(len(i), n) for i, n in part])
        starts = np.cumsum([0, *(len(i) for i, _ in part[:-1])])
        out.append(raw_score(*model, ids, x, starts)[0])
    return 1 / (1 + np.exp(-np.clip(np.concatenate(out), -40, 40)))


def score_documents(docs: DataFrame, labels: DataFrame, bits: int = BITS, **options) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: better) added or replaced.
    ``n_chars`` is used where ``docs`` has it."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, bits=bits, **options))  # fixed size

    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        bucket = Buckets(bits)
        for texts, n_chars in parts:
            known = [None if c is None or pd.isna(c) else int(c) for c in n_chars]
            yield pd.Series(score_texts(shared.value, texts, known, bucket, bits))

    return docs.withColumn("score", score(F.col("text"), _n_chars(docs)))
