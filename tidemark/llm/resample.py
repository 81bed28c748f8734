"""Importance resampling towards a target distribution.

Features are runs of words, hashed to buckets. Of each bucket's share of the
target and of the corpus the logarithm of the quotient is its gain; a document's
weight is the sum of the gains of its features, read from one array of fixed
size. Gumbel noise made of the id turns the weights into scores whose highest
``percent`` of documents are a draw without replacement.

Ranks come from parallel sorting by regular sampling: (1) each task sorts its
documents; the runs are written; (2) rows at regular places of all runs are
sorted, and regular places among them are the splitters; (3) counts between
splitters, added up from the top, tell each segment's first rank and which
segments are reached by the draw at all; (4) only those are exchanged, merged
each on its own, and numbered. A row's place in its run is the last part of the
key, so equal rows spread over segments like others do.

Nulls and edge cases: a text without words (null, empty, blank) has no features
and weight 0; it isn't drawn while ``least_words`` is above 0; a null doc_id has
the noise of an empty id and comes last among ties; rows that repeat a doc_id are
drawn one by one, those with fewer features first among ties; an empty table gives an
empty table, an empty target gains of the corpus alone; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import written

BUCKETS, PERCENT, LEAST_WORDS, SEED = 10_000, 10, 20, 2024
#: Segments of a sort, and rows sampled for each (beside one per run).
SEGMENTS, SAMPLES = 1024, 16
#: Features kept in a task, and texts taken from a batch at once: what they hold lies beside the heap.
MEMORY, TEXTS = 100_000, 128

_KEY = ["score", "doc_id", "n_features", "place"]
#: Bytes of words as they are (A-Z lower-cased), all others spaces.
_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def feature_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8").translate(_BYTES).split() if text else []


def each_text(column: pa.Array) -> Iterator[str | None]:
    """The texts of a batch; only a few are held beside it."""
    for i in range(0, len(column), TEXTS):
        yield from column.slice(i, TEXTS).to_pylist()


class Features(dict):
    """feature -> bucket, kept between texts and emptied when it is large."""

    def __init__(self, buckets: int, width: int):
        super().__init__()
        self.buckets, self.width = buckets, width

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
        self[feature] = out = zlib.crc32(feature) % self.buckets
        return out

    def of(self, w: list[bytes]) -> np.ndarray:
        """Buckets of all runs of 1 to ``width`` words."""
        n = len(w)
        out = [self[x] for x in w]
        for k in range(2, self.width + 1):
            out += [self[b" ".join(w[i : i + k])] for i in range(n - k + 1)]
        return np.array(out, np.int64)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, width: int = 1) -> np.ndarray:
    """Features of all texts per bucket. A task sends its buckets' sums; the
    result has a fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(buckets, width), np.zeros(buckets, np.int64)
        for b in batches:
            for t in each_text(b.column(0)):
                total += np.bincount(features.of(feature_words(t)), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    sums = texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in sums.collect():  # a row per bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of target over corpus, smoothed by one."""
    n, s, t = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log((b + 1) * (s + n) / ((a + 1) * (t + n))))
        for a, b in zip(corpus.tolist(), target.tolist())
    ], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, width: int = 1) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(len(gain), width)
        for b in batches:
            words, many, weight = [], [], []
            for t in each_text(b.column("text")):
                w = feature_words(t)
                x = features.of(w)
                words.append(len(w))
                many.append(len(x))
                weight.append(int(gain[x].sum()))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), *(pa.array(c, pa.int64()) for c in (words, many, weight))],
                names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: str, seed: int = SEED) -> Column:
    """Thousandths of Gumbel noise from the first 32 bits of a hash of the id."""
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(said, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _order() -> list[Column]:
    return [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("place")]


def splitters(runs: DataFrame, n: int, segments: int, samples: int) -> list[tuple]:
    """Keys that cut the sorted whole into ``segments`` stretches of about equal
    size: regular places of the sorted regular samples. Between two samples of
    a run are ``n / (segments * samples)`` of its rows, so a segment holds less
    than its share and that much from every run."""
    step = max(1, n // (segments * samples))
    # the rows of a run are numbered from 0 in the low 33 bits of ``place``
    regular = runs.where(F.col("place").bitwiseAND((1 << 33) - 1) % step == 0)
    # segments * samples rows, and one for each run
    rows = regular.select(*_KEY).orderBy(*_order()).collect()
    cuts = sorted({i * len(rows) // segments for i in range(1, segments)} - {0})
    return [tuple(rows[i]) for i in cuts if i < len(rows)]


def _columns(rows: list[tuple]) -> tuple[np.ndarray, ...]:
    """Keys so that a plain ascending order is the wanted one."""
    ways = (lambda r: -r[0], lambda r: r[1] is None, lambda r: r[1] or 0, lambda r: r[2], lambda r: r[3])
    return tuple(np.array([way(r) for r in rows], np.int64) for way in ways)


def with_segment(runs: DataFrame, cuts: list[tuple]) -> DataFrame:
    """``runs`` with ``segment``, the number of splitters at or before a row."""
    ends = runs.sparkSession.sparkContext.broadcast(_columns(cuts))  # fewer than ``segments`` keys
    schema = T.StructType([*runs.schema.fields, T.StructField("segment", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of = b.column("doc_id")
            mine = (
                -b.column("score").to_numpy(), of.is_null().to_numpy(zero_copy_only=False),
                of.fill_null(0).to_numpy(), b.column("n_features").to_numpy(), b.column("place").to_numpy())
            both = [np.concatenate([e, m]) for e, m in zip(ends.value, mine)]
            # splitters come first among equals, as lexsort is stable
            order = np.lexsort(both[::-1])
            cut = order < len(cuts)
            segment = np.empty(len(order), np.int32)
            segment[order] = np.cumsum(cut)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(segment[len(cuts) :])], names=schema.names)

    return runs.mapInArrow(run, schema)


def drawn_ranks(runs: DataFrame, n: int, draw: int, segments: int = SEGMENTS, samples: int = SAMPLES) -> DataFrame:
    """``runs`` with ``rank``: 1, 2, 3 ... for the first ``draw`` of ``n`` rows
    in the order of score (falling), doc_id, n_features and place; null for the
    others."""
    dealt = written(with_segment(runs, splitters(runs, n, segments, samples)), "segments")
    before, starts = 0, []
    for r in dealt.groupBy("segment").count().orderBy("segment").collect():  # a row per segment
        starts.append((r["segment"], before, before < draw))
        before += r["count"]
    first = runs.sparkSession.createDataFrame(starts, "segment int, start long, reached boolean")
    # a row per segment: a fixed number
    dealt = dealt.join(F.broadcast(first), "segment")
    own = F.row_number().over(Window.partitionBy("segment").orderBy(*_order()))
    ranked = dealt.where("reached").withColumn("rank", F.col("start") + own)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    rest = dealt.where("NOT reached").withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).drop("segment", "start", "reached")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
    seed: int = SEED, buckets: int = BUCKETS, width: int = 1, segments: int = SEGMENTS, samples: int = SAMPLES,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` per row of ``docs``.

    Of the documents with ``least_words`` words or more, ``percent`` in a
    hundred are drawn; their rank counts from the highest score.
    """
    gain = gains(bucket_counts(docs, buckets, width), bucket_counts(target, buckets, width))
    scored = weigh(docs, gain, width).withColumn("score", F.col("weight") + noise("doc_id", seed))
    short = F.col("n_words") < least_words
    runs = scored.sortWithinPartitions(short, F.desc("score"), F.asc_nulls_last("doc_id"), "n_features")
    runs = written(runs.withColumn("place", F.monotonically_increasing_id()), "sorted-runs")
    fit = runs.where(~short)
    n = fit.count()
    ranked = drawn_ranks(fit, n, percent * n // 100, segments, samples)
    rest = runs.where(short).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
