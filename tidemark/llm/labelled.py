"""The bounded labelled sample that the classifiers learn from."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CUT = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(256))


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the doc_id's decimal text, modulo ``folds``."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % folds


def sample(labels: DataFrame, label: str, usable: Column, most: int) -> DataFrame:
    """``doc_id, y`` of ``most`` usable labelled documents at most.

    They are those with the smallest hashes of doc_id; a cut at the hash that
    leaves about 1.5 times as many comes first, so the top-n sees a bounded
    number of rows. Null ids and labels are left out; of different labels for
    one id the larger holds.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & usable)
    share = min(1.0, 1.5 * most / max(1, known.count()))
    h = F.xxhash64("doc_id")
    known = known.where(h <= F.lit(int(-(2**63) + share * (2**64 - 1))) if share < 1 else F.lit(True))
    return (
        known.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
        .orderBy(h, "doc_id").limit(most)
    )


def one_text(sampled: DataFrame) -> DataFrame:
    """One row per ``doc_id``: of rows that repeat it the one with the smallest
    text, so a rerun learns from the same."""
    rest = [c for c in sampled.columns if c not in ("doc_id", "text")]
    return sampled.groupBy("doc_id").agg(F.min(F.struct("text", *rest)).alias("r")).select("doc_id", "r.*")


def letters(text: str | None) -> list[bytes]:
    """Lower-case words of letters; what isn't a letter in ASCII cuts."""
    return text.lower().encode("utf-8").translate(_CUT).split() if text else []


class Buckets(dict):
    """word -> hash bucket, kept between texts and emptied when it is large."""

    def __init__(self, bits: int, most: int = 500_000):
        super().__init__()
        self.mask, self.most = (1 << bits) - 1, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = out = zlib.crc32(word) & self.mask
        return out


class Weights(dict):
    """word -> weight of its bucket, likewise."""

    def __init__(self, weights, most: int = 500_000):
        super().__init__()
        self.weights, self.mask, self.most = weights, len(weights) - 1, most

    def __missing__(self, word: bytes) -> float:
        if len(self) >= self.most:
            self.clear()
        self[word] = out = float(self.weights[zlib.crc32(word) & self.mask])
        return out
