from __future__ import annotations

import hashlib
import math
import re
import zlib

import pytest
from conftest import SF01

from tidemark.llm import resample as R
from tidemark.llm.common import table
from tidemark.llm.queries import op13_importance_resample

from .conftest import ODD


def feature_list(text, width=1):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return [" ".join(w[i : i + k]) for k in range(1, width + 1) for i in range(len(w) - k + 1)], len(w)


def brute(docs, target, width=1, buckets=10_000, percent=10, least=20):
    bucket = lambda x: zlib.crc32(x.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for texts, into in ((docs, s), (target, t)):
        for _, text in texts:
            for x in feature_list(text, width)[0]:
                into[bucket(x)] += 1
    total, wanted = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((b + 1) * (total + buckets) / ((a + 1) * (wanted + buckets)))) for a, b in zip(s, t)]
    rows = []
    for d, text in docs:
        f, n = feature_list(text, width)
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(x)] for x in f)
        rows.append((d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n))
    fit = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = fit[: percent * len(fit) // 100]
    out = [(*r[:4], i + 1) for i, r in enumerate(drawn)] + [(*r[:4], None) for r in fit[len(drawn) :]]
    return sorted(out + [(*r[:4], None) for r in rows if r[4] < least], key=str)


def pairs(df, key):
    return [(r[key], r["text"]) for r in df.collect()]


def test_whole_table(spark):
    want = brute(pairs(table(spark, SF01, "documents"), "doc_id"), pairs(table(spark, SF01, "benchmark"), "item_id"))
    assert sorted((tuple(r) for r in op13_importance_resample(spark, SF01).collect()), key=str) == want


@pytest.mark.parametrize("segments, samples", [(1, 1), (7, 3), (64, 16)])
def test_ranks_of_ties_and_copies(spark, segments, samples):
    """Half of the rows have one key: they spread over segments and all get ranks of their own."""
    rows = [(5, 3, 7, 40), (6, 3, 7, 40), (None, 3, 7, 40)] * 200 + [(i, i % 9, i, i % 11) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, n_features long, weight long, score long").repartition(5)
    from pyspark.sql import functions as F

    runs = df.sortWithinPartitions(*R._order()[:3]).withColumn("place", F.monotonically_increasing_id())
    runs = R.written(runs, "test-runs")
    order = sorted(rows, key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for draw in (0, 1, 333, 1200):
        got = R.drawn_ranks(runs, len(rows), draw, segments, samples).collect()
        assert len(got) == len(rows)
        ranked = sorted((r for r in got if r.rank is not None), key=lambda r: r.rank)
        assert [r.rank for r in ranked] == list(range(1, draw + 1))
        assert [(r.doc_id, r.n_features, r.weight, r.score) for r in ranked] == order[:draw]
    cuts = R.splitters(runs, len(rows), segments, samples)
    dealt = R.with_segment(runs, cuts).groupBy("segment").count().collect()
    assert max(r["count"] for r in dealt) <= len(rows) / segments + 5 * (len(rows) / (segments * samples) + 1) + 1


def test_longer_features(spark, make_docs):
    docs = [(1, "The cat, the hat"), (2, "cat the"), (3, "the cat the cat " * 9)]
    target = [(1, "The cat")]
    got = R.resample(make_docs(docs), make_docs(target), percent=100, width=2, buckets=50)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, target, 2, 50, 100)


def test_odd_rows(make_docs):
    more = [(None, "word " * 25), (None, "word " * 25), (30, "other " * 25), (30, "other " * 30), (31, None)]
    rows = [(r[0], r[1]) for r in ODD] + more
    docs = make_docs(rows).selectExpr("*", "'x' AS score", "1 AS place", "2 AS rank", "3 AS segment")
    want = brute(rows, [(0, "long words")], percent=60)
    target = make_docs([(0, "long words"), (1, None)])
    got = R.resample(docs, target, percent=60)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_empty_tables(make_docs):
    assert R.resample(make_docs([]), make_docs([])).count() == 0
    assert R.resample(make_docs(ODD), make_docs([])).count() == len(ODD)


def test_a_task_holds_few_texts_and_features():
    """Beside the batch itself, whatever its size and however many words differ."""
    import tracemalloc

    import pyarrow as pa

    batch = pa.array([f"w{i} " * 500 if i % 7 else None for i in range(5000)])
    features = R.Features(100, 1)
    tracemalloc.start()
    n = sum(len(features.of(R.feature_words(t))) for t in R.each_text(batch))
    held = tracemalloc.get_traced_memory()[1]
    features.of([b"x%d" % i for i in range(300_000)])
    tracemalloc.stop()
    assert n == 500 * sum(i % 7 != 0 for i in range(5000))
    assert held < 3e6 and len(features) <= R.MEMORY <= 100_000
