from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from conftest import SF01

from tidemark.llm import quality_fm as Q
from tidemark.llm import toxicity as T
from tidemark.llm.common import table
from tidemark.llm.labelled import Buckets, letters, sample
from tidemark.llm.queries import op3_quality_fm, op10_counterfactual_toxicity

from .conftest import ODD

LABELS = "doc_id long, quality int, toxic int"


def held_out(spark, query, label, folds, fold):
    labels = {r.doc_id: r[label] for r in table(spark, SF01, "labels").collect()}
    rows = query(spark, SF01).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == fold) for r in rows)
    return [(r.predicted, labels[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in labels]


def test_toxic_documents_are_caught(spark):
    got = held_out(spark, op10_counterfactual_toxicity, "toxic", 3, 1)
    assert sum(p == y for p, y, _ in got) / len(got) >= 0.9
    assert all(0 <= s <= 1 and p == (s >= 0.7) for p, _, s in got)


def test_quality_is_told(spark):
    got = held_out(spark, op3_quality_fm, "quality", 5, 0)
    assert sum(p == y for p, y, _ in got) / len(got) >= 0.9
    assert all(0 <= s <= 1 and p == (s >= 0.3) for p, _, s in got)


def test_the_identity_gives_all_pairs():
    rng = np.random.default_rng(0)
    dim, k = 50, 4
    w, v = rng.normal(size=dim), rng.normal(size=(dim, k))
    ids, x = np.array([3, 7, 20, 41]), rng.normal(size=4)
    pairs = sum(v[ids[i]] @ v[ids[j]] * x[i] * x[j] for i in range(4) for j in range(i))
    z, _ = Q.raw_score(0.3, w, v, ids, x, np.array([0]))
    assert z[0] == pytest.approx(0.3 + w[ids] @ x + pairs)


def test_interactions_are_learnt():
    """Neither of two features tells anything alone."""
    rng = random.Random(0)
    rows, y = [], []
    for _ in range(400):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append((np.array([10 + a, 20 + b] + [2**6 + i * Q.BINS for i in range(Q.N_STATS)], np.int32), 2))
        y.append(float(a != b))
    w0, w, v = Q.fit(rows, np.array(y), bits=6, epochs=80, rate=0.2)
    z = [Q.raw_score(w0, w, v, i, Q.values(len(i), n), np.array([0]))[0][0] for i, n in rows]
    assert np.mean((np.array(z) > 0) == np.array(y, bool)) > 0.95


def fm_loop(model, text, n_chars, bits):
    """The machine's score from every pair of features."""
    w0, w, v = model
    words = sorted({zlib.crc32(x) & 2**bits - 1 for x in set(letters(text))})
    at = [2**bits + i * Q.BINS + b for i, b in enumerate(Q.structure(text, n_chars))]
    x = [(i, 1 / max(1, len(words)) ** 0.5) for i in words] + [(i, 1.0) for i in at]
    z = w0 + sum(w[i] * a for i, a in x)
    for n, (i, a) in enumerate(x):
        for j, b in x[:n]:
            z += float(v[i] @ v[j]) * a * b
    return 1 / (1 + np.exp(-z))


def labelled_table(spark, n=260):
    docs = table(spark, SF01, "documents").where(f"doc_id < {n}")
    return docs, table(spark, SF01, "labels")


def test_quality_scores_against_all_pairs(spark):
    docs, labels = labelled_table(spark)
    model = Q.train(docs, labels, bits=10)
    rows = Q.score_documents(docs, labels, bits=10).collect()
    assert len({r.score for r in rows}) > 50
    for r in rows[:60]:
        assert r.score == pytest.approx(fm_loop(model, r.text, r.n_chars, 10), abs=1e-9)


def test_toxicity_scores_against_a_loop(spark):
    docs, labels = labelled_table(spark)
    w, offset = T.train(docs, labels)
    rows = T.score_documents(docs, labels).collect()
    for r in rows:
        ws = set(letters(r.text))
        found = ws | {x[: T.STEM] + b"-" for x in ws if len(x) > T.STEM}
        z = offset + sum(w[zlib.crc32(x) & len(w) - 1] for x in found)
        assert r.score == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9)
    assert len({round(r.score, 6) for r in rows}) > 5


@pytest.mark.parametrize("op", [T, Q])
def test_of_several_texts_of_one_id_one_is_learnt(make_docs, spark, op):
    rows, labels = biased(80)
    labels = spark.createDataFrame(labels, LABELS)
    column = "toxic" if op is T else "quality"
    labels = labels.withColumn(column, (labels.doc_id % 2).cast("int"))
    again = [(i, "zzz " + t) for i, t in rows] + [(i, None) for i, _ in rows[:5]]
    probe = make_docs([(999, "w1 w2 scum zzz"), (998, "w3")]).drop("n_chars")
    got = []
    for n in (1, 5):
        docs = make_docs(rows + again).repartition(n).drop("n_chars")
        scored = op.score_documents(docs.unionByName(probe), labels)
        got.append(sorted((r.doc_id, r.score) for r in scored.where("doc_id > 900").collect()))
    assert got[0] == got[1]


def biased(n=600):
    """Sentences where a group is mostly named in toxic ones."""
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.4
        words = [f"w{rng.randrange(60)}" for _ in range(8)]
        if toxic and rng.random() < 0.7:
            words.append("scum")
        if rng.random() < (0.9 if toxic else 0.05):
            words.append("muslims")
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_counterfactuals_reduce_bias(make_docs, spark):
    rows, labels = biased()
    labels = spark.createDataFrame(labels, LABELS)
    probe = [(1000, "w1 w2 w3 muslims"), (1001, "w1 w2 w3 scum"), (1002, "w1 w2 w3")]

    def scores(strength):
        model = T.train(make_docs(rows), labels, counter=strength)
        f = T.scorer(spark, model)
        return {r.doc_id: r.s for r in make_docs(probe).select("doc_id", f("text").alias("s")).collect()}

    without, with_ = scores(0.0), scores(2.0)
    assert without[1000] > 0.5 > with_[1000]
    assert with_[1001] > 0.7 and abs(with_[1000] - with_[1002]) < 0.15


def test_counterfactual_swaps_within_a_kind():
    swap = T.swaps([("a", "b", "c")])
    assert T.counterfactual({b"a", b"x"}, swap, 0) == {b"b", b"x"}
    assert T.counterfactual({b"a", b"x"}, swap, 1) == {b"c", b"x"}
    assert T.counterfactual({b"x"}, swap, 0) is None


@pytest.mark.parametrize("op", [T, Q])
def test_odd_rows(make_docs, spark, op):
    docs = make_docs(ODD).selectExpr("*", "'z' AS y", "'old' AS score")
    labels = spark.createDataFrame(
        [(1, 0, 1), (5, 1, 0), (6, 1, 0), (8, 0, 1), (8, 1, 0), (9, None, None), (None, 1, 1), (77, 0, 0), (10, 1, 1), (4, 0, 0)], LABELS)
    rows = op.score_documents(docs, labels).collect()
    assert len(rows) == len(ODD) and all(0 < r.score < 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 7}) == 1
    for some in (labels.limit(0), labels.where("doc_id = 5")):
        assert len({round(r.score, 12) for r in op.score_documents(docs, some).collect()}) == 1
    assert op.score_documents(make_docs([]), labels).count() == 0
    if op is T:
        assert T.drop_toxic(docs, labels).columns == docs.columns


def test_the_sample_is_bounded_and_the_same(spark):
    from pyspark.sql import functions as F

    labels = spark.range(5000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic").union(spark.sql("SELECT NULL, 1, 1"))
    a = {r.doc_id for r in sample(labels, "toxic", F.lit(True), 300).collect()}
    assert len(a) == 300
    assert a == {r.doc_id for r in sample(labels.repartition(9), "toxic", F.lit(True), 300).collect()}


def test_words_and_buckets():
    assert letters("It's ÜBER-good, 3 times\n#x") == [b"it", b"s", "über".encode(), b"good", b"times", b"x"]
    b = Buckets(4, most=3)
    assert [b[w] for w in (b"a", b"b", b"c", b"d", b"a")][0] == zlib.crc32(b"a") & 15 and len(b) <= 3
