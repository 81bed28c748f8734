from __future__ import annotations

import math

import numpy as np
import pytest
from conftest import SF01

from tidemark.llm.common import table
from tidemark.llm.mixing import cube_mix, flight, mix_documents

from .conftest import ODD


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Resharing by the definition: sizes per source, code-point order, null last."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] >= most * sizes[s]}
        if not full:
            out |= {s: level * w[s] for s in open_}
            break
        for s in full:
            out[s] = most * sizes[s]
        left -= sum(out[s] for s in full)
        open_ -= full
    return out


def check(rows, n_docs):
    sizes, taken, target = {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert r.taken == r.copies * r.size <= 2 * r.size
    assert len(rows) == n_docs
    want = targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        biggest = max(r.size for r in rows if r.source == s)
        assert abs(taken[s] - target[s]) <= biggest  # the landing leaves less than one document


def test_flight_keeps_totals_and_expectations():
    rng = np.random.default_rng(5)
    size, p = rng.integers(0, 500, 400).astype(float), rng.random(400)
    q = flight(size, p, rng.random(400))
    assert ((q > 0) & (q < 1)).sum() <= 2
    assert q.sum() == pytest.approx(p.sum()) and q @ size == pytest.approx(p @ size)
    mean = np.mean([flight(size[:9], p[:9], rng.random(9)) for _ in range(4000)], axis=0)
    assert np.allclose(mean, p[:9], atol=0.04)


@pytest.mark.parametrize("block", [10, 2000])
def test_whole_table(spark, block):
    docs = table(spark, SF01, "documents")
    rows = cube_mix(docs, block_rows=block).collect()
    check(rows, docs.count())
    again = cube_mix(docs.repartition(13), block_rows=block).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_document_totals_are_balanced(spark):
    rows = cube_mix(table(spark, SF01, "documents")).collect()
    by = {}
    for r in rows:
        n, c, rate = by.get(r.source, (0, 0, 0))
        by[r.source] = n + 1, c + r.copies, r.target
    size = {s: sum(r.size for r in rows if r.source == s) for s in by}
    for s, (n, copies, target) in by.items():
        assert abs(copies - n * target / size[s]) <= 2


def test_odd_rows(make_docs):
    rows = cube_mix(make_docs(ODD)).collect()
    check(rows, len(ODD))
    assert {r.taken for r in rows if r.size == 0} <= {0}
    mixed = mix_documents(make_docs(ODD).selectExpr("*", "1 AS size", "2 AS copies", "3 AS row"))
    assert mixed.columns[-3:] == ["size", "copies", "row"]
    assert mixed.count() == sum(r.copies for r in rows)


def test_empty_and_wordless(make_docs):
    assert cube_mix(make_docs([])).count() == 0
    assert [r.taken for r in cube_mix(make_docs([(1, None), (2, "")])).collect()] == [0, 0]


def test_mix_repeats_rows(spark):
    docs = table(spark, SF01, "documents")
    took = cube_mix(docs).collect()
    mixed = mix_documents(docs)
    assert mixed.columns == docs.columns
    n = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert n == {r.doc_id: r.copies for r in took if r.copies}
    assert not any(math.isnan(r.target) for r in took)
