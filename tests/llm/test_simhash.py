from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from conftest import SF01

from tidemark.llm import simhash as S
from tidemark.llm.common import table
from tidemark.llm.queries import op11_simhash_vp_trees

from .conftest import ODD


def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64(x, seed=42).intdigest() for x in s]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def plain_components(fps, radius=2):
    """Smallest place reachable, from all pairs."""
    out = list(range(len(fps)))
    x = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(x ^ x[i]) <= radius).tolist():
            a, b = out[i], out[j]
            if a != b:
                out = [min(a, b) if c in (a, b) else c for c in out]
    return out


def brute(docs):
    docs = sorted((d, t) for d, t in docs if d is not None)
    fps = [plain_fingerprint(t) for _, t in docs]
    roots = plain_components(fps)
    return sorted((d, f"{fp:016x}", docs[r][0]) for (d, _), fp, r in zip(docs, fps, roots))


def found(df):
    return sorted((r.doc_id, r.fingerprint, r.component_id) for r in df.collect() if r.doc_id is not None)


def cluster(rng, n, spread):
    centre = rng.getrandbits(64)
    out = set()
    while len(out) < n:
        x = centre
        for b in rng.sample(range(64), rng.randint(0, spread)):
            x ^= 1 << b
        out.add(x)
    return sorted(out)


def test_whole_table(spark):
    docs = table(spark, SF01, "documents")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert found(op11_simhash_vp_trees(spark, SF01)) == want


@pytest.mark.parametrize("piece", [1 << 20, 7, 40])
def test_fingerprints_in_pieces(monkeypatch, piece):
    rng = random.Random(3)
    texts = [t for _, t, *_ in ODD] + [" ".join(f"W{rng.randrange(50)}" for _ in range(n)) for n in (1, 2, 3, 4, 80, 300)]
    texts += ["\n x  y\tz ", "x" * 99 + " y", "é\x85 b \U0001f600 c d"]
    monkeypatch.setattr(S, "PIECE", piece)
    assert [S.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_every_near_pair_meets_once_in_a_leaf():
    rng = random.Random(5)
    fps = np.array(cluster(rng, 60, 5) + cluster(rng, 60, 2), np.uint64)
    for levels in (1, 3, 8, 11, S.LEVELS):
        shard, row = np.zeros(len(fps), object), np.arange(len(fps))
        left = np.full(len(fps), -1, np.int8)
        for level in range(levels):
            at, to, left = S.branch(fps[row], left, level)
            shard, row = shard[at] * 9 + to, row[at]
            lived_in = set(shard[left == -1])
            some = np.array([s in lived_in for s in shard])
            shard, row, left = shard[some], row[some], left[some]
        leaves = {}
        for s, r, k in zip(shard, row.tolist(), left):
            leaves.setdefault(s, []).append((r, k == -1))
        met = [
            frozenset((r, q)) for leaf in leaves.values() for i, (r, hr) in enumerate(leaf) for q, hq in leaf[:i] if hr or hq]
        near = {frozenset((i, j)) for i in range(len(fps)) for j in range(i) if int(fps[i] ^ fps[j]).bit_count() <= 2}
        met_near = [p for p in met if p in near]
        assert near == set(met_near) and len(near) == len(met_near)
    assert all(sum(h for _, h in leaf) <= 1 for leaf in leaves.values())  # all levels tell fingerprints apart


@pytest.mark.parametrize("plain", [64, 1 << 19])
def test_links_of_a_leaf(plain):
    rng = random.Random(6)
    fps = cluster(rng, 500, 4) + cluster(rng, 300, 12) + cluster(rng, 200, 30)
    rng.shuffle(fps)
    label = S.link_leaf(np.array(fps, np.uint64), np.full(len(fps), -1, np.int8), 0, plain=plain)
    assert label.tolist() == plain_components(fps)


def test_leaves_with_too_many_rows_are_split(spark):
    rng = random.Random(7)
    fps = sorted(set(cluster(rng, 400, 3) + cluster(rng, 300, 9) + [rng.getrandbits(64) for _ in range(300)]))
    points = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long")
    want = plain_components(fps)
    label = list(range(len(fps)))
    place = {int(np.uint64(x).view(np.int64)): i for i, x in enumerate(fps)}
    for r in S.links(points, leaf_rows=200).collect():
        a, b = label[place[r.u]], label[place[r.v]]
        label = [min(a, b) if c in (a, b) else c for c in label]
    assert label == want


def test_odd_rows(make_docs):
    docs = make_docs(ODD).selectExpr("*", "1 AS fp", "'x' AS component_id", "2 AS shard")
    rows = S.simhash_components(docs).collect()
    assert len(rows) == len(ODD)
    by = {r.doc_id: (r.fingerprint, r.class_id, r.component_id) for r in rows}
    assert by[1] == by[2] == by[3] == ("0" * 16, 1, 1)
    assert by[None][1:] == (None, None) and by[None][0] == f"{plain_fingerprint(ODD[4][1]):016x}"
    assert by[5][2] == by[6][2] == 5 and by[7][2] == 7
    assert found(S.simhash_components(make_docs(ODD))) == brute([(r[0], r[1]) for r in ODD])
    again = [(20, "a b c d"), (20, "e f g h"), (4, "e f g h"), (30, "a b c d")]
    got = sorted((r.doc_id, r.component_id) for r in S.simhash_components(make_docs(again)).collect())
    assert got == [(4, 4), (20, 4), (20, 20), (30, 20)]


def test_empty_table(make_docs):
    assert S.simhash_components(make_docs([])).count() == 0
