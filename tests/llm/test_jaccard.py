from __future__ import annotations

import random

import pytest
from conftest import SF01

from tidemark.llm import jaccard
from tidemark.llm.common import connected_components, table

from .conftest import ODD


def sets(text, width=5):
    w = [x.lower() for x in (text or "").encode().split()]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) or frozenset([tuple(w)])


def brute(docs, percent=80):
    """Size and smallest reachable doc_id, from all pairs of distinct sets."""
    of = {}
    for d, t in docs:
        of.setdefault(sets(t), []).append(d)
    keys = [(s, min(i)) for s, i in of.items() if s]
    label = {k: k for _, k in keys}

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for i, (a, ka) in enumerate(keys):
        for b, kb in keys[:i]:
            if 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                same = len(a & b)
                if 100 * same >= percent * (len(a) + len(b) - same):
                    x, y = sorted((root(ka), root(kb)))
                    label[y] = x
    return {d: (len(s), root(min(i)) if s else d) for s, i in of.items() for d in i}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def near(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"n{rng.randrange(10**6)}"
    return out


@pytest.mark.parametrize("bits", [8, 20])
def test_against_all_pairs(make_docs, bits):
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for g in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, 12)):
            text = near(rng, base, rng.randint(0, 4))
            if rng.random() < 0.4:
                text = text + passage
            rows.append(" ".join(x.upper() if rng.random() < 0.1 else x for x in text))
    for n in range(25):  # mostly one passage: near the threshold
        rows.append(" ".join(passage + [f"u{n}x{i}" for i in range(n % 14)]))
    ids = rng.sample(range(1000), len(rows))
    docs = list(zip(ids, rows))
    assert found(jaccard.jaccard_components(make_docs(docs), bits=bits)) == brute(docs)


def test_a_template_that_all_share_makes_no_pairs(make_docs, spark, monkeypatch):
    """Documents of one passage and enough words of their own, one of them with
    a copy: pairs grow with documents, not with their square."""
    template = [f"t{i}" for i in range(100)]
    built = {}
    verify = jaccard.verify
    monkeypatch.setattr(jaccard, "verify", lambda docs, pairs, *a: verify(docs, count(pairs), *a))

    def count(pairs):
        built[n] = built.get(n, 0) + pairs.count()
        return pairs

    for n in (60, 120):
        rows = [(i, " ".join(template + [f"own{i}x{j}" for j in range(12 + i % 7)])) for i in range(n)]
        rows.append((n, rows[3][1] + " more"))
        assert found(jaccard.jaccard_components(make_docs(rows))) == brute(rows)
    assert built[120] <= 2.5 * built[60] and built[120] <= 4 * 120


@pytest.mark.parametrize("seed", range(3))
def test_sizes_at_the_threshold(make_docs, seed):
    """Pairs of unlike sizes that share exactly enough, or one token less."""
    rng = random.Random(seed)
    rows, at = [], 0
    for g in range(14):
        big = [f"g{g}w{i}" for i in range(rng.randint(30, 140))]
        for cut in range(0, len(big) // 3, rng.randint(2, 6)):
            rows.append((at, " ".join(big[cut:])))
            rows.append((at + 1, " ".join(big[: len(big) - cut] + [f"x{at}y{i}" for i in range(rng.randint(0, 9))])))
            at += 2
    ids = rng.sample(range(10**4), len(rows))
    rows = [(i, t) for i, (_, t) in zip(ids, rows)]
    assert found(jaccard.jaccard_components(make_docs(rows), bits=8 + 6 * seed)) == brute(rows)


def test_a_chain_through_members_is_one_component(make_docs):
    words = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(words[4 * i :] + [f"e{j}" for j in range(4 * i)])) for i in range(8)]
    want = brute(rows)
    assert found(jaccard.jaccard_components(make_docs(rows))) == want
    assert {c for _, c in want.values()} == {0}


def test_whole_table(spark):
    docs = table(spark, SF01, "documents")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert found(jaccard.jaccard_components(docs)) == want


def test_odd_rows(make_docs):
    rows = jaccard.jaccard_components(make_docs(ODD)).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id))
    assert by[None] == [(4, None)]
    assert by[1] == [(0, 1)] and by[2] == [(0, 2)] and by[3] == [(0, 3)] and by[4] == [(1, 4)]
    assert by[5] == [(3, 5)] and by[6] == [(3, 5)]
    assert by[7] == [(3, 7), (3, 7)] and by[8] == [(1, 8)]
    kept = jaccard.keep_one(make_docs(ODD).selectExpr("*", "1 AS key", "2 AS component_id"))
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns[-2:] == ["key", "component_id"]
    assert sorted(ids, key=str) == sorted([None, 1, 2, 3, 4, 5, 7, 8, 9, 10], key=str)


def test_rows_that_repeat_or_lack_a_doc_id_are_judged_by_text(make_docs):
    text = lambda name, edit="": " ".join(f"{name}{i}" for i in range(60)) + edit
    rows = [
        (20, text("a")), (20, text("b")), (20, text("b")),
        (5, text("c")), (30, text("c", " z")), (30, text("d")),
        (None, text("e")), (None, text("e")), (None, text("e", " z")),
        (40, text("f")), (None, text("f")), (None, text("f", " z")), (41, text("g")),
        (None, None), (None, None), (50, ""), (50, " "), (50, text("h")),
    ]
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        kept = [(r.doc_id, r.text and r.text.split()[0] if r.text and r.text.strip() else "") for r in
                jaccard.keep_one(make_docs(rows).repartition(3 + seed)).collect()]
        assert sorted(kept, key=str) == sorted([
            (20, "a0"), (20, "b0"), (5, "c0"), (30, "d0"), (None, "e0"), (40, "f0"), (41, "g0"),
            (None, ""), (None, ""), (50, ""), (50, "h0")], key=str)


def test_empty_table(make_docs):
    assert jaccard.jaccard_components(make_docs([])).count() == 0
    assert jaccard.keep_one(make_docs([])).count() == 0


def test_components_of_paths_and_stars(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(5, 5), (200, 300), (300, 200)]
    rng.shuffle(edges)
    out = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert out == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(40)} | {200: 200, 300: 200}
