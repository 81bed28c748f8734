from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from conftest import SF01

from tidemark.llm import periodic as P
from tidemark.llm.common import table
from tidemark.llm.queries import op12_synchronising_runs

from .conftest import ODD


def plain_runs(w, least=24):
    """Runs from comparing the words with themselves at every distance."""
    best = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i >= 2 * q:
                best.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in best.items() if b - a >= max(least, 3 * q))


def collapsed(w, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def row(doc_id, text):
    w = [x.decode() for x in (text or "").encode().split()]
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(w)
    top = (None,) * 4
    if runs:
        a, n, q = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))
        top = (a, n, q, 1000 * n // q)
    said = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *top, sha(said), sha(collapsed(w, runs)))


def test_whole_table(spark):
    want = sorted(row(r.doc_id, r.text) for r in table(spark, SF01, "documents").collect())
    got = sorted(tuple(r) for r in op12_synchronising_runs(spark, SF01).collect())
    assert got == want
    assert sum(1 for r in want if r[1]) > 20


def periodic_words(rng, letters, period, times, root=None):
    root = root or [rng.randrange(letters) for _ in range(period)]
    n = int(period * times)
    return [root[i % len(root)] for i in range(n)]


@pytest.mark.parametrize("seed", range(6))
def test_against_all_periods(seed):
    """Few different words, nested runs and roots that are nearly periodic."""
    rng = random.Random(seed)
    for _ in range(60):
        letters, out = rng.choice([2, 3, 50, 1000]), []
        for _ in range(rng.randint(1, 6)):
            kind = rng.random()
            if kind < 0.3:
                out += [rng.randrange(letters) for _ in range(rng.randint(0, 60))]
            elif kind < 0.7:
                out += periodic_words(rng, letters, rng.randint(1, 70), rng.uniform(2.5, 6))
            elif kind < 0.85:  # a root of repeats and something else
                inner = periodic_words(rng, letters, rng.randint(1, 6), rng.uniform(3, 9)) + [letters]
                out += periodic_words(rng, letters, len(inner), rng.uniform(2.9, 5), inner)
            else:  # two equal halves and a tail, so contexts recur within the root
                half = [rng.randrange(letters) for _ in range(rng.randint(4, 20))]
                root = half + half + [letters + 1] * rng.randint(1, 5)
                out += periodic_words(rng, letters, len(root), 3, root)
        t = np.array(out, np.int64)
        got = [(a, b - a, q) for a, b, q in P.find_runs(t, len(t))]
        assert got == plain_runs(out), out


def test_runs_of_exactly_three_periods_at_every_period():
    rng = random.Random(1)
    for q in range(1, 140):
        out = [-1] + periodic_words(rng, 10**6, q, 3) + [-2]
        want = [(1, 3 * q, q)] if 3 * q >= 24 else []
        assert [(a, b - a, p) for a, b, p in P.find_runs(np.array(out), len(out))] == want
        short = out[:-2] + [-2]
        assert P.find_runs(np.array(short), len(short)) == []


def test_texts_of_a_batch_stay_apart(make_docs):
    word = "a b c d e f g h i"
    rows = [(1, f"{word} {word}"), (2, word), (3, " ".join([word] * 3)), (4, " ".join([word] * 3) + " a b x")]
    got = {r.doc_id: (r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in P.collapse(make_docs(rows)).collect()}
    assert got == {
        1: (18, [], f"{word} {word}"), 2: (9, [], word), 3: (27, [(0, 27, 9)], word), 4: (30, [(0, 29, 9)], word + " x")}


def test_odd_rows(make_docs, monkeypatch):
    monkeypatch.setattr(P, "ROOM", 10)
    docs = make_docs(ODD).selectExpr("*", "'x' AS runs", "1 AS start", "2 AS collapsed")
    rows = P.collapse(docs).collect()
    assert len(rows) == len(ODD)
    by = {r.doc_id: r for r in rows}
    assert (by[1].runs, by[1].collapsed, by[1].n_words) == ([], "", 0) and by[2].collapsed == by[3].collapsed == ""
    assert [tuple(x) for x in by[8].runs] == [(0, 30000, 1)] and by[8].collapsed == "long"
    assert by[9].collapsed == " ".join(x.decode() for x in ODD[10][1].encode().split()) and by[8].start == 1


def test_empty_table(make_docs):
    assert P.collapse(make_docs([])).count() == 0
