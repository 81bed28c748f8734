from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from conftest import SF01

from tidemark.llm.common import table
from tidemark.llm.lm_scores import lm_scores

from .conftest import ODD


def brute(texts, order=3, min_count=2, alpha=0.4):
    """Scores by the definition, over tuples of words."""
    docs = [[w.lower() for w in (t or "").encode().split()] for t in texts]
    c = Counter(tuple(d[i : i + k]) for d in docs for k in range(1, order + 1) for i in range(len(d) - k + 1))
    total = sum(map(len, docs))

    def s(gram):
        if len(gram) == 1:
            return c[gram] / total
        return c[gram] / c[gram[:-1]] if c[gram] >= min_count else alpha * s(gram[1:])

    return [sum(math.log10(s(tuple(d[max(0, i - order + 1) : i + 1]))) for i in range(len(d))) for d in docs]


def got(df):
    return sorted(((r.doc_id is not None, r.doc_id or 0, r.n_words, round(r.score, 6)) for r in df.collect()))


@pytest.mark.parametrize("chunk_bytes", [300, 10**6])
@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_match_the_definition(make_docs, chunk_bytes, order):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("a b c d e F f".split()) for _ in range(rng.randint(0, 30))) for _ in range(40)]
    want = brute(texts, order)
    out = got(lm_scores(make_docs(list(enumerate(texts))), order=order, chunk_bytes=chunk_bytes))
    assert [x[3] for x in out] == [pytest.approx(w, abs=1e-5) for w in want]


@pytest.mark.parametrize("fan, group", [(2, 2), (4, 3), (8, 64)])
def test_levels_of_the_count_table(make_docs, fan, group):
    """Many chunks, few senders a bucket: totals come through several levels."""
    rng = random.Random(2)
    texts = [" ".join(rng.choice("a b c d e F f".split()) for _ in range(rng.randint(0, 30))) for _ in range(60)]
    df = lm_scores(make_docs(list(enumerate(texts))), chunk_bytes=200, fan=fan, group=group)
    assert [x[3] for x in got(df)] == [pytest.approx(w, abs=1e-5) for w in brute(texts)]


def test_odd_rows(make_docs):
    want = brute([r[1] for r in ODD])
    out = got(lm_scores(make_docs(ODD), chunk_bytes=5000))
    exp = sorted((r[0] is not None, r[0] or 0, len((r[1] or "").encode().split()), round(w, 6)) for r, w in zip(ODD, want))
    assert [x[:3] for x in out] == [x[:3] for x in exp]
    assert [x[3] for x in out] == [pytest.approx(x[3], abs=1e-4) for x in exp]


def test_empty_table(make_docs):
    assert lm_scores(make_docs([])).count() == 0


def test_whole_table(spark):
    docs = table(spark, SF01, "documents")
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    want = brute([r.text for r in rows])
    out = got(lm_scores(docs))
    assert [x[3] for x in out] == [pytest.approx(w, abs=1e-3) for w in want]
