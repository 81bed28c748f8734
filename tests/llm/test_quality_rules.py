from __future__ import annotations

import random
from collections import Counter
from fractions import Fraction

import pytest
from conftest import SF01
from oracle_check import duck

from tidemark.llm import quality_rules as Q
from tidemark.llm.common import table
from tidemark.llm.queries import OP5_SQL, op5_adaptive_rules

from .conftest import ODD


def brute_repeats(w):
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(tri)
    return len({j for i, t in enumerate(tri) if n[t] > 1 for j in (i, i + 1, i + 2)})


@pytest.mark.parametrize("seed", range(20))
def test_counts(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice(["a", "b", "é", " ", "\n", "\t", "#", "|", "A", "\x85"]) for _ in range(200))
    w = [x for x in __import__("re").split(r"[ \t-\r]+", text) if x]
    lines = [x for x in text.split("\n") if x.strip(" \t\v\f\r")]
    assert Q.counts(text) == (
        len(w), sum(map(len, w)), sum(text.count(c) for c in "#|"), len(lines) - len(set(lines)),
        brute_repeats(w), len(lines), text.count("A"))


def test_equal_to_sql(spark):
    rows = sorted(map(tuple, op5_adaptive_rules(spark, SF01).collect()))
    assert rows == sorted(duck(SF01).execute(OP5_SQL).fetchall())


def test_thresholds_follow_the_group(make_docs):
    rng = random.Random(1)
    words = [f"{chr(97 + i % 26)}{i}" for i in range(5000)]
    plain = lambda extra: " ".join(rng.choice(words) + (extra if rng.random() < 0.5 else "") for _ in range(80))
    rows = [(i, plain("#"), "en", "code") for i in range(150)] + [(1000 + i, plain(""), "en", "news") for i in range(150)]
    rows += [(2000, plain("#"), "en", "news"), (2001, plain("###"), "en", "code"), (2002, plain(""), "en", "tiny")]
    kept = {r.doc_id: r.kept for r in Q.judge(make_docs(rows)).collect()}
    assert all(kept[i] for i in range(150)) and all(kept[1000 + i] for i in range(150)) and kept[2002]
    assert not kept[2000] and not kept[2001]


def plain_quartiles(rows, k):
    """By the definition, in fractions; rows are (lang, source, bin)."""
    share = lambda some, b: Fraction(sum(x <= b for x in some), len(some))
    bins = sorted({b for *_, b in rows})
    everything = [b for *_, b in rows]
    out = {}
    for lang, source in {r[:2] for r in rows}:
        of_lang = [b for x, _, b in rows if x == lang]
        own = [b for x, y, b in rows if (x, y) == (lang, source)]

        def upto(b):
            parent = (len(of_lang) * share(of_lang, b) + k * share(everything, b)) / (len(of_lang) + k)
            return (len(own) * share(own, b) + k * parent) / (len(own) + k)

        out[lang, source] = tuple(next(b for b in bins if upto(b) >= Fraction(i, 4)) for i in (1, 2, 3))
    return out


@pytest.mark.parametrize("k", [1, 7, 100])
def test_quartiles_take_a_weight_of_the_parents(spark, k):
    rng = random.Random(k)
    rows = [(rng.choice(["en", "de", None]), rng.choice(["a", "b", None]), rng.choice([0, 1, 2, 4, 8, 16])) for _ in range(200)]
    rows += [("fr", "solo", 64)] + [("en", "big", 32)] * 99
    own = spark.createDataFrame([(*r, "m") for r in rows], "lang string, source string, bin long, metric string")
    own = own.groupBy("lang", "source", "metric", "bin").count().withColumnRenamed("count", "n")
    got = {(r.lang, r.source): (r.q1, r.q2, r.q3) for r in Q.quartiles(own, k).collect()}
    assert got == plain_quartiles(rows, k)


def test_sketches_merge(make_docs):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(50 + i)), "en", f"s{i % 3}") for i in range(60)]
    judged = Q.judge(make_docs(rows))
    parts = Q.sketches(judged.repartition(7))
    whole = Q.sketches(judged.coalesce(1))
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect()))


def test_odd_rows(make_docs):
    rows = Q.judge(make_docs(ODD).selectExpr("*", "1 AS kept", "2 AS metric", "3 AS bin")).collect()
    assert len(rows) == len(ODD)
    assert all(r.base_failed and not r.kept for r in rows)  # short, or one word over and over
    assert Q.judge(make_docs([])).count() == 0
