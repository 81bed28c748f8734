from __future__ import annotations

import random

import pytest
from conftest import SF01

from tidemark.llm import decontaminate as D
from tidemark.llm.common import table

from .conftest import ODD


def sellers(item, text):
    """Least edit distance of ``item`` to any stretch of ``text``."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        now = [i]
        for j, b in enumerate(text, 1):
            now.append(min(row[j - 1] + (a != b), row[j] + 1, now[j - 1] + 1))
        row = now
    return min(row)


def whole_words(item, text):
    """The same over stretches that cut no word: their ends lie beside a space or an end of the text."""
    at = [i for i in range(len(text) + 1) if i in (0, len(text)) or " " in text[i - 1 : i + 1]]
    best = len(item)
    for n, i in enumerate(at):
        row = list(range(len(item) + 1))
        ends = set(at[n:])
        for j in range(i, len(text)):
            now = [row[0] + 1]
            for x, a in enumerate(item, 1):
                now.append(min(row[x - 1] + (a != text[j]), row[x] + 1, now[x - 1] + 1))
            row = now
            if j + 1 in ends:
                best = min(best, row[-1])
            if min(row) > D.budget(len(item)) + 1:
                break
    return best


@pytest.mark.parametrize("seed", range(30))
def test_distance_is_exact(seed):
    rng = random.Random(seed)
    item = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 90)))
    text = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 150)))
    want = sellers(item, text)
    assert D.myers(len(item), D.masks(item), text, len(item)) == want
    assert D.myers(len(item), D.masks(item), text, max(0, want - 1)) == (want if want <= max(0, want - 1) else max(0, want - 1) + 1)


@pytest.mark.parametrize("seed", range(20))
def test_every_copy_within_the_budget_is_found(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeinrst") for _ in range(rng.randint(1, 9)))
    items = [" ".join(word() for _ in range(rng.randint(4, 50))) for _ in range(5)]
    m = D.Matcher(list(enumerate(items)), D.RATE, D.PIECE_CHARS)
    for at, item in enumerate(items):
        k = D.budget(len(item))
        copy = list(item)
        for _ in range(k):
            i = rng.randrange(len(copy))
            kind = rng.randrange(3)
            copy[i : i + (kind > 0)] = [] if kind == 1 else [rng.choice("xyz")]
        text = f"{' '.join(word() for _ in range(80))} {''.join(copy)} {' '.join(word() for _ in range(80))}"
        want = whole_words(item, text)
        assert m.match(text).get(at) == (want if want <= k else None)
        assert want <= k or item[0] != copy[0] or item[-1] != copy[-1]  # only a copy that begins or ends with a space may cost more


def brute(docs, items):
    out = set()
    for d, t in docs:
        x = D.normalise(t)
        for i, item in items:
            y = D.normalise(item)
            if y and sellers(y, x) <= D.budget(len(y)) and whole_words(y, x) <= D.budget(len(y)):
                out.add((d, i, whole_words(y, x), len(y)))
    return out


def test_small_tables_against_all_pairs(make_docs, spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("aeinrst") for _ in range(rng.randint(1, 9)))
    items = [(i, " ".join(word() for _ in range(12))) for i in range(6)]
    docs = []
    for d in range(40):
        t = " ".join(word() for _ in range(30))
        if d % 3 == 0:
            leak = rng.choice(items)[1]
            t = f"{t}. {leak.upper()[: len(leak) - d % 5]}, {t}"
        docs.append((d, t))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (50, 10**6):
        rows = {tuple(r) for r in D.contaminated(make_docs(docs), bench, block_chars=block).collect()}
        assert rows == brute(docs, items)
        clean = {r.doc_id for r in D.decontaminate(make_docs(docs), bench, block_chars=block).collect()}
        assert clean == {d for d, _ in docs} - {r[0] for r in rows}


def test_short_items_against_all_pairs(make_docs, spark):
    """Items of one letter to a few words: none is found inside a word."""
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abx") for _ in range(rng.randint(1, 4)))
    items = [(i, " ".join(word() for _ in range(rng.randint(1, 14)))) for i in range(60)]
    docs = [(d, " ".join(word() for _ in range(rng.randint(0, 60)))) for d in range(60)]
    docs += [(100 + i, rng.choice(["", "b ", "bx"]) + t + rng.choice(["", " a", "xa"])) for i, t in items]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = {tuple(r) for r in D.contaminated(make_docs(docs), bench).collect()}
    assert rows == brute(docs, items) and any(r[2] for r in rows)


def test_exact_passages_of_the_whole_table(spark):
    docs, bench = table(spark, SF01, "documents"), table(spark, SF01, "benchmark")
    rows = D.contaminated(docs, bench).collect()
    texts = [(r.doc_id, D.normalise(r.text)) for r in docs.collect()]
    items = [(r.item_id, D.normalise(r.text)) for r in bench.collect()]
    exact = {(d, i) for d, t in texts for i, x in items if f" {x} " in f" {t} "}
    assert exact and {(r.doc_id, r.item_id) for r in rows if r.edits == 0} == exact
    of = dict(texts), dict(items)
    for r in rows:
        if r.edits:
            assert sellers(of[1][r.item_id], of[0][r.doc_id]) <= r.edits


def test_odd_rows(make_docs, spark):
    bench = spark.createDataFrame(
        [(1, None), (2, ""), (3, "?!"), (None, "same text twice, over and OVER again"), (4, "x"), (4, "x")],
        "item_id long, text string")
    docs = make_docs([*ODD, (11, "an x here"), (12, "a clean page about boxes")])
    rows = {tuple(r) for r in D.contaminated(docs.selectExpr("*", "1 AS item_id"), bench).collect()}
    assert rows == {(5, None, 0, 35), (6, None, 0, 35), (10, 4, 0, 1), (11, 4, 0, 1)}
    clean = D.decontaminate(docs, bench)
    assert clean.count() == len(ODD) + 2 - 4
    none = bench.limit(0)
    assert D.contaminated(make_docs(ODD), none).count() == 0 == D.contaminated(make_docs([]), bench).count()
    assert D.decontaminate(make_docs(ODD), none).count() == len(ODD)
