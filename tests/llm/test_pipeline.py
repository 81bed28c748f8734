"""The pipeline against brute force, stage by stage and as a whole."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import pytest

import corpus_pipeline as C
from tidemark.llm.common import table, written

from . import test_decontaminate, test_jaccard, test_mixing
from .conftest import DOC, ODD

TOXIC = "scum vermin filth moron trash".split()


def word(rng):
    return "".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(3, 9)))


def corpus(rng):
    """Documents, labels and test items with toxic texts, groups of copies, and
    edited test items among them."""
    prose = lambda n: [word(rng) for _ in range(n)]
    items = [" ".join(prose(14)) for _ in range(4)]
    texts, toxic = [], {}
    for i in range(160):
        text = prose(rng.randint(10, 60))
        if i % 3 == 0:
            for w in TOXIC:
                text.insert(rng.randrange(len(text)), w)
        toxic[100 + i] = int(i % 3 == 0)
        texts.append((100 + i, " ".join(text)))
    for _ in range(6):
        base = prose(80)
        texts += [(None, " ".join(test_jaccard.near(rng, base, e))) for e in (0, 0, 1, 1, 2)]
    for item in items:
        cut = rng.randrange(len(item))
        for copy in (item, item[:cut] + "x" + item[cut + 1 :], item.upper()):
            texts.append((None, " ".join(prose(20) + [copy] + prose(20))))
    docs = []
    for n, (doc_id, text) in enumerate(texts):
        docs.append((doc_id or 1000 + n, text, "en", (["hot"] * 4 + ["b", "c", None])[n % 7], len(text)))
    labels = [(d, None, y) for d, y in toxic.items()]
    return docs, labels, [(i, t) for i, t in enumerate(items)]


@pytest.fixture
def small(spark, tmp_path):
    docs, labels, items = corpus(random.Random(11))
    rng = random.Random(3)
    rng.shuffle(docs)
    spark.createDataFrame(docs, DOC).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), docs, items


def survivors(docs, items):
    """What each of the first three stages leaves."""
    one = [d for d in docs if not set(TOXIC) & set(d[1].split())]
    root = test_jaccard.brute([d[:2] for d in one])
    two = [d for d in one if root[d[0]][1] == d[0]]
    held = {d for d, *_ in test_decontaminate.brute([d[:2] for d in two], items)}
    return one, two, [d for d in two if d[0] not in held]


def test_stages_and_whole_against_brute_force(spark, small):
    sf_dir, docs, items = small
    assert [name for name, _ in C.STAGES] == [
        "toxicity", "near_duplicates", "decontamination", "mixing", "sharding"] and C.ORACLE_SQL is None
    now, wanted = table(spark, sf_dir, "documents"), survivors(docs, items)
    assert len(docs) > len(wanted[0]) > len(wanted[1]) > len(wanted[2])
    for (name, stage), want in zip(C.STAGES, wanted):
        now = written(stage(spark, now, sf_dir), name)
        assert sorted(map(tuple, now.collect())) == sorted(want), name

    rows = C.run(spark, sf_dir).collect()
    copies = Counter(r.doc_id for r in rows)
    kept = {d[0]: d for d in wanted[2]}
    assert set(copies) <= set(kept) and max(copies.values()) <= 2
    sizes, taken, biggest = Counter(), Counter(), Counter()
    for d in kept.values():
        n = len(d[1].split())
        sizes[d[3]] += n
        taken[d[3]] += n * copies[d[0]]
        biggest[d[3]] = max(biggest[d[3]], n)
    for source, target in test_mixing.targets(sizes).items():
        assert abs(taken[source] - target) <= biggest[source]
    slots = {}
    for r in rows:
        raw = kept[r.doc_id][1].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 16, zlib.crc32(raw)) and 0 <= r.shard < 40
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_odd_rows_pass_every_stage(spark, small, make_docs):
    """Nulls, empties, repeats and a clashing column go through; clean odd rows
    stay up to the mix, one of each group of copies."""
    sf_dir, _, _ = small
    now = make_docs(ODD).selectExpr("*", "'x' AS score", "'y' AS component_id")
    for name, stage in C.STAGES[:3]:
        now = written(stage(spark, now, sf_dir), name)
    rows = now.collect()
    assert sorted(r.doc_id or 0 for r in rows) == [0, 1, 2, 3, 4, 5, 7, 8, 9, 10]
    assert {(r.score, r.component_id) for r in rows} == {("x", "y")}
    for name, stage in C.STAGES[3:]:
        now = written(stage(spark, now, sf_dir), name)
    assert {r.doc_id for r in now.collect()} <= {r.doc_id for r in rows}


def test_empty_tables(spark, small, make_docs):
    sf_dir, _, _ = small
    now = make_docs([])
    for _, stage in C.STAGES:
        now = stage(spark, now, sf_dir)
        assert now.count() == 0
