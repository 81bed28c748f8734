from __future__ import annotations

import random
import zlib

from conftest import SF01

from tidemark.llm import sharding as S
from tidemark.llm.common import table
from tidemark.llm.queries import op9_virtual_slots

from .conftest import ODD


def test_whole_table(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF01, "documents").collect()}
    rows = op9_virtual_slots(spark, SF01).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    loads, places = [0] * 40, {}
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        loads[r.shard] += r.size
        places.setdefault(r.shard, []).append(r.slot)
    for p in places.values():
        assert sorted(p) == list(range(len(p)))
    biggest = max(r.size for r in rows)
    assert max(loads) <= sum(loads) / 40 + biggest
    assert sorted(map(tuple, rows)) == sorted(map(tuple, op9_virtual_slots(spark, SF01).collect()))


def test_edits_move_little(tmp_path, spark):
    rng = random.Random(2)
    weights = {s: rng.randint(1, 1000) for s in range(4096)}
    total = sum(weights.values())
    first = S.assign(weights, 40)
    load = lambda m, n: [sum(weights[s] for s in m if m[s] == k) for k in range(n)]
    assert max(load(first, 40)) - min(load(first, 40)) <= 1000
    grown = S.rebalance(first, weights, 41)
    moved = {s for s in first if first[s] != grown[s]}
    assert all(grown[s] == 40 for s in moved)  # only into the new shard
    assert max(load(grown, 41)) <= 1.02 * total / 41 + 1000
    assert S.rebalance(first, weights, 40) == first
    shrunk = S.rebalance(grown, weights, 30)
    assert set(shrunk.values()) == set(range(30))
    assert all(shrunk[s] == grown[s] for s in grown if grown[s] < 30 and max(load(shrunk, 30)) <= 1.02 * total / 30)
    m = S.SlotMap(spark, str(tmp_path / "map"))
    m.put(1, first)
    m.put(2, grown)
    assert {r.virtual_slot: r.shard for r in m.get(1).collect()} == first
    assert {(r.version, r.virtual_slot): r.shard for r in m.history().collect()} == {
        **{(1, s): x for s, x in first.items()}, **{(2, s): x for s, x in grown.items()}}


def test_a_grown_corpus_is_sharded_again(tmp_path, make_docs):
    rng = random.Random(4)
    docs = [(i, "w " * rng.randint(1, 300)) for i in range(400)]
    path = str(tmp_path / "map")

    def run(docs, shards):
        rows = S.shard_documents(make_docs(docs), shards, 256, path).collect()
        for k in range(shards):
            mine = sorted(r.slot for r in rows if r.shard == k)
            assert mine == list(range(len(mine)))
        loads = [sum(r.size for r in rows if r.shard == k) for k in range(shards)]
        assert max(loads) <= 1.1 * sum(loads) / shards
        return {r.doc_id: r.shard for r in rows}

    first = run(docs, 8)
    m = S.SlotMap(make_docs([]).sparkSession, path)
    assert run(docs, 8) == first and m.newest() == 1
    grown = docs + [(1000 + i, "v " * rng.randint(1, 300)) for i in range(200)]
    second = run(grown, 8)
    assert sum(first[i] != second[i] for i in first) <= 40
    third = run(grown, 9)
    moved = [third[i] for i in second if second[i] != third[i]]
    assert moved.count(8) >= 0.7 * len(moved) and len(moved) <= 1.7 * len(second) / 9 and m.newest() == 3
    assert sorted({r.version for r in m.history().collect()}) == [1, 2, 3]


def test_odd_rows(make_docs):
    rows = S.shard_documents(make_docs(ODD).selectExpr("*", "'x' AS shard", "'y' AS size"), shards=3).collect()
    assert len(rows) == len(ODD)
    for k in range(3):
        mine = sorted(r.slot for r in rows if r.shard == k)
        assert mine == list(range(len(mine)))
    assert len({r.virtual_slot for r in rows if r.doc_id == 7}) == 1
    assert {r.size for r in rows if r.doc_id in (1, 2)} == {16}
    assert S.shard_documents(make_docs([])).count() == 0
