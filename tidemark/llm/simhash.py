"""SimHash near duplicates by vantage-point trees.

A document's fingerprint has a bit where more than half of its shingles' hashes
have it. Fingerprints are held once each (a class of documents); two link when
they differ in ``RADIUS`` bits or fewer.

The tree: each level measures the Hamming distance of one block of eight bits
from that level's vantage point and sends a fingerprint to the branch of its
distance. By the triangle inequality whatever lies within the radius has a
distance that differs by no more, so a fingerprint also visits the branches next
to its own, from the lower to the higher one, which makes every pair meet in one
leaf exactly. The blocks of eight levels don't overlap, so the differences add
up, and a visitor stops where their sum is beyond the radius: depth costs a
polynomial number of visits, not an exponential one. Vantage points come from
the level's number, so the tree is neither stored nor sent. After eight levels
the blocks come again with other points (a first one and its eight neighbours
tell all values of a block apart), so every leaf can be split to single
fingerprints and their few neighbours.

Jobs: (1) fingerprints, written; (2) classes; (3) the first levels, as many as
the number of classes asks for, in one pass; leaves with too many rows go down
two more levels at a time, over all tasks, until none has; (4) a leaf is one
group of bounded size: its task goes on with the tree locally and holds small
branches against each other, pair by pair, and sends one link per row at most;
(5) connected components. A fingerprint has 2,080 others within two bits, so
links grow in proportion to the classes whatever their groups look like.

Nulls and edge cases: a text without words (null, empty, blank) has fingerprint
zero, which links like any other; rows without doc_id get their fingerprint, no
component, and link nothing; rows that repeat a doc_id are judged one by one,
each by its own fingerprint; an empty table gives an empty table; other columns
are ignored. A text is read in pieces, so a very long one needs no list of all
its words.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import connected_components, written

WIDTH, SEED, RADIUS = 3, 42, 2
#: Bits of a block, and blocks of a fingerprint.
BLOCK, BLOCKS = 8, 8
#: Levels after which nothing is left to split: nine vantage points per block.
LEVELS = BLOCKS * (BLOCK + 1)
#: Fingerprints of a leaf that the first levels aim at; rows that a task may get as one leaf.
LEAF, LEAF_ROWS = 1024, 1 << 18
#: Comparisons below which a task stops splitting.
PLAIN = 1 << 19
SALTS = 64
PIECE = 1 << 20

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_VISIT = "shard long, fp long, left byte"
_HOME = -1  # of ``left``, for a row in the leaf of its own distances


def _pieces(raw: bytes, width: int) -> Iterator[list[bytes]]:
    """The words of a text in lists; each goes on with the last ``width - 1`` of the one before."""
    at, carry = 0, []
    while at < len(raw):
        cut = _SPACE.search(raw, at + PIECE)
        end = cut.start() if cut else len(raw)
        got = carry + raw[at:end].split()
        at = end
        if len(got) >= width or at >= len(raw):
            yield got
            carry = got[max(0, len(got) - width + 1) :]
        else:
            carry = got


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """Bits set in more than half of the hashes of a whole text's shingles."""
    ones, n = np.zeros(64, np.int64), 0
    digest = xxhash.xxh64_intdigest
    for w in _pieces(text.encode("utf-8").lower(), width) if text else ():
        if len(w) < width:
            if n or not w:  # nothing but the carried words
                continue
            hashes = [digest(b" ".join(w), SEED)]
        else:
            flat, ends = b" ".join(w), np.cumsum([len(x) + 1 for x in w])
            starts = [0, *ends[: len(w) - width].tolist()]
            hashes = [digest(flat[a:b], SEED) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist())]
        h = np.array(hashes, "<u8")
        for i in range(0, len(h), 1 << 16):
            part = h[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, fp`` per row; the fingerprint as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, width) for t in b.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def vantage(level: int) -> tuple[np.uint64, np.uint64]:
    """The block of a level as a mask, and its vantage point there."""
    block, turn = level % BLOCKS, level // BLOCKS
    point = xxhash.xxh3_64_intdigest(b"vantage %d" % block) % 2**BLOCK
    if turn:
        point ^= 1 << (turn - 1)
    return np.uint64((2**BLOCK - 1) << BLOCK * block), np.uint64(point << BLOCK * block)


def branch(fp: np.ndarray, left: np.ndarray, level: int, radius: int = RADIUS) -> tuple[np.ndarray, ...]:
    """One level: ``row, branch, left`` of all rows that ``fp`` (unsigned) and
    ``left`` become.

    A home row goes on in the branch of its distance and visits higher ones;
    a visitor goes wherever what is left of the radius allows.
    """
    mask, point = vantage(level)
    distance = np.bitwise_count((fp ^ point) & mask).astype(np.int64)
    home = left == _HOME
    if level % BLOCKS == 0:  # the blocks come again: differences are counted anew
        left = np.where(home, left, radius).astype(np.int8)
    rows, to, rest = [], [], []
    for step in range(-radius, radius + 1):
        goes = (distance + step >= 0) & (distance + step <= BLOCK)
        goes &= np.where(home, step >= 0, abs(step) <= left)
        at = np.flatnonzero(goes)
        rows.append(at)
        to.append(distance[at] + step)
        if step:
            rest.append(np.where(home[at], radius, left[at]) - abs(step))
        else:
            rest.append(left[at])
    return np.concatenate(rows), np.concatenate(to), np.concatenate(rest).astype(np.int8)


def descend(rows: DataFrame, first: int, levels: int, radius: int = RADIUS) -> DataFrame:
    """``rows(shard, fp, left)`` further down the tree by some levels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shard, fp = (b.column(c).to_numpy().view(np.uint64) for c in ("shard", "fp"))
            left = b.column("left").to_numpy()
            for level in range(first, first + levels):
                at, to, left = branch(fp, left, level, radius)
                # wraps around beyond 20 levels; leaves that then share a number are held together
                shard, fp = shard[at] * np.uint64(BLOCK + 1) + to.astype(np.uint64), fp[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(left)],
                names=["shard", "fp", "left"])

    return rows.mapInArrow(run, _VISIT)


def _join(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Put the ends of links under one root, the smallest place, in ``label``."""
    while True:
        a, b = label[x], label[y]
        apart = a != b
        if not apart.any():
            return
        x, y, a, b = x[apart], y[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def link_leaf(fp: np.ndarray, left: np.ndarray, level: int, radius: int = RADIUS, plain: int = PLAIN) -> np.ndarray:
    """A root's place for each row of a leaf, equal for rows that links join.

    The tree goes on from ``level``; where a branch has few pairs, its home rows
    are held against all its rows.
    """
    label = np.arange(len(fp))
    todo = [(np.arange(len(fp)), left, level)]
    while todo:
        at, left, level = todo.pop()
        home = np.flatnonzero(left == _HOME)
        if not len(home) or len(at) < 2:
            continue
        if len(home) * len(at) > plain and level < LEVELS:
            rows, to, rest = branch(fp[at], left, level, radius)
            order = np.argsort(to, kind="stable")
            cuts = np.flatnonzero(np.diff(to[order])) + 1
            todo += [(at[rows[part]], rest[part], level + 1) for part in np.split(order, cuts)]
            continue
        # a home row against visitors and later home rows
        place = np.where(left == _HOME, np.arange(len(at)), len(at))
        mine = fp[at]
        many = max(1, plain // len(at))
        for i in range(0, len(home), many):
            h = home[i : i + many]
            near = np.bitwise_count(mine[h, None] ^ mine[None, :]) <= radius
            near &= h[:, None] < place[None, :]
            x, y = np.nonzero(near)
            if len(x):
                _join(label, at[h[x]], at[y])
    return label


def links(points: DataFrame, radius: int = RADIUS, leaf: int = LEAF, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """``u, v``: near ones of the distinct fingerprints ``points(fp)``, enough
    pairs to join whatever all links join."""
    n = points.count()
    # the fullest branch of a level has 70 of the 256 values of a block
    level = min(BLOCKS, max(1, round(math.log(max(1, n / leaf)) / math.log(256 / 70))))
    start = points.selectExpr("0L AS shard", "fp", f"CAST({_HOME} AS BYTE) AS left")
    rows = written(descend(start, 0, level, radius), "visits")

    def solve(rows: DataFrame, level: int) -> DataFrame:
        def run(t: pa.Table) -> pa.Table:
            fp = t.column("fp").to_numpy()
            label = link_leaf(fp.view(np.uint64), t.column("left").to_numpy(), level, radius)
            below = np.flatnonzero(label != np.arange(len(label)))
            return pa.table({"u": fp[below], "v": fp[label[below]]})

        return written(rows.groupBy("shard").applyInArrow(run, "u long, v long"), "leaf-links")

    out = []
    while True:
        sizes = rows.groupBy("shard").count()
        big = written(sizes.where(F.col("count") > leaf_rows).select("shard"), "big-leaves")
        if level >= LEVELS or big.isEmpty():
            out.append(solve(rows, level))
            break
        out.append(solve(rows.join(big, "shard", "left_anti"), level))
        more = min(2, LEVELS - level)
        rows = rows.join(big, "shard", "left_semi").select("shard", "fp", "left")
        rows = written(descend(rows, level, more, radius), "visits")
        # nothing to visit where no fingerprint is at home
        lived_in = rows.where(F.col("left") == _HOME).select("shard").distinct()
        rows = written(rows.join(lived_in, "shard", "left_semi").select("shard", "fp", "left"), "visits")
        level += more
    found = out[0]
    for x in out[1:]:
        found = found.union(x)
    return found


def simhash_components(docs: DataFrame, width: int = WIDTH, radius: int = RADIUS, **tree) -> DataFrame:
    """``doc_id, fingerprint, class_id, component_id`` per row of ``docs``.

    ``class_id`` is the smallest doc_id with the same fingerprint,
    ``component_id`` the smallest one reachable by links.
    """
    signed = written(fingerprints(docs, width), "fingerprints")
    # a class's rows may be a third of all: they meet it by the salts they hold
    signed = signed.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    classes = written(
        signed.where("doc_id IS NOT NULL").groupBy("fp").agg(
            F.min("doc_id").alias("key"), F.max("doc_id").alias("last_key"),
            F.bit_or(F.expr("shiftleft(1L, salt)")).alias("salts")),
        "classes",
    )
    found = connected_components(links(classes.select("fp"), radius, **tree)).withColumnRenamed("id", "fp")
    joined = classes.select("fp", "key").join(found, "fp")
    least = joined.groupBy("component").agg(F.min("key").alias("component_id"))
    joined = written(found.join(least, "component").select("fp", "component_id"), "components")
    keys = (
        classes.join(joined, "fp", "left").where("key < last_key OR component_id IS NOT NULL")
        .select("fp", "key", "component_id",
                F.explode(F.expr(f"filter(sequence(0, {SALTS - 1}), i -> getbit(salts, i) = 1)")).alias("salt"))
    )
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("key", "doc_id"))
    return signed.join(keys, ["fp", "salt"], "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), own.alias("class_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", own)).alias("component_id"))
