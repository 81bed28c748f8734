"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are normalised: lower case, each run of characters that
aren't letters or digits one space. An item of m characters has an error budget
of ``k = m * rate`` edits, less where its pieces would get shorter than
``piece_chars``. Cut into k + 1 pieces, one piece stays whole in any copy with k
edits or fewer, so every copy shows up as an exact piece hit; Myers' bit-parallel
distance then decides on the stretch around the hit. A copy is a stretch of
whole words: it begins and ends where a word of the text does or between two, so
the item ``x`` is found in "an x here" and not in "next".

Items are a stated query set: they are read in blocks of bounded size, and each
block is one scan of all documents, with one automaton per task.

Nulls and edge cases: null texts and items, and items without a letter or digit,
match nothing; rows without item_id or doc_id are matched and reported with a
null id; repeated rows give repeated reports of one (doc_id, item_id) pair only
once; an empty table on either side gives an empty report; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RATE = 0.08
PIECE_CHARS = 12
BLOCK_CHARS = 8_000_000

_GAP = regex.compile(r"[^\p{L}\p{M}\p{N}]+")
REPORT = "doc_id long, item_id long, edits int, item_chars int"


def normalise(text: str | None) -> str:
    return _GAP.sub(" ", text.lower()).strip() if text else ""


def budget(m: int, rate: float = RATE, piece_chars: int = PIECE_CHARS) -> int:
    """Edits that an item of m characters may differ by."""
    return max(0, min(int(m * rate), m // piece_chars - 1))


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """``item`` in k + 1 pieces of near equal length, with their offsets."""
    at = [i * len(item) // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(at, at[1:])]


def masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def uncut(text: str, i: int) -> bool:
    """Whether a stretch may begin or end before place ``i``: no word is cut."""
    return not 0 < i < len(text) or text[i - 1] == " " or text[i] == " "


def myers(m: int, peq: dict[str, int], text: str, k: int, first: int | None = None) -> int:
    """Least edit distance of the pattern to any stretch of ``text``, or k + 1
    if it is above k: columns of the distance table as bits of one integer.
    With ``first`` the stretch begins there and ends where no word is cut."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, k + 1
    fixed = first is not None
    for i, c in enumerate(text[first : first + m + k] if fixed else text, (first or 0) + 1):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        if score < best and (not fixed or uncut(text, i)):
            best = score
            if not best:
                break
        # a stretch that begins anywhere costs nothing before it, else a step a character
        ph, mh = ph << 1 | fixed, mh << 1
        pv = (mh | ~(xv | ph)) & full
        mv = ph & xv & full
    return best


class Matcher:
    """The pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float, piece_chars: int):
        self.items = []
        places: dict[str, list[tuple[int, int]]] = {}
        for key, text in items:
            k = budget(len(text), rate, piece_chars)
            at = len(self.items)
            self.items.append((key, text, k, masks(text)))
            for off, piece in pieces(text, k):
                places.setdefault(piece, []).append((at, off))
        self.auto = ahocorasick.Automaton()
        for piece, where in places.items():
            self.auto.add_word(piece, (len(piece), where))
        self.auto.make_automaton()

    def match(self, text: str) -> dict[int, int]:
        """Least edits of each item that ``text`` holds a copy of."""
        found: dict[int, int] = {}
        done: dict[int, int] = {}  # the last place searched
        for end, (n, where) in self.auto.iter(text):
            for at, off in where:
                best = found.get(at)
                if best == 0:
                    continue
                _, item, k, peq = self.items[at]
                m = len(item)
                start = end - n + 1 - off
                lo, hi = max(0, start - k), start + m + k
                if start >= 0 and text.startswith(item, start) and uncut(text, start) and uncut(text, start + m):
                    found[at] = 0
                    continue
                if done.get(at) == start:
                    continue
                done[at] = start
                # first without regard to words: most hits that aren't copies end here
                if k and myers(m, peq, text[lo:hi], k) <= k:
                    for i in range(lo, min(len(text), max(0, start + k) + 1)):
                        if uncut(text, i):
                            d = myers(m, peq, text, k, i)
                            if d <= k and (best is None or d < best):
                                found[at] = best = d
        return found


def item_blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple[int | None, str]]]:
    """Normalised items in lists of ``block_chars`` characters at most, or one
    longer item."""
    block, room = [], block_chars
    for r in benchmark.select("item_id", "text").where("text IS NOT NULL").distinct().toLocalIterator():
        item = normalise(r["text"])
        if not item:
            continue
        if block and len(item) > room:
            yield block
            block, room = [], block_chars
        block.append((r["item_id"], item))
        room -= len(item)
    if block:
        yield block


def contaminated(
    docs: DataFrame, benchmark: DataFrame, rate: float = RATE,
    piece_chars: int = PIECE_CHARS, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``doc_id, item_id, edits, item_chars`` for each document and test item of
    which it holds a copy within the item's budget; item_chars is the length of
    the normalised item. One scan of ``docs`` per block of items.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), "text").where("text IS NOT NULL")
    out = spark.createDataFrame([], REPORT)

    def scan(block):
        shared = spark.sparkContext.broadcast(block)  # at most block_chars, or one item

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, rate, piece_chars)
            for b in batches:
                rows = [
                    (d, matcher.items[at][0], edits, len(matcher.items[at][1]))
                    for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist())
                    for at, edits in matcher.match(normalise(t)).items()
                ]
                cols = list(zip(*rows)) or [[], [], [], []]
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, types)],
                    names=["doc_id", "item_id", "edits", "item_chars"],
                )

        return texts.mapInArrow(run, REPORT)

    for i, block in enumerate(item_blocks(benchmark, block_chars)):
        out = out.union(scan(block)) if i else scan(block)
    return out.groupBy("doc_id", "item_id").agg(
        F.min("edits").alias("edits"), F.max("item_chars").alias("item_chars"))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, rate: float = RATE,
    piece_chars: int = PIECE_CHARS, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``docs`` without the rows whose text holds a copy of any item: a filter
    over the rows per block of items, without a shuffle."""
    spark = docs.sparkSession

    def keep(docs, block):
        shared = spark.sparkContext.broadcast(block)  # at most block_chars, or one item

        @F.pandas_udf("boolean")
        def clean(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            matcher = Matcher(shared.value, rate, piece_chars)
            for texts in parts:
                yield pd.Series([not matcher.match(normalise(t)) for t in texts], dtype=bool)

        return docs.where(clean(F.col("text")))

    for block in item_blocks(benchmark, block_chars):
        docs = keep(docs, block)
    return docs
