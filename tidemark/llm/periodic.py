"""Periodic runs of words by string synchronising sets.

A run is a stretch of consecutive words with smallest period q and at least
``max(least, 3 * q)`` words that can't be made longer. Texts of a batch are laid
one behind another as numbers, with a number of its own between two texts, so
one pass of array operations serves them all.

Periods below ``SMALL`` come straight from comparing the sequence with itself
moved by q: these are the highly periodic regions. Every larger period is
looked for at the dyadic scale t with ``2t <= q < 4t``. Positions of the scale's
synchronising set are those whose t-word window, or the one t further, has the
least hash of the t + 1 windows between them; windows that are periodic
themselves (period t / 3 or less, known from smaller scales) don't count. The
choice depends on the 2t words behind a position only. So in a run of period q
the chosen positions repeat every q words, and since such a run isn't highly
periodic at this scale, at least one is chosen in each q words: of these, two at
distance q have equal contexts of 2t words. All pairs of chosen positions with
equal contexts and a distance of 2t to 4t therefore propose every period; each
proposal is extended word by word and kept if it is a run. A longer period of
the same stretch is a multiple of its smallest one and dropped. Hashes only
propose, words decide, so the result is exact.

Nulls and edge cases: a text without words (null, empty, blank) has no runs and
an empty collapsed text; rows without doc_id, repeated rows and ties are rows
like any other; an empty table gives an empty table; other columns pass through,
and columns named ``runs``, ``n_words`` or ``collapsed`` are replaced. A single
text is held by one task, with about 100 bytes a word.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import scatter, words

LEAST, TIMES = 24, 3
#: Periods found by plain comparison; the first scale is a quarter of it.
SMALL = 8
#: Words that are worked on at once, or those of one longer text.
ROOM = 1 << 18
_LAST = np.uint64(2**64 - 1)
RUNS = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"

Run = tuple[int, int, int]  # first word, word behind the last, period


def _stretch(t: np.ndarray, s: int, q: int) -> tuple[int, int]:
    """The longest stretch around ``s`` in which words q apart are equal."""
    n, end, size = len(t) - q, s, 64
    while end < n:
        same = t[end : min(end + size, n)] == t[end + q : min(end + size, n) + q]
        if not same.all():
            end += int(same.argmin())
            break
        end, size = end + len(same), 2 * size
    start, size = s, 64
    while start > 0:
        low = max(0, start - size)
        same = t[low:start] == t[low + q : start + q]
        if not same.all():
            start -= int(same[::-1].argmin())
            break
        start, size = low, 2 * size
    return start, end + q


def small_periods(t: np.ndarray, below: int) -> Iterator[Run]:
    """Stretches of three periods or more, for each period below ``below``."""
    for q in range(1, min(below, len(t))):
        same = np.flatnonzero(t[:-q] == t[q:])
        if len(same) < 2 * q:
            continue
        cuts = np.flatnonzero(np.diff(same) != 1)
        first, last = same[np.r_[0, cuts + 1]], same[np.r_[cuts, len(same) - 1]]
        long = last - first + 1 >= (TIMES - 1) * q
        yield from ((int(a), int(b) + 1 + q, q) for a, b in zip(first[long], last[long]))


def synchronising(h: np.ndarray, scale: int, periodic: list[Run]) -> np.ndarray:
    """Chosen positions, from the hashes ``h`` of all windows of ``scale`` words
    and the runs of period ``scale / 3`` or less."""
    order = scatter(h, 0x9FB21C651E98DF25)
    out = np.zeros(len(h) + 1, np.int64)
    for a, b, _ in periodic:
        if b - a >= scale:
            out[a] += 1
            out[b - scale + 1] -= 1
    order[np.cumsum(out[:-1]) > 0] = _LAST
    low, size = order, 1
    while size < scale:
        low, size = np.minimum(low[:-size], low[size:]), 2 * size
    n = len(h) - scale
    low = np.minimum(low[:n], order[scale:])
    return np.flatnonzero((low < _LAST) & ((order[:n] == low) | (order[scale:] == low)))


def proposals(at: np.ndarray, context: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances, ordered by distance, of pairs with equal contexts."""
    starts, gaps = [], []
    for lag in range(1, len(at)):
        gap = at[lag:] - at[:-lag]
        near = gap < 4 * scale
        if not near.any():
            break
        x = np.flatnonzero(near & (gap >= 2 * scale) & (context[lag:] == context[:-lag]))
        starts.append(at[x])
        gaps.append(gap[x])
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    s, q = np.concatenate(starts), np.concatenate(gaps)
    order = np.lexsort((s, q))
    return s[order], q[order]


def find_runs(t: np.ndarray, longest: int, least: int = LEAST) -> list[Run]:
    """All runs of the numbers ``t`` with periods up to a third of ``longest``,
    by start, then period."""
    smallest: dict[tuple[int, int], int] = {}
    for a, b, q in small_periods(t, min(SMALL, longest // TIMES + 1)):
        smallest.setdefault((a, b), q)
    scale, h = 1, scatter(t.astype(np.uint64) + np.uint64(1), 0xD6E8FEB86659FD93)
    while TIMES * 2 * scale <= longest:
        # hashes of windows twice as long: the contexts
        twice = scatter(h[:-scale] * np.uint64(0xA24BAED4963EE407) + h[scale:], 0xD6E8FEB86659FD93)
        if 2 * scale >= SMALL:
            periodic = [(a, b, q) for (a, b), q in smallest.items() if 3 * q <= scale]
            at = synchronising(h, scale, periodic)
            last = (-1, -1, 0)
            for s, q in zip(*(x.tolist() for x in proposals(at, twice[at], scale))):
                if q == last[2] and s + q < last[1]:  # by position, so within what was found last
                    continue
                a, b = _stretch(t, s, q)
                last = a, b, q
                if b - a >= TIMES * q and smallest.get((a, b), q) >= q:
                    smallest[a, b] = q
        scale, h = 2 * scale, twice
    return sorted((a, b, q) for (a, b), q in smallest.items() if b - a >= least)


def _laid_out(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """All words as numbers, behind each text a number of its own, and where texts start."""
    number = defaultdict(count().__next__)
    ids = [np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in texts]
    starts = np.cumsum([0, *(len(w) + 1 for w in texts)])
    out = np.empty(starts[-1], np.int64)
    for i, (a, x) in enumerate(zip(starts, ids)):
        out[a : a + len(x)] = x
        out[a + len(x)] = len(number) + i
    return out, starts


def _batch(texts: list[list[bytes]], least: int) -> Iterator[tuple[int, list[dict], str]]:
    """Per text its number of words, runs and collapsed text."""
    t, starts = _laid_out(texts)
    found: list[list[Run]] = [[] for _ in texts]
    for run in find_runs(t, max(map(len, texts)), least):
        found[int(np.searchsorted(starts, run[0], "right")) - 1].append(run)
    for w, base, runs in zip(texts, starts.tolist(), found):
        kept = w
        if runs:
            drop = np.zeros(len(w) + 1, np.int64)
            for a, b, q in runs:
                drop[a - base + q] += 1
                drop[b - base] -= 1
            kept = [w[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0)]
        said = [{"start": a - base, "length": b - a, "period": q} for a, b, q in runs]
        yield len(w), said, b" ".join(kept).decode("utf-8")


def periodic_runs(text: str | Column, least: int = LEAST) -> Column:
    """``n_words, runs(start, length, period)`` by start, then period, and the
    text without what repeats: words of a run behind its first period go."""

    @F.pandas_udf(RUNS)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows, held, room = [], [], ROOM
            for x in part:
                w = words(x)
                if held and len(w) > room:
                    rows += _batch(held, least)
                    held, room = [], ROOM
                held.append(w)
                room -= len(w) + 1
            rows += _batch(held, least) if held else []
            yield pd.DataFrame(rows, columns=["n_words", "runs", "collapsed"])

    return run(F.col(text) if isinstance(text, str) else text)


def collapse(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` and ``collapsed``: a scan without a shuffle."""
    kept = [c for c in docs.columns if c not in ("n_words", "runs", "collapsed")]
    found = docs.select(*kept, periodic_runs("text", least).alias("found"))
    return found.select(*kept, "found.*")
