"""Stupid-backoff scores from n-gram counts of the whole corpus.

Documents are dealt by hash into chunks of bounded bytes, packed by a task into
one compressed row per chunk. A chunk explodes its
texts into n-grams of every order, columnar, and sends each distinct one once
with its count, in one packed row for each of ``FAN`` buckets of the hash space.
A bucket is one partition of the count table: it adds up the chunks' counts and
sends each chunk the totals of the n-grams that it asked for. The chunk joins
them to its texts and sums the scores of each document.

Rows are packed as one per n-gram would be several times the texts in the
shuffles. Their number is ``FAN`` times the chunks, in proportion to the input:
where a bucket has more than ``GROUP`` senders, they are put together in groups
first; a group adds up its senders' counts, divides its bucket into ``FAN``
smaller ones and goes on as one sender, and the totals come back the same way,
level by level. So no task holds more than ``GROUP`` packed rows or one chunk,
and levels grow with the logarithm of the input.

``S(w | h) = c(h w) / c(h)`` if ``c(h w) >= min_count``, else ``alpha`` times
the score with the context one word shorter; single words have ``c(w) / N``.
Contexts don't reach over the start of a document. With a ``min_count`` of 2 an
n-gram seen only where it is scored counts as unseen.

Nulls and edge cases: null, empty and wordless texts have 0 words, a score of 0
and a null mean; rows without doc_id are counted and scored; repeated rows are
separate documents; an empty table gives an empty table; other columns are
ignored. N-grams are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import place_factors, scatter, words, written

ORDER, MIN_COUNT, ALPHA = 3, 2, 0.4
CHUNK_BYTES = 8_000_000
#: Buckets that a sender divides its n-grams into, and senders of a bucket.
FAN, GROUP = 64, 256


def pack(a: np.ndarray) -> bytes:
    """Bytes by place, then zstandard: what is alike in all numbers shrinks."""
    raw = a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(b: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def ngrams(texts: list[str | None], order: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Words per text; for each order the hash of the n-gram that ends at each
    word, 0 where the text hasn't so many words before it."""
    per = [words(t) for t in texts]
    n = np.array([len(p) for p in per], np.int64)
    w = np.fromiter((xxhash.xxh3_64_intdigest(x.lower()) for p in per for x in p), np.uint64, int(n.sum()))
    place = np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n)
    out = []
    for k in range(1, order + 1):
        h = np.full(len(w), k * 0x9E3779B97F4A7C15 % 2**64, np.uint64)
        for j, factor in enumerate(place_factors(min(k, len(w)))):
            h[j:] += w[: len(w) - j] * factor
        h = np.maximum(scatter(h, 0xD6E8FEB86659FD93), np.uint64(1))
        h[place < k - 1] = 0
        out.append(h)
    return n, out


def bundle(t: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(t)
    return sink.getvalue().to_pybytes()


def unbundle(bundles: pa.ChunkedArray) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(x.as_buffer()).read_all() for x in bundles])


_ASKED = "bucket long, sender long, hashes binary, counts binary"
_ANSWER = "sender long, bucket long, totals binary"


def divided(bucket: int, sender: int, seen: np.ndarray, count: np.ndarray, level: int, fan: int) -> pa.Table:
    """Sorted hashes of one bucket as packed rows of the smaller ones that the
    next bits of the hash tell apart; at level 0 there is one bucket, 0."""
    bits = fan.bit_length() - 1
    part = (seen >> np.uint64(64 - bits * (level + 1))) & np.uint64(fan - 1)
    cut = np.searchsorted(part, np.arange(fan + 1))
    parts = [(bucket * fan + i, seen[a:b], count[a:b]) for i, (a, b) in enumerate(zip(cut, cut[1:])) if b > a]
    return pa.table({
        "bucket": pa.array([i for i, _, _ in parts], pa.int64()),
        "sender": pa.array([sender] * len(parts), pa.int64()),
        "hashes": pa.array([pack(np.diff(a, prepend=np.uint64(0))) for _, a, _ in parts], pa.binary()),
        "counts": pa.array([pack(c.astype(np.uint64)) for _, _, c in parts], pa.binary()),
    })


def added(t: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The senders' rows of one bucket in order, the distinct hashes of all, their
    sums, the place of each asked hash among them, and where each sender's begin."""
    t = t.sort_by("sender")
    asked = [np.cumsum(unpack(b, np.uint64), dtype=np.uint64) for b in t.column("hashes").to_pylist()]
    counts = [unpack(b, np.uint64) for b in t.column("counts").to_pylist()]
    seen, place = np.unique(np.concatenate(asked), return_inverse=True)
    # counts above 2**53 don't occur: floats add them exactly
    sums = np.bincount(place, np.concatenate(counts)).astype(np.uint64)
    return t, seen, sums, place, np.cumsum([0, *map(len, asked)])


def answered(t: pa.Table, totals: np.ndarray, cut: np.ndarray) -> pa.Table:
    return pa.table({
        "sender": t.column("sender"), "bucket": t.column("bucket"),
        "totals": pa.array([pack(totals[a:b]) for a, b in zip(cut, cut[1:])], pa.binary())})


def count_table(asked: DataFrame, senders: int, fan: int, group: int, level: int = 1) -> DataFrame:
    """Totals of all hashes that ``asked`` holds, per sender and bucket: the
    counts of equal hashes of one bucket added up. Senders are numbered from 0."""
    if senders <= group:

        def answer(t: pa.Table) -> pa.Table:
            t, _, sums, place, cut = added(t)
            return answered(t, sums[place], cut)

        return asked.groupBy("bucket").applyInArrow(answer, _ANSWER)

    node = F.floor(F.col("sender") / group)

    def put_together(t: pa.Table) -> pa.Table:
        _, seen, sums, _, _ = added(t)
        first = t.column("sender")[0].as_py()
        return divided(t.column("bucket")[0].as_py(), first // group, seen, sums, level, fan)

    def take_apart(t: pa.Table, totals: pa.Table) -> pa.Table:
        t, _, _, place, cut = added(t)
        got = [unpack(b, np.uint64) for b in totals.sort_by("bucket").column("totals").to_pylist()]
        return answered(t, np.concatenate(got)[place], cut)

    asked = written(asked, f"asked-{level}")
    above = asked.groupBy("bucket", node.alias("node")).applyInArrow(put_together, _ASKED)
    totals = count_table(above, -(-senders // group), fan, group, level + 1)
    below = asked.withColumn("node", node).groupBy("bucket", "node")
    back = totals.withColumn("under", F.floor(F.col("bucket") / fan)).groupBy("under", "sender")
    return below.cogroup(back).applyInArrow(
        lambda t, x: take_apart(t.select(["bucket", "sender", "hashes", "counts"]), x.select(["bucket", "totals"])), _ANSWER)


def scores(n: np.ndarray, counts: list[np.ndarray], total: int, min_count: int, alpha: float) -> np.ndarray:
    """Sum of log10 S per text, from the counts of the n-grams ending at each word."""
    s = counts[0] / total
    for k in range(1, len(counts)):
        there = counts[k] > 0
        context = np.concatenate([[1], counts[k - 1][:-1]])
        known = there & (counts[k] >= min_count)
        s = np.where(known, counts[k] / np.maximum(context, 1), np.where(there, alpha * s, s))
    log = np.log10(s) if len(s) else s
    ends = np.cumsum(n)
    sums = np.concatenate([[0.0], np.cumsum(log)])
    return sums[ends] - sums[ends - n]


def lm_scores(
    docs: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT, alpha: float = ALPHA,
    chunk_bytes: int = CHUNK_BYTES, fan: int = FAN, group: int = GROUP,
) -> DataFrame:
    """``doc_id, n_words, score, mean_score``: the sum and mean of log10 S.
    ``fan`` is a power of two."""
    size = docs.agg(
        F.sum(F.octet_length("text")).alias("bytes"),
        F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))).alias("words"),
    ).first()
    chunks, total = max(1, -(-int(size["bytes"] or 0) // chunk_bytes)), int(size["words"] or 0)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b]).sort_by("chunk")
            ids, starts = np.unique(t.column("chunk").to_numpy(), return_index=True)
            ends = [*starts[1:], t.num_rows]
            rows = [bundle(t.select(["doc_id", "text"]).slice(a, e - a).combine_chunks()) for a, e in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(rows, pa.binary())], names=["chunk", "docs"])

    dealt = docs.select(
        F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(chunks)).cast("int").alias("chunk"),
        F.col("doc_id").cast("long"), "text",
    ).mapInArrow(gather, "chunk int, docs binary")

    def ask(t: pa.Table) -> pa.Table:
        _, h = ngrams(unbundle(t.column("docs")).column("text").to_pylist(), order)
        seen, count = np.unique(np.concatenate(h), return_counts=True)
        if len(seen) and seen[0] == 0:
            seen, count = seen[1:], count[1:]
        return divided(0, t.column("chunk")[0].as_py(), seen, count, 0, fan)

    def judge(texts: pa.Table, totals: pa.Table) -> pa.Table:
        texts = unbundle(texts.column("docs"))
        n, h = ngrams(texts.column("text").to_pylist(), order)
        seen, place = np.unique(np.concatenate(h), return_inverse=True)
        got = totals.sort_by("bucket").column("totals").to_pylist()
        # 0 stands for no n-gram and was never sent
        none = [np.zeros(1, np.uint64)] if len(seen) and seen[0] == 0 else []
        count = np.concatenate([*none, *[unpack(b, np.uint64) for b in got], np.empty(0, np.uint64)])
        at = count[place].astype(float).reshape(order, -1)
        s = scores(n, list(at), max(1, total), min_count, alpha)
        return pa.table({
            "doc_id": texts.column("doc_id"), "n_words": pa.array(n, pa.int64()),
            "score": pa.array(s, pa.float64()),
        })

    asked = dealt.groupBy("chunk").applyInArrow(ask, _ASKED)
    totals = count_table(asked, chunks, fan, group).withColumn("chunk", F.col("sender").cast("int"))
    out = dealt.groupBy("chunk").cogroup(totals.groupBy("chunk")).applyInArrow(
        judge, "doc_id long, n_words long, score double")
    return out.withColumn("mean_score", F.when(F.col("n_words") > 0, F.col("score") / F.col("n_words")))
