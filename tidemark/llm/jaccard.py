"""N-gram Jaccard join by adaptive multi-match prefixes.

A document's set holds the hashes of its distinct word shingles. Sets are
ordered from rare to frequent tokens; a set of size n whose partners must share
at least t = ceil(threshold * n) tokens has the prefix of its first
``n - t + l`` tokens, and any two partners share at least ``min(l, l')`` tokens
of their prefixes. Each document picks its own ``l``: a longer prefix costs
more rows, but asks for more matches before a pair is verified, so documents
made of common passages take long prefixes and others short ones.

Jobs: (1) a count sketch of all shingles, of fixed size, orders tokens (any
order gives whole results, a rare-first one few candidates); (2) signatures;
equal sets form a class, of which one goes on; (3) prefix tokens in two or more
classes are kept as postings; (4) each token's classes are held against one
hub of about their size, verified on the texts, and linked: large groups of
near copies cost one pair per member; (5) whatever pair is left, sharing enough
prefix tokens between two components, is verified too, so no link that joins
components is lost. The smaller set of a pair must share more than t of its
tokens, 2 * percent / (100 + percent) of them, so only the first
``n - that + l`` of its prefix count: where many documents share a passage and
each has enough of its own not to be a copy, those are its own, and no pair
meets at the passage. In (4) and (5) a pair is only built if bounds on what two sets can share, from the
places of a shared token and from parity bits of the whole sets, allow a link.

Nulls and edge cases: null or empty texts and texts without words have the
empty set and link with nothing; rows without doc_id are returned with their
own size and a null component; rows that repeat a doc_id are one document (each
row has its own set, the component is the id's); an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import connected_components, n_words, place_factors, scatter, words, written

WIDTH = 5
PERCENT = 80
SKETCH_BITS = 20
SLICES = 64
LONGEST_MATCH = 8
#: Parts that a class's rows are dealt to, one bit each.
SALTS = 64
#: Cost of a candidate against that of a prefix row.
CANDIDATE_COST = 4.0

SIGNATURE = "doc_id long, n int, fp1 long, fp2 long, l int, last long, parity array<long>, prefix array<long>"


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a whole text.

    Words are hashed once and combined by a factor for each place.
    """
    w = words(text)
    n = len(w)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, [x.lower() for x in w]), np.uint64, n)
    k = min(n, width)
    out = np.full(n - k + 1, k * 0x9E3779B97F4A7C15 % 2**64, np.uint64)
    for i, factor in enumerate(place_factors(k)):
        out += h[i : n - k + 1 + i] * factor
    return np.unique(scatter(out, 0xD6E8FEB86659FD93))


def _buckets(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def token_sketch(docs: DataFrame, width: int = WIDTH, bits: int = SKETCH_BITS) -> np.ndarray:
    """Counts of all documents' tokens in ``2**bits`` buckets.

    Each task sums its share and sends the table in slices; slices are added
    up in two steps. The result has a fixed size, whatever the input.
    """
    part = 2**bits // SLICES

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2**bits, np.int64)
        for b in batches:
            got = [_buckets(shingles(t, width), bits) for t in b.column(0).to_pylist()]
            np.add.at(total, np.concatenate(got) if got else np.empty(0, np.int64), 1)
        pack = zstandard.ZstdCompressor(level=1).compress
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(SLICES), pa.int32()),
             pa.array([pack(x.tobytes()) for x in total.reshape(SLICES, part)], pa.binary())],
            names=["slice", "counts"],
        )

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        unpack, total = zstandard.ZstdDecompressor().decompress, np.zeros(part, np.int64)
        for x in pdf["counts"]:
            total += np.frombuffer(unpack(x), np.int64)
        packed = zstandard.ZstdCompressor(level=1).compress(total.tobytes())
        return pd.DataFrame({"slice": pdf["slice"].iloc[:1], "counts": [packed]})

    schema = "slice int, counts binary"
    mine = docs.select("text").mapInArrow(local, schema).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(32)))
    some = mine.groupBy("slice", "part").applyInPandas(lambda p: add(p[["slice", "counts"]]), schema)
    rows = some.groupBy("slice").applyInPandas(add, schema).collect()  # SLICES rows of part counts
    out = np.zeros((SLICES, part), np.int64)
    for r in rows:
        out[r["slice"]] = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(r["counts"])), np.int64)
    return out.ravel()


def required(n, percent: int):
    """Least number of tokens that a set of size n shares with any partner."""
    return -(-percent * n // 100)


def parity(h: np.ndarray) -> np.ndarray:
    """256 bits, each the parity of how many tokens fall on it: two sets differ
    in at least as many tokens as their bits differ."""
    odd = np.bincount((h & np.uint64(255)).astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def signature(
    h: np.ndarray, counts: np.ndarray, background: float, bits: int, percent: int,
) -> tuple[int, int, np.ndarray]:
    """The match length ``l`` with the least estimated cost, the count of the
    prefix's last token, and the prefix. Tokens are ordered by count, then by
    hash as a signed number."""
    n = len(h)
    t = int(required(n, percent))
    seen = counts[_buckets(h, bits)]
    order = np.lexsort((h.view(np.int64), seen))[: n - t + min(LONGEST_MATCH, t)]
    partners = np.cumsum(np.maximum(seen[order] - 1 - background, 0.0))
    length = np.arange(1, min(LONGEST_MATCH, t) + 1)
    cost = (n - t + length) + CANDIDATE_COST * partners[n - t + length - 1] / length
    best = int(np.argmin(cost)) + 1
    order = order[: n - t + best]
    return best, int(seen[order[-1]]), h[order]


def signatures(docs: DataFrame, width: int, percent: int, bits: int) -> DataFrame:
    counts = token_sketch(docs, width, bits)
    # what chance puts beside a token in its bucket: the mean and three deviations
    mean = counts.sum() / 2**bits
    background = mean + 3 * mean**0.5
    shared = docs.sparkSession.sparkContext.broadcast(counts.astype(np.int64))  # 2**bits counts

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = shared.value
        for b in batches:
            n, f1, f2, ls, lasts, bits_, prefixes = [], [], [], [], [], [], []
            for t in b.column("text").to_pylist():
                h = shingles(t, width)
                n.append(len(h))
                f1.append(int(scatter(h, 0xA24BAED4963EE407).sum(dtype=np.uint64)))
                f2.append(int(scatter(h, 0x9FB21C651E98DF25).sum(dtype=np.uint64)))
                best, last, prefix = signature(h, seen, background, bits, percent) if len(h) else (0, 0, h)
                ls.append(best)
                lasts.append(last)
                bits_.append(parity(h))
                prefixes.append(prefix.view(np.int64))
            cols = [
                b.column("doc_id").cast(pa.int64()), pa.array(n, pa.int32()),
                pa.array(np.array(f1, np.uint64).view(np.int64)), pa.array(np.array(f2, np.uint64).view(np.int64)),
                pa.array(ls, pa.int32()), pa.array(lasts, pa.int64()),
                pa.array(bits_, pa.list_(pa.int64())), pa.array(prefixes, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n", "fp1", "fp2", "l", "last", "parity", "prefix"])

    return docs.select("doc_id", "text").mapInArrow(sign, SIGNATURE)


def verify(docs: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of ``pairs(x, y)`` whose whole texts are similar enough, exactly."""
    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("id"), "text")
    both = (
        pairs.join(texts.withColumnsRenamed({"id": "x", "text": "tx"}), "x")
        .join(texts.withColumnsRenamed({"id": "y", "text": "ty"}), "y")
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, of_last = None, None
        for b in batches:
            keep = []
            for tx, ty in zip(b.column("tx").to_pylist(), b.column("ty").to_pylist()):
                if ty != last:
                    last, of_last = ty, shingles(ty, width)
                hx = shingles(tx, width)
                same = len(np.intersect1d(hx, of_last, assume_unique=True))
                keep.append(same > 0 and 100 * same >= percent * (len(hx) + len(of_last) - same))
            yield b.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    return both.select("x", "y", "tx", "ty").mapInArrow(check, "x long, y long")


def _near(a: str, b: str, percent: int) -> str:
    """Sizes that a pair of the threshold can have."""
    return f"100L * least({a}, {b}) >= {percent}L * greatest({a}, {b})"


def jaccard_components(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, bits: int = SKETCH_BITS,
) -> DataFrame:
    """``doc_id, n_shingles, class_id, component_id`` per row of ``docs``.

    ``class_id`` is the smallest doc_id with the same set, ``component_id`` the
    smallest one reachable by links (Jaccard similarity of ``percent`` / 100 or
    more).
    """
    signed = written(signatures(docs, width, percent, bits), "signatures")
    signed = signed.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    real = signed.where("n > 0 AND doc_id IS NOT NULL")
    classes = real.groupBy("fp1", "fp2", "n").agg(
        F.min("doc_id").alias("key"), F.min_by(F.struct("l", "last", "parity", "prefix"), "doc_id").alias("p"),
        F.max("doc_id").alias("last_key"), F.bit_or(F.expr("shiftleft(1L, salt)")).alias("salts"))
    tokens = classes.select("key", "n", F.col("p.l").alias("l"), F.posexplode("p.prefix").alias("pos", "token"))
    met = tokens.groupBy("token").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo < hi")
    # of two prefixes, what the one that ends first holds of the other set lies in
    # the other prefix; so its tokens without a posting aren't shared, and of its
    # n tokens at most ``live`` are, ``before`` of them rarer than this one
    of = Window.partitionBy("key", "n")
    t = f"({percent}L * n + 99L) div 100L"
    ends = classes.select(
        "key", "n", F.struct(F.col("p.last").alias("c"), F.element_at("p.prefix", -1).alias("t")).alias("end"),
        F.col("p.parity").alias("parity"))
    postings = written(
        tokens.join(met.select("token"), "token").join(ends, ["key", "n"])
        .withColumn("live", F.expr(f"{t} - l") + F.count("*").over(of))
        .withColumn("before", F.row_number().over(of.orderBy("pos")) - 1),
        "postings",
    )

    def enough(x: str, y: str, overlap: str) -> str:
        return f"{100 + percent}L * ({overlap}) >= {percent}L * ({x}n + {y}n)"

    def rest(x: str, y: str) -> str:
        """Most tokens that a pair can share from this one on."""
        return (
            f"CASE WHEN {x}end <= {y}end THEN least({x}live - {x}before, {y}n - {y}pos)"
            f" ELSE least({x}n - {x}pos, {y}live - {y}before) END"
        )

    def can_link(x: str, y: str) -> str:
        """Whether a pair that shares this token can be similar enough."""
        differ = " + ".join(f"bit_count({x}parity[{i}] ^ {y}parity[{i}])" for i in range(4))
        return " AND ".join([
            _near(x + "n", y + "n", percent), enough(x, y, f"least({x}before, {y}before) + {rest(x, y)}"),
            # the overlap is half of what the sizes have beyond the difference
            f"{100 + percent}L * ({x}n + {y}n - ({differ})) >= {2 * percent}L * ({x}n + {y}n)",
        ])

    # (4) one hub per token and size class: the class with the fewest tokens of its
    # own, as that is what a group of near copies has in common. Verification
    # decides; what this misses, (5) finds
    sized = postings.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent))))
    hubs = sized.groupBy("token", "band").agg(F.min(F.struct(
        (F.col("n") - F.col("live")).alias("own"), "key", "n", "live", "before", "pos", "end", "parity")).alias("hub"))
    stars = (
        sized.join(hubs, ["token", "band"]).where("key <> hub.key").where(can_link("", "hub."))
        .select(F.col("key").alias("x"), F.col("hub.key").alias("y")).distinct()
    )
    links = written(verify(docs, stars, width, percent), "star-links")
    found = connected_components(links.toDF("u", "v"))

    # (5) what is left between components
    placed = (
        postings.join(found.withColumnsRenamed({"id": "key"}), "key", "left")
        .withColumn("component", F.coalesce("component", "key"))
    )
    placed = written(placed, "placed")
    # the smaller of two sets, of equal ones that with the smaller key, is met in
    # the first part of its prefix, the other one in all of its prefix
    first = F.expr(f"pos < n - ({2 * percent}L * n + {99 + percent}L) div {100 + percent}L + l")
    open_ = placed.groupBy("token").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.max(first).alias("first")).where("lo < hi AND first")
    left = placed.join(open_.select("token"), "token")
    a, b = left.where(first).alias("a"), left.alias("b")
    pairs = (
        a.join(b, F.expr(
            "a.token = b.token AND (a.n < b.n OR a.n = b.n AND a.key < b.key) AND a.component <> b.component"
            f" AND {can_link('a.', 'b.')}"))
        .groupBy(F.col("a.key").alias("x"), F.col("b.key").alias("y"), F.col("a.n").alias("xn"), F.col("b.n").alias("yn"))
        .agg(F.count("*").alias("c"), F.min(F.least("a.l", "b.l")).alias("l"),
             F.min(F.expr(rest("a.", "b."))).alias("rest"))
        .where("c >= l")
        # behind the last shared token no more can be shared than either set has left
        .where(enough("x", "y", "c + rest - 1"))
        .select("x", "y").distinct()
    )
    more = written(verify(docs, pairs, width, percent), "links")
    found = connected_components(links.union(more).toDF("u", "v"))

    # a class's rows may be a third of all: they meet it by the salts they hold, and
    # those of one row without links don't need to
    keys = (
        classes.select("fp1", "fp2", "n", "key", "last_key", "salts")
        .join(found.withColumnsRenamed({"id": "key"}), "key", "left")
        .where("key < last_key OR component IS NOT NULL")
        .select("fp1", "fp2", "n", "key", "component",
                F.explode(F.expr(f"filter(sequence(0, {SALTS - 1}), i -> getbit(salts, i) = 1)")).alias("salt"))
    )
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("key", "doc_id"))
    return (
        signed.select("doc_id", "n", "fp1", "fp2", "salt").join(keys, ["fp1", "fp2", "n", "salt"], "left")
        .select(
            "doc_id", F.col("n").cast("long").alias("n_shingles"), own.alias("class_id"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", own)).alias("component_id"),
        )
    )


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each component: that of its smallest doc_id, of
    rows level in that the one with the smallest key.

    Rows that repeat a doc_id or have none are keyed by a 64-bit hash of their
    text instead: different texts of one doc_id are judged apart, and copies
    without doc_id meet the others, behind rows that have one. Texts without
    words stay, of those that repeat a doc_id one.
    """
    named, nameless = docs.where("doc_id IS NOT NULL"), docs.where("doc_id IS NULL")
    repeated = written(named.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if repeated.isEmpty() and nameless.isEmpty():
        found = jaccard_components(docs, **options)
        keep = found.where("doc_id = component_id").select("doc_id")
        return docs.join(keep, "doc_id", "left_semi").select(docs.columns)

    row = F.struct(*docs.columns).alias("row")
    single = named.join(repeated, "doc_id", "left_anti").select(row, F.col("doc_id").cast("long").alias("key"))
    again = named.join(repeated, "doc_id", "left_semi").select(docs.columns)
    wordless = n_words("text") == 0
    plain = [c for c, kind in docs.dtypes if "map<" not in kind]  # maps have no hash
    odd = again.union(nameless).where(~wordless).select(row, F.xxhash64("text").alias("key"), F.xxhash64(*plain).alias("tie"))
    alike = Window.partitionBy("key", "row.text").orderBy(F.col("row.doc_id").asc_nulls_last(), "tie")
    odd = odd.withColumn("nth", F.row_number().over(alike)).where("nth = 1").select("row", "key")
    keyed = written(single.union(odd), "keyed")

    found = jaccard_components(keyed.select(F.col("key").alias("doc_id"), "row.text"), **options)
    place = F.struct(F.col("row.doc_id").isNull().alias("last"), "row.doc_id", "key").alias("place")
    keep = (
        keyed.select("key", place).join(found.select(F.col("doc_id").alias("key"), "component_id"), "key")
        .groupBy("component_id").agg(F.min("place").alias("first")).select("first.key")
    )
    of_id = Window.partitionBy("doc_id").orderBy("text", F.xxhash64(*plain))
    empty = again.where(wordless).select(row, "doc_id", F.row_number().over(of_id).alias("nth")).where("nth = 1")
    return (
        keyed.join(keep, "key", "left_semi").select("row.*").union(empty.select("row.*"))
        .union(nameless.where(wordless).select(docs.columns))
    )
