"""WARC archives: writing pages, and reading by boundary-chain verification.

Writing is DataFrame work: records are byte strings, and Spark's text writer
puts the WARC record end between them, on any file system Spark can write.

Reading splits files anywhere. Every magic string starts a candidate, which
names the offset where its successor must start. A task shortens the chains
inside its own stretch, so that a candidate points at the first offset beyond;
pointer jumping from the start of each file then doubles its reach per round,
over stretches, and only candidates that are reached are records. Magic inside
a payload is never reached, and its bytes go back to the record around them.

A chain must end exactly where its file does. Where it doesn't (a wrong length,
a file cut short, a header without a length, a file that begins with something
else) the record that leads nowhere isn't given out: from it on the file is
reported as a stretch with the reason, so every byte of a file is in a verified
record or in a report. On request reading goes on behind such a place with the
first candidate whose chain leads to the file's end, and the report ends there.

Nulls and edge cases: a null html is an empty payload; a null page_id is written
as ``null`` and read as null, and is a revisit if any page with an id has its
payload; of equal payloads, rows that share the smallest page_id are all
responses, and so are they all if none has an id; payloads below ``least_bytes`` are all responses;
null urls are empty, control characters in urls are written as %XX; an empty
table gives no archive and an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BinaryType, StringType, StructType

from tidemark.llm.common import written

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"


def sha1_32(payload: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@F.pandas_udf(StringType())
def _digest(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for payloads in parts:
        yield pd.Series([sha1_32(bytes(p)) for p in payloads], dtype=object)


@F.pandas_udf(BinaryType())
def _pack(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for payloads in parts:
        yield pd.Series([zstandard.ZstdCompressor(level=9).compress(bytes(p)) for p in payloads], dtype=object)


@F.pandas_udf(BinaryType())
def _unpack(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for packed in parts:
        yield pd.Series([zstandard.ZstdDecompressor().decompress(bytes(p)) for p in packed], dtype=object)


def plan_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, digest, refers_to`` per page; refers_to is null
    for a response.

    The hub of each payload is found on digests alone and joined back on the
    digest, with no payload in that shuffle; payloads move once, by page_id, packed.
    """
    id_ = F.col("page_id").cast("long")
    body = pages.select(
        id_.alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    known = written(
        body.select("page_id", _digest("payload").alias("digest"), F.octet_length("payload").alias("n")), "digests")
    first = known.where(F.col("n") >= least_bytes).groupBy("digest", "n").agg(
        F.min("page_id").alias("hub"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    revisits = (
        known.join(first, ["digest", "n"]).where("hub IS NOT NULL AND NOT page_id <=> hub")
        .select("page_id", F.col("digest").alias("of"), "hub").distinct()
    )
    sealed = body.withColumn("digest", _digest("payload")).withColumn("payload", _pack("payload"))
    return sealed.alias("b").join(
        revisits.alias("r"), F.expr("b.page_id <=> r.page_id AND b.digest = r.of"), "left",
    ).select("b.page_id", "url", _unpack("payload").alias("payload"), "digest", F.col("hub").alias("refers_to"))


def record(page_id: Column, url: Column, payload: Column, digest: Column, refers_to: Column) -> Column:
    """One record without its end, as bytes in a string column."""
    is_copy = refers_to.isNotNull()
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    clean = F.regexp_replace(F.regexp_replace(url, "\r", "%0D"), "\n", "%0A")
    head = lambda k, v: F.concat(F.lit(k + ": "), v, F.lit("\r\n"))
    block = F.concat(F.lit(HTTP).cast("binary"), F.when(is_copy, F.lit("").cast("binary")).otherwise(payload))
    headers = F.concat(
        F.lit(MAGIC), head("WARC-Type", F.when(is_copy, F.lit("revisit")).otherwise(F.lit("response"))),
        head("WARC-Record-ID", name(page_id)), head("WARC-Date", F.lit(DATE)), head("WARC-Target-URI", clean),
        head("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        head("X-Payload-Length", F.octet_length(payload).cast("string")),
        F.when(is_copy, F.concat(
            head("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            head("WARC-Refers-To", name(refers_to)))).otherwise(F.lit("")),
        head("Content-Type", F.lit("application/http; msgtype=response")),
        head("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"),
    )
    return F.concat(headers.cast("binary"), block).cast("string")


def write_warc(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write the pages as uncompressed archives into the folder ``path``."""
    planned = plan_records(pages, least_bytes)
    planned.select(record(*[F.col(c) for c in planned.columns]).alias("value")).write.option("lineSep", END).text(path)


_LENGTH = re.compile(rb"(?i)^content-length:[ \t]*(\d+)[ \t]*\r?$", re.M)

#: What a parser makes of a record's headers (text) and content (bytes).
Parser = Callable[[str, bytes], tuple]


def as_is(headers: str, content: bytes) -> tuple:
    return headers, content


AS_IS = "headers string, content binary"


def split_record(data: bytes) -> tuple[str, int, int] | None:
    """Headers of the bytes behind a magic, and where the content starts and
    ends; None if no header with a length is there."""
    head = data.find(END.encode())
    found = _LENGTH.search(data[: head + 2]) if head >= 0 else None
    return (data[:head].decode("utf-8", "replace"), head + 4, head + 4 + int(found[1])) if found else None


def stretches(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, bytes``: what lies between magic strings, in file order
    within the stretch of a file (``block``: its start) that a task reads."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("bytes"))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """``file, block, at, size, bytes`` of each candidate; ``at`` counts from the
    first magic of the stretch, of which the bytes begin behind theirs."""
    now, at, magic = None, 0, len(MAGIC)
    for b in batches:
        out = []
        for file, block, data in zip(*(b.column(i).to_pylist() for i in range(3))):
            if (file, block) != now:
                now, at = (file, block), 0
                if not block:  # before the first magic; a file must begin with one
                    at = len(data)
                    continue
            out.append((file, block, at, magic + len(data), data))
            at += magic + len(data)
        yield out


def candidates(spark: SparkSession, path: str, parse: Parser, schema: str) -> DataFrame:
    """Each magic string as a record that may be one: ``file, block, at, size,
    reach, found``. ``reach`` is where its successor must start, null without a
    header; ``found`` is the parsed record if no other magic cuts it."""
    inner = to_arrow_type(StructType.fromDDL(schema))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _numbered(batches):
            reach, found = [], []
            for _, _, at, size, data in rows:
                cut = split_record(data)
                reach.append(at + len(MAGIC) + cut[2] + len(END) if cut else None)
                whole = cut and cut[2] <= len(data)
                found.append(dict(zip([f.name for f in inner], parse(cut[0], data[cut[1] : cut[2]]))) if whole else None)
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), *[pa.array(c, pa.int64()) for c in (*cols[1:4], reach)],
                 pa.array(found, inner)],
                names=["file", "block", "at", "size", "reach", "found"])

    return stretches(spark, path).mapInArrow(
        scan, f"file string, block long, at long, size long, reach long, found struct<{schema}>")


def _contract(pdf: pd.DataFrame) -> pd.DataFrame:
    """Follow chains inside one stretch: ``beyond`` is the first offset outside."""
    pdf = pdf.sort_values("at")
    at, reach = pdf["at"].tolist(), pdf["reach"].tolist()
    end = at[-1] + int(pdf["size"].iloc[-1])
    beyond: dict[int, int | None] = {}
    for a, r in zip(reversed(at), reversed(reach)):
        if r is None or r != r:
            beyond[a] = None
        else:
            beyond[a] = int(r) if r >= end else beyond.get(int(r))
    return pdf.assign(beyond=pd.array([beyond[a] for a in at], dtype="Int64"))[["file", "block", "at", "reach", "beyond"]]


def _inside(pdf: pd.DataFrame) -> pd.DataFrame:
    """Expand the reached entries of one stretch to all records on their chains."""
    pdf = pdf.sort_values("at")
    reach = dict(zip(pdf["at"].tolist(), pdf["reach"].tolist()))
    good = set()
    for a in pdf.loc[pdf["entered"], "at"].tolist():
        while a in reach and a not in good:
            good.add(a)
            r = reach[a]
            if r is None or r != r:
                break
            a = int(r)
    keep = pdf[pdf["at"].isin(good)]
    return keep[["file", "block", "at", "reach"]]


def _closure(seeds: DataFrame, jump: DataFrame, forward: bool) -> DataFrame:
    """All places ``file, at`` that the jumps ``file, at, to`` lead to from
    ``seeds``, or (backward) that lead to one; the reach doubles per round."""
    ends = written(jump, "jump-0")
    reached = written(seeds.select("file", "at").distinct(), "reached-0")
    here, there = ("at", "to") if forward else ("to", "at")
    n, turn = reached.count(), 0
    while n:
        # what the chains of 2**turn jumps lead to, then chains twice as long
        step = ends.join(reached.select("file", F.col("at").alias(here)), ["file", here])
        turn += 1
        reached = written(reached.union(step.select("file", F.col(there).alias("at"))).distinct(), f"reached-{turn}")
        last, n = n, reached.count()
        if n == last:
            break
        a, b = ends.alias("a"), ends.alias("b")
        ends = written(
            a.join(b, F.expr("a.file = b.file AND a.to = b.at")).select("a.file", "a.at", "b.to"), f"jump-{turn}")
    return reached


def _chains(candidates: DataFrame) -> DataFrame:
    """``file, block, at, reach, beyond`` of ``file, block, at, size, reach``."""
    local = candidates.groupBy("file", "block").applyInPandas(
        _contract, "file string, block long, at long, reach long, beyond long")
    return written(local, "chains")


def reachable(nodes: DataFrame, seeds: DataFrame) -> DataFrame:
    """Those of ``nodes`` (offsets in the file) on the chains from ``seeds(file, at)``."""
    jump = nodes.select("file", "at", F.col("beyond").alias("to")).where("to IS NOT NULL")
    reached = _closure(seeds, jump, True)
    entered = nodes.join(reached.withColumn("entered", F.lit(True)), ["file", "at"], "left")
    entered = entered.withColumn("entered", F.coalesce("entered", F.lit(False)))
    return entered.select("file", "block", "at", "reach", "entered").groupBy("file", "block").applyInPandas(
        _inside, "file string, block long, at long, reach long")


def _verified(spark: SparkSession, path: str, nodes: DataFrame, resync: bool) -> tuple[DataFrame, DataFrame]:
    """The records of all chains that hold (``file, block, at, reach``), and what
    doesn't: ``file, offset, bytes, reason``."""
    files = spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).where("size > 0")
    files = written(files, "files")

    def check(good: DataFrame, begins: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Chains that begin at ``begins(file, begin, size)``: their last records,
        of which those with a reason lead nowhere."""
        last = good.groupBy("file").agg(F.max_by(F.struct("at", "reach"), "at").alias("last"))
        reason = (
            F.when(F.col("last").isNull(), "no record at its start").when(F.col("last.reach").isNull(), "no length")
            .when(F.col("last.reach") > F.col("size"), "cut short").when(F.col("last.reach") < F.col("size"), "no record at its end"))
        ended = begins.join(last, "file", "left").select(
            "file", "size", F.coalesce("last.at", "begin").alias("offset"), reason.alias("reason"))
        bad = written(ended.where("reason IS NOT NULL"), "bad")
        return good.join(bad.select("file", F.col("offset").alias("at")), ["file", "at"], "left_anti"), bad

    good = written(reachable(nodes, nodes.where("at = 0")), "records")
    good, bad = check(good, files.withColumn("begin", F.lit(0).cast("long")))
    reports = bad.select("file", "offset", (F.col("size") - F.col("offset")).alias("bytes"), "reason")
    if not resync or bad.isEmpty():
        return good, reports
    # candidates whose chain ends with the file; of each broken file the first one behind the break
    jump = nodes.join(bad.select("file"), "file", "left_semi").select("file", "at", F.col("beyond").alias("to"))
    to_end = _closure(bad.select("file", F.col("size").alias("at")), jump.where("to IS NOT NULL"), False)
    again = (
        to_end.join(bad, "file").where("at > offset AND at < size").groupBy("file").agg(F.min("at").alias("at"))
    )
    again = written(again, "again")
    more = reachable(nodes, again).select(good.columns)
    reports = bad.join(again, "file", "left").select(
        "file", "offset", (F.coalesce("at", "size") - F.col("offset")).alias("bytes"), "reason")
    return good.select("file", "block", "at", "reach").union(more.select("file", "block", "at", "reach")), reports


def read_warc(spark: SparkSession, path: str, parse: Parser = as_is, schema: str = AS_IS) -> DataFrame:
    """``file, offset`` and the parser's columns of each verified record."""
    return read_verified(spark, path, parse, schema)[0]


def read_verified(
    spark: SparkSession, path: str, parse: Parser = as_is, schema: str = AS_IS, resync: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``file, offset`` and the parser's columns of each verified record, and
    ``file, offset, bytes, reason`` of each stretch that isn't in one.

    ``parse`` runs where a candidate is read, so with a parser that keeps little,
    little is moved; candidates that aren't reached are dropped with what it
    made of them. Records whose payload holds magic lie in several stretches;
    those are read again, put together and parsed. With ``resync`` records
    behind a broken place are given out too, from the first candidate on whose
    chain leads to the file's end; a whole record inside the broken one's
    payload could be taken for it, so it isn't the default.
    """
    seen = written(candidates(spark, path, parse, schema), "candidates")
    per = seen.groupBy("file", "block").agg(F.max(F.col("at") + F.col("size")).alias("bytes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = written(per.select(
        "file", "block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base")), "bases")
    placed = seen.join(bases, ["file", "block"]).select(
        "file", "block", (F.col("at") + F.col("base")).alias("at"), "size",
        (F.col("reach") + F.col("base")).alias("reach"), "found")
    nodes = _chains(placed.select("file", "block", "at", "size", "reach"))
    good, reports = _verified(spark, path, nodes, resync)
    good = good.select("file", "at", "reach").join(placed.select("file", "at", "size", "found"), ["file", "at"])
    names = [f.name for f in StructType.fromDDL(schema)]
    whole = good.where("found IS NOT NULL").select("file", F.col("at").alias("offset"), "found.*")
    cut = written(good.where("found IS NULL").select(
        "file", F.col("at").alias("start"), F.col("reach").alias("stop")), "cut")
    if not cut.take(1):
        return whole, reports

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _numbered(batches):
            cols = list(zip(*rows)) or [[]] * 5
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)], names=["file", "block", "at", "size", "bytes"])

    again = stretches(spark, path).mapInArrow(number, "file string, block long, at long, size long, bytes binary")
    wanted = placed.alias("p").join(
        cut.alias("c"), F.expr("p.file = c.file AND p.at >= c.start AND p.at < c.stop")).join(
        bases.alias("b"), F.expr("p.file = b.file AND p.block = b.block")).select(
        "p.file", "p.block", (F.col("p.at") - F.col("base")).alias("at"), "start", "stop")
    parts = again.join(wanted, ["file", "block", "at"])

    def mend(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["block", "at"])
        data = MAGIC.encode().join(bytes(x) for x in pdf["bytes"])
        parsed = split_record(data)
        row = parse(parsed[0], data[parsed[1] : parsed[2]])
        return pd.DataFrame([(pdf["file"].iloc[0], pdf["start"].iloc[0], *row)], columns=["file", "offset", *names])

    mended = parts.groupBy("file", "start").applyInPandas(mend, f"file string, offset long, {schema}")
    return whole.union(mended), reports


def header(headers: str, name: str) -> str | None:
    found = re.search(rf"(?im)^{re.escape(name)}:[ \t]*([^\r\n]*)", headers)
    return found[1] if found else None


PAGE = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def page_digest(headers: str, content: bytes) -> tuple:
    """A parser for records that :func:`write_warc` wrote: the columns of PAGE.

    A response's length and digest come from the payload as read; a revisit has
    none, so they come from its headers.
    """
    def number(name: str) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", header(headers, name) or "")
        return int(found[1]) if found else None

    kind = header(headers, "WARC-Type")
    if kind == "response":
        payload = content.partition(END.encode())[2]
        size, digest = len(payload), sha1_32(payload)
    else:
        size, digest = int(header(headers, "X-Payload-Length")), header(headers, "WARC-Payload-Digest").partition(":")[2]
    return number("WARC-Record-ID"), size, digest, kind, number("WARC-Refers-To")
