from __future__ import annotations

import base64
import glob
import hashlib
import os
import random
import re
import tempfile

import pytest
from conftest import SF01

from tidemark.llm import warc
from tidemark.llm.common import table
from tidemark.llm.queries import op6_warc_chain

PAGES = "page_id long, url string, html string"


def brute(rows):
    first = {}
    for i, html in rows:
        p = (html or "").encode()
        if i is not None and (p not in first or i < first[p]):
            first[p] = i
    out = []
    for i, html in rows:
        p = (html or "").encode()
        hub = first.get(p)
        copy = hub is not None and hub != i
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if copy else "response", hub if copy else None))
    return sorted(out, key=str)


def there_and_back(spark, rows, parts=3, path=None):
    path = path or tempfile.mkdtemp(prefix="warc-") + "/a"
    warc.write_warc(spark.createDataFrame(rows, PAGES).repartition(parts), path)
    return sorted(map(tuple, warc.read_warc(spark, path, warc.page_digest, warc.PAGE).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


FAKE = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


def nasty(rng, n):
    out = []
    for i in range(n):
        body = rng.choice(["", "x" * rng.randint(0, 900), FAKE * rng.randint(1, 3), "WARC/1.1\r\n", "WARC/1.1\r\n" * 3, "é\r\n\r\n"])
        out.append((i, f"http://h/{i}", body + rng.choice(["", FAKE, f"tail {i}"])))
    return out


@pytest.mark.parametrize("split", ["700b", "3000b", "128m"])
def test_magic_in_payloads_and_any_split(spark, split):
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        rows = nasty(random.Random(3), 60)
        assert there_and_back(spark, rows, parts=2) == brute([(r[0], r[2]) for r in rows])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_offsets_and_whole_content(spark):
    path = tempfile.mkdtemp(prefix="warc-") + "/a"
    rows = nasty(random.Random(5), 30)
    warc.write_warc(spark.createDataFrame(rows, PAGES).coalesce(1), path)
    data = open(glob.glob(f"{path}/part-*")[0], "rb").read()
    found = {r.offset: (r.headers, bytes(r.content)) for r in warc.read_warc(spark, path).collect()}
    at, want = 0, {}
    while at < len(data):  # one record after the other
        head = data.index(b"\r\n\r\n", at)
        n = int(re.search(rb"Content-Length: (\d+)", data[at:head])[1])
        want[at] = data[at + len(warc.MAGIC) : head].decode(), data[head + 4 : head + 4 + n]
        at = head + 4 + n + 4
    assert found == want and len(want) == 30


def test_odd_rows(spark):
    rows = [
        (1, None, None), (2, "u", ""), (None, "u", "a"), (4, "a\r\nContent-Length: 1", "a"), (5, "u", "same"), (6, "u", "same"),
        (6, "u", "same"), (5, "v", "same"), (7, "u", "long " * 100000), (-3, "u", "a"), (8, "ü", "é\U0001f600"),
    ]
    want = [(1, 0, "response", None), (2, 0, "revisit", 1), (None, 1, "revisit", -3), (4, 1, "revisit", -3), (-3, 1, "response", None)]
    out = there_and_back(spark, rows)
    assert len(out) == len(rows)
    assert {(r[0], r[1], r[3], r[4]) for r in out} >= set(want)
    assert [(r[3], r[4]) for r in out if r[0] == 5] == [("response", None)] * 2
    assert [(r[3], r[4]) for r in out if r[0] == 6] == [("revisit", 5)] * 2


def chain(data):
    """Offsets and ends of the records one behind the other, and where that stops."""
    at, out = 0, []
    while at < len(data):
        head = data.find(b"\r\n\r\n", at)
        found = re.search(rb"Content-Length: (\d+)", data[at:head]) if data.startswith(warc.MAGIC.encode(), at) and head >= 0 else None
        if not found or head + 4 + int(found[1]) + 4 > len(data):
            break
        out.append((at, head + 4 + int(found[1]) + 4))
        at = out[-1][1]
    return out, at


@pytest.mark.parametrize("kind, split", [
    ("length", "700b"), ("longer", "128m"), ("cut", "700b"), ("end", "128m"), ("no length", "700b"), ("start", "700b"),
    ("empty", "128m"), ("none", "128m")])
def test_no_byte_is_lost_in_silence(spark, kind, split):
    path = tempfile.mkdtemp(prefix="warc-") + "/a"
    rows = [(i, "u", "x" * (30 * i) + (FAKE if i % 5 == 0 else "")) for i in range(20)]
    warc.write_warc(spark.createDataFrame(rows, PAGES).coalesce(1), path)
    file = glob.glob(f"{path}/part-*")[0]
    data = open(file, "rb").read()
    offsets = [a for a, _ in chain(data)[0]]
    at = data.index(b"Content-Length: ", offsets[7]) + 16
    digits = re.match(rb"\d+", data[at:])[0]
    longer = b"%d" % (int(digits) + 10**6)
    broken, reason, begin = {
        "length": (data[:at] + b"%d" % (int(digits) - 1) + data[at + len(digits) :], "no record at its end", offsets[7]),
        "longer": (data[:at] + longer + data[at + len(digits) :], "cut short", offsets[7]),
        "cut": (data[:-20], "cut short", offsets[19]),
        "end": (data[:-1], "cut short", offsets[19]),
        "no length": (data.replace(b"Content-Length: " + digits, b"Content-Wealth: " + digits, 8), None, None),
        "start": (b"garbage" + data, "no record at its start", 0),
        "empty": (b"", None, None), "none": (b"nothing at all", "no record at its start", 0),
    }[kind]
    for crc in glob.glob(f"{path}/.*.crc"):
        os.remove(crc)
    open(file, "wb").write(broken)
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        whole, lost = (x.collect() for x in warc.read_verified(spark, path))
        more, left = (x.collect() for x in warc.read_verified(spark, path, resync=True))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
        spark.conf.unset("spark.sql.files.minPartitionNum")
    if kind == "no length":
        begin, reason = lost[0].offset, "no length"
        assert broken.count(b"Content-Wealth") and begin in offsets
    assert sorted(r.offset for r in whole) == [o for o in offsets if begin is not None and o < begin]
    if not broken:
        assert lost == left == more == []
        return
    assert [(r.offset, r.bytes, r.reason) for r in lost] == [(begin, len(broken) - begin, reason)]
    # with a new start behind the break, records and reports still cover the file
    spans = [(r.offset, r.offset + r.bytes) for r in left]
    for r in more:
        head = broken.index(b"\r\n\r\n", r.offset)
        spans.append((r.offset, head + 4 + len(r.content) + 4))
    spans.sort()
    assert [a for a, _ in spans] == [0, *[b for _, b in spans[:-1]]] and spans[-1][1] == len(broken)
    if kind in ("length", "longer", "start"):
        assert len(more) == (20 if kind == "start" else 19)


def test_empty_table(spark):
    assert there_and_back(spark, []) == []


def test_whole_table(spark):
    rows = [(r.page_id, r.html) for r in table(spark, SF01, "pages").collect()]
    assert sorted(map(tuple, op6_warc_chain(spark, SF01).collect()), key=str) == brute(rows)
