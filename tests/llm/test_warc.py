import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tablesync import files
from tablesync.llm.warc import archive_round_trip, read_warc, write_warc

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def payloads():
    r = random.Random(3)
    bits = [FAKE, "WARC/1.1\r\n", "<p>ü</p>", "\r\n\r\n", "x" * 300, "Content-Length: 7\r\n\r\n"]
    rows = [(k, "".join(r.choice(bits) for _ in range(r.randrange(10)))) for k in range(80)]
    rows += [(k, rows[k % 9][1]) for k in range(80, 120)]
    return [*rows, (300, None), (301, ""), (None, "n"), (302, FAKE * 30), (303, "WARC/1.1\r\n" * 500), (303, "WARC/1.1\r\n" * 500), (304, "y" * 90_000)]


def expected(rows, least=0):
    first = {}
    for i, text in rows:
        text = text or ""
        if text not in first or (i is not None and (first[text] is None or i > first[text])):
            first[text] = i
    found = []
    for i, text in rows:
        data = (text or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        keeper = first[text or ""]
        response = i == keeper or len(data) < least
        found.append((i, len(data), digest, "response" if response else "revisit", None if response else keeper))
    return sorted(found, key=repr)


def pages(spark, rows):
    filled = [(i, f"http://x/{i}\r\nWARC/1.1\r\n" if (i or 0) % 7 == 0 else None, t, "d", 1) for i, t in rows]
    return spark.createDataFrame(filled, "page_id long, url string, html string, digest string, n int").repartition(3)


@pytest.mark.parametrize(("block", "least"), [("128m", 0), ("128m", 50), ("3k", 0)])
def test_round_trip_with_magic_in_payloads(spark, block, least):
    rows = payloads()
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    try:
        spark.conf.set(names[0], block), spark.conf.set(names[1], "1b")
        found = archive_round_trip(pages(spark, rows), least).drop("target_uri").collect()
    finally:
        for name, value in zip(names, before, strict=True):
            spark.conf.set(name, value)
    assert sorted(map(tuple, found), key=repr) == expected(rows, least)


def test_payloads_come_back(spark):
    path = files.scratch(spark, "warc-test")
    write_warc(pages(spark, [(1, "a\r\nWARC/1.1\r\nb"), (2, "ü"), (3, "ü")]), path)
    found = read_warc(spark, path).select("record_id", "warc_type", F.col("payload").cast("string"), "target_uri").collect()
    assert sorted(map(tuple, found), key=repr) == [
        ("<urn:page:1>", "response", "a\r\nWARC/1.1\r\nb", None),
        ("<urn:page:2>", "revisit", "", None),
        ("<urn:page:3>", "response", "ü", None),
    ]


def test_no_pages(spark):
    assert archive_round_trip(pages(spark, [])).count() == 0


@pytest.mark.parametrize("junk", [b"junk", b"\r\n\r\n\r\n", b"WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", b"x" * 9000 + FAKE.encode()])
def test_the_chain_ends_after_the_last_record_before_other_bytes(spark, tmp_path, junk):
    record = lambda k: b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n" % k
    (tmp_path / "a.warc").write_bytes(record(1) + record(2) + junk)
    found = [r["record_id"] for r in read_warc(spark, str(tmp_path)).select("record_id").collect()]
    assert sorted(found) == ["<urn:page:1>", "<urn:page:2>"]
