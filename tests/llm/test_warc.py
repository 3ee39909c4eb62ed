import gzip
import hashlib
import io
import os
import random
import zlib

import pytest
from pyspark.sql import functions as F

from fleetgauge.llm import warc

BIG, SMALL = "ß" * 700, "x" * 999
ROWS = [
    (1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, None, BIG), (3, "http://a/3", BIG), (4, "http://b/\r\nX: 1", SMALL), (5, "http://b/5", SMALL),
    (6, "http://b/6", None), (7, "http://b/7", ""), (None, "http://c/", BIG), (8, "http://d/8", "a\r\n\r\nb" * 400),
]


def stored(spark, tmp_path, rows=ROWS):
    warc.register(spark)
    folder = str(tmp_path / "warc")
    pages = spark.createDataFrame([(*r, "digest", 1) for r in rows], "page_id long, url string, html string, digest string, length int")
    warc.to_records(pages, "page_id", "url", "html").repartition(3).write.format("warc").mode("append").save(folder)
    return folder, lambda **o: spark.read.format("warc").options(**o).load(folder)


def test_round_trip_and_revisits(spark, tmp_path):
    folder, read = stored(spark, tmp_path)
    got = sorted((r.record_id, r.record_type, r.refers_to, r.payload, r.payload_length, r.payload_digest) for r in read().collect())
    want = []
    for page, _, html in ROWS:
        html = html or ""
        again = len(html.encode()) >= 1000 and html == BIG and page != 3
        want.append((
            f"<urn:page:{'null' if page is None else page}>", "revisit" if again else "response", "<urn:page:3>" if again else None,
            "" if again else html, len(html.encode()), "sha1:" + hashlib.sha1(html.encode()).hexdigest(),
        ))
    assert got == sorted(want, key=lambda w: (w[0], w[1], w[2] or "", w[3])) or sorted(map(repr, got)) == sorted(map(repr, want))
    assert {r.target_uri for r in read().where("record_id = '<urn:page:4>'").collect()} == {"http://b/%0D%0AX: 1"}


def test_members_are_gzip(spark, tmp_path):
    folder, _ = stored(spark, tmp_path)
    names = [n for n in os.listdir(folder) if n.endswith(".gz")]
    text = b"".join(gzip.open(os.path.join(folder, n)).read() for n in names)
    assert text.count(b"WARC/1.1\r\n") == len(ROWS)


def test_filters_are_pushed_and_payloads_skipped(spark, tmp_path, monkeypatch):
    _, read = stored(spark, tmp_path)
    only = read(payload="false").where("record_type = 'revisit' AND payload_digest LIKE 'sha1:%'")
    assert only.count() == 3 and only.where("payload IS NOT NULL").count() == 0
    assert read().where(F.col("target_uri").isin("http://a/1", "http://b/5")).count() == 2
    assert read().where("target_uri IS NULL").count() == 1
    reader = warc.WarcReader({"path": "/nowhere"})
    from pyspark.sql.datasource import EqualTo, GreaterThan

    kept = [EqualTo(("payload_length",), 3), GreaterThan(("date",), "2")]
    assert list(reader.pushFilters([EqualTo(("record_type",), "response"), *kept])) == kept


def test_unwanted_payloads_are_not_inflated():
    body = "".join(random.Random(1).choices("abcdefghijklmnopqrstuvwxyz", k=200_000))
    member = warc.encode_record({"record_type": "response", "record_id": "r", "payload": body, "payload_length": len(body)})
    broken = member[:-2000] + b"\0" * 1992 + member[-8:]  # damage that only whole inflating would meet

    class File(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    assert [r["payload"] for r in warc.read_records(File(member * 2))] == [body] * 2
    assert list(warc.read_records(File(broken), [("EqualTo", "record_type", "revisit")])) == []
    assert [r["record_id"] for r in warc.read_records(File(broken), payload=False)] == ["r"]
    with pytest.raises((ValueError, zlib.error)):
        list(warc.read_records(File(broken)))


def test_empty_table_and_uncommitted_files(spark, tmp_path):
    folder, read = stored(spark, tmp_path, [])
    assert read().count() == 0
    (tmp_path / "warc" / "part-lost.warc.gz").write_bytes(b"half a file")
    assert read().count() == 0
