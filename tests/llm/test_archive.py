"""WARC archives: what is read back, whole records, and damage."""

import base64
import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from marketloom.llm import archive
from marketloom.session import new_folder

COLUMNS = "page_id long, url string, html string"
PAGES = [
    (1, "http://a/é", "<p>x</p>"), (5, "http://a\r\nWARC-Type: b", "<p>x</p>"), (5, "http://a\r\nWARC-Type: b", "<p>x</p>"), (None, None, None),
    (None, "u", ""), (7, None, "ü" * 5), (8, " blanks ", "\r\n\r\nWARC-Type: x\r\n"), (3, "", "<p>x</p>"), (9, "http://long", "<i>é" * 300_000),
    (10, "\x7f", "null"), (-2, "null", "null"),
]


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, COLUMNS).withColumns({"key": F.lit("x"), "row": F.lit(1), "payload": F.lit("y")}).repartition(3)


def test_archived(spark, pages):
    found = archive.archived(pages).collect()
    wanted = [((html or "").encode(), page_id) for page_id, _, html in PAGES]
    assert collections.Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in found) == collections.Counter(
        (page_id, len(p), digest(p)) for p, page_id in wanted
    )
    of_payload = collections.defaultdict(list)
    for r in found:
        of_payload[r.payload_digest].append(r)
    for group in of_payload.values():
        response, = (r for r in group if r.record_type == "response")
        assert response.refers_to is None
        assert response.page_id == max((r.page_id for r in group if r.page_id is not None), default=None)
        assert all(r.refers_to == response.page_id for r in group if r is not response and r.record_type == "revisit")
    assert archive.archived(spark.createDataFrame([], COLUMNS)).count() == 0


def test_small_payloads_may_all_be_responses(pages):
    types = {(r.page_id, r.payload_bytes): r.record_type for r in archive.archived(pages, least_bytes=8).collect() if r.payload_bytes < 8}
    assert set(types.values()) == {"response"}


def fields_of(record):
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    assert lines[0] == "WARC/1.1"
    fields = dict(line.split(": ", 1) for line in lines[1:])
    assert len(fields) == len(lines) - 1
    block = rest[:int(fields["Content-Length"])]
    assert rest[len(block):] == b"\r\n\r\n"
    return fields, block


def test_whole_records(spark, pages):
    folder = new_folder(spark, "warc-test")
    archive.write_archive(pages, folder)
    read = {r.record_id: fields_of(bytes(r.record)) for r in archive.reconstructed(spark, folder).collect()}
    assert len(read) == len(PAGES)
    for record_id, (fields, block) in read.items():
        assert fields["WARC-Record-ID"] == record_id
        if fields["WARC-Type"] == "revisit":
            assert block == b"" and read[fields["WARC-Refers-To"]][0]["WARC-Payload-Digest"] == fields["WARC-Payload-Digest"]
        else:
            http, _, payload = block.partition(b"\r\n\r\n")
            assert f"Content-Length: {len(payload)}".encode() in http.split(b"\r\n")
            assert fields["WARC-Payload-Digest"] == "sha1:" + digest(payload)
    urls = [(r.page_id, r.url) for r in archive.read_records(spark, folder).collect()]
    assert collections.Counter(urls) == collections.Counter((page_id, url) for page_id, url, _ in PAGES)
    stored = spark.read.parquet(f"{folder}/payloads")
    assert stored.count() == len({html or "" for _, _, html in PAGES})


def test_damage_is_found(spark, pages):
    folder, damaged = new_folder(spark, "warc-test"), new_folder(spark, "warc-test")
    archive.write_archive(pages, folder)
    payload = F.when(F.length("payload") == 8, F.lit(b"<p>y</p>")).otherwise(F.col("payload"))
    spark.read.parquet(f"{folder}/payloads").withColumn("payload", payload).write.parquet(f"{damaged}/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        archive.read_payloads(spark, damaged).collect()
