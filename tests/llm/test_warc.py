import base64
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from simsift.llm import warc

PAGES = "page_id long, url string, html string, payload string, origin string"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(5, "http://a", "same"), (3, "http://b", "same"), (9, None, "same"), (1, "http://c\r\nX: y", None), (2, "http://d", ""), (None, "http://e", "same"), (None, "http://f", "own ü"), (7, "http://g", "x" * 100_000 + "\r\n\r\nWARC/1.1\r\n\r\n"), (3, "http://b", "same")]
    return spark.createDataFrame([(*r, "p", "o") for r in rows], PAGES)


def expected(rows, min_bytes=0):
    out = []
    for r in rows:
        data = (r["html"] or "").encode()
        ids = [x["page_id"] for x in rows if (x["html"] or "") == (r["html"] or "") and x["page_id"] is not None]
        first = min(ids, default=None)
        later = len(data) >= min_bytes and r["page_id"] != first
        out.append((r["page_id"], len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if later else "response", first if later else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 2, 1000])
@pytest.mark.parametrize("segment", [50, 1_000, 10_000_000])
def test_archives_round_trip(pages, min_bytes, segment):
    segments = warc.read_segments(warc.write_archives(pages.repartition(3), min_bytes, segment))
    got = warc.reassemble(segments).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == expected(pages.collect(), min_bytes)


def test_payloads_come_back_whole(pages):
    got = warc.reassemble(warc.read_segments(warc.write_archives(pages, segment_bytes=3000)))
    assert got.where("page_id = 7").first()["payload"].decode() == pages.where("page_id = 7").first()["html"]


def test_missing_and_damaged_segments_are_noticed(pages):
    segments = warc.read_segments(warc.write_archives(pages, segment_bytes=3000)).cache()
    for broken in (segments.where("number IS NULL OR number <> 2"), segments.withColumn("total", F.col("total") + 1)):
        with pytest.raises(Exception, match="segments are missing"):
            warc.reassemble(broken).collect()


def test_empty_table(pages):
    assert warc.reassemble(warc.read_segments(warc.write_archives(pages.limit(0)))).collect() == []


@pytest.mark.parametrize("body", [b"", b"x", b"abc" * 10_000, b"\r\n0\r\n\r\n"])
def test_chunked_framing(body):
    assert warc.dechunked(warc.chunked(body, 7)) == body
    assert warc.dechunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.dechunked(warc.chunked(b"abcdef", 6)[:-6])


def test_records_that_end_early():
    data = warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<a>")], b"block")
    assert [b for _, b in warc.parse_records(io.BytesIO(data * 3))] == [b"block"] * 3
    with pytest.raises(ValueError):
        list(warc.parse_records(io.BytesIO(data[:-9])))
    with pytest.raises(ValueError):
        list(warc.parse_records(io.BytesIO(gzip.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"))))
