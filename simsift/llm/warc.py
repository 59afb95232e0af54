"""Web archives: pages to segmented WARC records and back.

Writing: a page's HTTP response, its body in chunked transfer framing, is a `response` record.
Blocks longer than segment_bytes are split: the first segment is the response itself, the others
are `continuation` records that name it (WARC-Segment-Origin-ID) and their number, and the last
also the total length. Of pages with equal payloads (min_bytes or more), those with the smallest
page_id are responses and the others `revisit` records, which hold the HTTP head alone and name the
response by its target URI and date (WARC-Refers-To-Target-URI, WARC-Refers-To-Date), as other
readers follow it, and by its page_id for ours. Each record is a gzip member; archives roll at archive_bytes, so segments of a page may lie in several files.

Reading: whole records are decoded where they are read. Only segments are shuffled: grouped by
origin, ordered by number, checked for gaps and against the total length, joined and decoded.

Defined cases: a null html is an empty payload; null page_ids and urls are kept as absent headers,
and among payloads a null page_id is response only if no other row has the payload; rows that
repeat the smallest page_id are all responses; line breaks in a url become spaces; an empty table
writes no file; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsift.llm._space import new_folder, written

SEGMENT_BYTES, ARCHIVE_BYTES, CHUNK_BYTES = 32_768, 64_000_000, 8_192
DATE = "2024-01-01T00:00:00Z"

SEGMENT = "origin string, number int, total long, record_type string, page_id long, refers_to long, stated string, block binary"
RECORD = "page_id long, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [b"%x\r\n%s\r\n" % (len(x), x) for k in range(0, len(body), size) if (x := body[k : k + size])]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            raise ValueError("chunked framing ends early")
        size = int(body[at:line].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        at = line + 2
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk length differs")
        out.append(body[at : at + size])
        at += size + 2


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in [*headers, ("Content-Length", len(block))] if v is not None]
    return gzip.compress("\r\n".join(["WARC/1.1", *lines, "", ""]).encode() + block + b"\r\n\r\n", 1, mtime=0)


def page_records(page_id, url, payload: bytes, refers_to, segment_bytes: int, refers_to_url=None) -> Iterator[bytes]:
    """The records of a page, ready to append to an archive. refers_to is a page_id for a revisit."""
    name = f"<urn:uuid:{uuid.uuid4()}>"
    url, refers_to_url = (None if x is None else " ".join(x.splitlines()) for x in (url, refers_to_url))
    common = [("WARC-Record-ID", name), ("WARC-Date", DATE), ("WARC-Target-URI", url), ("WARC-Page-ID", page_id)]
    common += [("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("Content-Type", "application/http; msgtype=response")]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        more = [("WARC-Type", "revisit"), ("WARC-Profile", profile), ("WARC-Refers-To-Target-URI", refers_to_url), ("WARC-Refers-To-Date", DATE), ("WARC-Refers-To-Page-ID", refers_to)]
        yield record(more + common, head + b"Content-Length: %d\r\n\r\n" % len(payload))
        return
    block = head + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    if len(block) <= segment_bytes:
        yield record([("WARC-Type", "response"), *common], block)
        return
    cuts = range(0, len(block), segment_bytes)
    for number, at in enumerate(cuts, 1):
        if number == 1:
            headers = [("WARC-Type", "response"), *common]
        else:
            headers = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", name)]
        headers.append(("WARC-Segment-Number", number))
        headers.append(("WARC-Segment-Total-Length", len(block) if number == len(cuts) else None))
        yield record(headers, block[at : at + segment_bytes])


def parse_records(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of every record of an archive, one gzip member at a time."""
    rest = b""
    while True:
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            rest = rest or source.read(1 << 20)
            if not rest:
                if parts:
                    raise ValueError("the archive ends inside a record")
                return
            parts.append(inflate.decompress(rest))
            rest = inflate.unused_data
        whole = b"".join(parts)
        head, _, body = whole.partition(b"\r\n\r\n")
        lines = head.decode("utf-8", "replace").split("\r\n")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(headers["content-length"])
        if len(body) != size + 4:
            raise ValueError(f"{headers.get('warc-record-id')}: the block has {len(body) - 4} bytes, not {size}")
        yield headers, body[:size]


def with_first_page(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """pages(page_id, url, html) with refers_to, refers_to_url: the smallest page_id with the payload,
    if another's, and its url."""
    html = F.coalesce("html", F.lit(""))
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"))
    keyed = keyed.withColumn("h", F.sha1("html"))
    least = F.min(F.struct(F.col("page_id").isNull(), "page_id", "url", F.octet_length("html"))).alias("least")
    first = keyed.groupBy("h").agg(least).select("h", F.col("least.page_id").alias("first"), F.col("least.url").alias("first_url"), F.col("least.col4").alias("bytes"))
    first = written(first, "payloads")
    # Both sides come straight from files: adaptive execution splits a hot payload.
    met = keyed.join(first, "h")
    later = (F.col("bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return met.select("page_id", "url", "html", *(F.when(later, F.col(c)).alias(n) for c, n in (("first", "refers_to"), ("first_url", "refers_to_url"))))


def write_archives(pages: DataFrame, min_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES, folder: str | None = None) -> DataFrame:
    """Writes every page; the manifest (file, records), whose commit decides which files count."""
    folder = folder or new_folder(pages.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = fs.FileSystem.from_uri(folder)
        where.create_dir(root, recursive=True)
        files, counts, out, size = [], [], None, 0
        for batch in batches:
            html = batch.column(2).cast(pa.large_binary())
            ids, urls, _, others, other_urls = (None if k == 2 else batch.column(k).to_pylist() for k in range(5))
            for page_id, url, payload, refers_to, refers_to_url in zip(ids, urls, html, others, other_urls):
                for data in page_records(page_id, url, payload.as_py(), refers_to, segment_bytes, refers_to_url):
                    if out is None or size >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        files.append(f"pages-{uuid.uuid4().hex}.warc.gz")
                        counts.append(0)
                        out, size = where.open_output_stream(f"{root}/{files[-1]}", compression=None), 0
                    out.write(data)
                    size += len(data)
                    counts[-1] += 1
        if out is not None:
            out.close()
        names = [f"{folder}/{x}" for x in files]
        yield pa.RecordBatch.from_pydict({"file": pa.array(names, pa.string()), "records": pa.array(counts, pa.int64())})

    rows = with_first_page(pages, min_bytes)
    return written(rows.mapInArrow(write, "file string, records long"), "warc-manifest")


def read_segments(manifest: DataFrame) -> DataFrame:
    """Every record of the archives: its origin's id, segment number, total length and block."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                where, path = fs.FileSystem.from_uri(file)
                with where.open_input_stream(path, compression=None) as source:
                    rows, size = [], 0
                    for h, block in parse_records(source):
                        number = lambda k: int(h[k]) if k in h else None  # noqa: B023, E731
                        origin = h.get("warc-segment-origin-id", h["warc-record-id"])
                        rows.append((origin, number("warc-segment-number"), number("warc-segment-total-length"), h["warc-type"], number("warc-page-id"), number("warc-refers-to-page-id"), h.get("warc-payload-digest", "").removeprefix("sha1:"), block))
                        size += len(block)
                        if size > 4_000_000:
                            yield _batch(rows, SEGMENT_SCHEMA)
                            rows, size = [], 0
                    if rows:
                        yield _batch(rows, SEGMENT_SCHEMA)

    files = max(1, manifest.count())
    return manifest.repartition(files, "file").select("file").mapInArrow(read, SEGMENT)


SEGMENT_SCHEMA = pa.schema([("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("record_type", pa.string()), ("page_id", pa.int64()), ("refers_to", pa.int64()), ("stated", pa.string()), ("block", pa.binary())])
RECORD_SCHEMA = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records with whole blocks to payloads, held against the digest that the record states. A
    revisit's payload is null; its length and digest are those that its HTTP head and record state."""
    for batch in batches:
        rows = []
        for x in batch.to_pylist():
            head, _, body = b"".join(x["blocks"]).partition(b"\r\n\r\n")
            fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(b":") for line in head.split(b"\r\n")[1:])}
            if x["record_type"] == "revisit":
                rows.append((x["page_id"], "revisit", x["refers_to"], None, int(fields[b"content-length"]), x["stated"]))
                continue
            payload = dechunked(body) if fields.get(b"transfer-encoding") == b"chunked" else body
            if digest(payload) != x["stated"]:
                raise ValueError(f"page {x['page_id']}: the payload's digest differs")
            rows.append((x["page_id"], x["record_type"], None, payload, len(payload), x["stated"]))
        if rows:
            yield _batch(rows, RECORD_SCHEMA)


def reassemble(segments: DataFrame) -> DataFrame:
    """Records with payloads from segments, in any order and from any file."""
    names = ["record_type", "page_id", "refers_to", "stated", "blocks"]
    whole = segments.where("number IS NULL").withColumn("blocks", F.array("block")).select(names)
    parts = segments.where("number IS NOT NULL").groupBy("origin").agg(
        F.array_sort(F.collect_list(F.struct("number", "block"))).alias("parts"),
        F.sum(F.octet_length("block")).alias("bytes"),
        F.max("total").alias("total"),
        F.max("page_id").alias("page_id"),
        F.max("stated").alias("stated"),
        F.count(F.lit(1)).alias("n"),
        F.max("number").alias("last"),
    )
    complete = (F.col("n") == F.col("last")) & F.col("total").eqNullSafe(F.col("bytes"))
    message = F.concat(F.lit("segments are missing or of another length: "), F.col("origin"))
    blocks = F.when(complete, F.transform("parts", lambda x: x["block"])).otherwise(F.raise_error(message).cast("array<binary>"))
    joined = parts.withColumns({"record_type": F.lit("response"), "refers_to": F.lit(None).cast("long"), "blocks": blocks})
    return whole.unionByName(joined.select(names)).mapInArrow(_decoded, RECORD)
