"""WARC archives with segmented records (operator 8).

Writing: every page is one record.  Of pages with equal payloads of at least
``revisit_bytes`` bytes the one with the smallest page_id is a response, the
others are revisits without payload that name it.  Payloads go out as HTTP
responses in chunked transfer framing.  A block over ``segment_bytes`` is split:
the first part keeps the record's header with segment number 1, the rest are
continuation records that name their origin, and the last gives the total
length.

Reading: files are parsed record by record; blocks are not interpreted until
the record is whole.  Continuations are grouped with their origin by record
identifier, ordered by segment number, checked for gaps and for the total
length, joined, and the chunked framing is decoded.  Whole records are decoded
where they are parsed.  Revisits carry the digest and take the payload length from the
response they refer to.

Archives are gzip files written by Spark's text sink (the record separator is
its line separator) and read by its binary source, so any file system Spark
reaches will do.  One file holds the records of one task, at most
``records_per_file``.

Defined cases: null or empty html is an empty payload (response); null url is
an empty target; null page_id is kept and never referred to; rows that repeat
the smallest page_id of a payload are all responses; other repeated rows are
revisits; empty table, no rows; extra columns are ignored.
"""
from __future__ import annotations

import hashlib
import io
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

CRLF = b"\r\n"
SEP = "\r\n\r\n"
DATE = b"2020-01-01T00:00:00Z"


class WarcError(ValueError):
    """A record that is damaged, or whose segments are incomplete."""


def chunked(payload: bytes, size: int) -> bytes:
    parts = []
    for i in range(0, len(payload), size):
        part = payload[i:i + size]
        parts += [b"%x" % len(part), CRLF, part, CRLF]
    return b"".join([*parts, b"0", CRLF, CRLF])


def unchunk(body: bytes) -> bytes:
    """Payload of a chunked body (chunk extensions and trailers are skipped)."""
    at, out = 0, []
    while True:
        end = body.find(CRLF, at)
        if end < 0:
            raise WarcError("chunk size line is cut short")
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if body[at + size:at + size + 2] != CRLF:
            raise WarcError("chunk is cut short")
        out.append(body[at:at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    head, sep, body = block.partition(b"\r\n\r\n")
    if not sep:
        raise WarcError("HTTP header is cut short")
    chunked_body = any(k.strip().lower() == b"transfer-encoding" and b"chunked" in v.lower()
                       for k, _, v in (line.partition(b":") for line in head.split(CRLF)[1:]))
    return unchunk(body) if chunked_body else body


def _record(headers: list[tuple[bytes, bytes]], block: bytes) -> bytes:
    lines = [b"WARC/1.1", *[k + b": " + v for k, v in headers], b"Content-Length: %d" % len(block)]
    return CRLF.join(lines) + b"\r\n\r\n" + block


def records(page_id, copy: int, url: str | None, html: bytes, digest: str, refers_to, segment_bytes: int, chunk_bytes: int) -> list[bytes]:
    """The records of one page, without the separator that follows each."""
    page = b"null" if page_id is None else b"%d" % page_id
    rid = b"<urn:page:" + page + b":%d>" % copy
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A").encode()
    head = [(b"WARC-Record-ID", rid), (b"WARC-Date", DATE), (b"WARC-Target-URI", target),
            (b"WARC-Payload-Digest", b"sha256:" + digest.encode()), (b"Content-Type", b"application/http;msgtype=response")]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is not None:
        profile = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        return [_record([(b"WARC-Type", b"revisit"), *head, (b"WARC-Refers-To", b"<urn:page:%d>" % refers_to),
                         (b"WARC-Profile", profile)], http + CRLF)]
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(html, chunk_bytes)
    if len(block) <= segment_bytes:
        return [_record([(b"WARC-Type", b"response"), *head], block)]
    out = []
    parts = range(0, len(block), segment_bytes)
    for no, at in enumerate(parts, 1):
        number = (b"WARC-Segment-Number", b"%d" % no)
        part = block[at:at + segment_bytes]
        if no == 1:
            out.append(_record([(b"WARC-Type", b"response"), *head, number], part))
            continue
        more = [(b"WARC-Type", b"continuation"), (b"WARC-Record-ID", rid[:-1] + b":%d>" % no), (b"WARC-Date", DATE),
                (b"WARC-Segment-Origin-ID", rid), number]
        if no == len(parts):
            more.append((b"WARC-Segment-Total-Length", b"%d" % len(block)))
        out.append(_record(more, part))
    return out


def _write(segment_bytes: int, chunk_bytes: int):
    def write(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                out += records(r["page_id"], r["copy"], r["url"], r["html"] or b"", r["digest"], r["refers_to"], segment_bytes, chunk_bytes)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
    return write


def write_archives(pages: DataFrame, path: str, revisit_bytes: int = 100, segment_bytes: int = 16384,
                   chunk_bytes: int = 4096, records_per_file: int = 20_000) -> None:
    base = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("html"))
    base = base.withColumn("digest", F.sha2("html", 256))
    first = (base.filter((F.octet_length("html") >= revisit_bytes) & F.col("page_id").isNotNull())
             .groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").select("digest", "first"))
    rows = (base.join(first, "digest", "left")
            .withColumn("refers_to", F.when(F.col("first") != F.coalesce("page_id", F.lit(-1)), F.col("first")))
            .withColumn("copy", F.monotonically_increasing_id()))
    (rows.select("page_id", "copy", "url", "html", "digest", "refers_to")
     .mapInArrow(_write(segment_bytes, chunk_bytes), "value binary").select(F.col("value").cast("string"))
     .write.mode("overwrite").option("lineSep", SEP).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


def parse(stream) -> "iter":
    """(headers, block) of every record of an uncompressed archive stream."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line != b"WARC/1.1\r\n":
            raise WarcError(f"no record at {line[:40]!r}")
        head = {}
        while (line := stream.readline()) not in (CRLF, b""):
            k, _, v = line.partition(b":")
            head[k.strip().lower()] = v.strip()
        size = int(head[b"content-length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise WarcError("record is cut short")
        yield head, block


class _Gunzip(io.RawIOBase):
    """Inflates a gzip file (one member or many) piece by piece."""

    def __init__(self, raw: bytes):
        self.raw, self.at, self.z = raw, 0, zlib.decompressobj(31)

    def readable(self):
        return True

    def readinto(self, buf):
        while True:
            if self.z.eof:
                rest = self.z.unused_data
                if not rest and self.at >= len(self.raw):
                    return 0
                self.at -= len(rest)
                self.z = zlib.decompressobj(31)
            feed = self.z.unconsumed_tail
            if not feed:
                feed = self.raw[self.at:self.at + 65536]
                self.at += len(feed)
                if not feed:
                    return 0
            out = self.z.decompress(feed, len(buf))
            if out:
                buf[:len(out)] = out
                return len(out)


SEGMENT = [("origin", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
           ("segment", pa.int32()), ("total_length", pa.int64()), ("block", pa.binary()), ("payload_bytes", pa.int64()),
           ("payload_digest", pa.string())]
SEGMENT_SCHEMA = ("origin string, page_id long, record_type string, refers_to long, segment int, total_length long, "
                  "block binary, payload_bytes long, payload_digest string")


def _page(urn: bytes) -> int | None:
    no = urn.strip(b"<>").split(b":")[2]
    return None if no == b"null" else int(no)


def _rows(raw: bytes):
    for head, block in parse(io.BufferedReader(_Gunzip(raw), 1 << 16)):
        kind = head[b"warc-type"].decode()
        rid = head[b"warc-record-id"].decode()
        number = int(head.get(b"warc-segment-number", b"0"))
        if kind == "revisit":
            digest = head[b"warc-payload-digest"].partition(b":")[2].strip().decode().lower()
            yield rid, _page(head[b"warc-record-id"]), kind, _page(head[b"warc-refers-to"]), None, None, None, None, digest
        elif kind == "continuation":
            total = head.get(b"warc-segment-total-length")
            yield head[b"warc-segment-origin-id"].decode(), None, kind, None, number, int(total) if total else None, block, None, None
        elif kind == "response" and number:
            yield rid, _page(head[b"warc-record-id"]), kind, None, number, None, block, None, None
        elif kind == "response":
            payload = http_payload(block)
            yield rid, _page(head[b"warc-record-id"]), kind, None, None, None, None, len(payload), hashlib.sha256(payload).hexdigest()


def _segments(batches):
    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(zip(*rows), SEGMENT)], names=[n for n, _ in SEGMENT])
    for files in batches:
        for content in files.column(0):
            held, size = [], 0
            for row in _rows(content.as_py()):
                held.append(row)
                size += 200 + len(row[6] or b"")
                if size > 4 << 20:
                    yield batch(held)
                    held, size = [], 0
            if held:
                yield batch(held)


def _reassemble(table: pa.Table) -> pa.Table:
    """One record from its segments; whatever is missing or too long is an error."""
    rows = sorted(table.to_pylist(), key=lambda r: r["segment"])
    if [r["segment"] for r in rows] != list(range(1, len(rows) + 1)):
        raise WarcError(f"segments of {rows[0]['origin']} are not 1..n")
    block = b"".join(r["block"] for r in rows)
    if rows[-1]["total_length"] != len(block):
        raise WarcError(f"{rows[0]['origin']}: total length {rows[-1]['total_length']}, found {len(block)}")
    payload = http_payload(block)
    return pa.table({"page_id": pa.array([rows[0]["page_id"]], pa.int64()), "record_type": ["response"],
                     "payload_bytes": pa.array([len(payload)], pa.int64()),
                     "payload_digest": [hashlib.sha256(payload).hexdigest()]})


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), a row per record."""
    from transitlens.llm.common import Scratch
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    parsed = Scratch(spark, "warc-read").write(files.mapInArrow(_segments, SEGMENT_SCHEMA), "parsed")
    whole = parsed.filter("segment is null and record_type = 'response'").select("page_id", "record_type", "payload_bytes", "payload_digest")
    joined = (parsed.filter("segment is not null").groupBy("origin")
              .applyInArrow(_reassemble, "page_id long, record_type string, payload_bytes long, payload_digest string"))
    responses = whole.unionByName(joined)
    known = responses.filter("page_id is not null").dropDuplicates(["page_id", "payload_digest"])
    revisits = parsed.filter("record_type = 'revisit'").select("page_id", "refers_to", "payload_digest")
    again = (revisits.join(known.select(F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest"), ["refers_to", "payload_digest"], "left")
             .select("page_id", F.lit("revisit").alias("record_type"), "payload_bytes", "payload_digest", "refers_to"))
    out = responses.withColumn("refers_to", F.lit(None).cast("long")).unionByName(again)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
