"""WARC archives: writing pages as records, reading records back, and putting segmented records together.

Each record is a gzip member of its own. Members are packed into rows of bounded size, and the rows go through Spark's
text sink, whose line separator is an empty member, so files are committed like any other output, to any file system,
and hold so many rows at most. Payloads that were met before become revisit records. HTTP bodies are sent in
chunks; a block beyond the segment size is cut into a first record and continuation records (WARC-Segment-Number,
-Origin-ID, -Total-Length). Reading parses whole files, groups the records of a segmented block by their origin, orders
them by number, verifies that none is missing and that the total length is right, and then undoes the chunked transfer
framing. Both ends check the payload digest."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import zlib
from itertools import count

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import fresh_path, materialize

SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
#: Bytes of members in a row of the sink (one record more at most), and in a file, which is read by one task; and bytes of
#: blocks that a reader holds at once.
PACK_BYTES = 1 << 20
FILE_BYTES = 32 << 20
READ_BYTES = 8 << 20
#: Payloads of fewer bytes are never revisits.
LEAST_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
CRLF = b"\r\n"
_PARSED = "record_id string, kind string, uri string, digest string, refers_to string, origin string, segment int, total long, block binary"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id, rest: str) -> str:
    """The id of a record of a page. A page number alone isn't one: an id can be repeated with another payload."""
    return f"<urn:page:{page_id}:{rest}>"


def member(record: bytes) -> bytes:
    """A record with its terminator as a gzip member."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(record + CRLF + CRLF) + z.flush()


def chunked(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    """A body in chunked transfer framing; chunks end between characters of UTF-8."""
    out, at = [], 0
    while at < len(body):
        end = _border(body, at + size, at)
        out += [b"%x\r\n" % (end - at), body[at:end], CRLF]
        at = end
    return b"".join([*out, b"0\r\n\r\n"])


def dechunked(data: bytes) -> bytes:
    """Undo chunked framing: chunk extensions and trailers are skipped; a cut or false chunk is an error."""
    out, at = [], 0
    while True:
        end = data.index(CRLF, at)
        size = int(data[at:end].split(b";")[0].strip(), 16)
        if not size:
            return b"".join(out)
        part = data[end + 2 : end + 2 + size]
        if len(part) != size or data[end + 2 + size : end + 4 + size] != CRLF:
            raise ValueError("a chunk is cut short")
        out.append(part)
        at = end + 4 + size


def _border(data: bytes, at: int, least: int) -> int:
    """The last place <= at between two characters of UTF-8, beyond ``least``."""
    at = min(at, len(data))
    while at < len(data) and at > least + 1 and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in headers if v is not None]
    return "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}", "", ""]).encode() + block


def records(rid: str, url: str | None, payload: bytes, digest: str, refers_to: str | None = None, segment: int = SEGMENT_BYTES, chunk: int = CHUNK_BYTES) -> list[bytes]:
    """The record or records of a page, without the terminator. ``refers_to``: the record of an equal payload."""
    uri = " ".join((url or "about:blank").split())
    common = [("WARC-Target-URI", uri), ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if refers_to is not None:
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        return [_record([("WARC-Type", "revisit"), ("WARC-Record-ID", rid), ("WARC-Refers-To", refers_to), ("WARC-Profile", profile), *common], block)]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk)
    if len(block) <= segment:
        return [_record([("WARC-Type", "response"), ("WARC-Record-ID", rid), *common], block)]
    parts, at = [], 0
    while at < len(block):
        end = _border(block, at + segment, at)
        parts.append(block[at:end])
        at = end
    out = [_record([("WARC-Type", "response"), ("WARC-Record-ID", rid), ("WARC-Segment-Number", 1), *common], parts[0])]
    for n, part in enumerate(parts[1:], 2):
        own = f"{rid[:-1]}:{n}>"
        total = len(block) if n == len(parts) else None
        out.append(_record([("WARC-Type", "continuation"), ("WARC-Record-ID", own), ("WARC-Segment-Number", n), ("WARC-Segment-Origin-ID", rid), ("WARC-Segment-Total-Length", total), ("WARC-Target-URI", uri), ("WARC-Date", DATE)], part))
    return out


def parse(data: bytes):
    """(headers in lower case, block) of each record of a file, plain or in gzip members, one at a time."""
    raw = io.BytesIO(data)
    stream = io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20) if data[:2] == b"\x1f\x8b" else raw
    while True:
        line = stream.readline()
        while line == CRLF:
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:20]!r}")
        headers = {}
        while (line := stream.readline()) != CRLF:
            if not line.endswith(CRLF):
                raise ValueError("the header of the last record is cut short")
            k, _, v = line.decode("utf-8", "replace").partition(":")
            headers[k.strip().lower()] = v.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("the last record is cut short")
        yield headers, block


def payload_of(block: bytes) -> bytes:
    """The decoded body of an HTTP response block."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip().lower() for k, _, v in (x.partition(b":") for x in head.split(CRLF)[1:])}
    return dechunked(body) if b"chunked" in fields.get(b"transfer-encoding", b"") else body


def reassemble(parts: list[tuple[int, int | None, bytes]]) -> tuple[bytes, int]:
    """(number, total length, block) of the segments of one origin, in any order, to the whole block, and how often it
    is there (rows repeated with one id give equal records). Segments that are missing or contradict each other, and a
    false total length, are errors."""
    once: dict[int, tuple] = {}
    for n, total, block in parts:
        if once.setdefault(n, (total, block)) != (total, block):
            raise ValueError(f"two segments have number {n}")
    times = len(parts) // len(once)
    if sorted(once) != list(range(1, len(once) + 1)) or any(sum(p[0] == n for p in parts) != times for n in once):
        raise ValueError("a segment is missing")
    whole = b"".join(once[n][1] for n in sorted(once))
    totals = {t for t, _ in once.values() if t is not None}
    if totals != {len(whole)}:
        raise ValueError(f"the segments have {len(whole)} bytes, not {totals}")
    return whole, times


def plan_records(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, body (the payload), kept: the largest page_id of those with an equal payload, if there are several.

    Only payloads that occur twice are looked up, from a table of known size; pages are shuffled only if that is large."""
    body = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    made = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", body.alias("body"))
    key = F.sha1("body")
    twice = made.select("page_id", key.alias("key"), F.octet_length("body").alias("n")).where(F.col("n") >= least_bytes).groupBy("key").agg(F.max("page_id").alias("kept"), F.count("*").alias("times"))
    twice = materialize(twice.where("times > 1").select("key", "kept"), "payloads")
    found = made.withColumn("key", key).join(twice, "key", "left")
    return found.select("page_id", "url", "body", "kept")


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES, segment: int = SEGMENT_BYTES, chunk: int = CHUNK_BYTES, file_bytes: int = FILE_BYTES, pack_bytes: int = PACK_BYTES) -> None:
    """Write each page as a response or revisit record into gzipped WARC files under ``path``."""

    def run(batches):
        task, row, pack, held = TaskContext.get().partitionId(), count(), [], 0
        out = lambda: pa.RecordBatch.from_arrays([pa.array([b"".join(pack)], pa.binary())], ["value"])
        for batch in batches:
            for i, u, b, kept in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "body", "kept"))):
                digest = digest_of(b)
                # a record that others refer to is known by its page and payload; the rest have numbers
                rid = record_id(i, digest if i is not None and i == kept else f"{task}-{next(row)}")
                to = record_id(kept, digest) if kept is not None and i is not None and i != kept else None
                for r in records(rid, u, b, digest, to, segment, chunk):
                    pack.append(member(r))
                    held += len(pack[-1])
                    if held >= pack_bytes:
                        yield out()
                        pack, held = [], 0
        if pack:
            yield out()

    rows = plan_records(pages, least_bytes).mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    between = zlib.compressobj(6, zlib.DEFLATED, 31).flush().decode("latin-1")
    rows.write.option("encoding", "ISO-8859-1").option("lineSep", between).option("maxRecordsPerFile", max(1, file_bytes // pack_bytes)).text(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path``, as it stands."""

    def run(frames):
        names = [x.split()[0] for x in _PARSED.split(", ")]
        number = lambda h, k: int(h[k]) if k in h else None
        table = lambda rows: pd.DataFrame(rows, columns=names).astype({"segment": "Int32", "total": "Int64"})
        for f in frames:
            for content in f["content"]:
                rows, held = [], 0
                for h, block in parse(bytes(content)):
                    digest = (h.get("warc-payload-digest") or "").rpartition(":")[2] or None
                    rows.append((h.get("warc-record-id"), h.get("warc-type"), h.get("warc-target-uri"), digest, h.get("warc-refers-to"), h.get("warc-segment-origin-id"), number(h, "warc-segment-number"), number(h, "warc-segment-total-length"), block))
                    held += len(block)
                    if held >= READ_BYTES:
                        yield table(rows)
                        rows, held = [], 0
                if rows:
                    yield table(rows)

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, _PARSED)


def payloads(parsed: DataFrame, verify: bool = True) -> DataFrame:
    """record_id, kind, uri, digest, refers_to, payload of each whole record (for revisits the payload is empty and
    n_bytes is the length that its HTTP header tells). Only segmented records are shuffled, by their origin."""
    schema = "record_id string, kind string, uri string, digest string, refers_to string, n_bytes long, payload binary"

    def run(frames):
        for f in frames:
            out = []
            for rid, kind, uri, digest, to, parts in zip(f["record_id"], f["kind"], f["uri"], f["digest"], f["refers_to"], f["parts"]):
                parts = [(p["segment"], p["total"], bytes(p["block"])) for p in parts]
                whole, times = (parts[0][2], 1) if parts[0][0] is None else reassemble(parts)
                if kind == "revisit":
                    head = {k.strip().lower(): v for k, _, v in (x.partition(b":") for x in whole.split(CRLF)[1:])}
                    out.append((rid, kind, uri, digest, to, int(head[b"content-length"]), b""))
                    continue
                body = payload_of(whole)
                if verify and digest and digest_of(body) != digest:
                    raise ValueError(f"the payload of {rid} doesn't have its digest")
                out += [(rid, kind, uri, digest or digest_of(body), to, len(body), body)] * times
            yield pd.DataFrame(out, columns=[x.split()[0] for x in schema.split(", ")])

    part = F.struct("segment", "total", "block")
    whole = parsed.where("segment is null").select("record_id", "kind", "uri", "digest", "refers_to", F.array(part).alias("parts"))
    cut = parsed.where("segment is not null").groupBy(F.coalesce("origin", "record_id").alias("record_id")).agg(
        *[F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in ("kind", "uri", "digest", "refers_to")], F.collect_list(part).alias("parts")
    )  # the segments of one page
    return whole.union(cut).mapInPandas(run, schema)


def archive_round_trip(pages: DataFrame, least_bytes: int = LEAST_BYTES, segment: int = SEGMENT_BYTES, chunk: int = CHUNK_BYTES, file_bytes: int = FILE_BYTES, pack_bytes: int = PACK_BYTES) -> DataFrame:
    """Write ``pages``, read the archives back, and tell per page: page_id, payload_bytes, payload_digest, record_type,
    refers_to.

    A null html is an empty payload; empty payloads are equal like others. A null url is about:blank. Of equal payloads
    of ``least_bytes`` bytes or more the largest page_id is the response; of rows repeated with that id each is one; a
    page_id with several payloads is a page each time. A page with a null id is archived without a number and reported with a null page_id. Other columns are ignored; an
    empty table gives an empty result."""
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_archives(pages, path, least_bytes, segment, chunk, file_bytes, pack_bytes)
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)", 1).try_cast("long")
    read = payloads(read_records(spark, path)).drop("payload")
    return read.select(number(F.col("record_id")).alias("page_id"), F.col("n_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), number(F.col("refers_to")).alias("refers_to"))
