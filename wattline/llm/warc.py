"""WARC archives by index: one row per record with file, offset, length, URL and payload digest.

Writing: of pages with equal payloads one is stored as ``response``, the others as ``revisit`` records
that refer to it. Each task writes gzip members, one per record, into files of its own and returns the
index rows; a file is only known through the index of a task that ended.

Reading goes through the index alone: the selected records are sorted by file and offset, neighbouring
ranges are read at once, and each record is checked against its digest.

Defined results: a null or missing payload is empty, and empty payloads count as equal; the response
is the page with the largest id (null ids last), and rows that repeat id and payload of a response are
responses too; pages below ``revisit_from`` bytes are always stored; a null URL is written as an empty
target; very long pages are one record each; an empty table gives an empty index.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.shared import landed, read_range, write_file

FILE_BYTES = 256 << 20
#: Reading: ranges with at most this many unneeded bytes between them are read at once, up to a size.
GAP_BYTES, RANGE_BYTES = 64 << 10, 16 << 20
#: Fixed value: the profile of records whose payload is stored elsewhere.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = (
    "page_id long, url string, record_type string, refers_to long, payload_digest string, "
    "payload_bytes long, file string, offset long, length long"
)
_INDEX = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string())]
    + [("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64())]
    + [("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id, url, payload: bytes, digest: str, refers_to, is_revisit: bool, date: str) -> bytes:
    """One uncompressed record: WARC header, HTTP header, and the payload unless it is a revisit."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if is_revisit else http + payload
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    fields = [
        ("WARC-Type", "revisit" if is_revisit else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if is_revisit:
        fields.append(("WARC-Profile", REVISIT_PROFILE))
        fields.append(("WARC-Refers-To", record_id(refers_to)))
        if refers_to is not None:
            fields.append(("X-Refers-To-Page-ID", str(refers_to)))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields and payload of one record; the payload's digest is checked where it is stored."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(
        int(line.split(b":")[1])
        for line in http.split(b"\r\n")
        if line.lower().startswith(b"content-length:")
    )
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    stored = fields["WARC-Type"] == "response"
    if stored and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    number = lambda key: int(fields[key]) if key in fields else None
    return {
        "page_id": number("X-Page-ID"),
        "url": fields["WARC-Target-URI"],
        "record_type": fields["WARC-Type"],
        "refers_to": number("X-Refers-To-Page-ID"),
        "payload_digest": digest,
        "payload_bytes": size,
        "payload": payload if stored else None,
    }


def with_roles(pages: DataFrame, revisit_from: int) -> DataFrame:
    """(page_id, url, html) with ``payload_key``, and ``refers_to`` for pages that are not stored.

    Which page of a group is stored is an aggregate with map-side combine; only groups of several
    pages meet the pages again, in a join that adaptive execution can split for a hot payload.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    keyed = pages.select("page_id", "url", "html", F.sha1(payload).alias("payload_key"))
    groups = (
        pages.select("page_id", F.sha1(payload).alias("payload_key"), F.length(payload).alias("n"))
        .filter(F.col("n") >= revisit_from)
        .groupBy("payload_key")
        .agg(F.max("page_id").alias("stored"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
        .select("payload_key", "stored", F.lit(True).alias("shared"))
    )
    other = F.col("shared") & ~F.col("page_id").eqNullSafe(F.col("stored"))
    return keyed.join(groups, "payload_key", "left").select(
        "page_id",
        "url",
        "html",
        F.coalesce(other, F.lit(False)).alias("revisit"),
        F.when(other, F.col("stored")).alias("refers_to"),
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    revisit_from: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    level: int = 6,
) -> DataFrame:
    """Write (page_id, url, html) pages as archives below ``folder``; gives the stored index."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            uri, _ = write_file(folder, "archive.warc.gz", members)
            for row in rows:
                row["file"] = uri
            return pa.RecordBatch.from_pylist(rows, schema=_INDEX)

        members, rows, at = [], [], 0
        for batch in batches:
            for page in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                payload = (page["html"] or "").encode()
                digest = payload_digest(payload)
                raw = record(
                    page["page_id"], page["url"], payload, digest,
                    page["refers_to"], page["revisit"], date,
                )
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = packer.compress(raw) + packer.flush()
                rows.append({
                    "page_id": page["page_id"], "url": page["url"], "offset": at,
                    "record_type": "revisit" if page["revisit"] else "response",
                    "refers_to": page["refers_to"], "payload_digest": digest,
                    "payload_bytes": len(payload), "length": len(member),
                })
                members.append(member)
                at += len(member)
                if at >= FILE_BYTES:
                    yield flush()
                    members, rows, at = [], [], 0
        if members:
            yield flush()

    return landed(with_roles(pages, revisit_from).mapInArrow(write, INDEX), "warc-index")


def read_records(index: DataFrame) -> DataFrame:
    """The records that the index rows point at, read in coalesced byte ranges."""
    schema = (
        "page_id long, url string, record_type string, refers_to long, payload_digest string, "
        "payload_bytes long, payload binary"
    )
    kinds = pa.schema([f for f in _INDEX if f.name not in ("file", "offset", "length")])
    kinds = kinds.append(pa.field("payload", pa.binary()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fetch(file: str, spans: list[tuple[int, int]]) -> pa.RecordBatch:
            start = spans[0][0]
            raw = memoryview(read_range(file, start, spans[-1][0] + spans[-1][1] - start))
            found = [
                parse_record(zlib.decompress(raw[a - start : a - start + n], 31)) for a, n in spans
            ]
            return pa.RecordBatch.from_pylist(found, schema=kinds)

        file, spans = None, []
        for batch in batches:
            for at in batch.to_pylist():
                end = spans[-1][0] + spans[-1][1] if spans else 0
                if spans and (
                    at["file"] != file
                    or at["offset"] - end > GAP_BYTES
                    or at["offset"] + at["length"] - spans[0][0] > RANGE_BYTES
                ):
                    yield fetch(file, spans)
                    spans = []
                file = at["file"]
                spans.append((at["offset"], at["length"]))
        if spans:
            yield fetch(file, spans)

    # Records of one stretch of a file meet in one task, in order.
    stretch = F.floor(F.col("offset") / F.lit(RANGE_BYTES))
    total = index.agg(F.sum("length").alias("n")).first()["n"] or 0
    ordered = (
        index.select("file", "offset", "length")
        .withColumn("stretch", stretch)
        .repartition(total // RANGE_BYTES * 2 + 8, "file", "stretch")
        .sortWithinPartitions("file", "offset")
        .drop("stretch")
    )
    return ordered.mapInArrow(read, schema)


def digest(pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages, read all archives back, and tell what the records say."""
    return read_records(write_archives(pages, folder)).drop("payload", "url")
