"""WARC archives in which repeated payloads are written once.

Headers alone - page, length, SHA-1 of the payload, all computed in the JVM -
are shuffled by payload to find the first page of each repeated payload.  Every other page with it becomes a
revisit record that names that page and carries no payload.  Archives are
gzipped record by record, and reading them back needs nothing else.
"""

from __future__ import annotations

import base64
import datetime
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import files_of, saved, scratch, text_slices, write_file

#: Payload bytes after which a task begins a new archive file.
BYTES_PER_FILE = 16 << 20
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _payload(html: str | None) -> bytes:
    return (html or "").encode("utf-8", "surrogatepass")


def headers(pages: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_key)`` of each page, computed in the JVM where it is read.

    ``payload_key`` is the hexadecimal SHA-1 of the payload: the same hash as the
    records' base32 digest, so equal keys are equal digests.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    return pages.select(
        F.col("page_id").cast("long"), F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload).alias("payload_key"),
    )


def revisits(heads: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``(page_id, payload_key, refers_to)`` of pages whose payload an earlier page already has.

    Counting is combined before the shuffle; only keys that occur twice are
    joined back, and adaptive execution splits the rows of a very common one.
    A revisit is named by page and payload, so a ``page_id`` that repeats with
    other payloads is resolved per payload.  Rows that repeat the first page
    itself stay responses, and so do rows without a ``page_id``.
    """
    heads = heads.where((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull())
    first = (
        heads.groupBy("payload_key")
        .agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
        .where("refers_to < last")
        .drop("last")
    )
    return (
        heads.join(first, "payload_key")
        .where("page_id > refers_to")
        .select("page_id", "payload_key", "refers_to")
        .distinct()
    )


def _record(head: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in [*head, ("Content-Length", str(len(block)))]]
    return ("WARC/1.0\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _urn(page_id: int | None, url: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}' if page_id is None else f'page {page_id}')}>"


def page_record(page_id, url, html, refers_to, date: str) -> bytes:
    """One record, a response with its payload or a revisit with the response's headers alone."""
    payload = _payload(html)
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _urn(page_id, url)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if url is not None:
        head.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if page_id is not None:
        head.append(("WARC-Page-ID", str(page_id)))
    if refers_to is not None:
        head += [
            ("WARC-Profile", _PROFILE),
            ("WARC-Refers-To", _urn(refers_to, None)),
            ("WARC-Refers-To-Page-ID", str(refers_to)),
        ]
    return _record(head, http + (payload if refers_to is None else b""))


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """``(record headers, HTTP headers, payload)`` of each record of one archive file."""
    data = gzip.GzipFile(fileobj=io.BytesIO(content)).read()
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if lines[0] != "WARC/1.0":
            raise ValueError("not a WARC record")
        head = dict(x.split(": ", 1) for x in lines[1:])
        start, size = end + 4, int(head["Content-Length"])
        body = data.index(b"\r\n\r\n", start, start + size) + 4
        yield head, data[start:body], data[body : start + size]
        at = start + size + 4


def write_archives(
    pages: DataFrame, min_bytes: int = 0, folder: str | None = None, date: str | None = None
) -> tuple[str, DataFrame]:
    """Write ``pages (page_id, url, html)``; returns the folder and the list of its files.

    A null html is an empty payload.  The empty table gives no file.
    """
    folder = folder or scratch(pages.sparkSession, "warc")
    date = date or datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        held: list[bytes] = []
        size = records = 0

        def flush() -> pa.RecordBatch:
            name = f"pages-{task:06d}-{uuid.uuid4().hex}.warc.gz"
            write_file(f"{folder}/{name}", held)
            row = pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([records], pa.int64())], names=["name", "records"]
            )
            held.clear()
            return row

        for batch in batches:
            for part in text_slices(batch, "html", 1 << 22):
                for row in zip(*(part.column(c).to_pylist() for c in part.schema.names), strict=True):
                    record = page_record(*row, date)
                    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                    held.append(packer.compress(record) + packer.flush())
                    size += len(record)
                    records += 1
                    if size >= BYTES_PER_FILE:
                        yield flush()
                        size = records = 0
        if held:
            yield flush()

    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    )
    heads = saved(headers(rows), "headers")
    keyed = rows.withColumn("payload_key", F.sha1(F.encode(F.coalesce("html", F.lit("")), "UTF-8")))
    again = revisits(heads, min_bytes)
    resolved = keyed.join(again, ["page_id", "payload_key"], "left").select("page_id", "url", "html", "refers_to")
    return folder, saved(resolved.mapInArrow(write, "name string, records long"), "archive-list")


def read_archives(spark, folder: str, listed: DataFrame) -> DataFrame:
    """One row per record: page, url, length and digest of the full payload, kind, reference, html."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for head, http, payload in parse(content.as_py()):
                    kind = head["WARC-Type"]
                    size, named = len(payload), head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "revisit":
                        size = int(http.rsplit(b"Content-Length: ", 1)[1])
                    elif digest(payload) != named:
                        raise ValueError("a payload differs from its digest")
                    page, first = head.get("WARC-Page-ID"), head.get("WARC-Refers-To-Page-ID")
                    rows.append(
                        (
                            None if page is None else int(page), head.get("WARC-Target-URI"), size,
                            named, kind, None if first is None else int(first),
                            payload.decode("utf-8", "surrogatepass") if kind == "response" else None,
                        )
                    )
                    if len(rows) == 1000:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    return files_of(spark, folder, listed.select("name")).select("content").mapInArrow(read, _SCHEMA)


_SCHEMA = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, html string"
)
_ARROW = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("html", pa.string()),
    ]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)],
        schema=_ARROW,
    )
