"""WARC archives: written by Spark tasks, and read back by a sequential reader.

One gzip member per record. The reader decompresses a file bit by bit with zlib, takes a
record's block by its Content-Length, and holds it against the record's digests; a member
must end where its record ends. Nothing but one record is in memory.

Records with equal payloads are written once: the record with the smallest id is the
response, the others are revisits of it, with HTTP headers but no payload.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import released_shuffles, written
from tidemark.llm.shared_files import fresh, located
from tidemark.streaming.workspace import workspace

LEAST_PAYLOAD = 100
CHUNK = 1 << 16
FILE_BYTES = 1 << 28
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:page:"


class WarcError(ValueError):
    """The archive is cut off, badly framed, or does not match its digests."""


@dataclass(frozen=True)
class Record:
    headers: dict[str, str]
    block: bytes = field(repr=False)

    def __getitem__(self, name: str) -> str | None:
        return self.headers.get(name.lower())

    def http(self) -> tuple[dict[str, str], bytes]:
        """HTTP headers of the block, and the payload after them."""
        head, found, payload = self.block.partition(b"\r\n\r\n")
        if not found:
            raise WarcError("the block has no end of HTTP headers")
        return _fields(head.split(b"\r\n")[1:]), payload


def _fields(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, found, value = line.decode("utf-8").partition(":")
        if not found:
            raise WarcError(f"not a header: {line[:80]!r}")
        out[name.strip().lower()] = value.strip()
    return out


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as one gzip member."""
    head = [("Content-Length", str(len(block))), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}")]
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in [*headers, *head]), "", ""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + packer.flush()


def read_records(file: BinaryIO, chunk: int = CHUNK) -> Iterator[Record]:
    """The records of an open archive, in order."""
    waiting = b""
    while True:
        waiting = waiting or file.read(chunk)
        if not waiting:
            return
        member, data = zlib.decompressobj(31), bytearray()
        record: tuple[dict[str, str], int, int] | None = None
        while not member.eof:
            if not waiting and not (waiting := file.read(chunk)):
                raise WarcError("the archive ends inside a member")
            try:
                data += member.decompress(waiting, chunk)
            except zlib.error as error:
                raise WarcError(f"not a gzip member: {error}") from None
            waiting = member.unused_data if member.eof else member.unconsumed_tail
            if record is None and (at := data.find(b"\r\n\r\n")) >= 0:
                lines = bytes(data[:at]).split(b"\r\n")
                if not lines[0].startswith(b"WARC/1."):
                    raise WarcError(f"not a WARC record: {lines[0][:80]!r}")
                headers = _fields(lines[1:])
                if not (size := headers.get("content-length", "")).isdecimal():
                    raise WarcError("no Content-Length")
                record = headers, at + 4, at + 4 + int(size)
            if record is not None and len(data) > record[2] + 4:
                raise WarcError("a member goes on after its record")
        if record is None:
            raise WarcError("a member without a record")
        headers, start, stop = record
        if len(data) != stop + 4 or data[stop:] != b"\r\n\r\n":
            raise WarcError("the block is not as long as its Content-Length")
        block = bytes(data[start:stop])
        _hold(headers.get("warc-block-digest"), block, "block")
        yield Record(headers, block)


def _hold(digest: str | None, data: bytes, what: str) -> None:
    """Compare with a digest header: sha256 or sha1, in hexadecimal or base32."""
    if digest is None:
        return
    name, _, want = digest.partition(":")
    if name not in ("sha256", "sha1"):
        raise WarcError(f"unknown digest {name}")
    made = hashlib.new(name, data)
    if want not in (made.hexdigest(), base64.b32encode(made.digest()).decode().rstrip("="), base64.b32encode(made.digest()).decode()):
        raise WarcError(f"the {what} does not match its digest")


def page_record(
    page: int | None, url: str | None, payload: bytes, digest: str, first: int | None
) -> bytes:
    """A response with its payload, or a revisit of page ``first``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    target = "".join(c if c.isprintable() else "" for c in url or "").strip()
    headers = [
        ("WARC-Type", "response" if first is None else "revisit"),
        ("WARC-Record-ID", f"<{ID}{'' if page is None else page}>"),
        ("WARC-Date", DATE),
        *([("WARC-Target-URI", target)] if target else []),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
    ]
    if first is None:
        return record_bytes(headers, http + payload)
    headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{ID}{first}>")]
    return record_bytes(headers, http)


def _page(reference: str | None) -> int | None:
    """The page of a record id; null for a record of a page without an id."""
    number = (reference or "").removeprefix(f"<{ID}").removesuffix(">")
    return int(number) if number else None


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least: int = LEAST_PAYLOAD,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write a record per row; the list of archives (file, records) is returned, a table in ``folder``.

    The payload is the html in UTF-8; null is empty. Of equal payloads of at least ``least``
    bytes the row with the smallest id is the response, the others are revisits; shorter ones
    are all responses. A row with a null id is a response of its own and is never referred to.
    Of rows that repeat the smallest id, all are responses. An empty table gives no archives.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(f"`{id_col}`").alias("page"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html_col}`"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    first = written(
        rows.where(f"page IS NOT NULL AND octet_length(payload) >= {least}")
        .groupBy("digest")
        .agg(F.min("page").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first"),
        "warc-repeated",
    )
    # A payload held by very many pages is a skewed join, which is split.
    known = rows.join(first, "digest", "left").select(
        "page", "url", "payload", "digest", F.expr("CASE WHEN page <> first THEN first END").alias("first")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, size, count, done = None, "", 0, 0, []
        for batch in batches:
            for page, url, payload, digest, earlier in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name, size, count = fresh(folder, ".warc.gz"), 0, 0
                    fs, path = located(name)
                    out = fs.open_output_stream(path, compression=None)
                made = page_record(page, url, payload, digest, earlier)
                out.write(made)
                size, count = size + len(made), count + 1
                if size >= file_bytes:
                    out.close()
                    out = None
                    done.append((name, count))
        if out is not None:
            out.close()
            done.append((name, count))
        if done:
            files, counts = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(files), pa.array(counts, pa.int64())], names=["file", "records"])

    fs, place = located(folder)
    fs.create_dir(place, recursive=True)
    with released_shuffles(spark):
        known.mapInArrow(run, "file string, records long").write.parquet(f"{folder}/list")
    return spark.read.schema("file string, records long").parquet(f"{folder}/list")


def read_archives(spark: SparkSession, archives: DataFrame) -> DataFrame:
    """Every record of the listed archives, checked: (page, type, url, digest, payload_bytes, refers_to, payload).

    ``payload`` is null in revisits; their length and digest are those of the full payload.
    An archive is read by one task from start to end.
    """
    schema = "page long, type string, url string, digest string, payload_bytes long, refers_to long, payload binary"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fs, path = located(name)
                seen, rows, size = 0, [], 0
                with fs.open_input_stream(path, compression=None) as file:
                    for record in read_records(file):
                        rows.append(row := _row(record))
                        seen, size = seen + 1, size + len(row[-1] or b"")
                        if size > 1 << 24 or len(rows) >= 10_000:
                            yield _rows(rows)
                            rows, size = [], 0
                if seen != records:
                    raise WarcError(f"{name} has {seen} records instead of {records}")
                if rows:
                    yield _rows(rows)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        names = ["page", "type", "url", "digest", "payload_bytes", "refers_to", "payload"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    count = archives.count()
    return archives.repartition(max(1, count)).mapInArrow(run, schema)


def _row(record: Record) -> tuple:
    fields, payload = record.http()
    digest, size = record["WARC-Payload-Digest"] or "", int(fields["content-length"])
    if record["WARC-Type"] == "response":
        if len(payload) != size:
            raise WarcError("the payload is not as long as its Content-Length")
        _hold(digest, payload, "payload")
        refers, body = None, payload
    else:
        refers, body = _page(record["WARC-Refers-To"]), None
    return (
        _page(record["WARC-Record-ID"]), record["WARC-Type"], record["WARC-Target-URI"], digest.removeprefix("sha256:"), size, refers, body,
    )


def archive_digest(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Write ``pages``, read them back: (id, payload_bytes, payload_digest, record_type, refers_to)."""
    spark = pages.sparkSession
    archives = write_archives(pages, workspace(spark, "warc"), id_col)
    return read_archives(spark, archives).select(
        F.col("page").alias(id_col),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        "refers_to",
    )


def archive_sql(least: int = LEAST_PAYLOAD) -> str:
    """What ``archive_digest`` returns for ``pages``, in DuckDB."""
    return (
        "WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,"
        " sha256(coalesce(html, '')) AS payload_digest FROM pages),"
        " f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)"
        " SELECT page_id, payload_bytes, payload_digest,"
        f" CASE WHEN payload_bytes >= {least} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,"
        f" CASE WHEN payload_bytes >= {least} AND page_id <> first THEN first END AS refers_to FROM f"
    )
