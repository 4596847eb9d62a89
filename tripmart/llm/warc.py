"""WARC archives: one gzip member per record, equal payloads stored once.

Writing: tasks write archive files of ``FILE_BYTES`` each. Of pages with the same payload the one with the smallest id is a ``response``; the others are ``revisit``
records, which hold headers alone and refer to it. Which page that is comes from joins on
narrow columns; the payload itself is shuffled once.

Reading: each file is a stream. Members are decompressed a block at a time, records are cut
by their ``Content-Length``, and block and payload digests are verified on the way.

Defined results: a page without html has an empty payload; a page without a url has no
target URI. Rows repeated with the same id and payload are one response and revisits of it.
Pages without an id take part: they never are the smallest unless all are without one.
Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.common import (
    TaskFile,
    file_system,
    fresh_folder,
    one_each,
    rows_in_arrow,
    stored,
)

# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "2000-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

# A payload that very many pages share is joined on this many keys.
SALTS = 64

# An archive ends with the record that reaches this size.
FILE_BYTES = 1 << 30

_MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64())])
_RECORDS = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)
RECORD_DDL = (
    "page_id long, url string, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, payload binary"
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# -- Which page holds a payload -----------------------------------------------------


def with_record_types(pages: DataFrame) -> DataFrame:
    """Pages as page_id, url, html, digest, and ``first_id``: NULL for a response that no
    smaller page precedes, else the page to refer to; ``nth`` numbers repeated rows.

    What is decided about pages follows from a stored list of them without their payloads.
    """
    html = F.coalesce("html", F.lit(""))
    page = F.col("page_id").cast("long")
    digest = F.sha1(html)
    key = F.concat_ws(":", F.coalesce(page.cast("string"), F.lit("none")), digest)
    narrow = pages.select(page.alias("page_id"), digest.alias("digest"), key.alias("key"))
    narrow = stored(narrow, "warc-pages")
    shared = (
        narrow.groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    salted = narrow.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int"))
    # One row per page whose payload occurs again.
    copies = salted.join(shared, ["digest", "salt"]).groupBy("key").agg(
        F.min("first_id").alias("first_id"), F.lit(True).alias("shared")
    )
    repeated = Window.partitionBy("key").orderBy(F.col("url").asc_nulls_first())
    wide = pages.select(
        page.alias("page_id"),
        F.col("url").cast("string").alias("url"),
        html.alias("html"),
        digest.alias("digest"),
        key.alias("key"),
    ).withColumn("nth", F.row_number().over(repeated))
    return wide.join(stored(copies, "warc-copies"), "key", "left").select(
        "page_id", "url", "html", "digest", "nth", "first_id",
        (
            F.coalesce("shared", F.lit(False))
            & ~(F.col("page_id").eqNullSafe(F.col("first_id")) & (F.col("nth") == 1))
        ).alias("revisit"),
    )


# -- Writing ------------------------------------------------------------------------


def record_id(page_id: int | None, digest: str, nth: int = 1) -> str:
    name = f"{'none' if page_id is None else page_id}:{digest}"
    return f"<urn:page:{name}>" if nth == 1 else f"<urn:page:{name}:{nth}>"


def record_bytes(row: dict) -> bytes:
    """One record, as a gzip member."""
    payload = row["html"].encode()
    digest = base32_sha1(payload)
    http = _HTTP % len(payload)
    block = http if row["revisit"] else http + payload
    head = {
        "WARC-Type": "revisit" if row["revisit"] else "response",
        "WARC-Record-ID": record_id(row["page_id"], digest, row["nth"]),
        "WARC-Date": RECORD_DATE,
        "WARC-Block-Digest": f"sha1:{base32_sha1(block)}",
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
        # Extension fields: the page, and what a revisit leaves out.
        "X-Payload-Length": str(len(payload)),
    }
    if row["page_id"] is not None:
        head["X-Page-ID"] = str(row["page_id"])
    if row["url"] is not None:
        # Fixed value: characters that may stand in a URI as they are.
        uri = quote(row["url"], safe="!#$%&'()*+,/:;=?@[]~")
        head["WARC-Target-URI"] = uri
    if row["revisit"]:
        head["WARC-Profile"] = PROFILE
        head["WARC-Refers-To"] = record_id(row["first_id"], digest)
        if row["first_id"] is not None:
            head["X-Refers-To-Page-ID"] = str(row["first_id"])
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode()
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    record = b"".join((VERSION, b"\r\n", lines, b"\r\n", block, b"\r\n\r\n"))
    return packer.compress(record) + packer.flush()


def write_warc(
    pages: DataFrame, folder: str | None = None, file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Write every page as a record; returns one row (path, records) per archive file."""
    folder = folder or fresh_folder(pages.sparkSession, "warc")

    def write(rows: Iterator[dict]) -> Iterator[tuple]:
        file = None
        records = size = nth = 0
        for row in rows:
            if file is None:
                file, records, size = TaskFile(folder, ".warc.gz", nth), 0, 0
            record = record_bytes(row)
            file.stream.write(record)
            records += 1
            size += len(record)
            if size >= file_bytes:
                yield file.commit(), records
                file, nth = None, nth + 1
        if file:
            yield file.commit(), records

    records = with_record_types(pages)
    return stored(
        records.mapInArrow(rows_in_arrow(write, _MANIFEST), "path string, records long"),
        "warc-files",
    )


# -- Reading ------------------------------------------------------------------------


class Record(NamedTuple):
    """Headers by lower-case name, and the block."""

    head: dict[str, str]
    block: bytes


def members(stream, block_size: int = 1 << 16) -> Iterator[bytes]:
    """The decompressed members of a gzip stream, one at a time."""
    unpacker, parts, started = zlib.decompressobj(31), [], False
    while data := stream.read(block_size):
        while data:
            started = True
            parts.append(unpacker.decompress(data))
            data = unpacker.unused_data
            if unpacker.eof:
                yield b"".join(parts)
                unpacker, parts, started = zlib.decompressobj(31), [], False
            else:
                data = b""
    if started:
        raise ValueError("the archive ends inside a member")


def parse_record(member: bytes) -> Record:
    """Cut a record by its content length and verify its block digest."""
    end = member.find(b"\r\n\r\n")
    lines = member[:end].split(b"\r\n")
    if end < 0 or not lines[0].startswith(b"WARC/1."):
        raise ValueError("not a WARC record")
    head = {}
    for line in lines[1:]:
        name, _, value = line.decode().partition(":")
        head[name.strip().lower()] = value.strip()
    length = int(head["content-length"])
    block = member[end + 4 : end + 4 + length]
    if len(block) != length or member[end + 4 + length :] != b"\r\n\r\n":
        raise ValueError(f"wrong content length in {head.get('warc-record-id')}")
    digest = head.get("warc-block-digest")
    if digest and digest != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"wrong block digest in {head.get('warc-record-id')}")
    return Record(head, block)


def payload_of(record: Record) -> bytes | None:
    """The payload of a response, verified; None for a revisit, which holds none."""
    if record.head["warc-type"] == "revisit":
        return None
    payload = record.block.partition(b"\r\n\r\n")[2]
    if record.head["warc-payload-digest"] != f"sha1:{base32_sha1(payload)}":
        raise ValueError(f"wrong payload digest in {record.head.get('warc-record-id')}")
    return payload


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def read_warc(spark: SparkSession, files: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of archive files: a frame with the schema ``RECORD_DDL``.

    ``files`` has a column ``path``. Each file is read in one go by one task. Revisits
    have no payload of their own, but its length and digest; ``payloads=False`` leaves
    out the others' too, once verified.
    """

    def read(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            system, path = file_system(row["path"])
            with system.open_input_stream(path, compression=None) as stream:
                for record in map(parse_record, members(stream)):
                    head, payload = record.head, payload_of(record)
                    length = int(head["x-payload-length"])
                    if payload is not None and len(payload) != length:
                        raise ValueError(f"wrong payload length in {head['warc-record-id']}")
                    yield (
                        _number(head.get("x-page-id")),
                        head.get("warc-target-uri"),
                        length,
                        head["warc-payload-digest"].removeprefix("sha1:"),
                        head["warc-type"],
                        _number(head.get("x-refers-to-page-id")),
                        payload if payloads else None,
                    )

    paths = files.select("path")
    spread = one_each(paths, paths.count())
    return spread.mapInArrow(rows_in_arrow(read, _RECORDS), RECORD_DDL)
