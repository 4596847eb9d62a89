import base64
import hashlib
import io
import zlib

import pytest
from corpus_cases import as_tuples

from tripmart.llm import warc

PAGES = [
    (1, "http://a/x y", "<p>one</p>"),
    (5, "http://b", "<p>one</p>"),
    (3, None, "<p>one</p>"),
    (3, "http://c", "<p>one</p>"),
    (9, "http://ü/\r\nX: y", "<p>zwei ü 🙂</p>"),
    (10, "u", None),
    (8, "u", ""),
    (None, "u", "<p>one</p>"),
    (None, "u", "lone"),
    (None, "u", "lone"),
    (12, "u", "long " * 200_000),
]
COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(pages):
    groups = {}
    for page_id, _, html in pages:
        groups.setdefault(html or "", []).append(page_id)
    rows = []
    for html, ids in groups.items():
        first = min((i for i in ids if i is not None), default=None)
        ids.remove(first)
        size = len(html.encode())
        rows.append((first, size, digest(html), "response", None))
        rows += [(i, size, digest(html), "revisit", first) for i in ids]
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def pages(spark):
    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    return frame.selectExpr("*", "'x' as key", "'x' as digest", "1 as nth", "'x' as payload")


def test_round_trip(spark, pages):
    files = warc.write_warc(pages.repartition(3))
    records = warc.read_warc(spark, files).cache()
    assert as_tuples(records, *COLUMNS) == expected(PAGES)
    payloads = {r.payload.decode() for r in records.collect() if r.record_type == "response"}
    assert payloads == {html or "" for _, _, html in PAGES}
    assert all(r.payload is None for r in records.collect() if r.record_type == "revisit")
    urls = {r.url for r in records.filter("page_id = 9").collect()}
    assert urls == {"http://%C3%BC/%0D%0AX:%20y"}


def test_archives_are_rolled(spark, pages):
    """By the bytes written, whatever the session's partitions are."""
    counts = [warc.write_warc(pages, file_bytes=size).count() for size in (1, 900, 1 << 30)]
    assert counts[0] == len(PAGES) > counts[1] > counts[2]
    small = warc.read_warc(spark, warc.write_warc(pages, file_bytes=1))
    assert as_tuples(small, *COLUMNS) == expected(PAGES)


def test_no_pages(spark, pages):
    assert warc.read_warc(spark, warc.write_warc(pages.limit(0))).count() == 0


def record(**changes):
    row = {"page_id": 1, "url": "u", "html": "text", "nth": 1, "first_id": None, "revisit": False}
    return warc.record_bytes(row | changes)


def test_members_are_read_in_small_steps():
    data = record() + record(page_id=2, html="") + record(page_id=3, revisit=True, first_id=1)
    heads = [warc.parse_record(m).head for m in warc.members(io.BytesIO(data), 7)]
    assert [h["x-page-id"] for h in heads] == ["1", "2", "3"]
    assert [h["warc-type"] for h in heads] == ["response", "response", "revisit"]
    # One member per record: each can be read by itself.
    assert zlib.decompress(record(), 31).startswith(b"WARC/1.1\r\n")


def test_damage_is_found():
    plain = zlib.decompress(record(), 31)
    with pytest.raises(ValueError, match="content length"):
        warc.parse_record(plain[:-5])
    with pytest.raises(ValueError, match="block digest"):
        warc.parse_record(plain.replace(b"text\r\n\r\n", b"tExt\r\n\r\n"))
    with pytest.raises(ValueError, match="not a WARC record"):
        warc.parse_record(b"something else")
    with pytest.raises(ValueError, match="inside a member"):
        list(warc.members(io.BytesIO(record()[:-3])))
    lying = warc.parse_record(plain)
    lying.head["warc-payload-digest"] = "sha1:X"
    with pytest.raises(ValueError, match="payload digest"):
        warc.payload_of(lying)
