from __future__ import annotations

import base64
import hashlib
import io
import zipfile

import pytest

from tollstats.llm import warc
from tollstats.llm.registry import QUERIES

PAGES = "page_id long, url string, html string, sha1 string, original int"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def reader(data):
    return lambda at, n: data[at : at + n]


@pytest.mark.parametrize("wide", [False, True])
def test_directory_of_plain_and_zip64_archives(wide):
    records = [(i, "response", warc.record_bytes(i, "http://x", b"p" * i, "D", None)) for i in range(5)]
    data = warc.pack_archive(records, wide)
    found = warc.members(reader(data), len(data))
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert {i.filename for i in z.infolist()} == set(found)
        for name, m in found.items():
            assert z.read(name) == data[m.offset : m.offset + m.size]


def test_zip64_end_records():
    """More members than the short end record can count."""
    target = io.BytesIO()
    with zipfile.ZipFile(target, "w", zipfile.ZIP_STORED) as z:
        for i in range(66_000):
            z.writestr(f"m{i}", b"x")
        z.comment = b"a comment behind the directory"
    data = target.getvalue()
    found = warc.members(reader(data), len(data))
    assert len(found) == 66_000 and data[found["m65999"].offset :][:1] == b"x"


def test_wide_extra_fields_are_taken_in_order():
    import struct

    extra = struct.pack("<HHI", 9, 4, 7) + struct.pack("<HHQQ", 1, 16, 5_000_000_000, 6_000_000_000)
    assert warc._wide_fields(extra, [0xFFFFFFFF, 12, 0xFFFFFFFF]) == [5_000_000_000, 12, 6_000_000_000]


def test_refusals():
    target = io.BytesIO()
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", b"x" * 100)
    data = target.getvalue()
    with pytest.raises(ValueError, match="compressed"):
        warc.members(reader(data), len(data))
    with pytest.raises(ValueError, match="not a ZIP"):
        warc.members(reader(b"short"), 5)


def test_whole_table(spark, medium):
    rows = QUERIES["op4_warc"](spark, medium).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{medium}/pages.parquet").collect()}
    check(rows, pages.items())


def check(rows, pages):
    largest = {}
    for page_id, html in pages:
        largest[html or ""] = max(largest.get(html or "", -1), page_id)
    want = sorted(
        (i, len((h or "").encode()), digest(h))
        + (("response", None) if largest[h or ""] == i else ("revisit", largest[h or ""]))
        for i, h in pages
    )
    got = sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows)
    assert got == want


def test_edges_and_payloads(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 500)
    monkeypatch.setattr(warc, "RANGE_BYTES", 300)
    html = [
        (1, "<p>ä\r\n\r\nb</p>"), (2, None), (3, ""), (9, "<p>ä\r\n\r\nb</p>"), (4, "x" * 500_000), (5, "same"),
        (6, "same"), (7, "same"), *[(100 + i, "hot") for i in range(50)],
    ]
    frame = spark.createDataFrame([(i, None if i == 1 else f"http://h/{i} \n", h, "own", 1) for i, h in html], PAGES)
    rows = warc.archived_pages(frame).collect()
    check(rows, html)
    texts = {r.page_id: bytes(r.payload).decode() for r in rows if r.record_type == "response"}
    assert texts == {i: h or "" for i, h in html if i in (3, 9, 4, 7, 149)}


def test_null_ids_and_repeated_rows(spark):
    frame = spark.createDataFrame([(None, None, "a", "", 1), (3, "u", "a", "", 1), (3, "u", "a", "", 1)], PAGES)
    rows = warc.archived_pages(frame).collect()
    assert sorted((str(r.page_id), r.record_type, r.refers_to) for r in rows) == [
        ("3", "response", None), ("3", "response", None), ("None", "response", None),
    ]
    assert warc.archived_pages(spark.createDataFrame([], PAGES)).count() == 0


def test_read_back_is_dealt_over_tasks(spark, small, monkeypatch):
    """As many tasks as the bytes need, which adaptive execution does not merge."""
    pages = spark.read.parquet(f"{small}/pages.parquet").repartition(8)
    tasks = []
    for size in (1 << 30, 10_000, 1_000):
        monkeypatch.setattr(warc, "TASK_BYTES", size)
        held = [len(x) for x in warc.archived_pages(pages).select("page_id").rdd.glom().collect()]
        assert sum(held) == pages.count()
        tasks.append(len(held))
    assert tasks[0] == 1 < tasks[1] < tasks[2] / 5
    assert sum(h > 0 for h in held) > 1


def test_stores_are_named_or_refused(spark, monkeypatch):
    assert warc.store_uri(spark, "/tmp/x") == warc.store_uri(spark, "file:/tmp/x") == "file:///tmp/x"
    monkeypatch.delitem(warc.STORES, "file")
    with pytest.raises(ValueError, match="cannot be written to file: stores"):
        warc.store_uri(spark, "/tmp/x")
