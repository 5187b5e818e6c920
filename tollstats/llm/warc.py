"""WARC records in ZIP-packaged archives: writing, and reading without extraction.

An archive is a ZIP file of stored (not compressed) members: the WARC file
``archive/data.warc.gz``, in which every record is a gzip member of its own, and
``indexes/index.cdxj`` with the place of every record in it. A reader finds the
members through the central directory, reads the index, and then any record by
its byte range.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollstats.llm.shipping import ship_package
from tollstats.llm.staging import checkpointed
from tollstats.sources.staging import staging_path

# Names and formats of the packaging and of WARC 1.1.
ARCHIVE_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LENGTH_FIELD = "WARC-Payload-Length"
END_RECORD, END_RECORD_64, LOCATOR_64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
DIRECTORY_ENTRY, LOCAL_HEADER = b"PK\x01\x02", b"PK\x03\x04"
ZIP64_EXTRA = 1
SMALL_LIMIT, LARGE_LIMIT = 0xFFFF, 0xFFFFFFFF

# An archive is closed at this many bytes of records; a task holds one at a time.
ARCHIVE_BYTES = 16 << 20
# Neighbouring records of up to so many bytes are read as one range.
RANGE_BYTES = 4 << 20
# Of the archives, what one task reads.
TASK_BYTES = 16 << 20
# Schemes of Spark's stores, and what the tasks' readers call them.
STORES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "gs": "gs"}
GZIP_LEVEL = 1
CAPTURE_DATE = "2024-01-01T00:00:00Z"

ReadRange = Callable[[int, int], bytes]


class Member(NamedTuple):
    """A stored member of an archive: where its bytes begin, and how many they are."""

    name: str
    offset: int
    size: int


# --- ZIP ----------------------------------------------------------------------


def _directory_place(read: ReadRange, size: int) -> tuple[int, int, int]:
    """Offset, bytes and entries of the central directory, from the end records."""
    tail_at = max(0, size - 22 - SMALL_LIMIT)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(END_RECORD)
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP archive")
    entries, length, offset = struct.unpack("<HII", tail[at + 10 : at + 20])
    if entries == SMALL_LIMIT or LARGE_LIMIT in (length, offset):
        locator = tail[at - 20 : at] if at >= 20 else read(tail_at + at - 20, 20)
        if locator[:4] == LOCATOR_64:
            (end_at,) = struct.unpack("<Q", locator[8:16])
            end = read(end_at, 56)
            if end[:4] != END_RECORD_64:
                raise ValueError("damaged ZIP64 end of central directory")
            entries, length, offset = struct.unpack("<QQQ", end[32:56])
    return offset, length, entries


def _wide_fields(extra: bytes, narrow: list[int]) -> list[int]:
    """Sizes and offset with those at their limit taken from the ZIP64 extra field, in order."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack("<HH", extra[at : at + 4])
        if kind == ZIP64_EXTRA:
            values = list(struct.unpack(f"<{length // 8}Q", extra[at + 4 : at + 4 + length // 8 * 8]))
            return [values.pop(0) if x == LARGE_LIMIT and values else x for x in narrow]
        at += 4 + length
    return narrow


def members(read: ReadRange, size: int) -> dict[str, Member]:
    """The stored members of a ZIP archive of ``size`` bytes, by name; compressed ones are refused."""
    offset, length, entries = _directory_place(read, size)
    directory, at, found = read(offset, length), 0, {}
    for _ in range(entries):
        if directory[at : at + 4] != DIRECTORY_ENTRY:
            raise ValueError("damaged central directory")
        (method,) = struct.unpack("<H", directory[at + 10 : at + 12])
        packed, unpacked, name_n, extra_n, comment_n = struct.unpack("<IIHHH", directory[at + 20 : at + 34])
        (header_at,) = struct.unpack("<I", directory[at + 42 : at + 46])
        name = directory[at + 46 : at + 46 + name_n].decode()
        extra = directory[at + 46 + name_n : at + 46 + name_n + extra_n]
        unpacked, packed, header_at = _wide_fields(extra, [unpacked, packed, header_at])
        if method:
            raise ValueError(f"{name} is compressed; only stored members can be read by range")
        local = read(header_at, 30)
        if local[:4] != LOCAL_HEADER:
            raise ValueError(f"no local header for {name}")
        local_name, local_extra = struct.unpack("<HH", local[26:30])
        found[name] = Member(name, header_at + 30 + local_name + local_extra, packed)
        at += 46 + name_n + extra_n + comment_n
    return found


# --- WARC ---------------------------------------------------------------------


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id: int, url: str | None, payload: bytes, digest: str, original: int | None) -> bytes:
    """One gzip member with a response record, or a revisit of the page ``original``."""
    fields = [
        ("WARC-Type", "response" if original is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{page_id}>"),
        ("WARC-Target-URI", " ".join((url or "").split())),
        ("WARC-Date", CAPTURE_DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        (LENGTH_FIELD, str(len(payload))),
    ]
    if original is not None:
        fields += [("WARC-Refers-To", f"<urn:page:{original}>"), ("WARC-Profile", REVISIT_PROFILE)]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    body = http + (payload if original is None else b"")
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(body)))]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + body + b"\r\n\r\n") + packer.flush()


class Record(NamedTuple):
    fields: dict[str, str]
    payload: bytes


def parse_record(packed: bytes) -> Record:
    """Header fields and payload (the body behind the HTTP header) of one gzip member."""
    raw = zlib.decompress(packed, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    body = rest[: int(fields["Content-Length"])]
    return Record(fields, body.partition(b"\r\n\r\n")[2])


def pack_archive(records: list[tuple[int, str, bytes]], wide: bool = False) -> bytes:
    """A ZIP archive of (page_id, type, gzip member) records and their index.

    ``wide`` writes ZIP64 fields even where the sizes do not need them.
    """
    lines, at = [], 0
    for page_id, kind, packed in records:
        lines.append(json.dumps({"page_id": page_id, "type": kind, "offset": at, "length": len(packed)}))
        at += len(packed)
    target = io.BytesIO()
    with zipfile.ZipFile(target, "w", zipfile.ZIP_STORED) as archive:
        for name, data in (
            (ARCHIVE_MEMBER, b"".join(r[2] for r in records)),
            (INDEX_MEMBER, "\n".join(lines).encode()),
        ):
            with archive.open(zipfile.ZipInfo(name), "w", force_zip64=wide) as member:
                member.write(data)
    return target.getvalue()


# --- Spark --------------------------------------------------------------------


def _range_reader(uri: str) -> tuple[ReadRange, int, Callable[[], None]]:
    """Ranged reads of a file in any store that pyarrow knows by its URI."""
    store, path = fs.FileSystem.from_uri(uri)
    file = store.open_input_file(path)
    return (lambda at, n: file.read_at(n, at)), file.size(), file.close


def originals(pages: DataFrame) -> DataFrame:
    """The pages and ``original``: the largest page_id of an equal payload.

    Digests are reduced before the join: one row per digest and map task.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    known = pages.select("page_id", "url", "html", F.sha1(payload).alias("sha1"))
    largest = known.groupBy("sha1").agg(F.max("page_id").alias("original"))
    return known.join(largest, "sha1").drop("sha1")


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write the pages into archives under ``folder`` and return their manifest (uri, records).

    ``pages`` needs page_id, url and html. A page whose payload another page of
    a larger id has as well becomes a revisit of the largest. Every attempt of
    a task writes files of its own names, and only those of the attempts that
    succeeded are in the manifest, so tasks may be repeated or lost.
    """
    spark = pages.sparkSession
    ship_package(spark)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        pending: list[tuple[int, str, bytes]] = []
        held = 0

        def close() -> pd.DataFrame:
            name = f"{base}/{uuid.uuid4().hex}.wacz"
            with store.open_output_stream(name) as out:
                out.write(pack_archive(pending))
            uri = f"{folder.rstrip('/')}/{name.rpartition('/')[2]}"
            return pd.DataFrame({"uri": [uri], "records": [len(pending)]})

        for batch in batches:
            ids, firsts = batch["page_id"].astype("Int64"), batch["original"].astype("Int64")
            for page_id, url, html, original in zip(ids, batch["url"], batch["html"], firsts):
                payload = (html or "").encode()
                here = None if pd.isna(page_id) else int(page_id)
                first = None if pd.isna(original) or here == original or here is None else int(original)
                packed = record_bytes(here, url, payload, payload_digest(payload), first)
                pending.append((here, "response" if first is None else "revisit", packed))
                held += len(packed)
                if held >= ARCHIVE_BYTES:
                    yield close()
                    pending, held = [], 0
        if pending:
            yield close()

    manifest = f"{folder.rstrip('/')}/manifest"
    originals(pages).mapInPandas(write, "uri string, records long").write.parquet(manifest)
    return spark.read.schema("uri string, records long").parquet(manifest)


def record_ranges(manifest: DataFrame) -> DataFrame:
    """(uri, start, stop, offsets): ranges of neighbouring records, from the archives' indexes."""

    def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for uri in batch["uri"]:
                read, size, close = _range_reader(uri)
                found = members(read, size)
                index, data = found[INDEX_MEMBER], found[ARCHIVE_MEMBER]
                lines = [json.loads(x) for x in read(index.offset, index.size).decode().splitlines()]
                close()
                group: list[int] = []
                for line in lines:
                    at = data.offset + line["offset"]
                    if group and at + line["length"] - group[0] > RANGE_BYTES:
                        rows.append((uri, group[0], at, group))
                        group = []
                    group.append(at)
                if group:
                    rows.append((uri, group[0], data.offset + data.size, group))
            yield pd.DataFrame(rows, columns=["uri", "start", "stop", "offsets"])

    return manifest.mapInPandas(ranges, "uri string, start long, stop long, offsets array<long>")


def read_records(manifest: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to and payload of every record.

    Indexes are read first; the byte ranges they give are dealt over tasks of
    about TASK_BYTES each and read one by one. A response's payload is checked against its digest; a
    revisit has none, and its payload_bytes and payload_digest are those its
    header states of the full payload.
    """
    ship_package(manifest.sparkSession)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri, start, stop, offsets in zip(batch["uri"], batch["start"], batch["stop"], batch["offsets"]):
                fetch, _, close = _range_reader(uri)
                data = fetch(int(start), int(stop - start))
                close()
                ends = np.append(np.asarray(offsets)[1:], stop) - start
                rows = [_result(parse_record(data[a:b])) for a, b in zip(np.asarray(offsets) - start, ends)]
                done = pd.DataFrame(rows, columns=_RESULT)
                yield done.astype({"page_id": "Int64", "refers_to": "Int64"})

    ranges = checkpointed(record_ranges(manifest))
    total = ranges.agg(F.sum(F.col("stop") - F.col("start"))).first()[0] or 0
    # A number of its own keeps adaptive execution from merging these small rows into one task.
    dealt = ranges.repartition(max(1, -(-total // TASK_BYTES)), "uri", "start")
    return dealt.mapInPandas(
        read,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary",
    )


_RESULT = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number not in ("", "None") else None


def _result(record: Record) -> tuple:
    fields = record.fields
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and payload_digest(record.payload) != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return (
        _page(fields["WARC-Record-ID"]), int(fields[LENGTH_FIELD]), digest, kind,
        _page(fields.get("WARC-Refers-To")), record.payload if kind == "response" else None,
    )


def store_uri(spark: SparkSession, folder: str) -> str:
    """The folder as Spark resolves it, in a form that the tasks' readers know too.

    A folder without a scheme lies in the cluster's default store. Spark's names
    of object stores become those of Arrow; a store that Arrow cannot open is
    refused here and not in a task.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    scheme, _, path = whole.partition(":")
    known = STORES.get(scheme)
    if known is None:
        raise ValueError(f"archives cannot be written to {scheme}: stores; use one of {', '.join(sorted(STORES))}")
    return f"{known}:///{path.lstrip('/')}" if known == "file" else f"{known}:{path}"


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write the pages into archives in the shared folder and read every record back.

    A null html is an empty payload; equal payloads, empty ones among them, are
    stored once, by the page of the largest id. A null page_id is written as a
    response of its own and read back as null. Repeated rows of the largest id
    are all responses. Other columns are ignored; an empty table gives an empty
    result.
    """
    spark: SparkSession = pages.sparkSession
    return read_records(write_archives(pages, store_uri(spark, staging_path(spark, "archives"))))
