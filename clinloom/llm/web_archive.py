"""WARC records in ZIP-packaged archives: writer, and a reader that never unpacks an archive.

An archive is a ZIP file whose members are stored, not deflated: ``archive/data.warc.gz`` (a gzip member
for each WARC record) and ``indexes/index.cdxj`` (a JSON line with offset and length for each record). The
reader takes an archive's tail, finds the end of the central directory, follows the ZIP64 locator where
fields are saturated, parses the directory and the ZIP64 extra fields, finds where a stored member's bytes
start by its local header, reads the index, and then reads records by byte range; ranges of neighbouring
records are dealt out over the cluster.

Of pages with equal payloads the one with the smallest page_id is a response record, the others are
revisits that refer to it. A task writes one archive, under a name of its own attempt.

Nulls and edge cases: a null html is the empty payload, and empty payloads count as equal; rows with
the smallest page_id, repeated rows among them, are all responses; null page_ids come after all others and
are carried; a null url leaves the target out, line breaks in one become blanks; very long payloads are
whole; columns besides page_id, url and html are not read, whatever their names; no pages give no archive and
no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import rows_in_slices
from clinloom.session import shared_dir, ship_package, store

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "1970-01-01T00:00:00Z"
#: Records, and bytes of them, that are read in one range (a longer record is a range alone).
RANGE_RECORDS, RANGE_BYTES = 128, 8 << 20
#: Archive bytes, and archives' indexes, that a reading task takes.
TASK_BYTES, TASK_ARCHIVES = 32 << 20, 16
MANIFEST = "path string, records long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    found = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(found) if found else None


def warc_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record, uncompressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _name(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", " ".join(url.splitlines())))
    if revisit:
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        fields.append(("WARC-Refers-To", _name(refers_to)))
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode("utf-8") + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}


def parse_record(record: bytes) -> tuple:
    """The columns of ``RECORD``; a response's payload is checked against its digest."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(_fields(http)["content-length"])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response" and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError(f"damaged record {fields['warc-record-id']}")
    return (
        _page(fields["warc-record-id"]),
        size,
        digest,
        fields["warc-type"],
        _page(fields.get("warc-refers-to")),
        fields.get("warc-target-uri"),
    )


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header: int  # place of the local header


def directory(file, size: int) -> list[Member]:
    """The members of a ZIP archive, from its tail alone. ``file`` has read_at(length, offset)."""
    tail_at = max(0, size - 65_557 - 20)
    tail = file.read_at(size - tail_at, tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    locator = end - 20
    if (count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF) and locator >= 0 and tail[locator : locator + 4] == b"PK\x06\x07":
        (wide_at,) = struct.unpack_from("<Q", tail, locator + 8)
        wide = file.read_at(56, wide_at)
        if wide[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", wide, 32)
    listing, at, members = file.read_at(length, start), 0, []
    for _ in range(count):
        if listing[at : at + 4] != b"PK\x01\x02":
            raise ValueError("damaged central directory")
        (method,) = struct.unpack_from("<H", listing, at + 10)
        packed, plain, n, extra, comment = struct.unpack_from("<IIHHH", listing, at + 20)
        (header,) = struct.unpack_from("<I", listing, at + 42)
        name = listing[at + 46 : at + 46 + n].decode("utf-8")
        x, stop = at + 46 + n, at + 46 + n + extra
        while x + 4 <= stop:
            kind, m = struct.unpack_from("<HH", listing, x)
            if kind == 1:  # ZIP64: 8 bytes for each saturated field, in this order
                wide_at = x + 4
                if plain == 0xFFFFFFFF:
                    (plain,), wide_at = struct.unpack_from("<Q", listing, wide_at), wide_at + 8
                if packed == 0xFFFFFFFF:
                    (packed,), wide_at = struct.unpack_from("<Q", listing, wide_at), wide_at + 8
                if header == 0xFFFFFFFF:
                    (header,) = struct.unpack_from("<Q", listing, wide_at)
            x += 4 + m
        members.append(Member(name, method, packed, header))
        at = stop + comment
    return members


def stored_at(file, member: Member) -> int:
    """Where a stored member's bytes start."""
    if member.method != 0:
        raise ValueError(f"{member.name} is not stored")
    local = file.read_at(30, member.header)
    if local[:4] != b"PK\x03\x04":
        raise ValueError(f"no local header of {member.name}")
    n, extra = struct.unpack_from("<HH", local, 26)
    return member.header + 30 + n + extra


class _Source:
    """Range reads of a file in any store that pyarrow knows."""

    def __init__(self, path: str):
        self.fs, self.path = pafs.FileSystem.from_uri(path)

    def __enter__(self):
        self.file = self.fs.open_input_file(self.path)
        self.size = self.file.size()
        return self

    def __exit__(self, *_):
        self.file.close()

    def read_at(self, length: int, offset: int) -> bytes:
        return bytes(self.file.read_at(length, offset))


def with_first(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with refers_to and revisit."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")
    ).withColumn("same", F.sha1("payload"))
    # stored, so that the join reads both sides through exchanges whose hot keys can be split
    several = store(
        rows.groupBy("same").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "payloads"
    )
    joined = rows.join(several, "same", "left")
    revisit = F.coalesce(F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id")), F.lit(False))
    return joined.select("page_id", "url", "payload", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))


def write(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes archives of ``pages`` into ``folder``, one a partition, and returns the stored manifest."""
    spark = pages.sparkSession
    ship_package(spark)
    folder = folder or f"{shared_dir(spark)}/archives-{uuid.uuid4().hex}"

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        store_, base = pafs.FileSystem.from_uri(folder)
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.wacz"
        index, at, archive = [], 0, None
        for part in rows_in_slices(batches):
            if archive is None:
                store_.create_dir(base, recursive=True)
                out = store_.open_output_stream(f"{base}/{name}")
                archive = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True)
                data = archive.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
            for page_id, url, payload, refers_to, revisit in zip(*(c.to_pylist() for c in part.columns), strict=True):
                record = gzip.compress(warc_record(page_id, url, payload, refers_to, revisit), 1, mtime=0)
                data.write(record)
                index.append(json.dumps({"id": page_id, "offset": at, "length": len(record)}))
                at += len(record)
        if archive is None:
            return
        data.close()
        archive.writestr(zipfile.ZipInfo(INDEX), "\n".join(index))
        archive.close()
        out.close()
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([len(index)])], names=["path", "records"])

    # stored, as another run of the tasks would write other files
    return store(with_first(pages).mapInArrow(run, MANIFEST), "manifest")


def locate(archives: DataFrame) -> DataFrame:
    """Ranges of neighbouring records in ``archives`` (path): path, start, and the records' lengths."""
    spark = archives.sparkSession
    ship_package(spark)
    # an explicit number of tasks, as a path says nothing of the bytes behind it
    archives = archives.select("path")
    archives = archives.repartition(-(-max(1, archives.count()) // TASK_ARCHIVES), "path")

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with _Source(path) as file:
                    members = {m.name: m for m in directory(file, file.size)}
                    lines = file.read_at(members[INDEX].size, stored_at(file, members[INDEX])).decode("utf-8").split("\n")
                    base = stored_at(file, members[DATA])
                entries = [json.loads(x) for x in lines if x]
                starts, lengths, size = [], [], 0
                for e in entries:
                    if not starts or len(lengths[-1]) == RANGE_RECORDS or size + e["length"] > RANGE_BYTES:
                        starts.append(base + e["offset"])
                        lengths.append([])
                        size = 0
                    lengths[-1].append(e["length"])
                    size += e["length"]
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(starts)), pa.array(starts, pa.int64()), pa.array(lengths, pa.list_(pa.int64()))], names=["path", "start", "lengths"])

    return archives.select("path").mapInArrow(run, "path string, start long, lengths array<long>")


def read(archives: DataFrame) -> DataFrame:
    """The records of ``archives`` (path), read by ranges, which are dealt out by the bytes behind them."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        names = [c.split()[0] for c in RECORD.split(", ")]
        for batch in batches:
            for path, start, lengths in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with _Source(path) as file:
                    data = file.read_at(sum(lengths), start)
                rows, at = [], 0
                for n in lengths:
                    rows.append(parse_record(gzip.decompress(data[at : at + n])))
                    at += n
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    ranges = store(locate(archives), "ranges")
    size = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b)
    n, total = ranges.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    tasks = max(1, min(n, max(-(-total // TASK_BYTES), archives.sparkSession.sparkContext.defaultParallelism)))
    return ranges.repartition(tasks, "path", "start").mapInArrow(run, RECORD)


def op2(pages: DataFrame) -> DataFrame:
    """Per page, from the archives: page_id, payload_bytes, payload_digest, record_type, refers_to; and
    url."""
    return read(write(pages))
