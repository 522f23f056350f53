"""WARC archives as a PySpark Python data source, and pages written and read by it.

Archives are gzip files of one member a record. Each member states its compressed
and full length in the "sl" extra field of the WARC standard's annex on gzip, so the
reader parses a record's headers from the first bytes of its member and, where the
headers fail a pushed filter or the asked columns need no payload, seeks to the
next member without decompressing the rest. Members without that field (other
writers') are decompressed to their end.

Reading: ``spark.read.format("kpiloom_warc").schema(columns).load(folder)``. The schema
names the columns to decode, out of ``SCHEMA``; payloads are decoded only if asked
for. Files are packed into partitions of ``partition_bytes``. Filters on record_type
and on the header columns (=, in, starts with, is [not] null) are pushed into the scan.

Writing rolls to a new file after ``file_bytes``; a task writes under names of its
own attempt, and only the files of committed tasks get names that the reader lists,
so a lost executor leaves no records behind. Folders may be any URI that
``pyarrow.fs`` opens, and must be shared by all executors.

Null texts are empty payloads; null URLs have no target header; control characters
in a URL are percent-encoded. Rows with the same page_id are records of their own,
and of equal payloads the largest page_id is the response (if all are null, each is one);
a payload of any length is one record, held once in memory; an empty table writes no
file and reads back as no rows; other columns are not written.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition, IsNotNull, IsNull,
    StringStartsWith, WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema

from kpiloom.llm.common import save, shared_dir

FORMAT = "kpiloom_warc"
SCHEMA = ("page_id long, record_type string, target_uri string, refers_to long, "
          "payload_bytes long, payload_digest string, payload binary")
HEADERS = {"record_type": "warc-type", "target_uri": "warc-target-uri"}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
MIN_REVISIT = 1000
_MEMBER = struct.Struct("<4sIBBH2sHII")  # gzip header with an extra field of 12 bytes
_BATCH_BYTES = 4 << 20


def _open(path: str):
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
        pafs.LocalFileSystem(), path)


def member(record: bytes, level: int = 6) -> bytes:
    """A gzip member of one record, with its lengths in the "sl" field."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(record) + z.flush()
    tail = struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    size = _MEMBER.size + len(body) + len(tail)
    if max(size, len(record)) >> 32:  # no room for the lengths: a plain member
        return b"\x1f\x8b\x08\0\0\0\0\0\0\xff" + body + tail
    return _MEMBER.pack(b"\x1f\x8b\x08\x04", 0, 0, 255, 12, b"sl", 8, size, len(record)) + body + tail


def record(page_id, url, payload: bytes, kind: str, refers_to, digest: str | None = None) -> bytes:
    """One WARC record of a page; a revisit holds the HTTP headers without the payload."""
    digest = base64.b32encode(bytes.fromhex(digest) if digest else hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
             f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if url is not None:
        safe = re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        lines.append(f"WARC-Target-URI: {safe}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join([*lines, "", ""]).encode() + block + b"\r\n\r\n"


def _headers(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        out[name.decode().strip().lower()] = value.decode("utf-8", "replace").strip()
    return out


def _number(text: str | None) -> int | None:
    return int(text) if text else None


def read_records(f, wanted, with_payload: bool) -> Iterator[tuple[dict[str, str], int, bytes | None]]:
    """Headers, payload length and payload (or None) of the records of an open file
    whose headers ``wanted`` accepts."""
    while True:
        at = f.tell()
        start = f.read(1 << 12)
        if len(start) < 18:
            return
        size = None
        skip = 10
        if len(start) >= _MEMBER.size and start[3] == 4 and start[12:14] == b"sl":
            size, skip = _MEMBER.unpack_from(start)[7], _MEMBER.size
        elif start[3] & 4:  # another writer's extra field
            skip = 12 + struct.unpack_from("<H", start, 10)[0]
        z = zlib.decompressobj(-15)
        text = z.decompress(start[skip:])
        while b"\r\n\r\n" not in text and not z.eof:
            more = f.read(1 << 14)
            if not more:
                raise ValueError(f"a record at byte {at} ends within its headers")
            text += z.decompress(more)
        head, _, block = text.partition(b"\r\n\r\n")
        headers = _headers(head)
        keep = wanted(headers)
        while not z.eof and (size is None or (keep and (with_payload or b"\r\n\r\n" not in block))):
            more = f.read(1 << 18)
            if not more:
                raise ValueError(f"a record at byte {at} is cut off")
            block += z.decompress(more)
        if keep:
            block = block[:int(headers["content-length"])] if z.eof else block
            http, _, payload = block.partition(b"\r\n\r\n")
            length = _number(_headers(http).get("content-length")) or 0
            whole = payload if with_payload and headers.get("warc-type") == "response" else None
            yield headers, length, whole
        f.seek(at + size if size else f.tell() - len(z.unused_data) + 8)


@dataclass
class Files(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, schema, options):
        self.schema, self.options, self.tests = schema, options, []

    def pushFilters(self, filters):
        """Keeps the filters on headers; the others go back to Spark."""
        for x in filters:
            column = x.attribute[0] if len(x.attribute) == 1 else None
            if column in HEADERS and isinstance(x, (EqualTo, In, StringStartsWith, IsNull, IsNotNull)):
                value = tuple(x.value) if isinstance(x, In) else getattr(x, "value", None)
                self.tests.append((HEADERS[column], type(x).__name__, value))
            else:
                yield x

    def partitions(self):
        fs, root = _open(self.options["path"])
        limit = int(self.options.get("partition_bytes", 128 << 20))
        packs, room = [], 0
        found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        for info in sorted((i for i in found if i.path.endswith(".warc.gz")), key=lambda i: i.path):
            if not packs or room < info.size:
                packs.append([])
                room = limit
            packs[-1].append(info.path)
            room -= info.size
        return [Files(p) for p in packs] or [Files([])]

    def wanted(self, headers: dict[str, str]) -> bool:
        for name, kind, value in self.tests:
            own = headers.get(name)
            if kind == "IsNull" or own is None:
                good = kind == "IsNull" and own is None
            else:
                good = {"EqualTo": lambda: own == value, "In": lambda: own in value,
                        "StringStartsWith": lambda: own.startswith(value), "IsNotNull": lambda: True}[kind]()
            if not good:
                return False
        return True

    def read(self, partition):
        fs, _ = _open(self.options["path"])
        names = [f.name for f in self.schema.fields]
        schema = to_arrow_schema(self.schema)
        make = {
            "page_id": lambda h, n, p: _number(h.get("x-page-id")),
            "record_type": lambda h, n, p: h.get("warc-type"),
            "target_uri": lambda h, n, p: h.get("warc-target-uri"),
            "refers_to": lambda h, n, p: _number(h.get("x-refers-to-page-id")),
            "payload_bytes": lambda h, n, p: n,
            "payload_digest": lambda h, n, p: base64.b32decode(h["warc-payload-digest"].split(":")[1]).hex(),
            "payload": lambda h, n, p: p,
        }
        rows, held = [], 0
        for path in partition.paths:
            with fs.open_input_file(path) as raw:
                f = io.BufferedReader(raw, 1 << 16)
                for headers, n, payload in read_records(f, self.wanted, "payload" in names):
                    rows.append([make[c](headers, n, payload) for c in names])
                    held += 200 + len(payload or b"")
                    if held > _BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


@dataclass
class Written(WriterCommitMessage):
    paths: list[str]


class WarcWriter(DataSourceWriter):
    """Rows of page_id, url, payload, record_type and refers_to."""

    def __init__(self, options):
        self.options = options

    def write(self, iterator):
        fs, root = _open(self.options["path"])
        limit, level = int(self.options.get("file_bytes", 64 << 20)), int(self.options.get("level", 6))
        fs.create_dir(root, recursive=True)
        paths, out = [], None
        for row in iterator:
            if out is None:
                paths.append(f"{root}/{uuid.uuid4().hex}.open")
                out = fs.open_output_stream(paths[-1])
            out.write(member(record(row.page_id, row.url, bytes(row.payload), row.record_type, row.refers_to), level))
            if out.tell() >= limit:
                out.close()
                out = None
        if out is not None:
            out.close()
        return Written(paths)

    def commit(self, messages):
        fs, _ = _open(self.options["path"])
        for path in (p for m in messages if m for p in m.paths):
            fs.move(path, path.removesuffix(".open") + ".warc.gz")

    def abort(self, messages):
        fs, _ = _open(self.options["path"])
        for path in (p for m in messages if m for p in m.paths):
            fs.delete_file(path)


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(schema, self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


def read(spark: SparkSession, path: str, columns: str = SCHEMA) -> DataFrame:
    """The records under ``path``; ``columns`` is the part of SCHEMA to decode."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format(FORMAT).schema(columns).load(path)


def with_types(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, record_type and refers_to of every page. Of equal
    payloads of at least MIN_REVISIT bytes the largest page_id is the response; the
    table joined for that has one row per repeated payload."""
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    # small payloads have no twin to look for: keys that spread them and meet nothing
    large = F.octet_length("payload") >= MIN_REVISIT
    rows = rows.withColumn("same", F.when(large, F.sha2("payload", 256)).otherwise(
        F.concat(F.lit("small-"), F.pmod(F.xxhash64("page_id", "url"), F.lit(4096)).cast("string"))))
    first = save(rows.filter(large).groupBy("same").agg(
        F.max("page_id").alias("keeper"), F.count("*").alias("n")).filter("n > 1").drop("n"), "warc-repeats")
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return rows.join(first, "same", "left").select(
        "page_id", "url", "payload", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("keeper")).alias("refers_to"))


def write(pages: DataFrame, path: str) -> None:
    """One record per page, appended to the archives under ``path``."""
    pages.sparkSession.dataSource.register(WarcSource)
    with_types(pages).write.format(FORMAT).mode("append").save(path)


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages written to archives in the shared folder and read back: digests and
    lengths of responses are taken from the payloads read, of revisits (which have
    none) from their headers alone."""
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write(pages, path)
    full = (read(spark, path, "page_id long, record_type string, payload binary").filter("record_type = 'response'")
            .select("page_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
                    F.sha1("payload").alias("payload_digest"), "record_type",
                    F.lit(None).cast("long").alias("refers_to")))
    again = (read(spark, path, "page_id long, record_type string, refers_to long, payload_bytes long, "
                               "payload_digest string").filter("record_type = 'revisit'")
             .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    return full.unionByName(again)
