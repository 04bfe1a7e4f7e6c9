"""WARC archives as a PySpark Python data source.

Writing: each task writes gzip archives, one gzip member per record, rolled at
``fileBytes``; the driver commits a list of the files, so files of lost or
repeated tasks are never read.  A member's extra field holds its compressed
length, so a reader can step over it.

Reading: the driver lists the committed files and packs them into partitions
by size.  Of each record only the headers are inflated; record types and
header predicates (pushed down from filters on ``record_type``, ``record_id``,
``target_uri`` and ``payload_digest``, or given as options) are tested there,
and the payload is decoded only for records that pass, and only if
``payload`` is wanted.  Archives without the extra field are read too; there,
unwanted payloads are inflated to find the next record but not decoded.

Payload records of equal digest are stored once: the one with the smallest
page id is the ``response``, others ``revisit`` it and name it.

Defined cases: control characters in header values are percent-encoded;
a null payload is empty; a null url leaves the target header
out; equal payloads shorter than ``min_bytes`` are all responses; repeated rows
are records of their own (those with the smallest id all responses); an empty
table gives no archive.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, WriterCommitMessage)

from panelforge.llm.common import BROADCAST_IDS
from panelforge.operators.common import materialize, maybe_broadcast

FIELD = b"PL"
_CONTROL = re.compile("[\\x00-\\x1F\\x7F]")
COMMITTED = "_committed.json"
SCHEMA = "record_type string, record_id string, target_uri string, payload_digest string, refers_to string, content_length long, headers map<string,string>, payload binary, file string, offset long"
#: Columns whose filters are tested on the headers, before the payload.
HEADERS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI (any that Arrow knows), and the path in it."""
    if "://" not in path and path.startswith("file:"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def digest_text(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header_text(value: str) -> str:
    """A value that stays one header: control characters are percent-encoded."""
    return _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", value)


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member that knows its own length."""
    head = "WARC/1.1\r\n" + "".join(f"{header_text(k)}: {header_text(v)}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    data = head.encode() + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    extra_size = 4 + 8
    total = 10 + 2 + extra_size + len(body) + 8
    extra = FIELD + struct.pack("<HQ", 8, total)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", extra_size) + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


class Committed(WriterCommitMessage):
    def __init__(self, files: list[str]):
        self.files = files


class WarcWriter(DataSourceArrowWriter):
    """Rows (record_type, record_id, target_uri, payload_digest, refers_to, headers, payload) to archives."""

    def __init__(self, options: dict):
        self.path, self.roll = options["path"], int(options.get("filebytes", 256 << 20))

    def write(self, batches: Iterator[pa.RecordBatch]) -> Committed:
        fs, folder = open_folder(self.path)
        fs.create_dir(folder, recursive=True)
        files, out = [], None
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    if out is None or out.tell() >= self.roll:
                        if out is not None:
                            out.close()
                        files.append(f"records-{uuid.uuid4().hex}.warc.gz")
                        out = fs.open_output_stream(f"{folder}/{files[-1]}", compression=None)
                    headers = [(HEADERS[c], row[c]) for c in HEADERS if row[c] is not None] + [(k, v) for k, v in row["headers"] or [] if v is not None]
                    out.write(member(headers, row["payload"] or b""))
        finally:
            if out is not None:
                out.close()
        return Committed(files)

    def commit(self, messages) -> None:
        fs, folder = open_folder(self.path)
        fs.create_dir(folder, recursive=True)
        files = sorted(f for m in messages if m is not None for f in m.files)
        with fs.open_output_stream(f"{folder}/{COMMITTED}", compression=None) as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages) -> None:
        pass  # files without a commit are never read


class Files(InputPartition):
    def __init__(self, files: list[str]):
        super().__init__(files)
        self.files = files


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() != "false"
        self.split = int(options.get("splitbytes", 128 << 20))
        self.tests: list[tuple[str, frozenset[str]]] = []
        if options.get("types"):
            self.tests.append(("record_type", frozenset(options["types"].split(","))))

    def pushFilters(self, filters):
        """Keep equality and IN on header columns to ourselves, hand the rest back."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in HEADERS and isinstance(f, EqualTo) and isinstance(f.value, str):
                self.tests.append((name, frozenset([f.value])))
            elif name in HEADERS and isinstance(f, In) and all(isinstance(v, str) for v in f.value):
                self.tests.append((name, frozenset(f.value)))
            elif not (name in HEADERS and isinstance(f, IsNotNull) and name in ("record_type", "record_id")):
                yield f

    def partitions(self):
        fs, folder = open_folder(self.path)
        if fs.get_file_info(f"{folder}/{COMMITTED}").type == pafs.FileType.File:
            with fs.open_input_stream(f"{folder}/{COMMITTED}", compression=None) as f:
                names = [f"{folder}/{n}" for n in json.loads(f.read())]
            found = fs.get_file_info(names)
        else:
            found = [i for i in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)) if i.path.endswith(".warc.gz")]
        out, size = [], 0
        for info in sorted(found, key=lambda i: -i.size):
            if not out or size + info.size > self.split:
                out.append([])
                size = 0
            out[-1].append(info.path)
            size += info.size
        return [Files(f) for f in out] or [Files([])]

    def read(self, partition):
        fs, _ = open_folder(self.path)
        for file in partition.files:
            with fs.open_input_file(file) as f:
                for offset, headers, payload in records(f, self._wanted, self.payload):
                    yield self._row(file, offset, headers, payload)

    def _wanted(self, headers: dict[str, str]) -> bool:
        return all(headers.get(HEADERS[c].lower()) in values for c, values in self.tests)

    def _row(self, file: str, offset: int, headers: dict[str, str], payload: bytes | None) -> tuple:
        own = [headers.get(h.lower()) for h in HEADERS.values()]
        return (*own, int(headers.get("content-length", 0)), headers, payload, file, offset)


def records(f, wanted, want_payload: bool) -> Iterator[tuple[int, dict[str, str], bytes | None]]:
    """(offset, headers, payload) of the wanted records of an open archive."""
    size, offset = f.size(), 0
    while offset < size:
        f.seek(offset)
        chunk = f.read(1 << 14)
        if chunk[:2] != b"\x1f\x8b":
            raise ValueError(f"no gzip member at {offset}")
        length = _own_length(chunk)
        inflate = zlib.decompressobj(31)
        data = inflate.decompress(chunk)
        at = offset + len(chunk)
        while b"\r\n\r\n" not in data and not inflate.eof:
            f.seek(at)
            chunk = f.read(1 << 16)
            if not chunk:
                raise ValueError(f"record at {offset} is cut off")
            at += len(chunk)
            data += inflate.decompress(chunk)
        head, _, body = data.partition(b"\r\n\r\n")
        headers = parse_headers(head)
        keep = wanted(headers)
        payload = None
        if keep and want_payload or length is None:
            parts = [body]
            while not inflate.eof:
                f.seek(at)
                chunk = f.read(1 << 18)
                if not chunk:
                    raise ValueError(f"record at {offset} is cut off")
                at += len(chunk)
                more = inflate.decompress(chunk)
                if keep and want_payload:
                    parts.append(more)
            if keep and want_payload:
                payload = b"".join(parts)[: int(headers.get("content-length", 0))]
            if length is None:
                length = at - len(inflate.unused_data) - offset
        if keep:
            yield offset, headers, payload
        offset += length


def _own_length(chunk: bytes) -> int | None:
    """The member's length, if its extra field tells."""
    if not chunk[3] & 4:
        return None
    (extra,) = struct.unpack_from("<H", chunk, 10)
    at = 12
    while at + 4 <= 12 + extra:
        name, n = chunk[at: at + 2], struct.unpack_from("<H", chunk, at + 2)[0]
        if name == FIELD and n == 8:
            return struct.unpack_from("<Q", chunk, at + 4)[0]
        at += 4 + n
    return None


def parse_headers(head: bytes) -> dict[str, str]:
    """Header names in lower case; folded lines are joined."""
    out: dict[str, str] = {}
    last = None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            last, _, value = line.partition(":")
            last = last.strip().lower()
            out[last] = value.strip()
    return out


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)`` / ``df.write.format("warc").save(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader({k.lower(): v for k, v in self.options.items()})

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter({k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def page_records(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One record per page, ready to be written.  Only digests and ids are
    compared; a payload is shuffled at most once, and not at all where no
    digest repeats or the repeated ones are few enough to broadcast."""
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"sha": F.unhex(F.sha1("payload")), "bytes": F.octet_length("payload").cast("long")})
    first = rows.where(F.col("bytes") >= min_bytes).select("sha", "id").groupBy("sha").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").select("sha", "first")
    found = rows.join(maybe_broadcast(materialize(first), BROADCAST_IDS), "sha", "left")
    again = F.col("first").isNotNull() & F.coalesce(F.col("id") != F.col("first"), F.lit(False)) & (F.col("bytes") >= min_bytes)
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    return found.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"), urn(F.col("id")).alias("record_id"), F.col("url").alias("target_uri"),
        F.col("sha"), F.when(again, urn(F.col("first"))).alias("refers_to"), F.col("bytes"), F.when(~again, F.col("payload")).alias("payload"))


def write_pages(pages: DataFrame, path: str, **options) -> None:
    """Write the pages' archives to a folder that executors and driver share."""
    register(pages.sparkSession)
    records_ = page_records(pages, **options)

    def finish(batches):
        for batch in batches:
            digest = ["sha1:" + base64.b32encode(v.as_py()).decode() for v in batch.column("sha")]
            headers = [[("X-Payload-Length", str(n.as_py())), ("Content-Type", "text/html; charset=utf-8")] + [("WARC-Profile", REVISIT_PROFILE)] * (t.as_py() == "revisit")
                       for n, t in zip(batch.column("bytes"), batch.column("record_type"))]
            yield pa.RecordBatch.from_arrays([batch.column("record_type"), batch.column("record_id"), batch.column("target_uri"), pa.array(digest), batch.column("refers_to"),
                                              pa.array(headers, pa.map_(pa.string(), pa.string())), batch.column("payload")],
                                             names=["record_type", "record_id", "target_uri", "payload_digest", "refers_to", "headers", "payload"])

    out = records_.mapInArrow(finish, "record_type string, record_id string, target_uri string, payload_digest string, refers_to string, headers map<string,string>, payload binary")
    out.write.format("warc").mode("append").save(path)


def read(spark: SparkSession, path: str, types: str | None = None, payload: bool = True) -> DataFrame:
    register(spark)
    reader = spark.read.format("warc").option("payload", str(payload).lower())
    return (reader.option("types", types) if types else reader).load(path)


def page_digests(archive: DataFrame) -> DataFrame:
    """One row per page record: responses from the payload itself, revisits from their headers."""
    number = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1).cast("long")

    def run(batches):
        for batch in batches:
            payload = [v.as_py() for v in batch.column("payload")]
            size = [int(n.as_py()) if t.as_py() == "revisit" else len(p) for p, t, n in zip(payload, batch.column("record_type"), batch.column("stated"))]
            digest = [d.as_py().removeprefix("sha1:") if t.as_py() == "revisit" else digest_text(p) for p, t, d in zip(payload, batch.column("record_type"), batch.column("payload_digest"))]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array(size, pa.int64()), pa.array(digest, pa.string()), batch.column("record_type"), batch.column("refers_to")],
                                             names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    rows = archive.select(number(F.col("record_id")).alias("page_id"), "payload", F.element_at("headers", F.lit("x-payload-length")).alias("stated"), "payload_digest", "record_type",
                          number(F.col("refers_to")).alias("refers_to"))
    return rows.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
