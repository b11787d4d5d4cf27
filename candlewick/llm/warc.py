"""WARC archives as a Spark data source: parallel reads with pushed filters, committed writes.

Records are gzip members of their own. A member's extra field ``sl`` holds its compressed length, so
a reader inflates only the headers, asks the pushed filters, and jumps over what nobody wants.
Plain files and members without that field are read as well, the latter by inflating them.
"""

from __future__ import annotations

import json
import struct
import sys
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringStartsWith,
    WriterCommitMessage,
)

from candlewick.llm.common import Scratch, prepare

#: Header names by column, and what a revisit without payload declares.
COLUMNS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "content_type": "Content-Type",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADERS = ", ".join(f"{name} string" for name in COLUMNS) + ", payload_length long"

PARTITION_BYTES = 64 << 20
FILE_BYTES = 256 << 20
BATCH_BYTES, BATCH_RECORDS = 4 << 20, 256
CHUNK = 16 << 10


def _open(path: str):
    return fs.FileSystem.from_uri(path)


def _clean(value: str) -> str:
    """A header value on one line: control characters and blanks in percent form."""
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in value)


def _record(row: dict) -> bytes:
    payload = row["payload"] or b""
    revisit = row["refers_to"] is not None
    length = row["payload_length"] if row["payload_length"] is not None else len(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}"]
    for name, header in COLUMNS.items():
        if name not in ("record_type", "content_type") and row.get(name) is not None:
            lines.append(f"{header}: {_clean(row[name])}")
    if revisit:
        lines.append(f"WARC-Profile: {PROFILE}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(body: bytes) -> bytes:
    """One gzip member that knows its own length."""
    squeeze = zlib.compressobj(1, zlib.DEFLATED, -15)
    packed = squeeze.compress(body) + squeeze.flush()
    size = 10 + 2 + 12 + len(packed) + 8
    known = (size, len(body)) if max(size, len(body)) < 1 << 32 else (0, 0)
    extra = b"sl" + struct.pack("<HII", 8, *known)
    head = b"\x1f\x8b\x08\x04" + struct.pack("<IBBH", 0, 0, 255, len(extra)) + extra
    return head + packed + struct.pack("<II", zlib.crc32(body), len(body) & 0xFFFFFFFF)


def _headers(raw: bytes) -> dict[str, str]:
    found: dict[str, str] = {}
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            found.setdefault(name.strip().lower(), value.strip())
    return found


class _Gzip:
    """Bytes of one gzip member, inflated as far as they are asked for."""

    def __init__(self, file, at: int):
        self.file, self.at = file, at
        file.seek(at)
        head = file.read(CHUNK)
        if head[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at {at}")
        self.length = 0
        if head[3] & 4:
            extra, left = head[12 : 12 + struct.unpack("<H", head[10:12])[0]], 0
            while left + 4 <= len(extra):
                kind, size = extra[left : left + 2], struct.unpack("<H", extra[left + 2 : left + 4])[0]
                if kind == b"sl" and size == 8:
                    self.length = struct.unpack("<I", extra[left + 4 : left + 8])[0]
                left += 4 + size
        self.inflate, self.waiting, self.taken = zlib.decompressobj(31), head, len(head)
        self.body = b""

    def more(self, limit: int) -> bool:
        """Inflate up to ``limit`` further bytes; false at the end of the member."""
        if self.inflate.eof:
            return False
        if not self.waiting:
            self.waiting = self.file.read(CHUNK)
            self.taken += len(self.waiting)
            if not self.waiting:
                raise ValueError(f"cut off member at {self.at}")
        self.body += self.inflate.decompress(self.waiting, limit)
        self.waiting = self.inflate.unconsumed_tail
        return True

    def until(self, mark: bytes, start: int = 0) -> int:
        """Position behind the mark, inflating no more than needed."""
        while (found := self.body.find(mark, start)) < 0:
            if not self.more(2048):
                return len(self.body)
        return found + len(mark)

    def rest(self, size: int) -> None:
        """Inflate up to ``size`` bytes in all; what is there is joined once."""
        parts, have = [self.body], len(self.body)
        while have < size:
            self.body = b""
            if not self.more(size - have):
                break
            parts.append(self.body)
            have += len(self.body)
        self.body = b"".join(parts)

    def end(self) -> int:
        """Where the next member begins."""
        if self.length:
            return self.at + self.length
        while self.more(1 << 20):
            self.body = b""
        return self.at + self.taken - len(self.inflate.unused_data)


class _Plain(_Gzip):
    """The same for an uncompressed record; ``limit`` bytes are read, not inflated."""

    def __init__(self, file, at: int):
        self.file, self.at, self.body = file, at, b""
        file.seek(at)

    def more(self, limit: int) -> bool:
        part = self.file.read(limit)
        self.body += part
        return bool(part)


def _keeps(filters: list[tuple], row: dict) -> bool:
    for kind, name, value in filters:
        have = row[name]
        if kind == "in" and (have is None or have not in value):
            return False
        if kind == "starts" and (have is None or not have.startswith(value)):
            return False
        if kind == "null" and (have is None) != value:
            return False
    return True


def read_records(path: str, filters: list[tuple], payload: bool) -> Iterator[dict]:
    """Records of one archive that pass the filters; payloads only if they are wanted."""
    store, inner = _open(path)
    with store.open_input_file(inner) as file:
        size, at, packed = file.size(), 0, path.endswith(".gz")
        while at < size:
            member = _Gzip(file, at) if packed else _Plain(file, at)
            start = member.until(b"\r\n\r\n")
            head = _headers(member.body[:start])
            row = {name: head.get(header.lower()) for name, header in COLUMNS.items()}
            length = int(head.get("content-length", 0))
            if _keeps(filters, row):
                body, row["payload_length"], whole = start, length, start + length
                if (row["content_type"] or "").startswith("application/http"):
                    member.rest(min(whole, start + 2048))
                    body = member.until(b"\r\n\r\n", start)
                    row["payload_length"] = int(_headers(member.body[start:body]).get("content-length", whole - body))
                if payload:
                    member.rest(whole)
                    row["payload"] = None if row["record_type"] == "revisit" else member.body[body:whole]
                yield row
            at = member.end() if packed else at + start + length + 4


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload, self.filters = path, payload, []

    def pushFilters(self, filters):
        """Header predicates are answered before a payload is touched; the rest goes back to Spark."""
        for f in filters:
            attribute = getattr(f, "attribute", ())
            name = attribute[0] if len(attribute) == 1 and attribute[0] in COLUMNS else None
            if name and isinstance(f, EqualTo):
                self.filters.append(("in", name, {f.value}))
            elif name and isinstance(f, In):
                self.filters.append(("in", name, set(f.value)))
            elif name and isinstance(f, StringStartsWith):
                self.filters.append(("starts", name, f.value))
            elif name and isinstance(f, IsNull | IsNotNull):
                self.filters.append(("null", name, isinstance(f, IsNull)))
            else:
                yield f

    def partitions(self):
        """Committed archives (or all, where nothing was committed) in groups of bounded size."""
        store, inner = _open(self.path)
        scheme = self.path[: len(self.path) - len(inner)] if self.path.endswith(inner) else ""
        found = [x for x in store.get_file_info(fs.FileSelector(inner, recursive=True)) if x.is_file]
        names = set()
        for x in (x for x in found if x.base_name.startswith("_committed-")):
            with store.open_input_stream(x.path) as file:
                names.update(json.loads(file.read()))
        files = sorted((x.path, x.size) for x in found if x.path.endswith((".warc", ".warc.gz")) and (not names or x.base_name in names))
        groups, held = [], PARTITION_BYTES
        for path, size in files:
            if held + size > PARTITION_BYTES:
                groups.append([])
                held = 0
            groups[-1].append(scheme + path)
            held += size
        return [InputPartition(group) for group in groups]

    def read(self, partition):
        names = [*COLUMNS, "payload_length", *(["payload"] if self.payload else [])]
        kinds = {"payload_length": pa.int64(), "payload": pa.binary()}
        schema = pa.schema([(name, kinds.get(name, pa.string())) for name in names])
        rows, size = [], 0
        for path in partition.value if partition else []:
            for row in read_records(path, self.filters, self.payload):
                rows.append(row)
                size += len(row.get("payload") or b"")
                if len(rows) >= BATCH_RECORDS or size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class Written(WriterCommitMessage):
    def __init__(self, files: list[str]):
        self.files = files


class WarcWriter(DataSourceArrowWriter):
    """Each task writes files under names of its own; the commit lists those that count.

    A task that is lost and run again leaves files that no list names, and readers pass over them.
    """

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator):
        store, inner = _open(self.path)
        store.create_dir(inner, recursive=True)
        files, out = [], None
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out = store.open_output_stream(f"{inner}/{files[-1]}", compression=None)
                out.write(_member(_record(row)))
                if out.tell() >= FILE_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages):
        store, inner = _open(self.path)
        store.create_dir(inner, recursive=True)
        with store.open_output_stream(f"{inner}/_committed-{uuid.uuid4().hex}.json", compression=None) as out:
            out.write(json.dumps([name for m in messages if m is not None for name in m.files]).encode())

    def abort(self, messages):
        store, inner = _open(self.path)
        for name in [name for m in messages if m is not None for name in m.files]:
            store.delete_file(f"{inner}/{name}")


class WarcSource(DataSource):
    """``format("warc")``: header columns, and the payload unless ``option("payload", "false")``."""

    @classmethod
    def name(cls):
        return "warc"

    def _payload(self) -> bool:
        return str(self.options.get("payload", "true")).lower() == "true"

    def schema(self):
        return HEADERS + (", payload binary" if self._payload() else "")

    def reader(self, schema):
        return WarcReader(self.options["path"].rstrip("/"), self._payload())

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("archives are appended to")
        return WarcWriter(self.options["path"].rstrip("/"))


def register(spark: SparkSession) -> None:
    prepare(spark)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of all archives in a folder; filter on header columns to skip payloads."""
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def page_records(pages: DataFrame, scratch: Scratch, least_bytes: int = 100) -> DataFrame:
    """Archive records of pages: the first page of equal payloads is a response, others revisit it.

    Payloads of fewer than ``least_bytes`` are always responses. A null html is an empty payload, a
    null url has no target header. Of pages with one id and one payload all are responses if that
    id is the smallest; a page without id is a response with a random record id.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    base = pages.select("page_id", "url", payload.alias("payload")).withColumns({"payload_length": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    first = base.where(F.col("payload_length") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    first = scratch.keep(first.where("copies > 1").select(F.col("digest").alias("shared"), "first"), "copies")
    joined = base.join(first, F.col("digest") == F.col("shared"), "left")
    again = F.col("first") < F.col("page_id")
    name = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    return joined.select(
        F.coalesce(name(F.col("page_id")), F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.when(again, name(F.col("first"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        "payload_length",
        F.when(again, F.lit(None)).otherwise(F.col("payload")).alias("payload"),
    )


def write(records: DataFrame, path: str) -> None:
    """Append records to the archives of a folder; empty tables write an empty commit."""
    register(records.sparkSession)
    records.write.format("warc").mode("append").save(path)
