"""WARC archives as a Spark data source, in Python: format("warc") to read and to write.

Written files are gzip members, one a record, each with its compressed and uncompressed length in the header's "sl" field, so a
reader steps over a record without decompressing it and a large file is split into ranges that start at a member. Files
from elsewhere are read too: .warc.gz without these lengths as one partition each, plain .warc likewise, stepping over payloads.

Options of the reader: payload (true or false: whether payloads are decoded), verify (true: a response's payload is decoded
and must have the digest of its header), splitBytes. Filters on record_type, record_id, target_uri, payload_digest and
refers_to are pushed down: they are settled on a record's headers, before the rest of it is decompressed.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage

SCHEMA = "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_length long, headers map<string, string>, payload binary"
_ARROW = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_length", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])
FILE_BYTES, SPLIT_BYTES = 256 << 20, 64 << 20
_BLOCK = 1 << 20
# fixed values: a gzip header with an extra field of 12 bytes named "sl", from RFC 1952 and Annex D of the WARC standard
_MEMBER = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff\x0c\x00sl\x08\x00"
_HEAD = len(_MEMBER) + 8
_END = b"\r\n\r\n"
_DATE = "1970-01-01T00:00:00Z"


def member(data: bytes) -> bytes:
    """A gzip member that tells its own length. No member's start stands within its body, as one would where an archive is stored in an
    archive: such data is coded with fixed codes, whose bytes aren't those of the data."""
    for strategy in (zlib.Z_DEFAULT_STRATEGY, zlib.Z_FIXED):
        squeeze = zlib.compressobj(6, zlib.DEFLATED, -15, strategy=strategy)
        body = squeeze.compress(data) + squeeze.flush()
        if _MEMBER not in body:
            break
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    return _MEMBER + struct.pack("<II", _HEAD + len(body) + 8, len(data) & 0xFFFFFFFF) + body + tail


def record(row: dict) -> bytes:
    """One record: a response with its payload behind an HTTP header, or a revisit with the header alone."""
    payload = row["payload"] or b""
    response = row["record_type"] == "response"
    length = len(payload) if response else row["payload_length"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {row['record_id']}", f"WARC-Date: {_DATE}"]
    if row["target_uri"] is not None:
        lines.append("WARC-Target-URI: " + " ".join(row["target_uri"].split("\r")).replace("\n", " "))
    if not response:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {row['refers_to']}"]
    lines += [f"WARC-Payload-Digest: sha1:{row['payload_digest']}", f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(http) + (len(payload) if response else 0)}"]
    return "\r\n".join(lines).encode() + _END + http + (payload if response else b"") + _END


class Archive:
    """Bytes of a file by place, read in blocks."""

    def __init__(self, path: str):
        files, inner = pyarrow.fs.FileSystem.from_uri(path)
        self.file = files.open_input_file(inner)
        self.size = self.file.size()
        self.at, self.block = 0, b""

    def get(self, at: int, n: int) -> bytes:
        if at < self.at or at + n > self.at + len(self.block):
            self.at, self.block = at, self.file.read_at(min(max(n, _BLOCK), max(0, self.size - at)), at)
        return self.block[at - self.at : at - self.at + n]

    def leads_on(self, at: int) -> bool:
        """Whether the member that seems to begin here ends where another one begins, or the file ends."""
        after = at + struct.unpack("<I", self.get(at + len(_MEMBER), 4).ljust(4, b"\0"))[0]
        return after == self.size or at < after < self.size and self.get(after, len(_MEMBER)) == _MEMBER

    def next_member(self, at: int, end: int) -> int:
        """Where the first member with a length begins at or after at; end if there is none before it."""
        while at < end:
            found = self.get(at, min(_BLOCK, self.size - at)).find(_MEMBER)
            if found >= 0 and self.leads_on(at + found):
                return min(at + found, end)
            at += found + 1 if found >= 0 else max(1, min(_BLOCK, self.size - at) - len(_MEMBER))
        return end


class _Inflated:
    """What a record's text is read from: it decompresses no further than asked."""

    def __init__(self, pull):
        self.pull, self.text = pull, b""

    def upto(self, mark: bytes, start: int) -> int:
        """The place after mark, or the end."""
        while (found := self.text.find(mark, start)) < 0:
            if not (more := self.pull(512 if len(self.text) < 4096 else _BLOCK)):
                return len(self.text)
            self.text += more
        return found + len(mark)

    def span(self, start: int, n: int) -> bytes:
        parts = [self.text]
        have = len(self.text)
        while have < start + n and (more := self.pull(_BLOCK)):
            parts.append(more)
            have += len(more)
        self.text = b"".join(parts)
        return self.text[start : start + n]


def _header(text: bytes) -> dict[str, str]:
    rows = [x.partition(":") for x in text.decode("utf-8", "replace").split("\r\n")[1:] if ":" in x]
    return {k.strip().lower(): v.strip() for k, _, v in rows}


@dataclass
class Wants:
    payload: bool = True
    verify: bool = False
    exact: dict[str, set] = field(default_factory=dict)
    starts: dict[str, str] = field(default_factory=dict)

    def take(self, source: _Inflated) -> tuple | None:
        """The record as a row, or None if its headers rule it out; then nothing after them is decompressed."""
        after = source.upto(_END, 0)
        headers = _header(source.text[:after])
        digest = headers.get("warc-payload-digest")
        row = {"record_id": headers.get("warc-record-id"), "record_type": headers.get("warc-type"), "target_uri": headers.get("warc-target-uri"), "refers_to": headers.get("warc-refers-to"), "payload_digest": digest and digest.rpartition(":")[2]}
        if any(row[k] not in v for k, v in self.exact.items()) or any(not (row[k] or "").startswith(v) for k, v in self.starts.items()):
            return None
        length = int(headers.get("content-length", 0))
        start, size = after, length
        if headers.get("content-type", "").startswith("application/http"):
            start = min(source.upto(_END, after), after + length)
            size = after + length - start
            if row["record_type"] == "revisit":
                size = int(_header(source.text[after:start]).get("content-length", 0))
        payload = None
        if row["record_type"] != "revisit" and (self.payload or self.verify):
            payload = source.span(start, size)
            if len(payload) != size:
                raise ValueError(f"{row['record_id']}: the record ends after {len(payload)} of {size} bytes")
            if self.verify and row["payload_digest"] != base64.b32encode(hashlib.sha1(payload).digest()).decode():
                raise ValueError(f"{row['record_id']}: the payload hasn't the digest of its header")
        return *row.values(), size, list(headers.items()), payload if self.payload else None


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int
    kind: str

    def __init__(self, path: str, start: int, end: int, kind: str):
        super().__init__(None)
        self.path, self.start, self.end, self.kind = path, start, end, kind


def rows_of(part: Range, wants: Wants) -> Iterator[tuple]:
    archive = Archive(part.path)
    if part.kind == "members":
        at = archive.next_member(part.start, part.end)
        while at < part.end:
            size = struct.unpack("<I", archive.get(at + len(_MEMBER), 4))[0]
            unzip = zlib.decompressobj(-15)
            left = [at + _HEAD, at + size - 8]

            def pull(n: int, unzip=unzip, left=left) -> bytes:
                while not unzip.eof:
                    held = unzip.unconsumed_tail
                    if not held:
                        held = archive.get(left[0], min(n, left[1] - left[0]))
                        left[0] += len(held)
                    if (more := unzip.decompress(held, 4 * n)) or not (held or unzip.unconsumed_tail):
                        return more
                return b""

            if (row := wants.take(_Inflated(pull))) is not None:
                yield row
            at += size
    elif part.kind == "gzip":
        at, held = 0, b""
        while held or at < archive.size:
            unzip = zlib.decompressobj(31)

            def pull(n: int, unzip=unzip) -> bytes:
                nonlocal at, held
                while not unzip.eof:
                    if not held:
                        held = archive.get(at, min(_BLOCK, archive.size - at))
                        at += len(held)
                        if not held:
                            return b""
                    more = unzip.decompress(held, max(n, 4096))
                    held = unzip.unused_data if unzip.eof else unzip.unconsumed_tail
                    if more:
                        return more
                return b""

            row = wants.take(_Inflated(pull))
            while pull(_BLOCK):  # the member's rest: without its length it has to be gone through
                pass
            if row is not None:
                yield row
    else:
        at = 0
        while at < archive.size:
            place = [at]

            def pull(n: int, place=place) -> bytes:
                more = archive.get(place[0], min(n, archive.size - place[0]))
                place[0] += len(more)
                return more

            source = _Inflated(pull)
            after = source.upto(_END, 0)
            length = int(_header(source.text[:after]).get("content-length", 0))
            if not source.text.strip():
                break
            if (row := wants.take(source)) is not None:
                yield row
            at += after + length + len(_END)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.split = int(options.get("splitBytes", SPLIT_BYTES))
        self.wants = Wants(options.get("payload", "true").lower() == "true", options.get("verify", "false").lower() == "true")

    def pushFilters(self, filters: list[Filter]):
        names = set(_ARROW.names[:5])
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in names and isinstance(f, (EqualTo, EqualNullSafe, In)):
                values = set(f.value) if isinstance(f, In) else {f.value}
                if isinstance(f, EqualNullSafe) or None not in values:
                    self.wants.exact[name] = self.wants.exact.get(name, values) & values
                    continue
            if name in names and isinstance(f, StringStartsWith) and name not in self.wants.starts:
                self.wants.starts[name] = f.value
                continue
            yield f

    def partitions(self) -> list[InputPartition]:
        files, inner = pyarrow.fs.FileSystem.from_uri(self.path)
        info = files.get_file_info(inner)
        found = [info] if info.is_file else files.get_file_info(pyarrow.fs.FileSelector(inner, recursive=False))
        head = self.path.removesuffix(inner)
        parts = []
        for f in sorted((f for f in found if f.is_file and f.size and f.base_name[0] not in "._"), key=lambda f: f.path):
            path = head + f.path
            if not f.path.endswith(".gz"):
                parts.append(Range(path, 0, f.size, "plain"))
            elif Archive(path).get(0, len(_MEMBER)) != _MEMBER:
                parts.append(Range(path, 0, f.size, "gzip"))
            else:
                parts += [Range(path, at, min(at + self.split, f.size), "members") for at in range(0, f.size, self.split)]
        return parts or [Range("", 0, 0, "none")]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for row in rows_of(partition, self.wants) if partition.kind != "none" else ():
            rows.append(row)
            size += len(row[-1] or b"")
            if len(rows) == 1000 or size > _BLOCK * 8:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Tasks write under a folder of the job; the driver moves what committed tasks wrote, so retries leave no trace."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite, self.job = options["path"].rstrip("/"), overwrite, f"_job-{uuid.uuid4().hex}"
        self.file_bytes = int(options.get("fileBytes", FILE_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, inner = pyarrow.fs.FileSystem.from_uri(self.path)
        files.create_dir(f"{inner}/{self.job}", recursive=True)
        names, out = [], None
        for batch in iterator:
            for at in range(0, batch.num_rows, 200):
                for row in batch.slice(at, 200).to_pylist():
                    if out is None or out.tell() >= self.file_bytes:
                        if out is not None:
                            out.close()
                        names.append(f"{uuid.uuid4().hex}.warc.gz")
                        out = files.open_output_stream(f"{inner}/{self.job}/{names[-1]}", compression=None)
                    out.write(member(record(row)))
        if out is not None:
            out.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        files, inner = pyarrow.fs.FileSystem.from_uri(self.path)
        files.create_dir(inner, recursive=True)
        if self.overwrite:
            for old in files.get_file_info(pyarrow.fs.FileSelector(inner)):
                if old.is_file:
                    files.delete_file(old.path)
        for name in (n for m in messages if m for n in m.files):
            files.move(f"{inner}/{self.job}/{name}", f"{inner}/{name}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        files, inner = pyarrow.fs.FileSystem.from_uri(self.path)
        if files.get_file_info(f"{inner}/{self.job}").type != pyarrow.fs.FileType.NotFound:
            files.delete_dir(f"{inner}/{self.job}")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def write_warc(records: DataFrame, path: str, mode: str = "append") -> None:
    """records (record_id, record_type, target_uri, refers_to, payload_digest, payload_length, payload) as archives under path."""
    register(records.sparkSession)
    names = ["record_id", "record_type", "target_uri", "refers_to", "payload_digest", "payload_length", "payload"]
    records.select(*names).write.format("warc").mode(mode).save(path)


def read_warc(spark: SparkSession, path: str, **options: str) -> DataFrame:
    register(spark)
    return spark.read.format("warc").options(**options).load(path)
