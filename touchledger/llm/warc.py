"""WARC archives as a PySpark Python data source.

``spark.read.format("warc")`` plans partitions from whole files, packed up to a target size. A reader parses the header of
each record first, tests the pushed-down predicates on it, and only if the record is wanted and the schema asks for the
payload does it decode it. In files that this writer made, every gzip member carries its compressed length in its ``sl``
extra field, so an unwanted record is skipped by a seek; in others it is inflated and thrown away. Uncompressed files are
skipped by Content-Length.

``df.write.format("warc")`` writes one gzip member per record. Files get their final name when the job commits, so what a
lost task leaves is never read.

Options: ``path``; ``partitionBytes`` (64 MB) for reading; ``verify`` (false) decodes the payload of each response that
is read and raises if its SHA-1 is not the one in the header; ``fileBytes`` (512 MB) for writing.

Defined results: a null payload is empty; a null record id gets a random one; a null target has no header; line breaks in
header values become spaces; a folder without archives is an empty table. Fields that a header does not have are null.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo,
                                    GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan,
                                    LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith,
                                    WriterCommitMessage)

from touchledger.plans.workspace import Workspace

SCHEMA = ("record_type string, record_id string, target_uri string, date string, content_type string, "
          "refers_to string, payload_digest string, payload_bytes bigint, payload binary, file string, offset bigint")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Header of each column that is one.
_HEADERS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
            "date": "warc-date", "content_type": "content-type", "refers_to": "warc-refers-to",
            "payload_digest": "warc-payload-digest"}
_READ = 1 << 20
_END = b"\r\n\r\n"


def filesystem(path: str):
    """File system and path in it, of a URI or a local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if ":/" in path else f"file://{path}")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open_uri(value: str | None) -> str | None:
    """The URI without its brackets."""
    return value[1:-1] if value and value[0] == "<" and value[-1] == ">" else value


# Writing

def _clean(value) -> str:
    return " ".join(str(value).splitlines())


def record(row: dict) -> bytes:
    """A response with its payload, or, if it refers to another record, a revisit without."""
    payload = row.get("payload") or b""
    payload = payload.encode() if isinstance(payload, str) else payload
    revisit = row.get("refers_to") is not None
    full = row.get("payload_bytes")
    full = len(payload) if full is None else full
    digest = base64.b32encode(row["sha1"]).decode() if row.get("sha1") else base32_sha1(payload)
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {full}\r\n\r\n").encode()
    body = http if revisit else http + payload
    record_id = row.get("record_id") or f"urn:uuid:{uuid.uuid4()}"
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{_clean(record_id)}>",
            f"WARC-Date: {row.get('date') or '1970-01-01T00:00:00Z'}", f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    if row.get("target_uri") is not None:
        head.append(f"WARC-Target-URI: {_clean(row['target_uri'])}")
    if revisit:
        head += [f"WARC-Refers-To: <{_clean(row['refers_to'])}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(head).encode() + _END + body + _END


def member(raw: bytes, level: int = 1) -> bytes:
    """A gzip member whose ``sl`` field has its whole length and that of its content (0 where 32 bits are too few)."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    packed = deflate.compress(raw) + deflate.flush()
    total = 24 + len(packed) + 8
    sizes = (total, len(raw)) if max(total, len(raw)) < 1 << 32 else (0, 0)
    extra = b"sl" + struct.pack("<HII", 8, *sizes)
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + packed
            + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF))


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, str]] = field(default_factory=list)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, file_bytes: int, overwrite: bool):
        self.path, self.file_bytes, self.overwrite = path, file_bytes, overwrite

    def write(self, iterator):
        from pyspark import TaskContext

        system, root = filesystem(self.path)
        system.create_dir(root, recursive=True)
        part, written, out, size = TaskContext.get().partitionId(), [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or size >= self.file_bytes:
                    if out is not None:
                        out.close()
                    name = f"{root}/part-{part:05d}-{uuid.uuid4().hex}.warc.gz"
                    written.append((f"{name}.inprogress", name))
                    out, size = system.open_output_stream(written[-1][0]), 0
                raw = member(record(row))
                out.write(raw)
                size += len(raw)
        if out is not None:
            out.close()
        return _Written(written)

    def commit(self, messages):
        system, root = filesystem(self.path)
        if self.overwrite:
            for old in archives(self.path):
                system.delete_file(old[0])
        for message in messages:
            for now, name in message.files if message else ():
                system.move(now, name)

    def abort(self, messages):
        system, _ = filesystem(self.path)
        for message in messages:
            for now, _ in message.files if message else ():
                system.delete_file(now)


# Reading

def archives(path: str) -> list[tuple[str, int]]:
    """Archives under a folder, or the one archive at a path, with their sizes."""
    from pyarrow import fs

    system, root = filesystem(path)
    found = system.get_file_info(root)
    if found.type == fs.FileType.Directory:
        found = system.get_file_info(fs.FileSelector(root, recursive=True))
    else:
        found = [found]
    return sorted((f.path, f.size) for f in found if f.is_file and f.path.endswith((".warc", ".warc.gz")))


@dataclass
class _Files(InputPartition):
    files: list[str]

    def __post_init__(self):
        self.value = self.files


def planned(files: list[tuple[str, int]], target: int) -> list[_Files]:
    """Whole files dealt to partitions of about the target size, the largest first."""
    out, now, size = [], [], 0
    for path, n in sorted(files, key=lambda f: -f[1]):
        if now and size + n > target:
            out.append(_Files(now))
            now, size = [], 0
        now.append(path)
        size += n
    return [*out, _Files(now)] if now else out


_TESTS = {EqualTo: lambda a, b: a == b, EqualNullSafe: lambda a, b: a == b, In: lambda a, b: a in b,
          GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b,
          LessThanOrEqual: lambda a, b: a <= b, StringStartsWith: lambda a, b: a.startswith(b),
          StringEndsWith: lambda a, b: a.endswith(b), StringContains: lambda a, b: b in a}


def _passes(test, row: dict) -> bool:
    """Whether a pushed predicate holds; one on null holds only where SQL says so."""
    if isinstance(test, Not):
        inner = test.child
        if not isinstance(inner, (EqualNullSafe, IsNull, IsNotNull)) and row[inner.attribute[0]] is None:
            return False
        return not _passes(inner, row)
    value = row[test.attribute[0]]
    if isinstance(test, IsNull):
        return value is None
    if isinstance(test, IsNotNull):
        return value is not None
    if value is None and not isinstance(test, EqualNullSafe):
        return False
    return _TESTS[type(test)](value, test.value)


def _pushable(test) -> bool:
    if isinstance(test, Not):
        return _pushable(test.child)
    return isinstance(test, (*_TESTS, IsNull, IsNotNull)) and len(test.attribute) == 1 and test.attribute[0] in _HEADERS


class _Stream:
    """Records of one archive, plain or of gzip members; what is not read of a record is skipped."""

    def __init__(self, file, compressed: bool):
        self.file, self.compressed = file, compressed
        self.buffer, self.at = b"", 0
        self.size = file.size()

    def _need(self, n: int) -> bytes:
        """At least n bytes from the place, if the file has them."""
        while len(self.buffer) < n:
            more = self.file.read(max(_READ, n - len(self.buffer)))
            if not more:
                break
            self.buffer += more
        return self.buffer

    def _advance(self, n: int) -> None:
        self.at += n
        if n <= len(self.buffer):
            self.buffer = self.buffer[n:]
        else:
            self.buffer = b""
            self.file.seek(self.at)

    def records(self):
        """(offset, header block, function that gives the block's bytes)."""
        return self._members() if self.compressed else self._plain()

    def _plain(self):
        while self.at < self.size:
            offset, n = self.at, 1 << 12
            while (end := self._need(n).find(_END)) < 0:
                if len(self.buffer) < n:
                    if self.buffer.strip():
                        raise ValueError("the archive ends inside a record's header")
                    return
                n *= 2
            head = self.buffer[:end]
            length = int(fields(head)["content-length"])
            self._advance(end + 4)
            begin = self.at
            yield offset, head, lambda: self._need(length)[:length]
            self._advance(begin + length + 4 - self.at)

    def _members(self):
        while self.at < self.size:
            offset, skip, content = self.at, 0, 0
            start = self._need(1 << 10)
            if start[:3] != b"\x1f\x8b\x08":
                raise ValueError(f"no gzip member at {offset}")
            if start[3] & 4 and start[12:14] == b"sl":
                skip, content = struct.unpack("<II", start[16:24])
            inside, first = _Member(self, offset), True
            # A member may hold several records; only one that says how long it is may be skipped, if it holds one.
            while first or inside.more():
                head = inside.head()
                length = int(fields(head)["content-length"])
                yield offset, head, lambda at=len(head) + 4, n=length: inside.peek(at, n)
                if first and skip and content == len(head) + 4 + length + 4:
                    break
                inside.drop(len(head) + 4 + length)
                first, skip = False, 0
            self._advance(skip or inside.taken - len(inside.inflate.unused_data))


class _Member:
    """What one gzip member holds, inflated as far as it is asked for."""

    def __init__(self, stream: _Stream, offset: int):
        self.stream, self.offset = stream, offset
        self.inflate, self.raw, self.taken = zlib.decompressobj(31), b"", 0

    def _inflate(self, most: int) -> bool:
        """Inflates up to so many bytes more; not at the member's end."""
        if self.inflate.eof:
            return False
        source = self.inflate.unconsumed_tail
        if not source:
            source = self.stream._need(self.taken + (_READ if self.taken else 2048))[self.taken:]
            if not source:
                raise ValueError(f"the member at {self.offset} is cut off")
            self.taken += len(source)
        self.raw += self.inflate.decompress(source, most)
        return True

    def more(self) -> bool:
        """Whether another record follows; line ends between records do not count."""
        self.raw = self.raw.lstrip(b"\r\n")
        while not self.raw and self._inflate(4096):
            self.raw = self.raw.lstrip(b"\r\n")
        return bool(self.raw)

    def head(self) -> bytes:
        while (end := self.raw.find(_END)) < 0:
            if not self._inflate(4096):
                raise ValueError(f"the member at {self.offset} ends inside a record's header")
        return self.raw[:end]

    def peek(self, at: int, n: int) -> bytes:
        """Bytes of the record's block."""
        parts, size = [self.raw], len(self.raw)
        while size < at + n:
            self.raw = b""
            if not self._inflate(_READ):
                raise ValueError(f"the member at {self.offset} ends inside a record")
            parts.append(self.raw)
            size += len(self.raw)
        self.raw = b"".join(parts)
        return self.raw[at:at + n]

    def drop(self, n: int) -> None:
        """Inflates past a record and throws it away."""
        while len(self.raw) < n:
            n, self.raw = n - len(self.raw), b""
            if not self._inflate(_READ):
                raise ValueError(f"the member at {self.offset} ends inside a record")
        self.raw = self.raw[n:]


def fields(head: bytes) -> dict[str, str]:
    """Header fields by their lower-case names; the first line is left out."""
    out: dict[str, str] = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        out.setdefault(name.strip().lower().decode("latin-1"), value.strip().decode("utf-8", "replace"))
    return out


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema, partition_bytes: int, verify: bool):
        self.path, self.schema, self.partition_bytes, self.verify = path, schema, partition_bytes, verify
        self.tests: list = []

    def pushFilters(self, filters):
        for test in filters:
            if _pushable(test):
                self.tests.append(test)
            else:
                yield test

    def partitions(self):
        return planned(archives(self.path), self.partition_bytes) or [_Files([])]

    def read(self, partition):
        from pyspark.sql.pandas.types import to_arrow_schema

        kind, names = to_arrow_schema(self.schema), self.schema.fieldNames()
        system, _ = filesystem(self.path)
        body = bool({"payload", "payload_bytes"} & set(names)) or self.verify
        rows, size = [], 0
        for path in partition.files:
            with system.open_input_file(path) as file:
                for offset, head, whole in _Stream(file, path.endswith(".gz")).records():
                    row = self._header(head)
                    if not all(_passes(t, row) for t in self.tests):
                        continue
                    row |= {"file": path, "offset": offset, "payload": None, "payload_bytes": None}
                    if body:
                        self._payload(row, whole)
                    rows.append([row[n] for n in names])
                    size += len(row["payload"] or b"") if "payload" in names else 0
                    if len(rows) >= 4096 or size >= 16 << 20:
                        yield self._batch(rows, kind)
                        rows, size = [], 0
        if rows:
            yield self._batch(rows, kind)

    @staticmethod
    def _batch(rows, kind):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kind.types)], schema=kind)

    @staticmethod
    def _header(head: bytes) -> dict:
        found = fields(head)
        row = {column: found.get(name) for column, name in _HEADERS.items()}
        for column in ("record_id", "refers_to", "target_uri"):
            row[column] = _open_uri(row[column])
        if row["payload_digest"] and row["payload_digest"].startswith("sha1:"):
            row["payload_digest"] = row["payload_digest"][5:]
        return row

    def _payload(self, row: dict, whole) -> None:
        """Payload and its length; of a revisit, the length that its HTTP header has for the full payload."""
        block = whole()
        http, found, payload = block.partition(_END)
        if not (row["content_type"] or "").startswith("application/http"):
            http, payload = b"", block
        if row["record_type"] == "revisit":
            length = fields(http).get("content-length")
            row["payload_bytes"] = int(length) if length is not None else None
            return
        row["payload"], row["payload_bytes"] = payload, len(payload)
        if self.verify and row["payload_digest"] and base32_sha1(payload) != row["payload_digest"]:
            raise ValueError(f"payload of {row['record_id']} in {row['file']} does not have its digest")


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        o = self.options
        return WarcReader(o["path"], schema, int(o.get("partitionBytes", 64 << 20)),
                          o.get("verify", "false").lower() == "true")

    def writer(self, schema, overwrite):
        o = self.options
        return WarcWriter(o["path"], int(o.get("fileBytes", 512 << 20)), overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def records_of(pages: DataFrame, least_bytes: int = 0, workspace: Workspace | None = None) -> DataFrame:
    """Rows for the writer: of pages with equal html of at least ``least_bytes`` bytes, that with the smallest page_id
    (a null one only if there is no other) is a response and the others revisit it.

    Rows that repeat page_id and html are all responses if the page is. The html moves once, dealt by its digest; a
    digest with very many pages is split by the skew join, for the other side has one row of it, and is written before
    the join, so that both sides come straight out of a shuffle.
    """
    workspace = workspace or Workspace(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").alias("target_uri"),
                        F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha1", F.unhex(F.sha1("payload")))
    first = rows.select("sha1", "page_id").groupBy(F.col("sha1").alias("_sha1")).agg(F.min("page_id").alias("first"))
    first = workspace.settle(first, f"first-{uuid.uuid4().hex}")
    joined = rows.hint("merge").join(first.hint("merge"), F.col("sha1") == F.col("_sha1"))
    full = F.octet_length("payload").cast("bigint")
    revisit = (full >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("first"))
    number = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    return joined.select(
        F.concat(F.lit("urn:x-page:"), number).alias("record_id"), "target_uri",
        F.when(~revisit, F.col("payload")).alias("payload"), full.alias("payload_bytes"), F.col("sha1"),
        F.when(revisit, F.concat(F.lit("urn:x-page:"), F.col("first").cast("string"))).alias("refers_to"))


def page_of(urn):
    """The page's id in a record's URN; null for a page without one."""
    return F.expr(f"try_cast(substring_index({urn}, ':', -1) as bigint)")
