"""WARC 1.1 archives as a Spark data source, in Python: spark.read.format("warc"), df.write.format("warc").

Reading plans partitions from the files, large files on their own and small ones together. Predicates on
record_type and on header columns are pushed to the reader. It parses a record's headers first; a record
that a predicate rejects, or whose payload nobody asked for, is skipped without decoding: by Content-Length in
plain files, by the "sl" lengths in a gzip member's extra field in compressed ones (members without that field
are inflated in small pieces and thrown away).

Options for reading: payload = "full" (column payload is filled), "verify" (payloads are decoded and held
against their digest and length, but not handed on) or "none". For writing: level (of gzip, 0 for plain
files) and max_mb (a task starts a new file beyond that size).

Cases: a null html counts as an empty payload; a null url has no WARC-Target-URI; control characters in a url are
percent-encoded; a null page_id has no WARC-Page-ID and is never chosen as a response that others
refer to; repeated rows with the smallest page_id of their payload are all responses; an empty table
writes no file, and a folder without files has no records; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

from .common import fs_of, importable, scratch_path

READ_SCHEMA = "record_id string, record_type string, target_uri string, date string, page_id long, refers_to long, payload_digest string, payload_bytes long, http_status int, payload binary, file string, offset long"
WRITE_SCHEMA = "page_id long, url string, payload binary, payload_digest string, payload_bytes long, record_type string, refers_to long"
DATE = "2024-01-01T00:00:00Z"
#: The record's named fields that predicates can test before the payload is read.
HEADER_COLUMNS = ("record_id", "record_type", "target_uri", "date", "page_id", "refers_to", "payload_digest", "payload_bytes", "http_status")
LEAST_REVISIT = 100
_CHUNK = 1 << 16


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options, overwrite)


# --- writing ---


def _member(record: bytes, level: int) -> bytes:
    """A gzip member with the lengths of both forms in its extra field."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(record) + z.flush()
    total = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, total, len(record)) if max(total, len(record)) < 1 << 32 else b"xx" + struct.pack("<HII", 8, 0, 0)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def _clean(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_of(page_id: int | None, url: str | None, payload: bytes, digest: str, n: int, kind: str, refers_to: int | None) -> bytes:
    """A response or revisit record. A revisit's block has the HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {n}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>", f"WARC-Date: {DATE}"]
    head += [f"WARC-Target-URI: {_clean(url)}"] if url is not None else []
    head += [f"WARC-Page-ID: {page_id}"] if page_id is not None else []
    head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To-Page-ID: {refers_to}"] if kind == "revisit" else []
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.level = int(options.get("level", 1))
        self.most = int(float(options.get("max_mb", 64)) * 1e6)
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = fs_of(self.path)
        files: list[str] = []
        out = None
        for batch in iterator:
            for row in zip(*(batch.column(batch.schema.names.index(c.split()[0])).to_pylist() for c in WRITE_SCHEMA.split(", ")), strict=True):
                if out is None or out.tell() >= self.most:
                    if out is not None:
                        out.close()
                    else:
                        fs.create_dir(f"{root}/_{self.job}")
                    files.append(f"{uuid.uuid4().hex}.warc{'.gz' * (self.level > 0)}")
                    out = fs.open_output_stream(f"{root}/_{self.job}/{files[-1]}", compression=None)
                record = record_of(*row)
                out.write(_member(record, self.level) if self.level else record)
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs as pfs

        fs, root = fs_of(self.path)
        fs.create_dir(root)
        if self.overwrite:
            for f in fs.get_file_info(pfs.FileSelector(root)):
                if re.search(r"\.warc(\.gz)?$", f.path):
                    fs.delete_file(f.path)
        for m in messages:
            for name in m.files if m else ():
                fs.move(f"{root}/_{self.job}/{name}", f"{root}/{name}")
        self._drop(fs, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._drop(*fs_of(self.path))

    def _drop(self, fs, root: str) -> None:
        from pyarrow import fs as pfs

        if fs.get_file_info(f"{root}/_{self.job}").type == pfs.FileType.Directory:
            fs.delete_dir(f"{root}/_{self.job}")


# --- reading ---


@dataclass
class Files(InputPartition):
    names: list[str]


def _holds(f: Filter, row: dict) -> bool:
    if isinstance(f, Not):
        return not _holds(f.child, row)
    value = row[f.attribute[0]]
    if isinstance(f, IsNull):
        return value is None
    if isinstance(f, IsNotNull):
        return value is not None
    if value is None:
        return False
    if isinstance(f, EqualTo):
        return value == f.value
    if isinstance(f, In):
        return value in f.value
    if isinstance(f, GreaterThan):
        return value > f.value
    if isinstance(f, GreaterThanOrEqual):
        return value >= f.value
    if isinstance(f, LessThan):
        return value < f.value
    if isinstance(f, LessThanOrEqual):
        return value <= f.value
    if isinstance(f, StringStartsWith):
        return value.startswith(f.value)
    if isinstance(f, StringEndsWith):
        return value.endswith(f.value)
    return f.value in value


_TESTS = (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, StringStartsWith, StringEndsWith, StringContains, IsNull, IsNotNull)


class WarcReader(DataSourceReader):
    def __init__(self, options, schema: StructType):
        self.path, self.payload = options["path"], options.get("payload", "full")
        self.together = int(float(options.get("partition_mb", 16)) * 1e6)
        self.schema, self.tests = schema, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            # Not of a comparison with null is unknown, not true; only plain tests are taken
            if isinstance(f, _TESTS) and len(f.attribute) == 1 and f.attribute[0] in HEADER_COLUMNS:
                self.tests.append(f)
            else:
                yield f

    def partitions(self) -> Sequence[Files]:
        from pyarrow import fs as pfs

        fs, root = fs_of(self.path)
        found = [fs.get_file_info(root)]
        if found[0].type == pfs.FileType.Directory:
            found = [f for f in fs.get_file_info(pfs.FileSelector(root)) if f.is_file and re.search(r"\.warc(\.gz)?$", f.path)]
        parts, size = [Files([])], 0
        for f in sorted(found, key=lambda f: f.path):
            if parts[-1].names and size + f.size > self.together:
                parts.append(Files([]))
                size = 0
            parts[-1].names.append(f.path)
            size += f.size
        return parts

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        fs, _ = fs_of(self.path)
        schema = to_arrow_schema(self.schema)
        names = schema.names

        def batch(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], schema.field(c).type) for c in names], schema=schema)

        rows, held = [], 0
        for name in partition.names:
            with fs.open_input_file(name) as source:
                for row in records(source, self.tests, self.payload, name):
                    rows.append(row)
                    held += len(row["payload"] or b"")
                    if len(rows) >= 4096 or held > 8 << 20:
                        yield batch(rows)
                        rows, held = [], 0
        if rows:
            yield batch(rows)


class _Plain:
    """Records one after another in a file."""

    def __init__(self, source, at: int):
        self.source, self.at, self.have = source, at, b""

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to the mark, None at the end of the file."""
        while (k := self.have.find(mark)) < 0:
            self.source.seek(self.at + len(self.have))
            more = self.source.read(_CHUNK)
            if not more:
                if self.have.strip():
                    raise ValueError("a record is cut short")
                return None
            self.have += more
        return self._take(k + len(mark))[:k]

    def _take(self, n: int) -> bytes:
        out, self.have = self.have[:n], self.have[n:]
        self.at += n
        return out

    def read(self, n: int) -> bytes:
        if len(self.have) < n:
            self.source.seek(self.at + len(self.have))
            self.have += self.source.read(max(_CHUNK, n - len(self.have)))
        if len(self.have) < n:
            raise ValueError("a record is cut short")
        return self._take(n)

    def skip(self, n: int) -> None:
        self.have = self.have[n:]
        self.at += n


class _Member(_Plain):
    """The inflated form of one gzip member; `end` is known beforehand if the member tells its length."""

    def __init__(self, source, at: int):
        source.seek(at)
        head = source.read(_CHUNK)
        self.end = None
        if head[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at {at}")
        if head[3] & 4:
            n, k = struct.unpack_from("<H", head, 10)[0], 12
            while k < 12 + n:
                size = struct.unpack_from("<H", head, k + 2)[0]
                if head[k : k + 2] == b"sl" and size == 8:
                    self.end = at + struct.unpack_from("<I", head, k + 4)[0]
                k += 4 + size
        self.source, self.have, self.inflate = source, b"", zlib.decompressobj(31)
        self.raw, self.next = head, at + len(head)

    def _more(self, least: int) -> bool:
        while len(self.have) < least and not self.inflate.eof:
            if not self.raw:
                self.source.seek(self.next)
                self.raw = self.source.read(_CHUNK)
                self.next += len(self.raw)
                if not self.raw:
                    raise ValueError("a gzip member is cut short")
            self.have += self.inflate.decompress(self.raw, max(_CHUNK // 16, least - len(self.have)))
            self.raw = self.inflate.unconsumed_tail
        return len(self.have) >= least

    def until(self, mark: bytes) -> bytes | None:
        while (k := self.have.find(mark)) < 0:
            if not self._more(len(self.have) + 1):
                raise ValueError("a record is cut short")
        out, self.have = self.have[:k], self.have[k + len(mark) :]
        return out

    def read(self, n: int) -> bytes:
        if not self._more(n):
            raise ValueError("a record is cut short")
        out, self.have = self.have[:n], self.have[n:]
        return out

    def after(self) -> int:
        """Where the next member begins."""
        if self.end is None:
            while not self.inflate.eof:
                self.have = b""
                self._more(1)
            self.end = self.next - len(self.inflate.unused_data)
        return self.end


def _headers(data: bytes) -> dict[str, str]:
    lines = re.sub(r"\r\n[ \t]+", " ", data.decode("utf-8", "replace")).split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def _number(value: str | None) -> int | None:
    return int(value) if value and re.fullmatch(r"-?\d+", value) else None


def records(source, tests: list[Filter] = (), payload: str = "full", name: str = "") -> Iterator[dict]:
    """The records of a file that pass the tests."""
    size, zipped = source.size(), source.read(2) == b"\x1f\x8b"
    at = 0
    plain = None if zipped else _Plain(source, 0)
    while at < size:
        part = _Member(source, at) if zipped else plain
        begun = at
        head = part.until(b"\r\n\r\n")
        if head is None:
            return
        head = head.lstrip()
        if not head.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {begun} of {name}")
        h = _headers(head)
        left = length = int(h["content-length"])
        digest = h.get("warc-payload-digest")
        row = {"record_id": h.get("warc-record-id"), "record_type": h.get("warc-type"), "target_uri": h.get("warc-target-uri"), "date": h.get("warc-date"), "page_id": _number(h.get("warc-page-id")), "refers_to": _number(h.get("warc-refers-to-page-id")), "payload_digest": digest.removeprefix("sha256:") if digest else None, "payload_bytes": length, "http_status": None, "payload": None, "file": name, "offset": begun}
        early = [t for t in tests if t.attribute[0] not in ("payload_bytes", "http_status")]
        keep = all(_holds(t, row) for t in early)
        if keep and h.get("content-type", "").startswith("application/http"):
            http = part.until(b"\r\n\r\n")
            left -= len(http) + 4
            inner = _headers(http)
            status = http.split(b"\r\n", 1)[0].split(b" ")
            row["http_status"] = _number(status[1].decode("latin-1")) if len(status) > 1 else None
            told = _number(inner.get("content-length"))
            row["payload_bytes"] = told if told is not None and row["record_type"] == "revisit" else left
        keep = keep and all(_holds(t, row) for t in tests)
        if keep and payload != "none" and row["record_type"] != "revisit":
            data = part.read(left)
            left = 0
            if digest and digest.startswith("sha256:") and hashlib.sha256(data).hexdigest() != row["payload_digest"]:
                raise ValueError(f"the payload at {begun} of {name} differs from its digest")
            row["payload"] = data if payload == "full" else None
        if zipped:
            at = part.after()
        else:
            part.skip(left + 4)
            at = part.at
        if keep:
            yield row


# --- pages ---


def records_of(pages: DataFrame, least: int = LEAST_REVISIT, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """The rows to write: of equal payloads of `least` bytes or more the smallest page_id is the response.

    Which pages revisit another is settled on ids and digests; payloads then meet these by page, never by digest, so many
    equal or empty pages do not come to one task.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumns({"payload_digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long")})
    large = rows.where(F.col("payload_bytes") >= least).select("page_id", "payload_digest")
    copies = large.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").drop("n")
    marks = large.join(copies, "payload_digest").where(~F.col("first").eqNullSafe(F.col("page_id"))).distinct()
    marks = marks.select(F.col("page_id").alias("again_id"), F.col("payload_digest").alias("again_digest"), "first")
    rows = rows.join(marks, F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("payload_digest") == F.col("again_digest")), "left")
    again = F.col("first").isNotNull()
    return rows.select("page_id", "url", F.when(again, F.lit(b"")).otherwise(F.col("payload")).alias("payload"), "payload_digest", "payload_bytes", F.when(again, "revisit").otherwise("response").alias("record_type"), F.col("first").alias("refers_to"))


def register(spark: SparkSession) -> None:
    importable(spark)
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def archive(pages: DataFrame, path: str | None = None, least: int = LEAST_REVISIT) -> DataFrame:
    """The query: pages written as archives and read back, payloads held against their digests."""
    spark = pages.sparkSession
    register(spark)
    path = path or scratch_path(spark, "warc")
    records_of(pages, least).write.format("warc").mode("append").save(path)
    return spark.read.format("warc").option("payload", "verify").load(path).where(F.col("record_type").isin("response", "revisit")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
