"""WARC archives: a writer with payload deduplication and a Spark data source.

``spark.read.format("warc")`` plans one partition per file.  Predicates on the record
type and on header columns are pushed down: a record's headers are parsed first, and the
payload of a record that they reject is not decoded.  Files of this writer put headers
and block of a record into two gzip members and note the block's compressed length, so
such payloads are not even read; other ``.warc`` and ``.warc.gz`` files are read too.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter,
                                    GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull,
                                    IsNull, LessThan, LessThanOrEqual, StringStartsWith)

from .storage import file_system, shared_folder

#: payloads of fewer bytes are never revisits
MIN_REVISIT_BYTES = 100
_SKIP = "X-Block-Member-Bytes"
_LENGTH = "X-Payload-Length"
_MANIFEST = "manifest.json"
_PAGE = "urn:page:"
_READ = 1 << 18

SCHEMA = ("record_id string, record_type string, target_uri string, date string, "
          "content_type string, page_id long, refers_to long, payload_digest string, "
          "payload_length long, payload binary, file string")


# ---- records -------------------------------------------------------------------

def _header(fields: list[tuple[str, str]]) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"WARC/1.1\r\n{lines}\r\n".encode()


def _gzip(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def _one_line(value: str | None) -> str:
    """A header value: line ends and outer blanks would break the header."""
    return " ".join((value or "").split())


def record(page_id: int | None, url: str | None, payload: bytes, digest: str,
           refers_to: int | None, date: str) -> bytes:
    """One record as gzip members: its headers, and its block (an HTTP response; none for
    a revisit)."""
    urn = f"{_PAGE}{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid4()}"
    kind = "response" if refers_to is None else "revisit"
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http + (payload if refers_to is None else b"")
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{urn}>"), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", _one_line(url)))
    if refers_to is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", f"<{_PAGE}{refers_to}>")]
    member = _gzip(block + b"\r\n\r\n")
    fields += [("WARC-Payload-Digest", f"sha256:{digest}"), (_LENGTH, str(len(payload))),
               (_SKIP, str(len(member))), ("Content-Type", "application/http; msgtype=response"),
               ("Content-Length", str(len(block)))]
    return _gzip(_header(fields)) + member


class _Bytes:
    """Plain bytes of a file of gzip members, or of a plain file."""

    def __init__(self, source):
        self.source, self.raw, self.plain = source, b"", b""
        self.raw = source.read(_READ)
        self.gzip = self.raw[:2] == b"\x1f\x8b"
        self.member = None

    def more(self) -> bool:
        """Get more plain bytes; False at the end."""
        if not self.raw:
            self.raw = self.source.read(_READ)
            if not self.raw:
                return False
        if not self.gzip:
            self.plain += self.raw
            self.raw = b""
            return True
        if self.member is None:
            self.member = zlib.decompressobj(31)
        self.plain += self.member.decompress(self.raw)
        self.raw = self.member.unused_data
        if self.member.eof:
            self.member = None
        return True

    def until(self, mark: bytes) -> bytes | None:
        at, seen = self.plain.find(mark), 0
        while at < 0:
            seen = max(0, len(self.plain) - len(mark))
            if not self.more():
                return None
            at = self.plain.find(mark, seen)
        out, self.plain = self.plain[:at], self.plain[at + len(mark):]
        return out

    def take(self, n: int) -> bytes:
        parts = []
        while n > len(self.plain):
            parts.append(self.plain)
            n -= len(self.plain)
            self.plain = b""
            if not self.more():
                raise ValueError("a record is cut off")
        parts.append(self.plain[:n])
        self.plain = self.plain[n:]
        return b"".join(parts)

    def drop(self, n: int) -> None:
        while n > len(self.plain):
            n -= len(self.plain)
            self.plain = b""
            if not self.gzip and n > len(self.raw):
                n -= len(self.raw)
                self.raw = b""
                self.source.seek(n, 1)
                return
            if not self.more():
                raise ValueError("a record is cut off")
        self.plain = self.plain[n:]

    def skip_member(self, n: int) -> bool:
        """Pass over the next gzip member of ``n`` bytes without inflating it."""
        if not self.gzip or self.member is not None or self.plain:
            return False
        if n <= len(self.raw):
            self.raw = self.raw[n:]
        else:
            self.source.seek(n - len(self.raw), 1)
            self.raw = b""
        return True


def records(source, wanted: Callable[[dict], bool] = lambda row: True,
            payloads: bool = True) -> Iterator[dict]:
    """Records of an open file whose headers are ``wanted``."""
    data = _Bytes(source)
    while True:
        head = data.until(b"\r\n\r\n")
        if head is None:
            if data.plain.strip():
                raise ValueError("a record is cut off")
            return
        head = head.lstrip(b"\r\n")
        if not head.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields = {}
        for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        row = _row(fields)
        length = int(fields.get("content-length", 0))
        if payloads and wanted(row):
            block = data.take(length)
            data.drop(4)
            row["payload"] = _payload(block, fields)
            yield row
            continue
        if not (_SKIP.lower() in fields and data.skip_member(int(fields[_SKIP.lower()]))):
            data.drop(length + 4)
        if wanted(row):
            yield row


def _payload(block: bytes, fields: dict) -> bytes | None:
    if fields.get("warc-type") == "revisit":
        return None
    if fields.get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def _page(urn: str | None) -> int | None:
    urn = (urn or "").strip("<>")
    number = urn[len(_PAGE):]
    return int(number) if urn.startswith(_PAGE) and number.lstrip("-").isdigit() else None


def _row(fields: dict) -> dict:
    digest = fields.get("warc-payload-digest")
    length = fields.get(_LENGTH.lower())
    return {"record_id": fields.get("warc-record-id"), "record_type": fields.get("warc-type"),
            "target_uri": fields.get("warc-target-uri"), "date": fields.get("warc-date"),
            "content_type": fields.get("content-type"), "page_id": _page(fields.get("warc-record-id")),
            "refers_to": _page(fields.get("warc-refers-to")),
            "payload_digest": digest.partition(":")[2] if digest else None,
            "payload_length": int(length) if length else None, "payload": None}


# ---- the data source -------------------------------------------------------------

_TESTS: dict[type, Callable] = {
    EqualTo: lambda v, f: v is not None and v == f.value,
    EqualNullSafe: lambda v, f: v == f.value,
    In: lambda v, f: v is not None and v in f.value,
    GreaterThan: lambda v, f: v is not None and v > f.value,
    GreaterThanOrEqual: lambda v, f: v is not None and v >= f.value,
    LessThan: lambda v, f: v is not None and v < f.value,
    LessThanOrEqual: lambda v, f: v is not None and v <= f.value,
    IsNull: lambda v, f: v is None,
    IsNotNull: lambda v, f: v is not None,
    StringStartsWith: lambda v, f: v is not None and v.startswith(f.value),
}


class _File(InputPartition):
    def __init__(self, name: str):
        self.name = name


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.payloads = str(options.get("payloads", "true")).lower() == "true"
        self.filters: list[tuple[str, Filter]] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            column = getattr(f, "attribute", ())
            if type(f) in _TESTS and len(column) == 1 and column[0] not in ("payload", "file"):
                self.filters.append((column[0], f))
            else:
                yield f

    def partitions(self) -> list[_File]:
        from pyarrow import fs as pafs
        fs, place = file_system(self.folder)
        if fs.get_file_info(f"{place}/{_MANIFEST}").type == pafs.FileType.File:
            with fs.open_input_file(f"{place}/{_MANIFEST}") as f:
                names = json.loads(f.read())
        else:
            names = sorted(i.base_name for i in fs.get_file_info(pafs.FileSelector(place))
                           if i.base_name.endswith((".warc", ".warc.gz")))
        return [_File(n) for n in names] or [_File("")]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        fs, place = file_system(self.folder)
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        schema = pa.schema([(f.split()[0], types[f.split()[1]]) for f in SCHEMA.split(", ")])

        def wanted(row: dict) -> bool:
            return all(_TESTS[type(f)](row[c], f) for c, f in self.filters)

        out, held = [], 0
        with fs.open_input_file(f"{place}/{partition.name}") as source:
            for row in records(source, wanted, self.payloads):
                row["file"] = partition.name
                out.append(row)
                held += len(row["payload"] or b"") + 256
                if held > 1 << 23:
                    yield pa.RecordBatch.from_pydict({n: [r[n] for r in out] for n in names}, schema)
                    out, held = [], 0
        if out:
            yield pa.RecordBatch.from_pydict({n: [r[n] for r in out] for n in names}, schema)


class WarcDataSource(DataSource):
    """Format ``warc``: option ``path`` (a folder), ``payloads`` (false: headers only)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)


def read_warc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Records of the archives in ``folder``; with ``payloads`` off, payloads are null.
    Turns filter pushdown to Python data sources on for the session."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    return spark.read.format("warc").option("payloads", str(payloads).lower()).load(folder)


# ---- writing -------------------------------------------------------------------

def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", min_bytes: int = MIN_REVISIT_BYTES,
               date: str = "1970-01-01T00:00:00Z") -> None:
    """Write one record per row of ``pages``; payload: the html in UTF-8 (null: empty).

    Of rows with equal payloads of ``min_bytes`` or more the one with the smallest id is a
    response and the others are revisits of it; rows that share that id are responses too.
    Null ids come last and are never referred to: equal payloads without any id are all
    responses.  Other columns are not read.  No rows give an archive without files.
    """
    spark = pages.sparkSession
    fs, place = file_system(folder)
    fs.create_dir(place, recursive=True)
    last = (1 << 63) - 1
    html = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.coalesce(F.col(id_col).cast("long"), F.lit(last)).alias("k"),
                        F.col(url_col).alias("url"), html.alias("html"),
                        F.unhex(F.sha2(html, 256)).alias("digest"))
    slim = rows.where(F.octet_length("html") >= min_bytes).select("k", "digest")
    first = slim.groupBy("digest").agg(F.min("k").alias("first"), F.max("k").alias("most")) \
        .where("first < most").select("digest", "first")
    revisits = slim.join(first, "digest").where("k > first").distinct()
    todo = rows.join(revisits, ["k", "digest"], "left").sortWithinPartitions("k")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        fs, place = file_system(folder)
        name = f"pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        sink = None
        for batch in batches:
            for k, digest, url, html, to in zip(*(batch.column(c).to_pylist() for c in (
                    "k", "digest", "url", "html", "first"))):
                if sink is None:
                    sink = fs.open_output_stream(f"{place}/{name}", compression=None)
                sink.write(record(None if k == last else k, url, html, digest.hex(), to, date))
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pydict({"file": [name]})

    # a task that runs again writes another file; only what the manifest names is read
    names = sorted(r["file"] for r in todo.mapInArrow(write, "file string").collect())
    with fs.open_output_stream(f"{place}/{_MANIFEST}", compression=None) as f:
        f.write(json.dumps(names).encode())


def through_archives(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write ``pages`` to archives in a new shared folder and read them back: ``page_id,
    payload_bytes, payload_digest, record_type, refers_to``; responses are measured on the
    payloads read, revisits by their headers."""
    folder = folder or shared_folder(pages.sparkSession, "warc")
    write_warc(pages, folder, **options)
    back = read_warc(pages.sparkSession, folder)
    revisit = F.col("record_type") == "revisit"
    return back.select(
        "page_id",
        F.when(revisit, F.col("payload_length")).otherwise(F.octet_length("payload").cast("long"))
        .alias("payload_bytes"),
        F.when(revisit, F.col("payload_digest")).otherwise(F.sha2("payload", 256)).alias("payload_digest"),
        "record_type", "refers_to")
