"""WARC archives: written by Spark's text writer, read by a Python data source.

Writing. A record is one line whose end is the record separator, so Spark's own writer commits
the files and any file system it reaches will do. Pages with equal payloads of at least
``min_bytes`` bytes are stored once: the one with the least id is a response, the others are
revisits that carry the HTTP head, the digest and the id of the response.

Reading. ``format("warc")`` plans its partitions from the listing: files are whole, and small
ones share a partition. Predicates on record headers are pushed down (``read_warc(where=...)``): the
reader parses a record's headers first, tests them, and skips the block of a record it does not
want without reading it. Options: ``payload`` (false leaves payloads undecoded and null),
``verify`` (true compares payloads with their digests), ``partitionBytes``, ``pushdown`` (true
takes predicates from Spark, which ``spark.sql.python.filterPushdown.enabled`` must allow).
The reader opens files through pyarrow: local or shared paths, hdfs://, s3://, gs://.

Defined cases: a null payload is empty; a null id has no page_id when read back, and is a revisit
if a page with an id has the same payload; rows that repeat the least id of a payload are all
responses; control characters in addresses are left out; an empty table gives no record; a
record cut short or with a wrong digest raises an error.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull,
    StringContains, StringEndsWith, StringStartsWith)

from viewstar.staging import Staging

END = "\r\n"
RECORD_END = END * 2
ID = "urn:viewstar:page:"
PARTITION_BYTES = 128 << 20
BATCH_ROWS = 1000
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HEX32, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

SCHEMA = ("record_id string, record_type string, target_uri string, date string, "
          "content_type string, content_length long, payload_digest string, refers_to string, "
          "payload_length long, payload binary")
_HEADERS = {
    "record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri",
    "date": "warc-date", "content_type": "content-type", "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to"}


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: forty bits, ten hex digits, make eight base32 digits."""
    digits = F.upper(F.sha1(payload))
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 10 * k, 10), 16, 32), 8, "0")
             for k in range(4)]
    return F.translate(F.concat(*parts), _HEX32, _BASE32)


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(END))


def write_pages(pages: DataFrame, path: str, staging: Staging, min_bytes: int = 0,
                date: str = "2024-01-01T00:00:00Z") -> None:
    """Write a record per row of ``pages`` (page_id, url, html)."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("html")).withColumn(
        "digest", base32_sha1(F.col("html").cast("binary")))
    # Stored first, so that its size is known: with few repeats the pages need not move.
    repeats = staging.table(rows.where(F.octet_length("html") >= min_bytes).groupBy(
        F.col("digest").alias("same")).agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select(
        "same", "first"), "repeats")
    linked = rows.join(repeats, (F.col("digest") == F.col("same"))
                       & (F.octet_length("html") >= min_bytes), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}"),
        _header("Content-Length", F.octet_length("html")), F.lit(END))
    block = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    uri = F.regexp_replace("url", "[\\x00-\\x1F\\x7F]", "")
    record = F.concat(
        F.lit(VERSION + END),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", F.concat(
            F.lit(f"<{ID}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        _header("WARC-Date", F.lit(date)),
        F.coalesce(_header("WARC-Target-URI", uri), F.lit("")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(
            _header("WARC-Profile", F.lit(REVISIT_PROFILE)),
            _header("WARC-Refers-To", F.concat(
                F.lit(f"<{ID}"), F.col("first").cast("string"), F.lit(">"))))
        ).otherwise(F.lit("")),
        _header("Content-Type", F.lit("application/http;msgtype=response")),
        _header("Content-Length", F.octet_length(F.col("head")) + F.octet_length(F.col("block"))),
        F.lit(END), F.col("head"), F.col("block"))
    linked.withColumns({"head": head, "block": block}).select(
        record.alias("value")).write.option("lineSep", RECORD_END).text(path)


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class WarcSource(DataSource):
    """``spark.read.format("warc").load(path)`` over a file or a folder of archives."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        pushing = self.options.get("pushdown", "false").lower() == "true"
        return (PushingReader if pushing else WarcReader)(self.options)


def _read_head(source: io.BufferedIOBase) -> bytes:
    """Lines up to and with the next empty one; nothing at the end of the file."""
    lines = []
    while line := source.readline():
        lines.append(line)
        if line in (b"\r\n", b"\n") and len(lines) > 1:
            return b"".join(lines)
        if line in (b"\r\n", b"\n"):
            lines.pop()
    if lines:
        raise ValueError("a record ends within its headers")
    return b""


def parse_headers(head: bytes) -> dict[str, str]:
    """Header names in lower case; a line that starts with white space goes on the last one.

    Lines end in CR LF or LF and nowhere else, whatever line separators a value holds; of a
    repeated header the first counts.
    """
    lines = [line.removesuffix("\r") for line in head.decode("utf-8", "replace").split("\n")]
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    fields, name = {}, None
    for line in lines[1:]:
        if line[:1] in (" ", "\t"):
            if name:
                fields[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            if name in fields:
                name = None
            else:
                fields[name] = value.strip()
    return fields


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options.get("path")
        if not self.path:
            raise ValueError("load() needs a path")
        self.payload = options.get("payload", "true").lower() == "true"
        self.verify = options.get("verify", "false").lower() == "true"
        self.partition_bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        self.tests: list[Filter] = []

    def partitions(self) -> list[InputPartition]:
        """Whole files in the order of their names, small ones together."""
        system, root = pyarrow.fs.FileSystem.from_uri(self.path)
        info = system.get_file_info(root)
        if info.type == pyarrow.fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info]
        if info.type == pyarrow.fs.FileType.Directory:
            found = [f for f in system.get_file_info(pyarrow.fs.FileSelector(root))
                     if f.is_file and f.base_name[0] not in "._"]
        planned, held = [Files([])], 0
        for file in sorted(found, key=lambda f: f.path):
            if held and held + file.size > self.partition_bytes:
                planned.append(Files([]))
                held = 0
            planned[-1].paths.append(file.path)
            held += file.size
        return planned

    def wanted(self, row: dict) -> bool:
        for test in self.tests:
            value = row[test.attribute[0]]
            if isinstance(test, IsNotNull):
                passed = value is not None
            elif isinstance(test, EqualNullSafe):
                passed = value == test.value
            elif value is None:
                passed = False
            elif isinstance(test, In):
                passed = value in test.value
            elif isinstance(test, StringStartsWith):
                passed = value.startswith(test.value)
            elif isinstance(test, StringEndsWith):
                passed = value.endswith(test.value)
            elif isinstance(test, StringContains):
                passed = test.value in value
            else:
                passed = value == test.value
            if not passed:
                return False
        return True

    def records(self, source, size: int | None = None) -> Iterator[dict]:
        """The records of an open file; ``size`` is its length where seeking goes past the end."""
        def skip(length: int) -> None:
            target = source.tell() + length
            if source.seek(length, io.SEEK_CUR) < target or size is not None and target > size:
                raise ValueError(f"{row['record_id']} is cut short")

        while head := _read_head(source):
            fields = parse_headers(head)
            length = int(fields.get("content-length", -1))
            if length < 0:
                raise ValueError("a record has no Content-Length")
            row = {column: fields.get(name) for column, name in _HEADERS.items()}
            for column in ("record_id", "refers_to"):
                if row[column]:
                    row[column] = row[column].strip("<>")
            if not self.wanted(row):
                skip(length)
                continue
            row |= {"content_length": length, "payload": None, "payload_length": length}
            rest, http = length, (row["content_type"] or "").startswith("application/http")
            if http:
                lines = []
                while rest and (line := source.readline(rest)):
                    rest -= len(line)
                    if line in (b"\r\n", b"\n"):
                        break
                    lines.append(line.decode("latin-1").partition(":"))
                row["payload_length"] = next(
                    (int(value) for name, _, value in lines
                     if name.strip().lower() == "content-length"), rest)
            if (self.payload or self.verify) and row["record_type"] != "revisit":
                payload = source.read(rest)
                if len(payload) != rest:
                    raise ValueError(f"{row['record_id']} is cut short")
                row["payload_length"] = rest
                if self.verify and row["payload_digest"]:
                    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    if row["payload_digest"].removeprefix("sha1:") != digest:
                        raise ValueError(f"{row['record_id']} does not match its digest")
                row["payload"] = payload if self.payload else None
            else:
                skip(rest)
            yield row

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = pyarrow.fs.FileSystem.from_uri(self.path)
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        schema = pa.schema([(n, kinds[c.split()[1]])
                            for n, c in zip(names, SCHEMA.split(", "))])
        for path in partition.paths:
            with system.open_input_file(path) as file:
                source, size = io.BufferedReader(file, 1 << 20), file.size()
                if path.endswith(".gz"):
                    source, size = gzip.GzipFile(fileobj=source), None
                rows, held = [], 0
                for row in self.records(source, size):
                    rows.append(row)
                    held += len(row["payload"] or b"")
                    if len(rows) >= BATCH_ROWS or held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)


class PushingReader(WarcReader):
    """A reader that Spark may hand predicates to (option ``pushdown``)."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Keep what can be told from headers; give back the rest."""
        kinds = (EqualTo, EqualNullSafe, In, IsNotNull, StringStartsWith, StringEndsWith,
                 StringContains)
        for filter_ in filters:
            if isinstance(filter_, kinds) and filter_.attribute[0] in _HEADERS:
                self.tests.append(filter_)
            else:
                yield filter_


def read_warc(spark: SparkSession, path: str, where: str | None = None, payload: bool = True,
              verify: bool = False) -> DataFrame:
    """The archives under ``path``; the reader skips records that ``where`` leaves out.

    Spark keeps one reader per loaded relation, and a later filter would replace what it was
    told, also for frames made before. So the predicates are pushed once, here, for a relation
    of this call's own, and later filters of the frame are Spark's own work.
    """
    spark.dataSource.register(WarcSource)
    frame = spark.read.format("warc").options(
        payload=payload, verify=verify, pushdown=where is not None).load(path)
    if where is None:
        return frame
    frame = frame.where(where)
    before = spark.conf.get(PUSHDOWN, "false")
    spark.conf.set(PUSHDOWN, "true")
    try:
        frame._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set(PUSHDOWN, before)
    return frame


def page_id(urn: str) -> Column:
    """The page's id from a record's id, null for none."""
    return F.regexp_extract(urn, f"^{ID}(-?[0-9]+)$", 1).try_cast("long")
