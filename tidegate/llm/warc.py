"""WARC archives: written by Spark's own writer, read by a PySpark Python data source.

``archive`` writes one record a row. Records are built as one expression and written by the text writer with the blank
lines that end a record as its separator: files appear by Spark's commit, in any store that Spark writes to. Of rows with
equal payloads of at least ``least`` bytes the one of the smallest id is a ``response``, the others are ``revisit`` records
that refer to it and hold no payload, only the HTTP header. The smallest ids are counted before (combined before the
shuffle, digests only); pages meet that list by broadcast where it is small, else by a join whose hot digests are split
at run time.

``WarcSource`` reads archives. Its reader plans partitions of whole files of about ``split_bytes`` together. Only the
columns of the wanted schema are made. Filters on record type, other header columns and the payload's size are pushed
down and tested as soon as the header they need has been parsed; the block of a record that fails, or whose payload no
wanted column needs, is skipped by a seek and never decoded. Files are read as streams, so that memory holds one payload
and one batch. Archives of others can be read too, plain or compressed by gzip (whole or by record). A task that is run
again reads the same files anew.

Cases: a null payload is empty. A null URL has no header and reads as null; of line ends and control characters in
URLs the percent form is written. A null id is written as an empty one and reads as null; it never is the smallest, and if
all ids of a group are null, all are responses. Rows that repeat an id share it: all rows of the smallest id are
responses. Ids are written as text in percent form. Other columns are not used, whatever their names. An empty table
gives an archive without records. A record that breaks off or whose header is none raises ValueError with file and
place; a folder without files is empty. Transfer encodings are not undone.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import os
import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidegate.llm.common import ship
from tidegate.session import scratch_dir, written

LEAST = 100
"""Payloads of fewer bytes are always written in full."""

# Names of the format.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "date": "warc-date",
    "target_uri": "warc-target-uri",
    "content_type": "content-type",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
    "content_length": "content-length",
}

SCHEMA = (
    "record_type string, record_id string, date string, target_uri string, content_type string, payload_digest string, "
    "refers_to string, content_length long, headers map<string,string>, file string, offset long, payload_bytes long, "
    "payload binary, payload_sha256 string"
)
"""``record_id`` and ``refers_to`` without brackets; ``payload_digest`` as the header says, ``payload_sha256`` as computed
from the payload that is there. ``payload_bytes`` of a revisit is the size its HTTP header states."""

_PAYLOAD = {"payload", "payload_bytes", "payload_sha256"}
BATCH_BYTES = 4 * 1024**2
BATCH_ROWS = 1_000
SPLIT_BYTES = 64 * 1024**2


# ---------------------------------------------------------------- writing


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _line_safe(text: Column) -> Column:
    """Control characters would end a header line: their percent form."""
    out = text
    for code in (0x0D, 0x0A, 0x00):
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return out


def records(
    pages: DataFrame, id: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST,
    date: str = "1970-01-01T00:00:00Z", media: str = "text/html; charset=utf-8",
) -> DataFrame:
    """``record``: the bytes of each row's record, without the blank lines that end it."""
    data = F.coalesce(_quoted(payload).cast("binary"), F.lit(b""))
    rows = pages.select(
        _quoted(id).alias("id"), _quoted(url).cast("string").alias("url"), data.alias("data")
    ).select("*", F.octet_length("data").cast("long").alias("size"), F.sha2("data", 256).alias("digest"))
    firsts = (
        rows.where(F.col("size") >= least)
        .groupBy("digest")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1 AND first IS NOT NULL")
        .select(F.col("digest").alias("known"), "first")
    )
    # A written list has a known size: a small one is broadcast and no page is shuffled.
    marked = rows.join(written(firsts, "firsts"), F.col("digest") == F.col("known"), "left")
    full = F.col("first").isNull() | F.col("id").eqNullSafe(F.col("first"))

    def name(value: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.url_encode(value.cast("string")), F.lit("")), F.lit(">"))

    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK\r\nContent-Type: {media}\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n")
    )
    block = F.octet_length(http) + F.when(full, F.col("size")).otherwise(0)
    header = F.concat_ws(
        "\r\n",
        F.lit(VERSION),
        F.when(full, "WARC-Type: response").otherwise("WARC-Type: revisit"),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col("id"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), _line_safe(F.col("url"))),
        F.when(~full, F.concat(F.lit("WARC-Refers-To: "), name(F.col("first")))),
        F.when(~full, f"WARC-Profile: {SAME_PAYLOAD}"),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), block.cast("string")),
    )
    head = F.concat(header, F.lit("\r\n\r\n"), http).cast("binary")
    return marked.select(F.concat(head, F.when(full, F.col("data")).otherwise(F.lit(b""))).alias("record"))


def archive(pages: DataFrame, path: str, records_per_file: int = 100_000, **names: object) -> None:
    """Write the records of ``pages`` to a new folder of WARC files. For ``names`` see :func:`records`."""
    # A string column may hold any bytes here: the text writer puts them out as they are.
    lines = records(pages, **names).select(F.col("record").cast("string").alias("value"))
    writer = lines.write.option("lineSep", "\r\n\r\n").option("compression", "none")
    writer.option("maxRecordsPerFile", records_per_file).text(path)


# ---------------------------------------------------------------- reading


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI or a local path."""
    if re.match(r"file:/", path):
        path = "/" + path[5:].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path)


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...] = ()


class WarcSource(DataSource):
    """Options: ``path`` (a file or folder), ``split_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, self.options["path"], int(self.options.get("split_bytes", SPLIT_BYTES)))


def _test(rule: Filter, row: dict) -> bool | None:
    """What SQL makes of a filter: true, false or null."""
    if isinstance(rule, Not):
        inner = _test(rule.child, row)
        return None if inner is None else not inner
    have = row[rule.attribute[0]]
    if isinstance(rule, IsNull):
        return have is None
    if isinstance(rule, IsNotNull):
        return have is not None
    want = rule.value
    if isinstance(rule, EqualNullSafe):
        return have == want
    if isinstance(rule, In):
        return True if have is not None and have in want else (None if have is None or None in want else False)
    if have is None or want is None:
        return None
    if isinstance(rule, EqualTo):
        return have == want
    if isinstance(rule, GreaterThan):
        return have > want
    if isinstance(rule, GreaterThanOrEqual):
        return have >= want
    if isinstance(rule, LessThan):
        return have < want
    if isinstance(rule, LessThanOrEqual):
        return have <= want
    if isinstance(rule, StringStartsWith):
        return have.startswith(want)
    if isinstance(rule, StringEndsWith):
        return have.endswith(want)
    return want in have


_KNOWN = (
    EqualTo, EqualNullSafe, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, In, IsNull, IsNotNull,
    StringStartsWith, StringEndsWith, StringContains,
)


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, path: str, split_bytes: int):
        self.columns, self.arrow = schema.fieldNames(), to_arrow_schema(schema)
        self.path, self.split_bytes = path, split_bytes
        self.by_header: list[Filter] = []
        self.by_size: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Filters on header columns and on the payload's size are taken; the others are handed back."""
        for rule in filters:
            plain = rule.child if isinstance(rule, Not) else rule
            column = plain.attribute[0] if isinstance(plain, _KNOWN) and len(plain.attribute) == 1 else None
            if column in HEADERS:
                self.by_header.append(rule)
            elif column == "payload_bytes":
                self.by_size.append(rule)
            else:
                yield rule

    def partitions(self) -> list[InputPartition]:
        store, path = open_store(self.path)
        if store.get_file_info(path).type == fs.FileType.File:
            found = [store.get_file_info(path)]
        else:
            found = [
                f for f in store.get_file_info(fs.FileSelector(path, recursive=True))
                if f.type == fs.FileType.File and f.size and f.base_name[0] not in "_."
            ]
        out: list[list[str]] = []
        room = 0
        for info in sorted(found, key=lambda f: f.path):
            if info.size > room or not out:
                out.append([])
                room = self.split_bytes
            out[-1].append(info.path)
            room -= info.size
        return [Files(tuple(paths)) for paths in out] or [Files()]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store = open_store(self.path)[0]
        held: list[dict] = []
        size = 0
        for path in partition.paths:
            with store.open_input_file(path) as raw:
                for row in self._rows(raw, path):
                    held.append(row)
                    size += len(row.get("payload") or b"")
                    if size >= BATCH_BYTES or len(held) >= BATCH_ROWS:
                        yield self._batch(held)
                        held, size = [], 0
        if held:
            yield self._batch(held)

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        arrays = [
            pa.array([list(r[f.name].items()) if f.name == "headers" else r[f.name] for r in rows], f.type) for f in self.arrow
        ]
        return pa.RecordBatch.from_arrays(arrays, schema=self.arrow)

    def _rows(self, raw: pa.NativeFile, path: str) -> Iterator[dict]:
        buffered = io.BufferedReader(raw, 1 << 20)
        packed = buffered.peek(2)[:2] == b"\x1f\x8b"
        stream = io.BufferedReader(gzip.GzipFile(fileobj=buffered), 1 << 20) if packed else buffered
        in_block = bool(_PAYLOAD & set(self.columns) or self.by_size)
        while True:
            offset = stream.tell()
            row = parse_header(stream, path)
            if row is None:
                return
            row |= {"file": path, "offset": offset}
            left = row["content_length"]
            if all(_test(f, row) for f in self.by_header):
                if in_block:
                    left = self._enter(stream, row, left)
                if all(_test(f, row) for f in self.by_size):
                    if {"payload", "payload_sha256"} & set(self.columns):
                        data = _exactly(stream, left, path)
                        left = 0
                        # A revisit has no payload, which is not an empty one.
                        there = row["record_type"] != "revisit"
                        row["payload"] = data if there else None
                        row["payload_sha256"] = hashlib.sha256(data).hexdigest() if there else None
                    yield row
            _skip(stream, left)

    def _enter(self, stream: io.BufferedReader, row: dict, left: int) -> int:
        """Read the HTTP header of a block, if it has one: the payload's size is known then. Returns what is left."""
        row["payload_bytes"] = left
        if (row["content_type"] or "").startswith("application/http"):
            stated = None
            while left and (line := stream.readline(left)):
                left -= len(line)
                if line in (b"\r\n", b"\n"):
                    break
                key, _, value = line.partition(b":")
                if key.strip().lower() == b"content-length" and value.strip().isdigit():
                    stated = int(value)
            row["payload_bytes"] = stated if row["record_type"] == "revisit" else left
        return left


def parse_header(stream: io.BufferedReader, path: str) -> dict | None:
    """The next record's header as columns, None at the end of the file."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"{path}: no record header before byte {stream.tell()}")
    headers: dict[str, str] = {}
    key = ""
    while (line := stream.readline()) not in (b"\r\n", b"\n"):
        if not line:
            raise ValueError(f"{path}: a record header breaks off at byte {stream.tell()}")
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in " \t" and key:  # a folded line
            headers[key] += " " + text.strip()
            continue
        key, _, value = text.partition(":")
        key = key.strip().lower()
        headers[key] = value.strip()
    row: dict = {column: headers.get(name) for column, name in HEADERS.items()}
    if not (row["content_length"] or "").isdigit():
        raise ValueError(f"{path}: a record without a length before byte {stream.tell()}")
    row["content_length"] = int(row["content_length"])
    for column in ("record_id", "refers_to"):
        if row[column]:
            row[column] = row[column].strip("<>")
    return row | {"headers": headers}


def _exactly(stream: io.BufferedReader, size: int, path: str) -> bytes:
    data = stream.read(size)
    if len(data) < size:
        raise ValueError(f"{path}: a record breaks off at byte {stream.tell()}")
    return data


def _skip(stream: io.BufferedReader, size: int) -> None:
    if size:
        stream.seek(size, io.SEEK_CUR)


def read_archive(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """The records of the archives at ``path`` with some columns of :data:`SCHEMA`, by default all.

    Sets the session's switch for filters pushed to Python sources, which is off by default.
    """
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    whole = StructType.fromDDL(SCHEMA)
    schema = StructType([whole[c] for c in columns or whole.fieldNames()])
    return spark.read.format("warc").schema(schema).option("split_bytes", split_bytes).load(path)


def _id(column: str) -> Column:
    text = F.url_decode(F.regexp_extract(column, "^urn:page:(.*)$", 1))
    return F.nullif(text, F.lit("")).cast("long")


def report(pages: DataFrame) -> DataFrame:
    """Write ``pages`` and read the archives back: a row per record.

    Sizes and digests of responses are those of the payloads read; revisits are read by their headers alone.
    """
    spark = pages.sparkSession
    path = f"{scratch_dir(spark)}/warc-{uuid.uuid4().hex}"
    archive(pages, path)
    full = read_archive(spark, path, ["record_type", "record_id", "payload_bytes", "payload_sha256"])
    again = read_archive(spark, path, ["record_type", "record_id", "payload_bytes", "payload_digest", "refers_to"])
    first = full.where("record_type = 'response'").select(
        _id("record_id").alias("page_id"), "payload_bytes", F.col("payload_sha256").alias("payload_digest"), "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    )
    others = again.where("record_type = 'revisit'").select(
        _id("record_id").alias("page_id"), "payload_bytes",
        F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"), "record_type",
        _id("refers_to").alias("refers_to"),
    )
    return first.unionByName(others)
