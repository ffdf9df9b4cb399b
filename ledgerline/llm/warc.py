"""WARC archives: written by Spark's text writer, read by a Python data source.

Of pages with equal payloads of at least ``LEAST_REVISIT`` bytes the one with
the smallest id is a response record, the others are revisit records that
refer to it. A record is one line of text to Spark, ended by the two line ends
that end a WARC record, so files are committed like any other output.

The reader plans one partition per group of files, takes equality and IN
filters on the record type and on header columns, parses a record's headers
first and passes over the block of a record that is not wanted, or when the
payload is no column of the read schema.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

from ledgerline.llm.common import stored
from ledgerline.session import shared_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the planner's Python needs no import of this package

LEAST_REVISIT = 100
#: Bytes of archive per read task.
TASK_BYTES = 32_000_000
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URN = "urn:page:"
#: Columns of the reader and the header each comes from.
HEADERS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
           "date": "warc-date", "payload_digest": "warc-payload-digest", "payload_length": "warc-payload-length",
           "refers_to": "warc-refers-to", "content_type": "content-type", "content_length": "content-length"}
SCHEMA = ", ".join(f"{c} {'bigint' if c in ('payload_length', 'content_length') else 'string'}" for c in HEADERS) + \
    ", payload binary"


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, html, payload_bytes, digest, refers_to (NULL: a response) of every page; NULL html is empty.

    Pages that repeat the smallest id of their payload are all responses, as
    are pages of a payload in which no page has an id.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"),
                        html.alias("html"), F.octet_length(html).cast("bigint").alias("payload_bytes"),
                        F.sha2(html.cast("binary"), 256).alias("digest"))
    firsts = rows.where(F.col("payload_bytes") >= LEAST_REVISIT).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL")
    firsts = stored(firsts.select(F.col("digest").alias("f_digest"), "first"), "warc-firsts")
    return rows.join(firsts, F.col("digest") == F.col("f_digest"), "left").select(
        "page_id", "url", "html", "payload_bytes", "digest",
        F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to"))


def write_archive(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", **columns: str) -> None:
    """One WARC/1.1 record per page, gzipped, under ``path``. ``date`` stands for the crawl time, which pages lack."""
    plan = plan_records(pages, **columns)
    uri = F.regexp_replace("url", r"[\r\n]", "%0A")
    name = lambda c: F.concat(F.lit(f"<{_URN}"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    length = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    lines = [
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col("page_id"))), F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), uri), F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.concat(F.lit("WARC-Payload-Length: "), F.col("payload_bytes").cast("string")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name(F.col("refers_to")))),
        F.when(revisit, F.lit(f"WARC-Profile: {_PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), length.cast("string")),
    ]
    record = F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), block)
    plan.select(record.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option(
        "zlib.compress.level", "BEST_SPEED").text(path)


class _Stream:
    """Bytes of a file, gzipped or not: lines, exact reads and skips."""

    def __init__(self, raw, packed: bool):
        self.raw, self.packed = raw, packed
        self.buffer, self.at = b"", 0  # what is before ``at`` has been read
        self.inflate = zlib.decompressobj(31)

    def _more(self) -> bool:
        data = self.inflate.unused_data if self.packed and self.inflate.eof else b""
        data = data or self.raw.read(1 << 18)
        if not data:
            return False
        if self.packed:
            if self.inflate.eof:  # the next member
                self.inflate = zlib.decompressobj(31)
            data = self.inflate.decompress(data)
        self.buffer, self.at = self.buffer[self.at:] + data, 0
        return True

    def line(self) -> bytes | None:
        while (end := self.buffer.find(b"\n", self.at)) < 0:
            if not self._more():
                return None
        out, self.at = self.buffer[self.at:end], end + 1
        return out.rstrip(b"\r")

    def _take(self, n: int, keep: bool) -> list[bytes]:
        parts = []
        while n > len(self.buffer) - self.at:
            if keep:
                parts.append(self.buffer[self.at:])
            n -= len(self.buffer) - self.at
            self.buffer, self.at = b"", 0
            if not keep and not self.packed:
                self.raw.seek(n, 1)
                return parts
            if not self._more():
                raise EOFError("a record ends early")
        if keep:
            parts.append(self.buffer[self.at:self.at + n])
        self.at += n
        return parts

    def read(self, n: int) -> bytes:
        return b"".join(self._take(n, True))

    def skip(self, n: int) -> None:
        """Pass over n bytes without keeping them."""
        self._take(n, False)


def records(raw, packed: bool, wanted, with_payload: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(headers, payload) of the records whose headers ``wanted`` accepts; the payload follows the HTTP headers."""
    stream = _Stream(raw, packed)
    while (line := stream.line()) is not None:
        if not line.startswith(b"WARC/"):
            continue  # the empty lines between records
        headers = {}
        while line := stream.line():
            key, _, value = line.decode("utf-8", "replace").partition(":")
            headers[key.lower()] = value.strip()
        length = int(headers.get("content-length", "0"))
        if not wanted(headers):
            stream.skip(length)
        elif not with_payload:
            stream.skip(length)
            yield headers, None
        else:
            block = stream.read(length)
            http = headers.get("content-type", "").startswith("application/http")
            yield headers, block.partition(b"\r\n\r\n")[2] if http else block


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(paths)
        self.paths = paths


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType):
        self.path, self.schema, self.wanted = path, schema, []

    def pushFilters(self, filters):
        """Takes ``column = value`` and ``column IN (...)`` on header columns; the rest is left to Spark."""
        for f in filters:
            if isinstance(f, EqualTo | In) and f.attribute[0] in HEADERS:
                values = [f.value] if isinstance(f, EqualTo) else list(f.value)
                self.wanted.append((HEADERS[f.attribute[0]], {str(v) for v in values}))
            yield f  # Spark checks again; headers such as <urn:...> compare as written

    def partitions(self):
        fs, root = _filesystem(self.path)
        from pyarrow.fs import FileSelector

        info = [x for x in fs.get_file_info(FileSelector(root, recursive=True))
                if x.is_file and not x.base_name.startswith(("_", "."))]
        groups: list[list[str]] = []
        size = TASK_BYTES
        for x in sorted(info, key=lambda x: x.path):
            if size + x.size > TASK_BYTES:
                groups.append([])
                size = 0
            groups[-1].append(x.path)
            size += x.size
        return [Files(g) for g in groups] or [Files([])]

    def read(self, partition):
        fs, _ = _filesystem(self.path)
        names = [f.name for f in self.schema.fields]
        accept = lambda h: all(h.get(k) in v for k, v in self.wanted)
        kinds = [pa.binary() if n == "payload" else pa.int64() if n.endswith("_length") else pa.string() for n in names]
        rows, held = [], 0
        for path in partition.paths:
            with fs.open_input_file(path) as raw:
                for headers, payload in records(raw, path.endswith(".gz"), accept, "payload" in names):
                    rows.append([payload if n == "payload" else
                                 int(headers[HEADERS[n]]) if n.endswith("_length") and HEADERS[n] in headers else
                                 headers.get(HEADERS[n]) for n in names])
                    held += len(payload or b"")
                    if len(rows) >= 5000 or held > 16_000_000:
                        yield _batch(rows, names, kinds)
                        rows, held = [], 0
        if rows:
            yield _batch(rows, names, kinds)


def _batch(rows: list[list], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      names=names)


def _filesystem(path: str):
    from pyarrow.fs import FileSystem

    path = re.sub(r"^file:/+", "file:///", path)
    return FileSystem.from_uri(path if "://" in path else f"file://{path}")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(self.options["path"], schema)


def read_archive(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Records under ``path``; ``columns``: of ``SCHEMA``, all if none. Without ``payload`` no block is read."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    source = spark.read.format("warc")
    if columns:
        kinds = dict(c.split(" ") for c in SCHEMA.split(", "))
        source = source.schema(", ".join(f"{c} {kinds[c]}" for c in columns))
    return source.load(path)


def page_of(record_id):
    """The page id in a record id; NULL where it has none."""
    return F.regexp_extract(record_id, r"urn:page:(-?\d+)", 1).try_cast("bigint")


def archive_pages(pages: DataFrame, **columns: str) -> DataFrame:
    """Pages written as an archive and read back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A response's length and digest are those of the payload read; a revisit
    has none in the archive and takes them from its headers.
    """
    spark = pages.sparkSession
    path = shared_dir(spark, "warc")
    write_archive(pages, path, **columns)
    full = read_archive(spark, path, "record_type", "record_id", "payload").where("record_type = 'response'").select(
        page_of("record_id").alias("page_id"), F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), "record_type", F.lit(None).cast("bigint").alias("refers_to"))
    again = read_archive(spark, path, "record_type", "record_id", "payload_digest", "payload_length", "refers_to")
    again = again.where("record_type = 'revisit'").select(
        page_of("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"),
        F.substring_index("payload_digest", ":", -1).alias("payload_digest"), "record_type",
        page_of("refers_to").alias("refers_to"))
    return full.unionByName(again)
