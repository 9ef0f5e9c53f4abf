"""WARC archives: written by Spark's text writer, read by a Python data source.

A record ends with two line breaks, so archives are text files whose line separator is that: Spark
writes them to any store it knows. The reader plans its partitions over whole files (a record start
cannot be told from payload that looks like one), takes predicates on record headers, parses the
headers first and jumps over blocks that nobody asked for.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith

from ranklake.llm.common import present

#: Digits of base 32, and of the number text that stands for them. Fixed values.
_BASE32, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"
END_OF_RECORD = "\r\n\r\n"
_ID = "urn:page:"


def base32_sha1(data: Column) -> Column:
    """The SHA-1 of a binary column in upper-case base 32: five hex digits make four of base 32."""
    hexed = F.sha1(data)
    fives = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*fives)), _DIGITS, _BASE32)


def header_text(value: Column) -> Column:
    """A value that fits on one header line: white space and control characters as percent codes."""
    shown = value.cast("string")
    for code in (*range(0x21), 0x7F):
        shown = F.replace(shown, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return shown


def with_revisits(pages: DataFrame, page_id: str, url: str, html: str, least: int) -> DataFrame:
    """``page_id, url, payload, digest, bytes, refers_to``: null for responses, else the response's id.

    The largest id of equal payloads is found with one partial result per task and payload, and the
    join that hands it back is one that Spark splits where a payload is very common.
    """
    payload = present(html)
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"),
        base32_sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).cast("long").alias("bytes"),
    )
    groups = (
        rows.groupBy("digest", "bytes")
        .agg(F.count("*").alias("_n"), F.max("page_id").alias("_keep"))
        .where((F.col("_n") > 1) & (F.col("bytes") >= least))
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("_keep")), F.col("_keep"))
    return rows.join(groups, ["digest", "bytes"], "left").select(*rows.columns, refers.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0, date: str = "1970-01-01T00:00:00Z", compression: str = "none") -> None:
    """Write one record per row of ``pages`` to archives in ``folder``.

    Rows of equal payloads of at least ``least`` bytes: that with the largest id is a response, the others
    are revisits that refer to it and carry no payload. Null html is an empty payload; a null url is left out;
    null ids never win, and revisit the winner, or are responses if no equal row has an id.
    Rows repeated in id and payload are all responses, or all revisits. An empty table gives archives without records.
    """
    rows = with_revisits(pages, page_id, url, html, least)
    revisit = F.col("refers_to").isNotNull()
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda c: F.concat(F.lit(f"<{_ID}"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"), F.lit("\r\n\r\n"),
    )
    length = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", header_text(F.col("url"))), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            line("WARC-Refers-To", urn(F.col("refers_to"))),
        )).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", length.cast("string")),
        F.lit("\r\n"), http,
        F.when(revisit, F.lit("")).otherwise(F.col("payload")),
    )
    rows.select(record.alias("value")).write.option("lineSep", END_OF_RECORD).option("compression", compression).text(folder)


@dataclass
class Files(InputPartition):
    """Archives that one task reads."""

    paths: list[str]


#: Columns that can be tested on the headers alone, with the header that holds them. Fixed values.
_HEADER = {
    "record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
    "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest", "date": "warc-date",
}
_SCHEMA = (
    "record_id string, record_type string, date string, target_uri string, refers_to string, "
    "payload_digest string, content_length bigint, payload_bytes bigint, payload binary"
)
_ARROW = pa.schema(
    [(c, pa.string()) for c in ("record_id", "record_type", "date", "target_uri", "refers_to", "payload_digest")]
    + [("content_length", pa.int64()), ("payload_bytes", pa.int64()), ("payload", pa.binary())]
)


class WarcSource(DataSource):
    """``spark.read.format("warc")``. Options: ``path``; ``payload`` (false: headers only); ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)


class WarcReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() != "false"
        self.split = int(options.get("splitBytes", str(64 << 20)))
        self.tests: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        """Take what the headers can answer; hand back the rest."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in _HEADER and isinstance(f, EqualTo):
                self.tests.append((_HEADER[column], "in", (f.value,)))
            elif column in _HEADER and isinstance(f, In):
                self.tests.append((_HEADER[column], "in", tuple(f.value)))
            elif column in _HEADER and isinstance(f, StringStartsWith):
                self.tests.append((_HEADER[column], "starts", (f.value,)))
            else:
                yield f

    def partitions(self) -> list[Files]:
        """Whole files, in bundles of about ``splitBytes``."""
        store, path = fs.FileSystem.from_uri(self.path)
        found = store.get_file_info(fs.FileSelector(path, recursive=True))
        found = sorted((x.path, x.size) for x in found if x.is_file and x.base_name[0] not in "._")
        bundles, room = [], 0
        for name, size in found:
            if not bundles or room < size:
                bundles.append(Files([]))
                room = self.split
            bundles[-1].paths.append(name)
            room -= size
        return bundles or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(self.path)
        rows, held = [], 0
        for path in partition.paths:
            with store.open_input_file(path) as raw:
                stream = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else io.BufferedReader(raw, 1 << 18)
                for row in self.records(stream):
                    rows.append(row)
                    held += 500 + len(row[-1] or b"")
                    if held > 8 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
        if rows:
            yield _batch(rows)

    def records(self, stream) -> Iterator[tuple]:
        """The wanted records of an archive. A block that is not wanted is jumped over, never read."""
        while True:
            version = stream.readline()
            if not version:
                return
            if not version.startswith(b"WARC/"):
                if not version.strip():
                    continue
                raise ValueError(f"no WARC record starts with {version[:40]!r}")
            headers = _headers(stream)
            length = int(headers["content-length"])
            if not all(_passes(headers.get(name), kind, values) for name, kind, values in self.tests):
                stream.seek(length + len(END_OF_RECORD), io.SEEK_CUR)
                continue
            payload, size = None, length
            left = length
            if headers.get("content-type", "").startswith("application/http"):
                start = stream.tell()
                stream.readline()
                size = int(_headers(stream).get("content-length", 0))
                left = length - (stream.tell() - start)
            if self.payload and headers["warc-type"] != "revisit":
                payload = stream.read(left)
                left = 0
            stream.seek(left + len(END_OF_RECORD), io.SEEK_CUR)
            yield (*(headers.get(_HEADER[c]) for c in _ARROW.names[:6]), length, size, payload)


def _headers(stream) -> dict[str, str]:
    found = {}
    for line in iter(stream.readline, b""):
        if line in (b"\r\n", b"\n"):
            break
        name, _, value = line.decode("utf-8", "replace").partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def _passes(value: str | None, kind: str, wanted: tuple) -> bool:
    if value is None:
        return False
    return value in wanted if kind == "in" else value.startswith(wanted)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def read_archives(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """The records of all archives in ``folder``. Without ``payload``, only their headers are read."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(folder)


def page_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    Size and digest of responses are taken from the payload that was read; those of revisits, whose
    records have none, from their headers.
    """
    number = lambda c: F.regexp_extract(c, r"(-?\d+)>$", 1).try_cast("bigint")
    responses = read_archives(spark, folder).where("record_type = 'response'")
    revisits = read_archives(spark, folder, payload=False).where("record_type = 'revisit'")
    read = responses.select(
        number("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"),
    )
    named = revisits.select(
        number("record_id").alias("page_id"), "payload_bytes",
        F.substring_index("payload_digest", ":", -1).alias("payload_digest"), "record_type",
        number("refers_to").alias("refers_to"),
    )
    return read.unionByName(named)
