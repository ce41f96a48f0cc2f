"""WARC archives: pages as records in whole-file gzip streams, a normaliser that gives every record a
gzip member of its own, and an offset index beside the archives.

All files are written and read by Spark, so they can lie in any store that Spark reaches. The text
sink writes a row's bytes as they are; its line separator ends a record in the first archives, and
is an empty gzip member in the normalised ones.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from targetlens.functions.flags import quoted
from targetlens.llm.common import columns
from targetlens.storage import fresh_path

LEAST_BYTES = 1_000
# Fixed values of the format.
VERSION = "WARC/1.1"
END = b"\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MEMBER = 31  # zlib's number for gzip framing
LEVEL = 6
READ_AT_ONCE = 1 << 16
INDEX_SCHEMA = (
    "archive string, offset long, length long, page_id string, url string, record_type string, "
    "payload_bytes long, payload_digest string, refers_to string"
)


def member(data: bytes) -> bytes:
    """One gzip member; the same bytes for the same data."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, MEMBER)
    return packer.compress(data) + packer.flush()


SEPARATOR = member(b"")


def page_records(
    pages: DataFrame, id_column: str, url_column: str, html_column: str, least: int
) -> DataFrame:
    """``record``: the bytes of each page's record without the blank lines after it.

    Equal payloads of at least ``least`` bytes are stored once, with the largest id; the others
    refer to it. Payloads are compared by their SHA-256.
    """
    payload = F.encode(F.coalesce(quoted(html_column).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(
        quoted(id_column).alias("id"), quoted(url_column).cast("string").alias("url"),
        payload.alias("payload"),
    )
    digests = rows.select("id", F.sha2("payload", 256).alias("same"), F.length("payload").alias("n"))
    keepers = digests.where(F.col("n") >= least).groupBy("same").agg(
        F.max("id").alias("keeper"), F.count(F.lit(1)).alias("number")
    )
    keepers = keepers.where("number > 1 and keeper is not null").select("same", "keeper")
    rows = rows.withColumn("same", F.sha2("payload", 256)).join(keepers, "same", "left")
    revisits = F.col("keeper").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeper"))
    return rows.select(_record(revisits).alias("record"))


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value."""
    clean = F.regexp_replace(value.cast("string"), "[\\r\\n]+", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def _record(revisits: Column) -> Column:
    size = F.length("payload").cast("string")
    body = F.when(revisits, F.lit(b"")).otherwise(F.col("payload"))
    head = F.concat(
        F.lit(f"{VERSION}\r\n"),
        _header("WARC-Type", F.when(revisits, "revisit").otherwise("response")),
        _header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("id").cast("string"), F.lit(">"))),
        _header("WARC-Date", F.lit(DATE)),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1("payload"))),
        _header("X-Payload-Length", size),
        _header(
            "WARC-Refers-To",
            F.when(revisits, F.concat(F.lit("<urn:page:"), F.col("keeper").cast("string"), F.lit(">"))),
        ),
        _header("WARC-Profile", F.when(revisits, F.lit(REVISIT_PROFILE))),
        _header("Content-Length", F.length(body).cast("string")),
        F.lit("\r\n"),
    )
    return F.concat(F.encode(head, "UTF-8"), body)


def write_monolithic(records: DataFrame, path: str) -> None:
    """Records as WARC files, each one gzip stream over the whole file, one per task."""
    raw = records.select(F.col("record").cast("string").alias("value"))
    raw.write.option("lineSep", END.decode()).option("compression", "gzip").text(path)


CUT_OFF = "the archive is cut off"


@dataclass
class Record:
    """A record's headers by lower-case name, its body, and all its bytes with the end."""

    headers: dict[str, str]
    body: bytes
    raw: bytes


class RecordReader:
    """Records out of the bytes of a WARC stream, given part by part."""

    def __init__(self):
        self.held = bytearray()
        self.need = 0

    def feed(self, data: bytes) -> Iterator[Record]:
        self.held += data
        while len(self.held) >= max(self.need, 1):
            head = self.held.find(END)
            if head < 0:
                return
            lines = self.held[:head].decode("utf-8", "replace").split("\r\n")
            headers = dict(
                (name.strip().lower(), value.strip())
                for name, _, value in (line.partition(":") for line in lines[1:])
            )
            start = head + len(END)
            stop = start + int(headers.get("content-length", "0"))
            self.need = stop + len(END)
            if len(self.held) < self.need:
                return
            raw = bytes(self.held[: self.need])
            del self.held[: self.need]
            self.need = 0
            yield Record(headers, raw[start : stop], raw)

    def close(self) -> None:
        """A stream that ends within a record is an error."""
        if self.held:
            raise ValueError(CUT_OFF)


def inflated(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The content of a gzip file, inflated once as a stream, whatever members it has.

    A file that ends within a member is an error.
    """
    stream, ended = zlib.decompressobj(MEMBER), True
    for chunk in chunks:
        while chunk:
            yield stream.decompress(chunk)
            chunk, ended = stream.unused_data, stream.eof
            if ended:
                stream = zlib.decompressobj(MEMBER)
    if not ended:
        raise ValueError(CUT_OFF)


def _parts(content: pa.Scalar) -> Iterator[bytes]:
    data = memoryview(content.as_buffer())
    for start in range(0, len(data), READ_AT_ONCE):
        yield data[start : start + READ_AT_ONCE]


def normalise(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite whole-file gzip archives so that every record is a member of its own.

    Each archive is inflated once, by one task; one that is cut off is an error. ``target`` has a folder per archive with one file;
    members are separated by empty members, which readers skip.
    """

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                reader, name = RecordReader(), path.rsplit("/", 1)[-1]
                for part in inflated(_parts(content)):
                    members = [member(record.raw) for record in reader.feed(part)]
                    if members:
                        yield columns(
                            archive=pa.array([name] * len(members)), value=pa.array(members, pa.binary())
                        )
                reader.close()

    rows = _archives(spark, source).mapInArrow(rewrite, "archive string, value binary")
    rows = rows.withColumn("value", F.col("value").cast("string"))
    separator = SEPARATOR.decode("latin-1")
    writer = rows.write.option("lineSep", separator).option("encoding", "ISO-8859-1")
    writer.partitionBy("archive").text(target)


def _archives(spark: SparkSession, path: str) -> DataFrame:
    """``path``, ``content`` of archive files, a file per task as far as there are tasks."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.where("length > 0").select("path", "content")


def offset_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of normalised archives: where its member is and what its headers say.

    A member is read alone; empty members belong to the record before them and are skipped.
    """

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                rows = [_row(name, *found) for found in members_of(content.as_buffer())]
                if rows:
                    names = [field.split()[0] for field in INDEX_SCHEMA.split(", ")]
                    arrays = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_pydict(
                        {
                            n: pa.array(a, pa.int64() if n in LONGS else pa.string())
                            for n, a in zip(names, arrays, strict=True)
                        }
                    )

    return _archives(spark, path).mapInArrow(index, INDEX_SCHEMA)


LONGS = {"offset", "length", "payload_bytes"}


def members_of(content) -> Iterator[tuple[int, int, Record]]:
    """Offset, length and record of each member that holds one."""
    data, offset = memoryview(content), 0
    while offset < len(data):
        stream, reader, at, found = zlib.decompressobj(MEMBER), RecordReader(), offset, []
        while not stream.eof and at < len(data):
            part = data[at : at + READ_AT_ONCE]
            at += len(part)
            found += reader.feed(stream.decompress(part))
        reader.close()
        if not stream.eof:
            raise ValueError(CUT_OFF)
        at -= len(stream.unused_data)
        for record in found:
            yield offset, at - offset, record
        offset = at


def _row(path: str, offset: int, length: int, record: Record) -> tuple:
    headers = record.headers
    revisit = headers.get("warc-type") == "revisit"
    body = record.body
    size = int(headers.get("x-payload-length", "0")) if revisit else len(body)
    stated = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    digest = stated if revisit else hashlib.sha1(body).hexdigest()
    return (
        path, offset, length, _page(headers.get("warc-record-id")), headers.get("warc-target-uri"),
        headers.get("warc-type"), size, digest, _page(headers.get("warc-refers-to")),
    )


def _page(urn: str | None) -> str | None:
    return urn.removeprefix("<urn:page:").removesuffix(">") if urn else None


def archived(
    pages: DataFrame,
    folder: str | None = None,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    least: int = LEAST_BYTES,
) -> DataFrame:
    """Write ``pages`` as WARC archives under ``folder``, normalise them, and read them back.

    Gives the offset index (``archive``, ``offset``, ``length``, id, ``url``, ``record_type``,
    ``payload_bytes``, ``payload_digest``, ``refers_to``), which is also written to
    ``folder/index``; archives are in ``folder/records``. One record per row of ``pages``.

    A null html is an empty payload. A row with a null id has a record without id and is never the
    one that others refer to; rows that share the largest id of a payload all hold it. A null url
    has no header; line ends in a url become blanks. Extra columns are not archived. An empty table
    gives an empty index.
    """
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")
    records = page_records(pages, id_column, url_column, html_column, least)
    write_monolithic(records, f"{folder}/monolithic")
    normalise(spark, f"{folder}/monolithic", f"{folder}/records")
    offset_index(spark, f"{folder}/records").write.parquet(f"{folder}/index")
    kind = pages.schema[id_column].dataType
    index = spark.read.schema(INDEX_SCHEMA).parquet(f"{folder}/index")
    return index.withColumns(
        {"page_id": F.col("page_id").cast(kind), "refers_to": F.col("refers_to").cast(kind)}
    ).withColumnRenamed("page_id", id_column)
