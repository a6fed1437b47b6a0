"""WARC archives: writing, reading, and one index merged from the files' sorted runs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.merge import merged
from llm.scratch import Scratch

# Payloads of fewer bytes are stored each time.
LEAST_REVISITED = 100
# A file is read by one task.
RECORDS_PER_FILE = 4_000
# Index rows that one task merges.
ROWS_PER_MERGE = 200_000
# Groups of equal payloads sent to all executors (some 150 bytes each).
BROADCAST_ROWS = 200_000

_END = "\r\n\r\n"
_INDEX = (
    "url_key string, captured string, page_id bigint, url string, payload_bytes bigint,"
    " payload_digest string, record_type string, refers_to bigint, file string,"
    " offset bigint, length bigint"
)
_NAMES = [f.split()[0] for f in _INDEX.split(", ")]
_TYPES = [pa.int64() if f.endswith("bigint") else pa.string() for f in _INDEX.split(", ")]
_CHUNK = 1 << 20


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for a null."""
    safe = F.regexp_replace(value, "[\\x00-\\x1F]+", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def records(pages: DataFrame, captured: Column, scratch: Scratch) -> DataFrame:
    """(record): one WARC record per page, without the empty lines that end it.

    Of pages with equal payloads of LEAST_REVISITED bytes or more, those with the smallest page_id
    are responses and others revisits of it.  Groups of equal payloads are found from digests;
    if they are few, pages are not shuffled.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    hashed = pages.select(
        "page_id",
        "url",
        payload.alias("payload"),
        F.octet_length(payload).alias("size"),
        F.sha2(payload, 256).alias("digest"),
        captured.alias("captured"),
    )
    repeated = scratch.write(
        hashed.filter(F.col("size") >= LEAST_REVISITED)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("digest", "first")
    )
    few = repeated.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    typed = hashed.join(F.broadcast(repeated) if few else repeated, "digest", "left")
    again = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first")), F.lit(True)) & F.col(
        "first"
    ).isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "),
        F.col("size").cast("string"),
        F.lit(_END),
    )
    block = F.when(again, http).otherwise(F.concat(http, F.col("payload")))
    profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    return typed.select(
        F.concat(
            F.lit("WARC/1.1\r\n"),
            _header("WARC-Type", F.when(again, "revisit").otherwise("response")),
            _header("WARC-Record-ID", _urn(F.col("page_id"))),
            _header("WARC-Date", F.col("captured")),
            _header("WARC-Target-URI", F.col("url")),
            _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
            _header("WARC-Profile", F.when(again, profile)),
            _header("WARC-Refers-To", F.when(again, _urn(F.col("first")))),
            _header("Content-Type", F.lit("application/http;msgtype=response")),
            _header("Content-Length", F.octet_length(block).cast("string")),
            F.lit("\r\n"),
            block,
        ).alias("record")
    )


def write_archives(pages: DataFrame, folder: str, captured: Column, scratch: Scratch) -> None:
    """Gzipped WARC files of at most RECORDS_PER_FILE records.

    The two empty lines that end a record are the line separator of the text writer.
    """
    (
        records(pages, captured, scratch)
        .write.option("lineSep", _END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(folder)
    )


def url_key(url: str) -> str:
    """Host in reverse, then path and query: equal for the spellings of one address."""
    parts = urlsplit(url.strip())
    host = (parts.hostname or "").removeprefix("www.")
    path = re.sub("/+", "/", parts.path).rstrip("/").lower()
    query = "&".join(sorted(q for q in parts.query.lower().split("&") if q))
    return ",".join(reversed(host.split("."))) + ")" + (path or "/") + (f"?{query}" if query else "")


def _safe_key(url: str | None) -> str:
    try:
        return url_key(url or "")
    except ValueError:  # not an address: kept as it is written
        return url or ""


class _Stream:
    """Reads a gzipped file piece by piece."""

    def __init__(self, data: memoryview):
        self.data, self.at, self.buffer = data, 0, b""
        self.inflate = zlib.decompressobj(31)

    def fill(self) -> bool:
        if self.inflate.eof and self.inflate.unused_data:
            left, self.inflate = self.inflate.unused_data, zlib.decompressobj(31)
            self.buffer += self.inflate.decompress(left)
            return True
        if self.at >= len(self.data):
            return False
        self.buffer += self.inflate.decompress(self.data[self.at : self.at + _CHUNK])
        self.at += _CHUNK
        return True

    def until(self, mark: bytes) -> bytes | None:
        """What comes before the next `mark`, None at the end of the file."""
        while (found := self.buffer.find(mark)) < 0:
            if not self.fill():
                if self.buffer:
                    raise ValueError("a record is cut off")
                return None
        out, self.buffer = self.buffer[:found], self.buffer[found + len(mark) :]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if not self.fill():
                raise ValueError("a record is cut off")
        out, self.buffer = self.buffer[:n], self.buffer[n:]
        return out


def read_records(data: memoryview) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of the records of one file, one in memory at a time."""
    stream, at, end = _Stream(data), 0, _END.encode()
    while (head := stream.until(end)) is not None:
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("this is no WARC record")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        block = stream.take(int(headers["Content-Length"]))
        if stream.take(len(end)) != end:
            raise ValueError("a record is longer than it says")
        size = len(head) + len(block) + 2 * len(end)
        yield at, size, headers, block
        at += size


def _id(urn: str | None) -> int | None:
    value = urn.removeprefix("<urn:page:").removesuffix(">") if urn else ""
    return int(value) if value else None


def _entry(file: str, record: tuple[int, int, dict[str, str], bytes]) -> tuple:
    offset, length, headers, block = record
    http, _, payload = block.partition(_END.encode())
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if headers["WARC-Type"] == "response":
        if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"payload of {headers['WARC-Record-ID']} is damaged")
    url = headers.get("WARC-Target-URI")
    return (
        _safe_key(url),
        headers.get("WARC-Date", ""),
        _id(headers["WARC-Record-ID"]),
        url,
        size,
        digest,
        headers["WARC-Type"],
        _id(headers.get("WARC-Refers-To")),
        file,
        offset,
        length,
    )


def _order(entry: tuple) -> tuple:
    page = entry[2]
    return entry[0], entry[1], page is None, page or 0


def _batch(rows: list[tuple], more: list[list] = ()) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES
    )


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """The index of every archive file as a run sorted by URL key, time and page_id.

    Payloads of responses are checked against their digest; a damaged file is an error.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                file = batch.column("path")[i].as_py()
                data = memoryview(batch.column("content")[i].as_buffer())
                yield _batch(sorted((_entry(file, r) for r in read_records(data)), key=_order))

    # One file at a time: a batch ends after each row of this size.
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(read, _INDEX)


def merged_index(runs_written: DataFrame, rows_per_merge: int = ROWS_PER_MERGE) -> DataFrame:
    """All runs in one order, with `part` and `row`: sorting by these gives the histories.

    The key space is cut into ranges that hold about `rows_per_merge` rows each.  The key
    ends with the page_id, so that a URL captured very often is cut too.  A range's pieces
    of the runs are merged by one task with a tree of losers.
    """
    count = runs_written.count()
    ranges = max(1, math.ceil(count / rows_per_merge))
    key = ["url_key", "captured", "page_id"]
    dealt = runs_written.repartitionByRange(ranges, *key).sortWithinPartitions(
        "file", "url_key", "captured", F.col("page_id").asc_nulls_last()
    )
    part = dealt.withColumn("part", F.spark_partition_id())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[str, list[tuple]] = {}
        number = 0
        for batch in batches:
            if batch.num_rows:
                number = batch.column("part")[0].as_py()
                rows = zip(*[batch.column(c).to_pylist() for c in _NAMES], strict=True)
                for row in rows:
                    pieces.setdefault(row[8], []).append(row)
        out: list[tuple] = []
        done = 0

        def full() -> pa.RecordBatch:
            base = _batch(out)
            places = pa.array(range(done - len(out), done), pa.int64())
            return pa.RecordBatch.from_arrays(
                [*base.columns, pa.array([number] * len(out), pa.int32()), places],
                names=[*_NAMES, "part", "row"],
            )

        for _, row in merged(((_order(r), r) for r in piece) for piece in pieces.values()):
            out.append(row)
            done += 1
            if len(out) == 10_000:
                yield full()
                out = []
        yield full()

    return part.mapInArrow(merge, f"{_INDEX}, part int, row bigint")


def archived(
    pages: DataFrame, captured: Column, folder: str | None = None
) -> DataFrame:
    """Write `pages` (page_id, url, html) as WARC files, read them, and merge their index.

    One row per page in the order of `part`, `row`: URL key, capture time, page_id.  The
    payload is the html in UTF-8.  A null html is an empty payload; a null URL has no
    header and sorts first; a null page_id stays null, sorts last and is never referred to
    unless no other exists, in which case all copies are responses.  Rows that repeat a page_id are separate
    records; equal ones are all responses if theirs is the smallest id.  Control characters in a URL
    are written as spaces.  Further columns of `pages` are not archived.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    folder = folder or scratch.new_path()
    write_archives(pages, folder, captured, scratch)
    return merged_index(scratch.write(runs(pages.sparkSession, folder)))
