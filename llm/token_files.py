"""Token ids of documents in files of independent zstandard frames with a seek table.

A file is a zstandard file in the public seekable format: frames, then the seek table as a
skippable frame, with each frame's sizes and the low half of the XXH64 of its content.  A frame
holds ids of one document, a long document several frames.  Before the seek table, one more skippable
frame lists the file's documents: doc_id, number of ids and of frames.  A reader takes
both tables from the end of the file and decompresses the frames of the documents it wants.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.scratch import Scratch
from llm.shipping import ship
from llm.word_encoder import WordEncoder

# Fixed values of the seekable format.
SKIPPABLE, SEEK_TABLE, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80
# Bytes of frames after which a file ends, and of ids in a frame.
FILE_BYTES, FRAME_BYTES = 16 << 20, 1 << 20
LEVEL = 3
# Text that is encoded at once.
SLICE_BYTES = 6 << 20
# Rows that one task sorts and writes.
ROWS_PER_TASK = 20_000
# Wanted documents that are sent to all executors (8 bytes each).
WANTED_SENT = 1_000_000
END_ID = 0

# Directory: a head, then arrays of doc_id, its presence, number of ids, number of frames.
_HEAD = struct.Struct("<4sBIIQ")
_MAGIC = b"TOK1"
_FOOTER = struct.Struct("<IBI")


class FileBuilder:
    """The bytes of one file, document by document."""

    def __init__(self, width: int, part: int, number: int):
        self.width, self.part, self.number = width, part, number
        self.compressor = zstandard.ZstdCompressor(
            level=LEVEL, write_content_size=True, write_checksum=False
        )
        self.frames: list[bytes] = []
        self.seek: list[bytes] = []
        self.docs: list[tuple[int | None, int, int]] = []
        self.size = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        step = FRAME_BYTES // self.width
        frames = range(0, len(ids), step)
        for i in frames:
            content = ids[i : i + step].astype(f"<u{self.width}", copy=False).tobytes()
            packed = self.compressor.compress(content)
            check = xxhash.xxh64_intdigest(content) & 0xFFFFFFFF
            self.frames.append(packed)
            self.seek.append(struct.pack("<III", len(packed), len(content), check))
            self.size += len(packed)
        self.docs.append((doc_id, len(ids), len(frames)))

    def content(self) -> bytes:
        """The whole file."""
        ids = np.array([0 if d is None else d for d, _, _ in self.docs], "<i8")
        there = np.array([d is not None for d, _, _ in self.docs], "u1")
        counts = np.array([n for _, n, _ in self.docs], "<u8")
        frames = np.array([k for _, _, k in self.docs], "<u4")
        head = _HEAD.pack(_MAGIC, self.width, self.part, self.number, len(self.docs))
        plain = b"".join(a.tobytes() for a in (ids, there, counts, frames))
        directory = head + self.compressor.compress(plain)
        table = b"".join(self.seek) + _FOOTER.pack(len(self.seek), CHECKSUMS, SEEKABLE)
        return b"".join(
            [
                *self.frames,
                struct.pack("<II", SKIPPABLE, len(directory)) + directory,
                struct.pack("<II", SEEK_TABLE, len(table)) + table,
            ]
        )


class TokenFile:
    """Reads a file from its bytes; nothing but the directory is decompressed to open it."""

    def __init__(self, data: memoryview):
        self.data = data
        if len(data) < _FOOTER.size or _FOOTER.unpack(data[-_FOOTER.size :])[1:] != (
            CHECKSUMS,
            SEEKABLE,
        ):
            raise ValueError("this file has no seek table with checksums")
        count = _FOOTER.unpack(data[-_FOOTER.size :])[0]
        table_size = 12 * count + _FOOTER.size
        start = len(data) - table_size
        if struct.unpack("<II", data[start - 8 : start]) != (SEEK_TABLE, table_size):
            raise ValueError("the seek table is damaged")
        table = np.frombuffer(data[start : start + 12 * count], "<u4").reshape(-1, 3)
        self.packed, self.plain, self.checks = table.T.astype(np.int64)
        self.ends = np.cumsum(self.packed)
        self.unpacker = zstandard.ZstdDecompressor()
        self.decompressed = 0
        at = int(self.ends[-1]) if count else 0
        magic, size = struct.unpack("<II", data[at : at + 8])
        if magic != SKIPPABLE or at + 8 + size != start - 8:
            raise ValueError("the directory is damaged")
        head = data[at + 8 : at + 8 + size]
        magic, self.width, self.part, self.number, docs = _HEAD.unpack(head[: _HEAD.size])
        if magic != _MAGIC:
            raise ValueError("this is no file of token ids")
        plain = self.unpacker.decompress(bytes(head[_HEAD.size :]))
        self.doc_ids = np.frombuffer(plain, "<i8", docs)
        self.there = np.frombuffer(plain, "u1", docs, 8 * docs).astype(bool)
        self.counts = np.frombuffer(plain, "<u8", docs, 9 * docs).astype(np.int64)
        self.frames = np.frombuffer(plain, "<u4", docs, 17 * docs).astype(np.int64)
        self.first_frame = np.cumsum(self.frames) - self.frames

    def frame(self, k: int) -> bytes:
        end = int(self.ends[k])
        content = self.unpacker.decompress(bytes(self.data[end - int(self.packed[k]) : end]))
        self.decompressed += 1
        if (
            len(content) != self.plain[k]
            or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.checks[k]
        ):
            raise ValueError(f"frame {k} is damaged")
        return content

    def ids(self, doc: int) -> np.ndarray:
        """Ids of the file's document number `doc`."""
        first = int(self.first_frame[doc])
        content = b"".join(self.frame(k) for k in range(first, first + int(self.frames[doc])))
        return np.frombuffer(content, f"<u{self.width}")


@lru_cache(maxsize=2)
def encoder(model: str) -> WordEncoder:
    """The tokenizer, once per Python process."""
    return WordEncoder(model)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    step = max(1, int(batch.num_rows * SLICE_BYTES / max(batch.nbytes, 1)))
    for i in range(0, batch.num_rows, step):
        yield batch.slice(i, step)


def write(docs: DataFrame, model_path: str, folder: str, end_id: int = END_ID) -> None:
    """Token files of `docs` (doc_id, text) in `folder`, documents in ascending doc_id order.

    Each document's ids end with `end_id`; a null text is an empty one.  A null doc_id comes
    first.  Documents of one doc_id stand in the order of the XXH64 of their texts, then of the texts,
    so that the order is the same in every run; that also spreads a doc_id that very many
    rows share.  Files follow each other by (part, number) in their directories.

    A task holds a slice of texts, and the frames of the file it is at (FILE_BYTES, more only if one
    document has more).  Files are published by Spark's commit protocol: a task that is lost or
    runs twice leaves nothing.
    """
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(Path(model_path).read_text())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(held.value)
        width = max(words.dtype.itemsize, 4 if end_id >= 1 << 16 else 2)
        kind = np.dtype(f"<u{width}")
        last = np.array([end_id], kind)
        part, number = TaskContext.get().partitionId(), 0
        file = FileBuilder(width, part, number)

        def full() -> pa.RecordBatch:
            # The writer adds the last four bytes of the file, see below.
            return pa.RecordBatch.from_arrays([pa.array([file.content()[:-4]])], names=["body"])

        for batch in batches:
            for texts in _slices(batch):
                ids, ends = words.encode(texts.column("text"))
                start = 0
                for doc_id, end in zip(texts.column("doc_id").to_pylist(), ends.tolist()):
                    file.add(doc_id, np.r_[ids[start:end].astype(kind), last])
                    start = end
                    if file.size >= FILE_BYTES:
                        yield full()
                        number += 1
                        file = FileBuilder(width, part, number)
        if file.docs:
            yield full()

    key = ["doc_id", "_hash"]
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("_hash"))
    tasks = max(1, -(-docs.count() // ROWS_PER_TASK), spark.sparkContext.defaultParallelism)
    ordered = rows.repartitionByRange(tasks, *key).sortWithinPartitions(*key, "text")
    (
        ordered.select("doc_id", "text")
        .mapInArrow(run, "body binary")
        .select(F.col("body").cast("string"))
        # A row is a file, and what ends a row is the number that ends a seekable file.
        .write.option("lineSep", struct.pack("<I", SEEKABLE).decode("latin-1"))
        .option("encoding", "ISO-8859-1")
        .option("maxRecordsPerFile", 1)
        .text(folder)
    )


_READ = (
    "part int, number int, place int, doc_id bigint, before bigint, n_tokens bigint,"
    " ids_crc32 bigint"
)


def read(
    spark: SparkSession, folder: str, wanted: Sequence[int] | None = None, *, ids: bool = False
) -> DataFrame:
    """Documents of the files in `folder`, all or those whose doc_id is in `wanted`.

    part, number: the file; place: the document's place in it; before: ids of the file that stand
    before the document; n_tokens; ids_crc32: CRC-32 of its ids as little-endian 32-bit numbers;
    token_ids too if `ids`.  Only frames of documents that are asked for are decompressed; each is
    checked.  A damaged file is an error.
    """
    ship(spark)
    if wanted is not None and len(wanted) > WANTED_SENT:
        raise ValueError(f"at most {WANTED_SENT} documents can be named; filter what is read")
    asked = None if wanted is None else np.unique(np.array(wanted, np.int64))
    held = spark.sparkContext.broadcast(asked)
    names = [f.split()[0] for f in _READ.split(", ")] + ["token_ids"] * ids

    def rows(file: TokenFile) -> Iterator[tuple]:
        before = np.cumsum(file.counts) - file.counts
        chosen = np.arange(len(file.doc_ids))
        if held.value is not None:
            chosen = np.flatnonzero(file.there & np.isin(file.doc_ids, held.value))
        for doc in chosen.tolist():
            found = file.ids(doc).astype("<u4")
            if len(found) != file.counts[doc]:
                raise ValueError("the directory and the frames differ")
            doc_id = int(file.doc_ids[doc]) if file.there[doc] else None
            row = (file.part, file.number, doc, doc_id, int(before[doc]), len(found))
            yield (*row, zlib.crc32(found)) + ((found.astype(np.int64),) if ids else ())

    kinds = [pa.int32()] * 3 + [pa.int64()] * 4 + [pa.list_(pa.int64())] * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = memoryview(batch.column("content")[i].as_buffer())
                out: list[tuple] = []
                for row in rows(TokenFile(data)):
                    out.append(row)
                    if len(out) == (200 if ids else 20_000):
                        yield packed(out)
                        out = []
                yield packed(out)

    def packed(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    schema = _READ + (", token_ids array<bigint>" if ids else "")
    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.mapInArrow(run, schema)


def stored_tokens(
    docs: DataFrame, model_path: str, folder: str | None = None, *, end_id: int = END_ID
) -> DataFrame:
    """Write `docs` (doc_id, text) as token files, read them, and say where each document lies.

    One row per document: doc_id, start (ids of all documents before it), n_tokens (with the
    end id), ids_crc32, and its file (part, number) and place there.  See `write` for the order.

    A null or empty text is its end id alone.  Repeated rows are documents of their own.  Whole
    texts are encoded, long ones in several frames.  Further columns, whatever their names, are
    not read.  Without documents there are no files and no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "tokens")
    folder = folder or scratch.new_path()
    write(docs, model_path, folder, end_id)
    found = scratch.write(read(spark, folder))
    # One row per file.
    totals = found.groupBy("part", "number").agg(F.sum("n_tokens").alias("_n"))
    earlier = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "part", "number", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    return found.join(offsets, ["part", "number"]).select(
        "doc_id",
        (F.col("before") + F.col("_offset")).alias("start"),
        "n_tokens",
        "ids_crc32",
        "part",
        "number",
        "place",
    )
