"""Encoding and decoding documents with a SentencePiece model."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from llm.transducer import Transducer

# Text that is encoded before its tokens are handed over.
SLICE_BYTES = 4 << 20
ADDED = ("token_ids", "n_tokens", "n_byte_tokens", "ids_crc32", "round_trip")


@lru_cache(maxsize=2)
def machine(model: bytes) -> Transducer:
    """The compiled model, once per Python process."""
    return Transducer(model)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    step = max(1, int(batch.num_rows * SLICE_BYTES / max(batch.nbytes, 1)))
    for i in range(0, batch.num_rows, step):
        yield batch.slice(i, step)


class Decoder:
    """Bytes of many token lists at once."""

    def __init__(self, pieces: Transducer):
        self.pieces = pa.array(pieces.texts, pa.binary())
        self.sizes = np.fromiter(map(len, pieces.texts), np.int64, len(pieces.texts))
        self.is_byte = np.zeros(len(pieces.texts), dtype=bool)
        self.is_byte[list(pieces.byte_ids.values())] = True
        self.prefix = pieces.prefix

    def texts(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The text of each list; `ends` are the lists' ends in `ids`."""
        joined = self.pieces.take(pa.array(ids, pa.int32()))
        data = joined.buffers()[2]
        raw = data.to_pybytes() if data is not None else b""
        sums = np.r_[0, np.cumsum(self.sizes[ids])]
        out, start = [], 0
        for end in ends.tolist():
            text = raw[sums[start] : sums[end]]
            if self.prefix and end > start and text[:1] == b" " and not self.is_byte[ids[start]]:
                text = text[1:]
            out.append(text)
            start = end
        return out


def encoded(docs: DataFrame, model_path: str, *, ids: bool = True) -> DataFrame:
    """`docs` with token_ids (unless `ids` is false) and what can be said of them.

    token_ids: the ids of `text` on the shortest path of the model's transducer, see
    `llm.transducer`; n_tokens and n_byte_tokens count all and byte-fallback ones, ids_crc32
    is the CRC-32 of the ids as little-endian 32-bit numbers, and round_trip says that decoding them gives
    the text again.  It does not where a text has U+2581, which decodes as a space, or
    where the model squeezes spaces.

    A null text gives a null list, 0 tokens, the CRC-32 of nothing and a null round_trip; an empty
    one has no tokens.  Whole texts are encoded, long ones in memory proportional to
    their length.  Rows are independent: no shuffle, repeats do no harm.  Other columns pass
    through; existing columns of the added names are replaced.

    `model_path` is read by the driver; the model itself, some 500 kB, goes to the tasks.
    """
    base = docs.drop(*ADDED)
    held = docs.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())
    names = base.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = machine(held.value)
        decoder = Decoder(pieces)
        for batch in batches:
            for part in _slices(batch):
                yield _encoded_part(part, pieces, decoder)

    def _encoded_part(part, pieces, decoder):
        column = part.column("text")
        texts = column.to_pylist()
        packed = [pieces.encode_packed(t) if t else b"" for t in texts]
        flat = np.frombuffer(b"".join(packed), dtype=np.int32)
        sizes = np.fromiter((len(p) // 4 for p in packed), np.int64, len(packed))
        ends = np.cumsum(sizes)
        null = np.fromiter((t is None for t in texts), bool, len(texts))
        back = decoder.texts(flat, ends)
        raw = column.cast(pa.binary()).to_pylist()
        same = [a == b for a, b in zip(raw, back, strict=True)]
        bytes_before = np.r_[0, np.cumsum(decoder.is_byte[flat])]
        arrays = [part.column(c) for c in names]
        if ids:
            offsets = pa.array(np.r_[0, ends], pa.int32(), mask=np.r_[null, False])
            arrays.append(pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32())))
        arrays += [
            pa.array(sizes, pa.int64()),
            pa.array(np.diff(bytes_before[np.r_[0, ends]]), pa.int64()),
            pa.array([zlib.crc32(p) for p in packed], pa.int64()),
            pa.array(same, pa.bool_(), mask=null),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=[*names, *added])

    types = ["array<int>", "bigint", "bigint", "bigint", "boolean"]
    added = list(ADDED if ids else ADDED[1:])
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema]
    fields += [f"{c} {t}" for c, t in zip(added, types if ids else types[1:], strict=True)]
    return base.mapInArrow(run, ", ".join(fields))


def decoded(tokens: DataFrame, model_path: str, *, into: str = "text") -> DataFrame:
    """`tokens` with column `into`: the text of token_ids.

    Null lists give null, empty ones an empty text; a null id or one the model does not have
    raises an error.  Bytes that are not UTF-8 become U+FFFD.
    """
    base = tokens.drop(into)
    held = tokens.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())
    names = base.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(machine(held.value))
        for batch in batches:
            for part in _slices(batch):
                lists = part.column("token_ids")
                rows = lists.to_pylist()
                flat = np.array([i for r in rows for i in r or ()], dtype=np.int64)
                if len(flat) and (flat.min() < 0 or flat.max() >= len(decoder.sizes)):
                    raise ValueError("token_ids holds an id that the model does not have")
                ends = np.cumsum([len(r or ()) for r in rows], dtype=np.int64)
                texts = [t.decode(errors="replace") for t in decoder.texts(flat, ends)]
                null = np.fromiter((r is None for r in rows), bool, len(rows))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in names], pa.array(texts, pa.string(), mask=null)],
                    names=[*names, into],
                )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema]
    return base.mapInArrow(run, ", ".join([*fields, f"`{into}` string"]))
