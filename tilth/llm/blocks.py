"""Texts packed into compressed blocks, and arrays exchanged between blocks and key ranges.

Work that looks up something about every position of a text sends keys from blocks to
key ranges and answers back.  A block is written once, so its number stays the same
however often it is read; keys and answers travel as packed arrays, one row for each
(block, range) that has any.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.functions.store import cut
from tilth.llm.text import slices

#: A block is closed before the row that would take its texts over this size.
BLOCK_BYTES = 8 << 20
#: A key range serves about so many bytes of text.
RANGE_BYTES = 8 << 20
FEWEST_RANGES = 48


def shrink(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def grow(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def shrink_array(values: np.ndarray) -> bytes:
    """Equal bytes of all values side by side, compressed; numbers of one size have many zeros there."""
    values = np.ascontiguousarray(values)
    return shrink(values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes())


def grow_array(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(grow(data), np.uint8).reshape(size, -1).T).view(kind).ravel()


def shrink_sorted(keys: np.ndarray) -> bytes:
    """Ascending keys as their differences."""
    return shrink_array(np.diff(keys, prepend=keys[:1] * 0))


def grow_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(grow_array(data, np.uint64), dtype=np.uint64)


def pack_texts(docs: DataFrame, doc_id: str, text: str, block_bytes: int = BLOCK_BYTES, carry: list[str] | None = None) -> DataFrame:
    """A written table of blocks: ``block``, ``doc_ids``, ``lengths`` (bytes), ``size`` and ``texts`` (compressed, UTF-8).

    ``carry`` names columns that travel along, as a struct for each document in ``rows``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text", block_bytes):
            texts = [(x or "").encode() for x in batch.column("text").to_pylist()]
            lengths = pa.array([len(x) for x in texts], pa.int64())
            row = [pa.array([number]), pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), batch.column("doc_id")), pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), lengths), pa.array([sum(map(len, texts))]), pa.array([shrink(b"".join(texts))], pa.binary())]
            if carry:
                row.append(pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), batch.column("rows")))
            yield pa.RecordBatch.from_arrays(row, names=["block", "doc_ids", "lengths", "size", "texts", "rows"][: len(row)])
            number += 1

    taken = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *([F.struct(*carry).alias("rows")] if carry else []))
    fields = [T.StructField("block", T.LongType()), T.StructField("doc_ids", T.ArrayType(docs.schema[doc_id].dataType)), T.StructField("lengths", T.ArrayType(T.LongType())), T.StructField("size", T.LongType()), T.StructField("texts", T.BinaryType())]
    if carry:
        fields.append(T.StructField("rows", T.ArrayType(taken.schema["rows"].dataType)))
    packed = taken.mapInArrow(run, T.StructType(fields))
    return cut(packed)


def ranges_for(blocks: DataFrame, range_bytes: int = RANGE_BYTES) -> int:
    """Number of key ranges for the bytes of text in the blocks."""
    size = blocks.agg(F.sum("size")).first()[0] or 0
    return max(FEWEST_RANGES, -(-size // range_bytes))


def range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """The key range of hashes: equal parts of the upper 32 bits."""
    return ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
