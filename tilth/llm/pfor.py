"""Token ids in patched frame-of-reference blocks.

A run of ids is cut into blocks.  Of each block the minimum is subtracted, the
differences are packed with the width that a percentile of them fits, and what does
not fit is kept whole in an exception list.  A run's header indexes where each block
starts, so any range of ids is read by unpacking its blocks alone.

``write_ids`` sorts documents by id, encodes them and writes a table of pages, each
holding the ids of consecutive whole documents in such blocks; ``read_ids`` reads it.
The table is Parquet: a page is a row, and the packed runs are its binary columns, so
that a written shard appears whole or not at all when executors are lost.
"""

from __future__ import annotations

import functools
import struct
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.functions.store import new_path
from tilth.llm.text import Words, slices, tokenizer_path

WORDS = "word_bpe_49k.json"
#: Ids in a block, and the share of a block's differences that the packed width fits.
BLOCK, PERCENTILE = 512, 0.9
#: A page is closed after the document that brings it to so many ids.
PAGE = 1 << 18
HEAD = struct.Struct("<4sIQI")


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.uint8)


def _squeeze(table: np.ndarray, width: int) -> np.ndarray:
    """Rows of values as rows of bytes, ``width`` bits a value from the lowest bit on.

    64 values fill ``width`` words, so each of the 64 places shifts as a whole column.
    """
    rows, n = table.shape
    places = np.zeros((-(-n // 64) * 64, rows), np.uint64)
    places[:n] = table.T
    places = places.reshape(-1, 64, rows)
    words = np.zeros((len(places), width, rows), np.uint64)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        words[:, word] |= places[:, j] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= places[:, j] >> np.uint64(64 - shift)
    flat = np.ascontiguousarray(words.reshape(-1, rows).T).astype("<u8").view(np.uint8)
    return flat[:, : (n * width + 7) // 8]


def _stretch(packed: np.ndarray, n: int, width: int) -> np.ndarray:
    """The ``n`` values in each row of bytes."""
    rows, runs = len(packed), -(-n // 64)
    padded = np.zeros((rows, runs * width * 8), np.uint8)
    padded[:, : packed.shape[1]] = packed
    words = np.ascontiguousarray(padded.view("<u8").T).reshape(runs, width, rows)
    out, low = np.empty((runs, 64, rows), np.uint32), np.uint64((1 << width) - 1)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            value |= words[:, word + 1] << np.uint64(64 - shift)
        out[:, j] = value & low
    return out.reshape(runs * 64, rows)[:n].T


def pack(values: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> bytes:
    """Blocks of unsigned 32-bit values.  Header, block index, then the blocks one after another."""
    values = np.asarray(values, np.uint32)
    n, blocks = len(values), -(-len(values) // block)
    padded = np.zeros(blocks * block, np.uint32)
    padded[:n] = values
    padded[n:] = values[-1] if n else 0
    table = padded.reshape(blocks, block)
    least = table.min(axis=1) if blocks else np.zeros(0, np.uint32)
    diff = table - least[:, None]
    at = min(block - 1, int(percentile * block))
    width = _widths(np.partition(diff, at, axis=1)[:, at]) if blocks else np.zeros(0, np.uint8)
    over = (diff >> np.minimum(width, 31)[:, None] > 0) & (width < 32)[:, None]
    counts = over.sum(axis=1).astype(np.uint16)
    lengths = (block * width.astype(np.int64) + 7) // 8 + 6 * counts.astype(np.int64)
    starts = np.zeros(blocks + 1, np.uint64)
    np.cumsum(lengths, out=starts[1:])
    body = np.zeros(int(starts[-1]), np.uint8)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        if w:
            packed = _squeeze(diff[rows] & np.uint32((1 << int(w)) - 1), int(w))
            body[(starts[rows].astype(np.int64)[:, None] + np.arange(packed.shape[1])).ravel()] = packed.ravel()
    for b in np.flatnonzero(counts):
        where = np.flatnonzero(over[b]).astype("<u2")
        body[int(starts[b + 1]) - 6 * len(where) : int(starts[b + 1])] = np.frombuffer(where.tobytes() + diff[b][where].astype("<u4").tobytes(), np.uint8)
    index = least.astype("<u4").tobytes() + width.tobytes() + counts.astype("<u2").tobytes() + starts.astype("<u8").tobytes()
    return HEAD.pack(b"PFR1", block, n, blocks) + index + body.tobytes()


def unpack(data: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Values ``start`` to ``stop`` of a packed run; only the blocks that hold them are read."""
    magic, block, n, blocks = HEAD.unpack_from(data)
    if magic != b"PFR1":
        raise ValueError("not a packed run of ids")
    stop = n if stop is None else min(stop, n)
    if start >= stop:
        return np.zeros(0, np.uint32)
    first, last = start // block, -(-stop // block)
    at = HEAD.size
    least = np.frombuffer(data, "<u4", blocks, at)[first:last]
    width = np.frombuffer(data, np.uint8, blocks, at := at + 4 * blocks)[first:last]
    counts = np.frombuffer(data, "<u2", blocks, at := at + blocks)[first:last]
    starts = np.frombuffer(data, "<u8", blocks + 1, at := at + 2 * blocks)[first : last + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8, offset=at + 8 * (blocks + 1))
    out = np.zeros((last - first, block), np.uint32)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        if w:
            size = (block * int(w) + 7) // 8
            out[rows] = _stretch(body[starts[rows][:, None] + np.arange(size)], block, int(w))
    for b in np.flatnonzero(counts):
        tail = body[starts[b + 1] - 6 * int(counts[b]) : starts[b + 1]].tobytes()
        where = np.frombuffer(tail, "<u2", int(counts[b]))
        out[b][where] = np.frombuffer(tail, "<u4", int(counts[b]), 2 * int(counts[b]))
    out += least[:, None].astype(np.uint32)
    return out.ravel()[start - first * block : stop - first * block]


#: Signs that the vocabulary's pre-tokeniser keeps together behind a run of letters.
SIGNS = "!\"#$%&()*+,-./:;=?@[]^_{}~"


class WordTable:
    """Ids of texts by the tokenizers library; each distinct word is encoded once by a worker's table.

    The vocabulary drops white space, so no merge crosses it and words are independent;
    neither does one cross from letters to signs, so a word of letters with signs behind
    it is put together from the two.  Only the six ASCII white-space bytes split here;
    others stay inside a word, where the library sees them.
    """

    def __init__(self, path: str, end_id: int, size: int = 1_000_000) -> None:
        from tokenizers import Tokenizer

        self.model, self.end_id, self.size = Tokenizer.from_file(path), end_id, size
        self.closes = np.zeros(1 + max(self.model.get_vocab().values()), bool)
        self.closes[[i for token, i in self.model.get_vocab().items() if token.endswith("</w>")]] = True
        self._empty()

    def _empty(self) -> None:
        self.number: dict[str, int] = {"": 0}
        self.letters: dict[str, bytes] = {"": b""}
        self.flat, self.starts = np.zeros(0, np.uint32), np.zeros(2, np.int64)

    def _runs(self, runs: list[str]) -> None:
        """Learn runs of letters, or of signs: each ends with the one token that closes it."""
        for k in range(0, len(runs), 4096):
            part = runs[k : k + 4096]
            ids = np.array(self.model.encode(" ".join(part), add_special_tokens=False).ids, np.uint32)
            ends = 4 * np.flatnonzero(self.closes[ids]) + 4
            if len(ends) == len(part):
                flat = ids.tobytes()
                found = [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
            else:
                found = self._apart(part)
            self.letters.update(zip(part, found, strict=True))

    def _apart(self, words: list[str]) -> list[bytes]:
        return [np.array(x.ids, np.uint32).tobytes() for x in self.model.encode_batch(words, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        fresh = list(dict.fromkeys(words))
        stems = [w.rstrip(SIGNS) for w in fresh]
        # Letters only, and still so when normalised and lower-cased.
        plain = [not s or s.isalpha() and (s.isascii() or unicodedata.normalize("NFC", s).lower().isalpha()) for s in stems]
        tails = [w[len(s) :] for w, s in zip(fresh, stems, strict=True)]
        stems = [s.lower() if s.isascii() else s for s in stems]
        new = dict.fromkeys(x for s, t, p in zip(stems, tails, plain, strict=True) if p for x in (s, t))
        self._runs([x for x in new if x not in self.letters])
        others = [w for w, p in zip(fresh, plain, strict=True) if not p]
        other = dict(zip(others, self._apart(others), strict=True))
        found = [self.letters[s] + self.letters[t] if p else other[w] for w, s, t, p in zip(fresh, stems, tails, plain, strict=True)]
        self.number.update(zip(fresh, range(len(self.number), len(self.number) + len(fresh)), strict=True))
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(found), np.uint32)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum([len(x) // 4 for x in found])])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, the end id behind each text's (null: empty), and the offsets of texts.

        Words are cut and numbered as arrays; only distinct ones become strings.
        """
        words = Words(texts, lower=False)
        at, distinct = words.numbered()
        named = [w.decode() for w in distinct]
        self._learn([w for w in named if w not in self.number])
        numbers = np.fromiter(map(self.number.__getitem__, named), np.int64, len(named))[at]
        sizes = self.starts[numbers + 1] - self.starts[numbers]
        ends = np.zeros(len(numbers) + 1, np.int64)
        np.cumsum(sizes, out=ends[1:])
        ids = self.flat[np.arange(ends[-1]) + np.repeat(self.starts[numbers] - ends[:-1], sizes)]
        bounds = ends[words.bounds]
        offsets = bounds + np.arange(len(texts) + 1)
        out = np.full(offsets[-1], self.end_id, np.uint32)
        out[np.arange(len(ids)) + np.repeat(np.arange(len(texts)), np.diff(bounds))] = ids
        if len(self.number) > self.size:
            self._empty()
        return out, offsets


@functools.lru_cache(maxsize=1)
def word_table(path: str, end_id: int) -> WordTable:
    """The table of this Python worker, which serves its tasks one after another."""
    return WordTable(path, end_id)


PAGES = "shard int, page long, before long, n_ids long, doc_ids array<bigint>, lengths binary, ids binary"


def write_ids(docs: DataFrame, path: str, encoder: Callable[[], object] | None = None, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, end_id: int = 1, page: int = PAGE) -> None:
    """Write the ids of all texts (null: empty) in ascending document order as pages below ``path``.

    A page row holds its shard and number, the ids in the shard before it, its document
    ids, and two packed runs: lengths in ids and the ids.  Shards follow each other in
    document order.  Equal document ids are ordered by a hash of their texts, null ids
    come first; an empty table writes no page.  The texts are exchanged once, by range.
    """
    tokenizer = tokenizer or tokenizer_path(WORDS)
    encoder = encoder or (lambda: word_table(tokenizer, end_id))
    sorted_docs = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).repartitionByRange("id").sortWithinPartitions("id", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, shard, number, before = encoder(), TaskContext.get().partitionId(), 0, 0
        ids: list[np.ndarray] = []
        names: list[int | None] = []
        lengths: list[int] = []

        def close() -> pa.RecordBatch:
            nonlocal number, before
            run = np.concatenate(ids)
            row = [shard, number, before, len(run), list(names), pack(np.array(lengths)), pack(run)]
            number, before = number + 1, before + len(run)
            for held in (ids, names, lengths):
                held.clear()
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=["shard", "page", "before", "n_ids", "doc_ids", "lengths", "ids"])

        size = 0
        for batch in slices(batches, "text"):
            flat, offsets = table.encode(batch.column("text"))
            docs_here, at = batch.column("id").to_pylist(), 0
            while at < len(docs_here):
                # As many whole documents as bring the page to its size.
                stop = min(len(docs_here), max(at + 1, int(np.searchsorted(offsets, offsets[at] + page - size))))
                ids.append(flat[offsets[at] : offsets[stop]])
                names += docs_here[at:stop]
                lengths += np.diff(offsets[at : stop + 1]).tolist()
                size += int(offsets[stop] - offsets[at])
                at = stop
                if size >= page:
                    yield close()
                    size = 0
        if names:
            yield close()

    sorted_docs.mapInArrow(run, PAGES).write.parquet(path)


def read_ids(spark: SparkSession, path: str, doc_id: str = "doc_id") -> DataFrame:
    """Documents of a written table: id, ``start`` (ids before it), ``n_tokens``, ``ids`` (little-endian unsigned 32-bit)."""
    pages = spark.read.schema(PAGES).parquet(path)
    # One row for each written shard: as many as the writing stage had tasks, 16 bytes each.
    totals = pages.groupBy("shard").agg(F.sum("n_ids").alias("total"))
    starts = totals.selectExpr("shard as s", "sum(total) over (order by shard) - total as base")
    placed = pages.join(F.broadcast(starts), pages["shard"] == F.col("s")).select((F.col("base") + F.col("before")).alias("start"), "doc_ids", "lengths", "ids")
    schema = T.StructType([T.StructField(doc_id, T.LongType()), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, names, lengths, ids in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                flat = unpack(ids).astype("<u4")
                offsets = np.zeros(len(names) + 1, np.int64)
                np.cumsum(unpack(lengths), out=offsets[1:])
                values = pa.Array.from_buffers(pa.binary(), len(names), [None, pa.py_buffer((4 * offsets).astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(start + offsets[:-1]), pa.array(np.diff(offsets)), values], names=schema.names)

    return placed.mapInArrow(run, schema)


def digests(docs: DataFrame) -> DataFrame:
    """Write the documents' ids below the shared folder, read them back, and digest each document's ids."""
    spark = docs.sparkSession
    path = new_path(spark, "ids")
    write_ids(docs, path)
    back = read_ids(spark, path)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
