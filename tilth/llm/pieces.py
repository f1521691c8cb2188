"""SentencePiece encoding and decoding through a table of distinct chunks.

Where no piece holds a white-space marker behind another character, no merge crosses
the start of a run of markers, and a text's ids are the ids of its marked words in
order.  Each worker keeps a table of the distinct marked words it has met, lets the
library segment each of them once, and joins the ids back by position.  The table
is emptied when it is full, so memory is bounded whatever the vocabulary.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.llm.text import slices, tokenizer_path

MARK = "▁"
MODEL = "piece_bpe_32k.model"
#: The table is emptied after the piece of input that takes it over so many chunks.
TABLE_SIZE = 250_000


class ChunkTable:
    """Ids and decoded text of chunks; each distinct chunk goes through the library once."""

    def __init__(self, model_path: str, size: int = TABLE_SIZE) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.size = size
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        # Nothing is normalised, and a text is encoded as its characters behind one marker.
        plain = self.model.normalize("a  b\n é") == MARK + "a" + 2 * MARK + "b\n" + MARK + "é"
        self.splits = plain and not any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces)
        self.end = self.model.eos_id()
        # A line break is no piece, so it ends every merge and shields a chunk from the leading marker.
        self.shield = len(self.model.encode("\n"))
        self._empty()

    def _empty(self) -> None:
        self.number: dict[str, int] = {}
        self.texts: list[str] = []
        self.flat, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def chunks(self, text: str) -> list[str]:
        """Runs of markers with the word behind them; line breaks stand alone."""
        return re.findall("▁*[^▁\n]+|▁+|\n", (" " + text).replace(" ", MARK)) if text else []

    def _learn(self, chunks: list[str]) -> None:
        fresh = list(dict.fromkeys(chunks))
        found = self.model.encode(["\n" + c for c in fresh], num_threads=1)
        self.texts += [x[1:] for x in self.model.decode(found, num_threads=1)]
        self.number.update(zip(fresh, range(len(self.number), len(self.texts)), strict=True))
        ids = [x[self.shield :] for x in found]
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.int32)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum([len(x) for x in ids])])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """All ids in one array, its offsets by text, and what each text's ids decode to.

        The end id closes each text.
        """
        offsets = np.zeros(len(texts) + 1, np.int64)
        if not self.splits:
            ids = [[*x, self.end] for x in self.model.encode(texts, num_threads=1)] if texts else []
            np.cumsum([len(x) for x in ids], out=offsets[1:])
            return np.fromiter(chain.from_iterable(ids), np.int32), offsets, self.model.decode(ids, num_threads=1) if ids else []
        parts = [self.chunks(x) for x in texts]
        flat = list(chain.from_iterable(parts))
        numbers = np.fromiter(map(self.number.get, flat, repeat(-1)), np.int64, len(flat))
        missed = np.flatnonzero(numbers < 0).tolist()
        if missed:
            new = [flat[i] for i in missed]
            self._learn(new)
            numbers[missed] = [self.number[c] for c in new]
        sizes = self.starts[numbers + 1] - self.starts[numbers]
        ends = np.zeros(len(flat) + 1, np.int64)
        np.cumsum(sizes, out=ends[1:])
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(x) for x in parts], out=bounds[1:])
        ids = self.flat[np.arange(ends[-1]) + np.repeat(self.starts[numbers] - ends[:-1], sizes)]
        offsets[:] = ends[bounds] + np.arange(len(texts) + 1)
        out = np.full(offsets[-1], self.end, np.int32)
        out[np.arange(len(ids)) + np.repeat(np.arange(len(texts)), np.diff(ends[bounds]))] = ids
        # The first marker was put there by the encoder, and the decoder takes it away.
        words, numbers = self.texts, numbers.tolist()
        decoded = ["".join(map(words.__getitem__, numbers[a:b]))[1:] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        if len(self.texts) > self.size:
            self._empty()
        return out, offsets, decoded


@functools.lru_cache(maxsize=1)
def chunk_table(model_path: str) -> ChunkTable:
    """The table of this Python worker, which serves its tasks one after another."""
    return ChunkTable(model_path)


def encode(docs: DataFrame, text: str = "text", model_path: str | None = None) -> DataFrame:
    """``docs`` with columns ``piece_ids`` (array of int, end id included) and ``decoded``.

    The ids are those of the library for the whole text, without sampling and with an
    end id only; ``decoded`` is the library's decoding of these ids.  A null or empty
    text has the end id alone and decodes to an empty text.  Columns of these two
    names in ``docs`` are replaced, all others stay as they are.  Rows are
    independent: repeated rows give repeated results.
    """
    path = model_path or tokenizer_path(MODEL)
    rest = docs.drop("piece_ids", "decoded")
    schema = T.StructType([*rest.schema.fields, T.StructField("piece_ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = chunk_table(path)
        for batch in slices(batches, text, 4 << 20):
            flat, offsets, decoded = table.encode([x or "" for x in batch.column(text).to_pylist()])
            ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids, pa.array(decoded, pa.string())], names=schema.names)

    return rest.mapInArrow(run, schema)


def decode(df: DataFrame, ids: str = "piece_ids", out: str = "decoded", model_path: str | None = None) -> DataFrame:
    """``df`` with the library's decoding of an id column (null: empty text)."""
    path = model_path or tokenizer_path(MODEL)
    rest = df.drop(out)
    schema = T.StructType([*rest.schema.fields, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        for batch in batches:
            texts = [model.decode(x or []) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return rest.mapInArrow(run, schema)


def digests(docs: DataFrame) -> DataFrame:
    """Per document: number of ids, and digests of the ids and of the decoded text."""
    coded = encode(docs.select("doc_id", "text"))
    return coded.select(
        "doc_id",
        F.size("piece_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("piece_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
