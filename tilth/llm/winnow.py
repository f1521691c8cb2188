"""Benchmark decontamination by winnowing.

Over the words of a text, hashes of ``GRAM`` consecutive words are taken, and of each
sliding window of such hashes the smallest is kept.  Two texts that share ``WINDOW``
consecutive words share every hash in that span and so the kept one: joining the kept
fingerprints of documents and benchmark items loses no shared span.  A hit is then
extended to the whole span: the words are part of the join key, so equality is exact.

Documents first pass a bitmap of the items' fingerprints, whose size is fixed; only
windows that pass are exchanged.  Items shorter than a window are one gram of their own
length.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.functions.store import cut
from tilth.llm.text import slices

WINDOW, GRAM = 10, 5
#: Bits of the bitmap that documents pass: 8 MB whatever the benchmark's size.
BITMAP_BITS = 26
#: ASCII signs but digits and letters become spaces, A-Z small letters; other bytes belong to words.
TO_WORDS = bytes(b if chr(b).isdigit() or 97 <= b <= 122 or b > 127 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Hash of each word met; emptied when it is large."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


HASHES = WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * MULTIPLIER
    return x ^ x >> np.uint64(29)


def _grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each position on."""
    count = max(0, len(hashes) - n + 1)
    out = np.full(count, n, np.uint64)
    for i in range(n):
        out = out * MULTIPLIER + hashes[i : i + count]
    return _mix(out)


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """Smallest of the ``n`` values from each position on."""
    out, width = values, 1
    while width < n:
        step = min(width, n - width)
        out = np.minimum(out[: len(out) - step], out[step:]) if len(out) > step else out[:0]
        width += step
    return out


def windows_of(texts: list[str | None], short: list[int], own_short: bool, bitmap: np.ndarray | None, window: int = WINDOW, gram: int = GRAM) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Word counts of the texts, and their windows: text, position, length, fingerprint, words.

    With ``own_short`` a text shorter than a window gives itself; otherwise each text
    gives all its grams of the lengths in ``short``.  With a bitmap only windows whose
    fingerprint it holds are given.
    """
    split = [(t or "").encode().translate(TO_WORDS).split() for t in texts]
    counts = [len(x) for x in split]
    flat = list(chain.from_iterable(split))
    hashes = np.fromiter(map(HASHES.__getitem__, flat), np.uint64, len(flat))
    if len(HASHES) > 600_000:
        HASHES.clear()
    of = np.repeat(np.arange(len(texts)), counts)
    bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    found = []
    for n in [window, *short]:
        prints = _least(_grams(hashes, gram), window - gram + 1) if n == window else _grams(hashes, n)
        inside = of[: len(prints)] == of[n - 1 : n - 1 + len(prints)]
        if n < window and own_short:
            inside &= np.asarray(counts)[of[: len(prints)]] == n
        if bitmap is not None:
            slot = (prints >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
            inside &= bitmap[slot >> 3] >> (slot & 7).astype(np.uint8) & 1 > 0
        at = np.flatnonzero(inside)
        found.append((at, np.full(len(at), n), prints[at]))
    at, length, prints = (np.concatenate([x[i] for x in found]) for i in range(3))
    order = np.argsort(at, kind="stable")
    at, length, prints = at[order], length[order], prints[order]
    words = [b" ".join(flat[a : a + n]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
    return counts, of[at], at - bounds[of[at]], length, prints, words


def item_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``fp``, ``words`` and ``items`` (their ids as strings) for each distinct window of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            _, of, _, _, prints, words = windows_of(batch.column("text").to_pylist(), list(range(1, WINDOW)), True, None)
            yield pa.RecordBatch.from_arrays([batch.column("item").take(pa.array(of)), pa.array(prints.view(np.int64)), pa.array(words, pa.binary())], names=["item", "fp", "words"])

    rows = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text")).mapInArrow(run, "item string, fp long, words binary")
    return rows.distinct().groupBy("fp", "words").agg(F.collect_list("item").alias("items"))


def _bitmap(windows: DataFrame) -> np.ndarray:
    """The fixed-size bitmap of all fingerprints, put together from blocks that Spark fills."""
    slot = F.shiftrightunsigned("fp", 64 - BITMAP_BITS) + 1  # the functions count from 1
    blocks = windows.groupBy(F.bitmap_bucket_number(slot).alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    out = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    for r in blocks.toLocalIterator():
        start = (r["block"] - 1) * 4096
        out[start : start + 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id") -> DataFrame:
    """A row per document: ``doc_id``, ``n_words``, ``n_hit``, ``items`` (sorted, as strings), ``spans``.

    A word is hit if it lies in an occurrence of a window of an item: ``WINDOW``
    consecutive words, or the whole of a shorter item.  ``spans`` holds the hit runs as
    (start, stop) in words.  Null texts have no words; items without words have no
    window; repeated documents are rows of their own; either table may be empty.
    """
    spark = docs.sparkSession
    items = cut(item_windows(benchmark, item_id))
    short = sorted(r["n"] for r in items.select((F.size(F.split(F.decode("words", "utf-8"), " "))).alias("n")).filter(f"n < {WINDOW}").distinct().collect())
    bitmap = spark.sparkContext.broadcast(_bitmap(items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches, "text", 4 << 20):
            counts, of, at, length, prints, words = windows_of(batch.column("text").to_pylist(), short, False, bitmap.value)
            offsets = np.searchsorted(of, np.arange(len(counts) + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(offsets), x) for x in (pa.array(at.astype(np.int32)), pa.array(length.astype(np.int32)), pa.array(prints.view(np.int64)), pa.array(words, pa.binary()))]
            keys = np.arange(row, row + len(counts))
            row += len(counts)
            yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column("doc_id"), pa.array(counts, pa.int64()), *lists], names=names)

    names = ["key", "doc_id", "n_words", "at", "length", "fp", "words"]
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"key long, doc_id {kind}, n_words long, at array<int>, length array<int>, fp array<bigint>, words array<binary>"
    # A row a document; windows only of those that pass the bitmap.
    scanned = cut(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema))
    passed = scanned.filter(F.size("fp") > 0).select("key", F.explode(F.arrays_zip("at", "length", "fp", "words")).alias("w")).select("key", "w.*")
    hits = passed.join(items, ["fp", "words"]).select("key", "at", "length", "items")
    merge = lambda s, x: F.when(
        (F.size(s) > 0) & (F.element_at(s, -1)["stop"] >= x["at"]),
        F.concat(F.slice(s, 1, F.size(s) - 1), F.array(F.struct(F.element_at(s, -1)["start"].alias("start"), F.greatest(F.element_at(s, -1)["stop"], x["at"] + x["length"]).alias("stop")))),
    ).otherwise(F.concat(s, F.array(F.struct(x["at"].alias("start"), (x["at"] + x["length"]).alias("stop")))))
    # Windows and items of one document; both are bounded by its words and the benchmark.
    by_doc = hits.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("at", "length"))).alias("at"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    spans = by_doc.select("key", "items", F.aggregate("at", F.array().cast("array<struct<start:int,stop:int>>"), merge).alias("spans"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return scanned.select("key", "doc_id", "n_words").join(spans, "key", "left").select("doc_id", "n_words", F.coalesce(n_hit, F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans")


def digests(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contamination(docs.select("doc_id", "text"), benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a window of a benchmark item; all columns stay."""
    hit = contamination(docs, benchmark, doc_id, text).filter("n_hit > 0").select(F.col("doc_id").alias("__id"))
    return docs.join(hit, docs[doc_id].eqNullSafe(hit["__id"]), "left_anti")
