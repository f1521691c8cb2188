"""Language-model scoring by context-tree weighting over bytes.

A byte is eight binary decisions, each with a context tree of its own over the bytes
before it.  A node at depth d (the last d bytes) has counted zeros and ones; its
Krichevsky-Trofimov estimate is mixed with those of all longer contexts, weighted by
how well either explains the training texts.  The score of a text is the sum of the
logarithms of the mixed probabilities of its bytes and of its end.

Counts are taken over all training texts: blocks send their distinct byte grams with
counts to key ranges by the last ``SPLIT`` bytes, where the trees below that depth are
complete; what is above them has a size bound (256 ** 2 contexts of 255 decisions) and is
put together on the driver.  Ranges answer with the probability of each gram, and a block
scores its own texts.  Word counts for a smoothed unigram score go the same way.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.functions.store import cut
from tilth.llm.blocks import grow, grow_array, grow_sorted, pack_texts, range_of, ranges_for, shrink_array, shrink_sorted
from tilth.llm.text import LOWER
from tilth.llm.winnow import HASHES, MULTIPLIER

#: Bytes of context, and the depth from which on trees lie within one key range.
DEPTH, SPLIT = 5, 3
BLOCK_BYTES = 5 << 20
#: Stands before a text and ends it; no UTF-8 byte.
EDGE = b"\xff"
SMOOTHING = 0.1
END_WORD = b""


def held_out(doc_id: int | None) -> bool:
    """Whether a document is kept from training; one without id is."""
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 == 0


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0: Stirling's series after eight steps of the recurrence."""
    shift = np.ones_like(x)
    y = x.astype(np.float64)
    for _ in range(8):
        low = y < 8
        shift[low] *= y[low]
        y = np.where(low, y + 1, y)
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(shift)


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the KT probability of a sequence with these counts."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - np.log(np.pi)


class Level:
    """Nodes of one depth: key (context, decision), counts, estimate of a one and weight of stopping here."""

    def __init__(self, key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None) -> None:
        self.key, self.zeros, self.ones = key, zeros, ones
        kt = _log_kt(zeros, ones)
        self.one = (ones + 0.5) / (zeros + ones + 1.0)
        self.log = kt if below is None else np.logaddexp(kt, below) - np.log(2)
        self.stop = np.ones(len(key)) if below is None else np.exp(kt - np.log(2) - self.log)

    def parents(self) -> np.ndarray:
        """Keys of the same decisions one byte of context higher."""
        return self.key >> np.uint64(16) << np.uint64(8) | self.key & np.uint64(255)


def _sum_by(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(key, kind="stable")
    key = key[order]
    heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else order
    return key[heads], *(np.add.reduceat(v[order], heads) if len(heads) else v for v in values)


def _decisions(byte: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The eight decisions of bytes, first bit first: number of the decision (1 to 255), and the bit."""
    for k in range(8):
        yield np.uint64(1 << k) | byte >> np.uint64(8 - k), byte >> np.uint64(7 - k) & np.uint64(1)


def levels(grams: np.ndarray, counts: np.ndarray, depth: int, top: int) -> list[Level]:
    """Levels ``depth`` down to ``top`` of counted grams (context, latest byte first, then the byte)."""
    out: list[Level] = []
    for d in range(depth, top - 1, -1):
        context, byte = grams >> np.uint64(8 * (depth - d + 1)), grams & np.uint64(255)
        keys, zeros, ones = [], [], []
        for node, bit in _decisions(byte):
            keys.append(context << np.uint64(8) | node)
            ones.append(counts * bit.astype(np.float64))
            zeros.append(counts * (1.0 - bit))
        key, zero, one = _sum_by(np.concatenate(keys), np.concatenate(zeros), np.concatenate(ones))
        below = None
        if out:
            below = np.bincount(np.searchsorted(key, out[-1].parents()), weights=out[-1].log, minlength=len(key))
        out.append(Level(key, zero, one, below))
    return out


def log_probabilities(grams: np.ndarray, depth: int, tables: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """log10 probability of each gram's last byte.  ``tables``: depth, keys, estimates, weights, deepest first.

    Where a context was never met, the estimate of the longest context that was stands for it.
    """
    total = np.zeros(len(grams))
    byte = grams & np.uint64(255)
    for node, bit in _decisions(byte):
        p, begun = np.full(len(grams), 0.5), np.zeros(len(grams), bool)
        for d, key, one, stop in tables:
            if not len(key):
                continue
            wanted = grams >> np.uint64(8 * (depth - d + 1)) << np.uint64(8) | node
            at = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
            have = key[at] == wanted
            mixed = np.where(begun, stop[at] * one[at] + (1 - stop[at]) * p, one[at])
            p = np.where(have, mixed, p)
            begun |= have
        total += np.log10(np.where(bit == 1, p, 1 - p))
    return total


class Block:
    """Byte grams and words of a block's texts, A-Z lower-cased."""

    def __init__(self, doc_ids: list, lengths: list[int], texts: bytes, depth: int) -> None:
        whole = grow(texts).translate(LOWER)
        bounds = np.concatenate([[0], np.cumsum(np.array(lengths, np.int64))]).astype(np.int64)
        spans = list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
        self.train = np.array([not held_out(x) for x in doc_ids], bool)
        self.sizes = np.array(lengths, np.int64) + 1  # with the end
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])[:-1].astype(np.int64)
        data = np.frombuffer(EDGE * depth + b"".join(whole[a:b] + EDGE * depth for a, b in spans), np.uint8)
        grams = data[depth:].astype(np.uint64)
        for k in range(1, depth + 1):
            grams |= data[depth - k : len(data) - k].astype(np.uint64) << np.uint64(8 * (depth + 1 - k))
        # Of the edges behind a text only the first is its end.
        real = np.ones(len(grams), bool)
        for b in (bounds[1:] + depth * np.arange(len(spans))).tolist():
            real[b + 1 : b + depth] = False
        self.grams = grams[real]
        del grams, data
        keys, counts = [], []
        for a, b in spans:
            words = [*whole[a:b].split(), END_WORD]
            keys.append(np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words)))
            counts.append(len(words))
        self.word_keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        self.word_counts = np.array(counts, np.int64)
        if len(HASHES) > 400_000:
            HASHES.clear()

    def distinct(self, depth: int, ranges: int) -> tuple[list, list]:
        """For grams and words: distinct keys in order of range, their training counts, and the bounds of ranges."""
        out = []
        for keys, sizes in ((self.grams, self.sizes), (self.word_keys, self.word_counts)):
            train = np.repeat(self.train, sizes)
            seen, counts = np.unique(keys[train], return_counts=True)
            other = np.setdiff1d(np.unique(keys[~train]), seen, assume_unique=True)
            every = np.concatenate([seen, other])
            counts = np.concatenate([counts, np.zeros(len(other), counts.dtype)])
            hashed = every if keys is self.word_keys else (every >> np.uint64(8 * (depth + 1 - SPLIT))) * MULTIPLIER
            place = range_of(hashed, ranges)
            order = np.lexsort((every, place))
            out.append((every[order], counts[order], np.searchsorted(place[order], np.arange(ranges + 1))))
        return out


def _send(blocks: DataFrame, ranges: int, depth: int) -> DataFrame:
    """``range``, ``block``, ``keys``, ``counts``: grams in ranges from 0, words in ranges from ``ranges`` on."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, ids, lengths, texts in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                rows = []
                for kind, (keys, counts, edges) in enumerate(Block(ids, lengths, texts, depth).distinct(depth, ranges)):
                    for r, a, b in zip(range(ranges), edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                        if a < b:
                            rows.append((kind * ranges + r, shrink_sorted(keys[a:b]), shrink_array(counts[a:b].astype(np.uint32))))
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int64()), pa.array([number] * len(rows), pa.int64()), pa.array([x[1] for x in rows], pa.binary()), pa.array([x[2] for x in rows], pa.binary())], names=["range", "block", "keys", "counts"])

    return cut(blocks.select("block", "doc_ids", "lengths", "texts").mapInArrow(send, "range long, block long, keys binary, counts binary"))


def _merged(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Of one range: the keys of each block, and all distinct keys with the sum of their counts."""
    keys = [grow_sorted(x) for x in table["keys"].to_pylist()]
    counts = [grow_array(x, np.uint32).astype(np.float64) for x in table["counts"].to_pylist()]
    return keys, *_sum_by(np.concatenate(keys), np.concatenate(counts))


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH) -> DataFrame:
    """A row per document: ``doc_id``, ``held_out``, ``n_bytes``, word counts, ``base_score`` and ``score``.

    Both scores are log10 probabilities: of the words under a smoothed unigram model, and
    of the bytes under the context trees; both count an end, which is all that a null or
    empty text has.  Without training documents every binary decision is even.
    """
    blocks = pack_texts(docs, doc_id, text, BLOCK_BYTES)
    ranges = ranges_for(blocks)
    sent = _send(blocks, ranges, depth)

    def summarise(table: pa.Table) -> pa.Table:
        _, keys, counts = _merged(table)
        if table["range"][0].as_py() >= ranges:
            key, zeros, ones, below = (np.array([x]) for x in (-1, counts.sum(), float((counts > 0).sum()), 0.0))
        else:
            seen = counts > 0
            low = levels(keys[seen], counts[seen], depth, SPLIT)[-1]
            key, zeros, ones, below = _sum_by(low.parents(), low.zeros, low.ones, low.log)
        return pa.table({"key": pa.array(key.astype(np.int64)), "zeros": pa.array(zeros), "ones": pa.array(ones), "below": pa.array(below)})

    sums = sent.groupBy("range").applyInArrow(summarise, "key long, zeros double, ones double, below double").groupBy("key").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("below").alias("below"))
    # At most 256 ** 2 contexts with 255 decisions each, whatever the table's size.
    top = sums.orderBy("key").toArrow()
    key, zeros, ones, below = (np.asarray(top[c]) for c in ("key", "zeros", "ones", "below"))
    words = key < 0
    total, kinds = float(zeros[words].sum()), float(ones[words].sum())
    tree = [Level(key[~words].astype(np.uint64), zeros[~words], ones[~words], below[~words])]
    for _ in range(SPLIT - 1):
        last = tree[-1]
        tree.append(Level(*_sum_by(last.parents(), last.zeros, last.ones, last.log)))
    shared = docs.sparkSession.sparkContext.broadcast([(SPLIT - 1 - i, x.key, x.one, x.stop) for i, x in enumerate(tree)])

    def answer(table: pa.Table) -> pa.Table:
        asked, keys, counts = _merged(table)
        if table["range"][0].as_py() >= ranges:
            values = counts
        else:
            seen = counts > 0
            own = [(depth - i, x.key, x.one, x.stop) for i, x in enumerate(levels(keys[seen], counts[seen], depth, SPLIT))]
            values = log_probabilities(keys, depth, own + shared.value).astype(np.float32)
        found = [shrink_array(values[np.searchsorted(keys, x)]) for x in asked]
        return pa.table({"block": table["block"], "range": table["range"], "values": pa.chunked_array([pa.array(found, pa.binary())])})

    answers = cut(sent.groupBy("range").applyInArrow(answer, "block long, range long, values binary")).groupBy("block").agg(F.collect_list(F.struct("range", "values")).alias("answers"))
    kind = docs.schema[doc_id].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, lengths, texts, given in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                block = Block(ids, lengths, texts, depth)
                parts = {x["range"]: x["values"] for x in given}
                (grams, _, _), (tokens, _, _) = block.distinct(depth, ranges)
                logs, counts = (np.concatenate([grow_array(parts[r], kind).astype(np.float64) for r in sorted(parts) if r // ranges == k] or [np.zeros(0)]) for k, kind in enumerate((np.float32, np.float64)))
                by_gram = _lookup(grams, logs, block.grams)
                scores = np.add.reduceat(by_gram, block.starts) if len(ids) else by_gram
                count = _lookup(tokens, counts, block.word_keys)
                heads = np.concatenate([[0], np.cumsum(block.word_counts)])[:-1].astype(np.int64)
                base = np.log10((count + SMOOTHING) / (total + SMOOTHING * (kinds + 1)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, batch.schema.field(0).type.value_type),
                        pa.array(~block.train),
                        pa.array(lengths, pa.int64()),
                        pa.array(block.word_counts),
                        pa.array(np.add.reduceat((count > 0).astype(np.int64), heads)),
                        pa.array(np.full(len(ids), int(total))),
                        pa.array(np.add.reduceat(base, heads)),
                        pa.array(scores),
                    ],
                    names=["doc_id", "held_out", "n_bytes", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    joined = blocks.join(answers, "block").select("doc_ids", "lengths", "texts", "answers")
    return joined.mapInArrow(apply, f"doc_id {kind}, held_out boolean, n_bytes long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values of wanted keys, all of which are in ``keys``: a hash table first, a search for those that share a slot."""
    bits = max(10, int(len(keys)).bit_length() + 2)
    slot = lambda x: (x * MULTIPLIER >> np.uint64(64 - bits)).astype(np.int64)
    table = np.zeros(1 << bits, np.int32)
    table[slot(keys)] = np.arange(len(keys))
    order = np.argsort(keys)
    ordered = keys[order]
    out = np.empty(len(wanted), values.dtype)
    for start in range(0, len(wanted), 1 << 19):
        part = wanted[start : start + (1 << 19)]
        at = table[slot(part)]
        missed = np.flatnonzero(keys[at] != part)
        at[missed] = order[np.searchsorted(ordered, part[missed])]
        out[start : start + len(part)] = values[at]
    return out


def digests(docs: DataFrame) -> DataFrame:
    """The scores, with the code length per byte (the end's included)."""
    return score(docs).withColumn("bits_per_byte", -F.col("score") / F.log10(F.lit(2.0)) / (F.col("n_bytes") + 1))
