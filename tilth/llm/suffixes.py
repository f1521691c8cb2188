"""Removal of byte strings that also start in a document with a smaller id, by suffix arrays.

Three passes over blocks of texts.  First each block sends the winnowing fingerprints of
its windows of ``LENGTH`` bytes to key ranges, which answer with those that occur in two
documents.  Then each block sends, to the range of its fingerprint, every segment whose
windows carry an answered fingerprint; equal windows have equal fingerprints and so meet
in one range.  There a suffix array of the segments is built in two stages, equal windows
are neighbours with a common prefix of ``LENGTH`` bytes, and all but those of the smallest
document are reported.  Last, each block cuts what was reported from its texts.

Two-stage sorting: only suffixes smaller than their successors are sorted directly; each
other suffix is placed when its successor is met in a scan of the buckets in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.functions.store import cut
from tilth.llm.blocks import grow, pack_texts, range_of, ranges_for, shrink

LENGTH, GRAM = 50, 20
#: Bytes of text in a block, and served by a key range: a task holds one of either and some arrays over it.
BLOCK_BYTES, RANGE_BYTES = 2 << 20, 1 << 20
#: Closes each segment in a suffix array's text; no UTF-8 byte.
SEPARATOR = 255
STEP = 1 << 17
MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one number in byte order; ``text`` needs seven more bytes."""
    return np.ndarray((len(text) - 7,), ">u8", text.data, strides=(1,))


def _minima(text: np.ndarray) -> np.ndarray:
    """Smallest fingerprint of the grams in each window; ``text`` is at least a window long."""
    words = np.ndarray((len(text) - 7,), "<u8", text.data, strides=(1,))
    count = len(text) - GRAM + 1
    grams = words[:count] * MULTIPLIERS[0] + words[8 : count + 8] * MULTIPLIERS[1] + words[GRAM - 8 : count + GRAM - 8] * MULTIPLIERS[2]
    grams ^= grams >> np.uint64(31)
    grams *= MULTIPLIERS[3]
    grams ^= grams >> np.uint64(30)
    width, want = 1, LENGTH - GRAM + 1
    while width < want:
        step = min(width, want - width)
        grams = np.minimum(grams[:-step], grams[step:])
        width += step
    return grams


def runs_of(text: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one fingerprint: first and last window start, and the fingerprint.

    ``bounds`` holds the starts of the documents in ``text`` and its end; windows lie
    inside a document.
    """
    valid = np.ones(len(text) + 1, bool)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        valid[max(a, b - LENGTH + 1) : b] = False
    valid[-1] = False
    firsts, lasts, prints = [], [], []
    before, before_valid = np.uint64(0), False
    for start in range(0, max(0, len(text) - LENGTH + 1), STEP):
        least = _minima(text[start : start + STEP + LENGTH - 1])
        ok = valid[start : start + len(least) + 1]
        fresh = np.empty(len(least) + 1, bool)
        fresh[0] = not before_valid or least[0] != before
        fresh[1:-1] = (least[1:] != least[:-1]) | ~ok[:-2]
        fresh[-1] = False
        at = np.flatnonzero(fresh[:-1] & ok[:-1])
        firsts.append(at + start)
        prints.append(least[at])
        before, before_valid = least[-1], bool(ok[-2])
    if not firsts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first, found = np.concatenate(firsts), np.concatenate(prints)
    # A run ends before the next run, or with the last window of its document.
    ends = bounds[np.searchsorted(bounds, first, side="right")] - LENGTH
    last = np.minimum(ends, np.concatenate([first[1:], [len(text)]]) - 1)
    return first, last, found


def _prefix_order(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions ordered by the ``depth`` bytes from them on, eight at a time; ties are refined only where they differ."""
    key = words[at].astype(np.uint64)
    order = np.argsort(key)
    at, key = at[order], key[order]
    fresh = np.concatenate([[True], key[1:] != key[:-1]])
    for k in range(8, depth, 8):
        starts = np.flatnonzero(fresh)
        sizes = np.diff(np.concatenate([starts, [len(at)]]))
        tied = np.flatnonzero(np.repeat(sizes > 1, sizes))
        if not len(tied):
            break
        group = np.repeat(np.arange(len(starts)), sizes)[tied]
        key = words[np.minimum(at[tied] + k, len(words) - 1)].astype(np.uint64)
        head = np.concatenate([[True], group[1:] != group[:-1]])
        differs = key != key[np.flatnonzero(head)[np.cumsum(head) - 1]]
        mixed = np.zeros(len(starts), bool)
        mixed[group[differs]] = True
        some = np.flatnonzero(mixed[group])
        if len(some):
            order = some[np.lexsort((key[some], group[some]))]
            at[tied[some]] = at[tied[order]]
            key[some] = key[order]
            inner = np.concatenate([[False], (key[1:] != key[:-1]) & (group[1:] == group[:-1])])
            fresh[tied[inner]] = True
    return at


def suffix_array(text: np.ndarray, needed: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Starts of the needed suffixes, ordered by at least ``depth`` bytes.

    ``text`` ends with ``depth + 8`` separators.  ``needed`` holds with any suffix that is
    larger than its successor that successor too.
    """
    n = len(text)
    rise = np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16))
    # Equal signs take the direction of the next pair that differs; the end is a fall.
    turn = np.where(rise != 0, np.arange(n - 1, dtype=np.int32), np.int32(n - 1))
    turn = np.minimum.accumulate(turn[::-1])[::-1]
    small = np.zeros(n, bool)
    small[:-1] = np.concatenate([rise > 0, [False]])[turn]
    del rise, turn
    direct = _prefix_order(words_at(text), np.flatnonzero(small & needed).astype(np.int32), depth)
    split = np.searchsorted(text[direct], np.arange(257))
    induced = needed & ~small
    queue: list[list[np.ndarray]] = [[] for _ in range(257)]
    out: list[np.ndarray] = []

    def met(at: np.ndarray) -> None:
        """Put the induced predecessors of a scanned piece at the ends of their buckets."""
        before = at[at > 0] - 1
        before = before[induced[before]]
        if len(before):
            signs = text[before]
            order = np.argsort(signs, kind="stable")
            edges = np.searchsorted(signs[order], np.arange(257))
            for c in np.flatnonzero(np.diff(edges)).tolist():
                queue[c].append(before[order[edges[c] : edges[c + 1]]])

    if n and induced[n - 1]:
        queue[text[n - 1]].append(np.array([n - 1]))
    for c in range(256):
        while queue[c]:
            piece = np.concatenate(queue[c])
            queue[c].clear()
            out.append(piece)
            met(piece)
        piece = direct[split[c] : split[c + 1]]
        if len(piece):
            out.append(piece)
            met(piece)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def common_windows(segments: list[bytes], docs: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Of all window starts in the segments: segment starts in one text, and whether a smaller document has that window."""
    sizes = np.array([len(x) for x in segments])
    text = np.frombuffer(b"".join(x + b"\xff" for x in segments) + b"\xff" * (length + 8), np.uint8)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    window = np.zeros(len(text) + 1, np.int32)
    np.add.at(window, starts, 1)
    np.add.at(window, starts + np.maximum(sizes - length + 1, 0), -1)
    window = np.cumsum(window)[:-1] > 0
    # A window larger than its successor needs it, and so on up to one that is smaller.
    rise = np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16))
    needed = window.copy()
    edge = starts + np.maximum(sizes - length + 1, 0)
    edge = edge[sizes >= length]
    while len(edge):
        needed[edge] = True
        edge = edge[edge < len(text) - 1]
        edge = edge[rise[edge] <= 0] + 1
        edge = edge[~needed[edge]]
    order = suffix_array(text, needed, length)
    order = order[window[order]]
    words = words_at(text)
    same = np.ones(max(0, len(order) - 1), bool)
    for k in [*range(0, length - 8, 8), length - 8]:
        left = np.flatnonzero(same)
        same[left] = words[order[left] + k] == words[order[left + 1] + k]
    heads = np.flatnonzero(np.concatenate([[True], ~same])) if len(order) else np.zeros(0, np.int64)
    owner = docs[np.searchsorted(starts, order, side="right") - 1]
    least = np.minimum.reduceat(owner, heads) if len(order) else owner
    repeated = np.zeros(len(text), bool)
    repeated[order] = np.repeat(least, np.diff(np.concatenate([heads, [len(order)]]))) < owner
    return starts, repeated


def _expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indexes ``starts[i] .. starts[i] + counts[i] - 1`` for all i, one after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


class Block:
    """A block's text with its documents; documents without an id take no part in comparisons."""

    def __init__(self, doc_ids: list, lengths: list[int], texts: bytes) -> None:
        self.text = np.frombuffer(grow(texts), np.uint8)
        self.bounds = np.concatenate([[0], np.cumsum(np.array(lengths, np.int64))]).astype(np.int64)
        self.ids = np.array([x if x is not None else 0 for x in doc_ids], np.int64)
        self.named = np.array([x is not None for x in doc_ids], bool)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        first, last, prints = runs_of(self.text, self.bounds)
        doc = np.searchsorted(self.bounds, first, side="right") - 1
        keep = self.named[doc]
        return first[keep], last[keep], prints[keep], doc[keep]


def _shared(blocks: DataFrame, ranges: int) -> DataFrame:
    """``block``, ``range`` and those of its fingerprints that two documents have."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, ids, lengths, texts in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                block = Block(ids, lengths, texts)
                _, _, prints, doc = block.runs()
                order = np.argsort(prints)
                prints, owner = prints[order], block.ids[doc[order]]
                heads = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]])) if len(prints) else order
                if not len(heads):
                    continue
                several = np.minimum.reduceat(owner, heads) < np.maximum.reduceat(owner, heads)
                keys = prints[heads]
                place = range_of(keys, ranges)
                low = keys.astype(np.uint32)  # the lower half; a chance agreement only sends a segment in vain
                edges = np.searchsorted(place, np.arange(ranges + 1))
                rows = [(r, low[a:b].tobytes(), np.packbits(several[a:b]).tobytes()) for r, a, b in zip(range(ranges), edges[:-1].tolist(), edges[1:].tolist(), strict=True) if a < b]
                yield pa.RecordBatch.from_pydict({"range": pa.array([x[0] for x in rows], pa.int64()), "block": pa.array([number] * len(rows)), "keys": pa.array([x[1] for x in rows], pa.binary()), "several": pa.array([x[2] for x in rows], pa.binary())})

    def answer(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x, np.uint32) for x in table["keys"].to_pylist()]
        several = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(k)).astype(bool) for x, k in zip(table["several"].to_pylist(), keys, strict=True)]
        of = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        flat, flags = np.concatenate(keys), np.concatenate(several)
        order = np.argsort(flat, kind="stable")
        heads = np.flatnonzero(np.concatenate([[True], flat[order][1:] != flat[order][:-1]]))
        sizes = np.diff(np.concatenate([heads, [len(flat)]]))
        wanted = (sizes > 1) | np.logical_or.reduceat(flags[order], heads)
        hit = np.zeros(len(flat), bool)
        hit[order] = np.repeat(wanted, sizes)
        edges = np.searchsorted(of, np.arange(len(keys) + 1))
        found = [k[hit[a:b]].tobytes() for k, a, b in zip(keys, edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
        out = pa.table({"block": table["block"], "range": table["range"], "keys": pa.chunked_array([pa.array(found, pa.binary())])})
        return out.filter(pa.compute.greater(pa.compute.binary_length(out["keys"]), 0))

    sent = blocks.select("block", "doc_ids", "lengths", "texts").mapInArrow(send, "range long, block long, keys binary, several binary")
    return sent.groupBy("range").applyInArrow(answer, "block long, range long, keys binary")


def _segments(blocks: DataFrame, shared: DataFrame, ranges: int) -> DataFrame:
    """Segments of windows with shared fingerprints, by key range: distinct in a block, with where they occur."""
    asked = shared.groupBy("block").agg(F.collect_list(F.struct("range", "keys")).alias("asked"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, ids, lengths, texts, asked_ in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                block = Block(ids, lengths, texts)
                first, last, prints, doc = block.runs()
                place = range_of(prints, ranges)
                code = place.astype(np.uint64) << np.uint64(32) | prints & np.uint64(0xFFFFFFFF)
                known = np.sort(np.concatenate([np.uint64(x["range"] << 32) | np.frombuffer(x["keys"], np.uint32).astype(np.uint64) for x in asked_]))
                spot = np.minimum(np.searchsorted(known, code), len(known) - 1)
                hit = np.flatnonzero(known[spot] == code)
                # In order of document ids, so that a segment's first occurrence is its smallest document's.
                hit = hit[np.argsort(block.ids[doc[hit]], kind="stable")]
                whole = block.text.tobytes()
                held: dict[bytes, list] = {}
                for a, b, r, d in zip(first[hit].tolist(), (last[hit] + LENGTH).tolist(), place[hit].tolist(), block.ids[doc[hit]].tolist(), strict=True):
                    own = held.setdefault(whole[a:b], [r, d, [], []])
                    (own[2] if own[1] == d else own[3]).append(a)
                by: dict[int, list] = {}
                for segment, (r, d, same, later) in held.items():
                    by.setdefault(r, []).append((segment, d, same, later))
                rows = []
                for r, found in by.items():
                    sizes = np.array([(len(x[0]), len(x[2]), len(x[3])) for x in found], np.uint32)
                    spots = np.array([a for x in found for a in (*x[2], *x[3])], np.uint32)
                    data = sizes.tobytes() + np.array([x[1] for x in found], np.int64).tobytes() + spots.tobytes() + b"".join(x[0] for x in found)
                    rows.append((r, number, len(found), len(spots), shrink(data)))
                yield pa.RecordBatch.from_pydict({k: pa.array([x[i] for x in rows], t) for i, (k, t) in enumerate((("range", pa.int64()), ("block", pa.int64()), ("n", pa.int64()), ("spots", pa.int64()), ("data", pa.binary())))})

    joined = blocks.join(asked, "block").select("block", "doc_ids", "lengths", "texts", "asked")
    return joined.mapInArrow(send, "range long, block long, n long, spots long, data binary")


def _repeats(segments: DataFrame) -> DataFrame:
    """``block``, ``data``: byte intervals of blocks whose windows a smaller document has."""

    def sort(table: pa.Table) -> pa.Table:
        texts: list[bytes] = []
        docs, counts, spots, blocks_of = [], [], [], []
        numbers = table["block"].to_pylist()
        for i, (n, m, data) in enumerate(zip(table["n"].to_pylist(), table["spots"].to_pylist(), table["data"].to_pylist(), strict=True)):
            data = grow(data)
            sizes = np.frombuffer(data, np.uint32, 3 * n).reshape(n, 3)
            docs.append(np.frombuffer(data, np.int64, n, 12 * n))
            spots.append(np.frombuffer(data, np.uint32, m, 20 * n))
            at = 20 * n + 4 * m
            for size in sizes[:, 0].tolist():
                texts.append(data[at : at + size])
                at += size
            counts.append(sizes[:, 1:].astype(np.int64))
            blocks_of.append(np.full(n, i))
        docs, counts, spots, blocks_of = (np.concatenate(x) for x in (docs, counts, spots, blocks_of))
        starts, repeated = common_windows(texts, docs)
        lengths = np.array([len(x) for x in texts])
        # Runs of repeated windows, by segment.
        flips = np.diff(np.concatenate([[0], repeated.astype(np.int8), [0]]))
        low, high = np.flatnonzero(flips == 1), np.flatnonzero(flips == -1) - 1 + LENGTH
        of = np.searchsorted(starts, low, side="right") - 1
        first_run = np.searchsorted(of, np.arange(len(texts) + 1))
        offsets = np.concatenate([[0], np.cumsum(counts.sum(axis=1))])[:-1]
        # Places in the segment's smallest document lose the runs, places in later ones the whole segment.
        same = _expand(offsets, counts[:, 0])
        own = np.repeat(np.arange(len(texts)), counts[:, 0])
        runs = _expand(first_run[own], first_run[own + 1] - first_run[own])
        base = np.repeat(spots[same].astype(np.int64), first_run[own + 1] - first_run[own])
        later = _expand(offsets + counts[:, 0], counts[:, 1])
        other = np.repeat(np.arange(len(texts)), counts[:, 1])
        begin = np.concatenate([base + low[runs] - starts[of[runs]], spots[later].astype(np.int64)]).astype(np.uint32)
        end = np.concatenate([base + high[runs] - starts[of[runs]], spots[later].astype(np.int64) + lengths[other]]).astype(np.uint32)
        where = np.concatenate([blocks_of[of[runs]], blocks_of[other]])
        order = np.argsort(where, kind="stable")
        edges = np.searchsorted(where[order], np.arange(len(numbers) + 1))
        rows = [(numbers[i], begin[order[a:b]].tobytes() + end[order[a:b]].tobytes()) for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)) if a < b]
        return pa.table({"block": pa.array([x[0] for x in rows], pa.int64()), "data": pa.array([x[1] for x in rows], pa.binary())})

    return segments.groupBy("range").applyInArrow(sort, "block long, data binary")


def cut_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: list[str] | None = None, characters: bool = False) -> DataFrame:
    """A row per document: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (the remaining bytes).

    The columns in ``carry`` stay with their rows, as a struct ``rows``.  With ``characters`` a
    UTF-8 character that loses a byte goes as a whole.

    A byte goes if a string of ``LENGTH`` bytes over it also starts in a document with a
    smaller id, as the texts were given.  Null and short texts lose nothing.  Documents
    with the same id do not compare with each other; a document without id neither
    loses nor takes; an empty table gives an empty result.
    """
    blocks = pack_texts(docs, doc_id, text, BLOCK_BYTES, carry)
    ranges = ranges_for(blocks, RANGE_BYTES)
    # Each round's answers are written, so that its exchanges can be dropped before the next.
    shared = cut(_shared(blocks, ranges))
    reported = cut(_repeats(_segments(blocks, shared, ranges))).groupBy("block").agg(F.collect_list("data").alias("cuts"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, (ids, lengths, texts, cuts) in enumerate(zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)):
                block = Block(ids, lengths, texts)
                depth = np.zeros(len(block.text) + 1, np.int32)
                for data in cuts or []:
                    pairs = np.frombuffer(data, np.uint32).reshape(2, -1)
                    np.add.at(depth, pairs[0], 1)
                    np.add.at(depth, pairs[1], -1)
                gone = np.cumsum(depth)[:-1] > 0
                if characters and gone.any():
                    starts = (block.text & 0xC0) != 0x80
                    starts[block.bounds[:-1][np.diff(block.bounds) > 0]] = True
                    of = np.cumsum(starts) - 1
                    gone = (np.bincount(of, gone) > 0)[of]
                begins = gone & ~np.concatenate([[False], gone[:-1]])
                edges = block.bounds[:-1][np.diff(block.bounds) > 0]
                begins[edges] = gone[edges]
                removed = np.concatenate([[0], np.cumsum(gone)])[block.bounds]
                spans = np.concatenate([[0], np.cumsum(begins)])[block.bounds]
                left = block.text[~gone].tobytes()
                kept = (block.bounds - removed).tolist()
                rest = [left[a:b] for a, b in zip(kept[:-1], kept[1:], strict=True)]
                columns = [pa.array(ids, batch.schema.field(0).type.value_type), pa.array(lengths, pa.int64()), pa.array(np.diff(removed).astype(np.int64)), pa.array(np.diff(spans).astype(np.int64)), pa.array(rest, pa.binary())]
                if carry:
                    columns.append(batch.column(4)[at].values)
                yield pa.RecordBatch.from_arrays(columns, names=out.names)

    out = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), *(T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")), T.StructField("kept", T.BinaryType())])
    if carry:
        out.add("rows", blocks.schema["rows"].dataType.elementType)
    joined = blocks.join(reported, "block", "left").select("doc_ids", "lengths", "texts", "cuts", *(["rows"] if carry else []))
    return joined.mapInArrow(apply, out)


def digests(docs: DataFrame) -> DataFrame:
    return cut_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
