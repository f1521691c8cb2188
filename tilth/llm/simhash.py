"""Near duplicates by SimHash, found as a range join in an embedding of the fingerprints.

A fingerprint's 64 bits are cut into segments of two, and each segment is mapped to its
number of set bits: a point with 32 coordinates.  The Manhattan distance of two points
is never more than the number of bits in which the fingerprints differ, so points
farther apart than the radius need no look at the bits.  The axes are dealt to
``radius + 2`` groups; two points within the radius agree on all axes of at least two
groups, so they meet in a cell of the grid over one pair of groups.  Inside a cell the
Manhattan distance excludes first and the exact distance decides.

Only distinct fingerprints are joined.  A cell gives links of a spanning forest and not
all its pairs; components are formed from links over the whole table.

Three bits of one fingerprint are far less than what a text of similarity 0.8 differs in.
``similar_texts`` therefore takes ``PRINTS`` fingerprints under hashes of their own: two
texts are candidates where they meet in a cell of any of them, here over segments of one
bit; the distances over all fingerprints, Manhattan first, exclude, and the sets decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.functions.store import cut
from tilth.llm.graph import components
from tilth.llm.similar import similar_groups
from tilth.llm.text import lower_words, mix, slices

SEED, SHINGLE, RADIUS = 42, 3, 3
SEGMENTS, LOW = 32, np.uint64(0x5555555555555555)
#: Fingerprints of a text, words in a shingle and least similarity in percent where sets decide.
PRINTS, WORDS, PERCENT = 20, 5, 80
#: How far beyond its mean the distance of the least similar texts may lie, in deviations.
SIGMAS = 5.0
#: Cells up to this size compare all pairs by shifts; larger ones grow trees.
SMALL_CELL = 8
#: Of each fingerprint so many choices of so many axes make cells.  Random texts share one in 2 ** AXES;
#: very many millions of texts want more axes, and more choices for the same recall.
CHOICES, AXES = 8, 24
_PRINT_SEEDS = mix(np.arange(1, PRINTS + 1, dtype=np.uint64))
_AXES = [np.uint64(sum(1 << int(b) for b in np.argsort(mix(np.arange(64 * c + 1, 64 * c + 65, dtype=np.uint64)))[:AXES])) for c in range(CHOICES)]


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles, repeats included; fewer words are one shingle, none give zero."""
    words = lower_words(text)
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    count = max(1, len(words) - shingle + 1)
    stops = ends[-count:].tolist()
    starts = [0, *(ends[: count - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.dtype("<u8"), count)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(count, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without its text but with the fingerprint as a signed 64-bit number."""
    rest = docs.drop(out)
    fields = [f for f in rest.schema.fields if f.name != text]
    schema = T.StructType([*fields, T.StructField(out, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            found = np.array([fingerprint(x, shingle) for x in batch.column(text).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in fields), pa.array(found)], names=schema.names)

    return rest.mapInArrow(run, schema)


def embed(prints: np.ndarray) -> np.ndarray:
    """The points, each coordinate 0, 1 or 2 in unary, so that bits that differ count the Manhattan distance."""
    one = (prints | prints >> np.uint64(1)) & LOW
    two = (prints & prints >> np.uint64(1)) & LOW
    return one | two << np.uint64(1)


def cells(prints: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """A row of cell numbers for each fingerprint: one for each pair of groups of axes."""
    points, groups = embed(prints), radius + 2
    axes = np.array_split(np.arange(SEGMENTS), groups)
    masks = [np.uint64(sum(3 << (2 * int(a)) for a in group)) for group in axes]
    pairs = list(combinations(range(groups), 2))
    out = np.empty((len(prints), len(pairs)), np.int64)
    for k, (a, b) in enumerate(pairs):
        # Bits outside the two groups are free and hold the number of the pair.
        cell = points & (masks[a] | masks[b])
        free = axes[next(g for g in range(groups) if g not in (a, b))]
        shift = np.uint64(2 * int(free[0]))
        out[:, k] = (cell | np.uint64(k) << shift).view(np.int64)
    return out


def _near(a: np.ndarray, b: np.ndarray, pa_: np.ndarray, pb: np.ndarray, radius: int) -> np.ndarray:
    close = np.bitwise_count(pa_ ^ pb) <= radius
    close[close] = np.bitwise_count(a[close] ^ b[close]) <= radius
    return close


def links_of_cells(cell: np.ndarray, prints: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links inside runs of equal cells; they connect all that any pair within the radius connects."""
    points = embed(prints)
    edges = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1], [True]]))
    sizes = np.diff(edges)
    size = np.repeat(sizes, sizes)
    left, right = [], []
    small = np.flatnonzero((size > 1) & (size <= SMALL_CELL))
    for d in range(1, SMALL_CELL):
        i = small[small + d < len(cell)]
        i = i[cell[i] == cell[i + d]]
        if not len(i):
            break
        i = i[_near(prints[i], prints[i + d], points[i], points[i + d], radius)]
        left.append(prints[i])
        right.append(prints[i + d])
    for k in np.flatnonzero(sizes > SMALL_CELL):
        # Trees: each reached fingerprint is compared once with those not reached yet.
        rest = np.arange(edges[k], edges[k + 1])
        while len(rest):
            todo, rest = [rest[0]], rest[1:]
            while todo and len(rest):
                at = todo.pop()
                close = np.bitwise_count(points[rest] ^ points[at]) <= radius
                hit = rest[close]
                hit = hit[np.bitwise_count(prints[hit] ^ prints[at]) <= radius]
                if len(hit):
                    left.append(np.full(len(hit), prints[at]))
                    right.append(prints[hit])
                    todo.extend(hit.tolist())
                    rest = np.setdiff1d(rest, hit, assume_unique=True)
    if not left:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(left), np.concatenate(right)


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints (column ``fingerprint``) at most ``radius`` bits apart.

    They connect what all such pairs connect.  Fingerprints are exchanged by cell and
    arrive sorted, so a task holds one batch and the cell that it ends in.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.asarray(batch.column(0)).view(np.uint64)
            grid = cells(found, radius)
            yield pa.RecordBatch.from_arrays([pa.array(grid.ravel()), pa.array(np.repeat(found, grid.shape[1]).view(np.int64))], names=["cell", "print"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def close(stop: int | None = None) -> pa.RecordBatch:
            cell, found = (np.concatenate([x[i] for x in held]) for i in (0, 1))
            held.clear()
            if stop is not None:
                stop = np.searchsorted(cell, cell[-1])
                held.append((cell[stop:], found[stop:]))
            a, b = links_of_cells(cell[:stop], found[:stop].view(np.uint64), radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append((np.asarray(batch.column(0)), np.asarray(batch.column(1))))
            if held[0][0][0] != held[-1][0][-1]:
                yield close(0)
        if held:
            yield close()

    grid = prints.select("fingerprint").mapInArrow(spread, "cell long, print long")
    return grid.repartition("cell").sortWithinPartitions("cell").mapInArrow(join, "a long, b long")


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``fingerprint`` (number) and ``component_id``: the smallest id that links reach.

    Null, empty and blank texts have fingerprint zero and are linked like any other.
    Repeated rows stay; a null id is never the smallest while its component has others.
    An empty table gives an empty result.
    """
    slim = cut(with_fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", shingle=shingle))
    distinct = cut(slim.groupBy("fingerprint").agg(F.min("doc_id").alias("first")))
    roots = cut(components(links(distinct, radius)))
    # Of each component, and of each fingerprint without links, the smallest id.
    placed = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left").select("fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = placed.join(least, "root").select(F.col("fingerprint").alias("f"), "component_id")
    # A fingerprint may be shared by a large part of the table: its rows can be split.
    return slim.join(named, slim["fingerprint"] == named["f"]).select("doc_id", "fingerprint", "component_id")


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the first row of each near-duplicate component alone; all columns stay.

    Of repeated rows with the smallest id all stay, since nothing tells them apart.
    """
    groups = near_groups(docs, doc_id, text, radius, shingle)
    keep = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(keep, docs[doc_id].eqNullSafe(keep["__id"]), "left_semi")


class Prints:
    """Several fingerprints of a set as a sketch for ``similar_groups``."""

    kind, size, passes = np.dtype(np.uint64), PRINTS, 5

    def make(self, members: np.ndarray) -> np.ndarray:
        out = np.empty(PRINTS, np.uint64)
        for k in range(PRINTS):
            hashes = mix(members ^ _PRINT_SEEDS[k]).astype("<u8")
            ones = np.zeros(64, np.int64)
            for i in range(0, len(hashes), 1 << 16):
                ones += np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            out[k] = np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0]
        return out

    def keys(self, rows: np.ndarray, part: int) -> np.ndarray:
        """The grid over several choices of axes of each fingerprint of a part.

        At this radius segments are single bits: two random texts then share a cell less
        often, for the same chance of two similar ones, than with counts of two bits.
        """
        found = [mix((rows[:, k] & axes) ^ _PRINT_SEEDS[k : k + 1] * np.uint64(2 * c + 1)) for k in range(part, PRINTS, self.passes) for c, axes in enumerate(_AXES)]
        return np.stack(found, axis=1)

    def near(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
        """A bit differs where a random plane parts the two sets: in the share of their angle."""
        share = float(np.arccos(2 * percent / (100 + percent))) / np.pi
        radius = 64 * PRINTS * share + SIGMAS * float(np.sqrt(64 * PRINTS * share * (1 - share)))
        near = np.bitwise_count(embed(a) ^ embed(b)).sum(axis=1) <= radius
        near[near] = np.bitwise_count((a ^ b)[near]).sum(axis=1) <= radius
        return near


def similar_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, shingle: int = WORDS) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` by similarity of shingle sets; see ``similar_groups``."""
    return similar_groups(docs, Prints(), percent, shingle, doc_id, text)


def first_of_similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, shingle: int = WORDS) -> DataFrame:
    """``docs`` with the rows of the smallest id of each component alone; all columns stay."""
    groups = similar_texts(docs, doc_id, text, percent, shingle)
    keep = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(keep, docs[doc_id].eqNullSafe(keep["__id"]), "left_semi")


def digests(docs: DataFrame) -> DataFrame:
    found = near_groups(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
