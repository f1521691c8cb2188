"""Linking texts whose sets of word shingles are similar, around hubs of candidate buckets.

A sketch tells which texts may be similar: its keys make buckets of candidates, and an
estimate from two sketches excludes.  What stays is decided on the sets of the texts.

Equal sets are one member.  A member's degree is the sum of the sizes of its buckets: of a
text and its edited copies the text itself has the greatest, since copies are less like
each other than like it.  In a bucket each member is compared with the one of the greatest
degree, and of each member's candidates the one of the greatest degree is confirmed first;
whatever the links found so far do not connect then meets the whole bucket, in blocks.  So a
bucket of copies gives about one link a copy, and no link between sets that differ is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.functions.store import cut
from tilth.llm.graph import components
from tilth.llm.text import Words, mix, slices

#: Candidates of one text that are confirmed in one run, beside one copy of its set.
RUN = 512
#: Members, and shingles of theirs, in a block of those around a hub.
BLOCK_MEMBERS, BLOCK_SHINGLES = 1024, 1 << 19


class Sketch(Protocol):
    """A summary of fixed size of a set of 64-bit hashes."""

    kind: np.dtype
    size: int
    #: Keys are met in so many passes, each with its part of them, so that one pass's exchange stays small.
    passes: int

    def make(self, members: np.ndarray) -> np.ndarray:
        """The sketch of a set, given as ascending hashes: ``size`` numbers of ``kind``."""

    def keys(self, rows: np.ndarray, part: int) -> np.ndarray:
        """Rows of the 64-bit keys of one pass, of rows of sketches: members that share a key are candidates."""

    def near(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
        """Which rows of ``a`` and ``b``, of sets of the given sizes, are not clearly below the bound."""


def sets_of(texts: pa.Array, shingle: int) -> list[np.ndarray]:
    """Ascending distinct hashes of each text's shingles; fewer words are one shingle, none are none."""
    words = Words(texts)
    hashes = mix(words.hashes())
    out = []
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
        n = min(shingle, b - a)
        if not n:
            out.append(hashes[:0])
            continue
        found = np.full(b - a - n + 1, n, np.uint64)
        for i in range(n):
            found = mix(found + hashes[a + i : b - n + 1 + i])
        out.append(np.unique(found))
    return out


def with_sketches(docs: DataFrame, sketch: Sketch, text: str, shingle: int) -> DataFrame:
    """``docs`` without its text but with ``n`` (size of the set), ``digest`` (128 bits of the set) and ``sketch``."""
    fields = [f for f in docs.schema.fields if f.name != text]
    schema = T.StructType([*fields, T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("sketch", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            found = sets_of(batch.column(text), shingle)
            made = [
                pa.array([len(x) for x in found], pa.int64()), pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in found], pa.binary()),
                pa.array([sketch.make(x).tobytes() if len(x) else None for x in found], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in fields), *made], names=schema.names)

    return docs.mapInArrow(run, schema)


def _rows(sketch: Sketch, column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), sketch.kind).reshape(-1, sketch.size)


def _bands(members: DataFrame, sketch: Sketch, part: int) -> DataFrame:
    """``key``, ``node``, ``n`` for each key of each member in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = sketch.keys(_rows(sketch, batch.column("sketch")), part)
            nodes, sizes = (np.repeat(np.asarray(batch.column(x)), keys.shape[1]) for x in ("node", "n"))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(nodes), pa.array(sizes)], names=["key", "node", "n"])

    return members.select("node", "n", "sketch").mapInArrow(run, "key long, node long, n long")


def _likely(pairs: DataFrame, members: DataFrame, sketch: Sketch, percent: int) -> DataFrame:
    """Pairs ``a``, ``b`` whose estimate is not clearly below the bound."""
    side = [members.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}")) for x in "ab"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (_rows(sketch, batch.column(x)) for x in ("s_a", "s_b"))
            near = sketch.near(a, b, np.asarray(batch.column("n_a")), np.asarray(batch.column("n_b")), percent)
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return pairs.join(side[0], "a").join(side[1], "b").mapInArrow(run, "a long, b long")


def _texts(nodes: DataFrame, members: DataFrame, docs: DataFrame) -> DataFrame:
    """``node``, ``digest``, ``text``: a whole text of each of the given members."""
    places = members.join(nodes.distinct(), "node").select("node", "digest", F.col("at.id").alias("p_id"), F.col("at.th").alias("p_th"))
    given = docs.select(F.col("id").alias("g_id"), F.col("text").alias("text"), F.xxhash64("text").alias("g_th"))
    return cut(places.join(given, F.col("p_id").eqNullSafe(F.col("g_id")) & (F.col("p_th") == F.col("g_th"))).select("node", "digest", "text"))


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirmed(pairs: DataFrame, members: DataFrame, docs: DataFrame, percent: int, shingle: int) -> DataFrame:
    """The pairs whose sets, made anew from the whole texts, are similar enough.

    A text ``a`` comes once for each run of its candidates, not once a pair; candidates
    of a text with very many are several runs.
    """
    runs = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(RUN)).alias("runs"))
    dealt = cut(pairs.join(runs, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("runs")).alias("run")))
    texts = _texts(dealt.select(F.col("a").alias("node")).unionAll(dealt.select(F.col("b").alias("node"))), members, docs)
    centre = dealt.select("a", "run").distinct().join(texts, F.col("a") == F.col("node")).select("a", "run", F.lit(None).cast("long").alias("b"), "digest", "text")
    others = dealt.join(texts, F.col("b") == F.col("node")).select("a", "run", "b", "digest", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = None, None
        for batch in slices(batches, "text"):
            found = sets_of(batch.column("text"), shingle)
            links: list[tuple[int, int]] = []
            for a, number, b, digest, members_ in zip(*(batch.column(x).to_pylist() for x in ("a", "run", "b", "digest")), found, strict=True):
                if xxhash.xxh3_128_digest(members_.tobytes()) != digest:
                    continue  # another text of the same id and hash
                if b is None:
                    held, at = members_, (a, number)
                elif at == (a, number) and _similar(held, members_, percent):
                    links.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["a", "b"])

    sorted_ = centre.unionByName(others).repartition("a", "run").sortWithinPartitions("a", "run", F.asc_nulls_first("b"))
    return sorted_.mapInArrow(run, "a long, b long").distinct()


def _crossed(placed: DataFrame, members: DataFrame, docs: DataFrame, sketch: Sketch, percent: int, shingle: int) -> DataFrame:
    """Links between members of a bucket that lie in different components.

    ``placed`` has each bucket's ``key``, ``pivot``, its component ``home``, and the other
    members with ``node``, ``n``, ``root``.  Around a pivot the members outside its
    component meet all members, in blocks of bounded size: estimates exclude first, sets
    decide, and of the links found only those of a spanning forest leave a pair of blocks.
    """
    mixed = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("key")
    group = cut(placed.join(mixed, "key").select("pivot", "node", "n", "root", "home").distinct())

    def blocks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("pivot").agg(F.greatest(F.ceil(F.count("*") / F.lit(BLOCK_MEMBERS)), F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES))).cast("long").alias(name))

    outside = group.filter("root != home")
    counts = cut(blocks(outside, "lefts").join(blocks(group, "rights"), "pivot"))
    texts = _texts(group.join(counts, "pivot", "left_semi").select("node"), members, docs)
    zero = F.lit(0).cast("long")

    def side(df: DataFrame, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        dealt = df.join(counts, "pivot").withColumn(mine, F.pmod(F.xxhash64("node"), F.col(own))).withColumn(theirs, F.explode(F.sequence(zero, F.col(other) - 1)))
        # Both sides come from the same tables: their columns get names of their own.
        named = dealt.join(texts, "node").select(*[F.col(x).alias(f"{mine}_{x}") for x in ("pivot", "i", "j", "node", "root", "digest", "text")])
        return named.groupBy(f"{mine}_pivot", f"{mine}_i", f"{mine}_j")

    def read(table: pa.Table) -> tuple[list[int], list[int], list[np.ndarray], np.ndarray]:
        table = table.rename_columns([x[2:] for x in table.column_names])
        found = sets_of(table["text"].combine_chunks(), shingle)
        good = [i for i, (x, d) in enumerate(zip(found, table["digest"].to_pylist(), strict=True)) if xxhash.xxh3_128_digest(x.tobytes()) == d]
        nodes, roots = (table[x].to_pylist() for x in ("node", "root"))
        return [nodes[i] for i in good], [roots[i] for i in good], [found[i] for i in good], np.array([sketch.make(found[i]) for i in good], sketch.kind).reshape(-1, sketch.size)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        links: list[tuple[int, int]] = []
        (a, root_a, sets_a, sketch_a), (b, root_b, sets_b, sketch_b) = read(left), read(right)
        above: dict[int, int] = {}

        def top(x: int) -> int:
            while x in above:
                x = above[x]
            return x

        sizes = np.array([len(x) for x in sets_b])
        for i in range(len(a)):
            if not len(b):
                break
            n = len(sets_a[i])
            fits = np.flatnonzero((100 * np.minimum(n, sizes) >= percent * np.maximum(n, sizes)) & (np.asarray(root_b) != root_a[i]))
            near = sketch.near(sketch_a[i][None], sketch_b[fits], np.full(len(fits), n), sizes[fits], percent)
            for j in fits[near].tolist():
                x, y = top(root_a[i]), top(root_b[j])
                if x != y and _similar(sets_a[i], sets_b[j], percent):
                    above[x] = y
                    links.append((a[i], b[j]))
        return pa.table([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return side(outside, "lefts", "rights", "i", "j").cogroup(side(group, "rights", "lefts", "j", "i")).applyInArrow(meet, "a long, b long")


def similar_groups(docs: DataFrame, sketch: Sketch, percent: int, shingle: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``: the smallest id that links reach.

    Null, empty and blank texts have an empty set and are linked with nothing, so their
    own id is their component's.  Repeated rows stay; a null id is never the smallest
    while its component has others.  An empty table gives an empty result.
    """
    given = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    slim = cut(with_sketches(given.withColumn("th", F.xxhash64("text")), sketch, "text", shingle))
    members = slim.filter("n > 0").groupBy("digest").agg(F.min("id").alias("first"), F.max(F.struct("id", "th")).alias("at"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    members = cut(members.withColumn("node", F.monotonically_increasing_id()))
    met = None
    for part in range(sketch.passes):
        bands = _bands(members, sketch, part)
        crowded = bands.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
        found = cut(bands.join(crowded, "key"))
        met = found if met is None else met.unionByName(found)
    degrees = met.groupBy("node").agg(F.sum("size").alias("degree"))
    met = met.join(degrees, "node")
    hubs = met.groupBy("key").agg(F.max(F.struct("degree", (-F.col("node")).alias("last"))).alias("hub"))
    met = cut(met.join(hubs, "key").select("key", "node", "n", F.col("hub.degree").alias("degree"), (-F.col("hub.last")).alias("pivot")))
    pairs = met.filter("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"), "degree").distinct()
    tried = cut(_likely(pairs.select("a", "b"), members, sketch, percent))
    best = cut(tried.join(pairs, ["a", "b"]).groupBy("b").agg(F.max(F.struct("degree", "a")).alias("best")).select("best.a", "b"))
    links = cut(_confirmed(best, members, given, percent, shingle))
    # What the links so far do not connect: other candidates, then pairs in a bucket without its hub.
    roots = cut(components(links)).select("node", "root")
    tied = tried.join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left").join(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left")
    rest = cut(tied.filter(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b").join(best, ["a", "b"], "left_anti"))
    links = cut(links.unionByName(_confirmed(rest, members, given, percent, shingle)))
    roots = cut(components(links)).select("node", "root")
    placed = met.join(roots, "node", "left").join(roots.select(F.col("node").alias("pivot"), F.col("root").alias("home")), "pivot", "left").filter("node != pivot")
    placed = cut(placed.select("key", "pivot", "node", "n", F.coalesce("root", "node").alias("root"), F.coalesce("home", "pivot").alias("home")))
    links = links.unionByName(_crossed(placed, members, given, sketch, percent, shingle))
    found = cut(components(links))
    joined = members.select("digest", "first", "node").join(found, "node", "left").select("digest", "first", F.coalesce("root", "node").alias("root"))
    least = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    components_ = joined.join(least, "root").select(F.col("digest").alias("d"), "component_id")
    # A set may be shared by a large part of the table: its rows can be split.
    full = slim.join(components_, (F.col("digest") == F.col("d")) & (F.col("n") > 0), "left")
    return full.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
