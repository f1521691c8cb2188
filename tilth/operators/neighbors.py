"""Exact nearest neighbours and what is built on them.

Donors of a group are dealt to the leaves of a two-level pivot tree (as in Lu et al.,
"Efficient processing of k nearest neighbor joins using MapReduce", 2012); the tree has
as many leaves as the counted donors need, and groups that one block holds have none.
A query meets its nearest leaf first.  Its k-th distance there bounds how far it must
look, and the triangle inequality leaves only those leaves that reach into that
distance.  These are counted before any is met: where they hold more than half of all pairs
of a group, its rows are compared in few large blocks instead, without leaves.  Leaves meet queries in blocks of bounded size, and a pair of blocks returns
its best k for each query, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.functions.hashing import hash_unit, stable_hash
from tilth.functions.store import cut
from tilth.schema import missing, nan_to_null

BLOCK_ROWS = 4096
#: The trees of all groups together, as they go to every task: leaves, and bytes of their centres.
MAX_LEAVES, TREE_BYTES = 16_384, 32 << 20
#: Bytes of a block as numbers where a group is compared whole, and of visits that leave a task together.
BLOCK_BYTES = 16 << 20
#: Sampled centres for each leaf wanted; empty and doubled ones fall away.
OVERSAMPLE = 1.5


class Tree:
    """Leaf centres of one group below about the square root of their number of top centres."""

    def __init__(self, sample: np.ndarray) -> None:
        tops = sample[: math.ceil(math.sqrt(len(sample)))]
        owner = _squares(sample, tops).argmin(axis=1)
        order = np.argsort(owner, kind="stable")
        used, starts = np.unique(owner[order], return_index=True)
        self.tops, self.leaves = tops[used], sample[order]
        self.starts = np.append(starts, len(sample))
        #: Rows of each leaf and their largest distance to its centre, known once donors are placed.
        self.rows, self.radius = np.zeros(len(sample), np.int64), np.zeros(len(sample))

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        """A near leaf of each vector: the nearest below the nearest top."""
        top = _squares(vectors, self.tops).argmin(axis=1)
        out = np.zeros(len(vectors), np.int64)
        for t in np.unique(top):
            mine = np.flatnonzero(top == t)
            a, b = self.starts[t], self.starts[t + 1]
            out[mine] = a + _squares(vectors[mine], self.leaves[a:b]).argmin(axis=1)
        return out

    def first(self, away: np.ndarray, keep: int) -> np.ndarray:
        """Which leaves each row of centre distances meets first: the nearest with ``keep`` donors, else all."""
        full = self.rows >= keep
        if not full.any():
            return np.broadcast_to(self.rows > 0, away.shape)
        out = np.zeros(away.shape, bool)
        out[np.arange(len(away)), np.where(full, away, np.inf).argmin(axis=1)] = True
        return out

    def reaching(self, away: np.ndarray, within: np.ndarray) -> np.ndarray:
        """Leaves that may hold donors within the given distances."""
        slack = 1e-9 * (1.0 + away)
        return (away - self.radius - slack <= within[:, None]) & (self.rows > 0)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances by direct differences, in slices that bound memory."""
    out = np.empty((len(a), len(b)))
    step = max(1, 1_000_000 // max(1, b.size))
    for i in range(0, len(a), step):
        diff = a[i : i + step, None, :] - b[None, :, :]
        out[i : i + step] = (diff * diff).sum(axis=2)
    return out


def _smallest(a: np.ndarray, b: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``b`` nearest to each row of ``a`` and their squares, ties by position.

    With many coordinates a matrix product finds which rows can matter and only those
    are measured; where its rounding leaves that open, all are.
    """
    keep, wide = min(keep, len(b)), min(len(b), keep + 16)
    if a.shape[1] < 8 or wide == len(b):
        squares = _squares(a, b)
        at = np.argsort(squares, axis=1, kind="stable")[:, :keep]
        return at, np.take_along_axis(squares, at, axis=1)
    at, found = np.empty((len(a), keep), np.int64), np.empty((len(a), keep))
    size_b = (b * b).sum(axis=1)
    step = max(1, 2_000_000 // len(b))
    for i in range(0, len(a), step):
        part = a[i : i + step]
        size_a = (part * part).sum(axis=1)
        rough = size_a[:, None] + size_b - 2 * part @ b.T
        near = np.sort(np.argpartition(rough, wide - 1, axis=1)[:, :wide], axis=1)
        diff = part[:, None, :] - b[near]
        squares = (diff * diff).sum(axis=2)
        order = np.argsort(squares, axis=1, kind="stable")[:, :keep]
        at[i : i + step] = np.take_along_axis(near, order, axis=1)
        found[i : i + step] = np.take_along_axis(squares, order, axis=1)
        beyond = np.take_along_axis(rough, near, axis=1).max(axis=1)
        open_ = np.flatnonzero(found[i : i + step, -1] >= beyond - 1e-9 * (1.0 + size_a + size_b.max()))
        if len(open_):
            exact = _squares(part[open_], b)
            at[i + open_] = np.argsort(exact, axis=1, kind="stable")[:, :keep]
            found[i + open_] = np.take_along_axis(exact, at[i + open_], axis=1)
    return at, found


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), float).reshape(-1, width)


def _added(df: DataFrame, **fields: T.DataType) -> T.StructType:
    return T.StructType([*df.schema.fields, *(T.StructField(n, t) for n, t in fields.items())])


def _by_group(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray]]:
    """Groups of a batch and the positions of their rows."""
    names = batch.column("_g").dictionary_encode()
    number = np.asarray(names.indices)
    for i, name in enumerate(names.dictionary.to_pylist()):
        yield name, np.flatnonzero(number == i)


def _distinct(df: DataFrame, keep: int) -> DataFrame:
    """Donors with at most ``keep`` smallest ids per distinct vector.

    More copies of one vector can never be among the nearest ``keep``, so a vector
    repeated by a third of all rows costs nothing and no result is lost.
    """
    w = W.partitionBy("_g", "_v").orderBy("_id")
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= keep).drop("_r")


def _trees(given: DataFrame, width: int, leaf_rows: int, leaves: int | None) -> dict[str, Tree]:
    """Trees of the groups with more than ``leaf_rows`` donors; at most total / ``leaf_rows`` of them."""
    large = {r["_g"]: r["n"] for r in given.groupBy("_g").agg(F.count("*").alias("n")).filter(F.col("n") > leaf_rows).collect()}
    if not large:
        return {}
    shares = [(g, min(1.0, OVERSAMPLE * (leaves or -(-n // leaf_rows)) / n)) for g, n in large.items()]
    wanted = given.sparkSession.createDataFrame(shares, "_g string, _share double")
    hashed = given.join(F.broadcast(wanted), "_g").withColumn("_h", stable_hash("pivot", "_id"))
    sample = hashed.filter(hash_unit(F.col("_h")) < F.col("_share")).select("_g", "_h", "_v").collect()
    found: dict[str, list] = {}
    for r in sorted(sample, key=lambda r: (r["_g"], r["_h"])):
        found.setdefault(r["_g"], []).append(r["_v"])
    # In hash order, so that tops are a random part; copies of a centre are one.
    return {g: Tree(np.array(list(dict.fromkeys(map(tuple, v))), float).reshape(-1, width)) for g, v in found.items()}


def _placed(given: DataFrame, trees: Broadcast | None, width: int) -> DataFrame:
    """Donors with their leaf and the distance to its centre; groups without a tree are leaf 0."""
    if trees is None:
        return given.select("*", F.lit(0).cast("long").alias("_leaf"), F.lit(0.0).alias("_far"))
    schema = _added(given, _leaf=T.LongType(), _far=T.DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, far = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            vectors = _matrix(batch.column("_v"), width)
            for group, rows in _by_group(batch):
                if group in trees.value:
                    tree = trees.value[group]
                    leaf[rows] = tree.leaf_of(vectors[rows])
                    far[rows] = np.sqrt(((vectors[rows] - tree.leaves[leaf[rows]]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf), pa.array(far)], names=schema.names)

    return given.mapInArrow(run, schema)


def _met(batch: pa.RecordBatch, trees: dict[str, Tree], width: int, keep: int, bounded: bool) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Group, rows, and which leaves each of them meets, for rows of groups with a tree; few at a time."""
    vectors = _matrix(batch.column("_v"), width)
    for group, mine in _by_group(batch):
        if group in trees:
            tree = trees[group]
            for part in np.array_split(mine, 1 + len(mine) * len(tree.leaves) // 1_000_000):
                away = np.sqrt(_squares(vectors[part], tree.leaves))
                met = tree.first(away, keep)
                if bounded:
                    within = np.asarray(batch.column("_within"), float)[part]
                    met = tree.reaching(away, np.where(np.isnan(within), np.inf, within)) & ~met
                yield group, part, met


def _visits(asked: DataFrame, trees: Broadcast, width: int, keep: int, bounded: bool) -> DataFrame:
    """Queries with the leaves that they meet first; or, ``bounded`` by ``_within``, with all others that can matter."""
    schema = _added(asked.select("_g", "_key", "_v"), _leaf=T.LongType())
    most = max(1, BLOCK_BYTES // (8 * max(width, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = batch.select(["_g", "_key", "_v"])

            def visits(rows: np.ndarray, leaves: np.ndarray) -> Iterator[pa.RecordBatch]:
                for i in range(0, len(rows), most):
                    taken = plain.take(pa.array(rows[i : i + most]))
                    yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(leaves[i : i + most])], names=schema.names)

            if not bounded:
                for group, mine in _by_group(batch):
                    if group not in trees.value:
                        yield from visits(mine, np.zeros(len(mine), np.int64))
            for _, part, met in _met(batch, trees.value, width, keep, bounded):
                i, j = np.nonzero(met)
                yield from visits(part[i], j)

    return asked.mapInArrow(run, schema)


def _unbounded(asked: DataFrame, trees: Broadcast, width: int, keep: int) -> list[str]:
    """Groups whose queries would meet more than half of all their pairs of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, part, met in _met(batch, trees.value, width, keep, True):
                pairs = float((met @ trees.value[group].rows).sum())
                yield pa.RecordBatch.from_arrays([pa.array([group]), pa.array([pairs]), pa.array([float(len(part)) * trees.value[group].rows.sum()])], names=["_g", "met", "all"])

    found = asked.mapInArrow(run, "_g string, met double, all double").groupBy("_g").agg(F.sum("met").alias("met"), F.sum("all").alias("all"))
    return [r["_g"] for r in found.filter(F.col("met") > F.col("all") / 2).collect()]


def _compare(visits: DataFrame, placed: DataFrame, keep: int, width: int, block_rows: int) -> DataFrame:
    """``_g``, ``_key``, ``_id``, ``_square``: the best ``keep`` of each pair of blocks that meet in a leaf."""
    leaf = ["_g", "_leaf"]

    def blocks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*leaf).agg(F.ceil(F.count("*") / F.lit(block_rows)).cast("long").alias(name))

    counts = cut(blocks(visits, "_qb").join(blocks(placed, "_db"), leaf))
    zero = F.lit(0).cast("long")
    q = visits.join(counts, leaf).withColumn("_qi", F.pmod(F.xxhash64("_key"), F.col("_qb"))).withColumn("_di", F.explode(F.sequence(zero, F.col("_db") - 1)))
    d = placed.join(counts, leaf).withColumn("_di", F.pmod(F.xxhash64("_id"), F.col("_db"))).withColumn("_qi", F.explode(F.sequence(zero, F.col("_qb") - 1)))
    pair = [*leaf, "_qi", "_di"]
    schema = T.StructType([visits.schema["_g"], visits.schema["_key"], placed.schema["_id"], T.StructField("_square", T.DoubleType())])

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"_g": left["_g"].slice(0, 0), "_key": left["_key"].slice(0, 0), "_id": right["_id"].slice(0, 0), "_square": pa.array([], pa.float64())})
        right = right.sort_by("_id")
        at, squares = _smallest(_matrix(left["_v"], width), _matrix(right["_v"], width), keep)
        names = left.select(["_g", "_key"]).take(pa.array(np.repeat(np.arange(left.num_rows), at.shape[1])))
        return pa.table([names["_g"], names["_key"], right["_id"].take(pa.array(at.ravel())), pa.array(squares.ravel())], names=schema.names)

    return q.select(*pair, "_key", "_v").groupBy(*pair).cogroup(d.select(*pair, "_id", "_v").groupBy(*pair)).applyInArrow(nearest, schema)


def _nearest(asked: DataFrame, given: DataFrame, keep: int, width: int, block_rows: int, leaves: int | None = None) -> DataFrame:
    """``_g``, ``_key``, ``_id``, ``_square``, ``_r``: the ``keep`` nearest donors of each query (_g, _key, _v) in its group.

    Donors are (_g, _id, _v); all vectors have ``width`` numbers.  What goes to every task
    is bounded by ``MAX_LEAVES`` and ``TREE_BYTES``: beyond that leaves grow, and blocks
    of a leaf stay as they are.
    """
    spark = asked.sparkSession
    given = cut(given)
    most = max(1, min(MAX_LEAVES, TREE_BYTES // (8 * max(width, 1))))
    leaf_rows = max(block_rows, -(-given.count() // most))
    trees = _trees(given, width, leaf_rows, leaves)
    shared = spark.sparkContext.broadcast(trees) if trees else None
    placed = _placed(given, shared, width)
    best = W.partitionBy("_g", "_key").orderBy("_square", "_id")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= keep)

    if shared is None:
        return ranked(_compare(asked.select("*", F.lit(0).cast("long").alias("_leaf")), placed, keep, width, block_rows))
    placed, asked = cut(placed), cut(asked)
    for r in placed.filter(F.col("_g").isin(list(trees))).groupBy("_g", "_leaf").agg(F.count("*").alias("n"), F.max("_far").alias("far")).collect():
        trees[r["_g"]].rows[r["_leaf"]], trees[r["_g"]].radius[r["_leaf"]] = r["n"], r["far"]
    known = spark.sparkContext.broadcast(trees)
    first = cut(ranked(_compare(_visits(asked, known, width, keep, False), placed, keep, width, block_rows)).drop("_r"))
    within = first.groupBy("_g", "_key").agg(F.when(F.count("*") >= keep, F.sqrt(F.max("_square"))).alias("_within"))
    more = cut(asked.filter(F.col("_g").isin(list(trees))).join(within, ["_g", "_key"], "left"))
    whole = F.col("_g").isin(_unbounded(more, known, width, keep))
    second = _compare(cut(_visits(more.filter(~whole), known, width, keep, True)), placed, keep, width, block_rows)
    found = ranked(first.filter(~whole).unionByName(second))
    left = asked.filter(whole).withColumn("_leaf", F.lit(0).cast("long"))
    largest = left.groupBy("_g").count().agg(F.max("count")).first()[0]
    if not largest:
        return found
    # Every block of one side meets every one of the other: as few as keep all cores busy, or as memory allows.
    sides = math.ceil(math.sqrt(2 * spark.sparkContext.defaultParallelism))
    rows = max(block_rows, min(BLOCK_BYTES // (8 * width), -(-largest // sides)))
    given = placed.filter(whole).withColumn("_leaf", F.lit(0).cast("long"))
    return found.unionByName(ranked(_compare(left, given, keep, width, rows)))


def _whole(df: DataFrame, vector: str, width: object) -> DataFrame:
    """Rows whose vector can be compared: not null, of the given length, without null, NaN or infinite numbers."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.filter(F.col(vector).isNotNull() & (F.size(vector) == F.lit(width)) & ~F.coalesce(odd, F.lit(True)))


def knn_join(
    queries: DataFrame,
    donors: DataFrame,
    k: int,
    query_id: str,
    donor_id: str,
    vector_col: str,
    *,
    by: str | None = None,
    exclude_self: bool = False,
    pivots: int | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """The ``k`` nearest donors of every query: query_id, donor_id, distance, rank.

    Exact; ties by donor id.  ``by`` restricts neighbours to the same group, where null
    is a group of its own, and ``exclude_self`` drops the pair of equal ids (self joins).
    Vectors have the length that most donors have (of equals the greatest); rows whose
    vector is null, of another length, or holds a null, NaN or infinity neither ask nor
    give.  Queries with equal ids share one answer only if their vectors are equal too.
    ``pivots`` sets the leaves of groups beyond one block.
    """
    block_rows = BLOCK_ROWS if block_rows is None else block_rows
    group = F.coalesce(F.concat(F.lit("="), F.col(by).cast("string")), F.lit("")) if by else F.lit("")
    keep = k + 1 if exclude_self else k
    # Numbers move in the width that they have; they are compared as doubles.
    floats = all(df.schema[vector_col].dataType == T.ArrayType(T.FloatType(), df.schema[vector_col].dataType.containsNull) for df in (queries, donors))

    def side(df: DataFrame, id_col: str) -> DataFrame:
        return df.select(group.alias("_g"), F.col(id_col).alias("_id"), F.col(vector_col).cast("array<float>" if floats else "array<double>").alias("_v"))

    lengths = donors.filter(F.col(vector_col).isNotNull()).groupBy(F.size(vector_col).alias("w")).count()
    width = lengths.orderBy(F.desc("count"), F.desc("w")).limit(1).collect()
    if not width or k < 1:
        return _empty(queries, query_id, donors, donor_id)
    width = width[0]["w"]
    asked = _whole(side(queries, query_id), "_v", width)
    given = _distinct(_whole(side(donors, donor_id), "_v", width), keep)
    # One query per distinct vector, named by its smallest id; copies share the result.
    vectors = cut(asked.groupBy("_g", "_v").agg(F.min("_id").alias("_key")))
    found = _nearest(vectors, given, keep, width, block_rows, pivots)
    per_vector = found.groupBy("_g", "_key").agg(F.array_sort(F.collect_list(F.struct("_r", "_id", F.sqrt("_square").alias("_dist")))).alias("_near"))
    answered = vectors.join(per_vector, ["_g", "_key"])
    near = F.filter("_near", lambda s: s["_id"] != F.col("_q")) if exclude_self else F.col("_near")
    return (
        asked.withColumnRenamed("_id", "_q")
        .join(answered.select("_g", "_v", "_near"), ["_g", "_v"])
        .select("_q", F.posexplode(F.slice(near, 1, k)).alias("_p", "_s"))
        .select(F.col("_q").alias("query_id"), F.col("_s._id").alias("donor_id"), F.col("_s._dist").alias("distance"), (F.col("_p") + 1).cast("long").alias("rank"))
    )


def _empty(queries: DataFrame, query_id: str, donors: DataFrame, donor_id: str) -> DataFrame:
    q = queries.schema[query_id].dataType.simpleString()
    d = donors.schema[donor_id].dataType.simpleString()
    return queries.sparkSession.createDataFrame([], f"query_id {q}, donor_id {d}, distance double, rank long")


def impute_knn(
    df: DataFrame, id_col: str, features: Sequence[str], k: int = 5, targets: Sequence[str] | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Fill numeric gaps with the mean of the ``k`` nearest rows that have the value.

    The distance uses coordinates present on both sides, scaled up by total over
    present coordinates.  Rows with gaps in the same columns form a pattern: between
    two patterns the shared coordinates are fixed, so their rows are a nearest-neighbour
    join of their own on these, which pivots bound, and a value is the mean over the
    best of all patterns that have it.  A pattern meets another only if that has what it
    lacks.  Rows that agree in all features are one query; copies of a donor beyond
    ``k`` are dropped, as they cannot change a mean of k.  Infinite values neither ask nor
    give.  Without any comparable donor the column mean is used.
    """
    block_rows = BLOCK_ROWS if block_rows is None else block_rows
    features, targets = list(features), list(targets or features)
    df = nan_to_null(df)
    width = len(features)
    vector = F.array(*[F.col(c).cast("double") for c in features])
    wanted = [features.index(c) for c in targets]
    gap = F.lit(False)
    for c in targets:
        gap = gap | missing(df, c)
    finite = ~F.exists("_v", lambda x: F.coalesce(F.abs(x) == float("inf"), F.lit(False)))
    has = F.concat(*[F.when(F.element_at("_v", i + 1).isNull(), "0").otherwise("1") for i in range(width)])
    rows = df.select(F.col(id_col).alias("_id"), vector.alias("_v")).filter(finite).withColumn("_has", has)
    lacks = F.lit(False)
    for f in wanted:
        lacks = lacks | (F.substring("_has", f + 1, 1) == "0")
    queries = cut(rows.filter(lacks).groupBy("_v", "_has").agg(F.min("_id").alias("_key")))
    own = W.partitionBy("_v").orderBy("_id")
    donors = cut(rows.withColumn("_r", F.row_number().over(own)).filter(F.col("_r") <= k).drop("_r"))
    # Pairs of patterns: one row each, at most two to the power of the features on a side.
    pairs = queries.select(F.col("_has").alias("_q")).distinct().crossJoin(donors.select(F.col("_has").alias("_d")).distinct())
    pairs = cut(pairs.filter(F.expr(_useful(wanted)) & F.expr(_shared(width) + " > 0")))

    def side(table: DataFrame, mine: str, name: str) -> DataFrame:
        joined = table.join(pairs, F.col("_has") == F.col(mine))
        # Coordinates that are not shared are zero on both sides.
        shared = [F.when(F.substring("_q", i + 1, 1).eqNullSafe("1") & F.substring("_d", i + 1, 1).eqNullSafe("1"), F.element_at("_v", i + 1)).otherwise(0.0) for i in range(width)]
        return joined.select(F.concat("_q", F.lit("|"), "_d").alias("_g"), F.col(name), F.array(*shared).alias("_v"))

    # Rows that agree in what is shared are one query of the pair; all get its answer.
    asked = cut(side(queries, "_q", "_key").withColumnRenamed("_key", "_one"))
    same = asked.groupBy("_g", "_v").agg(F.min("_one").alias("_key"))
    given = _distinct(side(donors, "_d", "_id"), k)
    found = _nearest(cut(same), given, k, width, block_rows)
    near = found.join(asked.join(same, ["_g", "_v"]).select("_g", "_key", "_one"), ["_g", "_key"])
    values = donors.select(F.col("_id").alias("_did"), F.col("_v").alias("_given"))
    patterns = F.split("_g", "\\|")
    split = near.withColumn("_q", patterns[0]).withColumn("_d", patterns[1])
    scaled = split.withColumn("_dist", F.sqrt(F.col("_square") * (F.lit(float(width)) / F.expr(_shared(width)))))
    each = scaled.join(values, F.col("_id") == F.col("_did")).select(
        "_one", "_id", "_dist", F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.element_at("_given", f + 1).alias("v"), (F.substring("_q", f + 1, 1) == "0").alias("asks")) for f in wanted])).alias("t")
    )
    best = W.partitionBy("_one", "t.f").orderBy("_dist", "_id")
    filled = (
        each.filter(F.col("t.asks") & F.col("t.v").isNotNull())
        .withColumn("_r", F.row_number().over(best))
        .filter(F.col("_r") <= k)
        .groupBy("_one")
        .agg(*[F.avg(F.when(F.col("t.f") == f, F.col("t.v"))).alias(f"_fill_{features[f]}") for f in wanted])
        .join(queries.select(F.col("_key").alias("_one"), F.col("_v").alias("_qv")), "_one")
        .drop("_one")
    )
    means = df.agg(*[F.avg(c).alias(c) for c in targets]).first()
    # Complete rows need no lookup and skip the join.
    complete = df.filter(~gap)
    repaired = df.withColumn("_v", vector).filter(gap).join(filled, F.col("_v") == F.col("_qv"), "left")
    repaired = repaired.select(
        *[F.coalesce(F.col(c).cast("double"), F.col(f"_fill_{c}"), F.lit(means[c])).alias(c) if c in targets else F.col(c) for c in df.columns]
    )
    complete = complete.select(*[F.col(c).cast("double").alias(c) if c in targets else F.col(c) for c in df.columns])
    return complete.unionByName(repaired)


def _shared(width: int) -> str:
    """How many coordinates two patterns ``_q`` and ``_d`` share."""
    return "(" + " + ".join(f"cast(substring(_q, {i + 1}, 1) = '1' and substring(_d, {i + 1}, 1) = '1' as int)" for i in range(width)) + ")"


def _useful(wanted: list[int]) -> str:
    """Whether pattern ``_d`` has a wanted value that ``_q`` lacks."""
    return " or ".join(f"(substring(_q, {f + 1}, 1) = '0' and substring(_d, {f + 1}, 1) = '1')" for f in wanted)
