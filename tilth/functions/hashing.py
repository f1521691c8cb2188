"""Deterministic, partition-independent random order.

``stable_hash`` orders rows by an md5 of seed and id, so a sample does not depend
on how the data happens to be partitioned and survives recomputation.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilth.functions.store import cut

# Hash prefix length: 16**3 buckets split every group, however large.
PREFIX = 3
# A bucket with more rows than this is cut by further digits before it is sorted.
SORT_ROWS = 20_000
# A table of bucket starts up to this many rows (some megabytes) is broadcast.
START_ROWS = 100_000
# Above this many rows a global top-n is taken by rank instead of one sorted task.
TOP_ROWS = 10_000


def stable_hash(seed: object, *ids: Column | str) -> Column:
    parts = [F.col(i) if isinstance(i, str) else i for i in ids]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def hash_number(digest: Column) -> Column:
    """First 60 bits of an md5 digest as a non-negative long."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def hash_unit(digest: Column) -> Column:
    """First 52 bits of an md5 digest as a double in [0, 1)."""
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def hash_ranked(
    df: DataFrame,
    by: Sequence[str],
    id_col: str,
    seed: object = 42,
    *,
    at_most: int | None = None,
    rank: str = "_rank",
    size: str = "_size",
) -> DataFrame:
    """Add the 1-based position of each row in the random order of its group, and the group size.

    A group is never sorted in one task: rows are bucketed by hash prefix, bucket
    sizes give each bucket its starting position, and only rows of one
    (group, bucket) are numbered together.  ``at_most`` drops, before the shuffle,
    buckets that start beyond it; the caller still filters on the exact rank.

    The table of bucket starts is counted first: up to ``START_ROWS`` rows it is
    sent to all tasks and rows move once; beyond that it is joined by shuffle.
    """
    by = list(by)
    keyed = df.withColumn("_h", stable_hash(seed, id_col)).withColumn(
        "_b", F.substring("_h", 1, PREFIX)
    )
    in_order = W.partitionBy(*by).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    starts = cut(
        keyed.groupBy(*by, "_b")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(in_order), F.lit(0)))
        .withColumn(size, F.sum("_n").over(W.partitionBy(*by)))
        .select(
            *[F.col(c).alias(f"_k_{c}") for c in by], F.col("_b").alias("_k_b"), "_start", size
        )
    )
    if at_most is not None:
        starts = starts.filter(F.col("_start") < at_most)
    if starts.count() <= START_ROWS:
        starts = F.broadcast(starts)
    on = F.col("_b") == F.col("_k_b")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    w = W.partitionBy(*by, "_b").orderBy("_h", id_col)
    return (
        keyed.join(starts, on)
        .withColumn(rank, (F.row_number().over(w) + F.col("_start")).cast("long"))
        .drop("_h", "_b", "_start", "_k_b", *[f"_k_{c}" for c in by])
    )


def hash_cuts(df: DataFrame, by: Sequence[str], id_col: str, quota: Callable[[DataFrame], DataFrame], seed: object = 42) -> DataFrame:
    """Where the first rows of each group end in random order: ``_k_`` keys, ``_size``, ``_quota``, ``_cut`` (hash and id of the last).

    ``quota`` adds the wanted number ``_quota`` to a table of groups and their ``_size``.
    Rows are counted by hash prefix; the one bucket of a group that its quota ends in is
    counted by longer prefixes until it is small, and only its hashes and ids are ranked.
    Ids must be unique.  ``_cut`` is null where a group gives no row, or all.
    """
    by = list(by)
    keys = [f"_k_{c}" for c in by]
    keyed = df.select(*[F.col(c).alias(k) for c, k in zip(by, keys)], F.col(id_col).alias("_id"), stable_hash(seed, id_col).alias("_h"))
    in_order = W.partitionBy(*keys).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)

    def counted(rows: DataFrame, digits: int, *more: str) -> DataFrame:
        return rows.groupBy(*keys, F.substring("_h", 1, digits).alias("_b"), *more).agg(F.count(F.lit(1)).alias("_n"))

    def ending(buckets: DataFrame, base: Column) -> DataFrame:
        """The bucket of each group that its quota ends in."""
        placed = buckets.withColumn("_start", base + F.coalesce(F.sum("_n").over(in_order), F.lit(0)))
        return placed.filter((F.col("_start") < F.col("_quota")) & (F.col("_quota") <= F.col("_start") + F.col("_n"))).select(*keys, "_b", "_start", "_n", "_quota")

    def within(edges: DataFrame, digits: int) -> DataFrame:
        """Rows of those buckets."""
        named = edges.select(*[F.col(k).alias(f"_e{k}") for k in keys], F.col("_b").alias("_eb"), F.col("_start").alias("_base"), "_quota")
        on = F.substring("_h", 1, digits) == F.col("_eb")
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"_e{k}"))
        return keyed.join(_sent(named), on).select(*keys, "_id", "_h", "_base", "_quota")

    buckets = cut(counted(keyed, PREFIX))
    sizes = buckets.groupBy(*keys).agg(F.sum("_n").alias("_size"))
    groups = cut(quota(sizes))
    wanted = groups.filter((F.col("_quota") > 0) & (F.col("_quota") < F.col("_size"))).select(*[F.col(k).alias(f"_g{k}") for k in keys], "_quota")
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_g{k}"))
    edges, digits = cut(ending(buckets.join(wanted, on), F.lit(0))), PREFIX
    # A digest has 32 digits; equal ones are ordered by id.
    while digits + PREFIX <= 30 and not edges.filter(F.col("_n") > SORT_ROWS).isEmpty():
        inner = counted(within(edges, digits), digits + PREFIX, "_base", "_quota")
        digits += PREFIX
        edges = cut(ending(inner, F.col("_base")))
    rank = F.row_number().over(W.partitionBy(*keys).orderBy("_h", "_id")) + F.col("_base")
    last = within(edges, digits).withColumn("_at", rank).filter(F.col("_at") == F.col("_quota"))
    last = last.select(*[F.col(k).alias(f"_l{k}") for k in keys], F.struct("_h", "_id").alias("_cut"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_l{k}"))
    return cut(groups.join(last, on, "left").select(*keys, "_size", "_quota", "_cut"))


def _sent(table: DataFrame) -> DataFrame:
    """A written table, to all tasks if it is small."""
    return F.broadcast(table) if table.count() <= START_ROWS else table


def first_by_hash(df: DataFrame, by: Sequence[str], id_col: str, quota: Callable[[DataFrame], DataFrame], seed: object = 42, out: str = "_first") -> DataFrame:
    """Add whether a row is among the ``_quota`` first of its group in random order; see ``hash_cuts``.

    Rows are compared with their group's cut where they are read: while groups are up to
    ``START_ROWS``, which is counted, no row moves.
    """
    cuts = hash_cuts(df, by, id_col, quota, seed)
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    at = F.struct(stable_hash(seed, id_col).alias("_h"), F.col(id_col).alias("_id"))
    inside = F.when(F.col("_quota") <= 0, False).when(F.col("_quota") >= F.col("_size"), True).otherwise(at <= F.col("_cut"))
    return df.join(_sent(cuts), on).withColumn(out, inside).drop("_size", "_quota", "_cut", *[f"_k_{c}" for c in by])
