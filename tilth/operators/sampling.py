"""Deterministic samples, quotas, splits and random order.

Every sample is taken by rank in the md5 order of seed and id: exact in size,
the same after recomputation, and independent of partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilth.functions.hashing import TOP_ROWS, first_by_hash, hash_ranked, stable_hash


def sample_n(df: DataFrame, n: int, id_col: str, seed: object = 42) -> DataFrame:
    """Exactly ``n`` random rows, or all rows if there are fewer."""
    if n <= TOP_ROWS:
        return df.orderBy(stable_hash(seed, id_col), id_col).limit(n)
    return hash_ranked(df, [], id_col, seed, at_most=n).filter(F.col("_rank") <= n).drop("_rank", "_size")


def shuffle(df: DataFrame, id_col: str, seed: object = 42) -> DataFrame:
    """Rows in random order: a range-partitioned sort, no single task."""
    return df.orderBy(stable_hash(seed, id_col), id_col)


def undersample(
    df: DataFrame, label_col: str, id_col: str, n: int | None = None, seed: object = 42
) -> DataFrame:
    """At most ``n`` random rows per class (the smallest class by default); null labels are dropped."""
    labelled = df.filter(F.col(label_col).isNotNull())
    if n is None:
        smallest = labelled.groupBy(label_col).agg(F.count(F.lit(1)).alias("c")).agg(F.min("c")).first()
        n = smallest[0] or 0
    return (
        hash_ranked(labelled, [label_col], id_col, seed, at_most=n)
        .filter(F.col("_rank") <= n)
        .drop("_rank", "_size")
    )


def stratified_cap(
    df: DataFrame, source_col: str, label_col: str, id_col: str, n: int, seed: object = 42
) -> DataFrame:
    """At most ``n`` rows per source with its label shares kept.

    A source above ``n`` rows gives each label its rounded share (half to even, at
    least one row); the result is shuffled and cut to ``n``.
    """
    source = f"_k_{source_col}"

    def by_label(groups: DataFrame) -> DataFrame:
        total = F.sum("_size").over(W.partitionBy(source))
        share = F.greatest(F.lit(1), F.bround(F.col("_size").cast("double") / total * n, 0).cast("long"))
        return groups.withColumn("_quota", F.when(total <= n, F.col("_size")).otherwise(share))

    chosen = first_by_hash(df, [source_col, label_col], id_col, by_label, seed).filter("_first").drop("_first")
    # Quotas add up to about n a source; what is over is cut in another order.
    kept = first_by_hash(chosen, [source_col], id_col, lambda g: g.withColumn("_quota", F.lit(n).cast("long")), f"{seed}-cut")
    return kept.filter("_first").drop("_first")


def stratified_split(
    df: DataFrame, label_col: str, id_col: str, test: float = 0.2, seed: object = 42
) -> DataFrame:
    """Add ``split`` (train or test) with class shares kept; a class of one or two rows stays in train."""
    def share(groups: DataFrame) -> DataFrame:
        return groups.withColumn("_quota", F.round(F.col("_size") * F.lit(test), 0).cast("long"))

    found = first_by_hash(df, [label_col], id_col, share, seed)
    return found.withColumn("split", F.when(F.col("_first"), "test").otherwise("train")).drop("_first")


def seed_and_pool(
    df: DataFrame, order: str, n_start: int, batch: int = 20
) -> tuple[DataFrame, DataFrame]:
    """The first rows in ``order`` as labelled seed, the rest as pool.

    The seed leaves at least one batch in the pool.  ``order`` must be unique: one
    boundary value splits the table with a filter that reaches the scan.
    """
    total = df.count()
    n = max(min(n_start, total - batch), 0)
    if n == 0:
        return df.limit(0), df
    edge = df.select(order).orderBy(order).limit(n).agg(F.max(order)).first()[0]
    return df.filter(F.col(order) <= F.lit(edge)), df.filter(F.col(order) > F.lit(edge))


def limit_per_query(hits: DataFrame, order: Sequence[str] | str, n: int, query_col: str = "query") -> DataFrame:
    """At most ``n`` hits of each query, in ``order``."""
    order = [order] if isinstance(order, str) else list(order)
    w = W.partitionBy(query_col).orderBy(*order)
    return hits.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def every_kth_point(history: DataFrame, step: int = 200) -> DataFrame:
    """The first point of a learning history, then one point per ``step`` labels."""
    start = history.agg(F.min("n_labeled")).scalar()
    return history.filter((F.col("n_labeled") == start) | (F.col("n_labeled") % step == 0))
