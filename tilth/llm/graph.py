"""Connected components of a link table, by alternating stars over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.functions.store import cut


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Tie the larger (or smaller) neighbours of every node to its smallest neighbour.

    ``links`` holds each link once, as ``a > b``.  The minimum is aggregated before it
    meets the links again, and that join has one row a node on its other side, so a
    node with very many neighbours can be split.
    """
    if large:
        both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    joined = both.join(least, F.col("a") == F.col("n"))
    if large:
        return joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(joined.select("a", F.col("m").alias("b"))).filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of ``links`` (a, b).

    Stops when a round leaves the links as they were: then every node hangs directly
    on its root.  The number of rounds grows with the logarithm of the longest path.
    """
    now = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct())
    state = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state or seen[0] == 0:
            break
        state = seen
        now = cut(_stars(_stars(now, True), False))
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
