"""Isolation forest (Liu, Ting & Zhou, "Isolation Forest", 2008) as Spark jobs.

The training samples are drawn by hash, every tree is grown in its own task from
at most 256 rows, and all rows are scored in Arrow batches against the finished
forest, whose size depends on its parameters only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.functions.hashing import hash_ranked
from tilth.functions.quantiles import quantiles
from tilth.functions.store import cut
from tilth.operators.detect import pct
from tilth.schema import nan_to_null

NODES = "tree int, node int, feature int, split double, child int, size int"


def _path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a tree of n points."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3.0)
    long = 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def _grow(points: np.ndarray, rng: np.random.Generator, depth: int) -> list[tuple]:
    """Nodes in breadth-first order; children of a split are adjacent, leaves have child -1."""
    nodes, queue = [], [(points, 0)]
    while len(nodes) < len(queue):
        rows, level = queue[len(nodes)]
        low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (0, 0)
        spread = np.flatnonzero(high > low) if len(rows) > 1 else []
        if level >= depth or not len(spread):
            nodes.append((-1, 0.0, -1, len(rows)))
            continue
        f = int(rng.choice(spread))
        split = float(rng.uniform(low[f], high[f]))
        left = rows[:, f] < split
        nodes.append((f, split, len(queue), len(rows)))
        queue += [(rows[left], level + 1), (rows[~left], level + 1)]
    return nodes


def _pack(nodes: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """Arrays to walk a tree with: a leaf leads to itself and holds its path length."""
    feature, split = nodes["feature"].to_numpy().copy(), nodes["split"].to_numpy().copy()
    child, length = nodes["child"].to_numpy().copy(), _path(nodes["size"])
    level = np.zeros(len(nodes))
    for i in np.flatnonzero(child >= 0):
        level[child[i] : child[i] + 2] = level[i] + 1
    leaves = child < 0
    feature[leaves], split[leaves] = 0, np.inf
    child[leaves] = np.flatnonzero(leaves)
    return feature, split, child, level + length


def isolation_scores(
    df: DataFrame,
    columns: Sequence[str],
    id_col: str,
    *,
    trees: int = 100,
    sample: int = 256,
    seed: int = 42,
) -> DataFrame:
    """(id, score) of rows complete in ``columns``; higher is more isolated."""
    columns = list(columns)
    data = nan_to_null(df).select(
        F.col(id_col).alias("id"), *[F.col(c).cast("double").alias(c) for c in columns]
    ).dropna(subset=columns)
    # A random permutation is cut into one block per tree, wrapping around on small
    # tables; what is drawn does not grow with the data.
    most = trees * sample
    numbered = cut(
        hash_ranked(data, [], "id", seed, at_most=most)
        .filter(F.col("_rank") <= most)
        .withColumn("_p", (F.col("_rank") - 1).cast("int"))
        .drop("_rank", "_size")
    )
    n = numbered.count()
    used = min(sample, n)
    if not used:
        return data.select("id", F.lit(None).cast("double").alias("score"))
    slots = data.sparkSession.range(trees * used).select(
        F.floor(F.col("id") / used).cast("int").alias("tree"),
        (F.col("id") % used).cast("int").alias("_r"),
    )
    place = ((F.col("tree") * F.lit(sample) + F.col("_r")) % n).cast("int").alias("_p")
    samples = slots.select("tree", "_r", place).join(numbered, "_p")
    depth = math.ceil(math.log2(max(used, 2)))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        ordered = pdf.sort_values("_r")
        nodes = _grow(ordered[columns].to_numpy(), np.random.default_rng([seed, tree]), depth)
        out = pd.DataFrame(nodes, columns=["feature", "split", "child", "size"])
        out.insert(0, "node", range(len(out)))
        out.insert(0, "tree", tree)
        return out

    # At most trees * 2 * sample nodes: bounded by the parameters.
    forest = samples.groupBy("tree").applyInPandas(grow, NODES).toPandas()
    packed = [_pack(t.sort_values("node")) for _, t in forest.groupby("tree")]
    scale = float(_path(used)) or 1.0

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = b[columns].to_numpy()
            flat, width = x.ravel(), x.shape[1]
            start = np.arange(len(x)) * width
            length = np.zeros(len(x))
            for feature, split, child, leaf in packed:
                at = np.zeros(len(x), dtype=np.int64)
                for _ in range(depth):
                    at = child[at] + (flat[start + feature[at]] >= split[at])
                length += leaf[at]
            yield pd.DataFrame({"id": b["id"], "score": 2.0 ** (-length / (len(packed) * scale))})

    id_type = df.schema[id_col].dataType.simpleString()
    return data.mapInPandas(score, f"id {id_type}, score double")


def detect_outliers_isolation_forest(
    df: DataFrame,
    columns: Sequence[str],
    id_col: str,
    contamination: float = 0.05,
    *,
    trees: int = 100,
    sample: int = 256,
    seed: int = 42,
) -> DataFrame:
    """Rows flagged as outliers: id and score above the contamination quantile."""
    scores = cut(isolation_scores(df, columns, id_col, trees=trees, sample=sample, seed=seed))
    cutoff = quantiles(scores, {"score": [1 - contamination]})["score"][0]
    return scores.filter(F.col("score") > F.lit(cutoff))


def isolation_report(df: DataFrame, flagged: DataFrame, contamination: float = 0.05) -> DataFrame:
    """One row: outlier count and share of all rows, with the first 20 ids."""
    total = df.agg(F.count(F.lit(1))).scalar()
    first = flagged.select("id").orderBy("id").limit(20).agg(
        F.array_join(F.array_sort(F.collect_list("id")).cast("array<string>"), ",")
    ).scalar()
    return flagged.agg(F.count(F.lit(1)).alias("outlier_count")).select(
        F.lit("isolation_forest").alias("method"),
        F.lit(contamination).alias("contamination"),
        "outlier_count",
        pct(F.col("outlier_count"), total).alias("outlier_pct"),
        first.alias("outlier_ids_sample"),
    )
