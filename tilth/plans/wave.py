"""One search wave: exclude known ids, rank, take verdicts, rerank, attach sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.functions.scalars import size_kb, size_mb
from tilth.operators.combine import apply_verdicts, exclude_ids, rerank
from tilth.operators.search import bm25_top


def attach_sizes(candidates: DataFrame, sizes: DataFrame, id_col: str = "id") -> DataFrame:
    """Join stored sizes (num_rows, num_bytes); unknown sizes stay null."""
    known = sizes.select(
        id_col, "num_rows", size_mb("num_bytes").alias("size_mb"), size_kb("num_bytes").alias("size_kb")
    )
    return candidates.drop("size_kb").join(known, id_col, "left")


def wave(
    catalog: DataFrame,
    terms: DataFrame,
    *,
    excluded: list[DataFrame],
    verdicts: DataFrame | None,
    ranks: DataFrame | None,
    sizes: DataFrame,
    bm25_n: int,
    final_n: int = 10,
    id_col: str = "id",
) -> tuple[DataFrame, DataFrame]:
    """(finalists, newly rejected ids) of one wave; no verdict kept means no finalists."""
    fresh = exclude_ids(catalog, *excluded, id_col=id_col)
    best = bm25_top(fresh, terms, bm25_n, id_col)
    survivors, rejected = apply_verdicts(best, verdicts, id_col)
    if ranks is None:
        ranked = survivors.withColumn("or_rank", F.lit(None).cast("long")).orderBy(F.desc("score"), id_col)
    else:
        ranked = rerank(survivors.withColumn("_place", -F.col("score")), ranks, "_place", id_col)
    finalists = ranked.limit(final_n).drop("_place")
    return attach_sizes(finalists, sizes, id_col), rejected
