"""Cleaning as compositions of operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.functions.store import cut
from tilth.operators.balance import oversample
from tilth.operators.combine import dedupe
from tilth.operators.detect import iqr_bounds
from tilth.operators.fix import (
    clip_iqr,
    clip_zscore,
    drop_outliers,
    drop_outliers_sequential,
    drop_rows,
    ffill,
    fill_constant,
    impute,
    impute_mode,
)
from tilth.operators.sampling import undersample
from tilth.schema import numeric_columns

# Default cleaning strategy and the recommended ones per learning task.
DEFAULT = {"missing": "median", "duplicates": "drop", "outliers": "clip_iqr", "imbalance": "skip"}
TASK_STRATEGIES = {
    "classification": {"missing": "median", "duplicates": "drop", "outliers": "clip_iqr"},
    "regression": {"missing": "median", "duplicates": "drop", "outliers": "drop"},
    "clustering": {"missing": "drop_rows", "duplicates": "drop", "outliers": "clip_iqr"},
}
KEEP = {"drop": "first", "keep_last": "last", "keep_none": "none"}


def strategy_for(task: str) -> dict[str, str]:
    """Settings for :func:`fix` by learning task."""
    return {**DEFAULT, **TASK_STRATEGIES[task]}


def fix(
    df: DataFrame,
    order: str,
    strategy: Mapping[str, str] | None = None,
    *,
    label_col: str | None = None,
    seed: object = 42,
) -> DataFrame:
    """Duplicates, then missing values, then outliers, then class balance.

    ``order`` is the row id: it decides which copy is kept and is itself neither
    compared nor clipped.  Statistics of a step are taken on the result of the
    step before, so the deduplicated table is materialised once instead of being
    shuffled again for every statistic.
    """
    chosen = {**DEFAULT, **(strategy or {})}
    if chosen["duplicates"] in KEEP:
        df = cut(dedupe(df, order, keep=KEEP[chosen["duplicates"]]))

    how = chosen["missing"]
    values = [c for c in df.columns if c != order]
    if how in ("mean", "median"):
        df = impute(df, how, values)
    elif how == "mode":
        df = impute_mode(df, values, fill_empty=True)
    elif how == "ffill":
        df = ffill(df, values, order)
    elif how == "drop_rows":
        df = drop_rows(df)
    elif how == "constant":
        df = fill_constant(df, columns=values)

    numeric = [c for c in numeric_columns(df) if c not in (order, label_col)]
    if chosen["outliers"] == "clip_iqr":
        df = clip_iqr(df, numeric)
    elif chosen["outliers"] == "clip_zscore":
        df = clip_zscore(df, numeric)
    elif chosen["outliers"] == "drop":
        df = drop_outliers_sequential(df, numeric)

    if label_col and chosen["imbalance"] == "undersample":
        df = undersample(df, label_col, order, seed=seed)
    elif label_col and chosen["imbalance"] == "oversample":
        df = oversample(df, label_col, order, seed).drop("copy")
    return df


def clean_aggressive(
    df: DataFrame,
    id_col: str,
    *,
    text_col: str = "text",
    label_col: str = "label",
    n: int | None = None,
    seed: object = 42,
) -> DataFrame:
    """Drop repeated texts and texts of unusual length, then take ``n`` rows per class,
    by default as many as the smallest class has.

    Deduplication is the one shuffle of the text.  Its result is written with the
    length beside it, so bounds and class quotas are found without reading text.
    """
    unique = cut(dedupe(df, id_col, [text_col]).withColumn("_len", F.length(text_col)))
    kept = unique.filter(~iqr_bounds(unique, ["_len"])["_len"].outside(F.col("_len")))
    return undersample(kept.filter("_len is not null").drop("_len"), label_col, id_col, n, seed)


def clean_preset(df: DataFrame, order: str, preset: str = "balanced") -> DataFrame:
    """aggressive drops missing, repeated and outlying rows; conservative only fills; balanced
    drops repeats, fills with the median and trims values beyond three deviations."""
    values = [c for c in df.columns if c != order]
    numeric = [c for c in numeric_columns(df) if c != order]
    if preset == "conservative":
        return impute(df, "median", values)
    unique = cut(dedupe(df, order))
    if preset == "aggressive":
        return drop_outliers(drop_rows(unique), numeric, "iqr")
    if preset == "balanced":
        return drop_outliers(impute(unique, "median", values), numeric, "zscore")
    raise ValueError("preset must be aggressive, conservative or balanced")


def row_counts(**steps: DataFrame) -> DataFrame:
    """Rows left after each named step, one small aggregation per step."""
    out = None
    for i, (name, df) in enumerate(steps.items()):
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(i).cast("long").alias("step"), F.lit(name).alias("name"), "rows"
        )
        out = one if out is None else out.unionByName(one)
    return out
