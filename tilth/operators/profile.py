"""Profiles of tables, text columns and text folders; histograms and word counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilth.functions.quantiles import quantiles
from tilth.functions.scalars import words
from tilth.operators.detect import duplicate_count, missing_totals, pct
from tilth.schema import missing, number, numeric_columns


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles and max of numeric columns, long by column; exact quartiles."""
    chosen = list(columns or numeric_columns(df))
    quartiles = quantiles(df, {c: [0.25, 0.5, 0.75] for c in chosen})
    stats = []
    for c in chosen:
        x = number(df, c)
        q = [F.round(F.lit(v).cast("double"), 4) for v in quartiles[c]]
        stats.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(x).alias("count"),
                F.round(F.avg(x), 4).alias("mean"),
                F.round(F.stddev_samp(x), 4).alias("std"),
                F.round(F.min(x), 4).alias("min"),
                q[0].alias("p25"),
                q[1].alias("p50"),
                q[2].alias("p75"),
                F.round(F.max(x), 4).alias("max"),
            )
        )
    return df.agg(F.array(*stats).alias("s")).select(F.explode("s").alias("s")).select("s.*")


def profile_columns(df: DataFrame) -> DataFrame:
    """Type and missing values of every column, in schema order."""
    rows = [
        F.struct(
            F.lit(i).cast("long").alias("position"),
            F.lit(c).alias("column"),
            F.lit(t).alias("dtype"),
            F.count_if(missing(df, c)).alias("missing"),
            F.count(F.lit(1)).alias("total"),
        )
        for i, (c, t) in enumerate(df.dtypes)
    ]
    out = df.agg(F.array(*rows).alias("s")).select(F.explode("s").alias("s")).select("s.*")
    return out.withColumn("missing_pct", pct(F.col("missing"), F.col("total"))).drop("total")


def profile_tabular(df: DataFrame) -> DataFrame:
    """One row: shape, share of missing cells and exact duplicate rows."""
    duplicates = duplicate_count(df).select("duplicate_rows").scalar()
    return missing_totals(df).select(
        F.col("total_rows").alias("rows"),
        F.col("total_cols").alias("cols"),
        pct(F.col("missing_cells"), F.col("total_rows") * len(df.columns)).alias("total_missing_pct"),
        duplicates.alias("duplicates_exact"),
    )


def head(df: DataFrame, order: Sequence[str] | str, n: int = 3) -> DataFrame:
    """First ``n`` rows in a given order."""
    order = [order] if isinstance(order, str) else list(order)
    return df.orderBy(*order).limit(n)


def profile_text(df: DataFrame, text_col: str = "text") -> DataFrame:
    """One row of length statistics; percentiles are cut to whole characters, not rounded."""
    lengths = df.select(F.length(text_col).cast("double").alias("n"), (F.col(text_col) == "").alias("e"))
    p50, p95 = quantiles(lengths, {"n": [0.5, 0.95]})["n"]
    return lengths.agg(
        F.count_if("e").alias("empty"),
        F.count_if(F.col("n").isNull()).alias("null"),
        F.round(F.avg("n"), 1).alias("len_mean"),
        F.min("n").cast("long").alias("len_min"),
        F.max("n").cast("long").alias("len_max"),
        F.lit(p50).cast("long").alias("len_p50"),
        F.lit(p95).cast("long").alias("len_p95"),
    )


def profile_text_dir(files: DataFrame, sampled: int | None = None) -> DataFrame:
    """One row over (path, bytes, words): sizes and word counts; with ``sampled`` words of the first files by path."""
    chosen = files if sampled is None else files.orderBy("path").limit(sampled)
    first = chosen.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.round(F.avg("words"), 1), F.lit(0.0)).alias("mean"),
        F.coalesce(F.min("words"), F.lit(0)).alias("min"),
        F.coalesce(F.max("words"), F.lit(0)).alias("max"),
    )
    sample = first.select(F.struct("*")).scalar()
    return files.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).cast("long").alias("bytes_total"),
        F.coalesce(F.round(F.avg("bytes"), 0), F.lit(0.0)).alias("bytes_mean"),
    ).select(
        "*",
        sample["n"].alias("count_sampled"),
        sample["mean"].alias("words_mean"),
        sample["min"].cast("long").alias("words_min"),
        sample["max"].cast("long").alias("words_max"),
    )


def histogram(df: DataFrame, column: str, bins: int = 20, by: str | None = None) -> DataFrame:
    """Equal-width bins between minimum and maximum (per group with ``by``); the last bin is closed.

    Empty bins are not listed.  A column of one value falls into one bin of width 1.
    """
    x = number(df, column)
    values = df.select(x.alias("_x"), *([F.col(by)] if by else [])).filter("_x is not null")
    if by:
        edges = values.groupBy(F.col(by).alias("_g")).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
        placed = values.join(edges, values[by].eqNullSafe(edges["_g"])).drop("_g")
    else:
        edge = values.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi"))).scalar()
        placed = values.withColumns({"_lo": edge["lo"], "_hi": edge["hi"]})
    flat = F.col("_lo") == F.col("_hi")
    low = F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo"))
    width = F.when(flat, 1.0).otherwise(F.col("_hi") - F.col("_lo")) / bins
    index = F.least(F.floor((F.col("_x") - low) / width), F.lit(bins - 1)).cast("long")
    keys = [by] if by else []
    return (
        placed.select(*keys, index.alias("bin"), (low + index * width).alias("_left"))
        .groupBy(*keys, "bin")
        .agg(F.round(F.min("_left"), 4).alias("left_edge"), F.count(F.lit(1)).alias("count"))
    )


def top_words(df: DataFrame, text_col: str = "text", by: str = "label", n: int = 20) -> DataFrame:
    """The ``n`` most frequent words of every class; ties by word."""
    counted = (
        df.filter(F.col(by).isNotNull())
        .select(by, F.explode(words(text_col)).alias("word"))
        .groupBy(by, "word")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    w = W.partitionBy(by).orderBy(F.desc("count"), "word")
    return counted.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
