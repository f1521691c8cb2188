"""Label statistics, agreement between labels, and scores of predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilth.functions.scalars import kappa_band


def value_counts(df: DataFrame, column: str, normalize: bool = False) -> DataFrame:
    """Counts of non-null values, largest first, optionally with their share of non-null rows."""
    counted = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    if normalize:
        total = df.agg(F.count(column)).scalar()
        counted = counted.withColumn("share", F.round(F.col("count").cast("double") / total, 4))
    return counted.orderBy(F.desc("count"), "value")


def pair_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows per pair of non-null labels."""
    return (
        df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
        .groupBy(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def cohen_kappa(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row (pairs, kappa): agreement beyond chance, null below two pairs or without spread.

    Works on pair counts only: rows are reduced per task before the one shuffle,
    and chance agreement is a join of the two marginals on the label.
    """
    pairs = pair_counts(df, a, b)
    margins = (
        pairs.select(F.explode(F.array(
            F.struct(F.col("a").alias("label"), F.col("n").alias("na"), F.lit(0).cast("long").alias("nb")),
            F.struct(F.col("b").alias("label"), F.lit(0).cast("long").alias("na"), F.col("n").alias("nb")),
        )).alias("m"))
        .groupBy("m.label")
        .agg(F.sum("m.na").alias("na"), F.sum("m.nb").alias("nb"))
    )
    chance = margins.agg(F.sum(F.col("na").cast("double") * F.col("nb"))).scalar()
    agreed = F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).cast("double")
    n = F.sum("n").cast("double")
    po, pe = agreed / n, chance / (n * n)
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("pairs"),
        F.when((F.sum("n") >= 2) & (pe < 1), F.round((po - pe) / (1 - pe), 4)).alias("kappa"),
    )


def confusion_matrix(df: DataFrame, true_col: str, pred_col: str, labels: Sequence[object]) -> DataFrame:
    """Counts of true (rows) against predicted labels (columns), labels sorted and given."""
    ordered = sorted(labels)
    counts = (
        df.filter(F.col(true_col).isin(ordered) & F.col(pred_col).isin(ordered))
        .groupBy(F.col(true_col).alias("true_label"))
        .agg(
            *[
                F.count_if(F.col(pred_col) == F.lit(v)).alias(f"pred_{v}")
                for v in ordered
            ]
        )
    )
    spark = df.sparkSession
    rows = spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in ordered])).alias("true_label"))
    return (
        rows.join(counts, "true_label", "left")
        .fillna(0, [f"pred_{v}" for v in ordered])
        .orderBy("true_label")
    )


def label_quality(
    df: DataFrame,
    reference_col: str | None = None,
    *,
    label_col: str = "label",
    confidence_col: str = "confidence",
    flag_col: str = "flagged_for_review",
) -> DataFrame:
    """One row: confidence statistics, share flagged, and agreement with ``reference_col``."""
    flag = F.col(flag_col).cast("double")
    kappa = (
        cohen_kappa(df, reference_col, label_col).select("kappa").scalar()
        if reference_col and reference_col in df.columns
        else F.lit(None).cast("double")
    )
    return df.agg(
        F.count(label_col).alias("labelled"),
        F.round(F.avg(confidence_col), 4).alias("confidence_mean"),
        F.round(F.stddev_samp(confidence_col), 4).alias("confidence_std"),
        F.round(F.min(confidence_col), 4).alias("confidence_min"),
        F.round(F.avg(flag) * 100, 2).alias("flagged_pct"),
        F.count_if(flag_col).alias("flagged_count"),
    ).withColumn("kappa", kappa)


def quality_red_flags(metrics: DataFrame, label_shares: DataFrame) -> DataFrame:
    """Band of kappa and warning signs on a label_quality row and value_counts shares."""
    largest = label_shares.agg(F.max("share")).scalar()
    return metrics.select(
        "*",
        kappa_band(F.col("kappa")).alias("kappa_band"),
        F.coalesce(F.col("confidence_mean") < 0.65, F.lit(False)).alias("low_confidence"),
        F.coalesce(F.col("flagged_pct") > 50, F.lit(False)).alias("many_flagged"),
        F.coalesce(largest > 0.8, F.lit(False)).alias("dominant_class"),
        F.coalesce(F.col("kappa") < 0.4, F.lit(False)).alias("low_agreement"),
    )


def evaluate(
    df: DataFrame,
    label_col: str,
    pred_col: str,
    known: DataFrame | None = None,
) -> DataFrame:
    """One row (rows, accuracy, f1): accuracy and support-weighted F1 from pair counts.

    ``known`` (one label column) restricts to labels seen in training; nothing left scores 0.
    """
    if known is not None:
        label = known.columns[0]
        seen = known.select(F.col(label).alias("_known")).distinct()
        df = df.join(seen, df[label_col] == seen["_known"], "left_semi")
    pairs = pair_counts(df, label_col, pred_col)
    per_label = (
        pairs.select(F.explode(F.array(
            F.struct(F.col("a").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                     F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0).alias("hits")),
            F.struct(F.col("b").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"),
                     F.lit(0).cast("long").alias("hits")),
        )).alias("m"))
        .groupBy("m.label")
        .agg(
            F.sum("m.support").alias("support"),
            F.sum("m.predicted").alias("predicted"),
            F.sum("m.hits").alias("hits"),
        )
    )
    f1 = 2.0 * F.col("hits") / (F.col("support") + F.col("predicted"))

    def share(c: Column) -> Column:
        return F.coalesce(F.round(F.try_divide(c, F.sum("support").cast("double")), 4), F.lit(0.0))

    return per_label.agg(
        F.coalesce(F.sum("support"), F.lit(0)).alias("rows"),
        share(F.sum("hits").cast("double")).alias("accuracy"),
        share(F.sum(f1 * F.col("support"))).alias("f1"),
    )


def review_order(
    df: DataFrame, id_col: str, n: int = 15, *, confidence_col: str = "confidence",
    flag_col: str = "flagged_for_review",
) -> DataFrame:
    """Flagged rows, least confident first."""
    return df.filter(F.col(flag_col)).orderBy(confidence_col, id_col).limit(n)


def class_examples(
    df: DataFrame, order: str, *, text_col: str = "text", label_col: str = "label",
    labels: Sequence[str] | None = None, k: int = 5, max_chars: int = 120,
) -> DataFrame:
    """First ``k`` non-null texts of every class, cut to ``max_chars``."""
    rows = df.filter(F.col(text_col).isNotNull() & F.col(label_col).isNotNull())
    if labels is not None:
        rows = rows.filter(F.col(label_col).isin(list(labels)))
    w = W.partitionBy(label_col).orderBy(order)
    return (
        rows.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select(label_col, "rank", F.substring(text_col, 1, max_chars).alias("example"))
    )
