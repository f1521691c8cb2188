"""Detecting missing values, duplicates, outliers and class imbalance."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.functions.quantiles import quantiles
from tilth.functions.scalars import (
    DUPLICATE_PCT,
    IMBALANCE_RATIO,
    MISSING_COLUMN,
    MISSING_TABLE,
    OUTLIER_SHARE,
    overall_severity,
    severity,
)
from tilth.functions.store import cut
from tilth.schema import missing, number, numeric_columns


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage in double arithmetic; null for an empty table."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")) * 100, digits)


def _null_counts(df: DataFrame) -> DataFrame:
    """One row: table totals and the null count of every column, in a single scan."""
    flags = [missing(df, c).cast("int") for c in df.columns]
    per_row = sum(flags[1:], flags[0])
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(per_row > 0).alias("rows_with_any"),
        F.count_if(per_row == len(df.columns)).alias("rows_all"),
        F.array(*[F.count_if(missing(df, c)) for c in df.columns]).alias("nulls"),
    )


def _per_column(counts: DataFrame, df: DataFrame) -> DataFrame:
    rows = [
        F.struct(F.lit(c).alias("column"), F.col("nulls")[i].alias("missing"), F.lit(t).alias("dtype"))
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return counts.select("total_rows", F.explode(F.array(*rows)).alias("c")).select("total_rows", "c.*")


def detect_missing(df: DataFrame, threshold: float = 0.0) -> DataFrame:
    """Columns whose share of missing values is above ``threshold``."""
    share = F.try_divide(F.col("missing").cast("double"), F.col("total_rows"))
    return (
        _per_column(_null_counts(df), df)
        .filter(share > threshold)
        .select(
            "column",
            "missing",
            pct(F.col("missing"), F.col("total_rows")).alias("pct"),
            "dtype",
            severity(share, MISSING_COLUMN).alias("severity"),
        )
    )


def missing_totals(df: DataFrame, threshold: float = 0.0) -> DataFrame:
    """One row of table-wide missing-value totals."""
    width = len(df.columns)
    total = F.aggregate("nulls", F.lit(0).cast("long"), lambda a, x: a + x)
    cells = F.col("total_rows") * width
    share = F.try_divide(F.col("missing_cells").cast("double"), cells)
    affected = F.size(
        F.filter("nulls", lambda x: F.try_divide(x.cast("double"), F.col("total_rows")) > threshold)
    )
    return _null_counts(df).withColumn("missing_cells", total).select(
        "total_rows",
        F.lit(width).cast("long").alias("total_cols"),
        "missing_cells",
        F.round(share * 100, 3).alias("missing_pct"),
        F.col("rows_with_any").alias("rows_with_any_missing"),
        pct(F.col("rows_with_any"), F.col("total_rows")).alias("rows_with_any_missing_pct"),
        F.col("rows_all").alias("rows_fully_missing"),
        affected.cast("long").alias("columns_with_missing"),
        severity(share, MISSING_TABLE).alias("severity"),
    )


def detect_missing_active(df: DataFrame) -> DataFrame:
    """Missing values of columns that hold any value at all.

    A column that is null throughout is an unused modality and left out;
    ``total_pct`` is the mean of the remaining columns' shares.
    """
    return (
        _per_column(_null_counts(df), df)
        .filter(F.col("missing") < F.col("total_rows"))
        .withColumn("share", F.col("missing") / F.col("total_rows").cast("double"))
        .withColumn("total_pct", F.round(F.avg("share").over(W.partitionBy()) * 100, 2))
        .filter(F.col("missing") > 0)
        .select("column", "missing", F.round(F.col("share") * 100, 2).alias("pct"), "total_pct")
    )


def empty_columns(df: DataFrame) -> list[str]:
    """Names of columns without a single value, in schema order."""
    row = df.agg(
        *[F.count_if(~missing(df, c)).alias(f"n{i}") for i, c in enumerate(df.columns)]
    ).first()
    return [c for i, c in enumerate(df.columns) if row[f"n{i}"] == 0]


def row_digest(df: DataFrame, subset: Sequence[str] | None = None) -> Column:
    """256 bits of a row's values, made in the scan: equal for rows that grouping would call equal.

    Each value goes in under its column's name and null is left out, so nulls equal nulls
    and nothing else; 0.0 and -0.0 are one number.  SHA-256 stands for the values: no two
    different rows with one digest are known.
    """
    plain = []
    for f in (df.schema[c] for c in (subset or df.columns)):
        value = F.col(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            value = value + F.lit(0.0).cast(f.dataType)
        plain.append(value.alias(f"c{len(plain)}"))
    text = F.to_json(F.struct(*plain), {"ignoreNullFields": "true"})
    return F.unhex(F.sha2(text.cast("binary"), 256))


def duplicate_count(df: DataFrame, subset: Sequence[str] | None = None, keep: str = "first") -> DataFrame:
    """One row (total_rows, duplicate_rows); ``keep='none'`` counts every member of a group.

    Rows are exchanged as digests of 32 bytes, counted per task first, so a hot key costs
    one row per task and long texts cost no more than short ones.
    """
    copies = F.col("_copies")
    extra = F.when(copies > 1, copies).otherwise(0) if keep == "none" else copies - 1
    groups = df.groupBy(row_digest(df, subset).alias("_digest")).agg(F.count(F.lit(1)).alias("_copies"))
    return groups.agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(extra), F.lit(0)).cast("long").alias("duplicate_rows"),
    )


@dataclass(frozen=True)
class Facts:
    """What reports need of each row, written once: its missing values, numbers, digest and label.

    Texts and whatever made the table are left behind, so each report after it reads a narrow table.
    """

    rows: DataFrame
    columns: list[str]
    numeric: list[str]

    def x(self, name: str) -> str:
        return f"x{self.numeric.index(name)}"

    def bounds(self, names: Sequence[str] | None = None, k: float = 1.5) -> dict[str, Bounds]:
        names = list(self.numeric if names is None else names)
        found = iqr_bounds(self.rows, [self.x(c) for c in names], k)
        return {c: found[self.x(c)] for c in names}

    def totals(self, bounds: dict[str, Bounds] | None = None) -> DataFrame:
        """One row: counts of rows and missing values, and of each number its spread and outliers."""
        every = F.size(F.filter("missing", lambda m: m))
        numbers = [
            F.struct(
                F.avg(self.x(c)).alias("mean"), F.stddev_samp(self.x(c)).alias("std"), F.min(self.x(c)).alias("min"), F.max(self.x(c)).alias("max"),
                F.count_if((bounds or {}).get(c, Bounds(None, None)).outside(F.col(self.x(c)))).alias("outliers"),
            )
            for c in self.numeric
        ]
        return self.rows.agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.count_if(every > 0).alias("rows_with_any"),
            F.coalesce(F.sum(every.cast("long")), F.lit(0)).alias("missing_cells"),
            F.array(*[F.count_if(F.col("missing")[i]) for i in range(len(self.columns))]).alias("nulls"),
            (F.array(*numbers) if numbers else F.array()).alias("numbers"),
        )

    def groups(self) -> DataFrame:
        """One row: duplicate rows, and of the labels their number and largest and smallest class."""
        copies = self.rows.groupBy("digest", "label").agg(F.count(F.lit(1)).alias("n"))
        classes = copies.groupBy("label").agg(F.sum("n").alias("n"), F.sum(F.col("n") - 1).alias("extra"))
        named = F.when(F.col("label").isNotNull(), F.col("n"))
        return classes.agg(
            F.coalesce(F.sum("extra"), F.lit(0)).alias("duplicate_rows"), F.count(named).alias("classes"), F.max(named).alias("largest"), F.min(named).alias("smallest"),
        )


def facts(df: DataFrame, label_col: str | None = None) -> Facts:
    numeric = numeric_columns(df)
    label = F.col(label_col).cast("string") if label_col in df.columns else F.lit(None).cast("string")
    flags = F.array(*[missing(df, c) for c in df.columns])
    numbers = [number(df, c).alias(f"x{i}") for i, c in enumerate(numeric)]
    return Facts(cut(df.select(row_digest(df).alias("digest"), label.alias("label"), flags.alias("missing"), *numbers)), df.columns, numeric)


def detect_duplicates(
    df: DataFrame, subset: Sequence[str] | None = None, keep: str = "first"
) -> DataFrame:
    share = pct(F.col("duplicate_rows"), F.col("total_rows"))
    return duplicate_count(df, subset, keep).select(
        "total_rows",
        "duplicate_rows",
        share.alias("duplicate_pct"),
        F.lit(",".join(subset) if subset else "all").alias("subset_cols"),
        severity(share, DUPLICATE_PCT).alias("severity"),
    )


def duplicate_samples(
    df: DataFrame, subset: Sequence[str], order: str, keep: str = "first", n: int = 5
) -> DataFrame:
    """The first ``n`` duplicate rows in ``order``.

    The kept row of each group is found by aggregation; only rows of repeated
    keys take part in the join that follows.
    """
    edge = {"first": F.min(order), "last": F.max(order), "none": F.lit(None)}[keep]
    groups = (
        df.groupBy(*subset)
        .agg(F.count(F.lit(1)).alias("_copies"), edge.alias("_kept"))
        .filter("_copies > 1")
    )
    for c in subset:
        groups = groups.withColumnRenamed(c, f"_k_{c}")
    on = F.lit(True)
    for c in subset:
        on = on & df[c].eqNullSafe(groups[f"_k_{c}"])
    extra = F.col("_kept").isNull() | (F.col(order) != F.col("_kept"))
    return df.join(groups, on).filter(extra).select(df.columns).orderBy(order).limit(n)


@dataclass(frozen=True)
class Bounds:
    """Limits of one column; ``low`` is null when the column cannot have outliers."""

    low: float | None
    high: float | None

    def outside(self, x: Column) -> Column:
        """Null-safe: a missing value is never outside."""
        if self.low is None:
            return F.lit(False)
        return F.coalesce((x < F.lit(self.low)) | (x > F.lit(self.high)), F.lit(False))

    def clip(self, x: Column) -> Column:
        if self.low is None:
            return x
        limited = F.least(F.greatest(x, F.lit(self.low)), F.lit(self.high))
        return F.when(x.isNotNull(), limited)


def iqr_bounds(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> dict[str, Bounds]:
    """Quartile fences per column from one pass over all columns; scalars only reach the driver."""
    out = {}
    for c, (q1, q3) in quantiles(df, {c: [0.25, 0.75] for c in columns}).items():
        fence = None if q1 is None else k * (q3 - q1)
        out[c] = Bounds(None, None) if q1 is None else Bounds(q1 - fence, q3 + fence)
    return out


def zscore_bounds(df: DataFrame, columns: Sequence[str], k: float = 3.0) -> dict[str, Bounds]:
    """Mean plus or minus ``k`` sample deviations; no bounds where the deviation is 0."""
    if not columns:
        return {}
    row = df.agg(
        *[F.avg(number(df, c)).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_samp(number(df, c)).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    out = {}
    for i, c in enumerate(columns):
        mean, std = row[f"m{i}"], row[f"s{i}"]
        out[c] = Bounds(mean - k * std, mean + k * std) if std else Bounds(None, None)
    return out


def percentile_bounds(
    df: DataFrame, columns: Sequence[str], low: float = 1, high: float = 99
) -> dict[str, Bounds]:
    found = quantiles(df, {c: [low / 100, high / 100] for c in columns})
    return {c: Bounds(*v) for c, v in found.items()}


def outlier_counts(df: DataFrame, bounds: dict[str, Bounds]) -> DataFrame:
    """Long table (column, outliers, non_null, total_rows, min, max, mean), one scan."""
    if not bounds:
        return df.sparkSession.createDataFrame(
            [],
            "total_rows long, position int, column string, low double, high double, outliers long,"
            " non_null long, min_value double, max_value double, mean double",
        )
    stats = []
    for i, (c, b) in enumerate(bounds.items()):
        x = number(df, c)
        stats.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(c).alias("column"),
                F.lit(b.low).cast("double").alias("low"),
                F.lit(b.high).cast("double").alias("high"),
                F.count_if(b.outside(x)).alias("outliers"),
                F.count(x).alias("non_null"),
                F.min(x).alias("min_value"),
                F.max(x).alias("max_value"),
                F.avg(x).alias("mean"),
            )
        )
    counted = df.agg(F.count(F.lit(1)).alias("total_rows"), F.array(*stats).alias("s"))
    return counted.select("total_rows", F.explode("s").alias("s")).select("total_rows", "s.*")


def _outlier_report(df: DataFrame, bounds: dict[str, Bounds], method: str, k: float) -> DataFrame:
    share = F.try_divide(F.col("outliers").cast("double"), F.col("non_null"))
    return (
        outlier_counts(df, bounds)
        .filter("outliers > 0")
        .select(
            "column",
            F.lit(method).alias("method"),
            F.lit(float(k)).alias("threshold"),
            F.col("outliers").alias("outlier_count"),
            F.round(share * 100, 2).alias("outlier_pct"),
            F.round("low", 4).alias("lower_bound"),
            F.round("high", 4).alias("upper_bound"),
            F.round("min_value", 4).alias("min_value"),
            F.round("max_value", 4).alias("max_value"),
            F.round("mean", 4).alias("mean"),
            severity(share, OUTLIER_SHARE).alias("severity"),
        )
    )


def detect_outliers_iqr(
    df: DataFrame, columns: Sequence[str] | None = None, k: float | None = 1.5
) -> DataFrame:
    """Columns with values outside the quartile fences; a threshold of 0 means the default."""
    k = k or 1.5
    columns = [c for c in columns or numeric_columns(df) if c in numeric_columns(df)]
    return _outlier_report(df, iqr_bounds(df, columns, k), "iqr", k)


def detect_outliers_zscore(
    df: DataFrame, columns: Sequence[str] | None = None, k: float | None = 3.0
) -> DataFrame:
    """Columns with values more than ``k`` sample deviations from the mean."""
    k = k or 3.0
    columns = [c for c in columns or numeric_columns(df) if c in numeric_columns(df)]
    return _outlier_report(df, zscore_bounds(df, columns, k), "zscore", k)


def outlier_totals(report: DataFrame, columns_checked: int) -> DataFrame:
    """One row over a per-column outlier report."""
    return report.agg(
        F.lit(columns_checked).cast("long").alias("columns_checked"),
        F.count(F.lit(1)).alias("columns_with_outliers"),
        F.coalesce(F.sum("outlier_count"), F.lit(0)).alias("total_outlier_instances"),
    )


def class_counts(df: DataFrame, label_col: str) -> DataFrame:
    """Rows per non-null label."""
    return (
        df.filter(F.col(label_col).isNotNull())
        .groupBy(F.col(label_col).alias("label"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def detect_imbalance(df: DataFrame, label_col: str) -> DataFrame:
    """One row: class sizes, ratio of largest to smallest, severity, missing labels.

    Null labels are no class but count in the total.  Ties go to the first label.
    """
    every = df.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("count"))
    named = F.col("label").isNotNull()
    key = F.when(named, F.struct(F.col("count"), F.col("label")))
    name = F.col("label").cast("string")
    summary = every.agg(
        F.sum("count").alias("total_rows"),
        F.count_if(named).alias("num_classes"),
        F.min_by(name, F.when(named, F.struct(-F.col("count"), F.col("label")))).alias("majority_class"),
        F.max(F.when(named, F.col("count"))).alias("majority_count"),
        F.min_by(name, key).alias("minority_class"),
        F.min(F.when(named, F.col("count"))).alias("minority_count"),
        F.coalesce(F.sum(F.when(~named, F.col("count"))), F.lit(0)).alias("missing_labels"),
    )
    ratio = F.round(F.try_divide(F.col("majority_count").cast("double"), F.col("minority_count")), 2)
    return summary.withColumn("imbalance_ratio", ratio).select(
        "total_rows",
        "num_classes",
        "majority_class",
        "majority_count",
        pct(F.col("majority_count"), F.col("total_rows")).alias("majority_pct"),
        "minority_class",
        "minority_count",
        pct(F.col("minority_count"), F.col("total_rows")).alias("minority_pct"),
        "imbalance_ratio",
        severity(F.col("imbalance_ratio"), IMBALANCE_RATIO).alias("severity"),
        "missing_labels",
    )


def class_distribution(df: DataFrame, label_col: str, top: int | None = None) -> DataFrame:
    """Classes, largest first, with their share of all rows, null labels included in the total.

    With ``top`` only the largest.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    counts = class_counts(df, label_col).orderBy(F.desc("count"), "label")
    if top is not None:
        counts = counts.limit(top)
    return counts.select("label", "count", pct(F.col("count"), total).alias("pct"))


def imbalance(df: DataFrame, label_col: str | None) -> DataFrame:
    """One row: ratio of largest to smallest class, 1.0 for a single class, null without labels."""
    if label_col is None or label_col not in df.columns:
        return df.sparkSession.range(1).select(
            F.lit(None).cast("double").alias("ratio"), F.lit(0).cast("long").alias("num_classes")
        )
    return class_counts(df, label_col).agg(
        F.when(
            F.count(F.lit(1)) > 1, F.round(F.max("count").cast("double") / F.min("count"), 2)
        )
        .otherwise(1.0)
        .alias("ratio"),
        F.count(F.lit(1)).alias("num_classes"),
    )


def quality_report(df: DataFrame, label_col: str | None = None) -> DataFrame:
    """Long table (issue, column, count, pct, severity) over all four kinds of issue.

    The table is read once (see ``Facts``); all lines come from one row of totals.
    """
    known = facts(df, label_col)
    bounds = known.bounds()
    labelled = label_col is not None and label_col in df.columns
    group = F.col("g")
    total, none = F.col("total_rows"), F.lit(None)
    ratio = F.lit(None).cast("double")
    if labelled:
        ratio = F.when(group["classes"] > 1, F.round(group["largest"].cast("double") / group["smallest"], 2)).otherwise(1.0)
    shares = F.transform(F.filter("nulls", lambda n: n < total), lambda n: n / total.cast("double"))
    summed = F.aggregate(shares, F.lit(0.0), lambda a, x: a + x)
    mean = F.round(F.try_divide(summed, F.size(shares)) * 100, 2)
    held = F.aggregate(F.filter("nulls", lambda n: n < total), F.lit(0).cast("long"), lambda a, n: a + n)
    repeated = pct(group["duplicate_rows"], total)

    def line(issue: str, column: Column, count: Column, value: Column, level: Column = none, where: Column | None = None) -> Column:
        return F.struct(
            F.lit(issue).alias("issue"), column.cast("string").alias("column"), count.cast("long").alias("count"), value.cast("double").alias("pct"),
            level.cast("string").alias("severity"), (F.lit(True) if where is None else where).alias("listed"),
        )

    lines = []
    for i, c in enumerate(known.columns):
        n = F.col("nulls")[i]
        lines.append(line("missing", F.lit(c), n, F.round(F.try_divide(n.cast("double"), total) * 100, 2), where=(n > 0) & (n < total)))
        lines.append(line("skipped_empty", F.lit(c), n, none, where=n == total))
    for i, c in enumerate(known.numeric):
        n = F.col("numbers")[i]["outliers"]
        lines.append(line("outliers", F.lit(c), n, pct(n, total), where=n > 0))
    lines += [
        line("missing_total", none, held, mean),
        line("duplicates", none, group["duplicate_rows"], repeated),
        line("imbalance", F.lit(label_col), group["classes"] if labelled else F.lit(0), ratio),
        line("overall", none, none, none, overall_severity(mean, repeated, ratio)),
    ]
    one = known.totals(bounds).withColumn("g", known.groups().select(F.struct("*").alias("g")).scalar())
    found = one.select(F.explode(F.array(*lines)).alias("s")).select("s.*")
    return found.filter("listed").drop("listed")


def zero_inflated(df: DataFrame, columns: Sequence[str] | None = None, share: float = 0.8) -> DataFrame:
    """Columns in which more than ``share`` of the values are zero; quartile fences mean little there."""
    chosen = list(columns or numeric_columns(df))
    stats = [
        F.struct(
            F.lit(c).alias("column"),
            F.avg(F.when(number(df, c) == 0, 1.0).when(number(df, c).isNotNull(), 0.0)).alias("zeros"),
        )
        for c in chosen
    ]
    return (
        df.agg(F.array(*stats).alias("s"))
        .select(F.explode("s").alias("s"))
        .filter(F.col("s.zeros") > share)
        .select("s.column", F.round("s.zeros", 4).alias("zero_share"))
    )
