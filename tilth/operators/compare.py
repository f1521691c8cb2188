"""Before/after comparison of tables and of profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.functions.scalars import signed, signed_pct
from tilth.operators.detect import class_counts, facts, missing_totals
from tilth.schema import numeric_columns
from tilth.sources.collect import flatten_struct


def compare(before: DataFrame, after: DataFrame) -> DataFrame:
    """metric, before, after, change, change_pct: rows, missing values, duplicates, outliers.

    Columns that are null throughout in ``before`` are unused modalities and are
    left out of missing values; each side uses its own outlier fences.  Each side is read
    once (see ``Facts``), and one row of totals of each reaches the driver.
    """
    sides = [facts(before), facts(after)]
    nulls = sides[0].totals().first()
    active = [c for c, n in zip(before.columns, nulls["nulls"]) if n < nulls["total_rows"]]
    numeric = [c for c in sides[0].numeric if c in active and c in after.columns]
    values = []
    for side in sides:
        fenced = [c for c in numeric if c in side.numeric]
        row = side.totals(side.bounds(fenced)).first()
        found = {"rows": row["total_rows"], "missing_values": sum(n for c, n in zip(side.columns, row["nulls"]) if c in active), "duplicates": side.groups().first()["duplicate_rows"]}
        found |= {f"outliers_{c}": row["numbers"][side.numeric.index(c)]["outliers"] for c in fenced}
        values.append(found)
    lines = [(i, m, v, values[1][m]) for i, (m, v) in enumerate(values[0].items()) if m in values[1]]
    table = before.sparkSession.createDataFrame(lines, "position int, metric string, before long, after long")
    with_pct = (F.col("metric") == "rows") | F.col("metric").startswith("outliers_")
    return (
        table.withColumn("change", signed(F.col("after") - F.col("before")))
        .withColumn(
            "change_pct",
            F.when(with_pct & (F.col("before") != 0), signed_pct(F.col("before"), F.col("after")))
            .otherwise(""),
        )
        .orderBy("position")
        .select("metric", "before", "after", "change", "change_pct")
    )


def compare_tables(before: DataFrame, after: DataFrame) -> DataFrame:
    """Long table (section, name, stat, before, after): shape, nulls by column, numeric statistics.

    Null counts are listed only where they changed; statistics only for numeric
    columns present on both sides.  Each side is read once (see ``Facts``).
    """
    common = [c for c in numeric_columns(before) if c in numeric_columns(after)]
    shared = [c for c in before.columns if c in after.columns]

    def side(df: DataFrame) -> DataFrame:
        known = facts(df)
        total = F.col("total_rows")
        cells = total * len(df.columns)

        def line(section: str, name: str, stat: str, value: Column) -> Column:
            return F.struct(F.lit(section).alias("section"), F.lit(name).alias("name"), F.lit(stat).alias("stat"), value.cast("double").alias("value"))

        lines = [
            line("table", "rows", "count", total),
            line("table", "cols", "count", F.lit(len(df.columns))),
            line("table", "missing_pct", "pct", F.coalesce(F.round(F.try_divide(F.col("missing_cells").cast("double"), cells) * 100, 3), F.lit(0.0))),
            line("table", "duplicates", "count", known.groups().select("duplicate_rows").scalar()),
            *[line("missing", c, "nulls", F.col("nulls")[known.columns.index(c)]) for c in shared],
            *[line("numeric", c, stat, F.round(F.col("numbers")[known.numeric.index(c)][stat], 4)) for c in common for stat in ("mean", "std", "min", "max")],
        ]
        return known.totals().select(F.explode(F.array(*lines)).alias("s")).select("s.*")

    keys = ["section", "name", "stat"]
    b = side(before).withColumnRenamed("value", "before")
    a = side(after).withColumnRenamed("value", "after")
    return (
        b.join(a, keys, "full_outer")
        .filter((F.col("section") != "missing") | ~F.col("before").eqNullSafe(F.col("after")))
        .withColumn("delta", F.round(F.col("after") - F.col("before"), 4))
    )


def profile_pairs(profile: DataFrame) -> DataFrame:
    """A one-row nested profile as (key, value, number) with dotted keys; arrays are left out."""
    leaves = []
    for col, field in zip(flatten_struct(profile), profile.select(*flatten_struct(profile)).schema.fields):
        if isinstance(field.dataType, (T.ArrayType, T.MapType)):
            continue
        numeric = isinstance(field.dataType, T.NumericType)
        leaves.append(
            F.struct(
                F.lit(field.name).alias("key"),
                col.cast("string").alias("value"),
                (col.cast("double") if numeric else F.lit(None).cast("double")).alias("number"),
            )
        )
    return profile.select(F.explode(F.array(*leaves)).alias("p")).select("p.*").filter("value is not null")


def diff_profiles(before: DataFrame, after: DataFrame) -> DataFrame:
    """Keys whose value differs between two profiles; a missing side reads N/A."""
    b = profile_pairs(before).select("key", F.col("value").alias("b"), F.col("number").alias("bn"))
    a = profile_pairs(after).select("key", F.col("value").alias("a"), F.col("number").alias("an"))
    same = F.coalesce(F.col("bn") == F.col("an"), F.lit(False)) | (
        F.col("bn").isNull() & F.col("an").isNull() & F.col("b").eqNullSafe(F.col("a"))
    )
    return (
        b.join(a, "key", "full_outer")
        .filter(~same)
        .select(
            "key",
            F.coalesce("b", F.lit("N/A")).alias("before"),
            F.coalesce("a", F.lit("N/A")).alias("after"),
        )
    )


def fix_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows, columns and nulls before and after, and what was fixed."""
    def totals(df: DataFrame, side: str) -> DataFrame:
        return missing_totals(df).select(
            F.struct(
                F.col("total_rows").alias("rows"), F.col("total_cols").alias("cols"),
                F.col("missing_cells").alias("nulls"),
            ).alias(side)
        )
    b, a = totals(before, "b").scalar(), totals(after, "a").scalar()
    return before.sparkSession.range(1).select(
        b["rows"].alias("rows_before"), a["rows"].alias("rows_after"),
        (b["rows"] - a["rows"]).alias("rows_removed"),
        b["cols"].alias("cols_before"), a["cols"].alias("cols_after"),
        b["nulls"].alias("nulls_before"), a["nulls"].alias("nulls_after"),
        (b["nulls"] - a["nulls"]).alias("fixed"),
    )


def distribution_change(before: DataFrame, after: DataFrame, label_col: str) -> DataFrame:
    """Class sizes before and after balancing."""
    b = class_counts(before, label_col).withColumnRenamed("count", "before")
    a = class_counts(after, label_col).withColumnRenamed("count", "after")
    return b.join(a, "label", "full_outer").fillna(0, ["before", "after"])

