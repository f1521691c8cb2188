"""Repairing missing values and outliers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.functions.quantiles import quantiles
from tilth.functions.store import cut
from tilth.operators.detect import (
    Bounds,
    empty_columns,
    iqr_bounds,
    percentile_bounds,
    zero_inflated,
    zscore_bounds,
)
from tilth.schema import missing, nan_to_null, number, numeric_columns

# A group up to this many rows is filled by one window task; larger groups are cut into blocks.
GROUP_ROWS = 5_000_000


# --- missing values -------------------------------------------------------------------


def column_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Most frequent non-null value per column, smallest on ties.

    Counted per distinct value with partial aggregation instead of one map of all
    values: the long (column, value) counts are reduced to a row per column.
    """
    out: dict[str, object] = {}
    for dtype in {df.schema[c].dataType.simpleString() for c in columns}:
        same = [c for c in columns if df.schema[c].dataType.simpleString() == dtype]
        cells = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in same])
        best = (
            df.select(F.explode(cells).alias("x"))
            .select("x.c", "x.v")
            .filter("v is not null")
            .groupBy("c", "v")
            .agg(F.count(F.lit(1)).alias("n"))
            .groupBy("c")
            .agg(F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("v"))
        )
        out.update({r["c"]: r["v"] for r in best.collect()})
    return out


def _fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls by one literal per column; means and medians make a whole-number column double."""
    new: dict[str, Column] = {}
    for c, v in values.items():
        if v is None:
            continue
        dtype = df.schema[c].dataType
        if isinstance(dtype, T.IntegralType) and isinstance(v, float):
            new[c] = F.coalesce(F.col(c).cast("double"), F.lit(v))
        else:
            new[c] = F.coalesce(F.col(c), F.lit(v).cast(dtype))
    return df.withColumns(new) if new else df


def _incomplete(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with some, but not only, missing values."""
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(missing(df, c)).alias(f"m{i}") for i, c in enumerate(columns)],
    ).first()
    return [c for i, c in enumerate(columns) if 0 < row[f"m{i}"] < row["n"]]


def _means(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    if not columns:
        return {}
    row = df.agg(*[F.avg(number(df, c)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return {c: row[f"m{i}"] for i, c in enumerate(columns)}


def impute(df: DataFrame, strategy: str = "median", columns: Sequence[str] | None = None) -> DataFrame:
    """Fill numeric columns with mean or median, other columns with their mode.

    Columns that are null throughout are unused modalities and stay untouched.
    """
    if strategy not in ("mean", "median"):
        raise ValueError("strategy must be mean or median")
    df = nan_to_null(df)
    gaps = _incomplete(df, list(columns or df.columns))
    numeric = [c for c in gaps if c in numeric_columns(df)]
    if strategy == "mean":
        values: dict[str, object] = dict(_means(df, numeric))
    else:
        values = {c: v[0] for c, v in quantiles(df, {c: [0.5] for c in numeric}).items()}
    values.update(column_modes(df, [c for c in gaps if c not in numeric]))
    return _fill(df, values)


def impute_mode(
    df: DataFrame, columns: Sequence[str] | None = None, fill_empty: bool = False
) -> DataFrame:
    """Fill every column with its mode; with ``fill_empty`` all-null text columns become "unknown"."""
    df = nan_to_null(df)
    chosen = list(columns or df.columns)
    values = column_modes(df, _incomplete(df, chosen))
    if fill_empty:
        for c in empty_columns(df.select(*chosen)):
            if isinstance(df.schema[c].dataType, (T.StringType, T.NullType)):
                values[c] = "unknown"
    return _fill(df, values)


def fill_constant(df: DataFrame, value: object = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Fill with a constant; by default 0 for numbers and "unknown" for text.

    Text that parses as a number is used as a number for numeric columns.
    """
    df = nan_to_null(df)
    numeric = set(numeric_columns(df))
    number_value: float | int | None = 0
    text_value = "unknown"
    if value is not None:
        text_value = str(value)
        try:
            number_value = int(text_value)
        except ValueError:
            try:
                number_value = float(text_value)
            except ValueError:
                number_value = None
    values: dict[str, object] = {}
    for c in columns or df.columns:
        if c in numeric:
            values[c] = number_value
        elif isinstance(df.schema[c].dataType, T.StringType):
            values[c] = text_value
    return _fill(df, values)


def drop_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a missing value in ``columns``; by default in any column that holds values."""
    df = nan_to_null(df)
    if columns is None:
        empty = set(empty_columns(df))
        columns = [c for c in df.columns if c not in empty]
    return df.dropna(subset=list(columns)) if columns else df


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def drop_sparse_columns(df: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Drop columns whose share of missing values is above ``threshold``; 1.0 drops none."""
    if threshold >= 1.0:
        return df
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)],
    ).first()
    sparse = [c for i, c in enumerate(df.columns) if row["n"] and row[f"m{i}"] / row["n"] > threshold]
    return df.drop(*sparse)


# --- fills along an order -------------------------------------------------------------


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(right[f"_k_{k}"])
    return on


def _neighbours(
    df: DataFrame, columns: Sequence[str], order: str, by: Sequence[str], group_rows: int
) -> DataFrame:
    """Add ``_pos`` and, per column, the previous and next present value with its position.

    Groups of moderate size are one window each.  Without groups, or when one is larger
    than ``group_rows``, the table is range-partitioned on (group, order), written once
    to the shared folder, and each block fills itself; what flows between blocks
    is one row per (group, block).
    """
    by = list(by)
    present = {c: ~missing(df, c) for c in columns}
    if by:
        sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("c")).agg(F.max("c"), F.sum("c")).first()
        largest, rows = sizes[0] or 0, sizes[1] or 0
    else:
        largest = rows = df.count()

    def point(c: str) -> Column:
        return F.when(present[c], F.struct(F.col(c).alias("v"), F.col("_pos").alias("p")))

    def around(w: list[str], c: str) -> dict[str, Column]:
        # Both frames grow from the start of their order: a frame that shrinks towards
        # the end of the group would be evaluated anew for every row.
        before = W.partitionBy(*w).orderBy("_pos").rowsBetween(W.unboundedPreceding, -1)
        behind = W.partitionBy(*w).orderBy(F.desc("_pos")).rowsBetween(W.unboundedPreceding, -1)
        return {
            f"_prev_{c}": F.last(point(c), ignorenulls=True).over(before),
            f"_next_{c}": F.last(point(c), ignorenulls=True).over(behind),
        }

    if by and largest <= group_rows:
        w = W.partitionBy(*by).orderBy(order)
        out = df.withColumn("_pos", F.row_number().over(w).cast("long"))
        return out.withColumns({k: v for c in columns for k, v in around(by, c).items()})

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(parts, -(-rows // group_rows) * 2)
    cut_df = cut(
        df.repartitionByRange(blocks, *by, order).withColumn("_block", F.spark_partition_id())
    )
    inside = W.partitionBy(*by, "_block").orderBy(order)
    local = cut_df.withColumn("_pos", F.row_number().over(inside).cast("long"))
    ends = local.groupBy(*by, "_block").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.max_by(point(c), F.when(present[c], F.col("_pos"))).alias(f"_last_{c}") for c in columns],
        *[F.min_by(point(c), F.when(present[c], F.col("_pos"))).alias(f"_first_{c}") for c in columns],
    )
    chain = W.partitionBy(*by).orderBy("_block")
    earlier = chain.rowsBetween(W.unboundedPreceding, -1)
    # What follows, as what precedes in the reversed order: a frame that only grows.
    later = W.partitionBy(*by).orderBy(F.desc("_block")).rowsBetween(W.unboundedPreceding, -1)
    ends = ends.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))

    def moved(c: str) -> Column:
        return F.when(
            F.col(c).isNotNull(),
            F.struct(F.col(c)["v"].alias("v"), (F.col(c)["p"] + F.col("_start")).alias("p")),
        )

    ends = ends.withColumns(
        {f"{e}_{c}": moved(f"{e}_{c}") for c in columns for e in ("_last", "_first")}
    )
    carry = ends.select(
        *[F.col(k).alias(f"_k_{k}") for k in by],
        F.col("_block").alias("_k__block"),
        "_start",
        *[F.last(f"_last_{c}", ignorenulls=True).over(earlier).alias(f"_in_{c}") for c in columns],
        *[F.last(f"_first_{c}", ignorenulls=True).over(later).alias(f"_out_{c}") for c in columns],
    )
    keys = [*by, "_block"]
    joined = local.join(carry, _match(local, carry, keys))
    joined = joined.withColumns({k: v for c in columns for k, v in around(keys, c).items()})
    joined = joined.withColumns(
        {
            **{f"_prev_{c}": F.coalesce(moved(f"_prev_{c}"), F.col(f"_in_{c}")) for c in columns},
            **{f"_next_{c}": F.coalesce(moved(f"_next_{c}"), F.col(f"_out_{c}")) for c in columns},
        }
    )
    return joined.withColumn("_pos", F.col("_pos") + F.col("_start")).drop(
        "_block", "_start", *[f"_k_{k}" for k in keys],
        *[f"_in_{c}" for c in columns], *[f"_out_{c}" for c in columns],
    )


def _fill_along(
    df: DataFrame,
    columns: Sequence[str],
    order: str,
    partition_by: Sequence[str] | str | None,
    value: Mapping[str, Column],
    group_rows: int | None,
) -> DataFrame:
    by = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    limit = GROUP_ROWS if group_rows is None else group_rows
    found = _neighbours(df, columns, order, by, limit)
    return found.withColumns(dict(value)).select(*df.columns)


def ffill(
    df: DataFrame, columns: Sequence[str], order: str, partition_by=None, group_rows: int | None = None
) -> DataFrame:
    """Last present value in ``order``, within each group."""
    value = {
        c: F.when(~missing(df, c), F.col(c)).otherwise(F.col(f"_prev_{c}")["v"]) for c in columns
    }
    return _fill_along(df, columns, order, partition_by, value, group_rows)


def bfill(
    df: DataFrame, columns: Sequence[str], order: str, partition_by=None, group_rows: int | None = None
) -> DataFrame:
    """Next present value in ``order``, within each group."""
    value = {
        c: F.when(~missing(df, c), F.col(c)).otherwise(F.col(f"_next_{c}")["v"]) for c in columns
    }
    return _fill_along(df, columns, order, partition_by, value, group_rows)


def interpolate(
    df: DataFrame, columns: Sequence[str], order: str, partition_by=None, group_rows: int | None = None
) -> DataFrame:
    """Linear by row position; leading gaps stay, trailing gaps take the last value."""
    value = {}
    for c in columns:
        p, n = F.col(f"_prev_{c}"), F.col(f"_next_{c}")
        step = (n["v"] - p["v"]).cast("double") / (n["p"] - p["p"])
        value[c] = (
            F.when(~missing(df, c), F.col(c).cast("double"))
            .when(p.isNotNull() & n.isNotNull(), p["v"] + step * (F.col("_pos") - p["p"]))
            .otherwise(p["v"].cast("double"))
        )
    return _fill_along(df, columns, order, partition_by, value, group_rows)


STRATEGIES = ("mean", "median", "mode", "ffill", "bfill", "interpolate", "knn", "drop_rows", "drop_col", "constant")


def read_strategies(text: str, columns: Sequence[str]) -> dict[str, str]:
    """``column=strategy`` entries between commas; unknown columns or strategies raise.

    A constant may hold an equals sign, and a column's name may too: the longest known
    name in front of a sign is the column.
    """
    out: dict[str, str] = {}
    for entry in filter(None, (e.strip() for e in text.split(","))):
        known = [c for c in columns if entry.startswith(c) and entry[len(c) :].lstrip().startswith("=")]
        if not known:
            raise ValueError(f"no known column in {entry!r}")
        column = max(known, key=len)
        strategy = entry[len(column) :].lstrip()[1:].strip()
        if strategy.partition(":")[0] not in STRATEGIES:
            raise ValueError(f"unknown strategy in {entry!r}")
        if column in out:
            raise ValueError(f"two strategies for {column}")
        out[column] = strategy
    return out


def _impute_in_order(df: DataFrame, spec: Mapping[str, str], default: str, *, only_numeric: bool, **options) -> DataFrame:
    """One column after the other, runs of columns between two row drops together."""
    numeric, gaps = set(numeric_columns(df)), set(_incomplete(df, df.columns))
    todo: dict[str, str] = {}
    for c in df.columns:
        if c not in gaps or (c not in spec and only_numeric and c not in numeric):
            continue
        strategy = spec.get(c, default)
        if strategy != "drop_rows":
            todo[c] = strategy
            continue
        if todo:
            df = _impute_only(df, todo, **options)
            todo = {}
        df = df.dropna(subset=[c])
    return _impute_only(df, todo, **options) if todo else df


def _impute_only(df: DataFrame, spec: Mapping[str, str], **options) -> DataFrame:
    """The columns of ``spec`` alone; the others keep their gaps."""
    others = {c: "leave" for c in df.columns if c not in spec}
    return impute_by_column(df, {**others, **spec}, "leave", **options)


def impute_by_column(
    df: DataFrame,
    spec: Mapping[str, str] | str = "",
    default: str = "median",
    *,
    order: str | None = None,
    partition_by=None,
    only_numeric: bool = False,
    drop_threshold: float = 1.0,
    id_col: str | None = None,
) -> DataFrame:
    """Per-column strategies with a default for the other columns that have gaps.

    ``spec`` is a mapping or text like ``"age=median,city=mode"``.  Columns of one
    strategy share their statistics pass and all literal fills are one projection.
    Text columns with a numeric default take their mode.
    """
    spec = read_strategies(spec, df.columns) if isinstance(spec, str) else dict(spec)
    df = drop_sparse_columns(nan_to_null(df), drop_threshold)
    dropping = [c for c in df.columns if spec.get(c, default) == "drop_rows"]
    if dropping:
        # Strategies apply in the order of columns: a column's statistics are those of the
        # rows that earlier columns have left.
        return _impute_in_order(df, spec, default, order=order, partition_by=partition_by, only_numeric=only_numeric, id_col=id_col)
    numeric = set(numeric_columns(df))
    gaps = _incomplete(df, df.columns)
    plan: dict[str, list[str]] = {}
    for c in gaps:
        strategy = spec.get(c)
        if strategy is None:
            if only_numeric and c not in numeric:
                continue
            strategy = default
        if strategy == "leave":
            continue
        if c not in numeric and strategy in ("mean", "median", "interpolate", "knn"):
            strategy = "mode"
        plan.setdefault(strategy, []).append(c)

    values: dict[str, object] = dict(_means(df, plan.pop("mean", [])))
    medians = plan.pop("median", [])
    values.update({c: v[0] for c, v in quantiles(df, {c: [0.5] for c in medians}).items()})
    values.update(column_modes(df, plan.pop("mode", [])))
    out = _fill(df, values)
    for strategy, columns in plan.items():
        if strategy.startswith("constant"):
            _, _, constant = strategy.partition(":")
            out = fill_constant(out, constant or None, columns)
        elif strategy == "drop_rows":
            out = out.dropna(subset=columns)
        elif strategy == "drop_col":
            out = out.drop(*columns)
        elif strategy in ("ffill", "bfill", "interpolate"):
            if order is None:
                raise ValueError(f"{strategy} needs order")
            along = {"ffill": ffill, "bfill": bfill, "interpolate": interpolate}[strategy]
            out = along(out, columns, order, partition_by)
        elif strategy == "knn":
            from tilth.operators.neighbors import impute_knn

            if id_col is None:
                raise ValueError("knn needs id_col")
            features = [c for c in df.columns if c in numeric and c != id_col]
            out = impute_knn(out, id_col, features, targets=columns)
        else:
            raise ValueError(f"unknown strategy: {strategy}")
    return out


# --- outliers -------------------------------------------------------------------------


def attach_bounds(df: DataFrame, bounds: Mapping[str, Bounds]) -> DataFrame:
    """Each row with the limits of its columns as ``<column>_low`` and ``<column>_high``."""
    return df.withColumns(
        {
            **{f"{c}_low": F.lit(b.low).cast("double") for c, b in bounds.items()},
            **{f"{c}_high": F.lit(b.high).cast("double") for c, b in bounds.items()},
        }
    )


def _numeric(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    numeric = numeric_columns(df)
    return [c for c in (columns or numeric) if c in numeric]


def clip(df: DataFrame, bounds: Mapping[str, Bounds]) -> DataFrame:
    """Clip columns to their bounds; bounds are literals, so this is a plain projection."""
    return df.withColumns(
        {c: b.clip(number(df, c)) for c, b in bounds.items() if b.low is not None}
    ) if bounds else df


def clip_iqr(df: DataFrame, columns: Sequence[str] | None = None, k: float = 1.5,
             skip_zero_inflated: float | None = None) -> DataFrame:
    """Clip to the quartile fences; columns that are mostly zero can be left alone."""
    chosen = _numeric(df, columns)
    if skip_zero_inflated is not None:
        flat = {r["column"] for r in zero_inflated(df, chosen, skip_zero_inflated).collect()}
        chosen = [c for c in chosen if c not in flat]
    return clip(df, iqr_bounds(df, chosen, k))


def clip_zscore(df: DataFrame, columns: Sequence[str] | None = None, k: float = 3.0) -> DataFrame:
    """Clip to mean plus or minus ``k`` deviations; columns without spread stay."""
    return clip(df, zscore_bounds(df, _numeric(df, columns), k))


def cap_percentile(
    df: DataFrame, columns: Sequence[str] | None = None, low: float = 1, high: float = 99
) -> DataFrame:
    """Clip to the given percentiles."""
    return clip(df, percentile_bounds(df, _numeric(df, columns), low, high))


winsorize = cap_percentile


def clip_report(df: DataFrame, bounds: Mapping[str, Bounds], digits: int = 4) -> DataFrame:
    """Clipped values and bounds per column; missing values do not count as clipped."""
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.count_if(b.outside(number(df, c))).alias("clipped"),
            F.round(F.lit(b.low).cast("double"), digits).alias("lower_bound"),
            F.round(F.lit(b.high).cast("double"), digits).alias("upper_bound"),
        )
        for c, b in bounds.items()
    ]
    return df.agg(F.array(*rows).alias("s")).select(F.explode("s").alias("s")).select("s.*")


def flag_outliers(df: DataFrame, columns: Sequence[str] | None = None, k: float = 1.5) -> DataFrame:
    """Add ``<column>_outlier`` 0/1; a missing value is 0."""
    bounds = iqr_bounds(df, _numeric(df, columns), k)
    return df.withColumns({f"{c}_outlier": b.outside(number(df, c)).cast("int") for c, b in bounds.items()})


def drop_outliers(
    df: DataFrame, columns: Sequence[str] | None = None, method: str = "iqr", k: float | None = None
) -> DataFrame:
    """Rows without an outlier in any column, all bounds from the original data."""
    chosen = _numeric(df, columns)
    bounds = (
        iqr_bounds(df, chosen, k or 1.5) if method == "iqr" else zscore_bounds(df, chosen, k or 3.0)
    )
    bad = F.lit(False)
    for c, b in bounds.items():
        bad = bad | b.outside(number(df, c))
    return df.filter(~bad)


def drop_outliers_sequential(
    df: DataFrame, columns: Sequence[str] | None = None, k: float = 1.5
) -> DataFrame:
    """Column by column, with bounds recomputed on what is left; column order matters.

    Each step only adds a literal filter, so the plan stays one scan with pushed filters.
    """
    for c in _numeric(df, columns):
        df = df.filter(~iqr_bounds(df, [c], k)[c].outside(number(df, c)))
    return df


def length_bounds(df: DataFrame, text_col: str = "text", k: float = 1.5) -> Bounds:
    """Quartile fences of the text length.

    Lengths are written out first, so the text is read once and the passes over
    its quantiles read numbers only.
    """
    return iqr_bounds(cut(df.select(F.length(text_col).alias("n"))), ["n"], k)["n"]


def filter_by_length_iqr(df: DataFrame, text_col: str = "text", k: float = 1.5) -> DataFrame:
    """Rows whose text length lies inside the quartile fences, ends included."""
    b = length_bounds(df, text_col, k)
    if b.low is None:
        return df
    return df.filter(F.length(text_col).between(b.low, b.high))
