"""Schemas and column helpers shared by all operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The unified record and the default label set.
UNIFIED_COLUMNS = ["text", "audio", "image", "label", "source", "collected_at"]
LABELS = ["negative", "neutral", "positive"]
LABEL_CODES = {"0": "negative", "1": "neutral", "2": "positive"}

UNIFIED = T.StructType(
    [T.StructField(c, T.StringType()) for c in UNIFIED_COLUMNS[:-1]]
    + [T.StructField("collected_at", T.TimestampType())]
)


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns in schema order; booleans are not numeric."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def number(df: DataFrame, name: str) -> Column:
    """The column as a double with NaN turned into null (Spark sorts NaN above all numbers)."""
    value = F.col(name).cast("double")
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(value), value)
    return value


def missing(df: DataFrame, name: str) -> Column:
    """True where the value is null or NaN."""
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return F.col(name).isNull() | F.isnan(name)
    return F.col(name).isNull()


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into null in every floating column."""
    floats = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))
    ]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def strip(col: Column | str) -> Column:
    """Strip all whitespace at both ends; SQL ``trim`` only removes spaces."""
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def cols(*names: str | Iterable[str] | None) -> list[str]:
    """Flatten names and lists of names."""
    out: list[str] = []
    for n in names:
        if n is None:
            continue
        out.extend([n] if isinstance(n, str) else list(n))
    return out
