"""Reading tables, folders of files and id lists."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.functions.scalars import word_count
from tilth.schema import nan_to_null, strip

# File suffixes by modality.
IMAGE_SUFFIXES = [".jpg", ".jpeg", ".png", ".bmp", ".webp", ".tiff"]
AUDIO_SUFFIXES = [".wav", ".mp3", ".flac", ".ogg", ".m4a"]
TABLE_SUFFIXES = [".csv", ".parquet", ".pq", ".json", ".jsonl", ".xlsx", ".xls", ".ndjson"]
SINGLE_IMAGE_SUFFIXES = [".jpg", ".jpeg", ".png"]
SINGLE_AUDIO_SUFFIXES = [".wav", ".mp3", ".flac"]


def read_any(
    spark: SparkSession,
    path: str,
    *,
    sep: str = ",",
    schema: T.StructType | str | None = None,
    suffix: str | None = None,
    multiline: bool | None = None,
) -> DataFrame:
    """Read a table by suffix: csv, parquet/pq, json (one document), jsonl/ndjson.

    Pass ``schema`` for large csv or json input: inferring it costs one more scan.
    A csv file is read by one task if its quoted fields hold line breaks, and in splits
    otherwise; without ``multiline`` a scan of its lines, in splits, finds out.
    """
    kind = (suffix or PurePosixPath(path).suffix).lower()
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if kind == ".csv":
        infer = schema is None
        if multiline is None:
            multiline = _broken_lines(spark, path)
        df = reader.csv(path, header=True, sep=sep, inferSchema=infer, multiLine=multiline, escape='"')
    elif kind in (".parquet", ".pq"):
        df = reader.parquet(path)
    elif kind == ".json":
        df = reader.json(path, multiLine=True)
    elif kind in (".jsonl", ".ndjson"):
        df = reader.json(path)
    else:
        raise ValueError(f"unsupported table format: {kind or path}")
    return nan_to_null(df)


def _broken_lines(spark: SparkSession, path: str) -> bool:
    """Whether a line ends inside quotes: then it has an odd number of them, doubled ones counting twice."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).filter(quotes % 2 == 1).limit(1).isEmpty()


def _suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./\\]+)$", 1))


def _with_file_columns(files: DataFrame) -> DataFrame:
    return files.select(
        "*",
        _suffix(F.col("path")).alias("extension"),
        F.element_at(F.split("path", "/"), -2).alias("class"),
    )


def files_inventory(
    spark: SparkSession, path: str, extensions: Sequence[str] | None = None
) -> DataFrame:
    """Recursive listing: path, length, extension and class (the parent folder).

    Only the listing is read; the pruned ``content`` column is never loaded.
    """
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length")
    )
    listing = _with_file_columns(found)
    if extensions is not None:
        listing = listing.filter(F.col("extension").isin([e.lower() for e in extensions]))
    return listing


def stored_files(files: DataFrame, extensions: Sequence[str] | None = None) -> DataFrame:
    """The same shape for a table that already holds (path, length[, content])."""
    listing = _with_file_columns(files)
    if extensions is not None:
        listing = listing.filter(F.col("extension").isin([e.lower() for e in extensions]))
    return listing


def read_text_dir(spark: SparkSession, path: str) -> DataFrame:
    """Every .txt file below ``path`` as one row: path, text, bytes, words."""
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.txt")
        .text(path, wholetext=True)
        .select(
            F.input_file_name().alias("path"),
            F.col("value").alias("text"),
            F.octet_length("value").cast("long").alias("bytes"),
            word_count("value").cast("long").alias("words"),
        )
    )


def detect_modality(inventory: DataFrame) -> DataFrame:
    """Modality of a folder listing: image if it holds any image, else audio, else text."""
    return inventory.agg(
        F.when(F.coalesce(F.bool_or(F.col("extension").isin(IMAGE_SUFFIXES)), F.lit(False)), "image")
        .when(F.coalesce(F.bool_or(F.col("extension").isin(AUDIO_SUFFIXES)), F.lit(False)), "audio")
        .otherwise("text")
        .alias("modality")
    )


def file_modality(path: Column | str) -> Column:
    """Modality of a single file by its suffix."""
    suffix = _suffix(F.col(path) if isinstance(path, str) else path)
    return (
        F.when(suffix.isin(TABLE_SUFFIXES), "tabular")
        .when(suffix.isin(SINGLE_IMAGE_SUFFIXES), "image")
        .when(suffix.isin(SINGLE_AUDIO_SUFFIXES), "audio")
        .otherwise("text")
    )


def id_set(ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Distinct non-blank ids, stripped, sorted."""
    return (
        ids.select(strip(F.col(id_col).cast("string")).alias("id"))
        .filter(F.col("id") != "")
        .distinct()
        .orderBy("id")
    )


def read_id_set(spark: SparkSession, path: str) -> DataFrame:
    """Ids from a newline-separated file or folder of such files."""
    return id_set(spark.read.text(path), "value")


def sample_rows(df: DataFrame, by: Sequence[str] | str, order: str, n: int = 15) -> DataFrame:
    """First ``n`` rows of every dataset, in ``order``."""
    by = [by] if isinstance(by, str) else list(by)
    return (
        df.withColumn("_r", F.row_number().over(W.partitionBy(*by).orderBy(order)))
        .filter(F.col("_r") <= n)
        .drop("_r")
    )


def sample_json(
    df: DataFrame,
    by: str,
    order: str,
    columns: Sequence[str],
    n: int = 15,
    max_chars: int = 3000,
) -> DataFrame:
    """First ``n`` rows of every dataset as one JSON string cut to ``max_chars``."""
    taken = sample_rows(df, by, order, n)
    held = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), F.struct(*columns).alias("row"))))
    return taken.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"),
        F.substring(F.to_json(F.transform(held, lambda s: s["row"])), 1, max_chars).alias("samples"),
    )
