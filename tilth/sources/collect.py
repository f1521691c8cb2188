"""Bringing tables of different shapes into the unified schema and the catalog schema."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.functions.scalars import null_if_zero
from tilth.operators.sampling import sample_n
from tilth.schema import UNIFIED, UNIFIED_COLUMNS

# Column names tried for text and label, in this order.
TEXT_CANDIDATES = ["text", "sentence", "review", "content"]
LABEL_CANDIDATES = ["label", "label_text", "category", "class"]
# Envelope fields of a stored API response, in this order.
ENVELOPES = ["results", "data", "items"]


def stamp(at: datetime | Column | None) -> Column:
    """The given time, or now."""
    return (F.current_timestamp() if at is None else F.lit(at)).cast("timestamp")


def pick_column(df: DataFrame, wanted: Sequence[str], *, parts: bool = False) -> str | None:
    """The column that a list of names asks for, or none.

    A column of one of these names is taken, the earlier name first.  With ``parts`` a
    column that only holds a name will do, a string before other types.  Where the table's
    order alone decides between such columns, a warning names them.
    """
    named = {name.casefold(): place for place, name in enumerate(wanted)}
    exact = [f.name for f in df.schema.fields if f.name.casefold() in named]
    if exact:
        return min(exact, key=lambda c: named[c.casefold()])
    holding = [f for f in df.schema.fields if parts and any(name in f.name.casefold() for name in named)]
    strings = [f for f in holding if isinstance(f.dataType, T.StringType)]
    left = [f.name for f in strings or holding]
    if len(left) > 1:
        warnings.warn(f"{left[0]} taken for {'/'.join(wanted)}; {', '.join(left[1:])} would do as well", stacklevel=3)
    return left[0] if left else None


def load_dataset(
    df: DataFrame,
    name: str,
    *,
    origin: str = "hf",
    text_col: str | None = None,
    label_col: str | None = None,
    collected_at: datetime | Column | None = None,
) -> DataFrame:
    """Project a table to text, label, source, collected_at.

    Without explicit columns they are picked by name or part of it; the text falls back
    on the first column and the label on null.  Nulls stay null.
    """
    text = text_col or pick_column(df, TEXT_CANDIDATES[:1], parts=True) or df.columns[0]
    label = label_col or pick_column(df, LABEL_CANDIDATES[:1], parts=True)
    return df.select(
        F.col(text).cast("string").alias("text"),
        (F.col(label) if label else F.lit(None)).cast("string").alias("label"),
        F.lit(f"{origin}:{name}").alias("source"),
        stamp(collected_at).alias("collected_at"),
    )


def to_unified(
    df: DataFrame,
    label_names: Mapping[str, str],
    *,
    text_candidates: Sequence[str] = TEXT_CANDIDATES,
    label_candidates: Sequence[str] = LABEL_CANDIDATES,
) -> DataFrame:
    """Resolve text and label by candidate names and decode digit labels."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    text = pick_column(df, text_candidates) or next(iter(strings), None)
    if text is None:
        raise ValueError("no text column found")
    label = pick_column(df, label_candidates) or df.columns[1]
    raw = F.col(label).cast("string")
    pairs = [F.lit(x) for kv in label_names.items() for x in kv]
    decoded = F.create_map(*pairs)[raw] if pairs else F.lit(None)
    return df.select(
        F.col(text).cast("string").alias("text"),
        F.when(raw.rlike("^[0-9]+$"), F.coalesce(decoded, raw)).otherwise(raw).alias("label"),
    )


def union_splits(splits: Mapping[str, DataFrame]) -> DataFrame:
    """Stack named splits, tagging each row with its split."""
    frames = [df.withColumn("split", F.lit(name)) for name, df in splits.items()]
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def news_to_unified(
    df: DataFrame,
    source: str,
    *,
    title: str = "title",
    topic: str = "topic",
    published: str = "published_date",
    max_rows: int | None = None,
    id_col: str | None = None,
    seed: object = 42,
) -> DataFrame:
    """News listing to unified rows; the date becomes ISO text in UTC.

    ``max_rows`` samples before incomplete rows are dropped and needs ``id_col``.
    """
    if max_rows is not None:
        if id_col is None:
            raise ValueError("max_rows needs id_col")
        df = sample_n(df, max_rows, id_col, seed)
    when = F.to_timestamp(published) if dict(df.dtypes)[published] == "string" else F.col(published)
    null = F.lit(None).cast("string")
    return df.select(
        F.col(title).cast("string").alias("text"),
        null.alias("audio"),
        null.alias("image"),
        F.col(topic).cast("string").alias("label"),
        F.lit(source).alias("source"),
        F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("collected_at"),
    ).dropna(subset=["text", "label"])


def flatten_struct(df: DataFrame, prefix: str = "") -> list[Column]:
    """Leaf columns of nested structs under dotted names."""

    def leaves(path: str, name: str, dtype: T.DataType) -> list[Column]:
        if isinstance(dtype, T.StructType):
            return [
                c
                for f in dtype.fields
                for c in leaves(f"{path}.`{f.name}`", f"{name}.{f.name}", f.dataType)
            ]
        return [F.col(path).alias(name)]

    return [c for f in df.schema.fields for c in leaves(f"`{f.name}`", f.name, f.dataType)]


def flatten_api(
    bodies: DataFrame,
    body_col: str,
    record: T.StructType | str,
    endpoint: str,
    *,
    text_field: str | None = None,
    collected_at: datetime | Column | None = None,
) -> DataFrame:
    """Records of stored JSON response bodies as flat rows with a text column.

    A list is its own records; an object holds them under one of the envelope
    fields, else is a record itself.  ``record`` is the schema of one record.
    """
    schema = record if isinstance(record, str) else record.simpleString()
    body = F.col(body_col)
    is_list = F.ltrim(body).startswith("[")
    wrapped = F.from_json(body, ", ".join(f"{e} array<{schema}>" for e in ENVELOPES))
    single = F.array(F.from_json(body, schema))
    records = F.when(is_list, F.from_json(body, f"array<{schema}>")).otherwise(
        F.coalesce(*[wrapped[e] for e in ENVELOPES], single)
    )
    rows = bodies.select(F.explode(records).alias("_rec")).select("_rec.*")
    flat = rows.select(*flatten_struct(rows))
    text = text_field if text_field in flat.columns else flat.columns[0]
    return flat.withColumns(
        {
            "text": F.col(f"`{text}`").cast("string"),
            "source": F.lit(f"api:{endpoint}"),
            "collected_at": stamp(collected_at),
        }
    )


def conform(df: DataFrame) -> DataFrame:
    """The unified columns in fixed order; absent ones are null."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(c) if c in have else F.lit(None)).cast(UNIFIED[c].dataType).alias(c)
            for c in UNIFIED_COLUMNS
        ]
    )


def merge(sources: Sequence[DataFrame]) -> DataFrame:
    """Stack sources in the unified schema; no row is dropped."""
    out = conform(sources[0])
    for df in sources[1:]:
        out = out.unionByName(conform(df))
    return out


def normalize_labels(
    df: DataFrame,
    mapping: Mapping[str, str],
    allowed: Sequence[str],
    *,
    label_col: str = "label",
    source_col: str = "source",
    by_source: Mapping[str, Mapping[str, str]] | None = None,
) -> DataFrame:
    """Decode labels and drop rows whose label is not allowed; null labels stay.

    ``by_source`` overrides the mapping for single sources, since the same code
    can mean different things in two datasets.
    """
    raw = F.col(label_col).cast("string")

    def decoded(codes: Mapping[str, str]) -> Column:
        pairs = [F.lit(x) for kv in codes.items() for x in kv]
        return F.coalesce(F.create_map(*pairs)[raw], raw) if pairs else raw

    label = decoded(mapping)
    for source, codes in (by_source or {}).items():
        label = F.when(F.col(source_col) == source, decoded(codes)).otherwise(label)
    return df.withColumn(label_col, label).filter(
        F.col(label_col).isNull() | F.col(label_col).isin(list(allowed))
    )


def drop_incomplete(df: DataFrame, subset: Sequence[str] = ("text", "label")) -> DataFrame:
    return df.dropna(subset=list(subset))


def known_labels(
    df: DataFrame, labels: Sequence[str], *, text_col: str = "text", label_col: str = "label"
) -> DataFrame:
    return df.filter(F.col(label_col).isin(list(labels)) & F.col(text_col).isNotNull())


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


#: Where a dataset's page is, by platform (fixed values).
HUB_URL, LISTING_URL = "https://huggingface.co/datasets/", "https://www.kaggle.com/datasets/"


def _shortened(c: Column, length: int | None) -> Column:
    return c if length is None else F.substring(c, 1, length)


def catalog_from_hub(raw: DataFrame, query_col: str = "query", description_chars: int | None = None) -> DataFrame:
    """Stored hub records to catalog rows; ``description_chars`` shortens descriptions.

    ``raw`` columns: id, description, tags array, license array or string,
    task_categories, task_ids, size_categories and language arrays, pretty_name,
    dataset_info (struct or array of struct with dataset_size, size_in_bytes),
    downloads, likes, last_modified.
    """
    info = raw.schema["dataset_info"].dataType
    first = F.try_element_at("dataset_info", F.lit(1)) if isinstance(info, T.ArrayType) else F.col("dataset_info")
    num_bytes = F.coalesce(null_if_zero(first["dataset_size"]), null_if_zero(first["size_in_bytes"]))
    if isinstance(raw.schema["license"].dataType, T.ArrayType):
        license_text = F.array_join("license", " ")
    else:
        license_text = F.col("license")
    none = F.array().cast("array<string>")

    def joined(c: str) -> Column:
        return F.coalesce(F.array_join(c, " "), F.lit(""))

    return raw.filter(_text("id") != "").select(
        F.col("id").cast("string").alias("id"),
        F.element_at(F.split(F.col("id").cast("string"), "/"), -1).alias("name"),
        _shortened(_text("description"), description_chars).alias("description"),
        F.lit("").alias("card_text"),
        F.concat_ws(
            " ",
            F.col("id").cast("string"),
            _text("description"),
            joined("tags"),
            F.coalesce(license_text, F.lit("")),
            joined("task_categories"),
            joined("task_ids"),
            _text("pretty_name"),
        ).alias("corpus_text"),
        F.coalesce(F.col("downloads").cast("long"), F.lit(0)).alias("downloads"),
        F.coalesce(F.col("likes").cast("long"), F.lit(0)).alias("likes"),
        F.coalesce("tags", none).alias("tags"),
        F.coalesce("task_categories", none).alias("task_categories"),
        F.coalesce(license_text, F.lit("unknown")).alias("license"),
        F.coalesce("size_categories", none).alias("size_categories"),
        F.round(num_bytes / F.lit(1024.0), 1).alias("size_kb"),
        F.coalesce("language", none).alias("language"),
        F.coalesce(
            F.nullif(F.substring(_text("last_modified"), 1, 10), F.lit("")), F.lit("unknown")
        ).alias("last_updated"),
        F.lit("huggingface").alias("platform"),
        F.concat(F.lit(HUB_URL), F.col("id").cast("string")).alias("url"),
        F.array(F.col(query_col)).alias("matched_queries"),
    )


def parse_int(c: Column) -> Column:
    """Integer text with thousands commas; anything else is 0."""
    return F.coalesce(F.regexp_replace(F.trim(c), ",", "").try_cast("long"), F.lit(0))


def catalog_from_listing(raw: DataFrame, query_col: str = "query", description_chars: int | None = None) -> DataFrame:
    """Stored csv listing rows to catalog rows; ``description_chars`` shortens subtitles.

    ``raw`` string columns: ref, title, subtitle, tags, size, downloadCount,
    totalBytes, voteCount, licenseName, lastUpdated, creationDate.
    """
    ref = F.trim(_text("ref"))
    title = F.trim(F.coalesce(F.col("title"), ref))
    subtitle = _shortened(F.trim(_text("subtitle")), description_chars)
    tags = F.filter(F.transform(F.split(_text("tags"), ","), lambda t: F.trim(t)), lambda t: t != "")
    licence = F.trim(F.coalesce(F.col("licenseName"), F.lit("unknown")))
    size = F.trim(_text("size"))
    none = F.array().cast("array<string>")
    first = F.coalesce(F.nullif(_text("downloadCount"), F.lit("")), F.nullif(_text("totalBytes"), F.lit("")), F.lit("0"))
    updated = F.coalesce(F.nullif(_text("lastUpdated"), F.lit("")), _text("creationDate"))
    return raw.filter(ref != "").select(
        F.concat(F.lit("kaggle:"), ref).alias("id"),
        title.alias("name"),
        subtitle.alias("description"),
        F.lit("").alias("card_text"),
        F.concat_ws(" ", ref, title, subtitle, F.array_join(tags, " "), licence).alias("corpus_text"),
        parse_int(first).alias("downloads"),
        parse_int(_text("voteCount")).alias("likes"),
        tags.alias("tags"),
        none.alias("task_categories"),
        licence.alias("license"),
        F.when(size != "", F.array(size)).otherwise(none).alias("size_categories"),
        none.alias("language"),
        F.substring(updated, 1, 10).alias("last_updated"),
        F.lit("kaggle").alias("platform"),
        F.concat(F.lit(LISTING_URL), ref).alias("url"),
        F.array(F.col(query_col)).alias("matched_queries"),
    )


def null_sentinels(df: DataFrame, sentinels: Sequence[str], subset: Sequence[str] | None = None) -> DataFrame:
    """Turn sentinel strings into null before detection."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    chosen = [c for c in strings if subset is None or c in subset]
    return df.withColumns(
        {c: F.when(~F.col(c).isin(list(sentinels)), F.col(c)) for c in chosen}
    )
