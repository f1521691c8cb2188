"""Scalar expressions: text, verdict parsing, thresholds and severity ladders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tilth.schema import strip

# Words left out of the word statistics.
STOP_WORDS = [
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for",
    "of", "with", "it", "is", "was", "i", "my", "this", "that", "be", "not",
]

# Strings that stand for a missing value.
NULL_SENTINELS = ["?", "N/A", "-"]

# Severity ladders as (exclusive lower bound, name), highest first.
MISSING_TABLE = [(0.3, "critical"), (0.1, "high"), (0.02, "medium")]
MISSING_COLUMN = [(0.5, "critical"), (0.2, "high"), (0.05, "medium")]
DUPLICATE_PCT = [(10, "high"), (1, "medium")]
IMBALANCE_RATIO = [(20, "critical"), (10, "high"), (3, "medium")]
OUTLIER_SHARE = [(0.1, "high"), (0.02, "medium")]
OVERALL = [
    ((40, 15, 10), "critical"),
    ((20, 5, 5), "high"),
    ((5, 1, 3), "medium"),
]


def severity(value: Column, ladder: list[tuple[float, str]]) -> Column:
    """First rung whose bound is strictly below ``value``; otherwise low."""
    (bound, name), *rest = ladder
    out = F.when(value > bound, name)
    for bound, name in rest:
        out = out.when(value > bound, name)
    return out.otherwise("low")


def overall_severity(missing_pct: Column, duplicate_pct: Column, ratio: Column) -> Column:
    out = F.lit("low")
    for (m, d, r), name in reversed(OVERALL):
        out = F.when(
            (missing_pct > m) | (duplicate_pct > d) | (F.coalesce(ratio, F.lit(1.0)) > r), name
        ).otherwise(out)
    return out


def tokenize(text: Column | str) -> Column:
    """Lower-case runs of a-z and 0-9; other letters separate tokens."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("([a-z0-9]+)"))


def words(text: Column | str) -> Column:
    """Whole ASCII words in lower case without stop words."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"\b([a-zA-Z]+)\b"))
    return F.filter(found, lambda w: ~w.isin(STOP_WORDS))


def text_length(text: Column | str) -> Column:
    return F.length(text)


def word_count(text: Column | str) -> Column:
    """Runs of other than white space.  One character stands for each while they are counted: an
    array of all words of a large file would take many times its size."""
    return F.length(F.regexp_replace(F.regexp_replace(text, r"\S+", "x"), r"\s+", ""))


def compact_record(
    id_col="id", downloads="downloads", license_col="license", sizes="size_categories",
    tags="tags", description="description",
) -> Column:
    """One line describing a catalog row, with placeholders for what is absent."""
    size_text = F.when(F.size(sizes) > 0, F.array_join(sizes, ", ")).otherwise("?")
    return F.concat_ws(
        " | ",
        F.concat(F.lit("ID: "), F.col(id_col)),
        F.concat(F.lit("DL: "), F.coalesce(F.col(downloads).cast("string"), F.lit("0"))),
        F.concat(F.lit("License: "), F.coalesce(F.col(license_col), F.lit("?"))),
        F.concat(F.lit("Size: "), size_text),
        F.concat(F.lit("Tags: "), F.coalesce(F.array_join(F.slice(tags, 1, 8), ", "), F.lit(""))),
        F.concat(F.lit("Desc: "), F.coalesce(F.substring(description, 1, 300), F.lit(""))),
    )


def reply_body(reply: Column | str) -> Column:
    """The JSON part of a model reply: text after the last think block, out of its code fence."""
    after = strip(F.element_at(F.split(reply, "</think>"), -1))
    parts = F.transform(
        F.split(after, "```"), lambda p: strip(F.regexp_replace(strip(p), r"^json", ""))
    )
    fenced = F.filter(parts, lambda p: p.startswith("[") | p.startswith("{"))
    return F.when(after.contains("```") & (F.size(fenced) > 0), fenced[0]).otherwise(after)


def parse_model_json(reply: Column | str) -> Column:
    """Parsed reply as a variant; null when it is not JSON."""
    return F.try_parse_json(reply_body(reply))


def is_blank(text: Column | str) -> Column:
    return F.coalesce(strip(text), F.lit("")) == ""


def null_if_zero(value: Column) -> Column:
    return F.when(value != 0, value)


def size_mb(num_bytes: Column | str) -> Column:
    b = F.col(num_bytes) if isinstance(num_bytes, str) else num_bytes
    return F.round(null_if_zero(b) / F.lit(1048576.0), 2)


def size_kb(num_bytes: Column | str) -> Column:
    b = F.col(num_bytes) if isinstance(num_bytes, str) else num_bytes
    return F.round(null_if_zero(b) / F.lit(1024.0), 1)


def partial_rows_label(rows: Column, state: Column) -> Column:
    """Row count as shown to people: exact, partial, or unreliable."""
    text = rows.cast("string")
    return (
        F.when(rows.isNull() | (state == "unreliable"), "? (unreliable)")
        .when(state == "partial", F.concat(F.lit("~"), text, F.lit(" (partial)")))
        .otherwise(text)
    )


def kappa_band(kappa: Column) -> Column:
    return (
        F.when(kappa < 0.2, "slight")
        .when(kappa < 0.4, "fair")
        .when(kappa < 0.6, "moderate")
        .when(kappa < 0.8, "substantial")
        .when(kappa.isNotNull(), "almost perfect")
    )


def auto_top_n(count: Column) -> Column:
    """How many candidates to rank, by the size of the candidate list; 60 when it is unknown."""
    return (
        F.when(count < 100, 30).when(count < 300, 50).when(count < 600, 70)
        .when(count.isNotNull(), 100).otherwise(60)
    )


def signed(value: Column) -> Column:
    return F.format_string("%+d", value)


def signed_pct(before: Column, after: Column) -> Column:
    return F.format_string("%+.1f%%", (after - before) / before.cast("double") * 100)
