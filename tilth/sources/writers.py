"""Writing tables, review queues, labelling tasks and reports."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.sources.readers import id_set

# Names the labelling tool expects in a task.
MODEL_VERSION = "annotation_agent_v1"
FROM_NAME = "sentiment"
TO_NAME = "text"


def write_any(df: DataFrame, path: str, *, sep: str = ",", suffix: str | None = None) -> str:
    """Write csv (with header) or parquet by suffix; an existing path is an error."""
    kind = (suffix or PurePosixPath(path).suffix).lower()
    writer = df.write.mode("errorifexists")
    if kind == ".csv":
        writer.csv(path, header=True, sep=sep, escape='"', quoteAll=True)
    elif kind in (".parquet", ".pq"):
        writer.parquet(path)
    elif kind in (".jsonl", ".ndjson"):
        writer.json(path)
    else:
        raise ValueError(f"unsupported output format: {kind or path}")
    return path


def write_id_set(ids: DataFrame, path: str, id_col: str = "id") -> str:
    """Sorted unique ids, one per line; the folder is replaced."""
    id_set(ids, id_col).write.mode("overwrite").text(path)
    return path


def labeling_tasks(
    df: DataFrame,
    id_col: str,
    *,
    text_col: str = "text",
    label_col: str = "label",
    confidence_col: str = "confidence",
    flag_col: str = "flagged_for_review",
) -> DataFrame:
    """One nested labelling-tool task per row; a prediction only where a label is present."""
    row_id = F.col(id_col).cast("long")
    label = F.col(label_col).cast("string")
    confidence = F.coalesce(F.col(confidence_col).cast("double"), F.lit(0.0))
    flagged = F.coalesce(F.col(flag_col), F.lit(False))
    result = F.struct(
        F.concat(F.lit("result_"), row_id.cast("string")).alias("id"),
        F.lit("choices").alias("type"),
        F.struct(F.array(label).alias("choices")).alias("value"),
        F.lit(FROM_NAME).alias("from_name"),
        F.lit(TO_NAME).alias("to_name"),
    )
    prediction = F.struct(
        F.lit(MODEL_VERSION).alias("model_version"),
        confidence.alias("score"),
        F.array(result).alias("result"),
    )
    return df.select(
        row_id.alias("id"),
        F.struct(F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("data"),
        F.struct(
            confidence.alias("confidence"),
            row_id.alias("source_row"),
            flagged.alias("flagged_for_review"),
        ).alias("meta"),
        F.when(F.coalesce(label, F.lit("")) != "", F.array(prediction)).alias("predictions"),
    )


def write_tasks(tasks: DataFrame, path: str) -> str:
    """Tasks as JSON Lines; absent predictions are left out."""
    tasks.write.mode("overwrite").option("ignoreNullFields", True).json(path)
    return path


def review_queue(df: DataFrame, flag_col: str = "flagged_for_review") -> DataFrame:
    """Rows a person should look at."""
    return df.filter(F.coalesce(F.col(flag_col), F.lit(False)))


def write_review_queue(df: DataFrame, path: str, flag_col: str = "flagged_for_review") -> str:
    """Write the queue; an empty queue replaces an older one, so stale edits are never applied."""
    review_queue(df, flag_col).write.mode("overwrite").csv(path, header=True, escape='"', quoteAll=True)
    return path


def report_json(report: DataFrame, name: str = "report") -> DataFrame:
    """Each report row as one JSON object; non-ASCII text is kept."""
    return report.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(name))

