"""Machine labels with confidence, and what goes to human review."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.functions.scalars import is_blank
from tilth.sources.collect import stamp

THRESHOLD = 0.75
BATCH = 8

# Takes the input values of a batch and the candidate labels, returns one score per (row, label).
Scorer = Callable[[pd.Series, Sequence[str]], np.ndarray]


def flag_low_confidence(
    df: DataFrame,
    *,
    threshold: float = THRESHOLD,
    text_col: str = "text",
    label_col: str = "label",
    confidence_col: str = "confidence",
) -> DataFrame:
    """Flag rows strictly below the threshold; a blank text has no label and confidence 0."""
    blank = is_blank(F.col(text_col))
    confidence = F.when(blank, F.lit(0.0)).otherwise(F.col(confidence_col))
    return df.withColumns(
        {
            label_col: F.when(~blank, F.col(label_col)),
            confidence_col: confidence,
            "flagged_for_review": confidence < threshold,
        }
    )


def auto_label(
    df: DataFrame,
    labels: Sequence[str],
    make_scorer: Callable[[], Scorer],
    *,
    text_col: str = "text",
    input_col: str | None = None,
    threshold: float = THRESHOLD,
    batch: int = BATCH,
    labeled_at: datetime | Column | None = None,
) -> DataFrame:
    """Label every row with its best-scoring candidate label.

    ``make_scorer`` runs once per Python worker task and may load a model there.
    Values reach the scorer in slices of ``batch``; blank texts are sent as "."
    and their result is discarded.  An existing ``label`` is kept as ``human_label``.
    """
    labels = list(labels)
    source = input_col or text_col
    if "label" in df.columns:
        df = df.withColumnRenamed("label", "human_label")
    out = T.StructType(
        [*df.schema.fields, T.StructField("label", T.StringType()), T.StructField("confidence", T.DoubleType())]
    )
    blank_as_dot = input_col is None

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        names = np.array(labels, dtype=object)
        for b in batches:
            values = b[source]
            if blank_as_dot:
                values = values.map(lambda t: t if isinstance(t, str) and t.strip() else ".")
            best, confidence = [], []
            for i in range(0, len(values), batch):
                scores = np.asarray(scorer(values.iloc[i : i + batch], labels), dtype=float)
                top = scores.argmax(axis=1)
                best.append(names[top])
                confidence.append(np.take_along_axis(scores, top[:, None], axis=1)[:, 0])
            yield b.assign(
                label=np.concatenate(best) if best else [],
                confidence=np.concatenate(confidence) if confidence else [],
            )

    scored = df.mapInPandas(score, out).withColumn("confidence", F.round("confidence", 4))
    flagged = flag_low_confidence(scored, threshold=threshold, text_col=text_col)
    return flagged.withColumn("labeled_at", stamp(labeled_at))


def centroids(df: DataFrame, vector_col: str, label_col: str) -> DataFrame:
    """Mean vector per label as an array, averaged element by element with partial aggregation."""
    return (
        df.filter(F.col(label_col).isNotNull())
        .select(F.col(label_col).cast("string").alias("label"), F.posexplode(vector_col).alias("i", "x"))
        .groupBy("label", "i")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
        .groupBy("label")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("centroid"))
    )


def centroid_scorer(table: DataFrame, labels: Sequence[str]) -> Callable[[], Scorer]:
    """Scorer for vectors: softmax of negative distance to each label's centroid.

    The table is cut to the candidate labels first, so what is sent to the tasks
    is one vector per candidate.
    """
    held = {r["label"]: r["centroid"] for r in table.filter(F.col("label").isin(list(labels))).collect()}
    centre = np.array([held[x] for x in labels], dtype=float)

    def make() -> Scorer:
        def score(vectors: pd.Series, names: Sequence[str]) -> np.ndarray:
            x = np.stack(vectors.to_numpy()).astype(float)
            d = np.sqrt(((x[:, None, :] - centre[None, :, :]) ** 2).sum(axis=2))
            e = np.exp(d.min(axis=1, keepdims=True) - d)
            return e / e.sum(axis=1, keepdims=True)

        return score

    return make
