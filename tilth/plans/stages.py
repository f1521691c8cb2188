"""The four stages from collected sources to a trained model, as DataFrame steps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tilth.functions.store import cut
from tilth.operators.agree import label_quality
from tilth.operators.combine import apply_corrections
from tilth.operators.compare import compare
from tilth.operators.detect import quality_report
from tilth.operators.learn import TextClassifier, learning_curve, run_cycle, savings
from tilth.operators.sampling import seed_and_pool, stratified_cap, stratified_split
from tilth.plans.quality import clean_aggressive
from tilth.sources.collect import drop_incomplete, known_labels, normalize_labels
from tilth.sources.writers import labeling_tasks, review_queue


def collect_stage(
    unified: DataFrame,
    id_col: str,
    codes: Mapping[str, str],
    labels: Sequence[str],
    *,
    cap: int,
    by_source: Mapping[str, Mapping[str, str]] | None = None,
) -> DataFrame:
    """Decode labels, drop incomplete rows, cap every source with label shares kept."""
    named = normalize_labels(unified, codes, labels, by_source=by_source)
    return stratified_cap(drop_incomplete(named), "source", "label", id_col, cap)


def quality_stage(
    collected: DataFrame, id_col: str, n: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cleaned rows, quality report before, before/after comparison)."""
    before = cut(collected)
    cleaned = cut(clean_aggressive(before, id_col, n=n))
    return cleaned, quality_report(before, "label"), compare(before, cleaned)


def review_stage(
    labelled: DataFrame, queue: DataFrame, allowed: Sequence[str], *, position: str
) -> tuple[DataFrame, DataFrame]:
    """(corrected rows, label quality against the labels people gave)."""
    corrected = apply_corrections(labelled, queue, allowed, position=position)
    reference = "human_label" if "human_label" in labelled.columns else None
    return corrected, label_quality(corrected, reference)


@dataclass
class Learned:
    curve: DataFrame
    saved: DataFrame
    model: TextClassifier


def learning_stage(
    labelled: DataFrame,
    id_col: str,
    labels: Sequence[str],
    *,
    n_start: int = 50,
    n_iterations: int = 5,
    batch: int = 20,
) -> Learned:
    """Entropy sampling against the random baseline from the same seed rows."""
    split = cut(stratified_split(known_labels(labelled, labels), "label", id_col))
    train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    seed, pool = seed_and_pool(train, id_col, n_start, batch)
    cycle = {"n_iterations": n_iterations, "batch": batch, "test": test}
    entropy, model = run_cycle(seed, pool, id_col, strategy="entropy", **cycle)
    random, _ = run_cycle(seed, pool, id_col, strategy="random", **cycle)
    return Learned(learning_curve(entropy, random), savings(entropy, random), model)


def export_stage(labelled: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """(labelling-tool tasks, rows for human review)."""
    return labeling_tasks(labelled, id_col), review_queue(labelled)


