"""Deduplication and the joins between candidates, verdicts, corrections and id sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def dedupe(
    df: DataFrame, order: str, subset: Sequence[str] | None = None, keep: str = "first"
) -> DataFrame:
    """Keep the first, last or none of equal rows by ``order``; null equals null.

    The row-number filter is applied before the shuffle as well as after it, so a
    key held by a third of all rows still sends only one or two rows per task.
    """
    keys = list(subset) if subset else [c for c in df.columns if c != order]
    if keep in ("first", "last"):
        by = F.col(order).asc() if keep == "first" else F.col(order).desc()
        w = W.partitionBy(*keys).orderBy(by)
        return df.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")
    if keep != "none":
        raise ValueError("keep must be first, last or none")
    # Two rows of a key are enough to know that it repeats.
    w = W.partitionBy(*keys).orderBy(order)
    return (
        df.withColumn("_r", F.row_number().over(w))
        .filter("_r <= 2")
        .withColumn("_c", F.count(F.lit(1)).over(W.partitionBy(*keys)))
        .filter("_c = 1")
        .drop("_r", "_c")
    )


def exclude_ids(df: DataFrame, *excluded: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows whose id is in none of the given id sets."""
    ids = None
    for e in excluded:
        one = e.select(F.col(e.columns[0]).alias(id_col))
        ids = one if ids is None else ids.union(one)
    return df if ids is None else df.join(ids.distinct(), id_col, "left_anti")


def catalog_dedupe(hits: DataFrame, order: str, id_col: str = "id") -> DataFrame:
    """One row per id: attributes of its first hit, its distinct queries in order of first match.

    (id, query) pairs are reduced before ids are grouped, so an id hit millions of
    times carries one entry per query.
    """
    attributes = [c for c in hits.columns if c not in (id_col, "matched_queries", order)]
    exploded = hits.select(
        id_col,
        F.col(order).alias("_o"),
        *([F.struct(*attributes).alias("_a")] if attributes else []),
        F.explode_outer("matched_queries").alias("_q"),
    )
    picks = [F.min("_o").alias("_o")]
    if attributes:
        picks.append(F.min_by("_a", "_o").alias("_a"))
    pairs = exploded.groupBy(id_col, "_q").agg(*picks)
    queries = F.array_sort(F.collect_list(F.when(F.col("_q").isNotNull(), F.struct("_o", "_q"))))
    merged = [queries.alias("_qs")]
    if attributes:
        merged.append(F.min_by("_a", "_o").alias("_a"))
    return (
        pairs.groupBy(id_col)
        .agg(*merged)
        .select(
            id_col,
            *([F.col("_a.*")] if attributes else []),
            F.transform("_qs", lambda s: s["_q"]).alias("matched_queries"),
            F.size("_qs").cast("long").alias("query_match_count"),
        )
        .orderBy(F.desc("query_match_count"), id_col)
    )


def multi_query_hits(catalog: DataFrame, at_least: int = 3) -> DataFrame:
    """How many candidates were matched by at least ``at_least`` queries."""
    return catalog.agg(
        F.count(F.lit(1)).alias("candidates"),
        F.count_if(F.col("query_match_count") >= at_least).alias("multi_query"),
    )


def catalog_merge(rows: DataFrame, order: Sequence[str], id_col: str = "id") -> DataFrame:
    """Catalogs of several files as one: first row per id in ``order``, queries united.

    The match count is recomputed only for ids that occur more than once; blank ids are skipped.
    """
    special = {id_col, "matched_queries", "query_match_count", *order}
    attributes = [c for c in rows.columns if c not in special]
    place = F.struct(*order)
    kept = rows.filter(F.coalesce(F.col(id_col).cast("string"), F.lit("")) != "")
    first = kept.groupBy(id_col).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min_by(F.struct(*attributes, "query_match_count"), place).alias("_a"),
    )
    queries = (
        kept.select(id_col, F.explode("matched_queries").alias("_q"))
        .distinct()
        .groupBy(id_col)
        .agg(F.array_sort(F.collect_list("_q")).alias("matched_queries"))
    )
    joined = first.join(queries, id_col, "left")
    found = F.coalesce("matched_queries", F.array().cast("array<string>"))
    return joined.select(
        id_col,
        *[F.col(f"_a.{c}") for c in attributes],
        found.alias("matched_queries"),
        F.when(F.col("_n") > 1, F.size(found).cast("long"))
        .otherwise(F.coalesce(F.col("_a.query_match_count").cast("long"), F.lit(0)))
        .alias("query_match_count"),
    ).orderBy(F.desc("query_match_count"), id_col)


def merge_final(
    rows: DataFrame, order: Sequence[str], id_col: str = "id", score_col: str = "llm_relevance_score"
) -> DataFrame:
    """Results of all waves, best score per id, sorted by score; an absent score counts as 0."""
    score = F.coalesce(F.col(score_col), F.lit(0))
    w = W.partitionBy(id_col).orderBy(score.desc(), *order)
    return (
        rows.withColumn("_r", F.row_number().over(w))
        .filter("_r = 1")
        .drop("_r")
        .orderBy(score.desc(), *order)
    )


def union_ids(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Distinct ids of both sets."""
    return existing.union(new).distinct()


def union_ids_counts(existing: DataFrame, new: DataFrame) -> DataFrame:
    """One row: known ids, ids added, ids in total; one aggregation over both sets."""
    id_col = existing.columns[0]
    both = existing.select(F.col(id_col).alias("id"), F.lit(True).alias("old")).union(
        new.select(F.col(new.columns[0]), F.lit(False))
    )
    return (
        both.groupBy("id")
        .agg(F.bool_or("old").alias("old"))
        .agg(
            F.count_if("old").alias("existing"),
            F.count_if(~F.col("old")).alias("added"),
            F.count(F.lit(1)).alias("total"),
        )
    )


def apply_corrections(
    labeled: DataFrame,
    queue: DataFrame,
    allowed: Sequence[str],
    *,
    position: str,
    text_col: str = "text",
    label_col: str = "label",
    flag_col: str = "flagged_for_review",
) -> DataFrame:
    """Take reviewed labels from the queue, matched by text, and clear the flag of changed rows.

    The last queue row of a text wins.  Labels outside ``allowed`` are ignored and
    a reviewed row whose label stays the same stays flagged.
    """
    reviewed = queue.groupBy(F.col(text_col).alias("_t")).agg(F.max_by(label_col, position).alias("_new"))
    joined = labeled.join(reviewed, labeled[text_col] == reviewed["_t"], "left")
    changed = F.coalesce(
        F.col("_new").isin(list(allowed)) & ~F.col("_new").eqNullSafe(F.col(label_col)), F.lit(False)
    )
    return (
        joined.withColumn("corrected", changed)
        .withColumns(
            {
                label_col: F.when(F.col("corrected"), F.col("_new")).otherwise(F.col(label_col)),
                flag_col: F.when(F.col("corrected"), F.lit(False)).otherwise(F.col(flag_col)),
            }
        )
        .drop("_t", "_new")
    )


def history_compare(a: DataFrame, b: DataFrame, names: tuple[str, str] = ("entropy", "random")) -> DataFrame:
    """Two learning histories side by side with the difference of F1."""
    keys = ["iteration", "n_labeled"]

    def side(h: DataFrame, name: str) -> DataFrame:
        return h.select(*keys, *[F.col(c).alias(f"{c}_{name}") for c in ("accuracy", "f1")])

    x, y = names
    return (
        side(a, x)
        .join(side(b, y), keys)
        .withColumn("f1_delta", F.round(F.col(f"f1_{x}") - F.col(f"f1_{y}"), 4))
    )


def apply_verdicts(
    candidates: DataFrame, verdicts: DataFrame | None, id_col: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """(survivors with summary, rejected ids).

    Candidates without a verdict are in neither; without any verdict table all pass.
    """
    if verdicts is None:
        none = candidates.select(id_col).limit(0)
        return candidates.withColumn("or_summary", F.lit(None).cast("string")), none
    judged = candidates.join(
        verdicts.select(id_col, F.coalesce("keep", F.lit(False)).alias("_keep"),
                        F.coalesce("summary", F.lit("")).alias("or_summary")),
        id_col,
    )
    return (
        judged.filter("_keep").drop("_keep"),
        judged.filter("not _keep").select(id_col).distinct(),
    )


def unjudged(candidates: DataFrame, verdicts: DataFrame, id_col: str = "id") -> DataFrame:
    """Candidates no verdict was returned for."""
    return candidates.join(verdicts.select(id_col), id_col, "left_anti")


def rerank(candidates: DataFrame, ranks: DataFrame | None, order: str, id_col: str = "id") -> DataFrame:
    """Attach rank, score and reason; unranked candidates go last with rank 999 and score 0."""
    if ranks is None:
        return candidates
    r = ranks.select(
        id_col,
        F.col("rank").cast("long").alias("or_rank"),
        F.coalesce("score", F.lit(0)).alias("or_score"),
        F.coalesce("one_line", F.lit("")).alias("or_one_line"),
    )
    return (
        candidates.join(r, id_col, "left")
        .withColumns(
            {"or_rank": F.coalesce("or_rank", F.lit(999)), "or_score": F.coalesce("or_score", F.lit(0))}
        )
        .orderBy("or_rank", order)
    )


def attach_answers(candidates: DataFrame, answers: DataFrame, order: str, id_col: str = "id") -> DataFrame:
    """Question/answer rows of each candidate as one text ``q → a | ...`` in ``order``."""
    line = F.concat(F.col("question"), F.lit(" → "), F.col("answer"))
    held = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("t"))))
    texts = answers.groupBy(id_col).agg(
        F.array_join(F.transform(held, lambda s: s["t"]), " | ").alias("qa_text")
    )
    return candidates.join(texts, id_col, "left").withColumn("qa_text", F.coalesce("qa_text", F.lit("")))


def final_selection(
    candidates: DataFrame, picks: DataFrame | None, order: str, id_col: str = "id"
) -> DataFrame:
    """Candidates that were picked, most relevant first; without picks the first three."""
    if picks is None:
        return candidates.orderBy(order).limit(3)
    p = picks.select(
        id_col,
        F.coalesce("rank", F.lit(0)).alias("llm_rank"),
        F.coalesce("reason", F.lit("")).alias("llm_reason"),
        F.coalesce("relevance_score", F.lit(0)).alias("llm_relevance_score"),
        F.coalesce("needs_verification", F.lit(False)).alias("needs_verification"),
    )
    return candidates.join(p, id_col).orderBy(F.desc("llm_relevance_score"), order)


def verification_gate(
    candidates: DataFrame, verdicts: DataFrame, id_col: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected ids): only an explicit false rejects; unknown and unchecked rows stay."""
    v = verdicts.select(id_col, F.struct("pass", "language", "num_classes", "reason").alias("verification"))
    unknown = F.struct(
        F.lit(None).cast("boolean").alias("pass"),
        F.lit("unknown").alias("language"),
        F.lit("unknown").alias("num_classes"),
        F.lit("Could not fetch samples").alias("reason"),
    )
    checked = candidates.join(v, id_col, "left").withColumn(
        "verification", F.coalesce("verification", unknown)
    )
    passed = F.coalesce(F.col("verification.pass"), F.lit(True))
    return checked.filter(passed), checked.filter(~passed).select(id_col).distinct()


def wave_needed(kept: DataFrame, min_pass: int = 2) -> DataFrame:
    """One row: how many candidates are left and whether another search wave is needed."""
    return kept.agg(
        F.count(F.lit(1)).alias("passed"),
        (F.count(F.lit(1)) < min_pass).alias("another_wave"),
    )
