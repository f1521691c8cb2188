"""Machine labels, text classification and active learning."""

from __future__ import annotations

from pyspark.sql import functions as F

from tilth.functions.store import new_path, spread
from tilth.operators import label as L
from tilth.operators import learn as M
from tilth.operators.agree import evaluate, value_counts
from tilth.operators.sampling import seed_and_pool, stratified_split
from tilth.plans import stages
from workload.base import LABELLED, LABELLED_SQL, STAMP, docs, md5_sql, spread_table, table
from workload.combine import APPLY_CORRECTIONS_SQL, history_rows, history_sql
from workload.fix import LENGTH_CTE, outliers_sql

CLASSES = [str(i) for i in range(10)]


def auto_label(spark, d):
    """Label every embedding with its nearest class centroid."""
    e = table(spark, d, "embeddings").selectExpr(
        "vec_id", "embedding", "cast(label as string) as label", "case when vec_id % 10 = 0 then ' ' else 'x' end as text"
    )
    scorer = L.centroid_scorer(L.centroids(e, "embedding", "label"), CLASSES)
    out = L.auto_label(e, CLASSES, scorer, input_col="embedding", threshold=0.105, batch=256, labeled_at=STAMP)
    return out.select("vec_id", "label", "human_label", F.round("confidence", 4).alias("confidence"), "flagged_for_review")


AUTO_LABEL_SQL = """
with e as (select vec_id, label, embedding::double[] as v from embeddings),
 x as (select label, i, avg(v[i]) as m from e, range(1, 65) r(i) group by label, i),
 c as (select label, list(m order by i) as m from x group by label),
 p as (select vec_id, e.label as human, c.label as cand, list_distance(v, m) as dist from e, c),
 s as (select *, exp(-dist) / sum(exp(-dist)) over (partition by vec_id) as score from p),
 b as (select *, row_number() over (partition by vec_id order by dist, cand) as r from s)
select vec_id, case when vec_id % 10 > 0 then cast(cand as string) end as label, cast(human as string) as human_label,
 case when vec_id % 10 > 0 then round(score, 4) else 0.0::double end as confidence,
 case when vec_id % 10 > 0 then round(score, 4) < 0.105 else true end as flagged_for_review
from b where r = 1
"""


def _labelled(spark, d):
    """Labelled documents, spread before tokenising."""
    docs = spread_table(spark, d, "documents", "doc_id")
    return docs.join(table(spark, d, "labels"), "doc_id").selectExpr(*LABELLED)


# Planted classes: words of one of three classes behind every whole text, so that the right answer is known.
PLANTED_CLASS = "case doc_id % 3 when 0 then 'red' when 1 then 'green' else 'blue' end"
MARKS, REPEATS = 300, 3


def _marked(df):
    marks = F.expr(f"array_join(transform(sequence(1, {MARKS}), i -> concat(label, 'mark', i)), ' ')")
    return df.withColumn("label", F.expr(PLANTED_CLASS)).withColumn("text", F.concat_ws(" ", "text", F.repeat(F.concat(marks, F.lit(" ")), REPEATS)))


def _planted(spark, d):
    """Labelled documents with the words of their planted class."""
    docs = spread_table(spark, d, "documents", "doc_id")
    return _marked(docs.join(table(spark, d, "labels").select("doc_id"), "doc_id").select("doc_id", "text"))


PLANTED_SQL = f"select doc_id, {PLANTED_CLASS} as label from documents join labels using (doc_id)"


def _model(spark, d, model="logreg"):
    return M.fit_text_classifier(_planted(spark, d), model=model)


def _predictions(model):
    def run(spark, d):
        fitted = _model(spark, d, model)
        return fitted.transform(_planted(spark, d)).select("doc_id", "label", "predicted", (F.array_max("probability") > 0.5).alias("sure"))

    return run


PREDICTIONS_SQL = f"select doc_id, label, label as predicted, true as sure from ({PLANTED_SQL})"


def score_new(spark, d):
    """Train, save, load, and label every document."""
    path = new_path(spark, "model")
    _model(spark, d).save(path)
    every = _marked(spread(docs(spark, d).drop("label"), "doc_id")).drop("label")
    return M.score_new(M.TextClassifier.load(path), every).select("doc_id", "label", (F.col("confidence") > 0.5).alias("sure"))


def class_shares(spark, d):
    """Label shares of predictions: one row per predicted class."""
    return value_counts(_predictions("logreg")(spark, d), "predicted", normalize=True)


def _crossed(spark, d):
    """Two words by two bits of the id; the label is their exclusive-or, which no linear machine separates."""
    a, b = F.col("doc_id") % 2, F.floor(F.col("doc_id") / 2) % 2
    words = F.concat_ws(" filler ", F.when(a == 0, "north").otherwise("south"), F.when(b == 0, "east").otherwise("west"))
    return table(spark, d, "documents").select("doc_id", words.alias("text"), F.when(a == b, "same").otherwise("other").alias("label"))


def svm_crossed(spark, d):
    """A kernel machine tells the exclusive-or of two words; its probabilities come from rows it was not fitted on."""
    t = _crossed(spark, d)
    return M.fit_text_classifier(t, model="svm").transform(t).select("doc_id", "predicted", (F.array_max("probability") > 0.8).alias("sure"))


SVM_CROSSED_SQL = "select doc_id, case when doc_id % 2 = doc_id // 2 % 2 then 'same' else 'other' end as predicted, true as sure from documents"


def _probabilities(spark, d):
    """Three-class probabilities derived from event values."""
    a, b = F.col("value") / (F.col("value") + 20), F.col("user_id") / (F.col("user_id") + 60.0)
    p = F.array(a * b, a * (1 - b), 1 - a)
    return table(spark, d, "events").select("event_id", p.alias("probability"))


PROBABILITY_CTE = """
x as (select event_id, value / (value + 20) as a, user_id / (user_id + 60.0::double) as b from events),
p as (select event_id, a * b as p1, a * (1 - b) as p2, 1 - a as p3 from x),
s as (select event_id, -(p1 * ln(p1 + 1e-10::double) + p2 * ln(p2 + 1e-10::double) + p3 * ln(p3 + 1e-10::double)) as entropy,
  list_sort([p1, p2, p3], 'desc') as o from p),
u as (select event_id, entropy, -(o[1] - o[2]) as margin from s)
"""


def uncertainty(spark, d):
    return _probabilities(spark, d).select(
        "event_id", F.round(M.entropy_score("probability"), 4).alias("entropy"), F.round(M.margin_score("probability"), 4).alias("margin")
    )


def _query(strategy):
    def run(spark, d):
        return M.query(_probabilities(spark, d), strategy, 50, "event_id").select("event_id")

    return run


def evaluate_model(spark, d):
    split = stratified_split(_planted(spark, d), "label", "doc_id")
    fitted = M.fit_text_classifier(split.filter("split = 'train'"))
    return evaluate(fitted.transform(split.filter("split = 'test'")), "label", "predicted")


TEST_SQL = f"select sum(round(n * 0.2::double))::bigint as rows from (select label, count(*) as n from ({PLANTED_SQL}) group by label)"


def _seeded(spark, d):
    split = stratified_split(_planted(spark, d), "label", "doc_id")
    train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    seed, pool = seed_and_pool(train, "doc_id", 60, 20)
    return seed, pool, test


def run_cycle(spark, d):
    seed, pool, test = _seeded(spark, d)
    history, _ = M.run_cycle(seed, pool, "doc_id", strategy="margin", test=test)
    return history


# Planted classes are told without a fault from the first round on; a round adds 20 rows while there are any.
CYCLE_SQL = f"""
train as (select (select count(*) from ({PLANTED_SQL})) - rows as n from ({TEST_SQL})),
seed as (select greatest(least(60, n - 20), 0) as s, n from train),
rounds as (select i as iteration, least(s + 20 * i, n) as n_labeled from seed, range(0, 6) r(i) where s + 20 * (i - 1) < n)
"""
RUN_CYCLE_SQL = f"with {CYCLE_SQL} select iteration::int as iteration, n_labeled, 1.0::double as accuracy, 1.0::double as f1, 'margin' as strategy from rounds"


def compare_strategies(spark, d):
    seed, pool, test = _seeded(spark, d)
    side_by_side, _ = M.compare_strategies(seed, pool, "doc_id", test=test)
    return side_by_side


def savings(spark, d):
    return M.savings(history_rows(spark, d, 0), history_rows(spark, d, 1))


SAVINGS_SQL = f"""
with h as ({history_sql(0)}), b as ({history_sql(1)}),
 f as (select f1 as q, n_labeled as n from b order by iteration desc limit 1),
 r as (select arg_min(n_labeled, iteration) as k from h, f where f1 >= q)
select 'f1' as target_metric, q as random_final_quality, n as random_final_n_labeled, k as entropy_reached_same_quality_at_n,
 n - k as labels_saved, round((n - k) / n::double * 100, 1) as savings_pct from f, r
"""


def learning_curve(spark, d):
    return M.learning_curve(history_rows(spark, d, 0), history_rows(spark, d, 1))


def stage_flow(spark, d):
    """Collect, clean, export: rows and classes after each stage."""
    unified = table(spark, d, "documents").selectExpr("doc_id", "text", "lang as label", "source")
    collected = stages.collect_stage(unified, "doc_id", {}, ["en", "fr", "de", "es"], cap=40)
    cleaned, _, comparison = stages.quality_stage(collected, "doc_id")
    return comparison


_ROWS = "doc_id, text, label, source"
STAGE_FLOW_SQL = f"""
with d as (select doc_id, text, lang as label, source from documents where lang in ('en', 'fr', 'de', 'es') and text is not null and lang is not null),
t as (select *, count(*) over (partition by source) as total, count(*) over (partition by source, label) as size,
   row_number() over (partition by source, label order by {md5_sql(42, "doc_id")}, doc_id) as r from d),
h as (select *, row_number() over (partition by source order by {md5_sql("42-cut", "doc_id")}, doc_id) as n from t
   where total <= 40 or r <= greatest(1, round_even(size / total::double * 40, 0)::bigint)),
b as (select {_ROWS} from h where total <= 40 or n <= 40),
u as (select {_ROWS} from (select *, row_number() over (partition by text order by doc_id) as r from b) where r = 1),
{LENGTH_CTE.format(t="u")},
s as (select min(n) as n from (select count(*) as n from k group by label)),
c as (select {_ROWS} from (select *, row_number() over (partition by label order by {md5_sql(42, "doc_id")}, doc_id) as r from k) where r <= (select n from s)),
m as (select 'rows' as metric, (select count(*) from b) as b, (select count(*) from c) as a
 union all select 'missing_values', 0, 0 union all select 'duplicates', 0, 0
 union all select 'outliers_doc_id', {outliers_sql("b", "doc_id")}, {outliers_sql("c", "doc_id")})
select metric, b as before, a as after, printf('%+d', a - b) as change,
 case when metric in ('rows', 'outliers_doc_id') and b <> 0 then printf('%+.1f%%', (a - b) / b::double * 100) else '' end as change_pct from m
"""


def review_quality(spark, d):
    """Corrections from the review queue, then agreement of the result with the labels of people."""
    queue = table(spark, d, "documents").selectExpr(
        "doc_id as position", "text", "case doc_id % 3 when 0 then '1' when 1 then '0' else 'unsure' end as label"
    )
    return stages.review_stage(_labelled(spark, d), queue, ["0", "1"], position="position")[1]


REVIEW_QUALITY_SQL = f"""
with c as ({APPLY_CORRECTIONS_SQL}),
 t as (select c.doc_id, c.label, human_label, confidence, c.flagged_for_review from c join ({LABELLED_SQL}) using (doc_id)),
 p as (select label as a, human_label as b, count(*) as n from t group by 1, 2),
 m as (select sum(n)::double as n, sum(case when a = b then n else 0 end)::double as agreed from p),
 e as (select sum(x.n::double * y.n) as c from (select a as l, sum(n) as n from p group by a) x join (select b as l, sum(n) as n from p group by b) y using (l))
select count(label) as labelled, round(avg(confidence), 4) as confidence_mean, round(stddev_samp(confidence), 4) as confidence_std,
 round(min(confidence), 4) as confidence_min, round(avg(flagged_for_review::int) * 100, 2) as flagged_pct,
 count(*) filter (where flagged_for_review) as flagged_count,
 (select round((agreed / n - c / (n * n)) / (1 - c / (n * n)), 4) from m, e) as kappa from t
"""


CASES = {
    "review_quality": (review_quality, REVIEW_QUALITY_SQL),
    "auto_label": (auto_label, AUTO_LABEL_SQL),
    "fit_text_classifier": (_predictions("logreg"), PREDICTIONS_SQL),
    "fit_text_classifier_svm": (_predictions("svm"), PREDICTIONS_SQL),
    "svm_crossed": (svm_crossed, SVM_CROSSED_SQL),
    "predicted_shares": (
        class_shares,
        f"select label as value, count(*) as count, round(count(*)::double / sum(count(*)) over (), 4) as share from ({PLANTED_SQL}) group by label",
    ),
    "score_new": (score_new, f"select doc_id, {PLANTED_CLASS} as label, true as sure from documents"),
    "uncertainty_scores": (
        uncertainty, f"with {PROBABILITY_CTE} select event_id, round(entropy, 4) as entropy, round(margin, 4) as margin from u",
    ),
    "query_entropy": (_query("entropy"), f"with {PROBABILITY_CTE} select event_id from u order by entropy desc, event_id limit 50"),
    "query_margin": (_query("margin"), f"with {PROBABILITY_CTE} select event_id from u order by margin desc, event_id limit 50"),
    "query_random": (_query("random"), "select event_id from events order by md5('42|' || event_id), event_id limit 50"),
    "evaluate_model": (evaluate_model, f"select rows, 1.0::double as accuracy, 1.0::double as f1 from ({TEST_SQL})"),
    "run_cycle": (run_cycle, RUN_CYCLE_SQL),
    "compare_strategies": (
        compare_strategies,
        f"with {CYCLE_SQL} select iteration::int as iteration, n_labeled, 1.0::double as accuracy_entropy, 1.0::double as f1_entropy, 1.0::double as accuracy_random, 1.0::double as f1_random, 0.0::double as f1_delta from rounds",
    ),
    "savings": (savings, SAVINGS_SQL),
    "learning_curve": (
        learning_curve,
        f"select strategy, iteration, n_labeled, accuracy, f1 from ({history_sql(0)} union all {history_sql(1)})",
    ),
    "collect_and_clean": (stage_flow, STAGE_FLOW_SQL),
}
