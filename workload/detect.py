"""Detection of missing values, duplicates, outliers and imbalance; agreement and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tilth.operators import agree as G
from tilth.operators import detect as D
from tilth.operators import forest
from workload.base import (
    DOCS_SQL, LABELLED_SQL, ORDERS_GAPS_SQL, docs, labelled, orders_gaps, spread_table, table,
)

GAP_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "note"]
LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def detect_missing(spark, d):
    return D.detect_missing(orders_gaps(spark, d)).drop("dtype")


def _missing_sql():
    parts = " union all ".join(
        f"select '{c}' as \"column\", count(*) filter (where {c} is null) as missing, count(*) as n from t" for c in GAP_COLUMNS
    )
    return f"with t as ({ORDERS_GAPS_SQL}), m as ({parts})"


DETECT_MISSING_SQL = f"""{_missing_sql()}
select "column", missing, round(missing / n::double * 100, 2) as pct,
 case when missing / n::double > 0.5 then 'critical' when missing / n::double > 0.2 then 'high' when missing / n::double > 0.05 then 'medium' else 'low' end as severity
from m where missing > 0
"""


def missing_totals(spark, d):
    return D.missing_totals(orders_gaps(spark, d))


_any = " or ".join(f"{c} is null" for c in GAP_COLUMNS)
MISSING_TOTALS_SQL = f"""{_missing_sql()},
 s as (select max(n) as n, sum(missing)::bigint as cells, count(*) filter (where missing > 0) as cols from m),
 r as (select count(*) filter (where {_any}) as any_missing from t)
select n as total_rows, cast(6 as bigint) as total_cols, cells as missing_cells, round(cells / (n * 6.0::double) * 100, 3) as missing_pct,
 any_missing as rows_with_any_missing, round(any_missing / n::double * 100, 2) as rows_with_any_missing_pct,
 cast(0 as bigint) as rows_fully_missing, cols as columns_with_missing,
 case when cells / (n * 6.0::double) > 0.3 then 'critical' when cells / (n * 6.0::double) > 0.1 then 'high' when cells / (n * 6.0::double) > 0.02 then 'medium' else 'low' end as severity
from s, r
"""


def detect_missing_active(spark, d):
    return D.detect_missing_active(orders_gaps(spark, d))


MISSING_ACTIVE_SQL = f"""{_missing_sql()},
 a as (select * from m where missing < n)
select "column", missing, round(missing / n::double * 100, 2) as pct, (select round(avg(missing / n::double) * 100, 2) from a) as total_pct
from a where missing > 0
"""


def _duplicates(keep):
    def run(spark, d):
        return D.detect_duplicates(table(spark, d, "documents"), ["text"], keep)

    return run


def _duplicates_sql(keep):
    extra = "case when c > 1 then c else 0 end" if keep == "none" else "c - 1"
    return f"""
with g as (select count(*) as c from documents group by text),
 s as (select sum(c)::bigint as n, sum({extra})::bigint as dup from g)
select n as total_rows, dup as duplicate_rows, round(dup / n::double * 100, 2) as duplicate_pct, 'text' as subset_cols,
 case when round(dup / n::double * 100, 2) > 10 then 'high' when round(dup / n::double * 100, 2) > 1 then 'medium' else 'low' end as severity
from s
"""


def duplicate_rows(spark, d):
    t = table(spark, d, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_returnflag")
    return D.detect_duplicates(t)


DUPLICATE_ROWS_SQL = """
with g as (select count(*) as c from lineitem group by l_quantity, l_discount, l_tax, l_returnflag),
 s as (select sum(c)::bigint as n, sum(c - 1)::bigint as dup from g)
select n as total_rows, dup as duplicate_rows, round(dup / n::double * 100, 2) as duplicate_pct, 'all' as subset_cols,
 case when round(dup / n::double * 100, 2) > 10 then 'high' when round(dup / n::double * 100, 2) > 1 then 'medium' else 'low' end as severity
from s
"""


def duplicate_samples(spark, d):
    return D.duplicate_samples(table(spark, d, "documents"), ["text"], "doc_id").select("doc_id", "lang")


DUPLICATE_SAMPLES_SQL = """
select doc_id, lang from (select *, row_number() over (partition by text order by doc_id) as r from documents)
where r > 1 order by doc_id limit 5
"""


def _bounds_sql(source, columns, method, k):
    if method == "iqr":
        low = "quantile_cont({c}, 0.25) - {k} * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"
        high = "quantile_cont({c}, 0.75) + {k} * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"
    else:
        low, high = "avg({c}) - {k} * stddev_samp({c})", "avg({c}) + {k} * stddev_samp({c})"
    return " union all ".join(
        f"select '{c}' as \"column\", {low.format(c=c, k=k)} as lo, {high.format(c=c, k=k)} as hi from ({source})" for c in columns
    )


def _outliers_sql(source, columns, method, k):
    values = " union all ".join(f"select '{c}' as \"column\", {c}::double as x from ({source}) where {c} is not null" for c in columns)
    return f"""
with b as ({_bounds_sql(source, columns, method, k)}), v as ({values}),
 s as (select "column", any_value(lo) as lo, any_value(hi) as hi, count(*) filter (where x < lo or x > hi) as n, count(*) as total,
   min(x) as mn, max(x) as mx, avg(x) as mean from v join b using ("column") group by "column")
select "column", '{method}' as method, {k}::double as threshold, n as outlier_count, round(n / total::double * 100, 2) as outlier_pct,
 round(lo, 4) as lower_bound, round(hi, 4) as upper_bound, round(mn, 4) as min_value, round(mx, 4) as max_value, round(mean, 4) as mean,
 case when n / total::double > 0.1 then 'high' when n / total::double > 0.02 then 'medium' else 'low' end as severity
from s where n > 0
"""


def _outliers(method, name, columns):
    find = D.detect_outliers_iqr if method == "iqr" else D.detect_outliers_zscore

    def run(spark, d):
        return find(orders_gaps(spark, d) if name == "orders_gaps" else table(spark, d, name), columns)

    return run


def outlier_totals(spark, d):
    return D.outlier_totals(D.detect_outliers_zscore(table(spark, d, "events"), ["value", "user_id"]), 2)


# Every fiftieth row is far from all others in both columns, each in a place of its own. The places lie within one
# million of each other however many rows there are: with ids as places, the first rows would be close to all others
# next to the width of the whole, and no forest could tell them.
FAR = [
    "event_id", "event_id % 50 = 7 as far",
    "case when event_id % 50 = 7 then 1e6 + 1e6 * (event_id * 0.6180339887498949D % 1) else value end as value",
    "case when event_id % 50 = 7 then -1e6 - 1e6 * (event_id * 0.6180339887498949D % 1) else cast(user_id as double) end as user_id",
]


def _far(spark, d):
    return spread_table(spark, d, "events", "event_id").selectExpr(*FAR)


def _far_share(df):
    return df.agg(F.avg(F.col("far").cast("double"))).first()[0]


def isolation_forest(spark, d):
    """The most isolated rows, as many as were set apart: these and no others."""
    t = _far(spark, d)
    return forest.detect_outliers_isolation_forest(t, ["value", "user_id"], "event_id", _far_share(t)).select("id")


def isolation_report(spark, d):
    t = _far(spark, d)
    share = _far_share(t)
    flagged = forest.detect_outliers_isolation_forest(t, ["value", "user_id"], "event_id", share)
    return forest.isolation_report(t, flagged, share)


ISOLATION_REPORT_SQL = """
with f as (select event_id as id from events where event_id % 50 = 7), n as (select count(*)::double as n from events)
select 'isolation_forest' as method, count(*) / any_value(n) as contamination, count(*) as outlier_count, round(count(*) / any_value(n) * 100, 2) as outlier_pct,
 (select string_agg(id::varchar, ',' order by id) from (select id from f order by id limit 20)) as outlier_ids_sample from f, n
"""


def detect_imbalance(spark, d):
    return D.detect_imbalance(docs(spark, d), "label")


IMBALANCE_SQL = f"""
with t as ({DOCS_SQL}), c as (select label, count(*) as n from t where label is not null group by label),
 s as (select count(*) as total_rows, count(*) filter (where label is null) as missing_labels from t),
 m as (select count(*) as k, max(n) as mx, min(n) as mn from c)
select total_rows, k as num_classes, (select label from c order by n desc, label limit 1) as majority_class, mx as majority_count,
 round(mx / total_rows::double * 100, 2) as majority_pct, (select label from c order by n, label limit 1) as minority_class,
 mn as minority_count, round(mn / total_rows::double * 100, 2) as minority_pct, round(mx / mn::double, 2) as imbalance_ratio,
 case when round(mx / mn::double, 2) > 20 then 'critical' when round(mx / mn::double, 2) > 10 then 'high' when round(mx / mn::double, 2) > 3 then 'medium' else 'low' end as severity,
 missing_labels
from s, m
"""


def class_distribution(spark, d):
    return D.class_distribution(docs(spark, d), "label")


def imbalance(spark, d):
    return D.imbalance(table(spark, d, "conversations"), "role")


def quality_report(spark, d):
    t = labelled(spark, d).selectExpr(
        "text", "case when doc_id % 9 = 0 then null else lang end as lang", "confidence * confidence * confidence as score",
        "label", "cast(null as string) as audio",
    )
    return D.quality_report(t, "label")


QUALITY_REPORT_SQL = f"""
with t as (select text, case when doc_id % 9 = 0 then null else lang end as lang, confidence * confidence * confidence as score, label,
   cast(null as string) as audio from ({LABELLED_SQL})),
 n as (select count(*) as n from t),
 m as (select 'text' as c, count(*) filter (where text is null) as k from t union all select 'lang', count(*) filter (where lang is null) from t
   union all select 'score', count(*) filter (where score is null) from t union all select 'label', count(*) filter (where label is null) from t),
 b as (select quantile_cont(score, 0.25) as q1, quantile_cont(score, 0.75) as q3 from t),
 o as (select count(*) filter (where score < q1 - 1.5 * (q3 - q1) or score > q3 + 1.5 * (q3 - q1)) as k from t, b),
 g as (select sum(c - 1)::bigint as k from (select count(*) as c from t group by text, lang, score, label)),
 l as (select max(c) / min(c)::double as ratio, count(*) as k from (select count(*) as c from t where label is not null group by label)),
 f as (select round(avg(k / n.n::double) * 100, 2) as miss, sum(k)::bigint as cells from m, n)
select 'missing' as issue, c as "column", k as count, round(k / n.n::double * 100, 2) as pct, null as severity from m, n where k > 0
union all select 'skipped_empty', 'audio', n.n, null, null from n
union all select 'missing_total', null, cells, miss, null from f
union all select 'duplicates', null, k, round(k / n.n::double * 100, 2), null from g, n
union all select 'outliers', 'score', k, round(k / n.n::double * 100, 2), null from o, n where k > 0
union all select 'imbalance', 'label', k, round(ratio, 2), null from l
union all select 'overall', null, null, null,
 case when miss > 40 or round(g.k / n.n::double * 100, 2) > 15 or round(ratio, 2) > 10 then 'critical'
  when miss > 20 or round(g.k / n.n::double * 100, 2) > 5 or round(ratio, 2) > 5 then 'high'
  when miss > 5 or round(g.k / n.n::double * 100, 2) > 1 or round(ratio, 2) > 3 then 'medium' else 'low' end
from f, g, l, n
"""


def zero_inflated(spark, d):
    t = table(spark, d, "lineitem").selectExpr(
        "l_discount", "case when l_partkey % 10 > 0 then 0 else l_tax end as rare", "l_quantity"
    )
    return D.zero_inflated(t)


ZERO_SQL = """
with z as (select avg((case when l_partkey % 10 > 0 then 0 else l_tax end = 0)::int) as r, avg((l_discount = 0)::int) as a, avg((l_quantity = 0)::int) as b from lineitem)
select * from (select 'rare' as "column", round(r, 4) as zero_share from z union all select 'l_discount', round(a, 4) from z union all select 'l_quantity', round(b, 4) from z)
where zero_share > 0.8
"""


def label_quality(spark, d):
    return G.label_quality(labelled(spark, d), "human_label")


KAPPA_CTE = f"""
with t as ({LABELLED_SQL}),
 p as (select label as a, human_label as b, count(*) as n from t where label is not null and human_label is not null group by 1, 2),
 m as (select sum(n)::bigint as n, sum(case when a = b then n else 0 end)::double as agreed from p),
 e as (select sum(x.n::double * y.n) as c from (select a as l, sum(n) as n from p group by a) x join (select b as l, sum(n) as n from p group by b) y using (l)),
 k as (select m.n as pairs, round((agreed / m.n - c / (m.n::double * m.n)) / (1 - c / (m.n::double * m.n)), 4) as kappa from m, e)
"""
LABEL_QUALITY_SQL = f"""{KAPPA_CTE}
select count(label) as labelled, round(avg(confidence), 4) as confidence_mean, round(stddev_samp(confidence), 4) as confidence_std,
 round(min(confidence), 4) as confidence_min, round(avg(flagged_for_review::int) * 100, 2) as flagged_pct,
 count(*) filter (where flagged_for_review) as flagged_count, (select kappa from k) as kappa from t
"""


def cohen_kappa(spark, d):
    return G.cohen_kappa(labelled(spark, d), "human_label", "label")


def confusion_matrix(spark, d):
    return G.confusion_matrix(table(spark, d, "labels"), "quality", "toxic", [0, 1])


def evaluate(spark, d):
    known = table(spark, d, "labels").selectExpr("cast(quality as string) as label").distinct()
    return G.evaluate(labelled(spark, d), "label", "human_label", known)


EVALUATE_SQL = f"""
with t as ({LABELLED_SQL}),
 l as (select distinct label as x from t union select distinct human_label from t),
 s as (select x, count(*) filter (where label = x) as support, count(*) filter (where human_label = x) as predicted,
   count(*) filter (where label = x and human_label = x) as hits from t, l group by x)
select sum(support)::bigint as rows, round(sum(hits) / sum(support)::double, 4) as accuracy,
 round(sum(support * 2.0::double * hits / (support + predicted)) / sum(support)::double, 4) as f1 from s
"""


def value_counts(spark, d):
    return G.value_counts(docs(spark, d), "label", normalize=True)


def review_order(spark, d):
    return G.review_order(labelled(spark, d), "doc_id").select("doc_id", "confidence")


def class_examples(spark, d):
    t = docs(spark, d)
    return G.class_examples(t, "doc_id").withColumn("rank", F.col("rank").cast("long"))


CASES = {
    "detect_missing": (detect_missing, DETECT_MISSING_SQL),
    "missing_totals": (missing_totals, MISSING_TOTALS_SQL),
    "detect_missing_active": (detect_missing_active, MISSING_ACTIVE_SQL),
    "detect_duplicates": (_duplicates("first"), _duplicates_sql("first")),
    "detect_duplicates_all_members": (_duplicates("none"), _duplicates_sql("none")),
    "detect_duplicate_rows": (duplicate_rows, DUPLICATE_ROWS_SQL),
    "duplicate_samples": (duplicate_samples, DUPLICATE_SAMPLES_SQL),
    "detect_outliers_iqr": (
        _outliers("iqr", "events", ["value", "user_id"]),
        _outliers_sql("select * from events", ["value", "user_id"], "iqr", 1.5),
    ),
    "detect_outliers_iqr_lineitem": (
        _outliers("iqr", "lineitem", LINE_COLUMNS), _outliers_sql("select * from lineitem", LINE_COLUMNS, "iqr", 1.5),
    ),
    "detect_outliers_zscore": (
        _outliers("zscore", "events", ["value", "user_id"]),
        _outliers_sql("select * from events", ["value", "user_id"], "zscore", 3.0),
    ),
    "outlier_totals": (
        outlier_totals,
        f"""select cast(2 as bigint) as columns_checked, count(*) as columns_with_outliers, coalesce(sum(outlier_count), 0)::bigint as total_outlier_instances
        from ({_outliers_sql("select * from events", ["value", "user_id"], "zscore", 3.0)})""",
    ),
    "isolation_forest": (isolation_forest, "select event_id as id from events where event_id % 50 = 7"),
    "isolation_forest_report": (isolation_report, ISOLATION_REPORT_SQL),
    "detect_imbalance": (detect_imbalance, IMBALANCE_SQL),
    "class_distribution": (
        class_distribution,
        f"""select label, count(*) as count, round(count(*) / (select count(*) from documents)::double * 100, 2) as pct
        from ({DOCS_SQL}) where label is not null group by label order by 2 desc limit 50""",
    ),
    "imbalance": (
        imbalance,
        "select round(max(c) / min(c)::double, 2) as ratio, count(*) as num_classes from (select count(*) as c from conversations group by role)",
    ),
    "quality_report": (quality_report, QUALITY_REPORT_SQL),
    "zero_inflated": (zero_inflated, ZERO_SQL),
    "label_quality": (label_quality, LABEL_QUALITY_SQL),
    "cohen_kappa": (cohen_kappa, f"{KAPPA_CTE} select pairs, kappa from k"),
    "confusion_matrix": (
        confusion_matrix,
        """select quality as true_label, count(*) filter (where toxic = 0) as pred_0, count(*) filter (where toxic = 1) as pred_1
        from labels group by quality""",
    ),
    "evaluate": (evaluate, EVALUATE_SQL),
    "value_counts": (
        value_counts,
        f"""select label as value, count(*) as count, round(count(*) / (select count(label) from ({DOCS_SQL}))::double, 4) as share
        from ({DOCS_SQL}) where label is not null group by label""",
    ),
    "review_order": (
        review_order,
        f"select doc_id, confidence from ({LABELLED_SQL}) where flagged_for_review order by confidence, doc_id limit 15",
    ),
    "class_examples": (
        class_examples,
        f"""select label, r as rank, substr(text, 1, 120) as example from
        (select *, row_number() over (partition by label order by doc_id) as r from ({DOCS_SQL}) where label is not null) where r <= 5""",
    ),
}
