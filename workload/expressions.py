"""Scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tilth.functions import scalars as S
from tilth.operators.agree import label_quality, quality_red_flags, value_counts
from tilth.operators.label import flag_low_confidence
from tilth.sources.collect import catalog_from_listing
from workload.base import LABELLED_SQL, labelled, table
from workload.collect import LISTING_SQL, listing_rows


def tokenize(spark, d):
    tokens = S.tokenize("text")
    return table(spark, d, "documents").select(
        "doc_id", F.size(tokens).cast("long").alias("tokens"),
        F.size(F.array_distinct(tokens)).cast("long").alias("distinct_tokens"),
    )


def words(spark, d):
    return table(spark, d, "documents").select("doc_id", F.array_join(S.words("text"), " ").alias("words"))


STOPS = ", ".join(f"'{w}'" for w in S.STOP_WORDS)
WORDS_SQL = f"""
select doc_id, array_to_string(list_filter(
    list_transform(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+'), lambda w: lower(w)),
    lambda w: regexp_full_match(w, '[a-z]+') and w not in ({STOPS})), ' ') as words
from documents
"""


def text_stats(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", S.text_length("text").cast("long").alias("chars"), S.word_count("text").cast("long").alias("words"),
    )


def compact_record(spark, d):
    catalog = catalog_from_listing(listing_rows(spark, d))
    return catalog.select(S.compact_record().alias("line"))


COMPACT_SQL = f"""
select 'ID: ' || id || ' | DL: ' || downloads || ' | License: ' || license || ' | Size: ' ||
  case when sizes = '' then '?' else sizes end || ' | Tags: ' || replace(tags, ',', ', ') || ' | Desc: ' || description as line
from ({LISTING_SQL})
"""


def parse_model_json(spark, d):
    n = F.col("doc_id")
    body = F.concat(F.lit('{"id":'), n, F.lit(',"lang":"'), F.col("lang"), F.lit('"}'))
    reply = (
        F.when(n % 5 == 0, body)
        .when(n % 5 == 1, F.concat(F.lit("Sure:\n```json\n"), body, F.lit("\n```\nDone.")))
        .when(n % 5 == 2, F.concat(F.lit("<think>{\"id\":0}</think>\n"), body))
        .when(n % 5 == 3, F.concat(F.lit("```\n"), body, F.lit("\n```")))
        .otherwise(F.concat(F.lit("sorry "), body))
    )
    parsed = table(spark, d, "documents").select("doc_id", S.parse_model_json(reply).alias("v"))
    return parsed.select(
        "doc_id",
        F.try_variant_get("v", "$.id", "bigint").alias("id"),
        F.try_variant_get("v", "$.lang", "string").alias("lang"),
        F.col("v").isNull().alias("parse_error"),
    )


def flagged(spark, d):
    t = labelled(spark, d).withColumn("text", F.expr(r"case when doc_id % 8 = 0 then '\t \n' when doc_id % 8 = 1 then null else text end"))
    out = flag_low_confidence(t.drop("flagged_for_review"))
    return out.select("doc_id", "label", "confidence", "flagged_for_review")


FLAGGED_SQL = f"""
select doc_id, case when doc_id % 8 < 2 then null else label end as label,
  case when doc_id % 8 < 2 then 0.0::double else confidence end as confidence,
  case when doc_id % 8 < 2 then true else confidence < 0.75 end as flagged_for_review
from ({LABELLED_SQL})
"""


def severity_ladders(spark, d):
    v = F.col("value")
    return table(spark, d, "events").select(
        "event_id",
        S.severity(v / 100, S.MISSING_TABLE).alias("missing_table"),
        S.severity(v / 100, S.MISSING_COLUMN).alias("missing_column"),
        S.severity(v, S.DUPLICATE_PCT).alias("duplicates"),
        S.severity(v, S.IMBALANCE_RATIO).alias("imbalance"),
        S.severity(v / 100, S.OUTLIER_SHARE).alias("outliers"),
        S.overall_severity(v, v / 4, v / 8).alias("overall"),
    )


SEVERITY_SQL = """
select event_id,
  case when value / 100 > 0.3 then 'critical' when value / 100 > 0.1 then 'high' when value / 100 > 0.02 then 'medium' else 'low' end as missing_table,
  case when value / 100 > 0.5 then 'critical' when value / 100 > 0.2 then 'high' when value / 100 > 0.05 then 'medium' else 'low' end as missing_column,
  case when value > 10 then 'high' when value > 1 then 'medium' else 'low' end as duplicates,
  case when value > 20 then 'critical' when value > 10 then 'high' when value > 3 then 'medium' else 'low' end as imbalance,
  case when value / 100 > 0.1 then 'high' when value / 100 > 0.02 then 'medium' else 'low' end as outliers,
  case when value > 40 or value / 4 > 15 or value / 8 > 10 then 'critical'
       when value > 20 or value / 4 > 5 or value / 8 > 5 then 'high'
       when value > 5 or value / 4 > 1 or value / 8 > 3 then 'medium' else 'low' end as overall
from events
"""


def red_flags(spark, d):
    t = labelled(spark, d)
    return quality_red_flags(label_quality(t, "human_label"), value_counts(t, "label", normalize=True))


RED_FLAGS_SQL = f"""
with t as ({LABELLED_SQL}),
 p as (select label as a, human_label as b, count(*) as n from t group by 1, 2),
 m as (select sum(n) as n, sum(case when a = b then n else 0 end)::double as agreed from p),
 e as (select sum(x.n::double * y.n) as c from (select a as l, sum(n) as n from p group by a) x join (select b as l, sum(n) as n from p group by b) y using (l)),
 k as (select round((agreed / n - c / (n::double * n)) / (1 - c / (n::double * n)), 4) as kappa from m, e),
 q as (select count(label) as labelled, round(avg(confidence), 4) as confidence_mean, round(stddev_samp(confidence), 4) as confidence_std,
   round(min(confidence), 4) as confidence_min, round(avg(flagged_for_review::int) * 100, 2) as flagged_pct,
   count(*) filter (where flagged_for_review) as flagged_count from t),
 s as (select max(c) / sum(c)::double as top from (select label, count(*) as c from t group by label))
select q.*, kappa,
 case when kappa < 0.2 then 'slight' when kappa < 0.4 then 'fair' when kappa < 0.6 then 'moderate' when kappa < 0.8 then 'substantial' else 'almost perfect' end as kappa_band,
 confidence_mean < 0.65 as low_confidence, flagged_pct > 50 as many_flagged, top > 0.8 as dominant_class, kappa < 0.4 as low_agreement
from q, k, s
"""


def size_units(spark, d):
    b = F.when(F.col("doc_id") % 10 == 0, F.lit(0).cast("long")).otherwise(F.col("n_chars") * 977)
    return table(spark, d, "documents").select("doc_id", S.size_mb(b).alias("size_mb"), S.size_kb(b).alias("size_kb"))


def partial_rows(spark, d):
    state = F.expr("case doc_id % 3 when 0 then 'exact' when 1 then 'partial' else 'unreliable' end")
    return table(spark, d, "documents").select("doc_id", S.partial_rows_label(F.col("n_chars"), state).alias("rows"))


CASES = {
    "tokenize": (
        tokenize,
        """select doc_id, len(regexp_extract_all(lower(text), '[a-z0-9]+')) as tokens,
        len(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+'))) as distinct_tokens from documents""",
    ),
    "words": (words, WORDS_SQL),
    "text_stats": (
        text_stats,
        "select doc_id, cast(length(text) as bigint) as chars, len(regexp_extract_all(text, '\\S+')) as words from documents",
    ),
    "compact_record": (compact_record, COMPACT_SQL),
    "parse_model_json": (
        parse_model_json,
        """select doc_id, case when doc_id % 5 < 4 then doc_id end as id, case when doc_id % 5 < 4 then lang end as lang,
        doc_id % 5 = 4 as parse_error from documents""",
    ),
    "flag_low_confidence": (flagged, FLAGGED_SQL),
    "severity_ladders": (severity_ladders, SEVERITY_SQL),
    "quality_red_flags": (red_flags, RED_FLAGS_SQL),
    "size_units": (
        size_units,
        """with t as (select doc_id, case when doc_id % 10 = 0 then null else n_chars * 977 end as b from documents)
        select doc_id, round(b / 1048576.0::double, 2) as size_mb, round(b / 1024.0::double, 1) as size_kb from t""",
    ),
    "partial_rows_label": (
        partial_rows,
        """select doc_id, case doc_id % 3 when 0 then cast(n_chars as string) when 1 then '~' || n_chars || ' (partial)'
        else '? (unreliable)' end as rows from documents""",
    ),
}
