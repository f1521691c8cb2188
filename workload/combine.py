"""Deduplication, catalogs, and joins with verdicts and corrections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tilth.operators import combine as C
from workload.base import (
    HITS_SQL, LABELLED_SQL, RANKS_SQL, VERDICTS_SQL, candidates, hits, labelled, ranks, table, verdicts,
)


def _dedupe(keep):
    def run(spark, d):
        return C.dedupe(table(spark, d, "documents"), "doc_id", ["text"], keep).select("doc_id", "lang")

    return run


def dedupe_rows(spark, d):
    t = table(spark, d, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber as id", "l_quantity", "l_discount", "l_returnflag",
        "case when l_suppkey % 3 = 0 then null else l_tax end as l_tax",
    )
    return C.dedupe(t, "id")


DEDUPE_ROWS_SQL = """
with t as (select l_orderkey * 10 + l_linenumber as id, l_quantity, l_discount, l_returnflag,
  case when l_suppkey % 3 = 0 then null else l_tax end as l_tax from lineitem)
select min(id) as id, l_quantity, l_discount, l_returnflag, l_tax from t group by all
"""


def _dedupe_sql(keep):
    if keep == "none":
        return """select doc_id, lang from (select *, count(*) over (partition by text) as c from documents) where c = 1"""
    order = "doc_id" if keep == "first" else "doc_id desc"
    return f"""select doc_id, lang from (select *, row_number() over (partition by text order by {order}) as r from documents) where r = 1"""


def exclude_ids(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    seen = labels.filter("quality = 0").select("doc_id")
    rejected = labels.filter("toxic = 1").select("doc_id")
    return C.exclude_ids(docs, seen, rejected, id_col="doc_id").select("doc_id", "lang")


def _hit_rows(spark, d):
    h = hits(spark, d)
    return h.select("id", "pos", "score", F.array("query").alias("matched_queries"))


def catalog_dedupe(spark, d):
    out = C.catalog_dedupe(_hit_rows(spark, d), "pos")
    return out.select("id", "score", F.array_join("matched_queries", ",").alias("queries"), "query_match_count")


CATALOG_DEDUPE_SQL = f"""
with h as ({HITS_SQL}), q as (select id, query, min(pos) as pos from h group by id, query)
select id, (select arg_min(score, pos) from h where h.id = q.id) as score,
  string_agg(query, ',' order by pos) as queries, count(*) as query_match_count
from q group by id
"""


def multi_query_hits(spark, d):
    return C.multi_query_hits(C.catalog_dedupe(_hit_rows(spark, d), "pos"), 3)


def catalog_merge(spark, d):
    rows = hits(spark, d).select(
        F.when(F.col("id") != "7", F.col("id")).otherwise("").alias("id"),
        (F.col("pos") % 3).alias("file"), "pos", "score",
        F.array("query").alias("matched_queries"), F.lit(1).alias("query_match_count"),
    )
    out = C.catalog_merge(rows, ["file", "pos"])
    return out.select("id", "score", F.array_join("matched_queries", ",").alias("queries"), "query_match_count")


CATALOG_MERGE_SQL = f"""
with h as (select *, pos % 3 as file from ({HITS_SQL}) where id <> '7'),
 f as (select id, arg_min(score, file * 1000000000 + pos) as score, count(*) as n from h group by id),
 q as (select distinct id, query from h)
select f.id, any_value(f.score) as score, string_agg(query, ',' order by query) as queries,
  case when any_value(n) > 1 then count(*) else 1 end as query_match_count
from f join q using (id) group by f.id
"""


def merge_final(spark, d):
    rows = hits(spark, d).selectExpr(
        "id", "pos % 4 as wave", "pos", "case when pos % 5 = 0 then null else score end as llm_relevance_score"
    )
    return C.merge_final(rows, ["wave", "pos"])


MERGE_FINAL_SQL = f"""
with h as (select id, pos % 4 as wave, pos, case when pos % 5 = 0 then null else score end as llm_relevance_score from ({HITS_SQL}))
select id, wave, pos, llm_relevance_score from (select *, row_number() over (partition by id order by coalesce(llm_relevance_score, 0) desc, wave, pos) as r from h)
where r = 1
"""


def union_ids(spark, d):
    docs = table(spark, d, "documents")
    labels = table(spark, d, "labels")
    return C.union_ids_counts(labels.select("doc_id"), docs.select("doc_id"))


UNION_IDS_SQL = """
with e as (select distinct doc_id from labels), n as (select distinct doc_id from documents)
select (select count(*) from e) as existing, (select count(*) from n where doc_id not in (select doc_id from e)) as added,
  (select count(*) from (select * from e union select * from n)) as total
"""


def union_id_set(spark, d):
    docs = table(spark, d, "documents").select("doc_id")
    return C.union_ids(table(spark, d, "labels").select("doc_id"), docs)


def apply_corrections(spark, d):
    queue = table(spark, d, "documents").selectExpr(
        "doc_id as position", "text", "case doc_id % 3 when 0 then '1' when 1 then '0' else 'unsure' end as label"
    )
    out = C.apply_corrections(labelled(spark, d), queue, ["0", "1"], position="position")
    return out.select("doc_id", "label", "flagged_for_review", "corrected")


APPLY_CORRECTIONS_SQL = f"""
with t as ({LABELLED_SQL}),
 q as (select text, arg_max(case doc_id % 3 when 0 then '1' when 1 then '0' else 'unsure' end, doc_id) as new from documents
   group by text),
 j as (select t.*, new, coalesce(new in ('0', '1') and new <> label, false) as corrected from t left join q using (text))
select doc_id, case when corrected then new else label end as label,
  case when corrected then false else flagged_for_review end as flagged_for_review, corrected from j
"""


def history_rows(spark, d, parity):
    """Learning histories derived from the event stream, one point per 500 events."""
    return (
        table(spark, d, "events")
        .filter(F.col("user_id") % 2 == parity)
        .groupBy(F.floor(F.col("event_id") / 500).cast("int").alias("iteration"))
        .agg(F.round(F.avg("value") / 100, 4).alias("accuracy"), F.round(F.avg("value") / 110, 4).alias("f1"))
        .select("iteration", (F.lit(50) + F.col("iteration") * 50).cast("long").alias("n_labeled"), "accuracy", "f1",
                F.lit("entropy" if parity == 0 else "random").alias("strategy"))
    )


def history_sql(parity):
    name = "entropy" if parity == 0 else "random"
    return f"""select i as iteration, cast(50 + i * 50 as bigint) as n_labeled, round(avg(value) / 100, 4) as accuracy,
     round(avg(value) / 110, 4) as f1, '{name}' as strategy
     from (select cast(floor(event_id / 500.0) as int) as i, value from events where user_id % 2 = {parity}) group by i"""


def history_compare(spark, d):
    return C.history_compare(history_rows(spark, d, 0), history_rows(spark, d, 1))


HISTORY_COMPARE_SQL = f"""
select iteration, n_labeled, a.accuracy as accuracy_entropy, a.f1 as f1_entropy, b.accuracy as accuracy_random, b.f1 as f1_random,
  round(a.f1 - b.f1, 4) as f1_delta
from ({history_sql(0)}) a join ({history_sql(1)}) b using (iteration, n_labeled)
"""


def apply_verdicts(spark, d):
    survivors, rejected = C.apply_verdicts(candidates(spark, d), verdicts(spark, d))
    return survivors.select("id", "or_summary", F.lit("kept").alias("state")).unionByName(
        rejected.select("id", F.lit(None).cast("string").alias("or_summary"), F.lit("rejected").alias("state"))
    )


APPLY_VERDICTS_SQL = f"""
select d.doc_id as id, case when keep then summary end as or_summary, case when keep then 'kept' else 'rejected' end as state
from documents d join ({VERDICTS_SQL}) v on d.doc_id = v.id
"""


def unjudged(spark, d):
    return C.unjudged(candidates(spark, d), verdicts(spark, d)).agg(F.count(F.lit(1)).alias("unjudged"))


def rerank(spark, d):
    out = C.rerank(candidates(spark, d), ranks(spark, d), "id")
    return out.select("id", "or_rank", F.col("or_score").cast("long").alias("or_score"), "or_one_line")


RERANK_SQL = f"""
select d.doc_id as id, coalesce(rank, 999) as or_rank, cast(coalesce(score, 0) as bigint) as or_score, one_line as or_one_line
from documents d left join ({RANKS_SQL}) r on d.doc_id = r.id
"""


def attach_answers(spark, d):
    c = table(spark, d, "conversations")
    qa = (
        c.alias("q").join(c.alias("a"), F.expr("q.conv_id = a.conv_id and a.turn = q.turn + 1 and q.role = 'user' and a.role = 'assistant'"))
        .selectExpr("q.conv_id as id", "q.turn as turn", "q.text as question", "a.text as answer")
    )
    return C.attach_answers(candidates(spark, d).select("id"), qa, "turn")


ATTACH_ANSWERS_SQL = """
with qa as (select q.conv_id as id, q.turn, q.text || ' → ' || a.text as t from conversations q join conversations a
  on q.conv_id = a.conv_id and a.turn = q.turn + 1 and q.role = 'user' and a.role = 'assistant'),
 s as (select id, string_agg(t, ' | ' order by turn) as qa_text from qa group by id)
select doc_id as id, coalesce(qa_text, '') as qa_text from documents left join s on doc_id = s.id
"""


def final_selection(spark, d):
    picks = table(spark, d, "labels").filter("quality = 1").selectExpr(
        "doc_id as id", "doc_id % 97 as rank", "case when doc_id % 4 = 0 then null else 'fits' end as reason",
        "doc_id % 11 as relevance_score", "toxic = 1 as needs_verification",
    )
    out = C.final_selection(candidates(spark, d), picks, "id")
    return out.select("id", "llm_rank", "llm_reason", "llm_relevance_score", "needs_verification")


FINAL_SELECTION_SQL = """
select doc_id as id, doc_id % 97 as llm_rank, case when doc_id % 4 = 0 then '' else 'fits' end as llm_reason,
  doc_id % 11 as llm_relevance_score, toxic = 1 as needs_verification from documents join labels using (doc_id) where quality = 1
"""


def _checked(spark, d):
    v = table(spark, d, "labels").selectExpr(
        "doc_id as id", "case when doc_id % 10 = 0 then null else quality = 1 end as pass", "'en' as language",
        "cast(toxic as string) as num_classes", "concat('q', cast(quality as string)) as reason",
    )
    return C.verification_gate(candidates(spark, d), v)


def verification_gate(spark, d):
    kept, rejected = _checked(spark, d)
    return kept.select("id", F.lit("kept").alias("state"), F.col("verification.pass").alias("pass"),
                       F.col("verification.reason").alias("reason")).unionByName(
        rejected.select("id", F.lit("rejected").alias("state"), F.lit(False).alias("pass"), F.lit("").alias("reason"))
    )


VERIFICATION_SQL = """
with j as (select d.doc_id as id, l.doc_id is not null as checked, case when d.doc_id % 10 = 0 then null else quality = 1 end as pass,
   'q' || quality as reason from documents d left join labels l using (doc_id)),
 k as (select id, case when checked then pass end as pass, case when checked then reason else 'Could not fetch samples' end as reason from j)
select id, case when pass is false then 'rejected' else 'kept' end as state, pass, case when pass is false then '' else reason end as reason from k
"""


def wave_needed(spark, d):
    return C.wave_needed(_checked(spark, d)[0], 2)


CASES = {
    "dedupe_first": (_dedupe("first"), _dedupe_sql("first")),
    "dedupe_last": (_dedupe("last"), _dedupe_sql("last")),
    "dedupe_none": (_dedupe("none"), _dedupe_sql("none")),
    "dedupe_rows": (dedupe_rows, DEDUPE_ROWS_SQL),
    "exclude_ids": (
        exclude_ids,
        "select doc_id, lang from documents where doc_id not in (select doc_id from labels where quality = 0 or toxic = 1)",
    ),
    "catalog_dedupe": (catalog_dedupe, CATALOG_DEDUPE_SQL),
    "multi_query_hits": (
        multi_query_hits,
        f"""select count(*) as candidates, count(*) filter (where q >= 3) as multi_query
        from (select id, count(distinct query) as q from ({HITS_SQL}) group by id)""",
    ),
    "catalog_merge": (catalog_merge, CATALOG_MERGE_SQL),
    "merge_final": (merge_final, MERGE_FINAL_SQL),
    "union_ids_counts": (union_ids, UNION_IDS_SQL),
    "union_ids": (
        union_id_set, "select doc_id from labels union select doc_id from documents",
    ),
    "apply_corrections": (apply_corrections, APPLY_CORRECTIONS_SQL),
    "history_compare": (history_compare, HISTORY_COMPARE_SQL),
    "apply_verdicts": (apply_verdicts, APPLY_VERDICTS_SQL),
    "unjudged": (
        unjudged, "select count(*) as unjudged from documents where doc_id not in (select doc_id from labels)",
    ),
    "rerank": (rerank, RERANK_SQL),
    "attach_answers": (attach_answers, ATTACH_ANSWERS_SQL),
    "final_selection": (final_selection, FINAL_SELECTION_SQL),
    "verification_gate": (verification_gate, VERIFICATION_SQL),
    "wave_needed": (
        wave_needed,
        f"select count(*) as passed, count(*) < 2 as another_wave from ({VERIFICATION_SQL}) where state = 'kept'",
    ),
}
