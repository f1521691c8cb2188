"""Ranking of candidates and search waves."""

from __future__ import annotations

from pyspark.sql import functions as F

from tilth.operators import neighbors
from tilth.operators import search as S
from tilth.plans.wave import wave
from tilth.sources.collect import catalog_from_listing
from workload.base import RANKS_SQL, VERDICTS_SQL, ranks, spread_table, table, verdicts
from workload.collect import LISTING_SQL, listing_rows


def _terms(spark, d):
    return S.query_terms(table(spark, d, "benchmark"), "text")


def _catalog(spark, d):
    return spread_table(spark, d, "documents", "doc_id").selectExpr(
        "doc_id as id", "text as corpus_text", "case when doc_id % 3 = 0 then null else doc_id % 5 end as query_match_count",
        "n_chars", "lang",
    )


def bm25(spark, d):
    return S.bm25(_catalog(spark, d), _terms(spark, d)).select("id", F.round("score", 4).alias("score"))


def _bm25_cte(where="true"):
    return f"""
tok as (select doc_id as id, regexp_extract_all(lower(text), '[a-z0-9]+') as t from documents where {where}),
dl as (select id, len(t)::double as dl from tok),
n as (select count(*)::double as n, sum(dl) / count(*) as avgdl from dl),
e as (select id, unnest(t) as term from tok),
tf as (select id, term, count(*)::double as tf from e group by id, term),
dfs as (select term, ln(n - count(*) + 0.5::double) - ln(count(*) + 0.5::double) as raw from tf, n group by term, n),
mi as (select avg(raw) as mean_idf from dfs),
qt as (select term, count(*)::double as q from (select unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) as term from benchmark) group by term),
sc as (select tf.id, sum(case when raw < 0 then 0.25 * mean_idf else raw end * q * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) as score
  from tf join qt using (term) join dfs using (term) join dl using (id), n, mi group by tf.id),
bm as (select dl.id, coalesce(score, 0) as score from dl left join sc using (id))"""


BOOST = "score + 0.05 * coalesce(case when id % 3 = 0 then null else id % 5 end, 1)"


def bm25_boosted(spark, d):
    return S.bm25_boosted(_catalog(spark, d), _terms(spark, d)).select("id", F.round("score", 4).alias("score"))


def bm25_top(spark, d):
    return S.bm25_top(_catalog(spark, d), _terms(spark, d), 50).select("id", "lang", F.round("score", 4).alias("score"))


def top_n(spark, d):
    return S.top_n(table(spark, d, "events"), "value", 100, "event_id").select("event_id", "value")


def choose_top_n(spark, d):
    return S.choose_top_n(table(spark, d, "documents"))


def catalog_filter(spark, d):
    catalog = catalog_from_listing(listing_rows(spark, d))
    return S.catalog_filter(catalog, license="CC0", task="", tags=["ECONOMY"]).select("id", "license")


def catalog_sort(spark, d):
    return S.catalog_sort(catalog_from_listing(listing_rows(spark, d)), "votes").select("id", "likes")


def knn(spark, d):
    e = table(spark, d, "embeddings")
    out = neighbors.knn_join(e, e, 5, "vec_id", "vec_id", "embedding", exclude_self=True)
    return out.select("query_id", "donor_id", F.round("distance", 4).alias("distance"), "rank")


def knn_by_label(spark, d):
    e = table(spark, d, "embeddings")
    out = neighbors.knn_join(e, e, 3, "vec_id", "vec_id", "embedding", by="label", exclude_self=True)
    return out.select("query_id", "donor_id", F.round("distance", 4).alias("distance"), "rank")


def _knn_sql(k, on):
    return f"""
with e as (select vec_id, label, embedding::double[] as v from embeddings),
 p as (select q.vec_id as query_id, d.vec_id as donor_id, list_distance(q.v, d.v) as distance from e q join e d on {on} and q.vec_id <> d.vec_id),
 r as (select *, row_number() over (partition by query_id order by distance, donor_id) as rank from p)
select query_id, donor_id, round(distance, 4) as distance, rank from r where rank <= {k}
"""


def search_wave(spark, d):
    docs = table(spark, d, "documents")
    seen = docs.filter("doc_id % 17 = 0").select("doc_id")
    sizes = docs.selectExpr("doc_id as id", "case when doc_id % 2 = 0 then n_chars end as num_rows", "n_chars * 512 as num_bytes")
    finalists, _ = wave(
        _catalog(spark, d), _terms(spark, d), excluded=[seen], verdicts=verdicts(spark, d), ranks=ranks(spark, d),
        sizes=sizes, bm25_n=100,
    )
    return finalists.select("id", "or_rank", "or_summary", "num_rows", "size_mb", "size_kb", F.round("score", 4).alias("score"))


WAVE_SQL = f"""
with {_bm25_cte("doc_id % 17 <> 0")},
 top as (select id, {BOOST} as score from bm order by 2 desc, 1 limit 100),
 j as (select top.*, v.summary, coalesce(r.rank, 999) as or_rank from top join ({VERDICTS_SQL}) v using (id) left join ({RANKS_SQL}) r using (id) where v.keep),
 f as (select * from j order by or_rank, score desc limit 10)
select f.id, or_rank, summary as or_summary, case when f.id % 2 = 0 then n_chars end as num_rows, round(n_chars * 512 / 1048576.0::double, 2) as size_mb,
 round(n_chars * 512 / 1024.0::double, 1) as size_kb, round(score, 4) as score from f join documents on f.id = doc_id
"""


def wave_rejected(spark, d):
    docs = table(spark, d, "documents")
    sizes = docs.selectExpr("doc_id as id", "n_chars as num_rows", "n_chars as num_bytes")
    _, rejected = wave(
        _catalog(spark, d), _terms(spark, d), excluded=[], verdicts=verdicts(spark, d), ranks=None, sizes=sizes, bm25_n=300,
    )
    return rejected


CASES = {
    "bm25": (bm25, f"with {_bm25_cte()} select id, round(score, 4) as score from bm"),
    "bm25_boosted": (bm25_boosted, f"with {_bm25_cte()} select id, round({BOOST}, 4) as score from bm"),
    "bm25_top": (
        bm25_top,
        f"""with {_bm25_cte()}, t as (select id, {BOOST} as score from bm order by 2 desc, 1 limit 50)
        select id, lang, round(score, 4) as score from t join documents on id = doc_id""",
    ),
    "top_n": (top_n, "select event_id, value from events order by value desc, event_id limit 100"),
    "choose_top_n": (
        choose_top_n,
        """select n as candidates, cast(case when n < 100 then 30 when n < 300 then 50 when n < 600 then 70 else 100 end as bigint) as top_n
        from (select count(*) as n from documents)""",
    ),
    "catalog_filter": (
        catalog_filter, f"select id, license from ({LISTING_SQL}) where license = 'CC0' and list_contains(string_split(tags, ','), 'ECONOMY')",
    ),
    "catalog_sort": (catalog_sort, f"select id, likes from ({LISTING_SQL})"),
    "knn_join": (knn, _knn_sql(5, "true")),
    "knn_join_by_label": (knn_by_label, _knn_sql(3, "q.label = d.label")),
    "search_wave": (search_wave, WAVE_SQL),
    "search_wave_rejected": (
        wave_rejected,
        f"""with {_bm25_cte()}, t as (select id, {BOOST} as score from bm order by 2 desc, 1 limit 300)
        select id from t join ({VERDICTS_SQL}) v using (id) where not v.keep""",
    ),
}
