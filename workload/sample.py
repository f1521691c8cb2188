"""Samples, quotas, splits and balancing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tilth.operators import balance as B
from tilth.operators import sampling as S
from tilth.operators.agree import value_counts
from workload.base import DOCS_SQL, HITS_SQL, docs, hits, md5_sql, table
from workload.combine import history_rows, history_sql


def sample_n(spark, d):
    return S.sample_n(table(spark, d, "documents"), 300, "doc_id").select("doc_id", "lang")


def sample_n_large(spark, d):
    """More rows than one sorted task should hold: taken by distributed rank."""
    orders = table(spark, d, "orders")
    ranked = S.hash_ranked(orders, [], "o_orderkey", 42, at_most=7000).filter(F.col("_rank") <= 7000)
    return ranked.select("o_orderkey", F.col("_rank").alias("rank"))


def shuffle(spark, d):
    return S.shuffle(table(spark, d, "documents"), "doc_id", 7).select("doc_id")


def undersample(spark, d):
    return S.undersample(docs(spark, d), "label", "doc_id").select("doc_id", "label")


_hash = md5_sql(42, "doc_id")
UNDERSAMPLE_SQL = f"""
with t as ({DOCS_SQL}), m as (select min(c) as n from (select count(*) as c from t where label is not null group by label))
select doc_id, label from (select *, row_number() over (partition by label order by {_hash}, doc_id) as r from t where label is not null), m where r <= n
"""


def stratified_cap(spark, d):
    return S.stratified_cap(table(spark, d, "documents"), "source", "lang", "doc_id", 20).select("doc_id", "source", "lang")


STRATIFIED_CAP_SQL = f"""
with t as (select doc_id, source, lang, count(*) over (partition by source) as total, count(*) over (partition by source, lang) as size,
   row_number() over (partition by source, lang order by {_hash}, doc_id) as r from documents),
 k as (select * from t where total <= 20 or r <= greatest(1, round_even(size / total::double * 20, 0)::bigint)),
 c as (select *, row_number() over (partition by source order by {md5_sql("42-cut", "doc_id")}, doc_id) as n from k)
select doc_id, source, lang from c where total <= 20 or n <= 20
"""


def stratified_split(spark, d):
    return S.stratified_split(table(spark, d, "documents"), "lang", "doc_id").select("doc_id", "lang", "split")


STRATIFIED_SPLIT_SQL = f"""
select doc_id, lang, case when row_number() over (partition by lang order by {_hash}, doc_id)
  <= round(count(*) over (partition by lang) * 0.2::double) then 'test' else 'train' end as split from documents
"""


def seed_and_pool(spark, d):
    seed, pool = S.seed_and_pool(table(spark, d, "documents"), "doc_id", 50)
    return seed.select("doc_id", F.lit("seed").alias("part")).unionByName(pool.select("doc_id", F.lit("pool").alias("part")))


def limit_per_query(spark, d):
    return S.limit_per_query(hits(spark, d), "pos", 100).select("query", "pos")


def every_kth_point(spark, d):
    return S.every_kth_point(history_rows(spark, d, 0), 200).select("n_labeled", "f1")


def class_weights(spark, d):
    return B.class_weights(docs(spark, d), "label")


def oversample(spark, d):
    return B.oversample(docs(spark, d), "label", "doc_id").select("doc_id", "label", "copy")


OVERSAMPLE_SQL = f"""
with t as (select doc_id, label from ({DOCS_SQL}) where label is not null),
 c as (select label, count(*) as n from t group by label), m as (select max(n) as mx from c),
 x as (select *, row_number() over (partition by label order by {_hash}, doc_id) - 1 as i from t),
 w as (select label, n, unnest(range(0, mx - n)) as j from c, m where n < mx),
 p as (select label, j, ('0x' || substr({md5_sql(42, "label", "j")}, 1, 15))::bigint % n as pick from w)
select doc_id, label, 0::bigint as copy from t
union all select x.doc_id, x.label, j + 1 from p join x on x.label = p.label and x.i = p.pick
"""


def oversample_counts(spark, d):
    return value_counts(B.oversample(table(spark, d, "conversations").withColumn("id", F.expr("conv_id * 1000 + turn")), "role", "id"), "role")


def auto_balance(spark, d):
    return B.auto_balance(docs(spark, d), "label", "doc_id").select("doc_id", "label")


AUTO_BALANCE_SQL = f"""
with t as ({DOCS_SQL}), m as (select min(c) as n, round(max(c) / min(c)::double, 2) as ratio
   from (select count(*) as c from t where label is not null group by label))
select doc_id, label from (select *, row_number() over (partition by label order by {_hash}, doc_id) as r from t), m
where ratio < 5 or (label is not null and r <= n)
"""


def smote(spark, d):
    t = table(spark, d, "part").select("p_partkey", "p_type", "p_size", "p_retailprice")
    out = B.smote(t, "p_type", "p_partkey", ["p_size", "p_retailprice"], 5)
    return out.select("p_type", F.round("p_size", 4).alias("p_size"), F.round("p_retailprice", 4).alias("p_retailprice"), "synthetic")


SMOTE_SQL = f"""
with t as (select p_partkey, p_type, p_size::double as a, p_retailprice as b from part),
 c as (select p_type, count(*) as n from t group by p_type), m as (select max(n) as mx from c),
 x as (select *, row_number() over (partition by p_type order by {md5_sql(42, "p_partkey")}, p_partkey) - 1 as i from t),
 w as (select p_type, n, unnest(range(0, mx - n)) as j from c, m where n < mx),
 g as (select *, {md5_sql(42, "p_type", "j")} as h from w),
 p as (select p_type, ('0x' || substr(h, 1, 15))::bigint % n as pick, ('0x' || substr(md5(h || 'n'), 1, 15))::bigint % least(5, greatest(n - 1, 1)) as nth,
   ('0x' || substr(md5(h || 'u'), 1, 13))::bigint / 4503599627370496.0::double as u from g),
 k as (select q.p_partkey as q, d.a, d.b, row_number() over (partition by q.p_partkey
   order by sqrt((q.a - d.a) * (q.a - d.a) + (q.b - d.b) * (q.b - d.b)), d.p_partkey) - 1 as nth from t q join t d on q.p_type = d.p_type and q.p_partkey <> d.p_partkey)
select p_type, round(a, 4) as p_size, round(b, 4) as p_retailprice, false as synthetic from t
union all select x.p_type, round(x.a + u * (coalesce(k.a, x.a) - x.a), 4), round(x.b + u * (coalesce(k.b, x.b) - x.b), 4), true
from p join x on x.p_type = p.p_type and x.i = p.pick left join k on k.q = x.p_partkey and k.nth = p.nth
"""

CASES = {
    "sample_n": (sample_n, f"select doc_id, lang from documents order by {_hash}, doc_id limit 300"),
    "sample_n_ranked": (
        sample_n_large,
        f"""select o_orderkey, r as rank from (select o_orderkey, row_number() over (order by {md5_sql(42, "o_orderkey")}, o_orderkey) as r from orders)
        where r <= 7000""",
    ),
    "shuffle": (shuffle, "select doc_id from documents"),
    "undersample": (undersample, UNDERSAMPLE_SQL),
    "stratified_cap": (stratified_cap, STRATIFIED_CAP_SQL),
    "stratified_split": (stratified_split, STRATIFIED_SPLIT_SQL),
    "seed_and_pool": (
        seed_and_pool,
        "select doc_id, case when row_number() over (order by doc_id) <= 50 then 'seed' else 'pool' end as part from documents",
    ),
    "limit_per_query": (
        limit_per_query,
        f"select query, pos from (select *, row_number() over (partition by query order by pos) as r from ({HITS_SQL})) where r <= 100",
    ),
    "every_kth_point": (
        every_kth_point,
        f"""with h as ({history_sql(0)}) select n_labeled, f1 from h where n_labeled = (select min(n_labeled) from h) or n_labeled % 200 = 0""",
    ),
    "class_weights": (
        class_weights,
        f"""with c as (select label, count(*) as count from ({DOCS_SQL}) group by label)
        select label, count, round(sum(count) over () / (count(*) over () * count)::double, 4) as weight from c""",
    ),
    "oversample": (oversample, OVERSAMPLE_SQL),
    "oversample_counts": (
        oversample_counts,
        "select role as value, max(c) over () as count from (select role, count(*) as c from conversations group by role)",
    ),
    "auto_balance": (auto_balance, AUTO_BALANCE_SQL),
    "smote": (smote, SMOTE_SQL),
}
