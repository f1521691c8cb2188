"""Repairs of missing values and outliers, and cleaning compositions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tilth.functions.store import cut
from tilth.operators import fix as X
from tilth.operators.compare import compare
from tilth.operators.detect import iqr_bounds
from tilth.operators.neighbors import impute_knn
from tilth.plans import quality as Q
from workload.base import EVENTS_GAPS_SQL, ORDERS_GAPS_SQL, events_gaps, md5_sql, orders_gaps, table

def _orders(change):
    return lambda spark, d: change(orders_gaps(spark, d))


def _fill_sql(custkey="o_custkey", price="o_totalprice", priority="o_orderpriority", note="note", where="true"):
    return f"""with t as ({ORDERS_GAPS_SQL}) select o_orderkey, {custkey} as o_custkey, o_orderstatus, {price} as o_totalprice,
    {priority} as o_orderpriority, {note} as note from t where {where}"""


def _mode(c):
    return f"coalesce({c}, (select {c} from t where {c} is not null group by {c} order by count(*) desc, {c} limit 1))"


def _mean(c):
    return f"coalesce({c}, (select avg({c}) from t))"


def _median(c):
    return f"coalesce({c}, (select quantile_cont({c}, 0.5) from t))"


def _along(fill):
    def run(spark, d):
        return fill(events_gaps(spark, d), ["value"], "event_id", "user_id").select("event_id", "user_id", F.round("value", 6).alias("value"))

    return run


def _along_all(fill):
    def run(spark, d):
        return fill(events_gaps(spark, d), ["value"], "event_id").select("event_id", F.round("value", 6).alias("value"))

    return run


def _ffill_sql(by):
    over = f"over ({by} order by event_id rows between unbounded preceding and current row)"
    return f"round(last_value(value ignore nulls) {over}, 6)"


def _bfill_sql(by):
    return f"round(first_value(value ignore nulls) over ({by} order by event_id rows between current row and unbounded following), 6)"


def _interpolate_sql(by, columns):
    return f"""
with t as (select *, row_number() over ({by} order by event_id) as p from ({EVENTS_GAPS_SQL})),
 n as (select *, case when value is not null then p end as vp from t),
 w as (select *, last_value(value ignore nulls) over a as v0, last_value(vp ignore nulls) over a as p0,
   first_value(value ignore nulls) over b as v1, first_value(vp ignore nulls) over b as p1 from n
   window a as ({by} order by event_id rows between unbounded preceding and current row),
     b as ({by} order by event_id rows between current row and unbounded following))
select {columns}, round(case when value is not null then value when v0 is not null and v1 is not null then v0 + (v1 - v0) / (p1 - p0) * (p - p0) else v0 end, 6) as value
from w
"""


def impute_by_column(spark, d):
    return X.impute_by_column(
        orders_gaps(spark, d), "o_custkey=mean,o_orderpriority=constant:none", "median"
    )


def impute_knn_part(spark, d):
    t = table(spark, d, "part").selectExpr(
        "p_partkey", "case when p_partkey % 9 = 0 then null else cast(p_size as double) end as p_size",
        "case when p_partkey % 9 = 4 then null else p_retailprice end as p_retailprice",
        "cast(length(p_name) as double) as name_chars",
    )
    out = impute_knn(t, "p_partkey", ["p_size", "p_retailprice", "name_chars"], 5)
    return out.select("p_partkey", F.round("p_size", 4).alias("p_size"), F.round("p_retailprice", 4).alias("p_retailprice"))


IMPUTE_KNN_SQL = """
with t as (select p_partkey, case when p_partkey % 9 = 0 then null else p_size::double end as a,
   case when p_partkey % 9 = 4 then null else p_retailprice end as b, length(p_name)::double as c from part),
 p as (select q.p_partkey as q, d.p_partkey as d, q.a as qa, q.b as qb, d.a as da, d.b as db,
   sqrt((coalesce((q.a - d.a) * (q.a - d.a), 0) + coalesce((q.b - d.b) * (q.b - d.b), 0) + (q.c - d.c) * (q.c - d.c))
     * (3.0::double / ((q.a is not null and d.a is not null)::int + (q.b is not null and d.b is not null)::int + 1))) as dist
   from t q, t d where q.a is null or q.b is null),
 fa as (select q, avg(da) as v from (select *, row_number() over (partition by q order by dist, d) as r from p where qa is null and da is not null) where r <= 5 group by q),
 fb as (select q, avg(db) as v from (select *, row_number() over (partition by q order by dist, d) as r from p where qb is null and db is not null) where r <= 5 group by q)
select p_partkey, round(coalesce(a, fa.v), 4) as p_size, round(coalesce(b, fb.v), 4) as p_retailprice
from t left join fa on p_partkey = fa.q left join fb on p_partkey = fb.q
"""


def _line(change):
    def run(spark, d):
        t = table(spark, d, "lineitem").selectExpr(
            "l_orderkey", "l_linenumber", "case when l_partkey % 5 = 0 then null else l_extendedprice end as l_extendedprice", "l_tax * l_tax * l_tax as l_tax",
        )
        out = change(t)
        return out.select("l_orderkey", "l_linenumber", F.round("l_extendedprice", 4).alias("l_extendedprice"), F.round("l_tax", 6).alias("l_tax"))

    return run


LINE_SQL = """select l_orderkey, l_linenumber, case when l_partkey % 5 = 0 then null else l_extendedprice end as l_extendedprice, l_tax * l_tax * l_tax as l_tax from lineitem"""


def _limits(kind):
    cols = ("l_extendedprice", "l_tax")
    if kind == "iqr":
        return [
            (f"(select quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) from t)",
             f"(select quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) from t)") for c in cols
        ]
    if kind == "zscore":
        return [(f"(select avg({c}) - 1.2 * stddev_samp({c}) from t)", f"(select avg({c}) + 1.2 * stddev_samp({c}) from t)") for c in cols]
    return [(f"(select quantile_cont({c}, 0.05) from t)", f"(select quantile_cont({c}, 0.9) from t)") for c in cols]


def _clip_sql(kind):
    (a, b), (x, y) = _limits(kind)
    return f"""with t as ({LINE_SQL}) select l_orderkey, l_linenumber,
    case when l_extendedprice is not null then round(least(greatest(l_extendedprice, {a}), {b}), 4) end as l_extendedprice, round(least(greatest(l_tax, {x}), {y}), 6) as l_tax from t"""


def _drop_sql(kind):
    (a, b), (x, y) = _limits(kind)
    return f"""with t as ({LINE_SQL}) select l_orderkey, l_linenumber, round(l_extendedprice, 4) as l_extendedprice, round(l_tax, 6) as l_tax
    from t where not coalesce(l_extendedprice < {a} or l_extendedprice > {b}, false) and not (l_tax < {x} or l_tax > {y})"""


def flag_outliers(spark, d):
    return X.flag_outliers(events_gaps(spark, d), ["value", "user_id"]).select("event_id", "value_outlier", "user_id_outlier")


FLAG_SQL = f"""
with t as ({EVENTS_GAPS_SQL}), q as (select quantile_cont(value, 0.25) as a, quantile_cont(value, 0.75) as b, quantile_cont(user_id, 0.25) as x, quantile_cont(user_id, 0.75) as y from t)
select event_id, case when value < a - 1.5 * (b - a) or value > b + 1.5 * (b - a) then 1 else 0 end as value_outlier,
 case when user_id < x - 1.5 * (y - x) or user_id > y + 1.5 * (y - x) then 1 else 0 end as user_id_outlier from t, q
"""


def clip_report(spark, d):
    t = events_gaps(spark, d)
    return X.clip_report(t, iqr_bounds(t, ["value", "user_id"]), digits=6)


CLIP_REPORT_SQL = f"""
with t as ({EVENTS_GAPS_SQL}), q as (select quantile_cont(value, 0.25) as a, quantile_cont(value, 0.75) as b, quantile_cont(user_id, 0.25) as x, quantile_cont(user_id, 0.75) as y from t)
select 'value' as "column", count(*) filter (where value < a - 1.5 * (b - a) or value > b + 1.5 * (b - a)) as clipped,
 round(any_value(a - 1.5 * (b - a)), 6) as lower_bound, round(any_value(b + 1.5 * (b - a)), 6) as upper_bound from t, q
union all select 'user_id', count(*) filter (where user_id < x - 1.5 * (y - x) or user_id > y + 1.5 * (y - x)),
 round(any_value(x - 1.5 * (y - x)), 6), round(any_value(y + 1.5 * (y - x)), 6) from t, q
"""


def attach_bounds(spark, d):
    t = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    out = X.attach_bounds(t, iqr_bounds(t, ["l_quantity"]))
    return out.select("l_orderkey", "l_linenumber", F.round("l_quantity_low", 4).alias("low"), F.round("l_quantity_high", 4).alias("high"))


ATTACH_SQL = """
select l_orderkey, l_linenumber, round(q1 - 1.5 * (q3 - q1), 4) as low, round(q3 + 1.5 * (q3 - q1), 4) as high
from lineitem, (select quantile_cont(l_quantity, 0.25) as q1, quantile_cont(l_quantity, 0.75) as q3 from lineitem)
"""


def drop_sequential(spark, d):
    t = table(spark, d, "events").selectExpr("event_id", "value", "value * user_id as weighted")
    return X.drop_outliers_sequential(t, ["value", "weighted"]).select("event_id")


DROP_SEQUENTIAL_SQL = """
with t as (select event_id, value, value * user_id as weighted from events),
 a as (select quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3 from t),
 u as (select t.* from t, a where value between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)),
 b as (select quantile_cont(weighted, 0.25) as q1, quantile_cont(weighted, 0.75) as q3 from u)
select event_id from u, b where weighted between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)
"""


def filter_by_length(spark, d):
    return X.filter_by_length_iqr(table(spark, d, "documents")).select("doc_id")


LENGTH_CTE = """
q as (select quantile_cont(length(text), 0.25) as q1, quantile_cont(length(text), 0.75) as q3 from {t}),
k as (select {t}.* from {t}, q where length(text) between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))
"""


def _clean(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", F.col("lang").alias("label"), "source", "n_chars")
    return docs, Q.clean_aggressive(docs, "doc_id", n=50)


def clean_aggressive(spark, d):
    return _clean(spark, d)[1].select("doc_id", "label", "source")


CLEAN_CTE = f"""
with docs as (select doc_id, text, lang as label, source, n_chars from documents),
u as (select doc_id, text, label, source, n_chars from (select *, row_number() over (partition by text order by doc_id) as r from docs) where r = 1),
{LENGTH_CTE.format(t="u")},
c as (select doc_id, text, label, source, n_chars from (select *, row_number() over (partition by label order by {md5_sql(42, "doc_id")}, doc_id) as r from k) where r <= 50)
"""


def clean_aggressive_compare(spark, d):
    before, after = _clean(spark, d)
    return compare(before, cut(after))


def outliers_sql(t, c):
    return f"""(select count(*) from {t}, (select quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.75) as q3 from {t}) z
    where {c} < q1 - 1.5 * (q3 - q1) or {c} > q3 + 1.5 * (q3 - q1))"""


CLEAN_COMPARE_SQL = CLEAN_CTE + f""",
m as (
 select 'rows' as metric, (select count(*) from docs) as b, (select count(*) from c) as a
 union all select 'missing_values', 0, 0
 union all select 'duplicates', 0, 0
 union all select 'outliers_doc_id', {outliers_sql("docs", "doc_id")}, {outliers_sql("c", "doc_id")}
 union all select 'outliers_n_chars', {outliers_sql("docs", "n_chars")}, {outliers_sql("c", "n_chars")})
select metric, b as before, a as after, printf('%+d', a - b) as change,
 case when metric in ('rows', 'outliers_doc_id', 'outliers_n_chars') and b <> 0 then printf('%+.1f%%', (a - b) / b::double * 100) else '' end as change_pct from m
"""


def _rows(spark, d):
    """Orders with gaps in which every fifth row repeats the values of its predecessor."""
    t = orders_gaps(spark, d).drop("note")
    copies = t.filter("o_orderkey % 5 = 0").withColumn("o_orderkey", F.col("o_orderkey") + 1000000000)
    return t.unionByName(copies)


ROWS_CTE = f"""
g as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from ({ORDERS_GAPS_SQL})),
r as (select * from g union all select o_orderkey + 1000000000, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from g where o_orderkey % 5 = 0),
u as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from (select *, row_number() over
  (partition by o_custkey, o_orderstatus, o_totalprice, o_orderpriority order by o_orderkey) as n from r) where n = 1)"""


def _filled(t):
    return f"""
f as (select o_orderkey, coalesce(o_custkey, (select quantile_cont(o_custkey, 0.5) from {t})) as o_custkey, o_orderstatus,
  coalesce(o_totalprice, (select quantile_cont(o_totalprice, 0.5) from {t})) as o_totalprice,
  coalesce(o_orderpriority, (select o_orderpriority from {t} where o_orderpriority is not null group by 1 order by count(*) desc, 1 limit 1)) as o_orderpriority
  from {t})"""


def _round(df):
    return df.withColumns({c: F.round(F.col(c).cast("double"), 4) for c in ("o_custkey", "o_totalprice")})


def fix_default(spark, d):
    return _round(Q.fix(_rows(spark, d), "o_orderkey"))


FIX_SQL = f"""
with {ROWS_CTE}, {_filled("u")},
q as (select quantile_cont(o_custkey, 0.25) as a, quantile_cont(o_custkey, 0.75) as b, quantile_cont(o_totalprice, 0.25) as x, quantile_cont(o_totalprice, 0.75) as y from f)
select o_orderkey, round(least(greatest(o_custkey, a - 1.5 * (b - a)), b + 1.5 * (b - a))::double, 4) as o_custkey, o_orderstatus,
 round(least(greatest(o_totalprice, x - 1.5 * (y - x)), y + 1.5 * (y - x)), 4) as o_totalprice, o_orderpriority from f, q
"""


def _preset(name):
    return lambda spark, d: _round(Q.clean_preset(_rows(spark, d), "o_orderkey", name))


BALANCED_SQL = f"""
with {ROWS_CTE}, {_filled("u")},
z as (select avg(o_custkey) as m1, stddev_samp(o_custkey) as s1, avg(o_totalprice) as m2, stddev_samp(o_totalprice) as s2 from f)
select o_orderkey, round(o_custkey::double, 4) as o_custkey, o_orderstatus, round(o_totalprice, 4) as o_totalprice, o_orderpriority
from f, z where abs(o_custkey - m1) <= 3 * s1 and abs(o_totalprice - m2) <= 3 * s2
"""
CONSERVATIVE_SQL = f"""
with {ROWS_CTE}, {_filled("r")}
select o_orderkey, round(o_custkey::double, 4) as o_custkey, o_orderstatus, round(o_totalprice, 4) as o_totalprice, o_orderpriority from f
"""
AGGRESSIVE_SQL = f"""
with {ROWS_CTE}, k as (select * from u where o_custkey is not null and o_totalprice is not null and o_orderpriority is not null),
q as (select quantile_cont(o_custkey, 0.25) as a, quantile_cont(o_custkey, 0.75) as b, quantile_cont(o_totalprice, 0.25) as x, quantile_cont(o_totalprice, 0.75) as y from k)
select o_orderkey, round(o_custkey::double, 4) as o_custkey, o_orderstatus, round(o_totalprice, 4) as o_totalprice, o_orderpriority
from k, q where o_custkey between a - 1.5 * (b - a) and b + 1.5 * (b - a) and o_totalprice between x - 1.5 * (y - x) and y + 1.5 * (y - x)
"""


def _for_task(task):
    return lambda spark, d: _round(Q.fix(_rows(spark, d), "o_orderkey", Q.strategy_for(task)))


def _inside(t, c):
    return f"""select * from {t}, (select quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.75) as q3 from {t}) z
  where {c} between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)"""


# Fences of a column are those of the rows that the column before it left.
REGRESSION_SQL = f"""
with {ROWS_CTE}, {_filled("u")},
i as ({_inside("f", "o_custkey")}),
j as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from i),
k as ({_inside("j", "o_totalprice")})
select o_orderkey, round(o_custkey::double, 4) as o_custkey, o_orderstatus, round(o_totalprice, 4) as o_totalprice, o_orderpriority from k
"""
CLUSTERING_SQL = f"""
with {ROWS_CTE}, f as (select * from u where o_custkey is not null and o_totalprice is not null and o_orderpriority is not null),
q as (select quantile_cont(o_custkey, 0.25) as a, quantile_cont(o_custkey, 0.75) as b, quantile_cont(o_totalprice, 0.25) as x, quantile_cont(o_totalprice, 0.75) as y from f)
select o_orderkey, round(least(greatest(o_custkey, a - 1.5 * (b - a)), b + 1.5 * (b - a))::double, 4) as o_custkey, o_orderstatus,
 round(least(greatest(o_totalprice, x - 1.5 * (y - x)), y + 1.5 * (y - x)), 4) as o_totalprice, o_orderpriority from f, q
"""


CASES = {
    "impute_mean": (
        _orders(lambda t: X.impute(t, "mean").withColumns({c: F.round(c, 4) for c in ("o_custkey", "o_totalprice")})),
        _fill_sql(f"round({_mean('o_custkey')}, 4)", f"round({_mean('o_totalprice')}, 4)", _mode("o_orderpriority")),
    ),
    "impute_median": (
        _orders(lambda t: X.impute(t, "median")),
        _fill_sql(_median("o_custkey"), _median("o_totalprice"), _mode("o_orderpriority")),
    ),
    "impute_mode": (
        _orders(lambda t: X.impute_mode(t, fill_empty=True)),
        _fill_sql(_mode("o_custkey"), _mode("o_totalprice"), _mode("o_orderpriority"), "'unknown'"),
    ),
    "ffill": (
        _along(X.ffill), f"select event_id, user_id, {_ffill_sql('partition by user_id')} as value from ({EVENTS_GAPS_SQL})",
    ),
    "bfill": (
        _along(X.bfill), f"select event_id, user_id, {_bfill_sql('partition by user_id')} as value from ({EVENTS_GAPS_SQL})",
    ),
    "interpolate": (_along(X.interpolate), _interpolate_sql("partition by user_id", "event_id, user_id")),
    "ffill_whole_table": (_along_all(X.ffill), f"select event_id, {_ffill_sql('')} as value from ({EVENTS_GAPS_SQL})"),
    "bfill_whole_table": (_along_all(X.bfill), f"select event_id, {_bfill_sql('')} as value from ({EVENTS_GAPS_SQL})"),
    "interpolate_whole_table": (_along_all(X.interpolate), _interpolate_sql("", "event_id")),
    "fill_constant": (
        _orders(X.fill_constant),
        _fill_sql("coalesce(o_custkey, 0)", "coalesce(o_totalprice, 0)", "coalesce(o_orderpriority, 'unknown')", "'unknown'"),
    ),
    "drop_rows": (
        _orders(X.drop_rows), _fill_sql(where="o_custkey is not null and o_totalprice is not null and o_orderpriority is not null"),
    ),
    "drop_columns": (
        _orders(lambda t: X.drop_columns(t, ["note", "o_custkey"])),
        f"select o_orderkey, o_orderstatus, o_totalprice, o_orderpriority from ({ORDERS_GAPS_SQL})",
    ),
    "drop_sparse_columns": (
        _orders(lambda t: X.drop_sparse_columns(t, 0.1)),
        f"select o_orderkey, o_custkey, o_orderstatus, o_orderpriority from ({ORDERS_GAPS_SQL})",
    ),
    "impute_knn": (impute_knn_part, IMPUTE_KNN_SQL),
    "impute_by_column": (
        impute_by_column,
        _fill_sql(_mean("o_custkey"), _median("o_totalprice"), "coalesce(o_orderpriority, 'none')"),
    ),
    "clip_iqr": (_line(lambda t: X.clip_iqr(t, ["l_extendedprice", "l_tax"])), _clip_sql("iqr")),
    "clip_zscore": (_line(lambda t: X.clip_zscore(t, ["l_extendedprice", "l_tax"], 1.2)), _clip_sql("zscore")),
    "cap_percentile": (_line(lambda t: X.cap_percentile(t, ["l_extendedprice", "l_tax"], 5, 90)), _clip_sql("percentile")),
    "clip_report": (clip_report, CLIP_REPORT_SQL),
    "attach_bounds": (attach_bounds, ATTACH_SQL),
    "flag_outliers": (flag_outliers, FLAG_SQL),
    "drop_outliers_iqr": (_line(lambda t: X.drop_outliers(t, ["l_extendedprice", "l_tax"])), _drop_sql("iqr")),
    "drop_outliers_zscore": (
        _line(lambda t: X.drop_outliers(t, ["l_extendedprice", "l_tax"], "zscore", 1.2)), _drop_sql("zscore"),
    ),
    "drop_outliers_sequential": (drop_sequential, DROP_SEQUENTIAL_SQL),
    "filter_by_length_iqr": (
        filter_by_length, f"with {LENGTH_CTE.format(t='documents')} select doc_id from k",
    ),
    "fix": (fix_default, FIX_SQL),
    "fix_for_task": (_for_task("classification"), FIX_SQL),
    "fix_for_regression": (_for_task("regression"), REGRESSION_SQL),
    "fix_for_clustering": (_for_task("clustering"), CLUSTERING_SQL),
    "clean_aggressive": (clean_aggressive, CLEAN_CTE + "select doc_id, label, source from c"),
    "clean_aggressive_compare": (clean_aggressive_compare, CLEAN_COMPARE_SQL),
    "clean_preset_balanced": (_preset("balanced"), BALANCED_SQL),
    "clean_preset_conservative": (_preset("conservative"), CONSERVATIVE_SQL),
    "clean_preset_aggressive": (_preset("aggressive"), AGGRESSIVE_SQL),
}
