"""Profiles and before/after comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from tilth.functions.scalars import STOP_WORDS
from tilth.functions.store import spread
from tilth.functions.scalars import word_count
from tilth.operators import compare as M
from tilth.operators import media
from tilth.operators import profile as P
from tilth.operators.combine import dedupe
from tilth.operators.fix import clip_iqr, drop_outliers, impute
from workload.base import DOCS_SQL, EVENTS_GAPS_SQL, ORDERS_GAPS_SQL, docs, events_gaps, orders_gaps, table
from workload.collect import _text_files
from workload.detect import LINE_COLUMNS


def describe(spark, d):
    return P.describe(table(spark, d, "lineitem"), LINE_COLUMNS)


def _describe_sql(source, columns):
    return " union all ".join(
        f"""select '{c}' as "column", count({c}) as count, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std,
        round(min({c})::double, 4) as min, round(quantile_cont({c}, 0.25), 4) as p25, round(quantile_cont({c}, 0.5), 4) as p50,
        round(quantile_cont({c}, 0.75), 4) as p75, round(max({c})::double, 4) as max from ({source})"""
        for c in columns
    )


def describe_gaps(spark, d):
    return P.describe(events_gaps(spark, d), ["event_id", "user_id", "value"])


def profile_tabular(spark, d):
    return P.profile_tabular(orders_gaps(spark, d).drop("o_orderkey"))


PROFILE_TABULAR_SQL = f"""
with t as (select o_custkey, o_orderstatus, o_totalprice, o_orderpriority, note from ({ORDERS_GAPS_SQL})),
 s as (select count(*) as n, sum((o_custkey is null)::int + (o_totalprice is null)::int + (o_orderpriority is null)::int + 1)::bigint as k from t)
select n as rows, cast(5 as bigint) as cols, round(k / (n * 5.0::double) * 100, 2) as total_missing_pct,
 (select sum(c - 1)::bigint from (select count(*) as c from t group by o_custkey, o_orderstatus, o_totalprice, o_orderpriority)) as duplicates_exact from s
"""


def profile_columns(spark, d):
    return P.profile_columns(docs(spark, d)).drop("dtype")


def profile_head(spark, d):
    return P.head(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), ["l_orderkey", "l_linenumber"])


def profile_text(spark, d):
    t = table(spark, d, "documents").selectExpr(
        "case when doc_id % 11 = 0 then null when doc_id % 13 = 0 then '' else text end as text"
    )
    return P.profile_text(t)


PROFILE_TEXT_SQL = """
with t as (select case when doc_id % 11 = 0 then null when doc_id % 13 = 0 then '' else text end as text from documents)
select count(*) filter (where text = '') as empty, count(*) filter (where text is null) as "null", round(avg(length(text)), 1) as len_mean,
 min(length(text))::bigint as len_min, max(length(text))::bigint as len_max,
 cast(floor(quantile_cont(length(text), 0.5)) as bigint) as len_p50, cast(floor(quantile_cont(length(text), 0.95)) as bigint) as len_p95
from t
"""


def profile_text_dir(spark, d):
    """The documents as stored text files: path, bytes and words of each."""
    files = table(spark, d, "documents").select(
        F.concat(F.lit("/data/"), "source", F.lit("/"), "doc_id", F.lit(".txt")).alias("path"),
        F.octet_length("text").cast("long").alias("bytes"), word_count("text").cast("long").alias("words"),
    )
    return P.profile_text_dir(files)


PROFILE_TEXT_DIR_SQL = """
with f as (select strlen(text) as bytes, len(regexp_extract_all(text, '\\S+')) as words from documents)
select count(*) as total_files, sum(bytes)::bigint as bytes_total, round(avg(bytes), 0) as bytes_mean, count(*) as count_sampled,
 round(avg(words), 1) as words_mean, min(words) as words_min, max(words) as words_max from f
"""


def _hex(value, width, little):
    """Bytes of an unsigned integer as hex text."""
    text = F.lpad(F.hex(value), width, "0")
    if not little:
        return text
    return F.concat(*[F.substring(text, i, 2) for i in range(width - 1, 0, -2)])


def image_files(spark, d):
    """Documents as PNG headers: width and height follow from the row, folders are languages."""
    png = F.concat(
        F.lit("89504E470D0A1A0A0000000D49484452"), _hex(F.col("n_chars"), 8, False), _hex(F.col("doc_id") % 7 + 1, 8, False),
    )
    name = F.format_string("/data/%s/%07d.%s", "lang", "doc_id", F.when(F.col("doc_id") % 3 > 0, "png").otherwise("PNG"))
    return table(spark, d, "documents").select(name.alias("path"), "n_chars", F.unhex(png).alias("content")).select(
        "path", F.col("n_chars").alias("length"), "content"
    )


def audio_files(spark, d):
    """Events as WAVE headers: the data chunk length follows from the value, folders are event types."""
    size = (F.col("value") * 1000).cast("long")
    wav = F.concat(
        F.lit("52494646"), _hex(size + 36, 8, True), F.lit("57415645666D742010000000010001003F000000"), _hex(F.lit(8000), 8, True),
        F.lit("01000800"), F.lit("64617461"), _hex(size, 8, True),
    )
    name = F.format_string("/data/%s/%08d.wav", "event_type", "event_id")
    return table(spark, d, "events").select(name.alias("path"), (size + 44).alias("length"), F.unhex(wav).alias("content"))


def profile_images(spark, d):
    return media.profile_images(image_files(spark, d)).select(
        "total_files", "bytes_total", "bytes_mean", "bytes_min", "bytes_max", "num_classes", "count_sampled",
        F.col("width_min").cast("long").alias("width_min"), F.col("width_max").cast("long").alias("width_max"), "width_mean",
        F.col("height_min").cast("long").alias("height_min"), F.col("height_max").cast("long").alias("height_max"), "height_mean",
        "unique_sizes",
    )


PROFILE_IMAGES_SQL = """
with f as (select '/data/' || lang || '/' || lpad(cast(doc_id as string), 7, '0') as path, lang, n_chars, doc_id % 7 + 1 as h from documents),
 s as (select * from f)
select count(*) as total_files, sum(n_chars)::bigint as bytes_total, round(avg(n_chars), 0) as bytes_mean, min(n_chars) as bytes_min, max(n_chars) as bytes_max,
 count(distinct lang) as num_classes, any_value(c) as count_sampled, any_value(w0) as width_min, any_value(w1) as width_max, any_value(wm) as width_mean,
 any_value(h0) as height_min, any_value(h1) as height_max, any_value(hm) as height_mean, any_value(u) as unique_sizes
from f, (select count(*) as c, min(n_chars) as w0, max(n_chars) as w1, round(avg(n_chars), 0) as wm, min(h) as h0, max(h) as h1, round(avg(h), 0) as hm,
  count(distinct (n_chars, h)) as u from s)
"""


def profile_audio(spark, d):
    return media.profile_audio(audio_files(spark, d))


PROFILE_AUDIO_SQL = """
with f as (select '/data/' || event_type || '/' || lpad(cast(event_id as string), 8, '0') as path, event_type, cast(trunc(value * 1000) as bigint) as n from events),
 s as (select n / 8000.0::double as x from f)
select count(*) as total_files, sum(n + 44)::bigint as bytes_total, round(avg(n + 44), 0) as bytes_mean, min(n + 44) as bytes_min, max(n + 44) as bytes_max,
 count(distinct event_type) as num_classes, any_value(c) as count_sampled, any_value(a) as seconds_min, any_value(b) as seconds_max, any_value(m) as seconds_mean
from f, (select count(*) as c, round(min(x), 2) as a, round(max(x), 2) as b, round(avg(x), 2) as m from s)
"""


def image_classes(spark, d):
    files = image_files(spark, d)
    return media.class_sizes(files, [".png"]).select("class", "count")


def image_extensions(spark, d):
    return media.extension_sizes(image_files(spark, d), [".png", ".jpg"])


def histogram(spark, d):
    return P.histogram(events_gaps(spark, d), "value", 20)


HISTOGRAM_SQL = f"""
with t as (select value as x from ({EVENTS_GAPS_SQL}) where value is not null), e as (select min(x) as lo, max(x) as hi from t),
 b as (select least(floor((x - lo) / ((hi - lo) / 20)), 19)::bigint as bin, lo, hi from t, e)
select bin, round(any_value(lo + bin * ((hi - lo) / 20)), 4) as left_edge, count(*) as count from b group by bin
"""


def histogram_by(spark, d):
    return P.histogram(events_gaps(spark, d), "value", 15, "event_type")


HISTOGRAM_BY_SQL = f"""
with t as (select event_type, value as x from ({EVENTS_GAPS_SQL}) where value is not null),
 e as (select event_type, min(x) as lo, max(x) as hi from t group by event_type),
 b as (select event_type, least(floor((x - lo) / ((hi - lo) / 15)), 14)::bigint as bin, lo, hi from t join e using (event_type))
select event_type, bin, round(any_value(lo + bin * ((hi - lo) / 15)), 4) as left_edge, count(*) as count from b group by event_type, bin
"""


def top_words(spark, d):
    return P.top_words(spread(docs(spark, d), "doc_id")).withColumn("rank", F.col("rank").cast("long"))


_stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
TOP_WORDS_SQL = f"""
with w as (select label, unnest(list_filter(list_transform(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+'), lambda w: lower(w)),
   lambda w: regexp_full_match(w, '[a-z]+') and w not in ({_stops}))) as word from ({DOCS_SQL}) where label is not null),
 c as (select label, word, count(*) as count from w group by label, word)
select label, word, count, rank from (select *, row_number() over (partition by label order by count desc, word) as rank from c) where rank <= 20
"""


def _before_after(spark, d):
    before = events_gaps(spark, d).selectExpr("event_type", "user_id", "value", "cast(null as string) as note")
    after = events_gaps(spark, d).filter("event_id % 6 > 0 and value is not null").selectExpr(
        "event_type", "user_id", "least(value, 120.0D) as value", "cast(null as string) as note"
    )
    return before, after


def compare(spark, d):
    return M.compare(*_before_after(spark, d))


def _side_sql(name):
    return f"""
 {name}m as (select count(*) as n, count(*) filter (where value is null) as miss from {name}),
 {name}d as (select sum(c - 1)::bigint as k from (select count(*) as c from {name} group by event_type, user_id, value)),
 {name}q as (select quantile_cont(user_id, 0.25) as u1, quantile_cont(user_id, 0.75) as u3, quantile_cont(value, 0.25) as v1, quantile_cont(value, 0.75) as v3 from {name}),
 {name}o as (select count(*) filter (where user_id < u1 - 1.5 * (u3 - u1) or user_id > u3 + 1.5 * (u3 - u1)) as u,
   count(*) filter (where value < v1 - 1.5 * (v3 - v1) or value > v3 + 1.5 * (v3 - v1)) as v from {name}, {name}q),
 {name}s_ as (select 'rows' as metric, n as x from {name}m union all select 'missing_values', miss from {name}m
   union all select 'duplicates', k from {name}d union all select 'outliers_user_id', u from {name}o union all select 'outliers_value', v from {name}o)"""


COMPARE_SQL = f"""
with b as (select event_type, user_id, value, cast(null as string) as note from ({EVENTS_GAPS_SQL})),
 a as (select event_type, user_id, least(value, 120.0::double) as value, cast(null as string) as note from ({EVENTS_GAPS_SQL}) where event_id % 6 > 0 and value is not null),
 {_side_sql("b")}, {_side_sql("a")}
select metric, x0.x as before, x1.x as after, printf('%+d', x1.x - x0.x) as change,
 case when metric = 'rows' or (metric like 'outliers_%' and x0.x <> 0) then printf('%+.1f%%', (x1.x - x0.x) / x0.x::double * 100) else '' end as change_pct
from bs_ x0 join as_ x1 using (metric)
"""


def compare_tables(spark, d):
    t = table(spark, d, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "case when l_partkey % 5 = 0 then null else l_quantity end as l_quantity", "l_extendedprice"
    )
    after = clip_iqr(drop_outliers(impute(t, "mean", ["l_quantity"]), ["l_extendedprice"]), ["l_quantity"])
    return M.compare_tables(t, after)


COMPARE_TABLES_SQL = """
with b as (select l_orderkey, l_linenumber, case when l_partkey % 5 = 0 then null else l_quantity end as l_quantity, l_extendedprice from lineitem),
 i as (select l_orderkey, l_linenumber, coalesce(l_quantity, (select avg(l_quantity) from b)) as l_quantity, l_extendedprice from b),
 q as (select quantile_cont(l_extendedprice, 0.25) as q1, quantile_cont(l_extendedprice, 0.75) as q3 from i),
 k as (select i.* from i, q where l_extendedprice between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)),
 p as (select quantile_cont(l_quantity, 0.25) as q1, quantile_cont(l_quantity, 0.75) as q3 from k),
 a as (select l_orderkey, l_linenumber, least(greatest(l_quantity, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)) as l_quantity, l_extendedprice from k, p),
 bs as (SIDE b), as_ as (SIDE a)
select section, name, stat, bs.v as before, as_.v as after, round(as_.v - bs.v, 4) as delta
from bs full join as_ using (section, name, stat) where section <> 'missing' or bs.v is distinct from as_.v
"""
_side = """select 'table' as section, 'rows' as name, 'count' as stat, count(*)::double as v from {t}
 union all select 'table', 'cols', 'count', 4.0
 union all select 'table', 'missing_pct', 'pct', round(count(*) filter (where l_quantity is null) / (count(*) * 4.0::double) * 100, 3) from {t}
 union all select 'table', 'duplicates', 'count', sum(c - 1)::double from (select count(*) as c from {t} group by l_orderkey, l_linenumber, l_quantity, l_extendedprice)
 union all select 'missing', 'l_quantity', 'nulls', count(*) filter (where l_quantity is null)::double from {t}
""" + "".join(
    f" union all select 'numeric', '{c}', '{s}', round({f}({c})::double, 4) from {{t}}"
    for c in ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    for s, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
)
COMPARE_TABLES_SQL = COMPARE_TABLES_SQL.replace("SIDE b", _side.format(t="b")).replace("SIDE a", _side.format(t="a"))


def _profile_row(t, kind):
    """A nested one-row profile of documents."""
    return t.agg(
        F.struct(F.count(F.lit(1)).alias("rows"), F.lit(5).alias("cols")).alias("shape"),
        F.struct(F.round(F.avg("n_chars"), 2).alias("mean"), F.max("n_chars").alias("max")).alias("length"),
        F.lit(kind).alias("modality"),
        *([F.min("lang").alias("first_lang")] if kind == "text" else []),
    )


def diff_profiles(spark, d):
    t = table(spark, d, "documents")
    return M.diff_profiles(_profile_row(t, "tabular"), _profile_row(t.filter("n_chars < 3000"), "text"))


DIFF_SQL = """
with b as (select count(*) as n, round(avg(n_chars), 2) as m, max(n_chars) as x from documents),
 a as (select count(*) as n, round(avg(n_chars), 2) as m, max(n_chars) as x, min(lang) as l from documents where n_chars < 3000)
select 'shape.rows' as key, b.n::string as before, a.n::string as after from a, b where a.n <> b.n
union all select 'length.mean', b.m::string, a.m::string from a, b where a.m <> b.m
union all select 'length.max', b.x::string, a.x::string from a, b where a.x <> b.x
union all select 'modality', 'tabular', 'text'
union all select 'first_lang', 'N/A', l from a
"""


def fix_summary(spark, d):
    before = orders_gaps(spark, d)
    after = impute(before.filter("o_orderkey % 10 > 0"), "mean", ["o_totalprice"])
    return M.fix_summary(before, after)


FIX_SUMMARY_SQL = f"""
with b as (select *, (o_custkey is null)::int + (o_totalprice is null)::int + (o_orderpriority is null)::int + 1 as k from ({ORDERS_GAPS_SQL})),
 s as (select count(*) as rows_before, count(*) filter (where o_orderkey % 10 > 0) as rows_after, sum(k)::bigint as nulls_before,
   sum(k - (o_totalprice is null)::int) filter (where o_orderkey % 10 > 0)::bigint as nulls_after from b)
select rows_before, rows_after, rows_before - rows_after as rows_removed, 6::bigint as cols_before, 6::bigint as cols_after,
 nulls_before, nulls_after, nulls_before - nulls_after as fixed from s
"""


def distribution_change(spark, d):
    t = docs(spark, d)
    return M.distribution_change(t, dedupe(t, "doc_id", ["text"]), "label")


DISTRIBUTION_SQL = f"""
with t as ({DOCS_SQL}), u as (select * from (select *, row_number() over (partition by text order by doc_id) as r from t) where r = 1)
select label, count(*) as before, coalesce((select count(*) from u where u.label = t.label), 0) as after from t where label is not null group by label
"""

CASES = {
    "describe": (describe, _describe_sql("select * from lineitem", LINE_COLUMNS)),
    "describe_gaps": (describe_gaps, _describe_sql(EVENTS_GAPS_SQL, ["event_id", "user_id", "value"])),
    "profile_tabular": (profile_tabular, PROFILE_TABULAR_SQL),
    "profile_columns": (
        profile_columns,
        f"""with t as ({DOCS_SQL}) select 0::bigint as position, 'doc_id' as "column", 0::bigint as missing, 0.0::double as missing_pct
        union all select 1, 'text', 0, 0 union all select 2, 'label', count(*) filter (where label is null),
        round(count(*) filter (where label is null) / count(*)::double * 100, 2) from t union all select 3, 'source', 0, 0""",
    ),
    "profile_head": (
        profile_head, "select l_orderkey, l_linenumber, l_quantity from lineitem order by l_orderkey, l_linenumber limit 3",
    ),
    "profile_text": (profile_text, PROFILE_TEXT_SQL),
    "profile_text_dir": (profile_text_dir, PROFILE_TEXT_DIR_SQL),
    "profile_images": (profile_images, PROFILE_IMAGES_SQL),
    "profile_audio": (profile_audio, PROFILE_AUDIO_SQL),
    "image_classes": (
        image_classes,
        "select lang as class, count(*) as count from documents group by lang",
    ),
    "image_extensions": (image_extensions, "select '.png' as extension, count(*) as count from documents"),
    "histogram": (histogram, HISTOGRAM_SQL),
    "histogram_by": (histogram_by, HISTOGRAM_BY_SQL),
    "top_words": (top_words, TOP_WORDS_SQL),
    "compare": (compare, COMPARE_SQL),
    "compare_tables": (compare_tables, COMPARE_TABLES_SQL),
    "diff_profiles": (diff_profiles, DIFF_SQL),
    "fix_summary": (fix_summary, FIX_SUMMARY_SQL),
    "distribution_change": (distribution_change, DISTRIBUTION_SQL),
}
