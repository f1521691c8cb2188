"""Sources, schema mapping and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tilth.functions.store import new_path
from tilth.sources import collect as C
from tilth.sources import readers as R
from tilth.sources import writers as K
from tilth.sources.pages import extract_html
from workload.base import (
    DOCS_SQL, LABELLED_SQL, STAMP, STAMP_SQL, docs, labelled, spread_table, table,
)

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
ORDERS_SQL = f"select {', '.join(ORDER_COLUMNS)} from orders"


def _round_trip(suffix, schema=None):
    def run(spark, d):
        path = new_path(spark, "orders")
        K.write_any(table(spark, d, "orders").select(*ORDER_COLUMNS), path, suffix=suffix)
        back = R.read_any(spark, path, suffix=suffix, schema=schema).select(*ORDER_COLUMNS)
        return back.withColumns({c: F.col(c).cast("long") for c in ("o_orderkey", "o_custkey")})

    return run


def load_dataset(spark, d):
    return C.load_dataset(table(spark, d, "documents"), "documents", collected_at=STAMP)


def load_dataset_mapped(spark, d):
    return C.load_dataset(
        table(spark, d, "conversations"), "chats", origin="kaggle", text_col="text", label_col="role",
        collected_at=STAMP,
    )


def to_unified(spark, d):
    joined = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    source = joined.select("text", F.col("quality").alias("label"))
    return C.to_unified(source, {"0": "poor", "1": "good"})


def union_splits(spark, d):
    t = table(spark, d, "documents").select("doc_id", "lang")
    return C.union_splits(
        {
            "train": t.filter("lang = 'en'"),
            "validation": t.filter("lang = 'fr'"),
            "test": t.filter("lang not in ('en', 'fr')"),
        }
    )


def news_to_unified(spark, d):
    raw = table(spark, d, "orders").selectExpr(
        "concat('order ', cast(o_orderkey as string)) as title",
        "case when o_orderkey % 11 = 0 then null else o_orderpriority end as topic",
        "o_orderdate as published_date",
    )
    return C.news_to_unified(raw, "news").select("text", "label", "source", "collected_at")


def flatten_api(spark, d):
    body = F.concat(F.lit('{"id":'), F.col("event_id"), F.lit(',"meta":'), F.col("props"), F.lit("}"))
    shape = F.col("event_id") % 3
    bodies = table(spark, d, "events").select(
        F.when(shape == 0, F.concat(F.lit('{"results":['), body, F.lit("]}")))
        .when(shape == 1, F.concat(F.lit("["), body, F.lit("]")))
        .otherwise(body)
        .alias("body")
    )
    flat = C.flatten_api(bodies, "body", "struct<id: bigint, meta: struct<k: bigint>>", "events", collected_at=STAMP)
    return flat.select("id", F.col("`meta.k`").alias("meta_k"), "text", "source")


def html_items(spark, d):
    return extract_html(spread_table(spark, d, "pages", "page_id"), "li", collected_at=STAMP).select(
        "text", "source", F.col("position").cast("long")
    )


def html_paragraphs(spark, d):
    return extract_html(spread_table(spark, d, "pages", "page_id"), "p", collected_at=STAMP)


HTML_ITEMS_SQL = """
with found as (
  select url, regexp_extract_all(html, '<li>(.*?)</li>', 1) as items from pages
), flat as (
  select url, unnest(items) as item, generate_subscripts(items, 1) - 1 as position from found
)
select replace(replace(replace(replace(replace(
         regexp_replace(regexp_replace(item, '<[^>]*>', '', 'g'), '^\\s+|\\s+$', '', 'g'),
       '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&amp;', '&') as text,
       'scrape:' || url as source, position
from flat where regexp_replace(regexp_replace(item, '<[^>]*>', '', 'g'), '^\\s+|\\s+$', '', 'g') <> ''
"""


def _hub_rows(spark, d):
    return table(spark, d, "documents").select(
        F.when(F.col("doc_id") % 50 > 0, F.concat("source", F.lit("/d"), F.col("doc_id"))).alias("id"),
        F.when(F.col("doc_id") % 9 > 0, F.col("text")).alias("description"),
        F.array("lang", F.concat(F.lit("source:"), "source")).alias("tags"),
        F.when(F.col("doc_id") % 4 > 0, F.array(F.lit("cc"), F.lit("by"))).alias("license"),
        F.array(F.lit("text-classification")).alias("task_categories"),
        F.array().cast("array<string>").alias("task_ids"),
        F.array(F.lit("n<1K")).alias("size_categories"),
        F.array("lang").alias("language"),
        F.col("source").alias("pretty_name"),
        F.struct(
            F.when(F.col("doc_id") % 3 > 0, F.col("n_chars")).alias("dataset_size"),
            (F.col("n_chars") * 2).alias("size_in_bytes"),
        ).alias("dataset_info"),
        F.col("n_chars").alias("downloads"),
        F.lit(None).cast("long").alias("likes"),
        F.when(F.col("doc_id") % 5 > 0, F.lit("2024-03-04T05:06:07Z")).alias("last_modified"),
        F.col("lang").alias("query"),
    )


def catalog_from_hub(spark, d):
    return C.catalog_from_hub(_hub_rows(spark, d)).select(
        "id", "name", "description", F.length("corpus_text").cast("long").alias("corpus_chars"),
        "downloads", "likes", F.array_join("tags", ",").alias("tags"), "license", "size_kb", "last_updated",
        "platform", "url",
    )


CATALOG_FROM_HUB_SQL = """
select source || '/d' || doc_id as id, 'd' || doc_id as name,
  case when doc_id % 9 > 0 then text else '' end as description,
  cast(length(source || '/d' || doc_id) + length(case when doc_id % 9 > 0 then text else '' end)
    + length(lang || ' source:' || source) + case when doc_id % 4 > 0 then 5 else 0 end
    + 19 + 0 + length(source) + 6 as bigint) as corpus_chars,
  n_chars as downloads, cast(0 as bigint) as likes, lang || ',source:' || source as tags,
  case when doc_id % 4 > 0 then 'cc by' else 'unknown' end as license,
  round(nullif(case when doc_id % 3 > 0 then n_chars else n_chars * 2 end, 0) / 1024.0::double, 1) as size_kb,
  case when doc_id % 5 > 0 then '2024-03-04' else 'unknown' end as last_updated,
  'huggingface' as platform, 'https://huggingface.co/datasets/' || source || '/d' || doc_id as url
from documents where doc_id % 50 > 0
"""


def listing_rows(spark, d):
    key = F.col("p_partkey")
    return table(spark, d, "part").select(
        F.when(key % 40 > 0, F.concat(F.lit("owner/p"), key)).otherwise(F.lit(" ")).alias("ref"),
        F.col("p_name").alias("title"),
        F.concat(F.lit(" "), "p_type", F.lit(" part")).alias("subtitle"),
        F.concat("p_brand", F.lit(", "), "p_type", F.lit(",, ")).alias("tags"),
        F.when(key % 3 > 0, F.concat(F.col("p_size"), F.lit("KB"))).otherwise("").alias("size"),
        F.when(key % 7 == 0, "").when(key % 7 == 1, "n/a")
        .otherwise(F.format_string("%,d", key * 37)).alias("downloadCount"),
        F.col("p_partkey").cast("string").alias("totalBytes"),
        F.col("p_size").cast("string").alias("voteCount"),
        F.lit("CC0").alias("licenseName"),
        F.when(key % 2 == 0, "").otherwise("2024-05-06 07:08:09").alias("lastUpdated"),
        F.lit("2023-01-02 03:04:05").alias("creationDate"),
        F.lit("parts").alias("query"),
    )


def catalog_from_listing(spark, d):
    return C.catalog_from_listing(listing_rows(spark, d)).select(
        "id", "name", "description", "corpus_text", "downloads", "likes",
        F.array_join("tags", ",").alias("tags"), F.array_join("size_categories", ",").alias("sizes"),
        "license", "last_updated", "platform", "url",
    )


LISTING_SQL = """
select 'kaggle:owner/p' || p_partkey as id, p_name as name, p_type || ' part' as description,
  'owner/p' || p_partkey || ' ' || p_name || ' ' || p_type || ' part ' || p_brand || ' ' || p_type || ' CC0' as corpus_text,
  cast(case when p_partkey % 7 = 0 then p_partkey when p_partkey % 7 = 1 then 0 else p_partkey * 37 end as bigint) as downloads,
  cast(p_size as bigint) as likes, p_brand || ',' || p_type as tags,
  case when p_partkey % 3 > 0 then p_size || 'KB' else '' end as sizes, 'CC0' as license,
  case when p_partkey % 2 = 0 then '2023-01-02' else '2024-05-06' end as last_updated, 'kaggle' as platform,
  'https://www.kaggle.com/datasets/owner/p' || p_partkey as url
from part where p_partkey % 40 > 0
"""


def _stored_listing(spark, d):
    """The documents as a stored listing of files: path and length."""
    suffix = F.element_at(F.array(*[F.lit(s) for s in (".csv", ".PNG", ".wav", ".md")]), (F.col("doc_id") % 4 + 1).cast("int"))
    path = F.concat(F.lit("/data/"), "source", F.lit("/"), "doc_id", suffix)
    return table(spark, d, "documents").select(path.alias("path"), F.col("n_chars").alias("length"))


def files_inventory(spark, d):
    return R.stored_files(_stored_listing(spark, d), [".png", ".CSV"])


FILES_INVENTORY_SQL = """
select '/data/' || source || '/' || doc_id || case doc_id % 4 when 0 then '.csv' else '.PNG' end as path, n_chars as length,
  case doc_id % 4 when 0 then '.csv' else '.png' end as extension, source as class
from documents where doc_id % 4 < 2
"""


def detect_modality(spark, d):
    return R.detect_modality(R.stored_files(_stored_listing(spark, d)))


DETECT_MODALITY_SQL = "select case when count(*) filter (where doc_id % 4 = 1) > 0 then 'image' when count(*) filter (where doc_id % 4 = 2) > 0 then 'audio' else 'text' end as modality from documents"


def file_modality(spark, d):
    suffix = F.element_at(F.array(*[F.lit(s) for s in (".csv", ".PNG", ".wav", ".md")]), (F.col("doc_id") % 4 + 1).cast("int"))
    paths = table(spark, d, "documents").select("doc_id", F.concat("source", F.lit("/"), "doc_id", suffix).alias("path"))
    return paths.select("doc_id", R.file_modality("path").alias("modality"))


def _text_files(spark, d):
    """Documents written as text files below one folder per source; more documents make more files, not larger ones."""
    path = new_path(spark, "texts")
    texts = table(spark, d, "documents").select("source", "text")
    texts.write.option("maxRecordsPerFile", 1000).partitionBy("source").text(path)
    return R.read_text_dir(spark, path)


def read_text_dir(spark, d):
    source = F.regexp_extract("path", "source=([^/]+)/", 1)
    return (
        _text_files(spark, d)
        .groupBy(F.url_decode(source).alias("source"))
        .agg(F.sum("bytes").alias("bytes"), F.sum("words").alias("words"))
    )


def read_ids(spark, d):
    path = new_path(spark, "ids")
    raw = table(spark, d, "documents").select(F.concat(F.lit(" "), F.col("doc_id"), F.lit(" ")).alias("id"))
    K.write_id_set(raw.union(raw), path)
    return R.read_id_set(spark, path)


def sample_rows(spark, d):
    return R.sample_rows(table(spark, d, "documents"), "source", "doc_id", 15).select("source", "doc_id")


def sample_json(spark, d):
    out = R.sample_json(table(spark, d, "documents"), "source", "doc_id", ["doc_id", "lang"], 15, 3000)
    return out.select("source", "n", "samples")


SAMPLE_JSON_SQL = """
with t as (select *, row_number() over (partition by source order by doc_id) as r from documents)
select source, count(*) as n,
  substr('[' || string_agg('{"doc_id":' || doc_id || ',"lang":"' || lang || '"}', ',' order by doc_id) || ']', 1, 3000) as samples
from t where r <= 15 group by source
"""


def conform(spark, d):
    return C.conform(docs(spark, d))


def merge_sources(spark, d):
    return C.merge(
        [
            C.load_dataset(table(spark, d, "documents"), "documents", label_col="lang", collected_at=STAMP),
            C.load_dataset(table(spark, d, "conversations"), "chats", text_col="text", label_col="role", collected_at=STAMP),
            C.load_dataset(table(spark, d, "benchmark"), "benchmark", collected_at=STAMP),
        ]
    )


MERGE_SQL = f"""
select text, cast(null as string) as audio, cast(null as string) as image, lang as label, 'hf:documents' as source, {STAMP_SQL} as collected_at from documents
union all select text, null, null, role, 'hf:chats', {STAMP_SQL} from conversations
union all select text, null, null, null, 'hf:benchmark', {STAMP_SQL} from benchmark
"""


def normalize_labels(spark, d):
    t = table(spark, d, "labels").selectExpr(
        "doc_id", "case when doc_id % 11 = 0 then null else cast(quality as string) end as label",
        "case when doc_id % 2 = 0 then 'a' else 'b' end as source",
    )
    return C.normalize_labels(
        t, {"0": "poor", "1": "good"}, ["good", "poor"], by_source={"b": {"0": "unclear", "1": "good"}}
    )


NORMALIZE_SQL = """
with t as (select doc_id, case when doc_id % 11 = 0 then null else quality end as q,
  case when doc_id % 2 = 0 then 'a' else 'b' end as source from labels)
select doc_id, case when q = 1 then 'good' when q = 0 then 'poor' end as label, source
from t where q is null or not (q = 0 and source = 'b')
"""


def drop_incomplete(spark, d):
    return C.drop_incomplete(docs(spark, d)).select("doc_id", "label")


def known_labels(spark, d):
    return C.known_labels(docs(spark, d), ["en", "de"]).select("doc_id", "label")


def null_sentinels(spark, d):
    t = table(spark, d, "part").selectExpr(
        "p_partkey",
        "case when p_partkey % 3 = 0 then '?' when p_partkey % 3 = 1 then 'N/A' else p_type end as p_type",
        "case when p_partkey % 5 = 0 then '-' else p_name end as p_name",
    )
    return C.null_sentinels(t, ["?", "N/A", "-"])


def labeling_tasks(spark, d):
    t = labelled(spark, d).withColumn("label", F.expr("case when doc_id % 6 = 0 then null else label end"))
    tasks = K.labeling_tasks(t, "doc_id")
    path = new_path(spark, "tasks")
    K.write_tasks(tasks, path)
    first = F.col("predictions")[0]
    return R.read_any(spark, path, suffix=".jsonl", schema=tasks.schema).select(
        "id",
        F.length("data.text").cast("long").alias("chars"),
        F.col("meta.confidence").alias("confidence"),
        F.col("meta.flagged_for_review").alias("flagged"),
        first["model_version"].alias("model_version"),
        first["result"][0]["id"].alias("result_id"),
        first["result"][0]["value"]["choices"][0].alias("choice"),
        first["result"][0]["from_name"].alias("from_name"),
    )


LABELING_TASKS_SQL = f"""
with t as ({LABELLED_SQL}), u as (select *, doc_id % 6 <> 0 as has from t)
select doc_id as id, cast(length(text) as bigint) as chars, confidence, flagged_for_review as flagged,
  case when has then 'annotation_agent_v1' end as model_version,
  case when has then 'result_' || doc_id end as result_id,
  case when has then label end as choice,
  case when has then 'sentiment' end as from_name
from u
"""


def review_queue(spark, d):
    return K.review_queue(labelled(spark, d)).select("doc_id", "label", "confidence")


def report_json(spark, d):
    t = table(spark, d, "nation").selectExpr("n_nationkey as k", "case when n_nationkey % 4 = 0 then null else concat('é', n_name) end as v")
    return K.report_json(t)


CASES = {
    "read_csv": (_round_trip(".csv"), ORDERS_SQL),
    "read_parquet": (_round_trip(".parquet"), ORDERS_SQL),
    "read_json_lines": (
        _round_trip(".jsonl", "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"),
        ORDERS_SQL,
    ),
    "load_dataset": (
        load_dataset,
        f"select text, cast(null as string) as label, 'hf:documents' as source, {STAMP_SQL} as collected_at from documents",
    ),
    "load_dataset_mapped": (
        load_dataset_mapped,
        f"select text, role as label, 'kaggle:chats' as source, {STAMP_SQL} as collected_at from conversations",
    ),
    "to_unified": (
        to_unified,
        "select text, case quality when 1 then 'good' else 'poor' end as label from documents join labels using (doc_id)",
    ),
    "union_splits": (
        union_splits,
        "select doc_id, lang, case lang when 'en' then 'train' when 'fr' then 'validation' else 'test' end as split from documents",
    ),
    "news_to_unified": (
        news_to_unified,
        """select 'order ' || o_orderkey as text, o_orderpriority as label, 'news' as source,
        strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') as collected_at from orders where o_orderkey % 11 <> 0""",
    ),
    "flatten_api": (
        flatten_api,
        """select event_id as id, cast(json_extract_string(props, '$.k') as bigint) as meta_k,
        cast(event_id as string) as text, 'api:events' as source from events""",
    ),
    "extract_html_items": (html_items, HTML_ITEMS_SQL),
    "extract_html_paragraphs": (html_paragraphs, None),
    "catalog_from_hub": (catalog_from_hub, CATALOG_FROM_HUB_SQL),
    "catalog_from_listing": (catalog_from_listing, LISTING_SQL),
    "files_inventory": (files_inventory, FILES_INVENTORY_SQL),
    "detect_modality": (detect_modality, DETECT_MODALITY_SQL),
    "file_modality": (
        file_modality,
        """select doc_id, case doc_id % 4 when 0 then 'tabular' when 1 then 'image' when 2 then 'audio' else 'text' end as modality
        from documents""",
    ),
    "read_text_dir": (
        read_text_dir,
        """select source, cast(sum(strlen(text) + 1) as bigint) as bytes,
        cast(sum(len(regexp_extract_all(text, '\\S+'))) as bigint) as words from documents group by source""",
    ),
    "read_id_set": (read_ids, "select distinct cast(doc_id as string) as id from documents"),
    "sample_rows": (
        sample_rows,
        """select source, doc_id from (select *, row_number() over (partition by source order by doc_id) as r from documents)
        where r <= 15""",
    ),
    "sample_json": (sample_json, SAMPLE_JSON_SQL),
    "conform": (
        conform,
        f"""select text, cast(null as string) as audio, cast(null as string) as image, label, source,
        cast(null as timestamp) as collected_at from ({DOCS_SQL})""",
    ),
    "merge_sources": (merge_sources, MERGE_SQL),
    "normalize_labels": (normalize_labels, NORMALIZE_SQL),
    "drop_incomplete": (
        drop_incomplete, f"select doc_id, label from ({DOCS_SQL}) where text is not null and label is not null",
    ),
    "known_labels": (known_labels, f"select doc_id, label from ({DOCS_SQL}) where label in ('en', 'de')"),
    "null_sentinels": (
        null_sentinels,
        """select p_partkey, case when p_partkey % 3 = 2 then p_type end as p_type,
        case when p_partkey % 5 <> 0 then p_name end as p_name from part""",
    ),
    "labeling_tasks": (labeling_tasks, LABELING_TASKS_SQL),
    "review_queue": (
        review_queue, f"select doc_id, label, confidence from ({LABELLED_SQL}) where flagged_for_review",
    ),
    "report_json": (
        report_json,
        """select '{"k":' || n_nationkey || ',"v":' || case when n_nationkey % 4 = 0 then 'null' else '"é' || n_name || '"' end || '}' as report
        from nation""",
    ),
}
