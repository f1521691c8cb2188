"""Tables and derived inputs shared by the queries; each derived input exists as DataFrame and SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tilth.functions.store import spread

# A fixed stamp, so that results do not depend on when a query runs.
STAMP = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
STAMP_SQL = "timestamp '2024-01-01 00:00:00'"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread_table(spark: SparkSession, folder: str, name: str, key: str) -> DataFrame:
    """A table for work that is heavy per row: small files are spread over all cores."""
    return spread(table(spark, folder, name), key)


# Orders with gaps: the same expressions run in Spark and in the oracle.
ORDERS_GAPS = [
    "o_orderkey",
    "case when o_orderkey % 13 = 0 then null else o_custkey end as o_custkey",
    "o_orderstatus",
    "case when o_orderkey % 7 = 0 then null else o_totalprice end as o_totalprice",
    "case when o_orderkey % 11 = 0 then null else o_orderpriority end as o_orderpriority",
    "cast(null as string) as note",
]
ORDERS_GAPS_SQL = f"select {', '.join(ORDERS_GAPS)} from orders"


def orders_gaps(spark, d):
    return table(spark, d, "orders").selectExpr(*ORDERS_GAPS)


EVENTS_GAPS = [
    "event_id",
    "ts",
    "user_id",
    "event_type",
    "case when event_id % 5 < 2 or event_id < 40 then null else value end as value",
]
EVENTS_GAPS_SQL = f"select {', '.join(EVENTS_GAPS)} from events"


def events_gaps(spark, d):
    return table(spark, d, "events").selectExpr(*EVENTS_GAPS)


# Labelled documents: quality as the machine label, toxic as the human one.
LABELLED = [
    "doc_id",
    "text",
    "lang",
    "source",
    "cast(quality as string) as label",
    "cast(toxic as string) as human_label",
    "cast(doc_id % 100 as double) / 100 as confidence",
    "cast(doc_id % 100 as double) / 100 < 0.75 as flagged_for_review",
]
LABELLED_SQL = f"select {', '.join(LABELLED)} from documents join labels using (doc_id)"


def labelled(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    return docs.join(labels, "doc_id").selectExpr(*LABELLED)


# Documents under the unified names, label with gaps.
DOCS = [
    "doc_id",
    "text",
    "case when doc_id % 11 = 0 then null else lang end as label",
    "source",
]
DOCS_SQL = f"select {', '.join(DOCS)} from documents"


def docs(spark, d):
    return table(spark, d, "documents").selectExpr(*DOCS)


# Search hits: every event is a hit of the query named by its type on the candidate user_id.
HITS = ["cast(user_id as string) as id", "event_type as query", "event_id as pos", "value as score"]
HITS_SQL = f"select {', '.join(HITS)} from events"


def hits(spark, d):
    return table(spark, d, "events").selectExpr(*HITS)


# Verdicts on documents: kept when the label says good quality.
def candidates(spark, d):
    return table(spark, d, "documents").selectExpr("doc_id as id", "text as corpus_text", "lang", "n_chars")


def verdicts(spark, d):
    return table(spark, d, "labels").selectExpr(
        "doc_id as id", "quality = 1 as keep", "concat('toxic ', cast(toxic as string)) as summary"
    )


VERDICTS_SQL = "select doc_id as id, quality = 1 as keep, concat('toxic ', cast(toxic as string)) as summary from labels"


def ranks(spark, d):
    return table(spark, d, "labels").filter("quality = 1 and doc_id % 3 > 0").selectExpr(
        "doc_id as id", "(doc_id * 7919) % 10007 as rank", "cast(doc_id % 10 as int) as score",
        "concat('doc ', cast(doc_id as string)) as one_line",
    )


RANKS_SQL = """select doc_id as id, (doc_id * 7919) % 10007 as rank, cast(doc_id % 10 as int) as score,
 concat('doc ', cast(doc_id as string)) as one_line from labels where quality = 1 and doc_id % 3 > 0"""


def md5_sql(seed, *cols):
    """The hash order used for sampling, in the oracle's dialect."""
    parts = " || '|' || ".join(f"cast({c} as string)" for c in cols)
    return f"md5('{seed}|' || {parts})"
