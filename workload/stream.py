"""Streaming forms, run to completion over what is available."""

from __future__ import annotations

from pyspark.sql import functions as F

from tilth.functions.store import new_path
from tilth.streaming import streams as S
from workload.base import EVENTS_GAPS, EVENTS_GAPS_SQL, HITS, HITS_SQL, table


def _events(spark, d):
    return S.read_stream(spark, d, table(spark, d, "events").schema, "events.parquet")


def wave_stream(spark, d):
    """All hits as waves; candidates labelled as rejected are left out."""
    path = new_path(spark, "waves")
    hits = _events(spark, d).selectExpr(*HITS).select("id", "pos", F.array("query").alias("matched_queries"))
    rejected = table(spark, d, "nation").filter("n_nationkey % 3 = 0").select(F.col("n_nationkey").cast("string").alias("id"))
    S.wave_stream(hits, path, "pos", rejected=rejected)
    return spark.read.parquet(f"{path}/waves").select("id", "query_match_count")


def dedupe_stream(spark, d):
    """First event per day, user and type: repeats lie within a day, after which a key's state is released."""
    path = new_path(spark, "dedupe")
    events = _events(spark, d).select("ts", F.to_date("ts").alias("day"), "user_id", "event_type")
    unique = S.dedupe_stream(events, ["day", "user_id", "event_type"], "ts", "1 day")
    S.run_available(unique, path)
    return spark.read.parquet(f"{path}/data").select("day", "user_id", "event_type")


def _quality(df):
    return S.quality_stream(df, "ts", "value", window="1 day", below=1.0)


def quality_batch(spark, d):
    return _quality(table(spark, d, "events").selectExpr(*EVENTS_GAPS))


def quality_stream(spark, d):
    """Finished windows of the stream: those that end before the last event less the delay."""
    path = new_path(spark, "quality")
    stream = _events(spark, d).selectExpr(*EVENTS_GAPS)
    S.run_available(S.quality_stream(stream, "ts", "value", window="1 day", delay="1 hour", below=1.0), path)
    return spark.read.parquet(f"{path}/data")


QUALITY_SQL = f"""
select date_trunc('day', ts)::timestamp as window_start, date_trunc('day', ts)::timestamp + interval 1 day as window_end, count(*) as rows,
 count(*) filter (where value is null) as missing, count(*) filter (where value < 1) as flagged from ({EVENTS_GAPS_SQL}) group by 1
"""

CASES = {
    "wave_stream": (
        wave_stream,
        f"select id, count(distinct query) as query_match_count from ({HITS_SQL}) where id not in (select cast(n_nationkey as string) from nation where n_nationkey % 3 = 0) group by id",
    ),
    "dedupe_stream": (dedupe_stream, "select distinct ts::date as day, user_id, event_type from events"),
    "quality_windows": (quality_batch, QUALITY_SQL),
    "quality_stream": (
        quality_stream,
        f"select * from ({QUALITY_SQL}) where window_end <= (select max(ts) - interval 1 hour from events)",
    ),
}
