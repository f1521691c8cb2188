"""The planted outliers are told apart whatever the ids of the rows are."""

from __future__ import annotations

from pyspark.sql import functions as F

from workload import detect


def test_planted_rows_are_found_in_tables_of_shifted_copies(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    shift = F.col("k") * 1_000_000_000
    copies = spark.range(6).select(F.col("id").alias("k"))
    events.crossJoin(copies).select((F.col("event_id") + shift).alias("event_id"), (F.col("user_id") + shift).alias("user_id"), "value").write.parquet(f"{tmp_path}/events.parquet")
    found = {r["id"] for r in detect.isolation_forest(spark, str(tmp_path)).collect()}
    assert found == {i + k * 1_000_000_000 for i in range(7, 10_000, 50) for k in range(6)}
