"""Streaming forms: search waves over arriving hits, deduplication, quality counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tilth.operators.combine import catalog_dedupe
from tilth.operators.combine import exclude_ids as without


def read_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    glob: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def run_available(stream: DataFrame, path: str, mode: str = "append") -> None:
    """Write what is available to parquet below ``path`` and stop; reruns continue where it ended."""
    (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", f"{path}/data")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


class _Fresh(StatefulProcessor):
    """Rows of keys that no earlier micro-batch had; the state is one mark a key."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._seen = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803 - names of the interface
        fresh = not self._seen.exists()
        if fresh:
            self._seen.update((True,))
        for part in rows:
            if fresh:
                yield part

    def close(self) -> None:
        pass


#: State on disk and by key, as the keyed state of a stream needs it.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def fresh_rows(stream: DataFrame, key: str) -> DataFrame:
    """Rows of a stream whose ``key`` no earlier micro-batch had; needs the state store of ``STATE_STORE``.

    A micro-batch looks up and marks its own keys alone, so its cost does not grow with
    the keys seen so far.  Rows pass through; those of one key are never held together.
    """
    return stream.groupBy(key).transformWithStateInPandas(_Fresh(), stream.schema, "Append", "None")


def wave_stream(
    hits: DataFrame,
    path: str,
    order: str,
    *,
    rejected: DataFrame | None = None,
    id_col: str = "id",
) -> StreamingQuery:
    """Each micro-batch of hits becomes a wave: ids seen in earlier batches and rejected ids are
    left out, the rest is one catalog row per id.  Gives the finished query.

    Seen ids are keyed state of the stream, so no wave reads what earlier ones wrote.  Waves are
    written under the number of their batch: a repeated batch starts from the same state and
    overwrites itself with the same rows.  Hits without an id are one candidate.
    """
    out = f"{path}/waves"
    spark = hits.sparkSession
    wanted = hits if rejected is None else without(hits, rejected, id_col=id_col)

    def one_wave(batch: DataFrame, number: int) -> None:
        catalog_dedupe(batch, order, id_col).write.mode("overwrite").parquet(f"{out}/batch={number}")

    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        # Columns keep their order, whatever the join did to it.
        query = (
            fresh_rows(wanted.select(hits.columns), id_col).writeStream.foreachBatch(one_wave)
            .option("checkpointLocation", f"{path}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)
    return query


def with_time(df: DataFrame, time_col: str) -> DataFrame:
    """Event time as a timestamp with zone, as watermarks need it."""
    return df.withColumn(time_col, F.col(time_col).cast("timestamp"))


def dedupe_stream(
    stream: DataFrame, keys: list[str], time_col: str, delay: str = "1 hour"
) -> DataFrame:
    """First row per key; state of keys older than ``delay`` behind the newest row is released."""
    return with_time(stream, time_col).withWatermark(time_col, delay).dropDuplicatesWithinWatermark(keys)


def quality_stream(
    df: DataFrame,
    time_col: str,
    value_col: str,
    *,
    window: str = "1 day",
    delay: str | None = None,
    below: float | None = None,
) -> DataFrame:
    """Rows, missing and flagged values per event-time window; the same plan for batch and stream."""
    timed = with_time(df, time_col)
    source = timed.withWatermark(time_col, delay) if delay and df.isStreaming else timed
    flagged = F.lit(False) if below is None else F.coalesce(F.col(value_col) < below, F.lit(False))
    return (
        source.groupBy(F.window(time_col, window).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col(value_col).isNull()).alias("missing"),
            F.count_if(flagged).alias("flagged"),
        )
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                "rows", "missing", "flagged")
    )
