"""Streams over the append-only event log: de-duplicated dispatch, windowed counts with late data, stalled jobs."""

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout


def event_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An append-only folder of event files as a stream; ts without zone is taken as UTC, as watermarks need."""
    raw = spark.readStream.schema(schema).parquet(path)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def deduplicated(events: DataFrame, key: str, delay: str) -> DataFrame:
    """Each event once, also where it is delivered again within the delay; state older than the watermark is dropped."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])


def window_counts(events: DataFrame, length: str, delay: str | None = None, slide: str | None = None) -> DataFrame:
    """(window_start, event_type, n_events, total) of each window; a stream drops what comes later than delay after its time."""
    events = events.withWatermark("ts", delay) if delay else events
    window = F.window("ts", length, slide) if slide else F.window("ts", length)
    return events.groupBy(window.alias("w"), "event_type").agg(F.count("*").alias("n_events"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "n_events", "total")


def sessions(events: DataFrame, gap: str, delay: str | None = None) -> DataFrame:
    """(user_id, session_start, session_end, n_events): events of a user less than gap apart."""
    events = events.withWatermark("ts", delay) if delay else events
    return events.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n_events")).select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n_events")


def stalled(beats: DataFrame, key: str, now, timeout: str) -> DataFrame:
    """Keys whose last heartbeat is older than timeout at a given time, with status retry_wait: the batch form."""
    last = beats.groupBy(key).agg(F.max("ts").alias("last_beat"))
    return last.filter(F.col("last_beat") < F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {timeout}")).withColumn("status", F.lit("retry_wait"))


def stalled_stream(beats: DataFrame, key: str, timeout_ms: int, delay: str) -> DataFrame:
    """Emits (key, last_beat, status) once a key's watermark has passed its last heartbeat by timeout: the streaming form."""

    def watch(keys, frames, state):
        if state.hasTimedOut:
            last = state.get[0]
            state.remove()
            yield pd.DataFrame({key: [keys[0]], "last_beat": [pd.Timestamp(last, unit="us")], "status": ["retry_wait"]})
            return
        last = state.get[0] if state.exists else 0
        for frame in frames:
            last = max(last, int(frame["ts"].max().value // 1000))
        state.update((last,))
        state.setTimeoutTimestamp(max(last // 1000 + timeout_ms, state.getCurrentWatermarkMs() + 1))

    kind = dict(beats.dtypes)[key]
    return beats.withWatermark("ts", delay).select(key, "ts").groupBy(key).applyInPandasWithState(watch, f"`{key}` {kind}, last_beat timestamp, status string", "last_us long", "append", GroupStateTimeout.EventTimeTimeout)


def dispatch(events: DataFrame, send: Callable[[DataFrame, int], None], checkpoint: str):
    """Starts a query that hands each micro-batch to send once it is stored; a batch may come again after a failure, with the same number."""
    return events.writeStream.foreachBatch(send).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
