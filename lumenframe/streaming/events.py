"""Structured Streaming twins: event-time windows, sessions, latest state and deduplication, replayed with a checkpoint.

A stream is read from a folder of Parquet files. ``replay`` takes all files that are there and ends; the same calls with
another trigger run on. A row later than the watermark's delay is dropped, so a replay of an unordered table needs a delay
that covers its disorder.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..sources import files, sinks

DELAY = "40 days"


def stream(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet file or folder as a stream, times taken as UTC. The path is given as a pattern: only then may it be one file."""
    return files.utc(spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[{path[-1]}]"))


def windowed(df: DataFrame, window: Column, keys: list[str], aggs: list[Column], delay: str = DELAY) -> DataFrame:
    """Aggregates by an event-time window (tumbling, sliding or session) and keys."""
    return df.withWatermark("ts", delay).groupBy(window.alias("w"), *keys).agg(*aggs)


def closed(df: DataFrame, ts: str) -> DataFrame:
    """A stream with a closing row: null but for a time far ahead, after which all windows of a replay are final. It is one file read
    with the others, so it is for replays that take all files in one batch; a stream that runs on needs no closing row."""
    spark = df.sparkSession
    kind = df.schema[ts].dataType.simpleString()
    path = sinks.shared(spark, "closing")
    spark.range(1).select(*(F.lit("9999-01-01").cast(kind).alias(c.name) if c.name == ts else F.lit(None).cast(c.dataType).alias(c.name) for c in df.schema)).coalesce(1).write.parquet(path)
    return df.union(spark.readStream.schema(df.schema).parquet(path))


def latest(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """The newest row of each key, for update mode."""
    return df.groupBy(*keys).agg(F.max(F.struct(*order, *values)).alias("x"))


def deduplicated(df: DataFrame, keys: list[str], delay: str = DELAY) -> DataFrame:
    """The first row of each key within the watermark's delay."""
    return df.withWatermark("ts", delay).dropDuplicatesWithinWatermark(keys)


def trailing(df: DataFrame, size: int) -> DataFrame:
    """Mean of each user's last ``size`` values by time and id, for update mode; the state is those rows and a count."""

    def step(key, frames, state):
        kept, n = (list(map(tuple, state.get[0])), state.get[1]) if state.exists else ([], 0)
        for frame in frames:
            n += len(frame)
            kept = sorted([*kept, *zip(frame["t"].tolist(), frame["event_id"].tolist(), frame["value"].tolist(), strict=True)])[-size:]
        state.update((kept, n))
        yield pd.DataFrame({"user_id": [key[0]], "mean": [sum(x[2] for x in kept) / len(kept)], "n": [n], "last_us": [kept[-1][0]]})

    rows = df.filter("user_id is not null and value is not null").select("user_id", F.unix_micros("ts").alias("t"), "event_id", "value")
    return rows.groupBy("user_id").applyInPandasWithState(step, "user_id long, mean double, n long, last_us long", "kept array<struct<t:bigint,event_id:bigint,value:double>>, n long", "update", GroupStateTimeout.NoTimeout)


def replay(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Run a stream over all that is there and read its result.

    With ``keys`` in update mode: each batch writes the keys it changed under its own number, so that a repeated batch
    overwrites its rows, and the last number of a key wins. Without: append mode to a Parquet sink.
    """
    spark = df.sparkSession
    path, state = sinks.shared(spark, "stream"), sinks.shared(spark, "stream-state")
    writer = df.writeStream.option("checkpointLocation", state).trigger(availableNow=True)
    if keys is None:
        writer.format("parquet").option("path", path).outputMode("append").start().awaitTermination()
        return spark.read.schema(df.schema).parquet(path)

    def save(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    writer.outputMode("update").foreachBatch(save).start().awaitTermination()
    rest = [c for c in df.columns if c not in keys]
    last = spark.read.parquet(path).groupBy(*keys).agg(F.max(F.struct("batch", *rest)).alias("_x"))
    return last.select(*keys, *(f"_x.{c}" for c in rest))
