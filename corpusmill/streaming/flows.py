"""Structured Streaming forms of the batch operators; every flow also runs on a batch DataFrame where Spark allows it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def daily_volume(events: DataFrame, key: str, at: str = "ts", late: str = "1 day") -> DataFrame:
    """Rows of each key and day; rows later than `late` behind the newest are dropped in a stream."""
    rows = events.withWatermark(at, late) if events.isStreaming else events
    return rows.groupBy(F.window(at, "1 day"), key).agg(F.count("*").alias("n")).select(key, F.to_date("window.start").alias("day"), "n")


def sliding_mean(events: DataFrame, key: str, value: str, at: str = "ts", span: str = "14 days", step: str = "1 day", late: str = "1 day") -> DataFrame:
    rows = events.withWatermark(at, late) if events.isStreaming else events
    return rows.groupBy(F.window(at, span, step), key).agg(F.avg(value).alias("mean"), F.count("*").alias("n")).select(key, F.col("window.end").alias("until"), "mean", "n")


def sessions(events: DataFrame, key: str, at: str = "ts", gap: str = "6 hours", late: str = "1 day") -> DataFrame:
    """Runs of rows of a key without a longer gap."""
    rows = events.withWatermark(at, late) if events.isStreaming else events
    return rows.groupBy(F.session_window(at, gap), key).agg(F.count("*").alias("n")).select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def first_seen(events: DataFrame, key: str, at: str = "ts", keep: str = "90 days") -> DataFrame:
    """The first row of each key within the watermark; state older than `keep` is dropped."""
    if events.isStreaming:
        return events.withWatermark(at, keep).dropDuplicatesWithinWatermark([key])
    return events.dropDuplicates([key])


def run_available(stream: DataFrame, target: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is there into Parquet, exactly once over restarts with the same checkpoint."""
    q = stream.writeStream.format("parquet").outputMode(mode).option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
