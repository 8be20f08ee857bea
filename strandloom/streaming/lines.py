"""Streaming forms of line scans and keyed counts: an extension, as batch files are the rule."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream_lines(spark: SparkSession, path: str) -> DataFrame:
    """New text files of a folder as a stream of lines."""
    return spark.readStream.text(path)


def stream_counts(events: DataFrame, time: str, keys: list[str], window: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Counts of keys in event-time windows; a window closes when the watermark passes it."""
    return events.withWatermark(time, late).groupBy(F.window(time, window), *keys).agg(F.count("*").alias("n")).select("window.start", "window.end", *keys, "n")


def each_batch(stream: DataFrame, f: Callable[[DataFrame, int], None], checkpoint: str):
    """f on each micro-batch; the checkpoint makes a restarted query go on where it stopped."""
    return stream.writeStream.foreachBatch(f).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
