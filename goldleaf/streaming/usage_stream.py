"""Continuous usage counts over the call log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def usage_windows(
    calls: DataFrame,
    key: str,
    window: str = "60 seconds",
    slide: str = "10 seconds",
    lateness: str = "2 minutes",
) -> DataFrame:
    """Calls and tokens per key in sliding windows; later calls than the watermark are dropped.

    Counts are reduced per task before the shuffle, so a busy key costs one row per window.
    """
    return (
        calls.withWatermark("timestamp", lateness)
        .groupBy(F.window("timestamp", window, slide), key)
        .agg(F.count("*").alias("requests"), F.sum("total_tokens").alias("tokens"))
        .select(F.col("window.start").alias("window_start"), key, "requests", "tokens")
    )


def write_usage(windows: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Closed windows to parquet, each exactly once."""
    return (
        windows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
