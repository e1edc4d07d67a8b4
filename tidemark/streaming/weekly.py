"""Structured Streaming form of the weekly counts: late rows up to a watermark, weeks from Monday."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def weekly_counts(events: DataFrame, time_col: str, topic_col: str, lateness: str = "7 days") -> DataFrame:
    """topic_id, week_start, topic_count. Windows of seven days start at the epoch, a Thursday; four days make it Monday."""
    at = F.col(time_col).cast("timestamp")
    rows = events.withColumn("__at", at).withWatermark("__at", lateness)
    return rows.groupBy(F.window("__at", "7 days", "7 days", "4 days"), F.col(topic_col).alias("topic_id")).agg(F.count("*").alias("topic_count")).select("topic_id", F.to_date("window.start").alias("week_start"), "topic_count")


def append_to(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends closed weeks to a Parquet table until the source has no more."""
    return df.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
