"""Windowed counts over event streams; the same functions work on batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _watermarked(events: DataFrame, time: str, late: str) -> DataFrame:
    return events.withWatermark(time, late) if events.isStreaming else events


def _totals(windowed, value: str) -> DataFrame:
    return windowed.agg(F.count("*").alias("n"), F.sum(value).alias("total"))


def tumbling(events: DataFrame, time: str, every: str, keys: list[str], value: str, late: str = "10 minutes") -> DataFrame:
    own = _watermarked(events, time, late)
    return _totals(own.groupBy(F.window(time, every).alias("w"), *keys), value).select(F.col("w.start").alias("start"), *keys, "n", "total")


def sliding(events: DataFrame, time: str, length: str, every: str, keys: list[str], value: str, late: str = "10 minutes") -> DataFrame:
    own = _watermarked(events, time, late)
    return _totals(own.groupBy(F.window(time, length, every).alias("w"), *keys), value).select(F.col("w.start").alias("start"), *keys, "n", "total")


def sessions(events: DataFrame, time: str, gap: str, keys: list[str], value: str, late: str = "10 minutes") -> DataFrame:
    own = _watermarked(events, time, late)
    out = _totals(own.groupBy(F.session_window(time, gap).alias("w"), *keys), value)
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n", "total")


def start(df: DataFrame, path: str, checkpoint: str, every: str = "60 seconds"):
    """Micro-batches to Parquet, each written once."""
    return df.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
