"""Running window figures per station."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docklens.functions.timecols import from_epoch, grid_seconds
from docklens.streaming.ingest import DELAY, EVENT_TIME, watermarked


def window_means(stream: DataFrame, step: str = "10T", delay: str = DELAY) -> DataFrame:
    """Mean, lowest and highest bikes per station and tumbling window.

    The aggregates are partial before the shuffle and the state is three
    numbers per station and window.
    """
    span = f"{grid_seconds(step)} seconds"
    return (
        watermarked(stream, delay)
        .groupBy("city_key", "id", F.window(EVENT_TIME, span).alias("w"))
        .agg(
            F.avg("available_bikes").alias("mean_bikes"),
            F.min("available_bikes").alias("min_bikes"),
            F.max("available_bikes").alias("max_bikes"),
        )
        .select(
            "city_key",
            "id",
            from_epoch(F.unix_timestamp("w.start")).alias("ts"),
            "mean_bikes",
            "min_bikes",
            "max_bikes",
        )
    )
