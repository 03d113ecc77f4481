"""Differences between consecutive readings of a station, safe for hot stations.

A plain ``lag`` over one window per station would put a station that holds a
third of all readings into one task.  Here the readings are windowed per
station *and hour*; each hour leaves one row (its inner total, its first and its
last value), and a second, small window over those rows adds the step from one
hour to the next.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docklens.functions.timecols import bin_start

BUCKET = "1H"
TIES = ("available_bikes", "available_stands")


def collapse_copies(
    readings: DataFrame, keys: Sequence[str], ts: str = "timestamp"
) -> DataFrame:
    """One row per different reading with its number of copies.

    The partial aggregation runs before the shuffle, and the shuffle key holds
    every column, so neither copies nor a hot station meet in one task.
    """
    return readings.groupBy(*keys, ts, *TIES).agg(F.count(F.lit(1)).alias("copies"))


def hourly_changes(
    readings: DataFrame,
    keys: Sequence[str],
    ts: str = "timestamp",
    value: str = "available_bikes",
    bucket: str = BUCKET,
    unique: bool = False,
) -> DataFrame:
    """Per ``keys`` and bucket: inner sum of |difference|, first and last value.

    Equal times are ordered by the counts.  A copy adds a difference of zero, so
    it only matters for ``changes``, the number of known differences.

    ``bucket`` is the stretch of one station that a task orders; a finer one
    spreads very dense stations further.  ``unique`` promises that there are no
    copies (as in a table filled by the ingest stream) and saves their shuffle.
    ``readings`` counts the different rows of a bucket.
    """
    if unique:
        rows = readings.withColumn("copies", F.lit(1))
    else:
        rows = collapse_copies(readings, keys, ts)
    return bucket_changes(rows.withColumn("bucket", bin_start(ts, bucket)), keys, ts, value)


def bucket_changes(
    rows: DataFrame, keys: Sequence[str], ts: str = "timestamp", value: str = "available_bikes"
) -> DataFrame:
    """``hourly_changes`` of different readings with their ``bucket`` and ``copies``."""
    order = Window.partitionBy(*keys, "bucket").orderBy(ts, *TIES)
    marked = rows.select(
        *keys,
        "bucket",
        F.col(value).alias("value"),
        F.abs(F.col(value) - F.lag(value).over(order)).alias("change"),
        F.when(F.col(value).isNotNull(), F.col("copies") - 1).otherwise(0).alias("repeats"),
        (F.row_number().over(order) == 1).alias("is_first"),
        F.lead(F.lit(True), 1, False).over(order).alias("has_next"),
    )
    return marked.groupBy(*keys, "bucket").agg(
        F.coalesce(F.sum("change"), F.lit(0)).alias("total"),
        (F.count("change") + F.sum("repeats")).alias("changes"),
        F.count(F.lit(1)).alias("readings"),
        F.max(F.when(F.col("is_first"), F.col("value"))).alias("first_value"),
        F.max(F.when(~F.col("has_next"), F.col("value"))).alias("last_value"),
    )


def join_hours(buckets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the step between neighbouring buckets to the later one's total."""
    order = Window.partitionBy(*keys).orderBy("bucket")
    step = F.abs(F.col("first_value") - F.lag("last_value").over(order))
    return buckets.withColumn("step", step).select(
        *keys,
        "bucket",
        (F.col("total") + F.coalesce("step", F.lit(0))).alias("total"),
        (F.col("changes") + F.col("step").isNotNull().cast("int")).alias("changes"),
    )


def total_changes(buckets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sum of |difference| per ``keys``; zero where no difference is known."""
    return (
        join_hours(buckets, keys)
        .groupBy(*keys)
        .agg(F.sum("total").cast("double").alias("number"))
    )
