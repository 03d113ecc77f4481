"""Running daily transactions.

The stream keeps the different readings of each station and bucket until the
watermark has passed, in any order of arrival, and emits every changed bucket
as one row in the form of ``operators.changes.hourly_changes``.  The batch step
that joins buckets to days is then the same for batch and stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docklens.functions.timecols import from_epoch
from docklens.operators.changes import total_changes
from docklens.streaming.ingest import DELAY, EVENT_TIME, watermarked
from docklens.streaming.versions import read_changes, store_changes

KEYS = ["city_key", "id", "date"]
BUCKET = "10 minutes"


def changed_buckets(
    stream: DataFrame, delay: str = DELAY, bucket: str = BUCKET
) -> DataFrame:
    """Per station and bucket: inner sum of |difference|, first and last value."""
    reading = F.struct("timestamp", "available_bikes", "available_stands")
    held = (
        watermarked(stream.where(F.col("status") == "open"), delay)
        .groupBy("city_key", "id", F.window(EVENT_TIME, bucket).alias("span"))
        .agg(F.array_sort(F.collect_set(reading)).alias("rows"))
    )
    bikes = F.col("rows.available_bikes")
    count = F.size("rows")
    steps = F.zip_with(
        F.slice(bikes, F.lit(2), count), F.slice(bikes, F.lit(1), count - 1),
        lambda later, earlier: F.abs(later - earlier),
    )
    known = F.filter(steps, lambda step: step.isNotNull())
    start = from_epoch(F.unix_timestamp("span.start"))
    return held.select(
        "city_key",
        "id",
        F.to_date(start).alias("date"),
        start.alias("bucket"),
        F.aggregate(
            known, F.lit(0).cast("bigint"), lambda total, step: total + step
        ).alias("total"),
        F.size(known).cast("bigint").alias("changes"),
        F.element_at(bikes, 1).alias("first_value"),
        F.element_at(bikes, -1).alias("last_value"),
    )


def run_daily_transactions(
    stream: DataFrame, path: str, checkpoint: str, delay: str = DELAY, bucket: str = BUCKET
) -> StreamingQuery:
    """Store the changed buckets of each batch below ``path``."""
    buckets = changed_buckets(stream, delay, bucket)
    return store_changes(buckets, path, checkpoint, ["date"])


def read_daily_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Daily totals as of the last batch."""
    buckets = read_changes(spark, path, [*KEYS, "bucket"])
    return total_changes(buckets, KEYS).select("city_key", "id", "number", "date")
