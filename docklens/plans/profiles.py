"""Hour-of-day and weekday profiles of transactions."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docklens.config import as_date, as_ids
from docklens.functions.timecols import hour_start, interval, step_seconds
from docklens.operators.changes import BUCKET, hourly_changes, join_hours
from docklens.operators.series import nest
from docklens.operators.topk import only_ids
from docklens.plans.transactions import daily_rows
from docklens.sources.tables import time_slice

KEYS = ["city_key", "id"]
HOUR = 3600


def hourly_totals(
    readings: DataFrame, bucket: str = BUCKET, unique: bool = False
) -> DataFrame:
    """Transactions per station and hour, gaps between known hours as 0.

    Differences run across midnight and need no open status.  The hours are the
    buckets of ``hourly_changes`` (or made of them, when they are finer), so
    readings are shuffled only there.
    """
    if HOUR % step_seconds(bucket):
        raise ValueError(f"{bucket!r} does not divide an hour")
    return totals_of(hourly_changes(readings, KEYS, bucket=bucket, unique=unique), bucket)


def totals_of(buckets: DataFrame, bucket: str = BUCKET) -> DataFrame:
    """``hourly_totals`` from buckets in the form of ``hourly_changes``."""
    hours = join_hours(buckets, KEYS).where(F.col("changes") > 0)
    if step_seconds(bucket) < HOUR:
        hours = hours.groupBy(*KEYS, hour_start(F.col("bucket")).alias("bucket")).agg(
            F.sum("total").alias("total")
        )
    hour = interval(HOUR)
    earlier = F.lag("bucket").over(Window.partitionBy(*KEYS).orderBy("bucket"))
    return hours.withColumn("start", F.coalesce(earlier + hour, F.col("bucket"))).select(
        *KEYS,
        F.explode(F.sequence("start", "bucket", hour)).alias("ts"),
        "bucket",
        "total",
    ).select(
        *KEYS,
        "ts",
        F.when(F.col("ts") == F.col("bucket"), F.col("total")).otherwise(0).alias("total"),
    )


def hourly_profile(
    readings: DataFrame,
    station: DataFrame,
    ids: str | Iterable[object] | None,
    day: date | str,
    window: int = 7,
    city: str | None = None,
) -> DataFrame:
    """Sum and mean of hourly transactions per hour of day in ``[day - window, day)``."""
    day = as_date(day)
    rows = time_slice(readings, day - timedelta(days=window), day, city)
    if ids is not None:
        rows = only_ids(rows, as_ids(ids))
    return profile_of(hourly_totals(rows), station)


def profile_of(totals: DataFrame, station: DataFrame) -> DataFrame:
    """Sum and mean per hour of day, from ``hourly_totals``."""
    profile = (
        totals.groupBy(*KEYS, F.hour("ts").alias("hour"))
        .agg(
            F.sum("total").cast("double").alias("sum"),
            F.avg("total").alias("mean"),
        )
    )
    return profile.join(station.select(*KEYS, "name"), KEYS, "left")


def daily_profile(
    daily: DataFrame,
    station: DataFrame,
    ids: str | Iterable[object] | None,
    day: date | str,
    window: int = 30,
    city: str | None = None,
) -> DataFrame:
    """Sum and mean of daily values per weekday in ``[day - window, day]``.

    Days without a value are left out, they do not count as zero.
    """
    rows = daily_rows(daily, station, ids, day, window, True, city)
    return rows.groupBy(*KEYS, "name", F.weekday("date").alias("day")).agg(
        F.sum("value").alias("sum"), F.avg("value").alias("mean")
    )


def nest_profile(profile: DataFrame, slot: str) -> DataFrame:
    """One row per station with the arrays slot (``hour`` or ``day``), sum, mean."""
    return nest(
        profile, [*KEYS, "name"], slot, {slot: slot, "sum": "sum", "mean": "mean"}
    )
