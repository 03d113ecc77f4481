"""Transactions and profiles from stored hours, without their readings.

The table ``hour_change`` holds one row for each station and hour in the form of
``operators.changes.hourly_changes``: the differences within the hour and the values at its
two ends. Days, profiles and slices begin at full hours, so any of them follows from these
rows alone. ``scope`` tells the rows of all readings (profiles) from those of open
readings (daily transactions).

A load stores the hours that it touches anew, as they are with it, beside what earlier
loads have stored of them (``sinks.hours``). Readings are only added, so the version
of an hour with the most different readings is its newest (of equal ones, that with the
most copies), in whatever order loads were stored.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docklens.config import as_date, as_ids
from docklens.functions.timecols import bin_start
from docklens.operators.changes import BUCKET, TIES, bucket_changes, total_changes
from docklens.operators.topk import only_ids
from docklens.plans.profiles import KEYS, profile_of, totals_of
from docklens.sources.tables import time_slice

ALL, OPEN = "all", "open"
VALUES = ["total", "changes", "first_value", "last_value"]


def hour_changes(readings: DataFrame) -> DataFrame:
    """The hours of ``readings`` in both scopes; readings without a time have none.

    Every reading is read and shuffled once; copies collapse before, and an open one is
    dealt to both scopes where its hour is.
    """
    rows = (
        readings.where(F.col("timestamp").isNotNull())
        .groupBy(*KEYS, "timestamp", *TIES)
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.count(F.when(F.col("status") == "open", 1)).alias("open_copies"),
        )
        .withColumn("bucket", bin_start("timestamp", BUCKET))
        .repartition(*KEYS, "bucket")
    )
    scopes = F.array(
        F.struct(F.lit(ALL).alias("scope"), F.col("copies")),
        F.struct(F.lit(OPEN).alias("scope"), F.col("open_copies").alias("copies")),
    )
    scoped = rows.select(*KEYS, "timestamp", *TIES, "bucket", F.inline(scopes)).where("copies > 0")
    return bucket_changes(scoped, [*KEYS, "scope"])


def newest_hours(versions: DataFrame) -> DataFrame:
    """The newest version of every station, hour and scope.

    A maximum by hash with a partial step: the versions of an hour are never sorted.
    """
    keys = [*KEYS, "date", "scope", "bucket"]
    newest = F.max_by(F.struct(*VALUES, "readings"), F.struct("readings", "changes"))
    return versions.groupBy(*keys).agg(newest.alias("newest")).select(*keys, "newest.*")


def daily_of_hours(hours: DataFrame) -> DataFrame:
    """``daily_transactions`` of the stored hours."""
    keys = [*KEYS, "date"]
    opened = hours.where(F.col("scope") == OPEN).withColumn("date", F.to_date("bucket"))
    return total_changes(opened, keys).select(*KEYS, "number", "date")


def aggregate_hours(hours: DataFrame, day: date | str, city: str | None = None) -> DataFrame:
    """``aggregate_transactions`` of the stored hours: the roll-up of one day."""
    day = as_date(day)
    return daily_of_hours(time_slice(hours, day, day + timedelta(days=1), city, "bucket"))


def hourly_profile_of_hours(
    hours: DataFrame,
    station: DataFrame,
    ids: str | Iterable[object] | None,
    day: date | str,
    window: int = 7,
    city: str | None = None,
) -> DataFrame:
    """``hourly_profile`` of the stored hours in ``[day - window, day)``."""
    day = as_date(day)
    rows = time_slice(hours, day - timedelta(days=window), day, city, "bucket")
    if ids is not None:
        rows = only_ids(rows, as_ids(ids))
    return profile_of(totals_of(rows.where(F.col("scope") == ALL)), station)
