"""Shifting stored times so that old data looks recent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docklens.config import as_date, as_datetime
from docklens.plans.timeseries import Time


def time_shift(readings: DataFrame, as_of: Time) -> Column:
    """Distance from the newest reading to ``as_of``, as a scalar subquery."""
    newest = readings.agg(F.max("timestamp")).scalar()
    return F.lit(as_datetime(as_of).isoformat()).cast("timestamp_ntz") - newest


def rebase_times(df: DataFrame, readings: DataFrame, as_of: Time) -> DataFrame:
    """``df`` (readings or predictions) moved by the shift of the readings."""
    return df.withColumn("timestamp", F.col("timestamp") + time_shift(readings, as_of))


def rebase_dates(daily: DataFrame, as_of: Time) -> DataFrame:
    """Daily rows moved so that the newest date is the day of ``as_of``."""
    newest = daily.agg(F.max("date")).scalar()
    days = F.date_diff(F.lit(as_date(as_datetime(as_of))), newest)
    return daily.withColumn("date", F.date_add("date", days))
