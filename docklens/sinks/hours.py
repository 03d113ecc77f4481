"""Keeping the stored hours (``plans.hours``) in step with the stored readings."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docklens import schemas
from docklens.config import as_date
from docklens.functions.timecols import bin_start
from docklens.operators.changes import BUCKET
from docklens.plans.hours import hour_changes, newest_hours
from docklens.session import delete_folder
from docklens.sinks.tables import (
    COMPACTED,
    LOAD,
    WRITERS,
    _canonical,
    _target,
    _write,
    stored_readings,
)
from docklens.sources.tables import stored

NAME = "hour_change"
PARTITION = ("city_key", "date", LOAD)
# the rows of one scope are row groups of their own
ORDER = ("scope", "id", "bucket")


def _stored_hours(spark: SparkSession, lake: str) -> DataFrame | None:
    schema = T.StructType(schemas.HOUR_CHANGE.fields + schemas.PARTITIONS[NAME].fields)
    return stored(spark, _target(lake, NAME), schema)


def read_hours(spark: SparkSession, lake: str) -> DataFrame:
    """The newest version of the stored hours; empty before the first one.

    Filters on city and day reach the folders through the choice of the version, one on the
    scope reaches the row groups.
    """
    versions = _stored_hours(spark, lake)
    if versions is None:
        schema = T.StructType(schemas.HOUR_CHANGE.fields + schemas.PARTITIONS[NAME].fields)
        versions = spark.createDataFrame([], schema)
    return newest_hours(versions)


def _write_hours(readings: DataFrame, lake: str, load: str, writers: int) -> None:
    hours = hour_changes(readings)
    rows = _canonical(hours, NAME).withColumns(
        {"date": F.to_date("bucket"), LOAD: F.lit(load)}
    )
    _write(rows, _target(lake, NAME), PARTITION, ORDER, writers)


def refresh_hours(
    spark: SparkSession, lake: str, load: str, writers: int = WRITERS
) -> None:
    """Store the hours that ``load`` has readings of, as they are with it.

    The other readings of these hours are read again, of the load's own days and of the
    span between its first and last hour: both are literals of the scan, so folders and
    row groups outside are skipped. Hours that the load does not touch are left alone,
    however late its readings are. The load's hours meet the readings as one row for each
    city and hour. Repeating the call stores the same rows.

    A load that replaces another one of its name by *other* readings leaves old versions
    behind; ``compact_hours`` builds its days anew.
    """
    held = stored_readings(spark, lake)
    if held is None:
        return
    hour = bin_start("timestamp", BUCKET)
    of_load = held.where((F.col(LOAD) == load) & F.col("timestamp").isNotNull())
    # one row for each city and hour that the load has readings of
    touched = of_load.groupBy("city_key", "date", hour.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")
    )
    days = touched.groupBy("city_key", "date").agg(
        F.min("bucket").alias("first"), F.max("bucket").alias("last")
    )
    found = days.collect()  # a row for each city and day of the load
    if not found:
        return
    first = min(r["first"] for r in found)
    after = max(r["last"] for r in found) + timedelta(hours=1)
    near = held.where(
        F.col("city_key").isin(sorted({r.city_key for r in found if r.city_key is not None}))
        & F.col("date").isin(sorted({r.date for r in found}))
        & (F.col("timestamp") >= F.lit(first.isoformat()).cast("timestamp_ntz"))
        & (F.col("timestamp") < F.lit(after.isoformat()).cast("timestamp_ntz"))
    ).withColumn("hour", hour)
    # by hint, as its size before the aggregation is all that is known: hours, not readings
    hours = F.broadcast(touched.select("city_key", F.col("bucket").alias("hour")))
    readings = near.join(hours, ["city_key", "hour"], "left_semi")
    _write_hours(readings, lake, load, writers)


def compact_hours(
    spark: SparkSession, lake: str, city: str, start: date | str, stop: date | str
) -> None:
    """Build the hours of a city's days ``[start, stop]`` anew from their readings.

    They become one load; the versions of other loads are removed after it is written. Run
    it after ``compact_readings``, which removes copies, or when a load was replaced by
    other readings. No load of these days may be written meanwhile; a call that dies in
    between is to be repeated.
    """
    held, versions = stored_readings(spark, lake), _stored_hours(spark, lake)
    if held is None or versions is None:
        return
    of_days = (F.col("city_key") == city) & F.col("date").between(
        F.lit(as_date(start)), F.lit(as_date(stop))
    )
    found = versions.where(of_days & (F.col(LOAD) != COMPACTED))
    old = found.select("date", LOAD).distinct().collect()  # folders, not rows
    _write_hours(held.where(of_days), lake, COMPACTED, WRITERS)
    for day, load in old:
        folder = f"city_key={city}/date={day}/{LOAD}={load}"
        delete_folder(spark, f"{_target(lake, NAME)}/{folder}")
