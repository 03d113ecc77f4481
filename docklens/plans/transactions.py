"""Daily transactions: the roll-up of readings and the queries over it."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docklens.config import (
    as_date,
    as_ids,
    check_count,
    check_ordering,
    time_window,
)
from docklens.operators.changes import BUCKET, hourly_changes, total_changes
from docklens.operators.series import nest
from docklens.operators.topk import only_ids, ranked_top
from docklens.sources.tables import date_range, time_slice


def daily_transactions(
    readings: DataFrame, bucket: str = BUCKET, unique: bool = False
) -> DataFrame:
    """Bikes taken or returned per station and day, from open readings.

    The sum of |difference| over a day's different open readings in time order.
    Differences never cross midnight; a lone reading gives 0.  For ``bucket``
    and ``unique`` see ``hourly_changes``.
    """
    keys = ["city_key", "id", "date"]
    open_readings = readings.where(F.col("status") == "open").withColumn(
        "date", F.to_date("timestamp")
    )
    buckets = hourly_changes(open_readings, keys, bucket=bucket, unique=unique)
    totals = total_changes(buckets, keys)
    return totals.select("city_key", "id", "number", "date")


def aggregate_transactions(
    readings: DataFrame, day: date | str, city: str | None = None
) -> DataFrame:
    """The roll-up of one day."""
    day = as_date(day)
    return daily_transactions(time_slice(readings, day, day + timedelta(days=1), city))


def _named(rows: DataFrame, station: DataFrame) -> DataFrame:
    return rows.join(station.select("city_key", "id", "name"), ["city_key", "id"], "left")


def daily_rows(
    daily: DataFrame,
    station: DataFrame,
    ids: str | Iterable[object] | None,
    day: date | str,
    window: int = 0,
    backward: bool = True,
    city: str | None = None,
) -> DataFrame:
    """The rows of ``daily_transaction``, without an order."""
    start, stop, _ = time_window(day, window, backward)
    rows = date_range(daily, start, stop, city)
    if ids is not None:
        rows = only_ids(rows, as_ids(ids))
    return _named(rows, station).select(
        "city_key", "id", F.col("number").alias("value"), "date", "name"
    )


def daily_transaction(
    daily: DataFrame,
    station: DataFrame,
    ids: str | Iterable[object] | None,
    day: date | str,
    window: int = 0,
    backward: bool = True,
    city: str | None = None,
) -> DataFrame:
    """Daily values of the given stations around ``day``, one row per day."""
    rows = daily_rows(daily, station, ids, day, window, backward, city)
    return rows.orderBy("city_key", "id", "date")


def nest_daily(rows: DataFrame, *extra: str) -> DataFrame:
    """One row per station with its dates and values; at most one entry per day."""
    return nest(
        rows, ["city_key", "id", "name", *extra], "date", {"date": "date", "value": "value"}
    )


def daily_transaction_list(
    daily: DataFrame,
    station: DataFrame,
    city: str | None,
    day: date | str,
    limit: int = 20,
    order_by: str = "station",
    window: int = 0,
    backward: bool = True,
) -> DataFrame:
    """The window of the ``limit`` first stations of the reference date.

    Stations are ranked on the reference date alone, by id or by value (largest
    first, equal values by id), then every day of their window is returned.
    Without a ``city`` each city has its own ranking.
    """
    check_ordering(order_by)
    check_count("limit", limit)
    start, stop, reference = time_window(day, window, backward)
    order = ["id"] if order_by == "station" else [F.desc_nulls_first("number"), "id"]
    keys = ["city_key"] if city is None else None
    top = ranked_top(date_range(daily, reference, reference, city), order, limit, keys)
    rows = date_range(daily, start, stop, city).join(
        top.select("city_key", "id", "rank"), ["city_key", "id"]
    )
    return (
        _named(rows, station)
        .select("city_key", "id", F.col("number").alias("value"), "date", "name", "rank")
        .orderBy("city_key", "rank", "date")
    )


def colour_scale(top: DataFrame) -> DataFrame:
    """Position of each top-k value between 0.7 x its city's lowest and the highest.

    ``top`` is a ranked one-day result, so it holds ``limit`` rows per city.
    """
    shown = Window.partitionBy("city_key")
    low = 0.7 * F.min("value").over(shown)
    high = F.max("value").over(shown)
    return top.withColumn("scale", F.try_divide(F.col("value") - low, high - low))
