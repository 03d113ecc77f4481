"""Queries over the readings."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docklens.config import as_datetime, as_ids, check_count
from docklens.functions.fill import fill_probability, has_docks
from docklens.functions.geo import LATEST_PROPERTIES, point_features
from docklens.operators.latest import newest
from docklens.operators.series import STRETCH, nest_series
from docklens.operators.topk import first_rows, only_ids
from docklens.sources.tables import time_slice

Time = datetime | date | str
KEYS = ["city_key", "id"]
RECENT = timedelta(days=2)


def _selected(
    readings: DataFrame, ids: str | Iterable[object] | None, start: Time, stop: Time,
    city: str | None,
) -> DataFrame:
    rows = time_slice(readings, start, stop, city)
    return rows if ids is None else only_ids(rows, as_ids(ids))


def _names(station: DataFrame) -> DataFrame:
    return station.select(*KEYS, "name", F.col("nb_stations").alias("nb_stands"))


def timeseries(
    readings: DataFrame,
    station: DataFrame,
    ids: str | Iterable[object] | None,
    start: Time,
    stop: Time,
    city: str | None = None,
) -> DataFrame:
    """Readings of the stations in ``[start, stop)`` with name and stands."""
    return (
        _selected(readings, ids, start, stop, city)
        .join(_names(station), KEYS, "left")
        .orderBy(*KEYS, "timestamp")
    )


def timeseries_nested(
    readings: DataFrame,
    station: DataFrame,
    ids: str | Iterable[object] | None,
    start: Time,
    stop: Time,
    city: str | None = None,
    stretch: str = STRETCH,
) -> DataFrame:
    """Parallel arrays per station and stretch of time from ``start`` on.

    A range of one stretch at most gives one row per station.
    """
    columns = {
        "ts": "timestamp",
        "status": "status",
        "available_bikes": "available_bikes",
        "available_stands": "available_stands",
    }
    rows = _selected(readings, ids, start, stop, city)
    ties = ("available_bikes", "available_stands", "status")
    since = as_datetime(start)
    nested = nest_series(rows, KEYS, "timestamp", columns, since, stretch, ties)
    return nested.join(_names(station), KEYS, "left")


def _on_map(latest: DataFrame, station: DataFrame, limit: int | None) -> DataFrame:
    """Newest rows with their station; rows without a station row are dropped."""
    place = station.select(
        *KEYS, "name", F.col("nb_stations").alias("nb_stands"), "x", "y"
    )
    rows = latest.join(place, KEYS).select(
        "city_key", "id", "timestamp", "nb_bikes", "name", "nb_stands", "x", "y"
    )
    return first_rows(rows, KEYS, limit)


def latest_rows(
    rows: DataFrame,
    station: DataFrame,
    as_of: Time,
    city: str | None,
    limit: int | None,
    geojson: bool,
) -> DataFrame:
    """Newest row per station not older than two days before ``as_of``."""
    check_count("limit", limit)
    recent = time_slice(rows, as_datetime(as_of) - RECENT, None, city)
    recent = recent.select(*KEYS, "timestamp", "nb_bikes")
    result = _on_map(newest(recent, KEYS), station, limit)
    return point_features(result, LATEST_PROPERTIES) if geojson else result


def latest_availability(
    readings: DataFrame,
    station: DataFrame,
    as_of: Time,
    city: str | None = None,
    limit: int | None = None,
    geojson: bool = False,
) -> DataFrame:
    """Newest reading per station; equal newest times are all kept."""
    rows = readings.withColumnRenamed("available_bikes", "nb_bikes")
    return latest_rows(rows, station, as_of, city, limit, geojson)


def _open_rows(
    readings: DataFrame, start: Time, stop: Time, city: str | None
) -> DataFrame:
    return (
        time_slice(readings, start, stop, city)
        .where(has_docks("available_bikes", "available_stands"))
        .where(F.col("status") == "open")
        .select(
            "city_key",
            F.col("id").alias("station_id"),
            F.col("timestamp").alias("ts"),
            F.col("available_bikes").alias("nb_bikes"),
            F.col("available_stands").alias("nb_stands"),
            fill_probability("available_bikes", "available_stands").alias("probability"),
        )
    )


def open_readings(
    readings: DataFrame, start: Time, stop: Time, city: str | None = None
) -> DataFrame:
    """Different open readings with docks in ``[start, stop)``, with probability."""
    return _open_rows(readings, start, stop, city).distinct()


def latest_open_rows(
    readings: DataFrame, start: Time, stop: Time, city: str | None = None
) -> DataFrame:
    """The rows of ``latest_station_timewindow``, without an order."""
    rows = _open_rows(readings, start, stop, city)
    return newest(rows, ["city_key", "station_id"], "ts").distinct()


def latest_station_timewindow(
    readings: DataFrame, start: Time, stop: Time, city: str | None = None
) -> DataFrame:
    """Newest open reading with docks per station in ``[start, stop)``."""
    rows = latest_open_rows(readings, start, stop, city)
    return rows.orderBy("city_key", "station_id")
