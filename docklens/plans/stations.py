"""Queries over the station table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docklens.config import CITIES, as_ids, check_count, city_list
from docklens.functions.geo import STATION_PROPERTIES, point_features
from docklens.operators.topk import first_rows, only_ids


def cities(station: DataFrame) -> DataFrame:
    """Configured cities with country and number of stations."""
    country = F.create_map(
        *[F.lit(x) for c in CITIES.values() for x in (c.city_key, c.country)]
    )
    return (
        station.where(F.col("city_key").isin(list(CITIES)))
        .groupBy(F.col("city_key").alias("city"))
        .agg(F.count(F.lit(1)).alias("stations"))
        .select("city", country[F.col("city")].alias("country"), "stations")
    )


def _columns(station: DataFrame, city: str | None) -> DataFrame:
    if city is not None:
        station = station.where(F.col("city_key").isin(city_list(city)))
    return station.select(
        "city_key", "id", "name", "address", "city",
        F.col("nb_stations").alias("nb_stands"), "x", "y",
    )


def stations(
    station: DataFrame,
    city: str | None = None,
    limit: int | None = None,
    geojson: bool = False,
) -> DataFrame:
    """Stations of a city, by id."""
    check_count("limit", limit)
    rows = first_rows(_columns(station, city), ["city_key", "id"], limit)
    return point_features(rows, STATION_PROPERTIES) if geojson else rows


def specific_stations(
    station: DataFrame, ids: str | Iterable[object], city: str | None = None
) -> DataFrame:
    """Stations with the given ids; none for an empty list."""
    return only_ids(_columns(station, city), as_ids(ids))


def station_ids(station: DataFrame, city: str | None = None) -> DataFrame:
    return _columns(station, city).select("city_key", "id")


def fill_ratio(latest: DataFrame) -> DataFrame:
    """Bikes per stand of each row; null where a station has no stands."""
    ratio = F.try_divide(F.col("nb_bikes").cast("double"), F.col("nb_stands"))
    return latest.withColumn("ratio", ratio)
