"""Reprojection of Lambert-93 points and GeoJSON features, as column math."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WGS84 = 4326
LAMBERT_93 = 2154

# GRS80 ellipsoid and the published Lambert-93 cone.
_SEMI_MAJOR = 6378137.0
_FLATTENING = 1 / 298.257222101
_PARALLELS = (49.0, 44.0)
_ORIGIN_LAT = 46.5
_ORIGIN_LON = 3.0
_FALSE_EASTING = 700000.0
_FALSE_NORTHING = 6600000.0

_ECCENTRICITY = math.sqrt(_FLATTENING * (2 - _FLATTENING))
_LATITUDE_STEPS = 5


def _isometric(lat: float) -> float:
    s = _ECCENTRICITY * math.sin(lat)
    return math.tan(math.pi / 4 - lat / 2) / ((1 - s) / (1 + s)) ** (_ECCENTRICITY / 2)


def _parallel_radius(lat: float) -> float:
    return math.cos(lat) / math.sqrt(1 - (_ECCENTRICITY * math.sin(lat)) ** 2)


def _cone() -> tuple[float, float, float]:
    """Cone constant, scale and origin radius from the two parallels."""
    north, south = (math.radians(p) for p in _PARALLELS)
    n = (math.log(_parallel_radius(north)) - math.log(_parallel_radius(south))) / (
        math.log(_isometric(north)) - math.log(_isometric(south))
    )
    scale = _parallel_radius(north) / (n * _isometric(north) ** n)
    radius = _SEMI_MAJOR * scale * _isometric(math.radians(_ORIGIN_LAT)) ** n
    return n, scale, radius


def lambert93_to_wgs84(easting: Column, northing: Column) -> tuple[Column, Column]:
    """(longitude, latitude) in degrees."""
    n, scale, radius = _cone()
    dx = easting - F.lit(_FALSE_EASTING)
    dy = F.lit(radius) - (northing - F.lit(_FALSE_NORTHING))
    lon = F.degrees(F.atan2(dx, dy) / F.lit(n)) + F.lit(_ORIGIN_LON)
    t = F.pow(F.sqrt(dx * dx + dy * dy) / F.lit(_SEMI_MAJOR * scale), F.lit(1 / n))
    lat = F.lit(math.pi / 2) - 2 * F.atan(t)
    for _ in range(_LATITUDE_STEPS):
        s = F.lit(_ECCENTRICITY) * F.sin(lat)
        lat = F.lit(math.pi / 2) - 2 * F.atan(
            t * F.pow((1 - s) / (1 + s), F.lit(_ECCENTRICITY / 2))
        )
    return lon, F.degrees(lat)


def to_wgs84(df: DataFrame, srid: int, x: str = "x", y: str = "y") -> DataFrame:
    """Replace the point columns by longitude and latitude."""
    if srid == WGS84:
        return df
    if srid != LAMBERT_93:
        raise ValueError(f"no reprojection from SRID {srid}")
    lon, lat = lambert93_to_wgs84(F.col(x), F.col(y))
    return df.withColumns({x: lon, y: lat})


def point_features(df: DataFrame, properties: Sequence[str]) -> DataFrame:
    """One GeoJSON ``Feature`` per row, with the chosen columns as properties."""
    return df.select(
        F.lit("Feature").alias("type"),
        F.struct(
            F.lit("Point").alias("type"), F.array("x", "y").alias("coordinates")
        ).alias("geometry"),
        F.struct(*properties).alias("properties"),
    )


STATION_PROPERTIES = ("id", "name", "address", "city", "nb_stands")
LATEST_PROPERTIES = ("id", "name", "timestamp", "nb_bikes", "nb_stands")
CLUSTER_PROPERTIES = ("id", "cluster_id", "name", "start", "stop")


def extent(df: DataFrame, *keys: str) -> DataFrame:
    """Bounding box and centre of the points, per ``keys`` where given."""
    box = df.groupBy(*keys).agg(
        F.min("x").alias("min_x"),
        F.min("y").alias("min_y"),
        F.max("x").alias("max_x"),
        F.max("y").alias("max_y"),
    )
    return box.withColumns(
        {
            "center_x": (F.col("min_x") + F.col("max_x")) / 2,
            "center_y": (F.col("min_y") + F.col("max_y")) / 2,
        }
    )
