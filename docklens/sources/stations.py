"""Station extracts to the canonical station table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docklens.config import CityConfig
from docklens.functions.fill import blank_to_null
from docklens.functions.geo import to_wgs84
from docklens.sources.feeds import Parsed, json_documents

FORMATS = ("geojson", "csv", "parquet")


def normalise_stations(raw: DataFrame, city: CityConfig) -> DataFrame:
    """Configured columns under canonical names, the point in longitude/latitude.

    ``raw`` holds the extract's own columns plus ``x`` and ``y`` in the city's
    coordinate system; a height column is left behind by the selection.
    """
    id_, name, address, town, docks = city.station_columns
    canonical = raw.select(
        F.lit(city.city_key).alias("city_key"),
        F.col(id_).cast("string").alias("id"),
        F.col(name).cast("string").alias("name"),
        F.col(address).cast("string").alias("address"),
        F.col(town).cast("string").alias("city"),
        F.col(docks).cast("int").alias("nb_stations"),
        F.col("x").cast("double").alias("x"),
        F.col("y").cast("double").alias("y"),
    )
    return to_wgs84(canonical, city.srid)


def read_stations(
    spark: SparkSession, path: str | Sequence[str], city: CityConfig, kind: str = "geojson"
) -> Parsed:
    """A city's stations from decoded extracts, and what could not be read of them.

    GeoJSON features hold the configured columns as properties and a point of two or three
    coordinates in the city's coordinate system; the height is left behind. CSV and Parquet
    files hold the configured columns and ``x`` and ``y``.

    A cut document and a station without an id (a ``record``) are left out. An unreadable
    number of docks or point (a ``field``) is null, the station stays; so does one whose
    docks or geometry are blank, which is no damage. Each damaged document or record is one
    reject with its text. A station that an extract repeats is repeated in the result.
    """
    if kind not in FORMATS:
        raise ValueError(f"kind is one of {FORMATS}")
    paths = [path] if isinstance(path, str) else list(path)
    names = list(city.station_columns)
    damaged = None
    if kind == "geojson":
        fields = ", ".join(f"`{name}`: string" for name in names)
        schema = (
            "features array<struct<geometry: struct<type: string, coordinates: array<string>>, "
            f"properties: struct<{fields}>>>"
        )
        documents, damaged = json_documents(spark, paths, schema)
        feature = documents.select("snapshot", F.explode("features").alias("record"))
        rows = feature.select(
            "snapshot", "record", "record.properties.*",
            F.get("record.geometry.coordinates", F.lit(0)).alias("x"),
            F.get("record.geometry.coordinates", F.lit(1)).alias("y"),
            F.col("record.geometry").isNotNull().alias("placed"),
            F.coalesce(F.col("record.geometry.type") == "Point", F.lit(False)).alias("point"),
        )
    else:
        text = [*names, "x", "y"]
        read = spark.read.option("header", "true")
        read = read.csv(paths) if kind == "csv" else spark.read.parquet(*paths)
        read = read.select(
            *[F.col(c).cast("string").alias(c) for c in text],
            F.col("_metadata.file_path").alias("snapshot"),
        )
        placed = blank_to_null(F.col("x")).isNotNull() | blank_to_null(F.col("y")).isNotNull()
        rows = read.select(
            "*", F.struct(*text).alias("record"), placed.alias("placed"), F.lit(True).alias("point")
        )
    return _checked(rows, city, damaged)


def _finite(column: str) -> Column:
    """The number of a text, or null if it has none or is not finite."""
    number = F.col(column).try_cast("double")
    return F.when(F.abs(number) < float("inf"), number)  # false for NaN, which is larger


def _checked(rows: DataFrame, city: CityConfig, damaged: DataFrame | None) -> Parsed:
    id_, docks = city.station_columns[0], city.station_columns[4]
    text = blank_to_null(F.col(docks))
    # extracts spell whole numbers as 20 or 20.0
    whole = text.try_cast("double").try_cast("int")
    placed = F.col("point") & _finite("x").isNotNull() & _finite("y").isNotNull()
    marked = rows.withColumns(
        {
            "_known": blank_to_null(F.col(id_)).isNotNull(),
            "_bad": (text.isNotNull() & whole.isNull()) | (F.col("placed") & ~placed),
            docks: whole,
            "x": F.when(placed, _finite("x")),
            "y": F.when(placed, _finite("y")),
        }
    )
    rejects = marked.where(~F.col("_known") | F.col("_bad")).select(
        "snapshot",
        F.when(F.col("_known"), "field").otherwise("record").alias("reason"),
        F.to_json("record").alias("text"),
    )
    rejects = rejects if damaged is None else damaged.union(rejects)
    return Parsed(normalise_stations(marked.where("_known"), city), rejects)


def coordinates(station: DataFrame) -> DataFrame:
    """Latitude and longitude per station, the input of geographic clusters."""
    return station.select(
        "city_key",
        F.col("id").alias("station_id"),
        F.col("y").alias("lat"),
        F.col("x").alias("lon"),
    )
