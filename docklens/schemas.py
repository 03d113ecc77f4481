"""Canonical tables. Times are local and without a zone."""

from __future__ import annotations

from pyspark.sql import types as T

HOUR_COLUMNS = [f"h{hour:02d}" for hour in range(24)]


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def table(columns: str) -> T.StructType:
    """Schema of flat ``name type`` pairs; unlike ``fromDDL`` it needs no session."""
    pairs = [pair.split() for pair in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# The names and types of the canonical tables.
STATION = table(
    "city_key string, id string, name string, address string, city string, "
    "nb_stations int, x double, y double"
)
TIMESERIES = table(
    "city_key string, id string, timestamp timestamp_ntz, "
    "available_stands int, available_bikes int, status string"
)
DAILY_TRANSACTION = table("city_key string, id string, number double, date date")
# Ours: a station's differences within one hour, of all readings or of the open ones.
HOUR_CHANGE = table(
    "city_key string, id string, scope string, bucket timestamp_ntz, total bigint, changes bigint, "
    "first_value int, last_value int, readings bigint"
)
CLUSTERING = table(
    "city_key string, station_id string, start date, stop date, cluster_id string"
)
CENTROID = table(
    "city_key string, cluster_id string, start date, stop date, "
    + ", ".join(f"{name} double" for name in HOUR_COLUMNS)
)
GEO_CLUSTERING = table("city_key string, station_id string, cluster_id int")
# Ours: stations that a run could not place.
CLUSTERING_REJECT = table("city_key string, station_id string, start date, stop date")
GEO_CLUSTERING_REJECT = table("city_key string, station_id string")
# Ours: what could not be read of a feed, and why: a cut ``document``, a malformed ``record``
# or an unreadable ``field``.
FEED_REJECT = table("city_key string, load string, snapshot string, reason string, text string")
STATION_REJECT = table("city_key string, snapshot string, reason string, text string")
WEATHER_REJECT = table(
    "city_key string, kind string, polled string, snapshot string, reason string, text string"
)
GEO_CENTROID = table("city_key string, cluster_id int, lat double, lon double")
PREDICTION = table(
    "city_key string, timestamp timestamp_ntz, frequency string, station_id string, "
    "availability double, nb_bikes int, nb_stands int"
)
WEATHER_CURRENT = table(
    "date timestamp_ntz, weather_id int, weather_desc string, temp double, "
    "temp_min double, temp_max double, pressure double, humidity double, "
    "wind_speed double, cloudiness int"
)
WEATHER_FORECAST = table(
    "forecast_at timestamp_ntz, ts timestamp_ntz, weather_id int, weather_desc string, "
    "temp double, temp_min double, temp_max double, rain_3h double, snow_3h double, "
    "pressure double, humidity double, wind_speed double, cloudiness int"
)

# Columns of the stored tables' folders, beside those of the table itself. ``load`` and
# ``polled`` tell the writes apart and are not part of what a reader gets.
PARTITIONS = {
    "timeseries": table("date date, load string"),
    "hour_change": table("date date, load string"),
    "snapshot": table("date date, load string"),
    "prediction": table("date date"),
    "weather_current": table("city_key string, polled string"),
    "weather_forecast": table("city_key string, polled string"),
}
WRITE_NAMES = ("load", "polled")

# Raw feeds -------------------------------------------------------------------

# The names that the feeds publish.
# Nested ones stay DDL text, which the readers take as it is.
# Numbers are read as text: a blank or damaged one must not take the good fields with it.
GML_MEMBER = (
    "CI_VCUB_P struct<GID: string, IDENT: string, TYPE: string, NOM: string, ETAT: string, "
    "NBPLACES: string, NBVELOS: string, MDATE: string>"
)
GEOJSON_READINGS = (
    "features array<struct<properties: struct<number: string, last_update: string, "
    "available_bike_stands: string, available_bikes: string, status: string>>>"
)
SNAPSHOT_CSV = table(
    "id string, timestamp timestamp_ntz, available_stands string, "
    "available_bikes string, status string"
)
TRANSACTIONS_CSV = table("id string, number double")
PREDICTIONS_CSV = table(
    "timestamp timestamp_ntz, station_id string, availability double, "
    "nb_bikes int, nb_stands int"
)

_WEATHER_PARTS = (
    "weather array<struct<id: int, main: string>>, wind struct<speed: double>, "
    "main struct<temp: double, temp_min: double, temp_max: double, "
    "pressure: double, humidity: double>, clouds struct<all: int>"
)
CURRENT_JSON = _WEATHER_PARTS
FORECAST_JSON = (
    f"list array<struct<{_WEATHER_PARTS}, dt bigint, "
    "rain struct<`3h`: double>, snow struct<`3h`: double>>>"
)
