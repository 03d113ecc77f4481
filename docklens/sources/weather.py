"""Weather documents to flat rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docklens import schemas
from docklens.functions.timecols import epoch_to_local
from docklens.sources.feeds import Parsed, json_documents

# The names in the weather documents (also in ``_measures`` and below).
_MAIN = ("temp", "temp_min", "temp_max", "pressure", "humidity")


def _measures(prefix: str = "") -> dict[str, Column]:
    at = lambda path: F.col(prefix + path)
    first = F.get(at("weather"), F.lit(0))
    columns = {"weather_id": first["id"], "weather_desc": first["main"]}
    columns |= {name: at(f"main.{name}") for name in _MAIN}
    columns |= {"wind_speed": at("wind.speed"), "cloudiness": at("clouds.all")}
    return columns


def _as_schema(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def current_rows(documents: DataFrame, polled_at: str = "date") -> DataFrame:
    """One row per parsed current-weather document; ``date`` is the poll time."""
    columns = {"date": F.col(polled_at)} | _measures()
    flat = documents.select(*[c.alias(n) for n, c in columns.items()])
    return _as_schema(flat, schemas.WEATHER_CURRENT)


def forecast_rows(
    documents: DataFrame, zone: str = "Europe/Paris", polled_at: str = "forecast_at"
) -> DataFrame:
    """One row per forecast step; rain and snow are optional."""
    steps = documents.select(
        F.col(polled_at).alias("forecast_at"), F.explode("list").alias("step")
    )
    columns = {
        "forecast_at": F.col("forecast_at"),
        "ts": epoch_to_local(F.col("step.dt"), zone),
        "rain_3h": F.col("step.rain.3h"),
        "snow_3h": F.col("step.snow.3h"),
    } | _measures("step.")
    flat = steps.select(*[c.alias(n) for n, c in columns.items()])
    return _as_schema(flat, schemas.WEATHER_FORECAST)


def _poll_time(value: datetime) -> Column:
    return F.lit(value.isoformat()).cast("timestamp_ntz")


def parse_current(
    spark: SparkSession, path: str | Sequence[str], polled_at: datetime
) -> Parsed:
    """Current weather of each document that could be read; the others are damaged."""
    documents, damaged = json_documents(spark, path, schemas.CURRENT_JSON)
    return Parsed(current_rows(documents.withColumn("date", _poll_time(polled_at))), damaged)


def parse_forecast(
    spark: SparkSession,
    path: str | Sequence[str],
    polled_at: datetime,
    zone: str = "Europe/Paris",
) -> Parsed:
    """Forecast steps, by time, of each document that could be read; the others are damaged."""
    documents, damaged = json_documents(spark, path, schemas.FORECAST_JSON)
    rows = forecast_rows(documents.withColumn("forecast_at", _poll_time(polled_at)), zone)
    return Parsed(rows.orderBy("ts"), damaged)


def read_current(
    spark: SparkSession, path: str | Sequence[str], polled_at: datetime
) -> DataFrame:
    return parse_current(spark, path, polled_at).rows


def read_forecast(
    spark: SparkSession,
    path: str | Sequence[str],
    polled_at: datetime,
    zone: str = "Europe/Paris",
) -> DataFrame:
    return parse_forecast(spark, path, polled_at, zone).rows
