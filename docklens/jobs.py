"""The recurring jobs: read stored tables, compute, write one part.

Every job can be run again with the same arguments; it then replaces what it
wrote before.  Where feeds are polled continuously, ``poll_readings`` stores each
file and each reading once, and ``compact_readings`` joins the loads of a day that
is over.  No job looks at the clock.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docklens.config import CITIES, as_date, as_datetime, check_city
from docklens.plans import clusters, forecast, hours as hourly, transactions
from docklens.plans.timeseries import Time, latest_open_rows
from docklens.sinks import hours as hour_sink
from docklens.sinks import models
from docklens.sinks import tables as sink
from docklens.sources import feeds, weather
from docklens.sources.stations import coordinates, normalise_stations, read_stations
from docklens.sources.tables import read_table
from docklens.streaming.ingest import ingest
from docklens.streaming.landing import land_feed, read_landed

PREDICTION_SPAN = timedelta(minutes=10)


def load_stations(raw: DataFrame, city: str, lake: str) -> None:
    """Replace a city's stations by a station extract."""
    sink.write_stations(normalise_stations(raw, CITIES[check_city(city)]), lake)


def load_station_files(
    spark: SparkSession, path: str, city: str, lake: str, kind: str = "geojson"
) -> None:
    """Replace a city's stations by those of extract files (``read_stations``).

    What could not be read goes to the table ``station_reject``.
    """
    rows, damaged = read_stations(spark, path, CITIES[check_city(city)], kind)
    sink.write_stations(rows, lake)
    rejects = damaged.withColumn("city_key", F.lit(city))
    sink.write_rejects(rejects, lake, "station_reject", city_key=city)


def read_feed(spark: SparkSession, path: str, city: str) -> feeds.FilledReadings:
    """Canonical readings of a city's landed snapshots, missing counts filled."""
    return feeds.read_feed(spark, path, CITIES[check_city(city)])


def load_readings(
    spark: SparkSession, path: str, city: str, lake: str, load: str, hours: bool = False
) -> DataFrame:
    """Add a city's landed snapshots as ``load``; returns the rows that were rejected.

    What could not be read of the snapshots goes to the table ``feed_reject``. With
    ``hours`` the hours of the load are stored, too (``sinks.hours``).
    """
    found = read_feed(spark, path, city)
    sink.append_readings(found.readings, lake, f"{city}-{load}")
    if hours:
        hour_sink.refresh_hours(spark, lake, f"{city}-{load}")
    sink.write_rejects(found.damaged, lake, "feed_reject", city_key=city, load=load)
    return found.rejects


def poll_readings(
    spark: SparkSession, path: str, city: str, lake: str, checkpoint: str, hours: bool = False
) -> None:
    """Append what is new in ``path`` since the last call, without copies.

    With ``hours`` the hours that the new readings touch are stored, too.
    """
    landed = f"{lake.rstrip('/')}/landed/{check_city(city)}"
    land_feed(spark, path, city, landed, f"{checkpoint}/land").awaitTermination()
    ingest(
        read_landed(spark, landed), lake, f"{checkpoint}/ingest", name=f"poll-{city}", hours=hours
    ).awaitTermination()


def compact_readings(
    spark: SparkSession, lake: str, city: str, start: date | str, stop: date | str
) -> None:
    """Join the loads of each day into one without copies, once the polls are over.

    The stored hours of these days, if there are any, become one load as well.
    """
    sink.compact_readings(spark, lake, check_city(city), start, stop)
    hour_sink.compact_hours(spark, lake, city, start, stop)


def roll_up_day(spark: SparkSession, lake: str, city: str, day: date | str) -> None:
    """Write the daily transactions of one day."""
    check_city(city)
    readings = read_table(spark, lake, "timeseries")
    sink.write_daily(transactions.aggregate_transactions(readings, day, city), lake)


def roll_up_hours(spark: SparkSession, lake: str, city: str, day: date | str) -> None:
    """The same from the stored hours; no reading is read."""
    check_city(city)
    hours = hour_sink.read_hours(spark, lake)
    sink.write_daily(hourly.aggregate_hours(hours, day, city), lake)


def cluster_patterns(
    spark: SparkSession, lake: str, city: str, start: date | str, stop: date | str
) -> None:
    """Fit the daily patterns of ``[start, stop)`` and write labels and centroids.

    Stations without a full profile go to the table ``clustering_reject``.
    """
    check_city(city)
    readings = read_table(spark, lake, "timeseries")
    found = clusters.compute_clusters(readings, city, start, stop)
    sink.write_clusters(found.labels, found.centroids, lake)
    run = {"city_key": city, "start": as_date(start), "stop": as_date(stop)}
    sink.write_rejects(found.rejects, lake, "clustering_reject", **run)


def cluster_places(spark: SparkSession, lake: str, city: str) -> None:
    """Fit the geographic clusters and write labels and centroids.

    Stations without coordinates go to the table ``geo_clustering_reject``.
    """
    check_city(city)
    points = coordinates(read_table(spark, lake, "station"))
    found = clusters.compute_geo_clusters(points, city)
    sink.write_geo_clusters(found.labels, found.centroids, lake)
    sink.write_rejects(found.rejects, lake, "geo_clustering_reject", city_key=city)


def train_forecast(
    spark: SparkSession,
    lake: str,
    city: str,
    start: Time,
    stop: Time,
    validation: Time,
    frequency: str = "30T",
) -> forecast.Trained:
    """Train on ``[start, stop)``, split at ``validation``, and save the model."""
    path = models.model_path(lake, city, start, stop, validation, frequency)
    readings = read_table(spark, lake, "timeseries")
    trained = forecast.train(readings, start, stop, validation, frequency, city)
    models.save_model(trained.model, path)
    return trained


def predict(
    spark: SparkSession,
    lake: str,
    city: str,
    train_start: Time,
    train_stop: Time,
    train_cut: Time,
    timestamp: datetime | str,
    predict_start: Time | None = None,
    frequency: str = "30T",
) -> None:
    """Forecast from the newest readings before ``timestamp`` with a saved model."""
    path = models.model_path(lake, city, train_start, train_stop, train_cut, frequency)
    stop = as_datetime(timestamp)
    start = stop - PREDICTION_SPAN if predict_start is None else as_datetime(predict_start)
    readings = read_table(spark, lake, "timeseries")
    rows = latest_open_rows(readings, start, stop, city)
    if rows.isEmpty():
        raise ValueError("no readings to predict from, check the dates")
    predicted = forecast.predict_bike_availability(rows, models.load_model(path), frequency)
    sink.write_predictions(predicted, lake, frequency)


def load_weather(
    spark: SparkSession, path: str, kind: str, polled_at: datetime, city: str, lake: str
) -> None:
    """Store landed weather documents of a city, ``current`` or ``forecast``.

    The documents of one poll replace what was stored of that poll. Those that could not
    be read go to the table ``weather_reject``.
    """
    parse = {"current": weather.parse_current, "forecast": weather.parse_forecast}[kind]
    rows, damaged = parse(spark, path, polled_at)
    sink.write_weather(rows.withColumn("city_key", F.lit(check_city(city))), lake, kind)
    run = {"city_key": city, "kind": kind, "polled": polled_at.strftime("%Y%m%dT%H%M%S")}
    sink.write_rejects(damaged, lake, "weather_reject", **run)
