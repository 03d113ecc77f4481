"""Queries over stored predictions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docklens.config import as_ids, check_count
from docklens.functions.timecols import step_text
from docklens.operators.topk import last_rows, only_ids
from docklens.plans.timeseries import KEYS, Time, latest_rows
from docklens.sources.tables import time_slice

_COLUMNS = ("city_key", "id", "timestamp", "nb_bikes", "nb_stands", "name", "at")


def _of_frequency(prediction: DataFrame, freq: str) -> DataFrame:
    return prediction.where(F.col("frequency") == step_text(freq)).withColumnRenamed(
        "station_id", "id"
    )


def prediction_timeseries(
    prediction: DataFrame,
    readings: DataFrame,
    station: DataFrame,
    city: str | None,
    ids: str | Iterable[object] | None,
    start: Time,
    stop: Time,
    values_num: int = 5,
    with_current: bool = False,
    freq: str = "1H",
    per_station: bool = False,
) -> DataFrame:
    """The last ``values_num`` predictions, after the readings when asked for.

    Predictions are tagged ``at`` with their horizon and readings with ``0``.
    The cut counts over all stations of a city together unless ``per_station``;
    ``values_num=0`` keeps every prediction.  Predictions of stations without a
    station row are dropped, readings of such stations are kept.
    """
    check_count("values_num", values_num)
    names = station.select(*KEYS, "name", F.col("nb_stations").alias("nb_stands"))
    wanted = None if ids is None else as_ids(ids)
    rows = only_ids(time_slice(_of_frequency(prediction, freq), start, stop, city), wanted)
    # the last rows of a city are among the last rows of its stations: cut before the join
    ends = last_rows(
        rows.select(*KEYS, "timestamp", "nb_bikes"), ["timestamp", "nb_bikes"], values_num, KEYS
    )
    predicted = (
        ends.join(names, KEYS).withColumn("at", F.lit(step_text(freq))).select(*_COLUMNS)
    )
    if not per_station:
        order = ["id", "timestamp", "nb_bikes"]
        predicted = last_rows(predicted, order, values_num, ["city_key"])
    if not with_current:
        return predicted.orderBy("city_key", "id", "timestamp")
    current = (
        only_ids(time_slice(readings, start, stop, city), wanted)
        .select(*KEYS, "timestamp", F.col("available_bikes").alias("nb_bikes"))
        .distinct()
        .join(names, KEYS, "left")
        .withColumn("at", F.lit("0"))
        .select(*_COLUMNS)
    )
    return current.unionByName(predicted)


def latest_predictions(
    prediction: DataFrame,
    station: DataFrame,
    as_of: Time,
    city: str | None = None,
    limit: int | None = None,
    geojson: bool = False,
    freq: str = "1H",
) -> DataFrame:
    """Newest prediction of one horizon per station."""
    return latest_rows(
        _of_frequency(prediction, freq), station, as_of, city, limit, geojson
    )
