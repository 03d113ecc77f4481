from datetime import date

import pytest
from conftest import at, rows_of
from pyspark.sql import functions as F

from docklens import schemas
from docklens.operators.latest import latest_date
from docklens.operators.topk import LITERAL_IDS, only_ids
from docklens.plans import predictions, rebase, stations, timeseries

SERIES = [
    ("a", "2024-01-10T00:00:00", 3),
    ("a", "2024-01-10T05:00:00", 4),
    ("a", "2024-01-12T00:00:00", 6),
    ("b", "2024-01-11T05:00:00", 1),
]


def test_range_is_half_open(make_readings, make_station):
    df = timeseries.timeseries(
        make_readings(SERIES), make_station(["a"]), "a,b", "2024-01-10", "2024-01-12", "lyon"
    )
    assert [(r.id, r.available_bikes, r.name, r.nb_stands) for r in df.collect()] == [
        ("a", 3, "name a", 20), ("a", 4, "name a", 20), ("b", 1, None, None),
    ]


@pytest.mark.parametrize("stretch, pieces", [("31D", 1), ("1D", 3), ("12H", 5)])
def test_nested_series_keeps_every_reading_in_order(
    make_readings, make_station, stretch, pieces
):
    rows = [
        ("a", f"2024-01-{1 + i // 24:02d}T{i % 24:02d}:{m:02d}:00", i)
        for i in range(50)
        for m in (0, 30)
    ]
    df = timeseries.timeseries_nested(
        make_readings(rows[::-1]), make_station(["a"]), None, "2024-01-01", "2024-02-01",
        stretch=stretch,
    )
    found = df.orderBy("piece").collect()
    assert [r.piece for r in found] == list(range(pieces))
    assert [b for r in found for b in r.available_bikes] == [row[2] for row in rows]
    assert [t for r in found for t in r.ts] == [at(row[1]) for row in rows]
    assert found[0].name == "name a" and found[0].nb_stands == 20


@pytest.mark.parametrize("n", [1, 7, 1000])
def test_pieces_do_not_depend_on_the_number_of_rows(make_readings, make_station, n):
    rows = (
        [("a", "2024-01-01T00:00:00", 1)]
        + [("a", "2024-01-01T00:10:00", 2)] * n
        + [("a", "2024-01-01T00:10:00", 3), ("a", "2024-01-01T05:00:00", None)]
    )
    df = timeseries.timeseries_nested(
        make_readings(rows), make_station([]), None, "2024-01-01", "2024-02-01"
    )
    found = df.collect()
    assert [r.piece for r in found] == [0]
    assert found[0].available_bikes == [row[2] for row in rows]
    assert found[0].status == ["open"] * (n + 3)


def test_latest_keeps_ties_and_drops_old_or_unknown_stations(make_readings, make_station):
    rows = [
        ("a", "2024-01-30T10:00:00", 3),
        ("a", "2024-01-30T10:00:00", 4),
        ("a", "2024-01-30T09:00:00", 9),
        ("b", "2024-01-28T23:59:59", 1),  # before the two days
        ("c", "2024-01-30T10:00:00", 1),  # no station row
        ("d", "2024-01-29T00:00:00", 2),  # on the bound
    ]
    station = make_station(["a", "b", "d"])
    df = timeseries.latest_availability(make_readings(rows), station, "2024-01-31")
    assert rows_of(df, "id", "nb_bikes") == [("a", 3), ("a", 4), ("d", 2)]
    assert latest_date(df).collect()[0].date == at("2024-01-30T10:00:00")
    two = timeseries.latest_availability(make_readings(rows), station, "2024-01-31", limit=2)
    assert [r.id for r in two.collect()] == ["a", "a"]
    ratio = stations.fill_ratio(df).where("id = 'd'").collect()[0].ratio
    assert ratio == pytest.approx(0.1)


def test_latest_of_nothing_has_a_null_date(make_readings, make_station):
    df = timeseries.latest_availability(make_readings([]), make_station(["a"]), "2024-01-31")
    assert df.count() == 0
    assert latest_date(df).collect()[0].date is None


def test_latest_in_window_needs_open_and_docks(make_readings):
    rows = [
        ("a", "2024-01-10T10:00:00", 4, 6),
        ("a", "2024-01-10T10:00:00", 4, 6),  # copy
        ("a", "2024-01-10T11:00:00", 4, 6, "closed"),
        ("a", "2024-01-10T12:00:00", 0, 0),
        ("b", "2024-01-11T00:00:00", 1, 1),  # on the open end
    ]
    df = timeseries.latest_station_timewindow(
        make_readings(rows), "2024-01-10", "2024-01-11"
    )
    assert rows_of(df, "station_id", "nb_bikes", "nb_stands", "probability") == [
        ("a", 4, 6, 0.4)
    ]


def test_geojson_feature(make_readings, make_station):
    df = timeseries.latest_availability(
        make_readings(SERIES), make_station(["a"]), "2024-01-12", geojson=True
    )
    feature = df.collect()[0]
    assert feature.type == "Feature"
    assert feature.geometry.type == "Point"
    assert feature.geometry.coordinates == [4.8, 45.7]
    assert list(feature.properties.asDict()) == [
        "id", "name", "timestamp", "nb_bikes", "nb_stands"
    ]


@pytest.fixture
def prediction(spark):
    rows = [
        ("lyon", at(f"2024-01-10T0{h}:00:00"), "1H", s, 0.5, h + 10 * int(s), 3)
        for s in ("1", "2")
        for h in (1, 2, 3)
    ]
    rows.append(("lyon", at("2024-01-10T04:00:00"), "30T", "2", 0.5, 99, 3))
    rows.append(("lyon", at("2024-01-10T04:00:00"), "1H", "9", 0.5, 99, 3))
    return spark.createDataFrame(rows, schemas.PREDICTION)


def _tail(prediction, make_readings, make_station, values, **more):
    readings = make_readings(
        [("1", "2024-01-10T01:00:00", 7), ("1", "2024-01-10T01:00:00", 7),
         ("9", "2024-01-10T01:00:00", 8)]
    )
    return predictions.prediction_timeseries(
        prediction, readings, make_station(["1", "2"]), "lyon", "1,2,9",
        "2024-01-10", "2024-01-11", values, **more,
    )


def test_tail_counts_over_all_stations(prediction, make_readings, make_station):
    df = _tail(prediction, make_readings, make_station, 2)
    assert [(r.id, r.nb_bikes, r["at"]) for r in df.collect()] == [
        ("2", 22, "1H"), ("2", 23, "1H")
    ]
    assert _tail(prediction, make_readings, make_station, 0).count() == 6
    each = _tail(prediction, make_readings, make_station, 1, per_station=True)
    assert rows_of(each, "id", "nb_bikes") == [("1", 13), ("2", 23)]


def test_current_values_come_with_the_tail(prediction, make_readings, make_station):
    df = _tail(prediction, make_readings, make_station, 1, with_current=True)
    assert rows_of(df, "id", "nb_bikes", "at") == [
        ("1", 7, "0"), ("2", 23, "1H"), ("9", 8, "0")
    ]


def test_latest_predictions(prediction, make_station):
    df = predictions.latest_predictions(
        prediction, make_station(["1", "2"]), "2024-01-11", "lyon", freq="60T"
    )
    assert rows_of(df, "id", "nb_bikes") == [("1", 13), ("2", 23)]


def test_station_queries(make_station):
    station = make_station(["93", "35", "100"]).unionByName(make_station(["7"], "bordeaux"))
    assert rows_of(stations.cities(station), "city", "country", "stations") == [
        ("bordeaux", "france", 1), ("lyon", "france", 3)
    ]
    listed = stations.stations(station, "lyon", 2)
    assert listed.columns == [
        "city_key", "id", "name", "address", "city", "nb_stands", "x", "y"
    ]
    assert [r.id for r in listed.collect()] == ["100", "35"]
    two = stations.specific_stations(station, [93, 35], "lyon")
    assert rows_of(two, "id") == [("35",), ("93",)]
    assert stations.specific_stations(station, []).count() == 0
    assert rows_of(stations.station_ids(station, "bordeaux"), "id") == [("7",)]
    with pytest.raises(ValueError):
        stations.stations(station, "paris")
    with pytest.raises(ValueError):
        stations.stations(station, "lyon", -1)


def test_many_ids_become_a_join(make_station):
    station = make_station(["a", "b"])
    many = [f"x{i}" for i in range(LITERAL_IDS)] + ["b"]
    joined = only_ids(station, many)
    assert rows_of(joined, "id") == [("b",)] and joined.columns == station.columns


def test_rebase(make_readings, spark):
    readings = make_readings(SERIES)
    moved = rebase.rebase_times(readings, readings, "2024-02-01T00:00:00")
    assert moved.agg(F.max("timestamp")).collect()[0][0] == at("2024-02-01T00:00:00")
    assert moved.agg(F.min("timestamp")).collect()[0][0] == at("2024-01-30T00:00:00")
    daily = spark.createDataFrame(
        [("lyon", "a", 1.0, date(2024, 1, 1)), ("lyon", "b", 1.0, date(2024, 1, 3))],
        schemas.DAILY_TRANSACTION,
    )
    assert rows_of(rebase.rebase_dates(daily, "2024-02-01"), "date") == [
        (date(2024, 1, 30),), (date(2024, 2, 1),)
    ]
