import json
from datetime import date, datetime, timedelta

import pytest
from conftest import rows_of
from test_sources import WEATHER, feature, geojson, station_extract

from docklens import jobs
from docklens.config import LYON
from docklens.sinks.tables import write_stations
from docklens.sources.tables import read_table

START = datetime(2024, 1, 1)


def snapshots(folder, days=3):
    """Four stations that fill up at different hours, polled every 30 minutes."""
    folder.mkdir()
    peaks = {"1": (0, 8), "2": (8, 16), "3": (16, 24), "4": (0, 24)}
    for slot in range(days * 48):
        time = START + timedelta(minutes=30 * slot)
        rows = []
        for number, (low, high) in peaks.items():
            bikes = 18 if low <= time.hour < high else 2 + slot % 3
            row = feature(number, 20 - bikes, bikes)
            row["properties"]["last_update"] = time.isoformat(" ")
            rows.append(row)
        geojson(folder, f"{slot:03d}.json", *rows)


def test_the_jobs_build_a_lake(spark, tmp_path):
    lake, landed = str(tmp_path / "lake"), tmp_path / "landed"
    snapshots(landed)
    for number in ("1", "2", "3", "4"):
        raw = station_extract(spark, LYON.station_columns, 4.8, 45.7)
        rows = raw.withColumn("idstation", raw.idstation * 0 + int(number))
        stations = rows if number == "1" else stations.unionByName(rows)
    stations = stations.selectExpr(
        "cast(cast(idstation as int) as string) as idstation", "nom", "adresse1", "commune",
        "nbbornette", "x", "y",
    )
    jobs.load_stations(stations, "lyon", lake)
    assert rows_of(read_table(spark, lake, "station"), "id") == [("1",), ("2",), ("3",), ("4",)]

    for _ in range(2):
        rejects = jobs.load_readings(spark, str(landed), "lyon", lake, "january")
        assert rejects.count() == 0
    assert read_table(spark, lake, "timeseries").count() == 4 * 3 * 48

    for _ in range(2):
        jobs.roll_up_day(spark, lake, "lyon", "2024-01-02")
    daily = read_table(spark, lake, "daily_transaction")
    assert daily.count() == 4 and rows_of(daily, "date")[0] == (date(2024, 1, 2),)

    run = ("lyon", "2024-01-01", "2024-01-04")
    jobs.cluster_patterns(spark, lake, *run)
    assert len({r.cluster_id for r in read_table(spark, lake, "clustering").collect()}) == 4

    cut = "2024-01-03T12:00:00"
    trained = jobs.train_forecast(spark, lake, *run, cut)
    assert trained.train_loss[-1] < trained.train_loss[0]
    for _ in range(2):
        jobs.predict(spark, lake, *run, cut, "2024-01-03T20:05:00")
    stored = read_table(spark, lake, "prediction")
    assert rows_of(stored, "station_id", "timestamp", "frequency") == [
        (n, datetime(2024, 1, 3, 20, 30), "30T") for n in "1234"
    ]
    with pytest.raises(ValueError):
        jobs.predict(spark, lake, *run, cut, "2024-02-03T20:05:00")


def test_places_and_weather(spark, make_station, tmp_path):
    lake = str(tmp_path / "lake")
    write_stations(make_station([f"s{i:02d}" for i in range(20)]), lake)
    jobs.cluster_places(spark, lake, "lyon")
    assert read_table(spark, lake, "geo_centroid").count() == 12
    assert read_table(spark, lake, "geo_clustering").count() == 20
    (tmp_path / "w.json").write_text(json.dumps(WEATHER))
    jobs.load_weather(spark, str(tmp_path / "w.json"), "current", START, "lyon", lake)
    assert read_table(spark, lake, "weather_current").collect()[0].city_key == "lyon"
    with pytest.raises(ValueError):
        jobs.roll_up_day(spark, lake, "paris", "2024-01-02")
