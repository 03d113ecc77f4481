import json
from datetime import date, datetime

import pytest
from conftest import rows_of

from docklens import schemas
from docklens.api import BikeShare
from docklens.plans import transactions
from docklens.sinks import export, tables as sink
from docklens.sources.feeds import drop_unloadable, read_snapshot_csv
from docklens.sources.tables import read_table, time_slice

READINGS = [
    ("a", "2024-01-01T08:00:00", 5),
    ("a", "2024-01-01T09:00:00", 7),
    ("a", "2024-01-02T08:00:00", 1),
    ("b", "2024-01-02T08:00:00", 2),
]


def test_readings_are_appended_and_pruned(spark, make_readings, tmp_path, capsys):
    lake = str(tmp_path)
    for _ in range(2):  # a load that is stored again replaces itself
        sink.append_readings(make_readings(READINGS[:2]), lake, "one")
        sink.append_readings(make_readings(READINGS[2:]), lake, "two")
    sink.append_readings(make_readings(READINGS[:1], "bordeaux"), lake, "one")
    table = read_table(spark, lake, "timeseries")
    assert table.count() == 5
    day = time_slice(table, "2024-01-02", "2024-01-03", "lyon")
    assert rows_of(day, "id", "available_bikes") == [("a", 1), ("b", 2)]
    day.explain()
    plan = capsys.readouterr().out
    partition_filters = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "city_key" in partition_filters and "date" in partition_filters
    assert "timestamp" in plan.split("PushedFilters: ")[1]


def test_loads_become_one(spark, make_readings, tmp_path):
    lake = str(tmp_path)
    for load in ("one", "two"):
        sink.append_readings(make_readings(READINGS), lake, load)
    sink.append_readings(make_readings(READINGS, "bordeaux"), lake, "one")
    day = tmp_path / "timeseries" / "city_key=lyon" / "date=2024-01-01"
    for _ in range(2):
        sink.compact_readings(spark, lake, "lyon", "2024-01-01", "2024-01-01")
        assert [p.name for p in day.iterdir()] == ["load=compacted"]
        assert read_table(spark, lake, "timeseries").count() == 2 + 2 * 2 + 4
    sink.append_readings(make_readings(READINGS[:1]), lake, "three")
    sink.compact_readings(spark, lake, "lyon", "2024-01-01", "2024-01-31")
    assert read_table(spark, lake, "timeseries").where("city_key = 'lyon'").count() == 4
    sink.compact_readings(spark, str(tmp_path / "none"), "lyon", "2024-01-01", "2024-01-31")


def test_predictions_read_only_the_days_they_touch(spark, tmp_path, capsys):
    lake = str(tmp_path)
    row = lambda day, station: (
        "lyon", datetime(2024, 1, day, 10), "1H", station, 0.5, 1, 10
    )
    make = lambda *rows: spark.createDataFrame(rows, schemas.PREDICTION)
    sink.write_predictions(make(row(1, "a"), row(2, "a"), row(9, "a")), lake)
    old = sink.stored(spark, f"{lake}/prediction", read_table(spark, lake, "prediction").schema)
    rows = make(row(2, "b")).selectExpr("*", "to_date(timestamp) as date")
    capsys.readouterr()
    sink.kept_predictions(old, rows).explain("formatted")
    filters = capsys.readouterr().out.split("PartitionFilters: ")[1].splitlines()[0]
    assert "date#" in filters and "2024-01-02" in filters and "lyon" in filters
    # two days far apart are two days, not all between them
    capsys.readouterr()
    apart = make(row(1, "b"), row(9, "b")).selectExpr("*", "to_date(timestamp) as date")
    sink.kept_predictions(old, apart).explain("formatted")
    filters = capsys.readouterr().out.split("PartitionFilters: ")[1].splitlines()[0]
    assert "2024-01-01,2024-01-09" in filters and "<=" not in filters
    assert sink.kept_predictions(old, rows.limit(0)).count() == 0
    assert rows_of(sink.kept_predictions(old, rows), "station_id", "date") == [
        ("a", date(2024, 1, 2))
    ]


def test_a_lake_may_lack_tables(spark, make_readings, tmp_path):
    sink.append_readings(make_readings(READINGS), str(tmp_path), "one")
    share = BikeShare.from_lake(spark, str(tmp_path))
    assert share.aggregate_transactions("lyon", "2024-01-01").count() == 1
    assert share.latest_predictions("lyon", "2024-01-03").count() == 0


def test_daily_rows_replace_their_days(spark, make_readings, tmp_path):
    lake = str(tmp_path)
    readings = make_readings(READINGS)
    for _ in range(2):
        sink.write_daily(transactions.daily_transactions(readings), lake)
    table = read_table(spark, lake, "daily_transaction")
    expected = [("a", 0.0, date(2024, 1, 2)), ("a", 2.0, date(2024, 1, 1)),
                ("b", 0.0, date(2024, 1, 2))]
    assert rows_of(table, "id", "number", "date") == expected
    # another day of the same city leaves the stored days alone
    later = make_readings([("a", "2024-01-03T08:00:00", 1)])
    sink.write_daily(transactions.aggregate_transactions(later, "2024-01-03"), lake)
    assert read_table(spark, lake, "daily_transaction").count() == 4


def test_predictions_replace_equal_keys(spark, tmp_path):
    lake = str(tmp_path)
    time = datetime(2024, 1, 1, 10)
    row = lambda station, bikes, hour=10, freq="1H": (
        "lyon", time.replace(hour=hour), freq, station, 0.5, bikes, 10
    )
    make = lambda *rows: spark.createDataFrame(rows, schemas.PREDICTION)
    sink.write_predictions(make(row("1", 1), row("2", 2), row("1", 3, 11)), lake)
    sink.write_predictions(make(row("1", 9), row("1", 9), row("1", 5, freq="30T")), lake)
    found = read_table(spark, lake, "prediction")
    assert rows_of(found, "station_id", "timestamp", "frequency", "nb_bikes") == [
        ("1", time, "1H", 9), ("1", time, "30T", 5),
        ("1", time.replace(hour=11), "1H", 3), ("2", time, "1H", 2),
    ]
    with pytest.raises(ValueError):
        sink.write_predictions(make(row("1", 1), row("1", 2)), lake)


def test_cluster_tables(spark, tmp_path):
    lake = str(tmp_path)
    run = (date(2024, 1, 1), date(2024, 1, 8))
    labels = spark.createDataFrame([("lyon", "a", *run, "1")], schemas.CLUSTERING)
    centre = spark.createDataFrame([("lyon", "1", *run, *[0.5] * 24)], schemas.CENTROID)
    for _ in range(2):
        sink.write_clusters(labels, centre, lake)
    assert rows_of(read_table(spark, lake, "clustering"), "station_id", "start", "cluster_id") == [
        ("a", run[0], "1")
    ]
    assert read_table(spark, lake, "centroid").collect()[0].h23 == 0.5
    with pytest.raises(ValueError):
        sink.write_clusters(labels.unionByName(labels), centre, lake)
    geo = spark.createDataFrame([("lyon", "a", 3)], schemas.GEO_CLUSTERING)
    place = spark.createDataFrame([("lyon", 3, 45.0, 4.0)], schemas.GEO_CENTROID)
    for _ in range(2):
        sink.write_geo_clusters(geo, place, lake)
    assert rows_of(read_table(spark, lake, "geo_clustering"), "station_id", "cluster_id") == [("a", 3)]
    assert rows_of(read_table(spark, lake, "geo_centroid"), "lat", "lon") == [(45.0, 4.0)]


def test_snapshot_csv_round_trip(spark, make_readings, tmp_path):
    path = str(tmp_path / "csv")
    sink.write_snapshot_csv(make_readings(READINGS), path)
    found = drop_unloadable(read_snapshot_csv(spark, f"{path}/city_key=lyon/date=2024-01-02"))
    assert rows_of(found, "id", "available_bikes") == [("a", 1), ("b", 2)]
    with pytest.raises(Exception, match="exist"):
        sink.write_snapshot_csv(make_readings(READINGS), path)


def test_snapshots_and_weather(spark, make_readings, tmp_path):
    for _ in range(2):  # a poll that is stored again replaces itself
        sink.write_snapshots(make_readings(READINGS), str(tmp_path), "10H00")
    assert spark.read.parquet(str(tmp_path / "snapshot")).count() == 4
    rows = spark.createDataFrame(
        [(datetime(2024, 1, 1, 10), 800, "Clear", 1.0, 0.0, 2.0, 1000.0, 50.0, 3.0, 10)],
        schemas.WEATHER_CURRENT,
    )
    rows = rows.selectExpr("*", "'lyon' as city_key")
    for _ in range(2):
        sink.write_weather(rows, str(tmp_path), "current")
    found = read_table(spark, str(tmp_path), "weather_current")
    assert [r.temp for r in found.collect()] == [1.0]
    assert found.columns == [*schemas.WEATHER_CURRENT.names, "city_key"]
    with pytest.raises(ValueError):
        sink.write_weather(rows, str(tmp_path), "past")


def test_json_formats(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", date(2024, 1, 2), datetime(2024, 1, 2, 10, 5, 6, 789), None, [date(2024, 1, 1)])],
        "id string, date date, timestamp timestamp_ntz, value double, dates array<date>",
    )
    expected = {
        "id": "a", "date": "2024-01-02", "timestamp": "2024-01-02T10:05:06", "value": None,
        "dates": ["2024-01-01"],
    }
    assert json.loads(export.json_rows(df).collect()[0].json) == expected
    assert export.iso_text(df).collect()[0].asDict() == expected
    export.write_json(df, str(tmp_path / "out"))
    lines = spark.read.text(str(tmp_path / "out")).collect()
    assert json.loads(lines[0].value) == expected


def test_query_object_over_a_stored_lake(spark, make_readings, make_station, tmp_path):
    lake = str(tmp_path)
    readings = make_readings(READINGS)
    sink.append_readings(readings, lake, "one")
    sink.write_daily(transactions.daily_transactions(readings), lake)
    sink.write_stations(make_station(["a", "b"]), lake)
    sink.write_predictions(
        spark.createDataFrame(
            [("lyon", datetime(2024, 1, 2, 9), "1H", "a", 0.5, 5, 5)], schemas.PREDICTION
        ),
        lake,
    )
    run = (date(2024, 1, 1), date(2024, 1, 8))
    sink.write_clusters(
        spark.createDataFrame([("lyon", "a", *run, "1")], schemas.CLUSTERING),
        spark.createDataFrame(
            [("lyon", str(c), *run, *[c / 10 + h * c / 100 for h in range(24)]) for c in range(4)],
            schemas.CENTROID,
        ),
        lake,
    )
    share = BikeShare.from_lake(spark, lake)
    assert share.cities().collect()[0].stations == 2
    assert share.stations("lyon", 1).count() == 1
    assert share.specific_stations("lyon", "a").count() == 1
    assert share.station_ids("lyon").count() == 2
    top = share.daily_transaction_list("lyon", "2024-01-01", 1, "value").collect()
    assert (top[0].id, top[0].value) == ("a", [2.0])
    days = share.daily_transaction("lyon", "a", "2024-01-02", 1).collect()[0]
    assert days.value == [2.0, 0.0]
    series = share.timeseries("lyon", "a", "2024-01-01", "2024-01-02").collect()[0]
    assert series.available_bikes == [5, 7]
    assert share.latest_availability("lyon", "2024-01-03").count() == 2
    assert share.latest_predictions("lyon", "2024-01-03").count() == 1
    tail = share.prediction_timeseries("lyon", "a", "2024-01-01", "2024-01-03")
    assert tail.collect()[0]["at"] == "1H"
    assert share.hourly_profile("lyon", "a", "2024-01-03").collect()[0].hour[0] == 0
    assert share.daily_profile("lyon", "a", "2024-01-03").collect()[0].day == [0, 1]
    assert share.station_clusters("lyon").collect()[0].cluster_id == "1"
    assert share.cluster_profiles("lyon").count() == 4
    assert share.latest_station_timewindow("lyon", "2024-01-01", "2024-01-03").count() == 2
    assert share.aggregate_transactions("lyon", "2024-01-01").collect()[0].number == 2.0
    latest = share.latest_date(share.latest_availability("lyon", "2024-01-03"))
    assert latest.collect()[0].date == datetime(2024, 1, 2, 8)
