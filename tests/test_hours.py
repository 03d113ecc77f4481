"""Stored hours: equal to the readings they come from, in any order of loads."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows_of

from docklens import jobs, schemas
from docklens.operators.changes import hourly_changes
from docklens.plans import hours, profiles, transactions
from docklens.sinks import hours as sink
from docklens.sinks.tables import append_readings, compact_readings
from docklens.sources.tables import read_table
from docklens.streaming.ingest import ingest, new_rows, read_stream

START = datetime(2024, 1, 1)


def some_readings(n=400, days=4, seed=1):
    """Gaps, ties, copies, closed and null counts, a null time; both cities, one hot station."""
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        station = draw.choice(["a", "a", "b", "c", "d"])
        minute = draw.choice([0, 59, 60, 61, draw.randrange(days * 1440)])
        bikes = draw.choice([None, *range(12)])
        status = draw.choice(["open", "open", "closed", None])
        city = draw.choice(["lyon", "bordeaux"])
        rows.append((city, station, START + timedelta(minutes=minute), 10, bikes, status))
    rows += draw.sample(rows, 40)
    return rows + [("lyon", "a", None, 1, 1, "open")]


def frame(spark, rows):
    return spark.createDataFrame(rows, schemas.TIMESERIES)


def store(spark, lake, loads):
    for name, rows in loads:
        append_readings(frame(spark, rows), lake, name)
        sink.refresh_hours(spark, lake, name)


def check(spark, lake, station):
    """Days and profiles of the stored hours are those of the stored readings."""
    readings = read_table(spark, lake, "timeseries")
    found = sink.read_hours(spark, lake)
    daily = ["city_key", "id", "date", "number"]
    assert rows_of(hours.daily_of_hours(found), *daily) == rows_of(
        transactions.daily_transactions(readings.drop("date")), *daily
    )
    day = transactions.aggregate_transactions(readings, "2024-01-02", "lyon")
    assert rows_of(hours.aggregate_hours(found, "2024-01-02", "lyon"), *daily) == rows_of(day, *daily)
    profile = ["city_key", "id", "hour", "sum", "mean"]
    for ids, window, city in ((None, 4, None), ("a,c", 2, "lyon")):
        rest = (station, ids, "2024-01-04", window, city)
        assert rows_of(hours.hourly_profile_of_hours(found, *rest), *profile) == rows_of(
            profiles.hourly_profile(readings, *rest), *profile
        )


@pytest.mark.parametrize("order", [1, 2, 3])
def test_loads_in_any_order(spark, make_station, tmp_path, order):
    rows = some_readings()
    loads = [(f"load {n}", rows[n::5]) for n in range(5)]
    random.Random(order).shuffle(loads)
    store(spark, str(tmp_path), [*loads, loads[0]])  # one is stored again
    check(spark, str(tmp_path), make_station("abcd"))


def test_compaction_removes_versions(spark, make_station, tmp_path):
    lake, rows = str(tmp_path), some_readings()
    store(spark, lake, [("one", rows), ("two", rows[:200]), ("three", rows)])
    compact_readings(spark, lake, "lyon", "2024-01-01", "2024-01-03")
    late = ("lyon", "a", START + timedelta(minutes=30), 10, 11, "open")
    store(spark, lake, [("late", [late])])  # counts although copies are gone
    found = hours.daily_of_hours(sink.read_hours(spark, lake))
    expected = transactions.daily_transactions(read_table(spark, lake, "timeseries").drop("date"))
    assert rows_of(found, "city_key", "id", "date", "number") == rows_of(
        expected, "city_key", "id", "date", "number"
    )
    for _ in range(2):
        jobs.compact_readings(spark, lake, "lyon", "2024-01-01", "2024-01-03")
        folder = tmp_path / "hour_change" / "city_key=lyon" / "date=2024-01-02"
        assert [p.name for p in folder.iterdir()] == ["load=compacted"]
        check(spark, lake, make_station("abcd"))


def test_a_late_load_stores_only_the_hours_it_touches(spark, make_readings, tmp_path):
    lake = str(tmp_path)
    many = [("a", f"2024-01-0{d}T{h:02d}:{m:02d}:00", h + m) for d in (1, 2) for h in range(24) for m in (0, 30)]
    for name, rows in (("first", many), ("late", [("b", "2024-01-01T05:10:00", 3)])):
        append_readings(make_readings(rows), lake, name)
        sink.refresh_hours(spark, lake, name)
    stored = spark.read.parquet(f"{lake}/hour_change").where("load = 'late' and scope = 'all'")
    assert rows_of(stored, "id", "bucket") == [
        ("a", datetime(2024, 1, 1, 5)), ("b", datetime(2024, 1, 1, 5))
    ]


def test_no_hours_and_no_readings(spark, make_station, tmp_path):
    lake = str(tmp_path)
    sink.refresh_hours(spark, lake, "none")
    sink.compact_hours(spark, lake, "lyon", "2024-01-01", "2024-01-02")
    assert sink.read_hours(spark, lake).count() == 0
    assert hours.daily_of_hours(sink.read_hours(spark, lake)).count() == 0
    store(spark, lake, [("timeless", [("lyon", "a", None, 1, 1, "open")])])
    assert sink.read_hours(spark, lake).count() == 0
    store(spark, lake, [("empty", [])])
    check(spark, lake, make_station("a"))


def test_the_plan_reads_no_reading_and_only_the_days_asked_for(spark, tmp_path, capsys, make_station):
    lake = str(tmp_path)
    store(spark, lake, [("one", some_readings(50))])
    found = sink.read_hours(spark, lake)
    for made in (
        hours.aggregate_hours(found, "2024-01-02", "lyon"),
        hours.hourly_profile_of_hours(found, make_station("a"), "a", "2024-01-03", 2, "lyon"),
    ):
        capsys.readouterr()
        made.explain("formatted")
        plan = capsys.readouterr().out
        read = [p for p in plan.splitlines() if p.startswith("Location")]
        assert len(read) == 1 and "hour_change" in read[0]
        folders = next(p for p in plan.splitlines() if p.startswith("PartitionFilters"))
        assert "city_key" in folders and "date" in folders
        pushed = next(p for p in plan.splitlines() if p.startswith("PushedFilters"))
        assert "scope" in pushed


def test_late_readings_of_a_stream(spark, make_station, tmp_path):
    """Files in any order, days late: no watermark, so the stored hours miss nothing."""
    lake, landed = str(tmp_path / "lake"), str(tmp_path / "landed")
    rows = some_readings(240)
    rows.sort(key=lambda r: r[2] or START, reverse=True)  # the newest come first
    for n in range(3):
        frame(spark, rows[n * 90 : (n + 1) * 90 + 20]).coalesce(1).write.mode("append").parquet(landed)
    for _ in range(2):  # the second call finds nothing new
        stream = read_stream(spark, landed, files_per_batch=1)
        ingest(stream, lake, str(tmp_path / "checkpoint"), writers=2, hours=True).awaitTermination()
    readings = read_table(spark, lake, "timeseries")
    assert readings.count() == len(set(rows))
    check(spark, lake, make_station("abcd"))


def test_readings_are_different_rows(spark, make_readings):
    rows = [("a", "2024-01-01T08:00:00", 5)] * 3 + [("a", "2024-01-01T08:30:00", 7)]
    found = hourly_changes(make_readings(rows), ["city_key", "id"]).first()
    assert (found.readings, found.changes, found.total) == (2, 3, 2)


def test_a_wrong_clock_does_not_widen_the_look_up(spark, make_readings, tmp_path, capsys):
    lake = str(tmp_path)
    held = [("a", f"2024-01-{d:02d}T08:00:00", d) for d in range(1, 10)]
    append_readings(make_readings(held), lake, "one")
    batch = make_readings([held[0], ("a", "2024-01-02T09:00:00", 3), ("a", "2031-05-05T09:00:00", 3)])
    capsys.readouterr()
    rows = new_rows(batch, lake, "two")
    rows.explain("formatted")
    plan = capsys.readouterr().out.splitlines()
    folders = next(p for p in plan if p.startswith("PartitionFilters"))
    assert "2024-01-01,2024-01-02,2031-05-05" in folders and "<=" not in folders
    assert rows_of(rows, "available_bikes") == [(3,), (3,)]
    timeless = spark.createDataFrame([("lyon", "a", None, 1, 1, "open")], schemas.TIMESERIES)
    append_readings(timeless, lake, "three")
    assert new_rows(timeless.union(timeless), lake, "four").count() == 0
    assert new_rows(batch.limit(0), lake, "four").count() == 0


def test_stored_and_new_readings_meet_in_one_shuffle(spark, tmp_path, make_readings):
    lake = str(tmp_path / "lake")
    rows = make_readings([("a", "2024-01-01T00:00:00", 1), ("a", "2024-01-01T00:00:00", None)])
    append_readings(rows, lake, "one")
    more = make_readings([("a", "2024-01-01T00:00:00", 2)])
    found = new_rows(rows.union(more).union(more), lake, "two")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
    assert [r.available_bikes for r in found.collect()] == [2]


def test_hours_shuffle_each_reading_once_for_both_scopes(make_readings):
    rows = make_readings([("a", "2024-01-01T00:00:00", 1)])
    plan = hours.hour_changes(rows)._jdf.queryExecution().executedPlan().toString()
    *above, source = plan.split("Exchange")
    assert len(above) == 2 and "Generate" not in above[1] + source
