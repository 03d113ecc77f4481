import random
from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from conftest import at, rows_of
from pyspark.sql import functions as F

from docklens.functions.timecols import calendar
from docklens.operators import grid
from docklens.plans import clusters, forecast
from docklens.plans.timeseries import open_readings

KEY = ["station_id"]
VALUES = ["nb_bikes", "nb_stands", "probability"]


def frame_of(spark, rows, values=("nb_bikes",)):
    ddl = "station_id string, ts timestamp_ntz, " + ", ".join(f"{v} double" for v in values)
    return spark.createDataFrame([(r[0], at(r[1]), *map(_f, r[2:])) for r in rows], ddl)


def _f(value):
    return None if value is None else float(value)


def test_backfill_takes_the_next_bin_of_the_same_station(spark):
    df = frame_of(spark, [
        ("1", "2024-01-01T00:01:00", 1), ("1", "2024-01-01T00:21:00", 3),
        ("2", "2024-01-01T00:33:00", 7), ("2", "2024-01-01T00:59:00", 9),
    ])
    found = grid.resample_mean(df, KEY, ["nb_bikes"], "10T")
    assert [(i, t.minute, v) for i, t, v in rows_of(found, "station_id", "ts", "nb_bikes")] == [
        ("1", 0, 1.0), ("1", 10, 3.0), ("1", 20, 3.0),
        ("2", 30, 7.0), ("2", 40, 9.0), ("2", 50, 9.0),
    ]


def test_unknown_counts_are_filled_from_later_bins(spark):
    df = frame_of(spark, [
        ("1", "2024-01-01T00:00:00", None), ("1", "2024-01-01T00:20:00", 3),
        ("1", "2024-01-01T00:30:00", None),
    ])
    found = grid.resample_mean(df, KEY, ["nb_bikes"], "10T")
    assert [r.nb_bikes for r in found.orderBy("ts").collect()] == [3.0, 3.0, 3.0, None]


def random_rows(seed, stations=3, count=60, days=4):
    rng = np.random.default_rng(seed)
    seconds = rng.integers(0, days * 86400, count)
    return pd.DataFrame({
        "station_id": [f"s{i}" for i in rng.integers(0, stations, count)],
        "ts": pd.Timestamp("2024-01-04") + pd.to_timedelta(seconds, unit="s"),
        "nb_bikes": rng.integers(0, 20, count).astype(float),
    })


def dense(rows, minutes):
    """(station, grid point) -> mean of the bin, or of the next one that has readings."""
    day = pd.Timestamp("2024-01-01")
    bins = {}
    for r in rows.itertuples():
        number = int((r.ts - day).total_seconds()) // (60 * minutes)
        bins.setdefault(r.station_id, {}).setdefault(number, []).append(r.nb_bikes)
    grid_points = {}
    for station, known in bins.items():
        value = None
        for number in range(max(known), min(known) - 1, -1):
            if number in known:
                value = sum(known[number]) / len(known[number])
            grid_points[station, day + pd.Timedelta(minutes=number * minutes)] = value
    return grid_points


@pytest.mark.parametrize("seed, step, minutes", [(1, "10T", 10), (2, "5T", 5), (3, "1H", 60)])
def test_resample_equals_brute_force(spark, seed, step, minutes):
    frame = random_rows(seed)
    rows = [(r.station_id, r.ts.isoformat(), r.nb_bikes) for r in frame.itertuples()]
    found = grid.resample_mean(frame_of(spark, rows), KEY, ["nb_bikes"], step)
    got = {(r.station_id, pd.Timestamp(r.ts)): r.nb_bikes for r in found.collect()}
    assert got == pytest.approx(dense(frame, minutes))


def hour_matrix(rows):
    """(hour, station) -> weekday mean of the grid over the station's largest hour."""
    values = {}
    for (station, time), value in dense(rows, 5).items():
        if time.weekday() not in (5, 6):
            values.setdefault(station, {}).setdefault(time.hour, []).append(value)
    matrix = {}
    for station, hours in values.items():
        means = {hour: sum(v) / len(v) for hour, v in hours.items()}
        top = max(means.values())
        matrix |= {(hour, station): mean / top for hour, mean in means.items()}
    return matrix


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_hour_profiles_equal_brute_force(spark, seed):
    active = random_rows(seed, days=9)
    idle = pd.DataFrame({"station_id": "idle", "ts": active.ts.head(3), "nb_bikes": 0.0})
    frame = pd.concat([active, idle])
    rows = [(r.station_id, r.ts.isoformat(), r.nb_bikes) for r in frame.itertuples()]
    df = frame_of(spark, rows).withColumn("city_key", F.lit("lyon"))
    got = {
        (r.hour, r.station_id): r.value for r in clusters.hour_profiles(df).collect()
    }
    assert got == pytest.approx(hour_matrix(active))


def test_hour_profiles_ignore_the_weekend(make_readings):
    readings = make_readings([
        ("a", "2024-01-05T23:57:00", 4), ("a", "2024-01-08T00:02:00", 10),
        ("a", "2024-01-08T01:03:00", 5),
        ("z", "2024-01-08T00:00:00", 0), ("z", "2024-01-08T01:00:00", 0),
    ])
    rows = clusters.cluster_input(readings, "2024-01-01", "2024-02-01")
    got = {(r.station_id, r.hour): r.value for r in clusters.hour_profiles(rows).collect()}
    assert got == pytest.approx(
        {("a", 0): 1.0, ("a", 1): 5 / 5.416666667, ("a", 23): 4 / 5.416666667}
    )


def test_wide_and_long_profiles_are_inverse(spark):
    rows = [("lyon", s, h, float(h)) for s in ("a", "b") for h in range(24)]
    long = spark.createDataFrame(rows, "city_key string, station_id string, hour int, value double")
    wide = clusters.wide_profiles(long)
    assert wide.columns[2:] == [f"h{h:02d}" for h in range(24)]
    back = clusters.long_profiles(wide, ["city_key", "station_id"])
    assert rows_of(back, *long.columns) == sorted(rows)


@pytest.fixture
def steps(spark):
    rows = [("1", f"2024-01-01T00:{m}0:00", (m + 1) / 10) for m in range(4)]
    return frame_of(spark, rows, ["probability"])


@pytest.mark.parametrize("step", ["10T", None])
def test_future_label(steps, step):
    found = grid.add_future(steps, "20T", step, KEY)
    assert [(r.ts.minute, r.future) for r in found.orderBy("ts").collect()] == [
        (0, 0.3), (10, 0.4)
    ]
    assert found.columns == ["station_id", "ts", "probability", "future"]


@pytest.mark.parametrize("step", ["10T", None])
def test_future_between_grid_points_has_no_partner(steps, step):
    assert grid.add_future(steps, "15T", step, KEY).count() == 0


@pytest.mark.parametrize("frequency", ["10T", "30T", "2H", "15T"])
def test_label_found_before_the_grid_is_that_of_the_grid(spark, frequency):
    rng = random.Random(frequency)
    first = at("2024-01-01T00:00:00")
    rows = [("lyon", s, first + timedelta(minutes=rng.randrange(700)),
             *[rng.choice([None, rng.random()]) for _ in VALUES])
            for s in ("a", "b", None) for _ in range(40)]
    rows += [("lyon", "a", None, 1.0, 1.0, 1.0), ("lyon", "c", None, 1.0, 1.0, 1.0),
             ("lyon", "d", first, 1.0, None, 0.5)]
    ddl = "city_key string, station_id string, ts timestamp_ntz, " + ", ".join(
        f"{v} double" for v in VALUES
    )
    df = spark.createDataFrame(rows, ddl)
    want = grid.add_future(grid.resample_mean(df), frequency, "10T")
    got = grid.resample_future(df, frequency)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_no_grid_is_sorted_for_its_label(make_readings):
    rows = open_readings(make_readings([("a", "2024-01-01T00:00:00", 4)]), "2024-01-01", "2024-02-01")
    plan = forecast.labelled(rows, "30T")._jdf.queryExecution().executedPlan().toString()
    above_the_grid, *below = plan.split("Generate explode")
    assert below
    assert "Sort" not in above_the_grid and "Window" not in above_the_grid


def test_calendar(steps):
    row = calendar(steps).orderBy("ts").collect()[1]
    assert (row.day, row.hour, row.minute) == (0, 0, 10)


def test_split_bounds_are_closed(spark):
    rows = [("1", f"2024-01-01T{h:02d}:{m}0:00", 0.5) for h in range(5) for m in (0, 3)]
    df = frame_of(spark, rows, ["probability"]).selectExpr("*", "0.1D as future")
    split = forecast.prepare_data_for_training(
        df, "2024-01-01T02:00:00", "1H", "2024-01-01T00:30:00", periods=1
    )
    hours = lambda part: [t.strftime("%H:%M") for (t,) in rows_of(part, "ts")]
    assert hours(split.train) == ["00:30", "01:00"]
    assert hours(split.test) == ["02:00", "02:30", "03:00"]
    assert "probability" not in split.train.columns
