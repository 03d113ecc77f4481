from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from conftest import rows_of

from docklens import schemas
from docklens.plans import profiles, transactions

E1 = [
    ("a", "2024-01-01T08:00:00", 5),
    ("b", "2024-01-01T08:00:00", 1),
    ("b", "2024-01-01T09:30:00", 4),
    ("b", "2024-01-01T12:00:00", 2),
    ("c", "2024-01-01T08:00:00", None),
    ("c", "2024-01-01T09:00:00", None),
]


def totals(readings):
    df = transactions.daily_transactions(readings)
    return {(r.id, str(r.date)): r.number for r in df.collect()}


def test_daily_totals(make_readings):
    day = "2024-01-01"
    assert totals(make_readings(E1)) == {("a", day): 0.0, ("b", day): 5.0, ("c", day): 0.0}


def test_copies_closed_rows_and_midnight(make_readings):
    rows = E1 + [
        ("b", "2024-01-01T09:30:00", 4),  # exact copy
        ("b", "2024-01-01T09:00:00", 9, 1, "closed"),
        ("b", "2024-01-02T00:01:00", 9),
    ]
    found = totals(make_readings(rows))
    assert found[("b", "2024-01-01")] == 5.0
    assert found[("b", "2024-01-02")] == 0.0


def test_unknown_count_hides_both_differences(make_readings):
    rows = [("a", f"2024-01-01T0{h}:00:00", v) for h, v in enumerate([1, None, 4, 6])]
    assert totals(make_readings(rows)) == {("a", "2024-01-01"): 2.0}


def test_day_argument_is_half_open(make_readings):
    rows = [
        ("a", "2024-01-01T23:59:59", 1),
        ("a", "2024-01-02T00:00:00", 2),
        ("a", "2024-01-02T10:00:00", 5),
        ("a", "2024-01-03T00:00:00", 9),
    ]
    df = transactions.aggregate_transactions(make_readings(rows), "2024-01-02", "lyon")
    assert rows_of(df, "id", "number", "date") == [("a", 3.0, date(2024, 1, 2))]


def random_readings(seed, stations=4, count=400, days=3):
    """Dense random readings with equal times, copies and unknown counts."""
    rng = np.random.default_rng(seed)
    start = pd.Timestamp("2024-03-30")
    seconds = rng.integers(0, days * 86400 // 60, count) * 60
    # one station holds most of the rows
    ids = np.where(rng.random(count) < 0.6, 0, rng.integers(1, stations, count))
    frame = pd.DataFrame(
        {
            "id": [f"s{i}" for i in ids],
            "timestamp": [start + timedelta(seconds=int(s)) for s in seconds],
            "available_bikes": rng.integers(0, 20, count).astype(object),
            "available_stands": rng.integers(0, 20, count),
            "status": np.where(rng.random(count) < 0.9, "open", "closed"),
        }
    )
    frame.loc[rng.random(count) < 0.03, "available_bikes"] = None
    return pd.concat([frame, frame.sample(40, random_state=seed)])


def to_spark(spark, frame):
    rows = [
        ("lyon", r.id, r.timestamp.to_pydatetime(), int(r.available_stands),
         None if r.available_bikes is None else int(r.available_bikes), r.status)
        for r in frame.itertuples()
    ]
    return spark.createDataFrame(rows, schemas.TIMESERIES)


def steps_of(rows):
    """(time, |difference|) of one station's rows, with unknown ones left out."""
    low = -1  # unknown counts come first among equal times
    ordered = sorted(rows, key=lambda r: (r[0], low if r[1] is None else r[1], r[2]))
    steps = []
    for before, after in zip(ordered, ordered[1:]):
        if before[1] is not None and after[1] is not None:
            steps.append((after[0], abs(after[1] - before[1])))
    return steps


def by_station(frame):
    """id -> [(time, bikes, stands, status)]"""
    rows = {}
    for r in frame.itertuples():
        bikes = None if r.available_bikes is None else int(r.available_bikes)
        rows.setdefault(r.id, []).append(
            (r.timestamp.to_pydatetime(), bikes, int(r.available_stands), r.status)
        )
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_daily_totals_equal_brute_force(spark, seed):
    frame = random_readings(seed)
    expected = {}
    for id_, rows in by_station(frame).items():
        different = {row for row in rows if row[3] == "open"}
        for day in {row[0].date() for row in different}:
            steps = steps_of([row for row in different if row[0].date() == day])
            expected[(id_, str(day))] = float(sum(step for _, step in steps))
    assert totals(to_spark(spark, frame)) == expected


@pytest.mark.parametrize("bucket", ["1T", "10T", "1H"])
def test_results_do_not_depend_on_the_bucket(spark, bucket):
    readings = to_spark(spark, random_readings(7))
    by_day = transactions.daily_transactions(readings, bucket)
    assert rows_of(by_day, "id", "date", "number") == rows_of(
        transactions.daily_transactions(readings), "id", "date", "number"
    )
    by_hour = profiles.hourly_totals(readings, bucket)
    assert rows_of(by_hour, "id", "ts", "total") == rows_of(
        profiles.hourly_totals(readings), "id", "ts", "total"
    )


def test_unique_readings_need_one_shuffle_less(spark, capsys):
    readings = to_spark(spark, random_readings(8).drop_duplicates())
    found = transactions.daily_transactions(readings, unique=True)
    assert rows_of(found, "id", "date", "number") == rows_of(
        transactions.daily_transactions(readings), "id", "date", "number"
    )
    found.explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 2
    with pytest.raises(ValueError):
        profiles.hourly_totals(readings, "7T")


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_hourly_profile_equals_brute_force(spark, make_station, seed):
    frame = random_readings(seed)
    station = make_station([f"s{i}" for i in range(4)])
    df = profiles.hourly_profile(
        to_spark(spark, frame), station, None, "2024-04-02", window=3, city="lyon"
    )
    found = {(r.id, r.hour): (r["sum"], r["mean"]) for r in df.collect()}
    expected = {}
    for id_, rows in by_station(frame).items():
        steps = steps_of(rows)
        slot = min(time for time, _ in steps).replace(minute=0)
        slots = {}
        while slot <= max(time for time, _ in steps):
            end = slot + timedelta(hours=1)
            slots.setdefault(slot.hour, []).append(
                sum(step for time, step in steps if slot <= time < end)
            )
            slot = end
        for hour, sums in slots.items():
            expected[(id_, hour)] = (sum(sums), pytest.approx(sum(sums) / len(sums)))
    assert found == expected


def test_hourly_profile_fills_empty_hours(make_readings, make_station):
    rows = [
        ("a", "2020-01-06T08:50:00", 3),
        ("a", "2020-01-06T09:10:00", 5),
        ("a", "2020-01-06T12:05:00", 1),
        ("a", "2020-01-07T09:30:00", 2),
        ("b", "2020-01-06T09:10:00", 5),  # one reading only: no rows
    ]
    df = profiles.hourly_profile(
        make_readings(rows), make_station(["a"]), "a,b", "2020-01-08", 7
    )
    found = {r.hour: (r["sum"], r["mean"]) for r in df.collect()}
    assert len(found) == 24
    assert found[8] == (0, 0)
    assert found[9] == (3, 1.5)
    assert found[10] == (0, 0)
    assert found[12] == (4, 4)
    nested = profiles.nest_profile(df, "hour").collect()
    assert len(nested) == 1 and nested[0].hour == list(range(24))
    assert nested[0]["sum"][9] == 3


@pytest.fixture
def daily(spark):
    rows = [
        ("lyon", "1", 5.0, date(2024, 1, 19)),
        ("lyon", "1", 7.0, date(2024, 1, 20)),
        ("lyon", "2", 7.0, date(2024, 1, 20)),
        ("lyon", "3", 9.0, date(2024, 1, 20)),
        ("lyon", "4", 99.0, date(2024, 1, 19)),
        ("lyon", "3", 1.0, date(2024, 1, 12)),
        ("lyon", "3", 2.0, date(2024, 1, 13)),
        ("bordeaux", "1", 50.0, date(2024, 1, 20)),
    ]
    return spark.createDataFrame(rows, schemas.DAILY_TRANSACTION)


def test_daily_by_station_is_closed_on_both_ends(daily, make_station):
    df = transactions.daily_transaction(
        daily, make_station(["1", "2"]), [1, 3], "2024-01-20", 7, city="lyon"
    )
    assert [(r.id, r.value, r.date.day, r.name) for r in df.collect()] == [
        ("1", 5.0, 19, "name 1"),
        ("1", 7.0, 20, "name 1"),
        ("3", 2.0, 13, None),
        ("3", 9.0, 20, None),
    ]
    nested = {r.id: r for r in transactions.nest_daily(df).collect()}
    assert nested["1"].value == [5.0, 7.0]
    assert nested["3"].date == [date(2024, 1, 13), date(2024, 1, 20)]


def test_top_is_ranked_on_the_reference_date(daily, make_station):
    df = transactions.daily_transaction_list(
        daily, make_station(["1", "2", "3", "4"]), "lyon", "2024-01-20", 2, "value", 7
    )
    assert [(r.id, r.rank, r.date.day) for r in df.collect()] == [
        ("3", 1, 13), ("3", 1, 20), ("1", 2, 19), ("1", 2, 20),
    ]
    each = transactions.daily_transaction_list(
        daily, make_station(["1"]), None, "2024-01-20", 1, "value"
    )
    assert [(r.city_key, r.id, r.rank) for r in each.collect()] == [
        ("bordeaux", "1", 1), ("lyon", "3", 1)
    ]
    by_id = transactions.daily_transaction_list(
        daily, make_station(["1"]), "lyon", "2024-01-20", 20, "station"
    )
    assert [r.id for r in by_id.collect()] == ["1", "2", "3"]
    with pytest.raises(ValueError):
        transactions.daily_transaction_list(daily, daily, "paris", "2024-01-20")
    with pytest.raises(ValueError):
        transactions.daily_transaction_list(daily, daily, "lyon", "2024-01-20", 1, "name")


def test_colour_scale(daily, make_station):
    top = transactions.daily_transaction_list(
        daily, make_station(["1"]), "lyon", "2024-01-20", 20, "value"
    )
    found = {r.id: r.scale for r in transactions.colour_scale(top).collect()}
    assert found["3"] == 1.0
    assert found["1"] == pytest.approx((7 - 4.9) / (9 - 4.9))


def test_daily_profile_leaves_missing_days_out(daily, make_station):
    df = profiles.daily_profile(daily, make_station(["3"]), "3", "2024-01-20", 30, "lyon")
    # 12 January 2024 is a Friday, the 13th and 20th are Saturdays
    assert rows_of(df, "day", "sum", "mean") == [(4, 1.0, 1.0), (5, 11.0, 5.5)]
