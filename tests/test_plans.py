"""What the physical plans must and must not contain."""

import os

import pytest

from docklens import schemas
from docklens.operators.latest import newest_once
from docklens.plans import clusters, forecast, profiles, timeseries, transactions
from registry import queries

FOLDER = os.environ.get("DOCKLENS_TESTDATA", "/root/testdata/sf0.001")
ACTIONS = ("stream_", "kmeans_", "forecast_", "_store")
LAZY = [n for n in queries.QUERIES if not any(a in n for a in ACTIONS)]


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


def exchanges(plan):
    return [
        line.split("Arguments: ")[1]
        for line in plan.splitlines()
        if line.startswith("Arguments: hashpartitioning")
    ]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python_in_the_plan(spark, capsys, name):
    plan = plan_of(queries.QUERIES[name](spark, FOLDER), capsys)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert operator not in plan


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "timeseries")
    spark.createDataFrame([], schemas.TIMESERIES).write.parquet(path)
    return spark.read.schema(schemas.TIMESERIES).parquet(path)


@pytest.mark.parametrize("make", [transactions.daily_transactions,
                                  lambda df: profiles.hourly_totals(df)])
def test_readings_are_never_shuffled_by_station_alone(stored, capsys, make):
    first, second, *rest = exchanges(plan_of(make(stored), capsys))
    assert "timestamp" in first and "available_bikes" in first  # copies collapse first
    assert "bucket" in second  # then a station is spread over its hours
    assert len(rest) == 1  # and only hourly rows meet per station


def test_only_needed_columns_and_rows_are_read(stored, capsys):
    plan = plan_of(
        transactions.aggregate_transactions(stored, "2024-01-02", "lyon"), capsys
    )
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    for part in ("status,open", "city_key,lyon", "GreaterThanOrEqual(timestamp", "LessThan("):
        assert part in pushed
    latest = timeseries.latest_open_rows(stored, "2024-01-01", "2024-01-02")
    assert "EqualTo(status,open)" in plan_of(latest, capsys)
    schema = plan_of(stored.groupBy("id").count(), capsys).split("ReadSchema: ")[1]
    assert schema.startswith("struct<id:string>")


def test_nesting_moves_the_readings_twice(stored, make_station, capsys):
    df = timeseries.timeseries_nested(
        stored, make_station([]), None, "2024-01-01", "2024-01-02"
    )
    copies, pieces, *rest = exchanges(plan_of(df, capsys))
    assert "timestamp" in copies and "piece" in pieces  # copies collapse first
    assert len(rest) <= 2  # and the join of the names


def test_small_tops_are_taken_without_a_sort_of_all_rows(stored, capsys, spark):
    daily = spark.createDataFrame([], schemas.DAILY_TRANSACTION)
    station = spark.createDataFrame([], schemas.STATION)
    top = transactions.daily_transaction_list(daily, station, "lyon", "2024-01-01", 5, "value")
    assert "TakeOrderedAndProject" in plan_of(top, capsys)


def test_named_centroids_need_two_shuffles(spark, capsys, tmp_path):
    path = str(tmp_path / "centroid")
    spark.createDataFrame([], schemas.CENTROID).write.parquet(path)
    rows = clusters.cluster_profiles(spark.read.schema(schemas.CENTROID).parquet(path))
    plan = plan_of(rows, capsys)
    assert len(exchanges(plan)) <= 2 and "Join" not in plan and "Expand" not in plan


def test_both_parts_of_a_split_come_from_one_grid(stored, capsys):
    rows = timeseries.open_readings(stored, "2024-01-01", "2024-01-31")
    table = forecast.labelled(rows, "30T")
    both = forecast.with_part(table, "2024-01-25", "30T", "2024-01-01", periods=2)
    plan = plan_of(both.groupBy("part", "station_id").count(), capsys)
    assert plan.count("Scan parquet") == 2  # once in the tree, once in the details
    assert len(exchanges(plan)) <= 4


def test_latest_rows_of_a_batch_are_read_once(stored, capsys):
    plan = plan_of(newest_once(stored, ["city_key", "id"]), capsys)
    assert plan.count("Scan parquet") == 2 and "WindowGroupLimit" in plan
