"""Every registered query beside its SQL on the smallest test tables."""

import os

import pytest

import __spark_entry__ as registered
import check_queries
from registry import oracle, queries

FOLDER = os.environ.get("DOCKLENS_TESTDATA", "/root/testdata/sf0.001")
# queries whose result follows from a fitted model have no SQL
FITTED = {
    "kmeans_profiles", "kmeans_centroids", "kmeans_geo", "kmeans_geo_centroids",
    "forecast_availability",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return check_queries.connect(FOLDER)


def test_only_fitted_queries_lack_sql():
    assert set(queries.QUERIES) - set(oracle.statements()) == FITTED
    assert set(oracle.statements()) <= set(queries.QUERIES)
    assert queries.QUERIES.items() <= registered.queries().items()
    assert oracle.statements().items() <= registered.oracle_sql().items()


def test_entry(spark):
    assert registered.entry(spark).columns == ["city_key", "id", "number", "date"]


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"forecast_availability", "forecast_check"}))
def test_query(spark, connection, name):
    assert check_queries.compare(spark, connection, FOLDER, name) == ""


def test_stations_are_dealt_out_before_they_become_hours(spark, tmp_path):
    for name, ddl, rows in (
        ("customer", "c_custkey long, c_nationkey long, c_name string, c_mktsegment string",
         [(i, i % 2, "n", "m") for i in range(60)]),
        ("nation", "n_nationkey long, n_name string", [(0, "a"), (1, "b")]),
    ):  # one file each, so that one task reads it
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    readings = queries._shaped_readings(spark, str(tmp_path))
    sizes = readings.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == 60 * 48
    assert max(sizes) < 60 * 48 / 2
