import threading
from datetime import date

import pytest
from conftest import rows_of

from docklens import schemas
from docklens.plans import clusters
from docklens.sources.stations import coordinates

# Hourly profiles of four known patterns.
PATTERNS = """
3,0.598,0.545,0.462,0.441,0.412,0.405,0.448,0.476,0.370,0.286,0.312,0.354,0.404,0.431,0.451,0.423,0.441,0.623,0.698,0.780,0.832,0.894,0.892,0.873
0,0.883,0.909,0.931,0.937,0.936,0.927,0.895,0.822,0.699,0.558,0.530,0.516,0.482,0.448,0.465,0.464,0.459,0.510,0.567,0.633,0.674,0.694,0.707,0.742
1,0.836,0.854,0.874,0.883,0.889,0.894,0.881,0.871,0.867,0.865,0.851,0.843,0.843,0.843,0.846,0.847,0.830,0.793,0.776,0.787,0.789,0.783,0.783,0.787
2,0.212,0.184,0.181,0.187,0.184,0.193,0.229,0.313,0.450,0.699,0.797,0.834,0.848,0.833,0.829,0.805,0.712,0.530,0.425,0.365,0.338,0.352,0.361,0.323
"""
RUN = (date(2024, 1, 1), date(2024, 1, 8))
OLD_RUN = (date(2023, 12, 1), date(2023, 12, 8))


def centroids(spark, run=RUN, city="lyon", count=4):
    rows = []
    for line in PATTERNS.strip().splitlines()[:count]:
        cluster_id, *values = line.split(",")
        rows.append((city, cluster_id, *run, *map(float, values)))
    return spark.createDataFrame(rows, schemas.CENTROID)


def test_patterns_get_their_names(spark):
    both = centroids(spark).unionByName(centroids(spark, OLD_RUN, "bordeaux"))
    found = rows_of(clusters.find_cluster(both), "city_key", "cluster_id", "label")
    names = [("0", "morning"), ("1", "high"), ("2", "noon"), ("3", "evening")]
    assert found == [(city, *n) for city in ("bordeaux", "lyon") for n in names]


def test_names_without_a_run_key(spark):
    found = clusters.find_cluster(centroids(spark).drop("city_key", "start", "stop"), [])
    assert dict(rows_of(found, "cluster_id", "label"))["3"] == "evening"


def test_naming_needs_four_clusters(spark):
    with pytest.raises(Exception, match="four clusters"):
        clusters.find_cluster(centroids(spark, count=3)).collect()


def test_profiles_are_those_of_the_newest_run(spark):
    table = centroids(spark).unionByName(centroids(spark, OLD_RUN))
    found = clusters.cluster_profiles(table, "lyon").collect()
    assert {r.cluster_id for r in found} == {"0", "1", "2", "3"}
    assert all(r.stop == RUN[1] and r.hour == list(range(24)) for r in found)
    high = next(r for r in found if r.label == "high")
    assert len(high["values"]) == 24 and high["values"][0] == 0.836
    older = clusters.cluster_profiles(table, "lyon", *OLD_RUN).collect()
    assert {r.stop for r in older} == {OLD_RUN[1]}
    assert clusters.cluster_profiles(table, "bordeaux").count() == 0


def test_station_clusters(spark, make_station):
    rows = [
        ("lyon", "a", *OLD_RUN, "1"), ("lyon", "b", *OLD_RUN, "2"), ("lyon", "a", *RUN, "3"),
        ("lyon", "gone", *RUN, "0"),
    ]
    table = spark.createDataFrame(rows, schemas.CLUSTERING)
    station = make_station(["a", "b"])
    newest = clusters.station_clusters(table, station, "lyon")
    assert rows_of(newest, "id", "cluster_id", "stop") == [("a", "3", RUN[1])]
    # the newest run is looked up after the choice of stations
    chosen = clusters.station_clusters(table, station, "lyon", ids=["b"])
    assert rows_of(chosen, "id", "cluster_id", "stop") == [("b", "2", OLD_RUN[1])]
    feature = clusters.station_clusters(table, station, "lyon", geojson=True).collect()[0]
    assert set(feature.properties.asDict()) == {"id", "cluster_id", "name", "start", "stop"}


def shaped_readings(make_readings, per_shape=3):
    """Stations of four clear daily shapes over a week, one reading per hour."""
    shapes = {
        "flat": lambda h: 18,
        "night": lambda h: 18 if h < 8 else 3,
        "noon": lambda h: 18 if 9 <= h < 16 else 2,
        "evening": lambda h: 18 if h >= 18 else 4,
    }
    rows = [
        (f"{name}{i}", f"2024-01-{d:02d}T{h:02d}:{i:02d}:00", shape(h) + i % 2)
        for name, shape in shapes.items()
        for i in range(per_shape)
        for d in range(1, 6)
        for h in range(24)
    ]
    return make_readings(rows)


def test_kmeans_finds_the_shapes_and_repeats(make_readings):
    readings = shaped_readings(make_readings)
    run = ("lyon", "2024-01-01", "2024-01-08")
    found = clusters.compute_clusters(readings, *run)
    labels = {r.station_id: r.cluster_id for r in found.labels.collect()}
    assert len(labels) == 12
    by_shape = {s: {labels[f"{s}{i}"] for i in range(3)} for s in ("flat", "night", "noon", "evening")}
    assert all(len(ids) == 1 for ids in by_shape.values())
    assert set(labels.values()) == {"0", "1", "2", "3"}
    assert found.centroids.columns == schemas.CENTROID.names
    assert rows_of(found.labels, "start", "stop")[0] == (date(2024, 1, 1), date(2024, 1, 8))
    # another layout of the same rows gives the same clusters
    again = clusters.compute_clusters(readings.repartition(7), *run)
    assert {r.station_id: r.cluster_id for r in again.labels.collect()} == labels
    assert found.rejects.count() == 0
    # the shapes are told apart by name
    named = {r.cluster_id: r.label for r in clusters.find_cluster(found.centroids).collect()}
    assert named[next(iter(by_shape["flat"]))] == "high"
    assert named[next(iter(by_shape["evening"]))] == "evening"


def test_stations_with_a_missing_hour_are_set_aside(make_readings):
    rows = clusters.cluster_input(
        make_readings([("a", "2024-01-01T10:00:00", 3)]), "2024-01-01", "2024-01-08"
    )
    known, rest = clusters.complete_profiles(
        clusters.wide_profiles(clusters.hour_profiles(rows))
    )
    assert known.count() == 0 and rows_of(rest, "station_id") == [("a",)]
    some = shaped_readings(make_readings).unionByName(
        make_readings([("x", "2024-01-01T10:00:00", 3)])
    )
    found = clusters.compute_clusters(some, "lyon", "2024-01-01", "2024-01-08")
    assert rows_of(found.rejects, "station_id") == [("x",)]
    assert found.labels.where("station_id = 'x'").isEmpty()


def test_geo_clusters(make_station):
    station = make_station([f"s{i:02d}" for i in range(30)])
    points = coordinates(station)
    lost = points.limit(1).selectExpr("city_key", "'gone' as station_id", "lat", "null as lon")
    found = clusters.compute_geo_clusters(points.unionByName(lost), "lyon")
    assert rows_of(found.rejects, "station_id") == [("gone",)]
    labels = found.labels.collect()
    assert [r.station_id for r in labels] == [f"s{i:02d}" for i in range(30)]
    assert {r.cluster_id for r in labels} == set(range(12))
    centres = found.centroids.orderBy("cluster_id").collect()
    assert len(centres) == 12 and all(45 < c.lat < 80 and 4 < c.lon < 40 for c in centres)


def test_starts_of_a_fit_run_side_by_side(spark, monkeypatch):
    together = threading.Barrier(clusters.STARTS)

    class Fit(clusters.KMeans):
        def _fit(self, dataset):
            together.wait(60)  # breaks if another start has not begun
            return super()._fit(dataset)

    monkeypatch.setattr(clusters, "KMeans", Fit)
    rows = [("lyon", str(i), float(i % 2), float(i % 2)) for i in range(20)]
    points = spark.createDataFrame(rows, "city_key string, station_id string, lat double, lon double")
    found = clusters.compute_geo_clusters(points, "lyon", k=2)
    assert {r.station_id: r.cluster_id for r in found.labels.collect()} == {
        str(i): i % 2 for i in range(20)
    }
