import math
import random

import pytest
from conftest import at
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from docklens.plans import forecast
from docklens.sinks import models
from docklens.sinks.tables import PREDICTION_KEY, write_predictions
from docklens.sources.tables import read_table

START, STOP, CUT = "2024-01-01", "2024-01-04", "2024-01-03T12:00:00"


def week(make_readings, names=("1", "2")):
    """Full at night, empty by day, a reading every ten minutes."""
    rows = [
        (name, f"2024-01-0{d}T{h:02d}:{m}2:00", 18 if h < 8 else 2, 2 if h < 8 else 18)
        for name in names
        for d in (1, 2, 3)
        for h in range(24)
        for m in range(6)
    ]
    return make_readings(rows)




def test_trees_learn_the_day_and_predict(spark, make_readings, tmp_path):
    readings = week(make_readings)
    trained = forecast.train(readings, START, STOP, CUT, "30T")
    assert len(trained.train_loss) == len(trained.test_loss) == forecast.ROUNDS
    assert trained.train_loss[-1] < trained.train_loss[0]
    assert trained.test_loss[-1] < 0.4  # no forecast can be below 0.33 here
    path = models.model_path(str(tmp_path), "lyon", START, STOP, CUT, "30T")
    models.save_model(trained.model, path)
    predicted = forecast.predict(
        readings, models.load_model(path), "2024-01-03T07:20:00", "2024-01-03T07:40:00"
    )
    rows = predicted.collect()
    assert {r.station_id for r in rows} == {"1", "2"}
    for r in rows:
        # newest reading 07:32 is in the bin 07:30; half an hour later the docks are empty
        assert r.timestamp == at("2024-01-03T08:00:00")
        assert 0 < r.availability < 0.3
        assert r.nb_bikes + r.nb_stands == 20
    write_predictions(predicted, str(tmp_path), "30m")
    stored = read_table(spark, str(tmp_path), "prediction")
    assert stored.select("frequency").distinct().collect()[0][0] == "30T"
    assert stored.count() == stored.select(*PREDICTION_KEY).distinct().count() == 2


def test_text_ids_become_numbers(make_readings):
    readings = week(make_readings, ("north", "south"))
    trained = forecast.train(readings, START, STOP, CUT, "30T")
    rows = forecast.predict(readings, trained.model, START, STOP).collect()
    assert {r.station_id for r in rows} == {"north", "south"}


def test_no_readings_is_an_error(make_readings):
    with pytest.raises(ValueError):
        forecast.train(make_readings([]), START, STOP, CUT)


@pytest.mark.parametrize(
    "bikes, stands, p, expected", [(10, 30, 0.333, (13, 27)), (9.5, 30, 0.5, (19, 20))]
)
def test_whole_bikes_and_stands(spark, bikes, stands, p, expected):
    df = spark.createDataFrame(
        [(float(bikes), float(stands), p)], "nb_bikes double, nb_stands double, availability double"
    )
    row = forecast.split_docks(df).collect()[0]
    assert (row.pred_bikes, row.pred_stands) == expected


def test_the_model_does_not_depend_on_the_cluster(spark, make_readings):
    readings = make_readings(
        [(f"s{i}", f"2024-01-{d:02d}T{h:02d}:00:00", (i * h + d) % 9)
         for i in range(4) for d in range(1, 5) for h in range(24)]
    )
    errors = []
    for tasks in ("2", "7"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
        try:
            trained = forecast.train(
                readings.repartition(int(tasks)), "2024-01-01", "2024-01-05", "2024-01-04"
            )
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        errors.append((trained.train_loss, trained.test_loss))
    assert errors[0] == errors[1]


def grid_rows(spark, n=400, seed=3):
    """Rows of the grid with labels 0, 1/2 and 1, many of them in one cell."""
    chance = random.Random(seed)
    rows = []
    for _ in range(n):
        bikes, hour = chance.randint(0, 9), chance.choice([2, 9, 17])
        future = min(max(round((bikes / 9 + (hour == 9) * 0.4) * 2 + chance.uniform(-1, 1)) / 2, 0.0), 1.0)
        rows.append(("lyon", str(chance.randint(1, 4)), at("2024-01-03"), float(bikes), 9.0 - bikes, 2, hour, 10, future))
    return spark.createDataFrame(
        rows,
        "city_key string, station_id string, ts timestamp_ntz, nb_bikes double, nb_stands double, "
        "day int, hour int, minute int, future double",
    )


def test_cells_give_the_trees_of_all_rows(spark):
    """A fit on weighted cells is the fit on each row, a label of 1/2 as one row of each class."""
    train = grid_rows(spark)
    found = forecast.fit(train, grid_rows(spark, 50, 4), places=1)
    binned = found.model.stages[1].transform(
        found.model.stages[0].transform(forecast._numbered_stations(train))
    )
    labels = F.when(F.col("future") == 1, F.array(F.lit(1.0), F.lit(1.0))).when(
        F.col("future") == 0, F.array(F.lit(0.0), F.lit(0.0))
    )
    plain = binned.withColumn("label", F.explode(F.coalesce(labels, F.array(F.lit(0.0), F.lit(1.0)))))
    trees = GBTClassifier(maxIter=25, maxDepth=6, stepSize=0.2, maxBins=32, seed=0).fit(
        plain.coalesce(1)
    )
    own = found.model.stages[2]
    assert own.getNumTrees == trees.getNumTrees == forecast.ROUNDS
    both = trees.transform(own.transform(binned).select("features", "future", F.col("probability").alias("p")).drop("probability"))
    for r in both.select("p", "probability").collect():
        assert math.isclose(r.p[1], r.probability[1], rel_tol=1e-6)
    assert [round(e / 2, 9) for e in trees.evaluateEachIteration(plain)] == [
        round(e, 9) for e in found.train_loss
    ]


def test_loss_is_that_of_labels_between_0_and_1(spark):
    train, test = grid_rows(spark), grid_rows(spark, 100, 5)
    found = forecast.fit(train, test)
    for rows, reported in ((train, found.train_loss), (test, found.test_loss)):
        scored = forecast.probabilities(rows, found.model).collect()
        losses = [
            -(r.future * math.log(r.availability) + (1 - r.future) * math.log(1 - r.availability))
            for r in scored
        ]
        assert math.isclose(sum(losses) / len(losses), reported[-1], rel_tol=1e-9)
        assert all(0 < r.availability < 1 for r in scored)
    mean = sum(r.future for r in train.collect()) / train.count()
    constant = [-(r.future * math.log(mean) + (1 - r.future) * math.log(1 - mean)) for r in test.collect()]
    assert found.test_loss[-1] < sum(constant) / len(constant)


def test_cells_keep_all_rows_and_labels(spark):
    rows = forecast._numbered_stations(grid_rows(spark, 300))
    counted = forecast.cells(rows, forecast.binning(rows), [])
    n, yes, cells = counted.agg(F.sum("n"), F.sum("yes"), F.count("*")).first()
    assert n == 300 and math.isclose(yes, sum(r.future for r in rows.collect()))
    assert cells == rows.select(*forecast.FEATURES).distinct().count() < 300
    weights = forecast.weighted(counted).groupBy("label").agg(F.sum("weight").alias("w"))
    assert {r.label: round(r.w, 9) for r in weights.collect()} == {1.0: yes, 0.0: 300 - yes}


def test_bins_of_few_and_of_many_values(spark):
    many = spark.range(2000).select(
        F.col("id").cast("double").alias("station_number"),
        (F.col("id") % 3).cast("double").alias("nb_bikes"),
        F.when(F.col("id") < 1000, 5.0).otherwise(F.col("id").cast("double")).alias("nb_stands"),
    )
    edges = forecast.bin_edges(many)
    assert len(edges["station_number"]) == 7 and edges["station_number"][0] == 1999 / 8
    assert edges["nb_bikes"] == [1.0, 2.0]
    # half of all rows hold one value: it has a bin, and the other quantiles cut the rest
    assert len(edges["nb_stands"]) == 16 and min(edges["nb_stands"]) > 5
    assert edges["hour"] == [float(h) for h in range(1, 24)]
    same = forecast.bin_edges(many.where("station_number = 7"))
    assert same["nb_bikes"] == same["nb_stands"] == []


@pytest.mark.parametrize("most", [10**6, 0])
def test_shared_probabilities_are_those_of_each_row(spark, monkeypatch, most):
    rows = grid_rows(spark, 300)
    model = forecast.fit(rows, grid_rows(spark, 100, 5)).model
    key = [*forecast.FEATURES, "future"]
    plain = forecast.probabilities(rows, model).select(*key, "availability").collect()
    calls = []
    direct = forecast.probabilities
    monkeypatch.setattr(forecast, "probabilities", lambda *a: calls.append(1) or direct(*a))
    shared = forecast.shared_probabilities(rows, model, most).select(*key, "availability").collect()
    assert sorted(map(str, shared)) == sorted(map(str, plain))
    assert len(calls) == (0 if most else 1)
