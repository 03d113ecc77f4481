"""Short-horizon availability forecasts with gradient-boosted trees.

The trees minimise the logistic loss of a label between 0 and 1. Such a label counts as two
weighted rows: bikes there with the weight of the label, none there with the rest of it.

Trees only ask on which side of a threshold a feature lies, and they try as many thresholds as
they have bins. So the grid is never handed to them: each feature is cut into its bins, and rows
that share all bins are one *cell* with their number and the sum of their labels, which is all
that the loss needs. The number of cells is bounded by the bins, not by the readings; a fit over
more readings takes longer only in the one aggregation that counts the cells.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from docklens.config import as_datetime
from docklens.functions.timecols import calendar, interval, step_seconds
from docklens.operators.grid import resample_future, resample_mean
from docklens.plans.timeseries import Time, latest_open_rows, open_readings
from docklens.session import cut_lineage

GRID = "10T"
# Boosting rounds, tree depth, learning rate, test periods.
ROUNDS = 25
DEPTH = 6
RATE = 0.2
TEST_PERIODS = 2
FEATURES = ("station_id", "nb_bikes", "nb_stands", "day", "hour", "minute")
STATION_NUMBER = "station_number"
STATION_NUMBERS = 2**31
#: bins of a feature, the trees' own default; a station's number is a code, whose order
#: says little, and gets fewer
BINS = 32
QUANTILES = {STATION_NUMBER: 8, "nb_bikes": BINS, "nb_stands": BINS}
CALENDAR = {"day": range(1, 7), "hour": range(1, 24), "minute": range(2, 60, 2)}
CELLS_PER_PLACE = 100_000
#: bin vectors whose probabilities are sent to every task
LOOKED_UP = 2_000_000


def features(rows: DataFrame, step: str = GRID) -> DataFrame:
    """Resampled readings with calendar columns."""
    return calendar(resample_mean(rows, step=step))


def labelled(rows: DataFrame, frequency: str, step: str = GRID) -> DataFrame:
    """Features with the probability of the same station ``frequency`` later."""
    return calendar(resample_future(rows, frequency, step=step))


class Split(NamedTuple):
    train: DataFrame
    test: DataFrame


def _time(value: datetime) -> Column:
    return F.lit(value.isoformat()).cast("timestamp_ntz")


PART = "part"


def with_part(
    df: DataFrame,
    cut: Time,
    frequency: str = "1H",
    start: Time | None = None,
    periods: int = 1,
) -> DataFrame:
    """Rows of either part of a split, told apart by ``part``, in one pass.

    ``train`` ends at ``cut - frequency`` and ``test`` begins at ``cut``; all bounds
    are closed.  ``probability`` is dropped and ``future`` is the label.
    """
    cut = as_datetime(cut)
    span = timedelta(seconds=step_seconds(frequency))
    ts = F.col("ts")
    train = ts <= _time(cut - span)
    if start is not None:
        train = train & (ts >= _time(as_datetime(start)))
    test = ts.between(_time(cut), _time(cut + periods * span))
    if start is not None:
        test = test & (ts >= _time(as_datetime(start)))
    part = F.when(train, "train").when(test, "test")
    return df.where(train | test).withColumn(PART, part).drop("probability")


def prepare_data_for_training(
    df: DataFrame,
    cut: Time,
    frequency: str = "1H",
    start: Time | None = None,
    periods: int = 1,
) -> Split:
    """Training rows up to ``cut - frequency`` and test rows from ``cut`` on."""
    both = with_part(df, cut, frequency, start, periods)
    of = lambda name: both.where(F.col(PART) == name).drop(PART)
    return Split(of("train"), of("test"))


def _numbered_stations(df: DataFrame) -> DataFrame:
    """The station as a number: its id, or a hash of an id that is not a number."""
    hashed = F.pmod(F.xxhash64("station_id"), F.lit(STATION_NUMBERS)).cast("double")
    number = F.coalesce(F.col("station_id").try_cast("double"), hashed)
    return df.withColumn(STATION_NUMBER, number)


def bin_edges(rows: DataFrame) -> dict[str, list[float]]:
    """Lower edges of the bins of each feature, the first bin's left out.

    A feature of few values has a bin for each; else the edges are quantiles over all rows.
    Equal values are counted before the quantiles, which then run over stations and dock
    counts. Days, hours and minutes are known beforehand.
    """
    values = cut_lineage(
        rows.groupBy(*QUANTILES)
        .agg(F.count("*").alias("n"))
        .select(
            "n",
            F.explode(
                F.create_map(*(p for c in QUANTILES for p in (F.lit(c), F.col(c).cast("double"))))
            ).alias("feature", "value"),
        )
        .groupBy("feature", "value")
        .agg(F.sum("n").alias("n"))
    )
    steps = [k / BINS for k in range(1, BINS)]
    found = (
        values.groupBy("feature")
        .agg(
            F.count("*").alias("different"),
            F.min("value").alias("low"),
            F.percentile("value", steps, F.col("n")).alias("edges"),
        )
        .collect()
    )
    cuts, few = {}, []
    for r in found:
        bins = QUANTILES[r["feature"]]
        if r["different"] > bins:
            apart = BINS // bins
            cuts[r["feature"]] = r["edges"][apart - 1 :: apart]
        else:
            few.append(r["feature"])
    for r in values.where(F.col("feature").isin(few)).collect():
        cuts.setdefault(r["feature"], []).append(r["value"])
    low = {r["feature"]: r["low"] for r in found}
    edges = {c: sorted({v for v in cuts.get(c, []) if v > low[c]}) for c in QUANTILES}
    return edges | {c: [float(v) for v in at] for c, at in CALENDAR.items()}


def binning(rows: DataFrame) -> PipelineModel:
    """From the features to their bins in one vector."""
    columns = [STATION_NUMBER if c == "station_id" else c for c in FEATURES]
    edges = bin_edges(rows)
    cut = Bucketizer(
        inputCols=columns,
        outputCols=[f"{c}_bin" for c in columns],
        splitsArray=[[-math.inf, *(edges[c] or [0.0]), math.inf] for c in columns],
    )
    return PipelineModel([cut, VectorAssembler(inputCols=cut.getOutputCols(), outputCol="features")])


def cells(rows: DataFrame, bins: PipelineModel, keys: list[str]) -> DataFrame:
    """Rows of one bin vector as one: their number ``n`` and the sum of their labels ``yes``.

    Labels are summed as decimals, so the order in which rows arrive does not matter.
    """
    columns = bins.stages[0].getOutputCols()
    binned = bins.stages[0].transform(rows.where("future IS NOT NULL"))
    return binned.groupBy(*keys, *columns).agg(
        F.count("*").cast("double").alias("n"),
        F.sum(F.col("future").cast("decimal(18,12)")).cast("double").alias("yes"),
    )


def weighted(counted: DataFrame) -> DataFrame:
    """Two rows of each cell: label 1 with the sum of its labels as weight, 0 with the rest."""
    sides = F.array(
        F.struct(F.lit(1.0).alias("label"), F.col("yes").alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (F.col("n") - F.col("yes")).alias("weight")),
    )
    others = [c for c in counted.columns if c not in ("n", "yes")]
    return counted.select(*others, F.inline(sides)).where("weight > 0")


class Trained(NamedTuple):
    model: PipelineModel
    # mean logistic loss after each round, on the training and the test rows
    train_loss: list[float]
    test_loss: list[float]


def fit(
    train: DataFrame, test: DataFrame, seed: int = 0, places: int | None = None
) -> Trained:
    """Boosted trees on the label ``future`` in [0, 1], with the loss after each round."""
    both = train.withColumn(PART, F.lit("train")).unionByName(test.withColumn(PART, F.lit("test")))
    return _fit_parts(both, seed, places)


def _fit_parts(both: DataFrame, seed: int, places: int | None) -> Trained:
    both = _numbered_stations(both)
    bins = binning(both.where(F.col(PART) == "train"))
    counted = cut_lineage(cells(both, bins, [PART]))  # read by the fit and by both losses
    cut, assemble = bins.stages
    ready, check = (
        _placed(
            assemble.transform(weighted(counted.where(F.col(PART) == name))),
            cut.getOutputCols(),
            places,
        )
        for name in ("train", "test")
    )
    ready, check = ready.persist(), check.persist()
    try:
        if ready.isEmpty():
            raise ValueError("no readings to train on, check the dates")
        trees = GBTClassifier(
            featuresCol="features",
            labelCol="label",
            weightCol="weight",
            maxIter=ROUNDS,
            maxDepth=DEPTH,
            stepSize=RATE,
            maxBins=BINS,
            seed=seed,
        ).fit(ready)
        losses = [_progress(df, trees) for df in (ready, check)]
    finally:
        ready.unpersist()
        check.unpersist()
    return Trained(PipelineModel([*bins.stages, trees]), *losses)


def _progress(ready: DataFrame, model: GBTClassificationModel) -> list[float]:
    """Loss after each round; empty without rows. (The trees' own loss is twice as large.)"""
    if ready.isEmpty():
        return []
    return [e / 2 for e in model.evaluateEachIteration(ready)]


def _placed(rows: DataFrame, key: list[str], places: int | None) -> DataFrame:
    """Weighted rows placed by their hash, sorted inside their partitions.

    The trees' split candidates are sampled in each partition, so the number of
    partitions is ``places`` or follows from the number of cells, never from the
    cluster: the same rows give the same model on any number of cores.
    """
    key = [*key, "label"]
    if places is None:
        places = max(1, -(-rows.count() // CELLS_PER_PLACE))
    return rows.repartition(places, *key).sortWithinPartitions(*key)


def train_prediction_model(
    rows: DataFrame,
    validation: Time,
    frequency: str = "30T",
    seed: int = 0,
    places: int | None = None,
) -> Trained:
    """Resample, add calendar and label, split at ``validation`` and fit."""
    table = labelled(rows, frequency)
    return _fit_parts(
        with_part(table, validation, frequency, periods=TEST_PERIODS), seed, places
    )


def train(
    readings: DataFrame,
    start: Time,
    stop: Time,
    validation: Time,
    frequency: str = "30T",
    city: str | None = None,
    seed: int = 0,
) -> Trained:
    """Train on the open readings of ``[start, stop)``."""
    rows = open_readings(readings, start, stop, city)
    return train_prediction_model(rows, validation, frequency, seed)


def train_cities(
    readings: DataFrame,
    cities: Iterable[str],
    start: Time,
    stop: Time,
    validation: Time,
    frequency: str = "30T",
    seed: int = 0,
) -> dict[str, Trained]:
    """A model for each city, trained side by side.

    The jobs of a fit are short and wait for the driver between levels of a tree; those of
    another city fill the gaps.
    """
    cities = list(cities)
    one = inheritable_thread_target(readings.sparkSession)(
        lambda city: train(readings, start, stop, validation, frequency, city, seed)
    )
    with ThreadPoolExecutor(max(1, len(cities))) as pool:
        return dict(zip(cities, pool.map(one, cities)))


def predict_bike_availability(
    rows: DataFrame, model: PipelineModel, frequency: str = "30T"
) -> DataFrame:
    """Probability, bikes and stands of each station ``frequency`` later.

    Bikes and stands are cut to whole numbers.
    """
    return split_docks(probabilities(features(rows), model)).select(
        "city_key",
        (F.col("ts") + interval(step_seconds(frequency))).alias("timestamp"),
        "station_id",
        "availability",
        F.col("pred_bikes").alias("nb_bikes"),
        F.col("pred_stands").alias("nb_stands"),
    )


def probabilities(rows: DataFrame, model: PipelineModel) -> DataFrame:
    """Rows of features with ``availability``, the model's probability of a bike."""
    ready = _numbered_stations(rows).drop("probability")  # the model adds its own
    p = vector_to_array("probability").getItem(1)
    return model.transform(ready).withColumn("availability", p)


def shared_probabilities(
    rows: DataFrame, model: PipelineModel, most: int = LOOKED_UP
) -> DataFrame:
    """``probabilities`` of many rows: the trees score each bin vector once.

    The trees see nothing of a row but its bins, whose vectors are far fewer than the rows
    of a grid. Each row looks its vector up in a broadcast; if there are more than ``most``
    of them, the rows are scored one by one.
    """
    cut, assemble, trees = model.stages
    columns = cut.getOutputCols()
    key = F.lit(0).cast("long")
    for column, splits in zip(columns, cut.getSplitsArray(), strict=True):
        key = key * len(splits) + F.col(column).cast("long")
    binned = cut.transform(_numbered_stations(rows).drop("probability"))
    vectors = cut_lineage(binned.select(*columns).distinct())
    if vectors.count() > most:
        return probabilities(rows, model)
    p = vector_to_array("probability").getItem(1)
    scored = trees.transform(assemble.transform(vectors)).select(
        key.alias("_vector"), p.alias("availability")
    )
    return (
        binned.withColumn("_vector", key).join(F.broadcast(scored), "_vector").drop("_vector")
    )


def split_docks(df: DataFrame, probability: str = "availability") -> DataFrame:
    """Whole bikes and stands of a probability: bikes first, the rest is stands."""
    total = F.col("nb_bikes") + F.col("nb_stands")
    bikes = (total * F.col(probability)).cast("int")
    return df.withColumn("pred_bikes", bikes).withColumn(
        "pred_stands", (total - F.col("pred_bikes")).cast("int")
    )


def predict(
    readings: DataFrame,
    model: PipelineModel,
    start: Time,
    stop: Time,
    frequency: str = "30T",
    city: str | None = None,
) -> DataFrame:
    """Forecast from the newest reading of each station in ``[start, stop)``."""
    rows = latest_open_rows(readings, start, stop, city)
    return predict_bike_availability(rows, model, frequency)
