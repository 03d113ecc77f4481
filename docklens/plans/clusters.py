"""Station clusters by daily pattern and by place."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from typing import NamedTuple

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from docklens.config import as_date, as_ids, city_list
from docklens.functions.geo import CLUSTER_PROPERTIES, point_features
from docklens.operators.grid import bin_means, weekday_hour_means
from docklens.operators.latest import newest_run
from docklens.operators.topk import only_ids
from docklens.plans.timeseries import Time
from docklens.schemas import HOUR_COLUMNS
from docklens.session import cut_lineage
from docklens.sources.tables import time_slice

STATION = ["city_key", "station_id"]
RUN = ["city_key", "start", "stop"]

# Cluster counts, seed and the hours that tell the patterns apart.
PATTERN_CLUSTERS = 4
PLACE_CLUSTERS = 12
SEED = 0
EVENING_HOUR = 21
NIGHT_HOUR = 4
DAWN_HOUR = 6

# Starts of a fit, of which the one with the least cost is kept, and how far each goes:
# until no centre moves, so that centres are the means of their members.
STARTS = 4
INIT_STEPS = 5
ROUNDS = 300
TOLERANCE = 1e-12

# Hash partitions of the clustering input. The seeding of Spark's k-means depends on them,
# so their number is part of the method and the same for any cluster and any input.
PLACES = 16


def cluster_input(
    readings: DataFrame, start: Time, stop: Time, city: str | None = None
) -> DataFrame:
    """Readings of the training range, of every status, copies included."""
    return time_slice(readings, start, stop, city).select(
        "city_key",
        F.col("id").alias("station_id"),
        F.col("timestamp").alias("ts"),
        F.col("available_bikes").alias("nb_bikes"),
    )


def active_bins(rows: DataFrame, step: str = "5T") -> DataFrame:
    """Bin means of the stations that had a bike at least once."""
    bins = bin_means(rows, STATION, ["nb_bikes"], step)
    # ordered like the window of the back-fill, so that one sort serves both
    station = (
        Window.partitionBy(*STATION)
        .orderBy(F.desc("ts"))
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    most = F.max("nb_bikes").over(station)
    # counts are never negative, so a positive mean means a positive reading
    return bins.withColumn("most", most).where(
        F.col("most").isNull() | (F.col("most") > 0)
    ).drop("most")


def hour_profiles(rows: DataFrame, step: str = "5T") -> DataFrame:
    """Per station and hour: weekday mean of the filled grid over its largest hour."""
    means = weekday_hour_means(active_bins(rows, step), STATION, "nb_bikes", step)
    largest = F.max("value").over(Window.partitionBy(*STATION))
    return means.withColumn("value", F.try_divide(F.col("value"), largest))


def wide_profiles(profiles: DataFrame) -> DataFrame:
    """One row per station with the columns ``h00`` .. ``h23``."""
    wide = profiles.groupBy(*STATION).pivot("hour", list(range(24))).agg(F.first("value"))
    return wide.withColumnsRenamed({str(h): name for h, name in enumerate(HOUR_COLUMNS)})


def long_profiles(wide: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The inverse: one row per key and hour."""
    tall = wide.unpivot(list(keys), HOUR_COLUMNS, "hour_name", "value")
    return tall.select(
        *keys, F.substring("hour_name", 2, 2).cast("int").alias("hour"), "value"
    )


class Clusters(NamedTuple):
    labels: DataFrame
    centroids: DataFrame
    # stations that cannot be placed: hours or coordinates are not known
    rejects: DataFrame


def _fit(
    features: DataFrame, columns: Sequence[str], k: int, seed: int, places: int
) -> tuple[KMeansModel, DataFrame]:
    """A fitted model and the vectors it was fitted on.

    The seeding of Spark's k-means depends on how rows are partitioned, so the
    rows are placed by a hash of the station into ``places`` partitions and
    sorted inside them.
    """
    vectors = VectorAssembler(inputCols=list(columns), outputCol="features").transform(
        features
    )
    vectors = cut_lineage(vectors.select(*STATION, "features"))
    placed = vectors.repartition(places, *STATION).sortWithinPartitions(*STATION)
    # the rounds are short and wait for the driver; those of another start fill the gaps
    one = inheritable_thread_target(features.sparkSession)(
        lambda start: KMeans(
            k=k, seed=seed + start, initSteps=INIT_STEPS, maxIter=ROUNDS, tol=TOLERANCE,
            featuresCol="features", predictionCol="label",
        ).fit(placed)
    )
    with ThreadPoolExecutor(STARTS) as pool:
        fits = list(pool.map(one, range(STARTS)))
    return min(fits, key=lambda fit: fit.summary.trainingCost), vectors


def _numbered(model: KMeansModel) -> dict[int, int]:
    """Cluster numbers in the order of the centres (k of them, k is 4 or 12).

    Centres are compared to nine places: the last bits depend on the order of a sum.
    """
    centres = [tuple(round(float(v), 9) for v in c) for c in model.clusterCenters()]
    order = sorted(range(len(centres)), key=lambda i: centres[i])
    return {old: new for new, old in enumerate(order)}


def _apply(model: KMeansModel, vectors: DataFrame) -> DataFrame:
    number = F.create_map(*[F.lit(x) for pair in _numbered(model).items() for x in pair])
    labelled = model.transform(vectors)
    return labelled.select(*STATION, number[F.col("label")].alias("cluster_id"))


def _centres(spark, model: KMeansModel, names: Sequence[str]) -> DataFrame:
    number = _numbered(model)
    rows = [
        (number[i], *[float(v) for v in centre])
        for i, centre in enumerate(model.clusterCenters())
    ]
    ddl = "cluster_id int, " + ", ".join(f"{n} double" for n in names)
    return spark.createDataFrame(sorted(rows), ddl)


def complete_profiles(wide: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stations with all 24 hours known, and the rest, which cannot be clustered."""
    known = F.lit(True)
    for name in HOUR_COLUMNS:
        known = known & F.col(name).isNotNull()
    return wide.where(known), wide.where(~known)


def compute_clusters(
    readings: DataFrame,
    city: str,
    start: date | str,
    stop: date | str,
    k: int = PATTERN_CLUSTERS,
    seed: int = SEED,
    places: int = PLACES,
) -> Clusters:
    """k-means on the 24-hour profiles of one city: labels and centroids of a run.

    Stations without all 24 weekday hours have no profile; they are ``rejects``.
    """
    start, stop = as_date(start), as_date(stop)
    rows = cluster_input(readings, start, stop, city)
    wide, rest = complete_profiles(cut_lineage(wide_profiles(hour_profiles(rows))))
    model, vectors = _fit(wide, HOUR_COLUMNS, k, seed, places)
    run = {"start": F.lit(start), "stop": F.lit(stop)}
    text_id = F.col("cluster_id").cast("string").alias("cluster_id")
    labels = _apply(model, vectors).withColumns(run)
    centres = _centres(readings.sparkSession, model, HOUR_COLUMNS).withColumns(run)
    return Clusters(
        labels.select("city_key", "station_id", "start", "stop", text_id),
        centres.select(
            F.lit(city).alias("city_key"), text_id, "start", "stop", *HOUR_COLUMNS
        ),
        rest.withColumns(run).select("city_key", "station_id", "start", "stop"),
    )


def compute_geo_clusters(
    points: DataFrame,
    city: str,
    k: int = PLACE_CLUSTERS,
    seed: int = SEED,
    places: int = PLACES,
) -> Clusters:
    """k-means on (lat, lon) of one city's stations, labels by station id.

    Stations without coordinates are ``rejects``.
    """
    rows = points.where(F.col("city_key").isin(city_list(city)))
    known = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    model, vectors = _fit(rows.where(known), ["lat", "lon"], k, seed, places)
    centres = _centres(points.sparkSession, model, ["lat", "lon"])
    return Clusters(
        _apply(model, vectors).orderBy("station_id"),
        centres.select(F.lit(city).alias("city_key"), "cluster_id", "lat", "lon"),
        rows.where(~known).select("city_key", "station_id"),
    )


def _labelled(centroid: DataFrame, run: Sequence[str]) -> DataFrame:
    """Centroid rows with their ``label``, in one shuffle by run.

    Every window holds the four rows of a run.
    """
    hours = [F.col(h) for h in HOUR_COLUMNS]
    at = lambda hour: F.col(HOUR_COLUMNS[hour])
    known = F.filter(F.array(*hours), lambda v: v.isNotNull())
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
    mean = total(known) / F.size(known)
    apart = total(F.transform(known, lambda v: (v - F.col("_mean")) * (v - F.col("_mean"))))
    group = Window.partitionBy(*run) if run else Window.partitionBy(F.lit(0))
    first = lambda *order: F.row_number().over(group.orderBy(*order, "cluster_id")) == 1
    gain = at(EVENING_HOUR) - at(NIGHT_HOUR)
    named = (
        centroid.withColumn("_mean", mean)
        .withColumn("_spread", F.sqrt(F.try_divide(apart, F.size(known) - 1)))
        .withColumn("_gain", gain)
        .withColumn("_four", F.count(F.lit(1)).over(group) == PATTERN_CLUSTERS)
        .withColumn("_high", first("_spread"))
        .withColumn("_evening", first("_high", F.desc("_gain")))
        .withColumn("_taken", F.col("_high") | F.col("_evening"))
        .withColumn("_noon", first("_taken", HOUR_COLUMNS[DAWN_HOUR]))
    )
    label = (
        F.when(~F.col("_four"), F.raise_error(F.lit("a run must have four clusters")))
        .when(F.col("_high"), "high")
        .when(F.col("_evening"), "evening")
        .when(F.col("_noon"), "noon")
        .otherwise("morning")
    )
    return named.select(*centroid.columns, label.alias("label"))


def find_cluster(centroid: DataFrame, keys: Sequence[str] = RUN) -> DataFrame:
    """Name the four patterns of each run: high, evening, noon, morning.

    The flattest profile is ``high``; of the rest the one gaining most from
    night to evening is ``evening``; then the lowest at dawn is ``noon`` and the
    last one ``morning``.
    """
    return _labelled(centroid, list(keys)).select(*keys, "cluster_id", "label")


def _of_run(
    df: DataFrame, city: str | None, start: date | str | None, stop: date | str | None
) -> DataFrame:
    if city is not None:
        df = df.where(F.col("city_key").isin(city_list(city)))
    if start is not None:
        df = df.where(F.col("start") == F.lit(as_date(start)))
    if stop is not None:
        df = df.where(F.col("stop") == F.lit(as_date(stop)))
    return df


def station_clusters(
    clustering: DataFrame,
    station: DataFrame,
    city: str | None = None,
    ids: str | Iterable[object] | None = None,
    geojson: bool = False,
) -> DataFrame:
    """Cluster of each station in the newest run that knows the stations asked for."""
    place = station.select("city_key", "id", "name", "x", "y")
    rows = _of_run(clustering, city, None, None).withColumnRenamed("station_id", "id")
    if ids is not None:
        rows = only_ids(rows, as_ids(ids))
    rows = newest_run(rows.join(place, ["city_key", "id"])).select(
        "city_key", "id", "cluster_id", "start", "stop", "name", "x", "y"
    )
    return point_features(rows, CLUSTER_PROPERTIES) if geojson else rows


def cluster_profiles(
    centroid: DataFrame,
    city: str | None = None,
    start: date | str | None = None,
    stop: date | str | None = None,
) -> DataFrame:
    """Named centroids of the newest run (or of the given one) as 24-value arrays."""
    rows = _labelled(newest_run(_of_run(centroid, city, start, stop)), RUN)
    return rows.select(
        "city_key",
        "cluster_id",
        "label",
        "start",
        "stop",
        F.sequence(F.lit(0), F.lit(23)).alias("hour"),
        F.array(*HOUR_COLUMNS).alias("values"),
    )
