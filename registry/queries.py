"""Every registered query: (spark, folder of the test tables) -> DataFrame.

Queries run over whole tables.  A limit, a date or a horizon appears only where
it is an argument of the query itself.  Doubles that
depend on the order of a sum are rounded to six places, so that both engines
print the same value.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docklens import schemas
from docklens.api import BikeShare
from docklens.config import BORDEAUX, CITIES, LYON
from docklens.functions import geo
from docklens.functions.timecols import calendar
from docklens.operators import grid
from docklens.operators.latest import latest_date
from docklens.plans import (
    clusters,
    forecast,
    hours as hourly,
    predictions,
    profiles,
    rebase,
    stations,
    timeseries,
    transactions,
)
from docklens.session import cut_lineage, scratch_path
from docklens.sinks import export, hours as hour_sink, models, tables as sink
from docklens.sources import adapters, feeds, legacy, weather
from docklens.sources.feeds import Parsed
from docklens.sources.stations import coordinates, normalise_stations, read_stations
from docklens.sources.tables import read_predictions_csv, read_table, read_transactions_csv
from docklens.streaming import ingest, landing, latest as live, rolling
from docklens.streaming import transactions as running
from docklens.streaming.versions import read_changes, store_changes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Arguments shared by the queries and their SQL.
DAY = "2024-01-20"
WINDOW = 7
IDS = "1,2,3,5,8"
LIMIT = 20
FIRST, LAST = "2024-01-01", "2024-01-31"  # all readings: [FIRST, LAST)
AS_OF = "2024-01-31"
VALUES = 5
HORIZON = "30T"
CUT = "2024-01-25"
STATION = ["city_key", "station_id"]
COUNTS = ["nb_bikes", "nb_stands", "probability"]
LANDED_FILES = 16


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _round(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _each_city(make: Callable[[str], DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [make(city) for city in CITIES])


def _readings(spark, folder):
    return adapters.timeseries(spark, folder)


def _station(spark, folder):
    return adapters.station(spark, folder)


def _daily(spark, folder):
    return adapters.daily_transaction(spark, folder)


# Stations --------------------------------------------------------------------


@query
def city_counts(spark, folder):
    return stations.cities(_station(spark, folder))


@query
def station_list(spark, folder):
    return stations.stations(_station(spark, folder))


@query
def stations_first(spark, folder):
    rows = _station(spark, folder)
    return _each_city(lambda city: stations.stations(rows, city, LIMIT))


@query
def stations_by_id(spark, folder):
    return stations.specific_stations(_station(spark, folder), IDS)


@query
def station_ids(spark, folder):
    return stations.station_ids(_station(spark, folder))


@query
def station_geojson(spark, folder):
    features = stations.stations(_station(spark, folder), geojson=True)
    return export.feature_lines(features)


@query
def map_extent(spark, folder):
    return geo.extent(_station(spark, folder), "city_key")


# Readings and transactions ---------------------------------------------------


@query
def daily_transactions(spark, folder):
    return transactions.daily_transactions(_readings(spark, folder))


@query
def day_transactions(spark, folder):
    return transactions.aggregate_transactions(_readings(spark, folder), DAY)


@query
def daily_by_station(spark, folder):
    return transactions.daily_transaction(
        _daily(spark, folder), _station(spark, folder), None, LAST, 30
    )


@query
def daily_by_station_forward(spark, folder):
    return transactions.daily_transaction(
        _daily(spark, folder), _station(spark, folder), None, DAY, WINDOW, backward=False
    )


@query
def daily_by_station_nested(spark, folder):
    rows = transactions.daily_rows(
        _daily(spark, folder), _station(spark, folder), None, LAST, 30
    )
    return export.iso_text(transactions.nest_daily(rows))


def _top(spark, folder, order_by, window=WINDOW, backward=True):
    return transactions.daily_transaction_list(
        _daily(spark, folder), _station(spark, folder), None, DAY, LIMIT, order_by, window,
        backward,
    )


@query
def daily_top_value(spark, folder):
    return _top(spark, folder, "value")


@query
def daily_top_station(spark, folder):
    return _top(spark, folder, "station", backward=False)


@query
def daily_top_nested(spark, folder):
    return export.iso_text(transactions.nest_daily(_top(spark, folder, "value"), "rank"))


@query
def colour_scale(spark, folder):
    return transactions.colour_scale(_top(spark, folder, "value", window=0))


@query
def timeseries_rows(spark, folder):
    return timeseries.timeseries(
        _readings(spark, folder), _station(spark, folder), None, FIRST, LAST
    )


@query
def timeseries_nested(spark, folder):
    nested = timeseries.timeseries_nested(
        _readings(spark, folder), _station(spark, folder), None, FIRST, LAST
    )
    return export.iso_text(nested)


@query
def timeseries_pieces(spark, folder):
    """The same in pieces of ten days, so that stations have several."""
    nested = timeseries.timeseries_nested(
        _readings(spark, folder), _station(spark, folder), None, FIRST, LAST, stretch="10D"
    )
    return export.iso_text(nested)


@query
def latest_availability(spark, folder):
    return timeseries.latest_availability(
        _readings(spark, folder), _station(spark, folder), AS_OF
    )


@query
def latest_availability_date(spark, folder):
    return latest_date(latest_availability(spark, folder))


@query
def latest_geojson(spark, folder):
    features = timeseries.latest_availability(
        _readings(spark, folder), _station(spark, folder), AS_OF, geojson=True
    )
    return export.feature_lines(features)


@query
def fill_ratio(spark, folder):
    return stations.fill_ratio(latest_availability(spark, folder))


@query
def latest_in_window(spark, folder):
    return timeseries.latest_station_timewindow(_readings(spark, folder), FIRST, LAST)


@query
def training_readings(spark, folder):
    return timeseries.open_readings(_readings(spark, folder), FIRST, LAST)


# Chosen stations and limits --------------------------------------------------


@query
def ids_many(spark, folder):
    """Every station, asked for by a list that holds all ids."""
    station = _station(spark, folder)
    ids = [row.id for row in station.select("id").collect()]
    return stations.specific_stations(station, ids)


@query
def daily_of_ids(spark, folder):
    return transactions.daily_transaction(
        _daily(spark, folder), _station(spark, folder), IDS, LAST, 30
    )


@query
def timeseries_of_ids(spark, folder):
    nested = timeseries.timeseries_nested(
        _readings(spark, folder), _station(spark, folder), IDS, FIRST, LAST
    )
    return export.iso_text(nested)


@query
def hourly_profile_of_ids(spark, folder):
    rows = profiles.hourly_profile(
        _readings(spark, folder), _station(spark, folder), IDS, LAST, 30
    )
    return _round(rows, "mean")


@query
def daily_profile_of_ids(spark, folder):
    rows = profiles.daily_profile(
        _daily(spark, folder), _station(spark, folder), IDS, LAST, 30
    )
    return _round(rows, "mean")


@query
def clusters_of_ids(spark, folder):
    return clusters.station_clusters(
        adapters.clustering(spark, folder), _station(spark, folder), ids=IDS
    )


@query
def latest_first(spark, folder):
    rows = (_readings(spark, folder), _station(spark, folder))
    return _each_city(lambda city: timeseries.latest_availability(*rows, AS_OF, city, LIMIT))


@query
def latest_first_geojson(spark, folder):
    rows = (_readings(spark, folder), _station(spark, folder))
    features = _each_city(
        lambda city: timeseries.latest_availability(*rows, AS_OF, city, LIMIT, geojson=True)
    )
    return export.feature_lines(features)


@query
def latest_prediction_first(spark, folder):
    rows = (adapters.prediction(spark, folder), _station(spark, folder))
    return _each_city(lambda city: predictions.latest_predictions(*rows, AS_OF, city, LIMIT))


# Predictions -----------------------------------------------------------------


def _predictions(spark, folder, values, with_current, per_station=False, ids=None):
    return predictions.prediction_timeseries(
        adapters.prediction(spark, folder), _readings(spark, folder), _station(spark, folder),
        None, ids, FIRST, "2024-02-01", values, with_current, per_station=per_station,
    )


@query
def prediction_tail_of_ids(spark, folder):
    return _predictions(spark, folder, VALUES, True, ids=IDS)


@query
def prediction_tail_of_each_id(spark, folder):
    return _predictions(spark, folder, VALUES, False, per_station=True, ids=IDS)


@query
def prediction_tail(spark, folder):
    return _predictions(spark, folder, VALUES, True)


@query
def prediction_all(spark, folder):
    return _predictions(spark, folder, 0, False)


@query
def prediction_tail_per_station(spark, folder):
    return _predictions(spark, folder, VALUES, False, per_station=True)


@query
def latest_prediction(spark, folder):
    return predictions.latest_predictions(
        adapters.prediction(spark, folder), _station(spark, folder), AS_OF
    )


# Profiles --------------------------------------------------------------------


def _hourly(spark, folder):
    return _round(
        profiles.hourly_profile(
            _readings(spark, folder), _station(spark, folder), None, LAST, 30
        ),
        "mean",
    )


def _weekdays(spark, folder):
    return _round(
        profiles.daily_profile(_daily(spark, folder), _station(spark, folder), None, LAST, 30),
        "mean",
    )


@query
def hourly_profile(spark, folder):
    return _hourly(spark, folder)


@query
def hourly_profile_nested(spark, folder):
    return profiles.nest_profile(_hourly(spark, folder), "hour")


@query
def daily_profile(spark, folder):
    return _weekdays(spark, folder)


@query
def daily_profile_nested(spark, folder):
    return profiles.nest_profile(_weekdays(spark, folder), "day")


# Grids -----------------------------------------------------------------------


def _open(spark, folder):
    return timeseries.open_readings(_readings(spark, folder), FIRST, LAST)


@query
def resample_10min(spark, folder):
    bins = grid.bin_means(_open(spark, folder), STATION, COUNTS, "10T")
    return _round(bins, *COUNTS)


@query
def backfill_grid(spark, folder):
    return _round(grid.resample_mean(_open(spark, folder)), *COUNTS)


@query
def calendar_features(spark, folder):
    return calendar(_open(spark, folder).select(*STATION, "ts"))


@query
def future_label(spark, folder):
    rows = grid.resample_future(_open(spark, folder), HORIZON)
    return _round(rows, *COUNTS, "future")


@query
def future_label_join(spark, folder):
    """The label on bins with gaps, where partners are found by a join."""
    bins = grid.bin_means(_open(spark, folder), STATION, COUNTS, "10T")
    return _round(grid.add_future(bins, HORIZON), *COUNTS, "future")


@query
def train_split(spark, folder):
    table = forecast.labelled(_open(spark, folder), HORIZON)
    both = forecast.with_part(table, CUT, HORIZON, FIRST, periods=2)
    summary = both.groupBy("part", *STATION).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.sum("nb_bikes").alias("bikes"),
        F.sum("future").alias("future"),
        F.sum(F.col("day") * 1440 + F.col("hour") * 60 + F.col("minute")).alias("minutes"),
    )
    return _round(summary, "bikes", "future")


def _hours(spark, folder):
    return clusters.hour_profiles(
        clusters.cluster_input(_readings(spark, folder), FIRST, LAST)
    )


@query
def cluster_matrix(spark, folder):
    return _round(_hours(spark, folder), "value")


@query
def cluster_matrix_wide(spark, folder):
    wide = clusters.wide_profiles(_hours(spark, folder))
    return _round(wide, *schemas.HOUR_COLUMNS)


# Clusters --------------------------------------------------------------------


@query
def latest_clusters(spark, folder):
    return clusters.station_clusters(
        adapters.clustering(spark, folder), _station(spark, folder)
    )


@query
def cluster_geojson(spark, folder):
    features = clusters.station_clusters(
        adapters.clustering(spark, folder), _station(spark, folder), geojson=True
    )
    return export.feature_lines(features)


@query
def cluster_profiles(spark, folder):
    rows = clusters.cluster_profiles(adapters.centroid(spark, folder))
    return export.iso_text(rows)


@query
def cluster_labels(spark, folder):
    return clusters.find_cluster(adapters.centroid(spark, folder))


@query
def kmeans_profiles(spark, folder):
    readings = _readings(spark, folder)
    return _each_city(
        lambda city: clusters.compute_clusters(readings, city, FIRST, LAST).labels
    )


@query
def kmeans_centroids(spark, folder):
    readings = _readings(spark, folder)
    found = _each_city(
        lambda city: clusters.compute_clusters(readings, city, FIRST, LAST).centroids
    )
    return clusters.cluster_profiles(found)


def _shaped_readings(spark, folder):
    """Hourly readings of two weekdays, in four shapes that are clearly apart."""
    hour = F.col("hour")
    full = lambda low, high: F.when((hour >= low) & (hour < high), 40)
    shape = (
        F.when(F.col("shape") == 0, F.coalesce(full(0, 24), F.lit(4)))
        .when(F.col("shape") == 1, F.coalesce(full(0, 8), F.lit(4)))
        .when(F.col("shape") == 2, F.coalesce(full(8, 16), F.lit(4)))
        .otherwise(F.coalesce(full(16, 24), F.lit(4)))
    )
    slots = F.explode(F.sequence(F.lit(0), F.lit(47))).alias("slot")
    first = F.lit(FIRST).cast("timestamp_ntz")
    # a station becomes 48 rows: the few large splits of a small file are dealt out before
    places = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        _station(spark, folder)
        .select("city_key", "id")
        .repartition(places, "city_key", "id")
        .select("city_key", "id", (F.col("id").cast("int") % 4).alias("shape"), slots)
        .withColumn("hour", F.col("slot") % 24)
        .select(
            "city_key",
            "id",
            (first + F.make_dt_interval(hours="slot")).alias("timestamp"),
            F.lit(0).alias("available_stands"),
            shape.cast("int").alias("available_bikes"),
            F.lit("open").alias("status"),
        )
    )


@query
def kmeans_shapes(spark, folder):
    """Daily patterns that are clearly apart: the label and its name per station."""
    readings = _shaped_readings(spark, folder)

    def of_city(city):
        found = clusters.compute_clusters(readings, city, FIRST, LAST)
        names = clusters.find_cluster(found.centroids).select("city_key", "cluster_id", "label")
        return found.labels.join(names, ["city_key", "cluster_id"])

    return _each_city(of_city)


def _off(labels, points, centroids, columns, keys):
    """Of a fit: rows, rows not with their nearest centre, centres off their members' mean."""
    near = points.join(centroids.select("city_key", "cluster_id", *columns), "city_key")
    apart = reduce(
        lambda a, b: a + b, [F.pow(points[c] - centroids[c], F.lit(2)) for c in columns]
    )
    best = near.groupBy(*[points[k] for k in keys]).agg(
        F.min(apart).alias("least"),
        F.min_by(centroids["cluster_id"], apart).alias("nearest"),
    )
    rows = labels.select(*keys, "cluster_id").join(best, keys)
    wrong = rows.groupBy("city_key").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("cluster_id") != F.col("nearest"), 1)).alias("misplaced"),
    )
    means = points.join(labels.select(*keys, "cluster_id"), keys).groupBy(
        "city_key", "cluster_id"
    ).agg(*[F.avg(c).alias(f"m_{c}") for c in columns])
    drift = reduce(F.greatest, [F.abs(F.col(c) - F.col(f"m_{c}")) for c in columns]) if len(
        columns
    ) > 1 else F.abs(F.col(columns[0]) - F.col(f"m_{columns[0]}"))
    off = centroids.join(means, ["city_key", "cluster_id"]).groupBy("city_key").agg(
        F.count(F.lit(1)).alias("centres"),
        F.count(F.when(drift > 1e-6, 1)).alias("off_centre"),
    )
    return wrong.join(off, "city_key")


@query
def kmeans_profiles_check(spark, folder):
    """The fit of the daily patterns: every station with its nearest centre, every centre a mean."""
    readings = _readings(spark, folder)

    def of_city(city):
        rows = clusters.cluster_input(readings, FIRST, LAST, city)
        wide = clusters.wide_profiles(clusters.hour_profiles(rows))
        points, _ = clusters.complete_profiles(cut_lineage(wide))  # read twice by the check
        found = clusters.compute_clusters(readings, city, FIRST, LAST)
        return _off(found.labels, points, found.centroids, schemas.HOUR_COLUMNS, STATION)

    return _each_city(of_city)


@query
def kmeans_geo_check(spark, folder):
    points = coordinates(_station(spark, folder))

    def of_city(city):
        found = clusters.compute_geo_clusters(points, city)
        return _off(found.labels, points, found.centroids, ["lat", "lon"], STATION)

    return _each_city(of_city)


@query
def kmeans_geo(spark, folder):
    points = coordinates(_station(spark, folder))
    return _each_city(lambda city: clusters.compute_geo_clusters(points, city).labels)


@query
def kmeans_geo_centroids(spark, folder):
    points = coordinates(_station(spark, folder))
    return _each_city(lambda city: clusters.compute_geo_clusters(points, city).centroids)


def _trained(spark, readings):
    """The models of the cities, trained, saved and loaded again."""
    lake = scratch_path(spark, "forecast")
    found = forecast.train_cities(readings, CITIES, FIRST, LAST, CUT, HORIZON)
    for city, trained in found.items():
        path = models.model_path(lake, city, FIRST, LAST, CUT, HORIZON)
        models.save_model(trained.model, path)
        found[city] = trained._replace(model=models.load_model(path))
    return found


def _log_loss(label: Column, p: Column) -> Column:
    return -(label * F.ln(p) + (1 - label) * F.ln(1 - p))


@query
def forecast_availability(spark, folder):
    """Train a model of each city and forecast from its stations' newest readings."""
    readings = _readings(spark, folder)
    found = _trained(spark, readings)

    def of_city(city):
        return forecast.predict(readings, found[city].model, FIRST, LAST, HORIZON, city)

    return _each_city(of_city)


@query
def forecast_check(spark, folder):
    """Per city: stations forecast, forecasts out of bounds, and whether the mean is beaten.

    A forecast lies between 0 and 1, and neither is reached. (Few of the test stations'
    readings change within the horizon, so "no change" is nearly exact.)
    """
    readings = _readings(spark, folder)
    found = _trained(spark, readings)

    def of_city(city):
        trained = found[city]
        rows = forecast.predict(readings, trained.model, FIRST, LAST, HORIZON, city)
        table = forecast.labelled(timeseries.open_readings(readings, FIRST, LAST, city), HORIZON)
        parts = forecast.with_part(table, CUT, HORIZON, periods=2)
        mean = parts.where("part = 'train'").agg(F.avg("future")).scalar()
        constant = parts.where("part = 'test'").agg(F.avg(_log_loss(F.col("future"), mean)))
        beaten = F.lit(trained.test_loss[-1]) < constant.scalar()
        bad = (
            (F.col("availability") <= 0)
            | (F.col("availability") >= 1)
            | (F.col("nb_bikes") + F.col("nb_stands") != 40)
            | (F.col("nb_bikes") < 0)
        )
        return rows.groupBy("city_key").agg(
            F.countDistinct("station_id").alias("stations"),
            F.count(F.when(bad, 1)).alias("bad"),
        ).withColumn("beaten", beaten)

    return _each_city(of_city)


@query
def forecast_loss(spark, folder):
    """Per city and part: rows, and whether the loss of the fit is that of its forecasts.

    The fit reports its loss from cells of rows that share all bins; here it is taken again
    from each row of the grid and the model's probability for it.
    """
    readings = _readings(spark, folder)
    found = _trained(spark, readings)

    def of_city(city):
        trained = found[city]
        table = forecast.labelled(timeseries.open_readings(readings, FIRST, LAST, city), HORIZON)
        scored = forecast.shared_probabilities(
            forecast.with_part(table, CUT, HORIZON, periods=2), trained.model
        )
        train, test = trained.train_loss, trained.test_loss
        reported = F.when(F.col("part") == "train", train[-1]).otherwise(test[-1])
        falls = F.when(F.col("part") == "train", train[-1] < train[0]).otherwise(True)
        return (
            scored.groupBy("city_key", "part")
            .agg(
                F.count("*").alias("n"),
                F.avg(_log_loss(F.col("future"), F.col("availability"))).alias("loss"),
            )
            .select(
                "city_key", "part", "n",
                (F.abs(F.col("loss") - reported) < 1e-6).alias("agrees"), falls.alias("falls"),
            )
        )

    return _each_city(of_city)


@query
def dock_rounding(spark, folder):
    """Whole bikes and stands from a probability (here: a third of the fill)."""
    rows = _open(spark, folder).withColumn("availability", F.col("probability") / 3)
    return forecast.split_docks(rows).select(*STATION, "ts", "pred_bikes", "pred_stands")


# Sources ---------------------------------------------------------------------


def _feed_events(spark, folder):
    readings = adapters.events(spark, folder)
    bikes = F.floor("value").cast("int") % 41
    return readings.withColumns({"bikes": bikes, "stands": 40 - bikes})


def _iso(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


@query
def gml_feed(spark, folder):
    """Events spelled as GML members, then read like the feed."""
    member = F.to_xml(
        F.struct(
            F.struct(
                F.col("event_id").cast("int").alias("GID"),
                F.col("user_id").cast("int").alias("IDENT"),
                F.lit("VLS").alias("TYPE"),
                F.col("event_type").alias("NOM"),
                F.when(F.col("event_type") == "error", "DECONNECTEE")
                .otherwise("CONNECTEE")
                .alias("ETAT"),
                F.col("stands").alias("NBPLACES"),
                F.col("bikes").alias("NBVELOS"),
                _iso("ts").alias("MDATE"),
            ).alias("CI_VCUB_P")
        ),
        {"rowTag": "member"},
    )
    parsed = F.from_xml(F.col("text"), schemas.GML_MEMBER, {"rowTag": "member"})
    members = (
        _feed_events(spark, folder)
        .select(member.alias("text"), F.to_date("ts").cast("string").alias("snapshot"))
        .select(parsed["CI_VCUB_P"].alias("CI_VCUB_P"), "snapshot")
    )
    return feeds.canonical_readings(feeds.member_rows(members), BORDEAUX)


@query
def geojson_feed(spark, folder):
    """Events spelled as one-feature collections with some blank counts."""
    blank = lambda kind, name: F.when(F.col("event_type") == kind, "").otherwise(
        F.col(name).cast("string")
    )
    properties = F.struct(
        F.col("user_id").cast("string").alias("number"),
        _iso("ts").alias("last_update"),
        blank("view", "stands").alias("available_bike_stands"),
        blank("click", "bikes").alias("available_bikes"),
        F.when(F.col("event_type") == "error", "CLOSED").otherwise("OPEN").alias("status"),
    )
    text = F.to_json(
        F.struct(F.array(F.struct(properties.alias("properties"))).alias("features"))
    )
    documents = (
        _feed_events(spark, folder)
        .select(text.alias("text"), F.to_date("ts").cast("string").alias("snapshot"))
        .select(F.from_json("text", schemas.GEOJSON_READINGS).alias("d"), "snapshot")
        .select("d.features", "snapshot")
    )
    rows = feeds.canonical_readings(feeds.feature_rows(documents), LYON)
    return rows.withColumns({c: F.col(c).cast("int") for c in feeds.COUNTS})


def _gappy(spark, folder):
    missing = lambda kind, name: F.when(F.col("event_type") != kind, F.col(name))
    return _feed_events(spark, folder).select(
        "city_key",
        F.to_date("ts").cast("string").alias("snapshot"),
        F.col("user_id").cast("string").alias("id"),
        F.col("ts").alias("timestamp"),
        missing("view", "stands").alias("available_stands"),
        missing("click", "bikes").alias("available_bikes"),
        F.col("event_type").alias("status"),
    )


@query
def snapshot_fill(spark, folder):
    return feeds.fill_counts(_gappy(spark, folder)).readings


@query
def snapshot_rejects(spark, folder):
    return feeds.fill_counts(_gappy(spark, folder)).rejects


@query
def station_fill(spark, folder):
    return feeds.fill_counts(_gappy(spark, folder), scope="station").readings


@query
def status_recode(spark, folder):
    raw = _feed_events(spark, folder).select(
        F.col("user_id").alias("ident"),
        F.col("ts").alias("heure"),
        F.col("stands").alias("nbplaces"),
        F.col("bikes").alias("nbvelos"),
        F.when(F.col("event_type") == "view", "CONNECTEE")
        .when(F.col("event_type") == "click", F.lit(None))
        .otherwise(F.col("event_type"))
        .alias("etat"),
    )
    return feeds.canonical_readings(raw, BORDEAUX, keep=())


@query
def load_guard(spark, folder):
    text = _gappy(spark, folder).withColumns(
        {
            "available_stands": F.coalesce(
                F.col("available_stands").cast("string"), F.lit("None")
            ),
            "available_bikes": F.col("available_bikes").cast("string"),
            "status": F.when(F.col("status") != "signup", F.col("status")).otherwise("None"),
        }
    )
    return feeds.drop_unloadable(text)


def _lambert_stations(spark, folder):
    key = F.col("c_custkey")
    return spark.read.parquet(f"{folder}/customer.parquet").select(
        key.alias("numstat"),
        F.col("c_name").alias("nom"),
        F.col("c_mktsegment").alias("adresse"),
        F.lit("bordeaux").alias("commune"),
        F.lit("40").alias("nbsuppor"),
        (410000.0 + 25.0 * (key % 1000)).alias("x"),
        (6415000.0 + 25.0 * F.floor(key / 1000)).alias("y"),
    )


@query
def reproject(spark, folder):
    return _round(normalise_stations(_lambert_stations(spark, folder), BORDEAUX), "x", "y")


def _station_documents(spark, folder) -> dict[str, Parsed]:
    """Stations of both cities in GeoJSON extracts of 200 each, read with their rejects.

    Every other point has a height; of every 30 stations one has no id, one unreadable docks
    and one a broken point; one extract of each city is cut before its end.
    """
    key = F.col("c_custkey")
    customers = spark.read.parquet(f"{folder}/customer.parquet")
    place = {
        "bordeaux": (410000.0 + 25.0 * (key % 1000), 6415000.0 + 25.0 * F.floor(key / 1000)),
        "lyon": (4.7 + 0.005 * (key % 40), 45.7 + 0.005 * F.floor(key / 40)),
    }
    head, foot = '{"type":"FeatureCollection","features":[', "]}"
    parsed = {}
    for name, city in CITIES.items():
        id_, title, address, town, docks = city.station_columns
        properties = F.struct(
            F.when(key % 30 != 1, key.cast("string")).alias(id_),
            F.col("c_name").alias(title), F.col("c_mktsegment").alias(address),
            F.lit(name).alias(town),
            F.when(key % 30 == 2, "many").otherwise("40").alias(docks),
        )
        x, y = [v.cast("string") for v in place[name]]
        x = F.when(key % 30 == 3, "east").otherwise(x)
        at = F.when(key % 2 == 0, F.array(x, y, F.lit("9.5"))).otherwise(F.array(x, y))
        feature = F.struct(
            F.lit("Feature").alias("type"), properties.alias("properties"),
            F.struct(F.lit("Point").alias("type"), at.alias("coordinates")).alias("geometry"),
        )
        items = F.array_sort(F.collect_list(F.struct(key, F.to_json(feature).alias("text"))))
        body = F.array_join(F.transform(items, lambda item: item["text"]), ",")
        whole = F.concat(F.lit(head), body, F.lit(foot))
        kept = F.when(F.col("part") == 2, F.length(whole) - 30).otherwise(F.length(whole))
        path = scratch_path(spark, f"extract-{name}")
        customers.groupBy(F.floor(key / 200).alias("part")).agg(
            F.substr(whole, F.lit(1), kept).alias("text")
        ).write.partitionBy("part").text(path)
        parsed[name] = read_stations(spark, f"{path}/*", city)
    return parsed


@query
def station_files(spark, folder):
    """Stations out of GeoJSON extracts, with what could be read of them."""
    parsed = _station_documents(spark, folder)
    rows = reduce(DataFrame.unionByName, [p.rows for p in parsed.values()])
    return _round(rows, "x", "y")


@query
def station_file_rejects(spark, folder):
    """Per city and reason: what could not be read of the extracts."""
    parsed = _station_documents(spark, folder)
    rejects = [p.damaged.withColumn("city_key", F.lit(c)) for c, p in parsed.items()]
    return reduce(DataFrame.unionByName, rejects).groupBy("city_key", "reason").agg(
        F.count("*").alias("n")
    )


def _weather_parts():
    t = F.col("value")
    return [
        F.array(
            F.struct(F.col("event_id").cast("int").alias("id"), F.col("event_type").alias("main"))
        ).alias("weather"),
        F.struct((t / 10).alias("speed")).alias("wind"),
        F.struct(
            t.alias("temp"),
            (t - 1).alias("temp_min"),
            (t + 1).alias("temp_max"),
            (t + 1000).alias("pressure"),
            F.lit(50.0).alias("humidity"),
        ).alias("main"),
        F.struct(F.floor("value").cast("int").alias("all")).alias("clouds"),
    ]


_WEATHER_DOUBLES = ("temp", "temp_min", "temp_max", "pressure", "wind_speed")


@query
def weather_current(spark, folder):
    """Events spelled as weather documents, then read like the service's."""
    documents = (
        adapters.events(spark, folder)
        .select(F.col("ts").alias("date"), F.to_json(F.struct(*_weather_parts())).alias("text"))
        .select("date", F.from_json("text", schemas.CURRENT_JSON).alias("d"))
        .select("date", "d.*")
    )
    return _round(weather.current_rows(documents), *_WEATHER_DOUBLES)


@query
def weather_forecast(spark, folder):
    rain = F.when(
        F.col("event_type") == "view", F.struct(F.col("value").alias("3h"))
    ).alias("rain")
    step = F.struct(*_weather_parts(), F.unix_timestamp("ts").alias("dt"), rain)
    documents = (
        adapters.events(spark, folder)
        .select(
            F.col("ts").alias("forecast_at"),
            F.to_json(F.struct(F.array(step).alias("list"))).alias("text"),
        )
        .select("forecast_at", F.from_json("text", schemas.FORECAST_JSON).alias("d"))
        .select("forecast_at", "d.list")
    )
    return _round(weather.forecast_rows(documents), *_WEATHER_DOUBLES, "rain_3h")


def _legacy_readings(spark, folder):
    return _feed_events(spark, folder).select(
        F.col("user_id").cast("int").alias("number"),
        F.col("ts").alias("last_update"),
        F.lit(40).alias("bike_stands"),
        F.col("stands").alias("available_bike_stands"),
        F.col("bikes").alias("available_bikes"),
        F.lit("no").alias("bonus"),
        F.when(F.col("event_type") == "error", "CLOSED")
        .when(F.col("event_type") == "signup", "MAINT")
        .otherwise("OPEN")
        .alias("status"),
    )


@query
def legacy_upgrade(spark, folder):
    return legacy.upgrade_readings(_legacy_readings(spark, folder), "lyon")


@query
def legacy_view(spark, folder):
    names = _station(spark, folder).select(
        F.col("id").alias("idstation"), F.col("name").alias("nom")
    )
    return legacy.normalised_view(_legacy_readings(spark, folder), "lyon", names)


@query
def legacy_centroids(spark, folder):
    former = adapters.centroid(spark, folder).withColumnsRenamed(
        {name: f"h{hour}" for hour, name in enumerate(schemas.HOUR_COLUMNS)}
    )
    return legacy.upgrade_centroids(
        former.withColumn("cluster_id", F.col("cluster_id").cast("int"))
    )


@query
def centroid_long(spark, folder):
    keys = ["city_key", "cluster_id", "start", "stop"]
    return clusters.long_profiles(adapters.centroid(spark, folder), keys)


# Rebase ----------------------------------------------------------------------


@query
def rebase_readings(spark, folder):
    readings = _readings(spark, folder)
    return rebase.rebase_times(readings, readings, AS_OF)


@query
def rebase_daily(spark, folder):
    return rebase.rebase_dates(_daily(spark, folder), AS_OF)


@query
def legacy_upgrade_bordeaux(spark, folder):
    return legacy.upgrade_readings(_legacy_bordeaux(spark, folder), "bordeaux")


@query
def legacy_view_bordeaux(spark, folder):
    return legacy.normalised_view(_legacy_bordeaux(spark, folder), "bordeaux")


def _legacy_bordeaux(spark, folder):
    return _feed_events(spark, folder).select(
        F.col("event_id").cast("int").alias("gid"),
        F.col("user_id").cast("int").alias("ident"),
        F.lit("VLS").alias("type"),
        F.col("event_type").alias("name"),
        F.col("ts"),
        F.col("stands").alias("available_stand"),
        F.col("bikes").alias("available_bike"),
        F.when(F.col("event_type") == "error", "DECONNECTEE")
        .when(F.col("event_type") == "signup", "MAINT")
        .otherwise("CONNECTEE")
        .alias("state"),
    )


# Files -----------------------------------------------------------------------

# Namespaces of the GML feed.
_GML_ROOT = (
    "wfs:FeatureCollection xmlns:wfs='http://www.opengis.net/wfs/2.0' "
    "xmlns:bm='http://data.bordeaux-metropole.fr/wfs'"
)


def _documents(rows: DataFrame, item: Column, path: str) -> None:
    """A JSON document for each day: the list of the day's items."""
    day = F.to_date("ts").alias("day")
    rows.groupBy(day).agg(F.to_json(F.collect_list(item)).alias("value")).write.partitionBy(
        "day"
    ).text(path)


@query
def gml_files(spark, folder):
    """Events written as GML files with namespaces in Latin-1, and read as the feed."""
    path = scratch_path(spark, "gml")
    fields = {
        "GID": F.col("event_id").cast("int"),
        "IDENT": F.col("user_id").cast("int"),
        "TYPE": F.lit("VLS"),
        "NOM": F.concat(F.lit("Méri "), F.col("event_type")),
        "ETAT": F.when(F.col("event_type") == "error", "DECONNECTEE").otherwise("CONNECTEE"),
        "NBPLACES": F.col("stands"),
        "NBVELOS": F.col("bikes"),
        "MDATE": _iso("ts"),
    }
    member = F.struct(*[c.alias(f"bm:{name}") for name, c in fields.items()])
    _feed_events(spark, folder).select(member.alias("bm:CI_VCUB_P")).write.format("xml").options(
        rootTag=_GML_ROOT, rowTag="wfs:member", encoding="ISO-8859-1", validateName="false",
        declaration="version='1.0' encoding='ISO-8859-1'",
    ).save(path)
    rows = feeds.canonical_readings(feeds.read_gml(spark, path), BORDEAUX, ["nom"])
    return rows


@query
def geojson_files(spark, folder):
    """Events written as GeoJSON documents, one a day, and read as the feed."""
    path = scratch_path(spark, "geojson")
    blank = lambda kind, name: F.when(F.col("event_type") == kind, "").otherwise(
        F.col(name).cast("string")
    )
    properties = F.struct(
        F.col("user_id").cast("string").alias("number"),
        _iso("ts").alias("last_update"),
        blank("view", "stands").alias("available_bike_stands"),
        blank("click", "bikes").alias("available_bikes"),
        F.when(F.col("event_type") == "error", "CLOSED").otherwise("OPEN").alias("status"),
    )
    feature = F.struct(F.lit("Feature").alias("type"), properties.alias("properties"))
    rows = _feed_events(spark, folder).groupBy(F.to_date("ts").alias("day"))
    rows.agg(
        F.to_json(F.struct(F.collect_list(feature).alias("features"))).alias("value")
    ).write.partitionBy("day").text(path)
    found = feeds.canonical_readings(feeds.read_geojson(spark, f"{path}/*"), LYON, [])
    return found.withColumns({c: F.col(c).cast("int") for c in feeds.COUNTS})


def _damaged_feeds(spark, folder) -> dict[str, str]:
    """Snapshot documents of both cities by day and quarter of the stations, some damaged.

    Those of every fifth day are cut before their end, and a signup's bikes are no number.
    """
    root = scratch_path(spark, "damaged")
    bikes = F.when(F.col("event_type") == "signup", "n/a").otherwise(F.col("bikes").cast("string"))
    fields = {
        "GID": F.col("event_id"), "IDENT": F.col("user_id"), "NBPLACES": F.col("stands"),
        "NBVELOS": bikes, "MDATE": _iso("ts"), "ETAT": F.lit("CONNECTEE"),
    }
    tags = [
        F.concat(F.lit(f"<bm:{name}>"), value.cast("string"), F.lit(f"</bm:{name}>"))
        for name, value in fields.items()
    ]
    member = F.concat(
        F.lit("<wfs:member><bm:CI_VCUB_P>"), *tags, F.lit("</bm:CI_VCUB_P></wfs:member>")
    )
    properties = F.struct(
        F.col("user_id").cast("string").alias("number"), _iso("ts").alias("last_update"),
        F.col("stands").cast("string").alias("available_bike_stands"),
        bikes.alias("available_bikes"), F.lit("OPEN").alias("status"),
    )
    feature = F.to_json(F.struct(F.lit("Feature").alias("type"), properties.alias("properties")))
    events = _feed_events(spark, folder).withColumns(
        {"day": F.to_date("ts"), "quarter": F.col("user_id") % 4}
    )
    paths = {}
    for city, text, head, between, foot in (
        ("bordeaux", member, f"<{_GML_ROOT}>", "", "</wfs:FeatureCollection>"),
        ("lyon", feature, '{"type":"FeatureCollection","features":[', ",", "]}"),
    ):
        parts = F.array_sort(F.collect_list(F.struct(F.col("event_id"), text.alias("text"))))
        body = F.array_join(F.transform(parts, lambda p: p["text"]), between)
        whole = F.concat(F.lit(head), body, F.lit(foot))
        # the cut takes the foot and a part of the last record
        kept = F.when(F.dayofmonth("day") % 5 == 0, F.length(whole) - len(foot) - 20).otherwise(
            F.length(whole)
        )
        documents = events.groupBy("day", "quarter").agg(F.substr(whole, F.lit(1), kept).alias("text"))
        paths[city] = f"{root}/{city}"
        documents.write.partitionBy("day", "quarter").text(paths[city])
    return paths


def _damage_by_day(readings: DataFrame, damaged: DataFrame) -> DataFrame:
    """Readings, those with bikes, cut documents and damaged fields of each city and day."""
    day = F.to_date(F.regexp_extract("snapshot", "day=([0-9-]+)", 1))
    counted = damaged.groupBy("city_key", day.alias("day")).agg(
        F.count(F.when(F.col("reason") == "document", 1)).alias("cut"),
        F.count(F.when(F.col("reason") == "field", 1)).alias("fields"),
        F.count(F.when(F.col("reason") == "record", 1)).alias("records"),
    )
    return (
        readings.groupBy("city_key", F.to_date("timestamp").alias("day"))
        .agg(F.count("*").alias("readings"), F.sum("available_bikes").alias("bikes"))
        .join(counted, ["city_key", "day"], "full")
        .select(
            "city_key", "day", F.coalesce("readings", F.lit(0)).cast("long").alias("readings"),
            F.coalesce("bikes", F.lit(0)).cast("long").alias("bikes"),
            *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("cut", "fields", "records")],
        )
    )


@query
def feed_rejects(spark, folder):
    """Damaged snapshots: their good rows are readings, the rest is kept with its text."""
    paths = _damaged_feeds(spark, folder)

    def of_city(city):
        rows, damaged = feeds.PARSERS[city.city_key](spark, f"{paths[city.city_key]}/*/*")
        readings = feeds.canonical_readings(rows, city)
        return _damage_by_day(readings, damaged.withColumn("city_key", F.lit(city.city_key)))

    return of_city(BORDEAUX).unionByName(of_city(LYON))


@query
def feed_rejects_stream(spark, folder):
    """The same snapshots through the stream; what has no count is a reject, too."""
    paths = _damaged_feeds(spark, folder)

    def of_city(city):
        root = scratch_path(spark, "landed")
        landing.land_feed(
            spark, f"{paths[city]}/*/*", city, root, f"{root}-checkpoint", files_per_batch=50
        ).awaitTermination()
        read = lambda name: spark.read.parquet(f"{root}/{name}")
        readings = read("readings").unionByName(read("rejects"))
        return _damage_by_day(readings, read("damaged").withColumn("city_key", F.lit(city)))

    # a missing count is filled from another station's, so the sums differ from the batch's
    return _each_city(of_city).drop("bikes")


@query
def weather_files(spark, folder):
    """Events written as current-weather documents, read and stored twice."""
    path = scratch_path(spark, "weather")
    _documents(adapters.events(spark, folder), F.struct(*_weather_parts()), f"{path}/files")
    polled = datetime.fromisoformat(AS_OF)
    for _ in range(2):
        rows = weather.read_current(spark, f"{path}/files/*", polled)
        sink.write_weather(rows.withColumn("city_key", F.lit("lyon")), path, "current")
    return _round(read_table(spark, path, "weather_current"), *_WEATHER_DOUBLES)


@query
def weather_forecast_files(spark, folder):
    path = scratch_path(spark, "forecast")
    step = F.struct(*_weather_parts(), F.unix_timestamp("ts").alias("dt"))
    document = F.struct(F.array(step).alias("list"))
    _documents(adapters.events(spark, folder), document, f"{path}/files")
    polled = datetime.fromisoformat(AS_OF)
    for _ in range(2):
        rows = weather.read_forecast(spark, f"{path}/files/*", polled)
        sink.write_weather(rows.withColumn("city_key", F.lit("lyon")), path, "forecast")
    return _round(read_table(spark, path, "weather_forecast"), *_WEATHER_DOUBLES)


@query
def roll_up_csv(spark, folder):
    """The day's roll-up written as a file and read back."""
    path = scratch_path(spark, "roll-up")
    day = transactions.aggregate_transactions(_readings(spark, folder), DAY)
    day.select("id", F.col("number").alias("transactions")).write.csv(path, header=True)
    return read_transactions_csv(spark, path, DAY)


@query
def predictions_csv(spark, folder):
    path = scratch_path(spark, "predictions")
    adapters.prediction(spark, folder).select(
        F.col("timestamp").alias("ts"), "station_id", F.col("availability").alias("pred_probability"),
        F.col("nb_bikes").alias("pred_nb_bikes"), F.col("nb_stands").alias("pred_nb_stands"),
    ).write.option("timestampNTZFormat", sink.CSV_TIME).csv(path, header=True)
    return read_predictions_csv(spark, path, "1H")


# Sinks -----------------------------------------------------------------------


@query
def daily_store(spark, folder):
    """Written twice, read once: the second write replaces the same days."""
    lake = scratch_path(spark, "daily")
    for _ in range(2):
        sink.write_daily(_daily(spark, folder), lake)
    return read_table(spark, lake, "daily_transaction")


@query
def prediction_store(spark, folder):
    """A second forecast replaces equal keys and keeps the others."""
    lake = scratch_path(spark, "prediction")
    stored = adapters.prediction(spark, folder)
    sink.write_predictions(stored, lake)
    again = stored.where(F.col("nb_bikes") < 10).withColumn("availability", F.lit(0.5))
    sink.write_predictions(again, lake)
    return read_table(spark, lake, "prediction").drop("date")


@query
def readings_store(spark, folder):
    """Appended to the partitioned table, then sliced by day and city."""
    lake = scratch_path(spark, "readings")
    for _ in range(2):  # the same load twice is one load
        sink.append_readings(_readings(spark, folder), lake, "first")
    stored = read_table(spark, lake, "timeseries")
    return timeseries.timeseries(stored, _station(spark, folder), None, FIRST, DAY).drop("date")


@query
def snapshot_csv(spark, folder):
    """Written as snapshot files by city and day, then read back."""
    path = scratch_path(spark, "snapshot")
    sink.write_snapshot_csv(_readings(spark, folder), path)
    rows = feeds.read_snapshot_csv(spark, path)
    return feeds.drop_unloadable(rows).drop("snapshot", "date")


@query
def cluster_store(spark, folder):
    """Labels and centroids of both runs, written twice, the labels read back."""
    lake = scratch_path(spark, "cluster")
    for _ in range(2):
        sink.write_clusters(
            adapters.clustering(spark, folder), adapters.centroid(spark, folder), lake
        )
    return read_table(spark, lake, "clustering")


@query
def centroid_store(spark, folder):
    lake = scratch_path(spark, "centroid")
    for _ in range(2):
        sink.write_clusters(
            adapters.clustering(spark, folder), adapters.centroid(spark, folder), lake
        )
    return read_table(spark, lake, "centroid")


def _geo_groups(spark, folder):
    """Stations in twelve places far apart, some degrees beside each other."""
    number = F.col("id").cast("int")
    place = number % 12
    return _station(spark, folder).select(
        "city_key",
        F.col("id").alias("station_id"),
        (place * 7 % 12 + 0.0001 * (F.floor(number / 12) % 10)).alias("lat"),
        (place * 5 % 12 + 40.0).alias("lon"),
        place.alias("place"),
    )


@query
def geo_store(spark, folder):
    """Places that are clearly apart: fitted, written twice and read back."""
    lake = scratch_path(spark, "geo")
    points = _geo_groups(spark, folder)
    for city in CITIES:
        found = clusters.compute_geo_clusters(points, city)
        for _ in range(2):
            sink.write_geo_clusters(found.labels, found.centroids, lake)
    return read_table(spark, lake, "geo_clustering")


@query
def geo_centroid_store(spark, folder):
    lake = scratch_path(spark, "geo")
    points = _geo_groups(spark, folder)
    for city in CITIES:
        found = clusters.compute_geo_clusters(points, city)
        sink.write_geo_clusters(found.labels, found.centroids, lake)
    return _round(read_table(spark, lake, "geo_centroid"), "lat", "lon")


@query
def station_store(spark, folder):
    lake = scratch_path(spark, "station")
    for _ in range(2):
        sink.write_stations(_station(spark, folder), lake)
    return read_table(spark, lake, "station")


@query
def json_export(spark, folder):
    rows = _daily(spark, folder).select("city_key", "id", "number", "date")
    return export.json_rows(rows)


@query
def lake_api(spark, folder):
    """Top stations through the query object on the test tables."""
    share = BikeShare.from_star_schema(spark, folder)
    top = _each_city(lambda city: share.daily_transaction_list(city, DAY, LIMIT, "value"))
    return export.iso_text(top)


# Streams ---------------------------------------------------------------------


@query
def stream_daily_transactions(spark, folder):
    path = scratch_path(spark, "stream-daily")
    stream = adapters.timeseries_stream(spark, folder)
    running.run_daily_transactions(
        stream, f"{path}/rows", f"{path}/checkpoint"
    ).awaitTermination()
    return running.read_daily_transactions(spark, f"{path}/rows")


@query
def stream_dedup(spark, folder):
    path = scratch_path(spark, "stream-ingest")
    stream = adapters.timeseries_stream(spark, folder)
    ingest.ingest(stream, path, f"{path}/checkpoint").awaitTermination()
    return read_table(spark, path, "timeseries").drop("date")


@query
def stream_window_means(spark, folder):
    path = scratch_path(spark, "stream-means")
    means = rolling.window_means(adapters.timeseries_stream(spark, folder))
    store_changes(means, f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    rows = read_changes(spark, f"{path}/rows", ["city_key", "id", "ts"])
    return _round(rows, "mean_bikes")


@query
def stream_latest(spark, folder):
    path = scratch_path(spark, "stream-latest")
    stream = adapters.timeseries_stream(spark, folder)
    live.run_latest(stream, f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    return live.read_latest(spark, f"{path}/rows")


def _landed(spark, folder, path):
    """Readings in five landings: copies and changed ones in all, an early and a late one.

    Each is as many files, written side by side, as the stream takes in a batch.
    """
    rows = _readings(spark, folder)
    shifted = lambda days: rows.withColumn(
        "timestamp", F.col("timestamp") + F.expr(f"INTERVAL {days} DAY")
    )
    changed = rows.withColumn("available_bikes", F.col("available_bikes") + 1)
    for part in (rows, changed.unionByName(rows), shifted(3), shifted(-3), rows):
        landing = part.select(*schemas.TIMESERIES.names).repartition(LANDED_FILES)
        landing.write.mode("append").parquet(path)
    return ingest.read_stream(spark, path, files_per_batch=LANDED_FILES)


@query
def stream_ingest_batches(spark, folder):
    """A batch for each landing: every different reading is stored, once, in any order."""
    path = scratch_path(spark, "stream-batches")
    stream = _landed(spark, folder, f"{path}/landed")
    for _ in range(2):  # the second call finds nothing new
        ingest.ingest(stream, f"{path}/lake", f"{path}/checkpoint").awaitTermination()
    return read_table(spark, f"{path}/lake", "timeseries").drop("date")


@query
def readings_compacted(spark, folder):
    """Three loads of the same days, joined day by day."""
    lake = scratch_path(spark, "compacted")
    rows = _readings(spark, folder)
    for load in ("one", "two", "three"):
        sink.append_readings(rows, lake, load)
    for _ in range(2):
        for city in CITIES:
            sink.compact_readings(spark, lake, city, FIRST, LAST)
    return read_table(spark, lake, "timeseries").drop("date")


# Stored hours ----------------------------------------------------------------


def _hours_of_loads(spark, folder) -> DataFrame:
    """Readings stored in three loads, of which every hour has a part, and their hours.

    The second load is stored twice, and the last one holds copies of the first.
    """
    lake = scratch_path(spark, "hours")
    rows = _readings(spark, folder)
    part = F.pmod(F.xxhash64("id", "timestamp", "available_bikes"), F.lit(3))
    loads = {"later": rows.where(part == 2), "one": rows.where(part == 0)}
    loads["again"] = loads["one"]
    loads["rest"] = rows.where(part <= 1)
    for load, of_load in loads.items():
        load = "one" if load == "again" else load
        sink.append_readings(of_load, lake, load)
        hour_sink.refresh_hours(spark, lake, load)
    return hour_sink.read_hours(spark, lake)


@query
def hours_store(spark, folder):
    """Of the stored hours: different readings, differences and the values at both ends."""
    hours = _hours_of_loads(spark, folder)
    return hours.select(
        "city_key", "id", "scope", "bucket", "total", "first_value", "last_value", "readings"
    )


@query
def daily_of_hours(spark, folder):
    """Daily transactions from the stored hours."""
    return hourly.daily_of_hours(_hours_of_loads(spark, folder))


@query
def hourly_profile_of_hours(spark, folder):
    """The hourly profile from the hours of a table without copies."""
    lake = scratch_path(spark, "profile-hours")
    sink.append_readings(_readings(spark, folder), lake, "all")
    hour_sink.refresh_hours(spark, lake, "all")
    profile = hourly.hourly_profile_of_hours(
        hour_sink.read_hours(spark, lake), _station(spark, folder), None, LAST, 30
    )
    return _round(profile, "mean")


@query
def stream_late_transactions(spark, folder):
    """Daily transactions of a stream in which readings are up to six days late."""
    path = scratch_path(spark, "stream-late")
    stream = _landed(spark, folder, f"{path}/landed")
    ingest.ingest(
        stream, f"{path}/lake", f"{path}/checkpoint", hours=True
    ).awaitTermination()
    return hourly.daily_of_hours(hour_sink.read_hours(spark, f"{path}/lake"))
