"""Maps the star-schema test tables to the canonical bike-sharing tables.

One customer is one station, one event is one reading.  Cluster runs and
predictions are deterministic stand-ins, so that queries over them have exact
expected results without a fitted model.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docklens.functions.timecols import interval
from docklens.plans.transactions import daily_transactions
from docklens.schemas import HOUR_COLUMNS
from docklens.streaming.ingest import read_stream

DOCKS = 40
RUNS = ((date(2024, 1, 1), date(2024, 1, 15)), (date(2024, 1, 1), date(2024, 1, 31)))


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _city_of(nation: str) -> Column:
    return F.when(F.col(nation) % 2 == 0, "lyon").otherwise("bordeaux")


def _bikes() -> Column:
    return F.floor("value").cast("int") % (DOCKS + 1)


def station(spark: SparkSession, folder: str) -> DataFrame:
    nation = _table(spark, folder, "nation").select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    return (
        _table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            _city_of("c_nationkey").alias("city_key"),
            key.cast("string").alias("id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("address"),
            F.col("n_name").alias("city"),
            F.lit(DOCKS).alias("nb_stations"),
            F.round(4.7 + 0.005 * (key % 40), 6).alias("x"),
            F.round(45.7 + 0.005 * F.floor(key / 40), 6).alias("y"),
        )
    )


EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def with_city(events: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Events (batch or stream) with the city of their station."""
    owner = _table(spark, folder, "customer").select(
        "c_custkey", _city_of("c_nationkey").alias("city_key")
    )
    return events.join(owner, F.col("user_id") == F.col("c_custkey")).drop("c_custkey")


def as_readings(events: DataFrame, *keep: str) -> DataFrame:
    return events.select(
        "city_key",
        F.col("user_id").cast("string").alias("id"),
        F.col("ts").alias("timestamp"),
        (DOCKS - _bikes()).alias("available_stands"),
        _bikes().alias("available_bikes"),
        F.when(F.col("event_type") == "error", "closed").otherwise("open").alias("status"),
        *keep,
    )


def events(spark: SparkSession, folder: str) -> DataFrame:
    return with_city(_table(spark, folder, "events"), spark, folder)


def timeseries(spark: SparkSession, folder: str) -> DataFrame:
    return as_readings(events(spark, folder))


def timeseries_stream(spark: SparkSession, folder: str) -> DataFrame:
    # a glob matches one file as well as a folder of files
    landed = read_stream(spark, f"{folder}/events*.parquet", EVENTS)
    return as_readings(with_city(landed, spark, folder))


def daily_transaction(spark: SparkSession, folder: str) -> DataFrame:
    return daily_transactions(timeseries(spark, folder))


def prediction(spark: SparkSession, folder: str) -> DataFrame:
    """Every reading, one hour later, as if it had been forecast."""
    return timeseries(spark, folder).select(
        "city_key",
        (F.col("timestamp") + interval(3600)).alias("timestamp"),
        F.lit("1H").alias("frequency"),
        F.col("id").alias("station_id"),
        (F.col("available_bikes") / float(DOCKS)).alias("availability"),
        F.col("available_bikes").alias("nb_bikes"),
        F.col("available_stands").alias("nb_stands"),
    )


def _runs() -> Column:
    return F.inline(
        F.array(
            *[
                F.struct(F.lit(start).alias("start"), F.lit(stop).alias("stop"))
                for start, stop in RUNS
            ]
        )
    )


def _group_of(id_column: str) -> Column:
    return (F.col(id_column).cast("int") % 4).cast("string")


def clustering(spark: SparkSession, folder: str) -> DataFrame:
    return (
        station(spark, folder)
        .select("city_key", F.col("id").alias("station_id"), _runs())
        .withColumn("cluster_id", _group_of("station_id"))
    )


def centroid(spark: SparkSession, folder: str) -> DataFrame:
    """Mean hourly fill of each stand-in group over the days of each run."""
    hours = (
        timeseries(spark, folder)
        .select("city_key", "timestamp", "available_bikes", _group_of("id").alias("cluster_id"))
        .groupBy("city_key", "cluster_id", F.to_date("timestamp").alias("day"),
                 F.hour("timestamp").alias("hour"))
        .agg(F.sum("available_bikes").alias("bikes"), F.count("available_bikes").alias("n"))
        .select("*", _runs())
        .where((F.col("day") >= F.col("start")) & (F.col("day") < F.col("stop")))
    )
    total = {
        name: F.try_divide(
            F.sum(F.when(F.col("hour") == hour, F.col("bikes"))).cast("double"),
            F.sum(F.when(F.col("hour") == hour, F.col("n"))) * float(DOCKS),
        ).alias(name)
        for hour, name in enumerate(HOUR_COLUMNS)
    }
    return hours.groupBy("city_key", "cluster_id", "start", "stop").agg(*total.values())
