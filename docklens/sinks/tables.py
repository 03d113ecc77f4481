"""Writing the canonical tables as partitioned Parquet.

Writes of a day, a run or a city replace their own partitions, so a repeated
job leaves the same table.  The ``rebalance`` hint lets Spark even out the
partitions to write: a day that holds a third of all rows is split over tasks
and small days share a file.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docklens import schemas
from docklens.config import as_date
from docklens.functions.timecols import step_text
from docklens.session import cut_lineage, delete_folder
from docklens.sources.tables import stored

# the writer's own format would cut times to milliseconds
CSV_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"
LOAD = "load"
COMPACTED = "compacted"
POLL_FORMAT = "yyyyMMdd'T'HHmmss.SSSSSS"
# tasks for each partition of a stream batch; callers may pass another number
WRITERS = 16
PREDICTION_KEY = ("city_key", "timestamp", "frequency", "station_id")


def _target(lake: str, name: str) -> str:
    return f"{lake.rstrip('/')}/{name}"


def _evened(df: DataFrame, partition: Sequence[str], writers: int = WRITERS) -> DataFrame:
    """Rows of one partition in few tasks, a large partition in several.

    The batches of a stream run without adaptive execution, where the hint would
    send a whole day to one task; there each partition gets ``writers`` tasks.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return df.hint("rebalance", *partition)
    return df.repartition(*partition, F.pmod(F.xxhash64(*df.columns), F.lit(writers)))


def _write(
    df: DataFrame,
    path: str,
    partition: Sequence[str],
    order: Sequence[str] = (),
    writers: int = WRITERS,
) -> None:
    spread = _evened(df, partition, writers)
    if order:  # close keys in one row group make its statistics selective
        spread = spread.sortWithinPartitions(*partition, *order)
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *partition
    ).parquet(path)


def _canonical(df: DataFrame, name: str, *extra: str) -> DataFrame:
    schema = getattr(schemas, name.upper())
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema], *extra)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when two rows share a key."""
    repeated = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1)
    if not repeated.isEmpty():
        raise ValueError(f"more than one row per {tuple(keys)}")


def write_snapshots(readings: DataFrame, lake: str, poll: str) -> None:
    """Landed snapshots as they were polled, by city and day, under the name ``poll``.

    Storing a poll again replaces it.
    """
    dated = readings.withColumns({"date": F.to_date("timestamp"), LOAD: F.lit(poll)})
    _write(dated, _target(lake, "snapshot"), ["city_key", "date", LOAD])


def write_snapshot_csv(readings: DataFrame, path: str) -> None:
    """Snapshot files for exchange, written once per target."""
    readings.select(
        "city_key",
        F.to_date("timestamp").alias("date"),
        *[f.name for f in schemas.SNAPSHOT_CSV],
    ).write.partitionBy("city_key", "date").mode("errorifexists").option(
        "timestampNTZFormat", CSV_TIME
    ).csv(path, header=True)


READINGS_PARTITION = ("city_key", "date", LOAD)


def append_readings(
    readings: DataFrame, lake: str, load: str, writers: int = WRITERS
) -> None:
    """Add readings under the name ``load``.

    A load owns its partitions: storing it again replaces it, other loads of
    the same days stay.
    """
    rows = _canonical(readings, "timeseries").withColumns(
        {"date": F.to_date("timestamp"), LOAD: F.lit(load)}
    )
    order = ["id", "timestamp"]
    _write(rows, _target(lake, "timeseries"), READINGS_PARTITION, order, writers)


def stored_readings(spark: SparkSession, lake: str) -> DataFrame | None:
    """The readings table with its days and loads, or ``None`` before the first load."""
    schema = schemas.TIMESERIES.fields + schemas.PARTITIONS["timeseries"].fields
    return stored(spark, _target(lake, "timeseries"), T.StructType(schema))


def compact_readings(
    spark: SparkSession, lake: str, city: str, start: date | str, stop: date | str
) -> None:
    """Rewrite the loads of a city's days ``[start, stop]`` as one load without copies.

    The one load is written first and the others are removed after it, so a job
    that dies in between loses nothing; until it is repeated, some readings are
    stored twice.  No load of these days may be written meanwhile.
    """
    held = stored_readings(spark, lake)
    if held is None:
        return
    days = held.where(
        (F.col("city_key") == city)
        & F.col("date").between(F.lit(as_date(start)), F.lit(as_date(stop)))
    )
    loads = [tuple(r) for r in days.select("date", LOAD).distinct().collect()]
    if all(load == COMPACTED for _, load in loads):
        return
    # read in full before the write replaces a former compact load
    rows = cut_lineage(days.select(*schemas.TIMESERIES.names).distinct())
    append_readings(rows, lake, COMPACTED)
    for day, load in loads:
        if load != COMPACTED:
            folder = f"city_key={city}/date={day}/{LOAD}={load}"
            delete_folder(spark, f"{_target(lake, 'timeseries')}/{folder}")


def write_daily(daily: DataFrame, lake: str) -> None:
    """Replace the days present in ``daily``."""
    rows = _canonical(daily, "daily_transaction")
    _write(rows, _target(lake, "daily_transaction"), ["city_key", "date"], ["id"])


def write_clusters(labels: DataFrame, centroids: DataFrame, lake: str) -> None:
    """Replace the runs present in ``labels`` and ``centroids``."""
    run = ["city_key", "start", "stop"]
    for df, name, key in (
        (labels, "clustering", "station_id"),
        (centroids, "centroid", "cluster_id"),
    ):
        rows = _canonical(df, name)
        assert_unique(rows, [*run, key])
        _write(rows, _target(lake, name), run)


def write_geo_clusters(labels: DataFrame, centroids: DataFrame, lake: str) -> None:
    """Replace the cities present in ``labels`` and ``centroids``."""
    for df, name, key in (
        (labels, "geo_clustering", "station_id"),
        (centroids, "geo_centroid", "cluster_id"),
    ):
        rows = _canonical(df, name)
        assert_unique(rows, ["city_key", key])
        _write(rows, _target(lake, name), ["city_key"])


def write_rejects(rejects: DataFrame, lake: str, name: str, **run) -> None:
    """Replace what a run (given as the values of its folders) left out."""
    missing = {k: F.lit(v) for k, v in run.items() if k not in rejects.columns}
    rejects = rejects.withColumns(missing) if missing else rejects
    folder = "/".join(f"{key}={value}" for key, value in run.items())
    delete_folder(rejects.sparkSession, f"{_target(lake, name)}/{folder}")
    _write(_canonical(rejects, name), _target(lake, name), list(run))


def write_stations(station: DataFrame, lake: str) -> None:
    """Replace the station table of the cities present in ``station``."""
    _write(_canonical(station, "station"), _target(lake, "station"), ["city_key"])


PREDICTION_PARTITION = ("city_key", "frequency", "date")


def write_predictions(prediction: DataFrame, lake: str, frequency: str | None = None) -> None:
    """Insert predictions; a row with the same key replaces the stored one.

    Copies are one row; two different rows for one key are refused.  Only touched
    days are read, as literals in the partition filter, and rewritten.  What is kept of them
    is written to the shared folder before the table is replaced.
    """
    if frequency is not None:
        prediction = prediction.withColumn("frequency", F.lit(step_text(frequency)))
    rows = _canonical(prediction, "prediction").withColumn("date", F.to_date("timestamp"))
    rows = cut_lineage(rows.distinct())  # used several times below
    assert_unique(rows, PREDICTION_KEY)
    path = _target(lake, "prediction")
    old = stored(rows.sparkSession, path, rows.schema)
    if old is not None:
        rows = cut_lineage(rows.unionByName(kept_predictions(old, rows)))
    _write(rows, path, PREDICTION_PARTITION, ["station_id", "timestamp"])


def kept_predictions(old: DataFrame, rows: DataFrame) -> DataFrame:
    """Stored rows of the touched days whose key is not in ``rows``."""
    touched = rows.agg(
        F.collect_set("date").alias("days"),  # days, not rows: as many as folders
        F.collect_set("city_key").alias("cities"),
        F.collect_set("frequency").alias("frequencies"),
    ).first()
    near = old.where(
        F.col("date").isin(sorted(touched.days))
        & F.col("city_key").isin(touched.cities)
        & F.col("frequency").isin(touched.frequencies)
    )
    days = rows.select(*PREDICTION_PARTITION).distinct()
    return near.join(days, list(PREDICTION_PARTITION), "left_semi").join(
        rows, list(PREDICTION_KEY), "left_anti"
    )


def write_weather(rows: DataFrame, lake: str, kind: str) -> None:
    """Current or forecast weather by city (column ``city_key``) and time of the poll.

    Storing a poll again replaces it.
    """
    if kind not in ("current", "forecast"):
        raise ValueError("kind is 'current' or 'forecast'")
    polled = "date" if kind == "current" else "forecast_at"
    text = F.date_format(polled, POLL_FORMAT)
    dated = _canonical(rows, f"weather_{kind}", "city_key").withColumn("polled", text)
    _write(dated, _target(lake, f"weather_{kind}"), ["city_key", "polled"])
