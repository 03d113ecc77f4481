"""Reading the stored canonical tables and the CSV outputs."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docklens import schemas
from docklens.config import as_date, as_datetime, city_list


def time_slice(
    df: DataFrame,
    start: datetime | date | str | None = None,
    stop: datetime | date | str | None = None,
    city: str | None = None,
    ts: str = "timestamp",
) -> DataFrame:
    """Half-open slice ``[start, stop)``.

    Stored tables are partitioned by ``city_key`` and ``date``.  Spark does not
    derive a date filter from a time filter, so both are given.
    """
    if city is not None:
        df = df.where(F.col("city_key").isin(city_list(city)))
    dated = "date" in df.columns and ts != "date"
    if start is not None:
        start = as_datetime(start)
        df = df.where(F.col(ts) >= F.lit(start.isoformat()).cast("timestamp_ntz"))
        if dated:
            df = df.where(F.col("date") >= F.lit(start.date()))
    if stop is not None:
        stop = as_datetime(stop)
        df = df.where(F.col(ts) < F.lit(stop.isoformat()).cast("timestamp_ntz"))
        if dated:
            last = (stop - timedelta(microseconds=1)).date()
            df = df.where(F.col("date") <= F.lit(last))
    return df


def date_range(
    df: DataFrame,
    start: date | str,
    stop: date | str,
    city: str | None = None,
    column: str = "date",
) -> DataFrame:
    """Closed date range ``[start, stop]``."""
    if city is not None:
        df = df.where(F.col("city_key").isin(city_list(city)))
    return df.where(F.col(column).between(F.lit(as_date(start)), F.lit(as_date(stop))))


def read_table(spark: SparkSession, lake: str, name: str) -> DataFrame:
    """A stored table with the column types of its canonical schema.

    Partition columns beside the schema (``date``) come last.  A table that was
    not written yet is empty.
    """
    own = getattr(schemas, name.upper())
    beside = schemas.PARTITIONS.get(name, T.StructType())
    whole = T.StructType(own.fields + beside.fields)
    df = stored(spark, f"{lake.rstrip('/')}/{name}", whole)
    if df is None:
        df = spark.createDataFrame([], whole)
    return df.select(*own.names, *[c for c in beside.names if c not in schemas.WRITE_NAMES])


def stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The table at ``path``, or ``None`` when nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_transactions_csv(spark: SparkSession, path: str, day: date | str) -> DataFrame:
    """A day's roll-up file with its date as a column."""
    return (
        spark.read.schema(schemas.TRANSACTIONS_CSV)
        .option("header", "true")
        .csv(path)
        .withColumn("date", F.lit(as_date(day)))
    )


def read_predictions_csv(spark: SparkSession, path: str, frequency: str) -> DataFrame:
    """A prediction file with its horizon as the second column."""
    df = spark.read.schema(schemas.PREDICTIONS_CSV).option("header", "true").csv(path)
    rest = [c for c in df.columns if c != "timestamp"]
    return df.select("timestamp", F.lit(frequency).alias("frequency"), *rest)
