"""Streaming ingest of readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from docklens import schemas
from docklens.functions.timecols import event_time
from docklens.sinks.hours import refresh_hours
from docklens.sinks.tables import LOAD, WRITERS, append_readings, stored_readings

DELAY = "1 hour"
EVENT_TIME = "event_time"
HELD = "_held"


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = schemas.TIMESERIES,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Parquet files as they land in ``path`` (a folder or a glob)."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def watermarked(stream: DataFrame, delay: str = DELAY) -> DataFrame:
    """The stream with a watermark; readings later than ``delay`` are left out.

    For running figures, whose state must end.  Storing readings needs no
    watermark (see ``ingest``).
    """
    return stream.withColumn(EVENT_TIME, event_time("timestamp")).withWatermark(
        EVENT_TIME, delay
    )


def new_rows(batch: DataFrame, lake: str, load: str) -> DataFrame:
    """The different readings of ``batch`` that no other load holds.

    Rows are compared whole, nulls included, so two different readings of a
    station at one time both stay.  Only the batch's own cities and days are looked up,
    as literals of the scan: one reading with a wrong clock adds one day, not a span.
    """
    columns = schemas.TIMESERIES.names
    held = stored_readings(batch.sparkSession, lake)
    if held is None:
        return batch.select(*columns).distinct()
    # a row for each city and day of the batch
    found = batch.select("city_key", F.to_date("timestamp").alias("date")).distinct().collect()
    of_batch = _is_in("city_key", {r.city_key for r in found}) & _is_in(
        "date", {r.date for r in found}
    )
    held = held.where(of_batch & (F.col(LOAD) != load)).select(*columns, F.lit(True).alias(HELD))
    # equal rows of both sides meet in one shuffle, nulls among equal ones
    both = batch.select(*columns, F.lit(False).alias(HELD)).union(held)
    found_held = both.groupBy(*columns).agg(F.max(HELD).alias(HELD))
    return found_held.where(~F.col(HELD)).select(*columns)


def _is_in(column: str, values: set) -> Column:
    """Whether the column holds one of the values, null among them."""
    known = F.col(column).isin(sorted(values - {None}))
    return known | F.col(column).isNull() if None in values else known


def ingest(
    stream: DataFrame,
    lake: str,
    checkpoint: str,
    name: str = "stream",
    writers: int = WRITERS,
    hours: bool = False,
) -> StreamingQuery:
    """Append every new reading to the stored table; ends when caught up.

    A reading is stored once, however often the feed repeats it and however late
    it comes.  Each batch is a load of its own: a batch that is repeated after a
    failure replaces itself, and batch jobs may write to the same table.
    ``name`` tells the streams into one table apart; ``writers`` is the number
    of tasks for each city and day of a batch.

    With ``hours`` each batch also stores the hours it touches anew (``sinks.hours``).
    Daily transactions and profiles of the stored hours are then those of all
    readings so far, late ones included, without state and without a watermark.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        load = f"{name}-{batch_id}"
        batch.persist()
        try:
            append_readings(new_rows(batch, lake, load), lake, load, writers)
            if hours:
                refresh_hours(batch.sparkSession, lake, load, writers)
        finally:
            batch.unpersist()

    return (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
        .trigger(availableNow=True)
        .start()
    )
