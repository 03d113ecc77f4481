"""Raw feed files to canonical readings, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from docklens.config import CITIES, check_city
from docklens.schemas import TIMESERIES
from docklens.sources import feeds
from docklens.streaming.ingest import read_stream

_FILE = "path string, modificationTime timestamp, length long, content binary"


def land_feed(
    spark: SparkSession,
    path: str,
    city: str,
    landed: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Turn new snapshot files of a city into filled readings; ends when caught up.

    The stream is one of file names; each batch reads its files like any other, so a
    damaged document is the same in both. Missing counts are looked up inside their
    snapshot, and a snapshot arrives whole. A batch owns its folders and replaces them.
    Rows without a count go to ``rejects``, what could not be read to ``damaged``.
    """
    config = CITIES[check_city(city)]
    names = (
        spark.readStream.format("binaryFile")
        .schema(_FILE)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
        .select("path")
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        paths = [row["path"] for row in batch.collect()]
        if not paths:
            return
        parsed = feeds.PARSERS[config.city_key](spark, paths)
        # the fill reads the readings several times, the documents are parsed once for it
        readings = feeds.canonical_readings(parsed.rows, config).persist()
        try:
            filled = feeds.fill_counts(readings)._replace(damaged=parsed.damaged)
            for name, rows in filled._asdict().items():
                folder = f"{landed}/{name}/batch_id={batch_id}"
                kept = rows if name == "damaged" else rows.select(*TIMESERIES.names)
                kept.write.mode("overwrite").parquet(folder)
        finally:
            readings.unpersist()

    return (
        names.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(store)
        .trigger(availableNow=True)
        .start()
    )


def read_landed(spark: SparkSession, landed: str, **options) -> DataFrame:
    """The readings landed by ``land_feed``, as a stream."""
    return read_stream(spark, f"{landed}/readings/*", **options)
