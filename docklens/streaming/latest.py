"""Latest reading per station, kept up to date by a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from docklens import schemas
from docklens.operators.latest import newest_once
from docklens.sources.tables import stored

KEYS = ["city_key", "id"]
SLOTS = 2
_VERSIONED = T.StructType([*schemas.TIMESERIES, T.StructField("batch_id", T.LongType())])


def run_latest(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Fold each batch into the table of newest readings; ends when caught up.

    Two folders take turns: batch N reads the folder of batch N-1 and replaces
    the other one.  A batch that fails half way finds its input untouched when
    it is repeated.
    """

    def slot(batch_id: int) -> str:
        return f"{path}/slot={batch_id % SLOTS}"

    def fold(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.select(*schemas.TIMESERIES.names)
        if batch_id > 0:
            before = stored(spark, slot(batch_id - 1), schemas.TIMESERIES)
            if before is not None:
                rows = before.unionByName(rows)
        newest_once(rows, KEYS).withColumn("batch_id", F.lit(batch_id)).write.mode(
            "overwrite"
        ).parquet(slot(batch_id))

    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(fold)
        .trigger(availableNow=True)
        .start()
    )


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest reading of every station as of the last batch."""
    rows = spark.read.schema(_VERSIONED).parquet(path)
    last = rows.agg(F.max("batch_id")).scalar()
    return rows.where(F.col("batch_id") == last).select(*schemas.TIMESERIES.names)
