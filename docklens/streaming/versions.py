"""Stored results of update-mode streams.

A stream in update mode emits a row again whenever it changes.  Each batch
owns one folder and replaces it, so a repeated batch changes nothing; readers
take the newest version of every key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docklens.session import cut_lineage, delete_folder


def store_changes(
    changes: DataFrame, path: str, checkpoint: str, partition: Sequence[str] = ()
) -> StreamingQuery:
    """Write the changed rows of each batch below ``path``; ends when caught up.

    ``partition`` columns become folders, so that readers of a few days open
    only those.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}/batch_id={batch_id}"
        batch.write.mode("overwrite").partitionBy(*partition).parquet(folder)

    return (
        changes.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
        .trigger(availableNow=True)
        .start()
    )


def compact_changes(spark: SparkSession, path: str, keys: Sequence[str]) -> None:
    """Fold all batches but the last into the one before it.

    Run it while the stream is not running.  The newest versions are read in full
    before they replace that batch, and the batches folded into it are removed
    after it; readers take the newest version of a key, so a call that dies in
    between changes no result once it is repeated.
    """
    versions = spark.read.parquet(path)
    batches = sorted(r[0] for r in versions.select("batch_id").distinct().collect())
    if len(batches) < 3:
        return
    last = batches[-2]
    rows = cut_lineage(_newest(versions.where(F.col("batch_id") <= last), keys))
    partition = [c for c in ("date",) if c in rows.columns]
    target = f"{path}/batch_id={last}"
    rows.write.mode("overwrite").partitionBy(*partition).parquet(target)
    for batch in batches[:-2]:
        delete_folder(spark, f"{path}/batch_id={batch}")


def _newest(versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    values = [c for c in versions.columns if c not in (*keys, "batch_id")]
    return versions.groupBy(*keys).agg(*[F.max_by(v, "batch_id").alias(v) for v in values])


def read_changes(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest version of every key as of the last batch."""
    return _newest(spark.read.parquet(path), keys)
