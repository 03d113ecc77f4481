"""Newest rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def newest(df: DataFrame, keys: Sequence[str], ts: str = "timestamp") -> DataFrame:
    """All rows that carry the newest ``ts`` of their key (ties are kept).

    The maximum is a hash aggregation with a partial step, so no key is ever
    sorted or gathered; ties come back through a semi join, whose small side
    Spark broadcasts when its measured size allows.
    """
    last = df.groupBy(*keys).agg(F.max(ts).alias(ts))
    return df.join(last, [*keys, ts], "left_semi")


def newest_once(df: DataFrame, keys: Sequence[str], ts: str = "timestamp") -> DataFrame:
    """The different rows of ``newest``, reading ``df`` only once.

    Copies collapse first (partially, inside each task); what is left of a key
    are its different rows, of which the window keeps those of the newest time,
    and Spark cuts each task's rows to them before it shuffles.
    """
    rank = F.rank().over(Window.partitionBy(*keys).orderBy(F.desc(ts)))
    return df.distinct().withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def newest_run(df: DataFrame, keys: Sequence[str] = ("city_key",)) -> DataFrame:
    """Rows of the training run with the latest ``stop`` per city, read only once.

    Spark cuts each task's rows to those of its newest run before the shuffle; a
    city's newest run holds one row for each of its stations or clusters.
    """
    rank = F.rank().over(Window.partitionBy(*keys).orderBy(F.desc("stop")))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def latest_date(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """One row with the newest time of a result, null when it is empty."""
    return df.agg(F.max(ts).alias("date"))
