"""Nesting of series into arrays."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docklens.functions.timecols import seconds_since, step_seconds

# The time that one row of a nested series covers, unless the caller names another.
STRETCH = "31D"


def known(columns: Sequence[str]) -> Column:
    """True where no column is null.

    Written out before a self-join, because the join would add this filter to
    its sides one by one, and sides that differ do not share their shuffle.
    """
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])


def nest(
    df: DataFrame, keys: Sequence[str], order: str, columns: dict[str, str]
) -> DataFrame:
    """One row per key with parallel arrays, in the order of ``order``.

    ``columns`` maps the array's name to the source column.  Groups must be
    small by construction; ``nest_series`` handles the ones that are not.
    """
    fields = list(dict.fromkeys(columns.values()))
    rows = F.array_sort(
        F.collect_list(F.struct(F.col(order).alias("_order"), *fields))
    )
    return (
        df.groupBy(*keys)
        .agg(rows.alias("_rows"))
        .select(*keys, *[F.col(f"_rows.{c}").alias(n) for n, c in columns.items()])
    )


def _repeat(column: str):
    return lambda row: F.array_repeat(row[column], row["_times"])


def nest_series(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    columns: dict[str, str],
    start: datetime,
    stretch: str = STRETCH,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Parallel arrays per key and ``piece``: the stretches of time from ``start`` on.

    A series that ends within one stretch is one row with ``piece`` 0; a longer
    one goes on in the next pieces, whatever the number of its rows.  Copies are
    counted before the shuffle, travel as one row and are repeated in the arrays.
    """
    ties = [*ties, *[c for c in columns.values() if c not in (ts, *ties)]]
    seconds = seconds_since(ts, start)
    placed = (
        df.groupBy(*keys, ts, *ties)
        .agg(F.count(F.lit(1)).alias("_times"))
        .where(known([*keys, ts]))
        .withColumn("piece", F.floor(seconds / step_seconds(stretch)).cast("int"))
    )
    times = F.col("_times").cast("int").alias("_times")
    rows = F.array_sort(F.collect_list(F.struct(ts, *ties, times)))
    nested = placed.groupBy(*keys, "piece").agg(rows.alias("_rows"))
    repeated = [
        F.flatten(F.transform("_rows", _repeat(column))).alias(name)
        for name, column in columns.items()
    ]
    return nested.select(*keys, "piece", *repeated)
