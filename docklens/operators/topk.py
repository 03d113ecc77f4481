"""Top-k, tail and id filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Up to this many ids go into the plan as literals, more as a joined list.
LITERAL_IDS = 1_000


def only_ids(df: DataFrame, ids: Sequence[str] | None, key: str = "id") -> DataFrame:
    """Rows whose ``key`` is in ``ids`` (compared as text); ``None`` keeps all."""
    if ids is None:
        return df
    if len(ids) <= LITERAL_IDS:
        return df.where(F.col(key).isin(list(ids)))
    wanted = df.sparkSession.createDataFrame([(i,) for i in ids], f"{key} string")
    # a join by name puts the key first
    return df.join(wanted, key, "left_semi").select(*df.columns)


def first_rows(df: DataFrame, order: Sequence[str | Column], limit: int | None) -> DataFrame:
    """Rows in ``order``; with ``limit`` Spark keeps a bounded heap per task."""
    ordered = df.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)


def ranked_top(
    df: DataFrame,
    order: Sequence[str | Column],
    limit: int,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """The first ``limit`` rows, overall or per ``keys``, with their 1-based ``rank``.

    Overall, the limit comes first, so the window without a partition holds
    ``limit`` rows at most.  Per key, Spark cuts each task's rows to ``limit``
    before they are shuffled.
    """
    if keys is not None:
        number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return df.withColumn("rank", number).where(F.col("rank") <= limit)
    top = df.orderBy(*order).limit(limit)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def last_rows(
    df: DataFrame,
    order: Sequence[str],
    count: int,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """The last ``count`` rows in ``order``, overall or per ``keys``; 0 keeps all."""
    if count == 0:
        return df
    backwards = [F.col(c).desc_nulls_first() for c in order]
    if keys is None:
        return df.orderBy(*backwards).limit(count)
    # Spark cuts each task's rows to ``count`` before they are shuffled
    numbered = F.row_number().over(Window.partitionBy(*keys).orderBy(*backwards))
    return df.withColumn("rn", numbered).where(F.col("rn") <= count).drop("rn")
