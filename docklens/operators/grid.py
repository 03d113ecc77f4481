"""Regular time grids: resampled means, back-fill, future labels, hour means.

Readings are averaged into bins first (partial aggregation), so every window
below runs over bins, whose number per station is bounded by the time range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docklens.functions.timecols import (
    bin_start,
    grid_seconds,
    hour_start,
    interval,
    step_seconds,
)


def bin_means(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    step: str,
    ts: str = "ts",
) -> DataFrame:
    """Mean of each value per key and left-closed bin; empty bins are absent."""
    return (
        df.withColumn("bin", bin_start(ts, step))
        .groupBy(*keys, F.col("bin").alias(ts))
        .agg(*[F.avg(v).alias(v) for v in values])
    )


def known_spans(
    bins: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    step: str,
    ts: str = "ts",
) -> DataFrame:
    """Each bin with the first empty bin it stands for as ``span_start``.

    An unknown value takes the next known one of its station.  The window is
    ordered backwards so that "next known" is a running ``last``.
    """
    backwards = Window.partitionBy(*keys).orderBy(F.col(ts).desc())
    running = backwards.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = F.lead(ts).over(backwards)
    return bins.select(
        *keys,
        ts,
        F.coalesce(earlier + interval(grid_seconds(step)), F.col(ts)).alias("span_start"),
        *[F.last(v, ignorenulls=True).over(running).alias(v) for v in values],
    )


def backfill_grid(
    bins: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    step: str,
    ts: str = "ts",
) -> DataFrame:
    """Dense grid from first to last bin; an empty bin takes the next one's values."""
    every = interval(grid_seconds(step))
    return known_spans(bins, keys, values, step, ts).select(
        *keys,
        F.explode(F.sequence("span_start", ts, every)).alias(ts),
        *values,
    )


def resample_mean(
    df: DataFrame,
    keys: Sequence[str] = ("city_key", "station_id"),
    values: Sequence[str] = ("nb_bikes", "nb_stands", "probability"),
    step: str = "10T",
    ts: str = "ts",
) -> DataFrame:
    """Bin means on a dense, back-filled grid."""
    return backfill_grid(bin_means(df, keys, values, step, ts), keys, values, step, ts)


def add_future(
    df: DataFrame,
    frequency: str,
    step: str | None = None,
    keys: Sequence[str] = ("city_key", "station_id"),
    value: str = "probability",
    ts: str = "ts",
) -> DataFrame:
    """Add ``future``: the value of the same station at ``ts + frequency``.

    Rows without a partner are dropped.  With ``step`` the input must be a dense
    grid of that step; the label is then a ``lead`` in the partitioning the grid
    already has.  Without it the input may have gaps and is joined to itself.
    """
    ahead = step_seconds(frequency)
    if step is None:
        label = df.select(
            *keys,
            (F.col(ts) - interval(ahead)).alias(ts),
            F.col(value).alias("future"),
        )
        return df.join(label, [*keys, ts])
    rows, rest = divmod(ahead, grid_seconds(step))
    if rest:  # between two grid points: no partner for any row
        return df.withColumn("future", F.lit(None).cast("double")).where(F.lit(False))
    order = Window.partitionBy(*keys).orderBy(ts)
    return (
        df.withColumns(
            {
                "future": F.lead(value, rows).over(order),
                "partner": F.lead(ts, rows).over(order),
            }
        )
        .where(F.col("partner").isNotNull())
        .drop("partner")
    )


def resample_future(
    df: DataFrame,
    frequency: str,
    keys: Sequence[str] = ("city_key", "station_id"),
    values: Sequence[str] = ("nb_bikes", "nb_stands", "probability"),
    value: str = "probability",
    step: str = "10T",
    ts: str = "ts",
) -> DataFrame:
    """``add_future`` of ``resample_mean``, with the label found before the grid is built.

    A bin's stretch of the grid is cut where its partners pass to another bin, and each
    piece takes that bin's value. Only bins are sorted, the grid itself never is. The
    partners of a bin's points lie in it or in one of the next ``frequency / step`` bins.
    """
    spans = known_spans(bin_means(df, keys, values, step, ts), keys, values, step, ts)
    rows, rest = divmod(step_seconds(frequency), grid_seconds(step))
    every, ahead = interval(grid_seconds(step)), interval(step_seconds(frequency))
    # the order of known_spans, so that one sort serves both
    next_bins = Window.partitionBy(*keys).orderBy(F.col(ts).desc()).rowsBetween(-rows, 0)
    partner = F.struct("span_start", F.col(ts).alias("last"), F.col(value).alias("future"))
    pieces = (
        spans.withColumn("partners", F.collect_list(partner).over(next_bins))
        .where(F.col(ts).isNotNull() & F.lit(rest == 0))  # between two points: no partner
        .select(*keys, ts, "span_start", *values, F.explode("partners").alias("partner"))
        .select(
            *keys,
            *values,
            F.col("partner.future").alias("future"),
            F.greatest("span_start", F.col("partner.span_start") - ahead).alias("low"),
            F.least(F.col(ts), F.col("partner.last") - ahead).alias("high"),
        )
        .where("low <= high")
    )
    return pieces.select(
        *keys, F.explode(F.sequence("low", "high", every)).alias(ts), *values, "future"
    )


def weekday_hour_means(
    bins: DataFrame, keys: Sequence[str], value: str, step: str, ts: str = "ts"
) -> DataFrame:
    """Mean per weekday hour of the back-filled grid, without building the grid.

    A bin stands for the empty bins before it.  That stretch is cut at full
    hours, and each piece counts with its number of bins.
    """
    size = grid_seconds(step)
    if 3600 % size:
        raise ValueError(f"{step!r} does not divide an hour")
    pieces = known_spans(bins, keys, [value], step, ts).select(
        *keys,
        ts,
        "span_start",
        value,
        F.explode(
            F.sequence(
                hour_start(F.col("span_start")), hour_start(F.col(ts)), interval(3600)
            )
        ).alias("piece"),
    )
    first = F.greatest("span_start", "piece")
    last = F.least(F.col(ts), F.col("piece") + interval(3600 - size))
    weight = (F.unix_timestamp(last) - F.unix_timestamp(first)) / size + 1
    return (
        pieces.where(F.weekday("piece") < 5)
        .where(F.col(value).isNotNull())
        .groupBy(*keys, F.hour("piece").alias("hour"))
        .agg((F.sum(F.col(value) * weight) / F.sum(weight)).alias("value"))
    )
