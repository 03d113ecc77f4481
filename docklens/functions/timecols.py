"""Steps, time bins and calendar columns, all on zone-less timestamps."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_SECONDS = 86_400

# Accepted unit letters of a step text ("T" and "m" are minutes).
_UNIT_SECONDS = {
    "s": 1,
    "S": 1,
    "m": 60,
    "min": 60,
    "T": 60,
    "h": 3600,
    "H": 3600,
    "d": DAY_SECONDS,
    "D": DAY_SECONDS,
}


def step_seconds(step: str) -> int:
    """Seconds of a step text such as ``30T``, ``1H`` or ``10m``."""
    match = re.fullmatch(r"(\d*)\s*([A-Za-z]+)", step.strip())
    if match is None or match[2] not in _UNIT_SECONDS:
        raise ValueError(f"cannot read step {step!r}")
    seconds = int(match[1] or 1) * _UNIT_SECONDS[match[2]]
    if seconds == 0:
        raise ValueError("a step must be longer than zero")
    return seconds


def step_text(step: str) -> str:
    """One spelling per horizon, so that ``60T`` and ``1H`` are the same key."""
    seconds = step_seconds(step)
    for unit, size in (("H", 3600), ("T", 60)):
        if seconds % size == 0:
            return f"{seconds // size}{unit}"
    return f"{seconds}S"


def grid_seconds(step: str) -> int:
    """Like ``step_seconds`` for bins, which start at midnight of every day."""
    seconds = step_seconds(step)
    if DAY_SECONDS % seconds:
        raise ValueError(f"{step!r} does not divide a day")
    return seconds


def interval(seconds: int) -> Column:
    return F.expr(f"INTERVAL '{seconds}' SECOND")


def seconds_since(ts: str, start: datetime) -> Column:
    """Whole seconds from ``start`` to ``ts``, both without a zone."""
    days = F.datediff(ts, F.lit(start.date()))
    of_day = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    before = start.hour * 3600 + start.minute * 60 + start.second
    return days.cast("bigint") * DAY_SECONDS + of_day - before


def bin_start(ts: str, step: str) -> Column:
    """Start of the left-closed bin of ``step`` that holds ``ts``."""
    return F.window(ts, f"{grid_seconds(step)} seconds").start


def hour_start(ts: Column) -> Column:
    """Full hour of a bin start; plain subtraction keeps the zone-less type."""
    return ts - F.make_dt_interval(mins=F.minute(ts), secs=F.second(ts))


def calendar(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Weekday (Monday = 0), hour and minute of ``ts`` as columns."""
    return df.withColumns(
        {"day": F.weekday(ts), "hour": F.hour(ts), "minute": F.minute(ts)}
    )


def from_epoch(epoch: Column) -> Column:
    """Epoch seconds as a zone-less time that reads like UTC."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        secs=epoch
    )


def epoch_to_local(epoch: Column, zone: str) -> Column:
    """Epoch seconds as the wall-clock time of ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), from_epoch(epoch))


def event_time(ts: str) -> Column:
    """``ts`` to the second as the zoned type that watermarks ask for.

    The zone-less time is read as UTC whatever the session's zone is;
    ``from_epoch(unix_timestamp(..))`` is the way back.
    """
    return F.timestamp_seconds(F.unix_timestamp(ts))
