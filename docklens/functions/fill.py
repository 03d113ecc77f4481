"""Scalar formulas on bike and stand counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fill_probability(bikes: str, stands: str) -> Column:
    """Share of docks that hold a bike; null for a station without docks."""
    bikes_d = F.col(bikes).cast("double")
    return F.try_divide(bikes_d, bikes_d + F.col(stands).cast("double"))


def has_docks(bikes: str, stands: str) -> Column:
    return (F.col(bikes) > 0) | (F.col(stands) > 0)


def recode_status(raw: Column, open_token: str) -> Column:
    """``open`` for the city's open token, ``closed`` for all else and null."""
    return F.when(raw == open_token, "open").otherwise("closed")


def blank_to_null(raw: Column) -> Column:
    return F.nullif(F.trim(raw), F.lit(""))
