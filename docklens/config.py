"""City settings and the checks made on arguments before a plan is built."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from typing import NamedTuple


@dataclass(frozen=True)
class CityConfig:
    """How one city's raw feeds name their columns."""

    city_key: str
    country: str
    srid: int
    open_token: str
    # station extract: raw names of id, name, address, city, nb_stations
    station_columns: tuple[str, str, str, str, str]
    # availability feed: raw names of id, timestamp, stands, bikes, status
    reading_columns: tuple[str, str, str, str, str]


# The raw column names, coordinate systems and open tokens are
# those the two city feeds publish.
LYON = CityConfig(
    city_key="lyon",
    country="france",
    srid=4326,
    open_token="OPEN",
    station_columns=("idstation", "nom", "adresse1", "commune", "nbbornette"),
    reading_columns=(
        "number",
        "last_update",
        "available_bike_stands",
        "available_bikes",
        "status",
    ),
)
BORDEAUX = CityConfig(
    city_key="bordeaux",
    country="france",
    srid=2154,
    open_token="CONNECTEE",
    station_columns=("numstat", "nom", "adresse", "commune", "nbsuppor"),
    reading_columns=("ident", "heure", "nbplaces", "nbvelos", "etat"),
)

CITIES: dict[str, CityConfig] = {c.city_key: c for c in (LYON, BORDEAUX)}

ORDERINGS = ("station", "value")


class TimeWindow(NamedTuple):
    start: date
    stop: date
    order_reference_date: date


def time_window(day: date | str, window: int = 0, backward: bool = True) -> TimeWindow:
    """The closed date range of ``window`` days before (or after) ``day``."""
    day = as_date(day)
    span = timedelta(days=window)
    if backward:
        return TimeWindow(day - span, day, day)
    return TimeWindow(day, day + span, day)


def check_city(city: str) -> str:
    if city not in CITIES:
        raise ValueError(f"unknown city {city!r}, expected one of {sorted(CITIES)}")
    return city


def city_list(city: str | Iterable[str] | None) -> list[str]:
    """``None`` stands for every configured city."""
    if city is None:
        return list(CITIES)
    names = [city] if isinstance(city, str) else list(city)
    return [check_city(name) for name in names]


def check_ordering(order_by: str) -> str:
    if order_by not in ORDERINGS:
        raise ValueError(f"order_by must be one of {ORDERINGS}, not {order_by!r}")
    return order_by


def check_count(name: str, value: int | None) -> int | None:
    if value is not None and value < 0:
        raise ValueError(f"{name} must not be negative, got {value}")
    return value


def as_date(value: date | str) -> date:
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    return date.fromisoformat(value)


def as_datetime(value: datetime | date | str) -> datetime:
    """ISO text, a date (its midnight) or a naive datetime."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            raise ValueError("times are local and without a zone")
        return value
    return datetime(value.year, value.month, value.day)


def as_ids(ids: str | Iterable[object]) -> list[str]:
    """Station ids as text; a comma-separated text is split."""
    if isinstance(ids, str):
        return [part for part in ids.split(",") if part]
    return [str(value) for value in ids]
