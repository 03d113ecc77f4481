"""Upgrade of tables written under the former column names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docklens.config import check_city
from docklens.schemas import HOUR_COLUMNS

# Former column names, dropped columns and status words.
RENAMED = {
    "lyon": {
        "number": "id",
        "last_update": "timestamp",
        "available_bike_stands": "available_stands",
    },
    "bordeaux": {
        "ident": "id",
        "ts": "timestamp",
        "available_stand": "available_stands",
        "available_bike": "available_bikes",
        "state": "status",
    },
}
DROPPED = {
    "lyon": ("bike_stands", "availabilitycode", "availability", "bonus"),
    "bordeaux": ("gid", "type", "name"),
}
STATUS_WORDS = {
    "lyon": {"OPEN": "open", "CLOSED": "closed"},
    "bordeaux": {"CONNECTEE": "open", "DECONNECTEE": "closed"},
}


def upgrade_readings(legacy: DataFrame, city: str) -> DataFrame:
    """Canonical names, text ids, recoded status; other status words stay."""
    check_city(city)
    renamed = legacy.drop(*DROPPED[city]).withColumnsRenamed(RENAMED[city])
    status = F.col("status")
    recoded = F.coalesce(
        *[F.when(status == old, new) for old, new in STATUS_WORDS[city].items()], status
    )
    return renamed.withColumns({"id": F.col("id").cast("string"), "status": recoded})


def upgrade_ids(legacy: DataFrame, *columns: str) -> DataFrame:
    """Numeric ids (stations, clusters) become text."""
    return legacy.withColumns({c: F.col(c).cast("string") for c in columns})


def upgrade_centroids(legacy: DataFrame) -> DataFrame:
    """``h0`` .. ``h9`` become ``h00`` .. ``h09``; cluster ids become text."""
    names = {f"h{hour}": HOUR_COLUMNS[hour] for hour in range(10)}
    return upgrade_ids(legacy.withColumnsRenamed(names), "cluster_id")


def normalised_view(
    legacy: DataFrame, city: str, raw_station: DataFrame | None = None
) -> DataFrame:
    """Distinct former readings with a name: their own, or the station's."""
    check_city(city)
    if city == "bordeaux":
        rows = legacy.select(
            F.col("ident").alias("id"), "name", "available_stand", "available_bike", "ts"
        )
    else:
        names = raw_station.select(
            F.col("idstation").try_cast("int").alias("number"), F.col("nom").alias("name")
        )
        # copies go first, so the join carries each reading once
        rows = (
            legacy.select("number", "available_bike_stands", "available_bikes", "last_update")
            .distinct()
            .join(names, "number", "left")
            .select(
                F.col("number").alias("id"),
                "name",
                F.col("available_bike_stands").alias("available_stand"),
                F.col("available_bikes").alias("available_bike"),
                F.col("last_update").alias("ts"),
            )
        )
    return rows.distinct().orderBy("id", "ts")
