"""City feeds (GML, GeoJSON, CSV snapshots) to canonical readings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docklens import schemas
from docklens.config import CityConfig
from docklens.functions.fill import blank_to_null, recode_status
from docklens.functions.timecols import bin_start
from docklens.operators.series import known

COUNTS = ("available_stands", "available_bikes")
_PLACE = ("snapshot", "id", "timestamp", "status", *COUNTS)


class Parsed(NamedTuple):
    """Rows of feed documents, and what could not be read: (snapshot, reason, text)."""

    rows: DataFrame
    damaged: DataFrame


_CORRUPT = "_corrupt_record"
_TIMES = ("MDATE", "last_update")


def _known_or_not(column: str) -> Column:
    """Always true, and reads the column: Spark parses no document for its damaged text alone."""
    return F.col(column).isNull() | F.col(column).isNotNull()


def _snapshot() -> Column:
    return F.col("_metadata.file_path").alias("snapshot")


def _readable(name: str, value: Column) -> Column:
    """The value of a text field, or null; blank text is a missing value."""
    kind = "timestamp_ntz" if name in _TIMES else "double"
    return blank_to_null(value).try_cast(kind)


def _damaged_fields(records: DataFrame, record: str, names: Sequence[str]) -> DataFrame:
    """Records with a field that is neither blank nor readable."""
    at = lambda name: F.col(f"{record}.{name}")
    bad = reduce(
        Column.__or__,
        [blank_to_null(at(n)).isNotNull() & _readable(n, at(n)).isNull() for n in names],
    )
    return records.where(bad).select(
        "snapshot", F.lit("field").alias("reason"), F.to_json(record).alias("text")
    )


def parse_gml(
    spark: SparkSession, path: str | Sequence[str], encoding: str = "ISO-8859-1"
) -> Parsed:
    """The station members of GML snapshots, with the feed's names.

    A document whose root is not closed was cut: its whole members count, and what follows
    the last of them is damaged.
    """
    paths = [path] if isinstance(path, str) else list(path)
    members = (
        spark.read.format("xml")
        .schema(f"{schemas.GML_MEMBER}, {_CORRUPT} string")
        .option("rowTag", "member")
        .option("ignoreNamespace", "true")
        .option("encoding", encoding)
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .load(paths)
        .select("CI_VCUB_P", _CORRUPT, _snapshot())
    )
    # a member without an end is the one where its document was cut, see below
    ended = F.col(_CORRUPT).rlike(r"member>\s*$")
    malformed = members.where(ended & _known_or_not("CI_VCUB_P")).select(
        "snapshot",
        F.when(F.col("CI_VCUB_P").isNull(), "record").otherwise("field").alias("reason"),
        F.col(_CORRUPT).alias("text"),
    )
    fields = _damaged_fields(
        members, "CI_VCUB_P", ["GID", "IDENT", "NBPLACES", "NBVELOS", "MDATE"]
    )
    document = spark.read.format("binaryFile").load(paths).select(
        _snapshot(), F.rtrim(F.decode("content", encoding), F.lit(" \t\r\n")).alias("text")
    )
    root = F.regexp_extract("text", r"<([A-Za-z_][^\s/>]*)", 1)
    closed = F.endswith("text", F.concat(F.lit("</"), root, F.lit(">")))
    empty = F.endswith("text", F.lit("/>")) & ~F.contains("text", F.lit("member>"))
    cut = document.where(~(closed | empty)).select(
        "snapshot",
        F.lit("document").alias("reason"),
        F.trim(F.substring_index("text", "member>", -1)).alias("text"),
    )
    whole = members.where(F.col("CI_VCUB_P").isNotNull())
    return Parsed(
        member_rows(whole.select("CI_VCUB_P", "snapshot")), malformed.union(fields).union(cut)
    )


def read_gml(
    spark: SparkSession, path: str | Sequence[str], encoding: str = "ISO-8859-1"
) -> DataFrame:
    """One row per station member of the GML snapshots, with the feed's names."""
    return parse_gml(spark, path, encoding).rows


def member_rows(members: DataFrame) -> DataFrame:
    """Parsed station members under the feed's lower-case names."""
    number = lambda name: _readable(name, F.col(f"CI_VCUB_P.{name}")).cast("int")
    return members.select(
        number("GID").alias("gid"),
        number("IDENT").alias("ident"),
        F.col("CI_VCUB_P.TYPE").alias("type"),
        F.col("CI_VCUB_P.NOM").alias("nom"),
        F.col("CI_VCUB_P.ETAT").alias("etat"),
        number("NBPLACES").alias("nbplaces"),
        number("NBVELOS").alias("nbvelos"),
        F.col("CI_VCUB_P.MDATE").try_cast("timestamp_ntz").alias("heure"),
        "snapshot",
    )


def json_documents(
    spark: SparkSession, path: str | Sequence[str], schema: str
) -> tuple[DataFrame, DataFrame]:
    """(parsed documents with ``snapshot``, those that were damaged).

    Of a damaged document the parts that could be read stay.
    """
    read = (
        spark.read.schema(f"{schema}, {_CORRUPT} string")
        .option("multiLine", "true")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .json([path] if isinstance(path, str) else list(path))
    )
    parts = [c for c in read.columns if c != _CORRUPT]
    some = reduce(Column.__or__, [F.col(c).isNotNull() for c in parts])
    damaged = read.where(F.col(_CORRUPT).isNotNull() & _known_or_not(parts[0])).select(
        _snapshot(),
        F.when(some, "record").otherwise("document").alias("reason"),
        F.col(_CORRUPT).alias("text"),
    )
    return read.where(some).select(*parts, _snapshot()), damaged


def parse_geojson(spark: SparkSession, path: str | Sequence[str]) -> Parsed:
    """The features of GeoJSON snapshots, properties as columns."""
    documents, damaged = json_documents(spark, path, schemas.GEOJSON_READINGS)
    features = documents.select("snapshot", F.inline("features"))
    fields = _damaged_fields(
        features, "properties", ["last_update", "available_bike_stands", "available_bikes"]
    )
    return Parsed(feature_rows(documents), damaged.union(fields))


def read_geojson(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per feature of the GeoJSON snapshots, properties as columns."""
    return parse_geojson(spark, path).rows


def feature_rows(documents: DataFrame) -> DataFrame:
    """``features[].properties`` of parsed documents; blank counts become null."""
    rows = documents.select("snapshot", F.inline("features")).select(
        "snapshot", "properties.*"
    )
    names = ("last_update", "available_bike_stands", "available_bikes")
    return rows.withColumns({n: _readable(n, F.col(n)) for n in names})


PARSERS = {"bordeaux": parse_gml, "lyon": parse_geojson}


def read_snapshot_csv(spark: SparkSession, path: str) -> DataFrame:
    """Canonical snapshot files; counts stay text for ``drop_unloadable``."""
    return (
        spark.read.schema(schemas.SNAPSHOT_CSV)
        .option("header", "true")
        .csv(path)
        .withColumn("snapshot", F.col("_metadata.file_path"))
    )


def canonical_readings(
    raw: DataFrame, city: CityConfig, keep: Sequence[str] = ("snapshot",)
) -> DataFrame:
    """The five configured columns under their canonical names, status recoded."""
    id_, ts, stands, bikes, status = city.reading_columns
    return raw.select(
        F.lit(city.city_key).alias("city_key"),
        F.col(id_).cast("string").alias("id"),
        F.col(ts).cast("timestamp_ntz").alias("timestamp"),
        F.col(stands).alias("available_stands"),
        F.col(bikes).alias("available_bikes"),
        recode_status(F.col(status), city.open_token).alias("status"),
        *keep,
    )


def drop_unloadable(readings: DataFrame) -> DataFrame:
    """Skip rows whose status or stands is the text ``None``; cast the counts."""
    spelled_none = lambda name: F.coalesce(F.col(name) == "None", F.lit(False))
    kept = readings.where(~spelled_none("status") & ~spelled_none("available_stands"))
    return kept.withColumns({c: F.col(c).try_cast("int") for c in COUNTS})


class FilledReadings(NamedTuple):
    """Readings with both counts, those after which no count is known, and unread parts."""

    readings: DataFrame
    rejects: DataFrame
    damaged: DataFrame | None = None


def read_feed(spark: SparkSession, path: str | Sequence[str], city: CityConfig) -> FilledReadings:
    """Canonical readings of a city's snapshots, missing counts filled."""
    rows, damaged = PARSERS[city.city_key](spark, path)
    return fill_counts(canonical_readings(rows, city))._replace(damaged=damaged)


def fill_counts(
    readings: DataFrame, scope: str = "snapshot", prefix: int = 5, bucket: str = "1H"
) -> FilledReadings:
    """Give a missing count the next known one in (id, timestamp) order.

    ``scope="snapshot"`` looks on through the whole snapshot, also past the end
    of a station; ``scope="station"`` stays inside the station.  Rows after
    which no count is known go to ``rejects``.

    Rows with both counts stay where they are.  The others look their counts up
    among the snapshot's different rows, which are never ordered in one task.
    Each station's hour (``bucket``) is filled by itself and leaves one row, its
    first known counts; those rows carry counts back inside a station, or among
    the ids with the same first ``prefix`` characters, and one row of each such
    group carries them through the snapshot.  Neither length changes the result.
    """
    if scope not in ("snapshot", "station"):
        raise ValueError("scope is 'snapshot' or 'station'")
    readings = readings.withColumns({c: F.col(c).cast("int") for c in COUNTS})
    complete = known(COUNTS)
    rows = (
        readings.select(*_PLACE)
        .distinct()
        .where(known(["snapshot", "id"]))
        .withColumns(
            {
                "part": F.col("id") if scope == "station" else F.substring("id", 1, prefix),
                # a reading without a time comes before all others of its station
                "bucket": F.coalesce(
                    bin_start("timestamp", bucket),
                    F.lit("0001-01-01 00:00:00").cast("timestamp_ntz"),
                ),
            }
        )
    )
    cell = ["snapshot", "part", "id", "bucket"]
    order = [F.desc("timestamp"), F.desc("status"), *[F.desc_nulls_last(c) for c in COUNTS]]
    backwards = Window.partitionBy(*cell).orderBy(*order)
    running = backwards.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns(
        {f"next_{c}": F.last(c, ignorenulls=True).over(running) for c in COUNTS}
        | {"is_first": F.lead(F.lit(False), 1, True).over(backwards)}
    )
    heads = rows.where("is_first").select(*cell, *[f"next_{c}" for c in COUNTS])
    heads = _carried(heads, ["snapshot", "part"], [F.desc("id"), F.desc("bucket")])
    if scope == "snapshot":
        parts = heads.where("is_first").select("snapshot", "part", *_first_known())
        parts = _carried(parts, ["snapshot"], [F.desc("part")])
        beyond = parts.select(
            "snapshot", "part", *[F.col(f"later_{c}").alias(f"beyond_{c}") for c in COUNTS]
        )
        heads = heads.join(beyond, ["snapshot", "part"]).withColumns(
            {f"later_{c}": F.coalesce(f"later_{c}", f"beyond_{c}") for c in COUNTS}
        )
    carried = heads.select(*cell, *[f"later_{c}" for c in COUNTS])
    found = (
        rows.where(~complete)
        .join(carried, cell)
        .select(*[F.col(c).alias(f"_{c}") for c in _PLACE], *_first_known())
    )
    same_row = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _PLACE])
    filled = (
        readings.where(~complete)
        .join(found, same_row, "left")
        .withColumns({c: F.col(f"next_{c}") for c in COUNTS})
        .select(*readings.columns)
    )
    return FilledReadings(
        readings.where(complete).unionByName(filled.where(complete)),
        filled.where(~complete),
    )


def _first_known() -> list[Column]:
    """The counts of a row's own group, else those carried back to it."""
    return [F.coalesce(f"next_{c}", f"later_{c}").alias(f"next_{c}") for c in COUNTS]


def _carried(heads: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per group of readings, with the first known counts of the groups after it.

    ``order`` runs backwards; ``is_first`` marks the first row of each ``group``.
    """
    backwards = Window.partitionBy(*group).orderBy(*order)
    later = backwards.rowsBetween(Window.unboundedPreceding, -1)
    return heads.withColumns(
        {f"later_{c}": F.last(f"next_{c}", ignorenulls=True).over(later) for c in COUNTS}
        | {"is_first": F.lead(F.lit(False), 1, True).over(backwards)}
    )
