"""JSON export: dates as ``YYYY-MM-DD``, times as ``YYYY-MM-DDTHH:MM:SS``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The two text formats.
DATE_FORMAT = "yyyy-MM-dd"
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"

_FORMATS = {
    "dateFormat": DATE_FORMAT,
    "timestampFormat": TIME_FORMAT,
    "timestampNTZFormat": TIME_FORMAT,
}


def json_rows(df: DataFrame) -> DataFrame:
    """One JSON object per row."""
    return df.select(
        F.to_json(F.struct(*df.columns), {**_FORMATS, "ignoreNullFields": "false"}).alias(
            "json"
        )
    )


def _text(column: Column, kind: T.DataType) -> Column | None:
    if isinstance(kind, T.DateType):
        return F.date_format(column, DATE_FORMAT)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(column, TIME_FORMAT)
    if isinstance(kind, T.ArrayType) and _text(column, kind.elementType) is not None:
        return F.transform(column, lambda item: _text(item, kind.elementType))
    return None


def iso_text(df: DataFrame) -> DataFrame:
    """Date and time columns, also inside arrays, as their export text."""
    texts = {f.name: _text(F.col(f.name), f.dataType) for f in df.schema}
    return df.withColumns({n: c for n, c in texts.items() if c is not None})


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines; tasks write their own files, nothing is gathered."""
    df.write.mode("errorifexists").options(**_FORMATS, ignoreNullFields="false").json(path)


def feature_lines(features: DataFrame) -> DataFrame:
    """GeoJSON features as text lines (newline-delimited GeoJSON)."""
    return json_rows(features)
