import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from docklens import schemas  # noqa: E402
from docklens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, spark__sql__shuffle__partitions="4")
    if not session.conf.get("spark.checkpoint.dir", None):
        folder = str(tmp_path_factory.mktemp("shared"))
        session.conf.set("spark.checkpoint.dir", folder)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text):
    return datetime.fromisoformat(text)


@pytest.fixture
def make_readings(spark):
    """Readings from (id, time, bikes[, stands[, status]]) rows of one city."""

    def make(rows, city="lyon"):
        full = []
        for row in rows:
            id_, ts, bikes, *rest = row
            stands = rest[0] if rest else 10
            status = rest[1] if len(rest) > 1 else "open"
            full.append((city, id_, at(ts), stands, bikes, status))
        return spark.createDataFrame(full, schemas.TIMESERIES)

    return make


@pytest.fixture
def make_station(spark):
    def make(ids, city="lyon"):
        rows = [
            (city, i, f"name {i}", f"address {i}", "town", 20, 4.8 + n, 45.7 + n)
            for n, i in enumerate(ids)
        ]
        return spark.createDataFrame(rows, schemas.STATION)

    return make


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
