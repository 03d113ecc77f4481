import pytest
from conftest import at, rows_of
from test_sources import GML, MEMBER, feature, geojson
from test_transactions import E1

from docklens import jobs
from docklens.plans import transactions
from docklens.sinks.tables import append_readings
from docklens.sources.tables import read_table
from docklens.streaming import ingest, landing, latest, rolling
from docklens.streaming import transactions as running
from docklens.streaming.versions import compact_changes, read_changes, store_changes
from registry import queries

# Arrival by file: out of order inside the hour, with a copy across files.
FILES = [
    [E1[0], E1[1], E1[3], ("b", "2024-01-01T11:50:00", 8)],
    [("b", "2024-01-01T11:20:00", 4), E1[3], E1[4], ("b", "2024-01-01T12:05:00", None)],
    [E1[5], ("b", "2024-01-02T00:01:00", 9), ("b", "2024-01-01T23:55:00", 3, 1, "closed")],
]
DELAY = "12 hours"


@pytest.fixture
def landed(make_readings, tmp_path):
    folder = tmp_path / "landed"
    for n, rows in enumerate(FILES):
        make_readings(rows).coalesce(1).write.parquet(str(tmp_path / f"part{n}"))
        source = next((tmp_path / f"part{n}").glob("*.parquet"))
        folder.mkdir(exist_ok=True)
        (folder / f"{n}.parquet").write_bytes(source.read_bytes())
    return folder


def stream(spark, landed):
    return ingest.read_stream(spark, str(landed), files_per_batch=1)


def all_rows(make_readings):
    return make_readings([row for rows in FILES for row in rows])


def test_running_totals_equal_the_batch(spark, landed, make_readings, tmp_path):
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    running.run_daily_transactions(
        stream(spark, landed), path, checkpoint, DELAY
    ).awaitTermination()
    found = running.read_daily_transactions(spark, path)
    batch = transactions.daily_transactions(all_rows(make_readings))
    columns = ["city_key", "id", "number", "date"]
    assert rows_of(found, *columns) == rows_of(batch, *columns)


def test_running_totals_go_on_after_a_restart(spark, landed, make_readings, tmp_path):
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    late = landed / "2.parquet"
    held_back = late.read_bytes()
    late.rename(tmp_path / "later.parquet")
    columns = ["city_key", "id", "number", "date"]
    for rows in (FILES[:2], FILES):
        if rows is FILES:
            late.write_bytes(held_back)
        running.run_daily_transactions(
            stream(spark, landed), path, checkpoint, DELAY
        ).awaitTermination()
        batch = transactions.daily_transactions(make_readings([r for f in rows for r in f]))
        found = running.read_daily_transactions(spark, path)
        assert rows_of(found, *columns) == rows_of(batch, *columns)


def test_different_readings_are_stored_once(spark, landed, make_readings, tmp_path):
    lake, checkpoint = str(tmp_path / "lake"), str(tmp_path / "checkpoint")
    for _ in range(2):
        ingest.ingest(stream(spark, landed), lake, checkpoint).awaitTermination()
    found = read_table(spark, lake, "timeseries").drop("date")
    want = all_rows(make_readings).distinct()
    assert found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty()


def files(make_readings, folder, parts):
    for n, rows in enumerate(parts):
        make_readings(rows).coalesce(1).write.parquet(str(folder / f"n={n}"))


def test_no_reading_is_too_late_or_too_much(spark, make_readings, tmp_path):
    ordinary = [("c", f"2024-01-01T10:{m:02d}:00", m) for m in range(5)]
    parts = [
        # two readings at one time, and a station whose clock is two days ahead
        [("a", "2024-01-01T10:00:00", 1), ("a", "2024-01-01T10:00:00", 2),
         ("a", "2024-01-01T10:00:00", 2), ("b", "2024-01-01T10:00:00", None)],
        [("a", "2024-01-03T10:00:00", 5), ("b", "2024-01-01T10:00:00", None)],
        ordinary + [("a", "2024-01-01T10:00:00", 1)],
    ]
    files(make_readings, tmp_path / "landed", parts)
    source = ingest.read_stream(spark, str(tmp_path / "landed" / "n=*"), files_per_batch=1)
    lake = str(tmp_path / "lake")
    ingest.ingest(source, lake, str(tmp_path / "checkpoint")).awaitTermination()
    found = read_table(spark, lake, "timeseries")
    assert found.count() == 9
    assert rows_of(found.where("id = 'a'"), "available_bikes") == [(1,), (2,), (5,)]


def test_a_repeated_batch_replaces_itself(spark, make_readings, tmp_path):
    lake = str(tmp_path / "lake")
    batch = make_readings([("a", "2024-01-01T10:00:00", 1), ("a", "2024-01-02T10:00:00", 2)])
    for _ in range(2):
        append_readings(ingest.new_rows(batch, lake, "s-0"), lake, "s-0")
    append_readings(ingest.new_rows(batch, lake, "s-1"), lake, "s-1")
    assert rows_of(read_table(spark, lake, "timeseries"), "available_bikes") == [(1,), (2,)]


def test_folded_batches_give_the_same_rows(spark, landed, make_readings, tmp_path):
    path = str(tmp_path / "out")
    running.run_daily_transactions(
        stream(spark, landed), path, str(tmp_path / "checkpoint"), DELAY
    ).awaitTermination()
    before = rows_of(running.read_daily_transactions(spark, path), "id", "number", "date")
    for _ in range(2):
        compact_changes(spark, path, [*running.KEYS, "bucket"])
        found = running.read_daily_transactions(spark, path)
        assert rows_of(found, "id", "number", "date") == before
    assert not (tmp_path / "out" / "batch_id=0").exists()


def test_readings_later_than_the_watermark_are_left_out(spark, make_readings, tmp_path):
    folder = tmp_path / "landed"
    for n, rows in enumerate([
        [("a", "2024-01-01T08:00:00", 1), ("a", "2024-01-01T20:00:00", 5)],
        [("a", "2024-01-01T21:00:00", 7)],
        [("a", "2024-01-01T09:00:00", 50), ("a", "2024-01-01T21:01:00", 8)],
    ]):
        make_readings(rows).coalesce(1).write.mode("append").parquet(str(folder / f"n={n}"))
    source = ingest.read_stream(spark, str(folder / "n=*"), files_per_batch=1)
    path = str(tmp_path / "out")
    running.run_daily_transactions(
        source, path, str(tmp_path / "checkpoint"), "1 hour"
    ).awaitTermination()
    found = running.read_daily_transactions(spark, path)
    assert rows_of(found, "id", "number") == [("a", 4.0 + 2.0 + 1.0)]


def test_window_means(spark, landed, make_readings, tmp_path):
    path = str(tmp_path / "out")
    means = rolling.window_means(stream(spark, landed), "1H", DELAY)
    store_changes(means, path, str(tmp_path / "checkpoint")).awaitTermination()
    found = read_changes(spark, path, ["city_key", "id", "ts"]).where("id = 'b'")
    at_eleven = found.where("hour(ts) = 11").collect()[0]
    assert (at_eleven.mean_bikes, at_eleven.min_bikes, at_eleven.max_bikes) == (6.0, 4, 8)


def test_latest_rows_follow_the_stream(spark, landed, make_readings, tmp_path):
    path = str(tmp_path / "out")
    latest.run_latest(stream(spark, landed), path, str(tmp_path / "checkpoint")).awaitTermination()
    found = latest.read_latest(spark, path)
    assert [(i, str(t), b) for i, t, b in sorted(
        (r.id, r.timestamp, r.available_bikes) for r in found.collect()
    )] == [
        ("a", "2024-01-01 08:00:00", 5),
        ("b", "2024-01-02 00:01:00", 9),
        ("c", "2024-01-01 09:00:00", None),
    ]


def test_polled_feeds_are_landed_and_stored_once(spark, tmp_path):
    folder, lake, checkpoint = tmp_path / "feed", str(tmp_path / "lake"), str(tmp_path / "cp")
    folder.mkdir()
    geojson(folder, "a.json", feature("1", "", 4), feature("2", 7, 5))
    poll = lambda: jobs.poll_readings(spark, str(folder), "lyon", lake, checkpoint)
    stored = lambda: rows_of(
        read_table(spark, lake, "timeseries"), "id", "available_stands", "available_bikes"
    )
    poll()
    assert stored() == [("1", 7, 4), ("2", 7, 5)]
    # the next snapshot repeats one reading and brings a new one; the last has no counts
    geojson(folder, "b.json", feature("2", 7, 5), feature("3", 1, 1), feature("4", "", ""))
    poll()
    assert stored() == [("1", 7, 4), ("2", 7, 5), ("3", 1, 1)]
    poll()
    assert len(stored()) == 3
    assert spark.read.parquet(f"{lake}/landed/lyon/rejects").count() == 1


def test_gml_feed_as_a_stream(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    member = MEMBER.format(gid=1, ident=12, nom="M\u00e9ri", etat="CONNECTEE", places=5,
                           velos=7, mdate="2024-01-02T10:00:00")
    (tmp_path / "feed" / "a.xml").write_bytes(GML.format(members=member).encode("ISO-8859-1"))
    landing.land_feed(
        spark, str(tmp_path / "feed"), "bordeaux", str(tmp_path / "landed"), str(tmp_path / "cp")
    ).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "landed" / "readings"))
    assert rows_of(found, "city_key", "id", "available_stands", "available_bikes") == [
        ("bordeaux", "12", 5, 7)
    ]


def test_a_damaged_snapshot_is_the_same_in_the_stream_and_in_batch(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    for n in range(5):
        members = [
            MEMBER.format(gid=10 * n + k, ident=k, nom="M\u00e9ri", etat="CONNECTEE",
                          places="?" if k == n else k, velos=7, mdate=f"2024-01-02T10:0{n}:00")
            for k in range(4)
        ]
        text = GML.format(members="".join(members))
        data = text[: -60 if n == 1 else None].encode("ISO-8859-1")
        (tmp_path / "feed" / f"{n}.xml").write_bytes(data)
    batch = jobs.read_feed(spark, str(tmp_path / "feed"), "bordeaux")
    landed, checkpoint = str(tmp_path / "landed"), str(tmp_path / "cp")
    for _ in range(2):  # the second run finds nothing new
        landing.land_feed(
            spark, str(tmp_path / "feed"), "bordeaux", landed, checkpoint, files_per_batch=2
        ).awaitTermination()
    assert len(list((tmp_path / "landed" / "damaged").iterdir())) == 3
    for name, rows in batch._asdict().items():
        found = spark.read.parquet(f"{landed}/{name}").drop("batch_id")
        columns = [c for c in found.columns if c in rows.columns]
        assert len(columns) >= 3 and rows_of(found, *columns) == rows_of(rows, *columns)
    assert batch.damaged.count() == 5 and batch.readings.count() + batch.rejects.count() == 19


def test_what_could_not_be_read_is_stored(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "a.json").write_text('{"features": [')
    (tmp_path / "weather").mkdir()
    (tmp_path / "weather" / "a.json").write_text("{")
    lake = str(tmp_path / "lake")
    for _ in range(2):
        jobs.load_readings(spark, str(tmp_path / "feed"), "lyon", lake, "one")
        jobs.load_weather(spark, str(tmp_path / "weather"), "current", at("2024-01-02"), "lyon", lake)
    for name in ("feed_reject", "weather_reject"):
        [row] = spark.read.parquet(f"{lake}/{name}").collect()
        assert row.reason == "document" and row.city_key == "lyon" and row.text.startswith("{")


def test_documents_are_parsed_once_for_their_readings(spark, tmp_path, monkeypatch):
    folder = tmp_path / "feed"
    folder.mkdir()
    (folder / "one.json").write_text('{"features":[{"properties":{"number":"1",'
        '"last_update":"2024-01-01T00:00:00","available_bike_stands":"1","available_bikes":"",'
        '"status":"OPEN"}}]}')  # fmt: skip
    kept, fill = [], landing.feeds.fill_counts

    def filled(readings):
        kept.append(readings.storageLevel.useMemory)
        return fill(readings)

    monkeypatch.setattr(landing.feeds, "fill_counts", filled)
    landing.land_feed(
        spark, str(folder), "lyon", str(tmp_path / "landed"), str(tmp_path / "checkpoint")
    ).awaitTermination()
    assert kept == [True]
    assert spark.read.parquet(str(tmp_path / "landed" / "rejects")).count() == 1


def test_landings_of_the_registered_streams_are_written_by_several_tasks(spark, tmp_path, monkeypatch, make_readings):
    rows = make_readings([("a", f"2024-01-{d:02d}T{h:02d}:00:00", h) for d in (1, 2) for h in range(24)])
    monkeypatch.setattr(queries, "_readings", lambda *_: rows.coalesce(1))
    queries._landed(spark, "", str(tmp_path / "landed"))
    assert len(list((tmp_path / "landed").glob("*.parquet"))) == 5 * queries.LANDED_FILES
