import json
from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from conftest import at, rows_of
from pyspark.sql import functions as F

from docklens import jobs, schemas
from docklens.config import BORDEAUX, LYON
from docklens.sources import feeds, legacy, weather
from docklens.sources.stations import normalise_stations, read_stations
from docklens.sources.tables import read_predictions_csv, read_table, read_transactions_csv

GML = """<?xml version="1.0" encoding="ISO-8859-1"?>
<wfs:FeatureCollection xmlns:wfs="http://www.opengis.net/wfs/2.0"
    xmlns:bm="http://data.bordeaux-metropole.fr/wfs">
{members}
</wfs:FeatureCollection>
"""
MEMBER = """<wfs:member><bm:CI_VCUB_P><bm:GID>{gid}</bm:GID><bm:IDENT>{ident}</bm:IDENT>
<bm:TYPE>VLS</bm:TYPE><bm:NOM>{nom}</bm:NOM><bm:ETAT>{etat}</bm:ETAT>
<bm:NBPLACES>{places}</bm:NBPLACES><bm:NBVELOS>{velos}</bm:NBVELOS>
<bm:MDATE>{mdate}</bm:MDATE></bm:CI_VCUB_P></wfs:member>"""


def test_gml_snapshots(spark, tmp_path):
    members = "\n".join([
        MEMBER.format(gid=1, ident=12, nom="Méri", etat="CONNECTEE", places=5, velos=7,
                      mdate="2024-01-02T10:00:00"),
        MEMBER.format(gid=2, ident=3, nom="Gare", etat="DECONNECTEE", places=0, velos=0,
                      mdate="2024-01-02T09:58:00+01:00"),
    ])
    for name in ("10H00.xml", "10H05.xml"):
        (tmp_path / name).write_bytes(GML.format(members=members).encode("ISO-8859-1"))
    raw = feeds.read_gml(spark, str(tmp_path))
    assert rows_of(raw.where("gid = 1"), "nom") == [("Méri",), ("Méri",)]
    readings = feeds.canonical_readings(raw, BORDEAUX)
    one = readings.where(F.col("snapshot").endswith("10H05.xml"))
    assert rows_of(
        one, "city_key", "id", "timestamp", "available_stands", "available_bikes", "status"
    ) == [
        ("bordeaux", "12", at("2024-01-02T10:00:00"), 5, 7, "open"),
        ("bordeaux", "3", at("2024-01-02T09:58:00"), 0, 0, "closed"),
    ]


def damaged_of(parsed):
    rows = parsed.damaged.withColumn("file", F.regexp_extract("snapshot", "([^/]*)$", 1))
    return sorted((r.file, r.reason, r.text) for r in rows.collect())


def test_damaged_gml_goes_to_rejects_and_the_rest_stays(spark, tmp_path):
    member = lambda gid, places=5, mdate="2024-01-02T10:00:00": MEMBER.format(
        gid=gid, ident=gid, nom="Méri", etat="CONNECTEE", places=places, velos=7, mdate=mdate
    )
    whole = GML.format(members=member(1) + member(2, "x5") + member(3, ""))
    cut = GML.format(members=member(4) + member(5))
    cut = cut[: cut.index("<bm:NBVELOS>", cut.index("<bm:GID>5"))]
    files = {
        "a.xml": whole, "b.xml": cut, "c.xml": GML.format(members=member(6, mdate="noon")),
        "d.xml": GML.format(members=""), "e.xml": "<a:FeatureCollection/>\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_bytes(text.encode("ISO-8859-1"))
    parsed = feeds.parse_gml(spark, str(tmp_path))
    assert rows_of(parsed.rows, "gid", "nbplaces", "nbvelos", "heure") == [
        (1, 5, 7, at("2024-01-02T10:00:00")), (2, None, 7, at("2024-01-02T10:00:00")),
        (3, None, 7, at("2024-01-02T10:00:00")), (4, 5, 7, at("2024-01-02T10:00:00")),
        (6, 5, 7, None),
    ]
    found = damaged_of(parsed)
    assert [(name, reason) for name, reason, _ in found] == [
        ("a.xml", "field"), ("b.xml", "document"), ("c.xml", "field")
    ]
    assert '"NBPLACES":"x5"' in found[0][2] and "<bm:GID>5" in found[1][2]
    assert "Méri" in found[1][2] and "<bm:GID>4" not in found[1][2]


def test_damaged_geojson_goes_to_rejects_and_the_rest_stays(spark, tmp_path):
    geojson(tmp_path, "a.json", feature("1", 2, 3), feature("2", "many", 4), feature("3", "", 5))
    geojson(tmp_path, "b.json", feature("4", 2, 3))
    text = (tmp_path / "b.json").read_text()
    (tmp_path / "b.json").write_text(text[: len(text) // 2])
    (tmp_path / "c.json").write_text("<html>503</html>")
    geojson(tmp_path, "d.json")
    parsed = feeds.parse_geojson(spark, str(tmp_path))
    assert rows_of(parsed.rows, "number", "available_bike_stands", "available_bikes") == [
        ("1", 2, 3), ("2", None, 4), ("3", None, 5)
    ]
    found = damaged_of(parsed)
    assert [(name, reason) for name, reason, _ in found] == [
        ("a.json", "field"), ("b.json", "document"), ("c.json", "document")
    ]
    assert '"many"' in found[0][2] and found[2][2] == "<html>503</html>"


def test_damaged_weather_is_not_stored(spark, tmp_path):
    good = {"weather": [{"id": 1, "main": "Rain"}], "main": {"temp": 3.5}, "clouds": {"all": 7}}
    (tmp_path / "a.json").write_text(json.dumps(good))
    (tmp_path / "b.json").write_text(json.dumps(good)[:40])
    (tmp_path / "c.json").write_text(json.dumps(good | {"wind": {"speed": "calm"}}))
    parsed = weather.parse_current(spark, str(tmp_path), datetime(2024, 1, 2))
    assert rows_of(parsed.rows, "weather_id", "temp", "wind_speed") == [(1, 3.5, None)] * 2
    assert [(n, r) for n, r, _ in damaged_of(parsed)] == [("b.json", "document"), ("c.json", "record")]
    (tmp_path / "steps").mkdir()
    (tmp_path / "steps" / "a.json").write_text(json.dumps({"list": [good | {"dt": 0}] * 2}))
    (tmp_path / "steps" / "b.json").write_text('{"list": [')
    parsed = weather.parse_forecast(spark, str(tmp_path / "steps"), datetime(2024, 1, 2))
    assert parsed.rows.count() == 2 and [r for _, r, _ in damaged_of(parsed)] == ["document"]


def feature(number, stands, bikes, status="OPEN"):
    return {
        "type": "Feature",
        "properties": {
            "number": number, "last_update": "2024-01-02 10:00:00",
            "available_bike_stands": stands, "available_bikes": bikes, "status": status,
        },
    }


def geojson(tmp_path, name, *features):
    text = json.dumps({"type": "FeatureCollection", "features": features}, indent=1)
    (tmp_path / name).write_text(text)


def test_geojson_snapshot_is_filled_across_stations(spark, tmp_path):
    geojson(tmp_path, "a.json", feature("1002", "", 4), feature("1003", 12, ""),
            feature("1004", 5, 6, "CLOSED"))
    geojson(tmp_path, "b.json", feature("1002", 1, 1), feature("1003", "", ""))
    raw = feeds.canonical_readings(feeds.read_geojson(spark, str(tmp_path)), LYON)
    found = feeds.fill_counts(raw)
    first = found.readings.where(F.col("snapshot").endswith("a.json"))
    assert rows_of(first, "id", "available_stands", "available_bikes", "status") == [
        ("1002", 12, 4, "open"), ("1003", 12, 6, "open"), ("1004", 5, 6, "closed")
    ]
    # nothing is carried over from one snapshot to the other
    assert rows_of(found.rejects, "id", "available_stands") == [("1003", None)]
    alone = feeds.fill_counts(raw, scope="station")
    assert alone.rejects.count() == 3
    with pytest.raises(ValueError):
        feeds.fill_counts(raw, scope="city")


def test_copies_are_filled_and_kept(spark):
    ddl = (
        "city_key string, snapshot string, id string, timestamp timestamp_ntz, "
        "available_stands int, available_bikes int, status string"
    )
    row = lambda id_, stands, bikes, status=None: (
        "lyon", "p", id_, datetime(2024, 1, 1), stands, bikes, status
    )
    df = spark.createDataFrame(
        [row("1", None, 4)] * 3 + [row("1", 2, 4, "open"), row("2", 7, None)]
        + [row("3", 8, 9)] * 2, ddl
    )
    found = feeds.fill_counts(df)
    assert found.readings.columns == df.columns
    assert rows_of(found.readings, "id", "available_stands", "available_bikes") == [
        ("1", 2, 4)] * 4 + [("2", 7, 9)] + [("3", 8, 9)] * 2
    assert found.rejects.count() == 0


@pytest.mark.parametrize("prefix, bucket", [(1, "1H"), (2, "10T"), (9, "1D"), (3, "2H")])
@pytest.mark.parametrize("scope", ["snapshot", "station"])
def test_fill_equals_brute_force_whatever_the_grouping(spark, prefix, bucket, scope):
    rng = np.random.default_rng(prefix)
    count = 300
    frame = pd.DataFrame({
        "snapshot": rng.choice(["p", "q"], count),
        "id": [f"{i % 40:03d}" for i in range(count)],
        "minute": rng.permutation(count),
        "available_stands": [None if rng.random() < 0.6 else int(v) for v in rng.integers(0, 9, count)],
        "available_bikes": [None if rng.random() < 0.9 else int(v) for v in rng.integers(0, 9, count)],
    })
    rows = [
        (r.snapshot, r.id, datetime(2024, 1, 1) + timedelta(minutes=r.minute * 7),
         _int(r.available_stands), _int(r.available_bikes), "open")
        for r in frame.itertuples()
    ]
    df = spark.createDataFrame(
        rows, "snapshot string, id string, timestamp timestamp_ntz, available_stands int, "
        "available_bikes int, status string"
    )
    found = feeds.fill_counts(df, scope, prefix, bucket)
    key = ("snapshot", "id", "timestamp")
    got = rows_of(found.readings, *key, "available_stands", "available_bikes")
    expected, after = [], {}
    for snapshot, id_, time, stands, bikes, _ in sorted(rows, key=lambda r: r[:3], reverse=True):
        place = snapshot if scope == "snapshot" else (snapshot, id_)
        later = after.get(place, (None, None))
        known = tuple(
            new if new is not None else old for new, old in zip((stands, bikes), later)
        )
        after[place] = known
        if None not in known:
            expected.append((snapshot, id_, time, *known))
    assert got == sorted(expected)
    assert found.rejects.count() == count - len(expected)


def _int(value):
    return None if pd.isna(value) else int(value)


def test_snapshot_csv_skips_rows_spelled_none(spark, tmp_path):
    (tmp_path / "10H00.csv").write_text(
        "id,timestamp,available_stands,available_bikes,status\n"
        "1,2024-01-02 10:00:00,5,7,open\n"
        "2,2024-01-02 10:00:00,None,7,open\n"
        "3,2024-01-02 10:00:00,5,7,None\n"
        "4,2024-01-02 10:00:00,5,,closed\n"
    )
    found = feeds.drop_unloadable(feeds.read_snapshot_csv(spark, str(tmp_path)))
    assert [tuple(r) for r in found.orderBy("id").select(
        "id", "timestamp", "available_stands", "available_bikes", "status").collect()
    ] == [
        ("1", at("2024-01-02T10:00:00"), 5, 7, "open"),
        ("4", at("2024-01-02T10:00:00"), 5, None, "closed"),
    ]


def test_output_csv_files(spark, tmp_path):
    (tmp_path / "transactions.csv").write_text("id,transactions\n7,12.0\n")
    daily = read_transactions_csv(spark, str(tmp_path / "transactions.csv"), "2024-01-02")
    assert rows_of(daily, "id", "number", "date") == [("7", 12.0, date(2024, 1, 2))]
    (tmp_path / "predictions.csv").write_text(
        "ts,station_id,pred_probability,pred_nb_bikes,pred_nb_stands\n"
        "2024-01-02 10:30:00,7,0.25,5,15\n"
    )
    predicted = read_predictions_csv(spark, str(tmp_path / "predictions.csv"), "30T")
    assert predicted.columns[:2] == ["timestamp", "frequency"]
    assert tuple(predicted.collect()[0]) == (
        at("2024-01-02T10:30:00"), "30T", "7", 0.25, 5, 15
    )


def station_extract(spark, names, x, y):
    ddl = ", ".join(f"{n} string" for n in names) + ", height double, x double, y double"
    return spark.createDataFrame([("7", "Gare", "1 rue", "ville", "20", 9.0, x, y)], ddl)


def test_lambert_points_are_reprojected(spark):
    raw = station_extract(spark, BORDEAUX.station_columns, 417241.54, 6421813.35)
    found = normalise_stations(raw, BORDEAUX)
    assert found.columns == schemas.STATION.names
    row = found.collect()[0]
    assert (row.city_key, row.id, row.name, row.nb_stations) == ("bordeaux", "7", "Gare", 20)
    assert (row.x, row.y) == (pytest.approx(-0.5792, abs=1e-7), pytest.approx(44.8378, abs=1e-7))


def test_wgs84_points_stay(spark):
    row = normalise_stations(
        station_extract(spark, LYON.station_columns, 4.85, 45.75), LYON
    ).collect()[0]
    assert (row.city_key, row.city, row.x, row.y) == ("lyon", "ville", 4.85, 45.75)


WEATHER = {
    "weather": [{"id": 800, "main": "Clear"}, {"id": 1, "main": "x"}],
    "wind": {"speed": 2.5},
    "main": {"temp": 10.5, "temp_min": 9, "temp_max": 12, "pressure": 1015, "humidity": 60},
    "clouds": {"all": 20},
}


def test_current_weather(spark, tmp_path):
    (tmp_path / "w.json").write_text(json.dumps(WEATHER, indent=1))
    rows = weather.read_current(spark, str(tmp_path), datetime(2024, 1, 2, 10))
    assert rows.columns == schemas.WEATHER_CURRENT.names
    assert tuple(rows.collect()[0]) == (
        datetime(2024, 1, 2, 10), 800, "Clear", 10.5, 9.0, 12.0, 1015.0, 60.0, 2.5, 20
    )


def test_forecast_weather(spark, tmp_path):
    steps = [
        {**WEATHER, "dt": 1704193200, "rain": {"3h": 0.5}},
        {**WEATHER, "dt": 1704182400, "snow": {}},
    ]
    (tmp_path / "f.json").write_text(json.dumps({"list": steps}))
    rows = weather.read_forecast(spark, str(tmp_path), datetime(2024, 1, 2, 8)).collect()
    assert [r.ts for r in rows] == [datetime(2024, 1, 2, 9), datetime(2024, 1, 2, 12)]
    assert [(r.rain_3h, r.snow_3h) for r in rows] == [(None, None), (0.5, None)]
    assert rows[0].forecast_at == datetime(2024, 1, 2, 8)
    # half a year later the same zone is two hours ahead of UTC
    july = {"list": [{**WEATHER, "dt": 1719828000}]}
    (tmp_path / "f.json").write_text(json.dumps(july))
    row = weather.read_forecast(spark, str(tmp_path / "f.json"), datetime(2024, 7, 1)).collect()[0]
    assert row.ts == datetime(2024, 7, 1, 12)


def test_legacy_readings(spark):
    lyon = spark.createDataFrame(
        [(7, at("2024-01-02T10:00:00"), 20, 5, 6, "A", s) for s in ("OPEN", "CLOSED", "X", None)],
        "number int, last_update timestamp_ntz, bike_stands int, available_bike_stands int, "
        "available_bikes int, availabilitycode string, status string",
    )
    found = legacy.upgrade_readings(lyon, "lyon")
    assert found.columns == ["id", "timestamp", "available_stands", "available_bikes", "status"]
    assert [r.status for r in found.collect()] == ["open", "closed", "X", None]
    assert found.collect()[0].id == "7"
    bordeaux = spark.createDataFrame(
        [(1, 7, "VLS", "Gare", at("2024-01-02T10:00:00"), 5, 6, "CONNECTEE")],
        "gid int, ident int, type string, name string, ts timestamp_ntz, available_stand int, "
        "available_bike int, state string",
    )
    row = legacy.upgrade_readings(bordeaux, "bordeaux").collect()[0]
    assert row.asDict() == {
        "id": "7", "timestamp": at("2024-01-02T10:00:00"), "available_stands": 5,
        "available_bikes": 6, "status": "open",
    }
    view = legacy.normalised_view(bordeaux.unionByName(bordeaux), "bordeaux")
    assert view.columns == ["id", "name", "available_stand", "available_bike", "ts"]
    assert view.count() == 1


def test_legacy_view_with_station_names(spark):
    readings = spark.createDataFrame(
        [(7, 5, 6, at("2024-01-02T10:00:00"))] * 2 + [(8, 5, 6, at("2024-01-02T10:00:00"))],
        "number int, available_bike_stands int, available_bikes int, last_update timestamp_ntz",
    )
    names = spark.createDataFrame([("7", "Gare"), ("x", "?")], "idstation string, nom string")
    found = legacy.normalised_view(readings, "lyon", names)
    assert [(r.id, r.name) for r in found.collect()] == [(7, "Gare"), (8, None)]


def test_legacy_centroids(spark):
    wide = spark.createDataFrame(
        [(1, *[float(h) for h in range(24)])],
        "cluster_id int, " + ", ".join(f"h{h} double" for h in range(24)),
    )
    found = legacy.upgrade_centroids(wide)
    assert found.columns == ["cluster_id", *schemas.HOUR_COLUMNS]
    assert found.collect()[0].cluster_id == "1"


def station_feature(id_, docks="20", point=(4.85, 45.75), kind="Point", **more):
    names = dict(zip(LYON.station_columns, (id_, "Gare", "1 rue", "ville", docks)))
    geometry = None if point is None else {"type": kind, "coordinates": list(point)}
    return {"type": "Feature", "properties": names | more, "geometry": geometry}


def test_station_extract_in_geojson(spark, tmp_path):
    nan = float("nan")
    geojson(
        tmp_path, "a.json",
        station_feature("1", 20, (4.85, 45.75, 170.5), x="clash", snapshot="clash", placed=1),
        station_feature("2", "20.0"),
        station_feature("2"),  # repeated: two rows
        station_feature("3", "", None),  # blank docks and no geometry are no damage
        station_feature("4", "many"),
        station_feature("5", point=(4.85,)),
        station_feature("6", point=((4.85, 45.75), (4.9, 45.8)), kind="LineString"),
        station_feature("7", point=("east", 45.75)),
        station_feature("8", point=(nan, 45.75)),
        station_feature(None), station_feature(" "),
    )
    (tmp_path / "b.json").write_text('{"type": "FeatureCollection", "features": [{"type": "Fea')
    geojson(tmp_path, "c.json")
    parsed = read_stations(spark, str(tmp_path), LYON)
    assert parsed.rows.columns == schemas.STATION.names
    at = (4.85, 45.75)
    found = sorted((r.id, r.nb_stations, r.x, r.y) for r in parsed.rows.collect() if r.id < "3")
    assert found == [("1", 20, *at), ("2", 20, *at), ("2", 20, *at)]
    rest = {r.id: (r.nb_stations, r.x, r.y) for r in parsed.rows.collect() if r.id >= "3"}
    none = (20, None, None)
    assert rest == {"3": (None,) * 3, "4": (None, *at), "5": none, "6": none, "7": none, "8": none}
    reasons = [(n, r) for n, r, _ in damaged_of(parsed)]
    assert sorted(reasons) == sorted(
        [("a.json", "field")] * 5 + [("a.json", "record")] * 2 + [("b.json", "document")]
    )
    assert all(text for _, _, text in damaged_of(parsed))


def test_station_extract_in_tables(spark, tmp_path):
    raw = station_extract(spark, BORDEAUX.station_columns, 417241.54, 6421813.35)
    bad = raw.withColumns({"numstat": F.lit("8"), "nbsuppor": F.lit("x"), "y": F.lit(None)})
    both = raw.unionByName(bad)
    both.write.parquet(str(tmp_path / "parquet"))
    both.write.csv(str(tmp_path / "csv"), header=True)
    for kind in ("parquet", "csv"):
        parsed = read_stations(spark, str(tmp_path / kind), BORDEAUX, kind)
        rows = {r.id: r for r in parsed.rows.collect()}
        assert (rows["7"].nb_stations, round(rows["7"].x, 4)) == (20, -0.5792)
        assert (rows["8"].nb_stations, rows["8"].x, rows["8"].y) == (None, None, None)
        assert [r for _, r, _ in damaged_of(parsed)] == ["field"]  # one reject a record
    with pytest.raises(ValueError):
        read_stations(spark, str(tmp_path), BORDEAUX, "shapefile")


def test_the_job_stores_stations_and_rejects(spark, tmp_path):
    lake, files = str(tmp_path / "lake"), tmp_path / "files"
    files.mkdir()
    geojson(files, "a.json", station_feature("1"), station_feature("2", "many"))
    for _ in range(2):
        jobs.load_station_files(spark, str(files), "lyon", lake)
    assert rows_of(read_table(spark, lake, "station"), "id") == [("1",), ("2",)]
    assert rows_of(read_table(spark, lake, "station_reject"), "city_key", "reason") == [
        ("lyon", "field")
    ]
