"""The registered queries as SQL over the test tables.

Each statement names the common tables it uses; ``statements`` puts them in
front as a WITH list.
"""

from __future__ import annotations

# Common tables: name -> (names it reads, SELECT).
_COMMON: dict[str, tuple[tuple[str, ...], str]] = {}
_QUERIES: dict[str, tuple[tuple[str, ...], str]] = {}

_HOURS = [f"h{hour:02d}" for hour in range(24)]


def _table(name: str, uses: str, sql: str) -> None:
    _COMMON[name] = (tuple(uses.split()), sql)


def _oracle(name: str, uses: str, sql: str) -> None:
    _QUERIES[name] = (tuple(uses.split()), sql)


def _order(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _order(_COMMON[name][0], seen)
            seen.append(name)
    return seen


def statements() -> dict[str, str]:
    result = {}
    for name, (uses, sql) in _QUERIES.items():
        tables = ",\n".join(f"{t} AS ({_COMMON[t][1]})" for t in _order(uses, []))
        result[name] = f"WITH {tables}\n{sql}"
    return result


# Canonical tables ------------------------------------------------------------

_CITY = "CASE WHEN c_nationkey % 2 = 0 THEN 'lyon' ELSE 'bordeaux' END"
_BIKES = "CAST(floor(value) AS INTEGER) % 41"

_table("station", "", f"""
  SELECT {_CITY} AS city_key, CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
    c_mktsegment AS address, n_name AS city, CAST(40 AS INTEGER) AS nb_stations,
    CAST(4.7 + 0.005 * (c_custkey % 40) AS DOUBLE) AS x,
    CAST(45.7 + 0.005 * (c_custkey // 40) AS DOUBLE) AS y
  FROM customer JOIN nation ON c_nationkey = n_nationkey""")

_table("sourced", "", f"""
  SELECT {_CITY} AS city_key, CAST(user_id AS VARCHAR) AS id, ts, event_id, user_id,
    event_type, value, {_BIKES} AS bikes, CAST(40 - {_BIKES} AS INTEGER) AS stands
  FROM events JOIN customer ON user_id = c_custkey""")

_table("readings", "sourced", """
  SELECT city_key, id, ts AS "timestamp", stands AS available_stands,
    bikes AS available_bikes,
    CASE WHEN event_type = 'error' THEN 'closed' ELSE 'open' END AS status
  FROM sourced""")

_DAILY = """
  SELECT city_key, id, CAST(coalesce(sum(d), 0) AS DOUBLE) AS number, "date"
  FROM (
    SELECT city_key, id, CAST("timestamp" AS DATE) AS "date",
      abs(available_bikes - lag(available_bikes) OVER (
        PARTITION BY city_key, id, CAST("timestamp" AS DATE)
        ORDER BY "timestamp", available_bikes, available_stands)) AS d
    FROM (SELECT DISTINCT * FROM {}) WHERE status = 'open')
  GROUP BY city_key, id, "date" """
_table("daily", "readings", _DAILY.format("readings"))

_table("prediction", "readings", """
  SELECT city_key, "timestamp" + INTERVAL 1 HOUR AS "timestamp", '1H' AS frequency,
    id AS station_id, available_bikes / 40.0::DOUBLE AS availability,
    available_bikes AS nb_bikes, available_stands AS nb_stands
  FROM readings""")

_table("runs", "", """
  SELECT * FROM (VALUES (DATE '2024-01-01', DATE '2024-01-15'),
    (DATE '2024-01-01', DATE '2024-01-31')) AS r("start", "stop")""")

_table("clustering", "station runs", """
  SELECT city_key, id AS station_id, "start", "stop",
    CAST(CAST(id AS INTEGER) % 4 AS VARCHAR) AS cluster_id
  FROM station CROSS JOIN runs""")

_table("centroid", "readings runs", f"""
  SELECT city_key, CAST(CAST(id AS INTEGER) % 4 AS VARCHAR) AS cluster_id, "start", "stop",
    {", ".join(
        f'CAST(sum(available_bikes) FILTER (hour("timestamp") = {h}) AS DOUBLE) / '
        f'(count(*) FILTER (hour("timestamp") = {h}) * 40.0::DOUBLE) AS {name}'
        for h, name in enumerate(_HOURS))}
  FROM readings JOIN runs ON CAST("timestamp" AS DATE) >= "start"
    AND CAST("timestamp" AS DATE) < "stop"
  GROUP BY ALL""")

# Stations --------------------------------------------------------------------

_INFO = "city_key, id, name, address, city, nb_stations AS nb_stands, x, y"

_oracle("city_counts", "station", """
  SELECT city_key AS city, 'france' AS country, count(*) AS stations
  FROM station GROUP BY city_key""")
_oracle("station_list", "station", f"SELECT {_INFO} FROM station")
_oracle("stations_first", "station", f"""
  SELECT {_INFO} FROM station
  QUALIFY row_number() OVER (PARTITION BY city_key ORDER BY id) <= 20""")
_oracle("stations_by_id", "station", f"""
  SELECT {_INFO} FROM station WHERE id IN ('1', '2', '3', '5', '8')""")
_oracle("station_ids", "station", "SELECT city_key, id FROM station")


def _feature(properties: str, source: str) -> str:
    return f"""
  SELECT '{{"type":"Feature","geometry":{{"type":"Point","coordinates":['
    || CAST(x AS VARCHAR) || ',' || CAST(y AS VARCHAR) || ']}},"properties":{{'
    || {properties} || '}}}}' AS json
  FROM {source}"""


def _text(name: str, column: str | None = None) -> str:
    return f"""'"{name}":"' || {column or name} || '"'"""


_oracle("station_geojson", "station", _feature(
    " || ',' || ".join([
        _text("id"), _text("name"), _text("address"), _text("city"),
        "'\"nb_stands\":' || nb_stations"]),
    "station"))
_oracle("map_extent", "station", """
  SELECT city_key, min(x) AS min_x, min(y) AS min_y, max(x) AS max_x, max(y) AS max_y,
    (min(x) + max(x)) / 2 AS center_x, (min(y) + max(y)) / 2 AS center_y
  FROM station GROUP BY city_key""")

# Readings and transactions ---------------------------------------------------

_oracle("daily_transactions", "daily", "SELECT * FROM daily")
_oracle("day_transactions", "daily", """
  SELECT * FROM daily WHERE "date" = DATE '2024-01-20'""")
_DAILY_ROWS = """
  SELECT city_key, id, number AS value, "date", name
  FROM daily LEFT JOIN station USING (city_key, id)
  WHERE "date" BETWEEN DATE '{}' AND DATE '{}'"""
_oracle("daily_by_station", "daily station", _DAILY_ROWS.format("2024-01-01", "2024-01-31"))
_oracle("daily_by_station_forward", "daily station",
        _DAILY_ROWS.format("2024-01-20", "2024-01-27"))
_oracle("daily_by_station_nested", "daily station", f"""
  SELECT city_key, id, name,
    list(strftime("date", '%Y-%m-%d') ORDER BY "date") AS "date",
    list(value ORDER BY "date") AS value
  FROM ({_DAILY_ROWS.format("2024-01-01", "2024-01-31")}) GROUP BY city_key, id, name""")


def _top(order: str, start: str, stop: str) -> str:
    return f"""
  SELECT d.city_key, d.id, d.number AS value, d."date", s.name, CAST(t.rank AS INTEGER) AS rank
  FROM (
    SELECT city_key, id, row_number() OVER (PARTITION BY city_key ORDER BY {order}) AS rank
    FROM daily WHERE "date" = DATE '2024-01-20' QUALIFY rank <= 20) AS t
  JOIN daily AS d ON d.city_key = t.city_key AND d.id = t.id
  LEFT JOIN station AS s ON s.city_key = d.city_key AND s.id = d.id
  WHERE d."date" BETWEEN DATE '{start}' AND DATE '{stop}'"""


_BY_VALUE = "number DESC, id"
_oracle("daily_top_value", "daily station", _top(_BY_VALUE, "2024-01-13", "2024-01-20"))
_oracle("daily_top_station", "daily station", _top("id", "2024-01-20", "2024-01-27"))
_NEST_TOP = """
  SELECT city_key, id, name, rank,
    list(strftime("date", '%Y-%m-%d') ORDER BY "date") AS "date",
    list(value ORDER BY "date") AS value
  FROM ({}) GROUP BY city_key, id, name, rank"""
_oracle("daily_top_nested", "daily station",
        _NEST_TOP.format(_top(_BY_VALUE, "2024-01-13", "2024-01-20")))
_oracle("lake_api", "daily station",
        _NEST_TOP.format(_top(_BY_VALUE, "2024-01-20", "2024-01-20")))
_oracle("colour_scale", "daily station", f"""
  SELECT *, (value - 0.7::DOUBLE * min(value) OVER w)
    / nullif(max(value) OVER w - 0.7::DOUBLE * min(value) OVER w, 0) AS scale
  FROM ({_top(_BY_VALUE, "2024-01-20", "2024-01-20")}) WINDOW w AS (PARTITION BY city_key)""")

_SERIES = """
  SELECT r.*, s.name, s.nb_stations AS nb_stands
  FROM readings AS r LEFT JOIN station AS s USING (city_key, id)
  WHERE "timestamp" >= TIMESTAMP '2024-01-01' AND "timestamp" < TIMESTAMP '{}'"""
_oracle("timeseries_rows", "readings station", _SERIES.format("2024-01-31"))
_oracle("readings_store", "readings station", _SERIES.format("2024-01-20"))


def _nested(days: int, where: str = "TRUE") -> str:
    return f"""
  SELECT city_key, id, piece, list(strftime("timestamp", '%Y-%m-%dT%H:%M:%S') ORDER BY n) AS ts,
    list(status ORDER BY n) AS status, list(available_bikes ORDER BY n) AS available_bikes,
    list(available_stands ORDER BY n) AS available_stands, name, nb_stands
  FROM (
    SELECT *, CAST(floor(date_diff('second', TIMESTAMP '2024-01-01', "timestamp")
        / ({days} * 86400)) AS INTEGER) AS piece,
      row_number() OVER (PARTITION BY city_key, id
        ORDER BY "timestamp", available_bikes, available_stands, status) AS n
    FROM ({_SERIES.format("2024-01-31")}))
  WHERE {where}
  GROUP BY city_key, id, piece, name, nb_stands"""


_oracle("timeseries_nested", "readings station", _nested(31))
_oracle("timeseries_pieces", "readings station", _nested(10))

_LATEST = """
  SELECT city_key, id, "timestamp", nb_bikes, name, nb_stations AS nb_stands, x, y
  FROM (
    SELECT *, rank() OVER (PARTITION BY city_key, id ORDER BY "timestamp" DESC) AS rk
    FROM (SELECT city_key, {} AS id, "timestamp", {} AS nb_bikes FROM {})
    WHERE "timestamp" >= TIMESTAMP '2024-01-29')
  JOIN station USING (city_key, id) WHERE rk = 1"""
_NOW = _LATEST.format("id", "available_bikes", "readings")
_oracle("latest_availability", "readings station", _NOW)
_oracle("latest_availability_date", "readings station",
        f"""SELECT max("timestamp") AS "date" FROM ({_NOW})""")
_LATEST_PROPERTIES = " || ',' || ".join([
    _text("id"), _text("name"),
    _text("timestamp", "strftime(\"timestamp\", '%Y-%m-%dT%H:%M:%S')"),
    "'\"nb_bikes\":' || nb_bikes", "'\"nb_stands\":' || nb_stands"])
_oracle("latest_geojson", "readings station", _feature(_LATEST_PROPERTIES, f"({_NOW})"))
_oracle("fill_ratio", "readings station", f"""
  SELECT *, CAST(nb_bikes AS DOUBLE) / nullif(nb_stands, 0) AS ratio
  FROM ({_NOW})""")
_oracle("latest_prediction", "prediction station",
        _LATEST.format("station_id", "nb_bikes", "prediction"))

_table("open_rows", "readings", """
  SELECT DISTINCT city_key, id AS station_id, "timestamp" AS ts, available_bikes AS nb_bikes,
    available_stands AS nb_stands, CAST(available_bikes AS DOUBLE)
      / (CAST(available_bikes AS DOUBLE) + CAST(available_stands AS DOUBLE)) AS probability
  FROM readings
  WHERE "timestamp" >= TIMESTAMP '2024-01-01' AND "timestamp" < TIMESTAMP '2024-01-31'
    AND (available_bikes > 0 OR available_stands > 0) AND status = 'open'""")
_oracle("training_readings", "open_rows", "SELECT * FROM open_rows")
_oracle("latest_in_window", "open_rows", """
  SELECT * FROM open_rows
  QUALIFY rank() OVER (PARTITION BY city_key, station_id ORDER BY ts DESC) = 1""")
_oracle("calendar_features", "open_rows", """
  SELECT city_key, station_id, ts, CAST(isodow(ts) - 1 AS INTEGER) AS "day",
    CAST(hour(ts) AS INTEGER) AS "hour", CAST(minute(ts) AS INTEGER) AS "minute"
  FROM open_rows""")
_oracle("dock_rounding", "open_rows", """
  SELECT city_key, station_id, ts,
    CAST(trunc((nb_bikes + nb_stands) * (probability / 3)) AS INTEGER) AS pred_bikes,
    CAST(nb_bikes + nb_stands
      - trunc((nb_bikes + nb_stands) * (probability / 3)) AS INTEGER) AS pred_stands
  FROM open_rows""")

# Predictions -----------------------------------------------------------------

_table("predicted", "prediction station", """
  SELECT p.city_key, p.station_id AS id, p."timestamp", p.nb_bikes,
    s.nb_stations AS nb_stands, s.name, '1H' AS "at"
  FROM prediction AS p JOIN station AS s ON s.city_key = p.city_key AND s.id = p.station_id
  WHERE frequency = '1H' AND "timestamp" >= TIMESTAMP '2024-01-01'
    AND "timestamp" < TIMESTAMP '2024-02-01'""")
_LAST = """
  SELECT * FROM predicted QUALIFY row_number() OVER (
    PARTITION BY {} ORDER BY id DESC, "timestamp" DESC, nb_bikes DESC) <= 5"""
_oracle("prediction_all", "predicted", "SELECT * FROM predicted")
_oracle("prediction_tail_per_station", "predicted", _LAST.format("city_key, id"))
_oracle("prediction_tail", "predicted readings", f"""
  SELECT DISTINCT r.city_key, r.id, r."timestamp", r.available_bikes AS nb_bikes,
    s.nb_stations AS nb_stands, s.name, '0' AS "at"
  FROM readings AS r LEFT JOIN station AS s USING (city_key, id)
  WHERE "timestamp" >= TIMESTAMP '2024-01-01' AND "timestamp" < TIMESTAMP '2024-02-01'
  UNION ALL SELECT * FROM ({_LAST.format("city_key")})""")

# Profiles --------------------------------------------------------------------

_table("hourly", "readings station", """
  SELECT g.city_key, g.id, CAST(hour(g.slot) AS INTEGER) AS "hour",
    CAST(sum(coalesce(b.total, 0)) AS DOUBLE) AS "sum",
    round(avg(coalesce(b.total, 0)), 6) AS mean
  FROM (
    SELECT city_key, id, unnest(generate_series(min(slot), max(slot), INTERVAL 1 HOUR)) AS slot
    FROM (SELECT * FROM steps WHERE d IS NOT NULL) GROUP BY city_key, id) AS g
  LEFT JOIN (
    SELECT city_key, id, slot, sum(d) AS total FROM steps GROUP BY ALL) AS b
    USING (city_key, id, slot)
  GROUP BY g.city_key, g.id, "hour" """)
_table("steps", "readings", """
  SELECT city_key, id, date_trunc('hour', "timestamp") AS slot,
    abs(available_bikes - lag(available_bikes) OVER (PARTITION BY city_key, id
      ORDER BY "timestamp", available_bikes, available_stands)) AS d
  FROM readings
  WHERE "timestamp" >= TIMESTAMP '2024-01-01' AND "timestamp" < TIMESTAMP '2024-01-31'""")
_COMMON["hourly"] = (("steps", "station"), _COMMON["hourly"][1])
_table("weekdays", "daily station", """
  SELECT city_key, id, name, CAST(isodow("date") - 1 AS INTEGER) AS "day",
    sum(number) AS "sum", round(avg(number), 6) AS mean
  FROM daily LEFT JOIN station USING (city_key, id)
  WHERE "date" BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' GROUP BY ALL""")
_HOURLY = "SELECT h.*, name FROM hourly AS h LEFT JOIN station USING (city_key, id)"
_NEST_PROFILE = """
  SELECT city_key, id, name, list("{0}" ORDER BY "{0}") AS "{0}",
    list("sum" ORDER BY "{0}") AS "sum", list(mean ORDER BY "{0}") AS mean
  FROM ({1}) GROUP BY city_key, id, name"""
_oracle("hourly_profile", "hourly", _HOURLY)
_oracle("hourly_profile_nested", "hourly", _NEST_PROFILE.format("hour", _HOURLY))
_oracle("daily_profile", "weekdays", "SELECT * FROM weekdays")
_oracle("daily_profile_nested", "weekdays",
        _NEST_PROFILE.format("day", "SELECT * FROM weekdays"))

# Chosen stations and limits --------------------------------------------------

_CHOSEN = "id IN ('1', '2', '3', '5', '8')"
_oracle("ids_many", "station", f"SELECT {_INFO} FROM station")
_oracle("daily_of_ids", "daily station",
        _DAILY_ROWS.format("2024-01-01", "2024-01-31") + f" AND {_CHOSEN}")
_oracle("timeseries_of_ids", "readings station", _nested(31, _CHOSEN))
_oracle("hourly_profile_of_ids", "hourly", f"SELECT * FROM ({_HOURLY}) WHERE {_CHOSEN}")
_oracle("daily_profile_of_ids", "weekdays", f"SELECT * FROM weekdays WHERE {_CHOSEN}")
_FIRST = "SELECT * FROM ({}) QUALIFY row_number() OVER (PARTITION BY city_key ORDER BY id) <= 20"
_oracle("latest_first", "readings station", _FIRST.format(_NOW))
_oracle("latest_first_geojson", "readings station", _feature(
    _LATEST_PROPERTIES, f"({_FIRST.format(_NOW)})"))
_oracle("latest_prediction_first", "prediction station",
        _FIRST.format(_LATEST.format("station_id", "nb_bikes", "prediction")))
_TAIL_OF = """
  SELECT * FROM (SELECT * FROM predicted WHERE {}) QUALIFY row_number() OVER (
    PARTITION BY {} ORDER BY id DESC, "timestamp" DESC, nb_bikes DESC) <= 5"""
_oracle("prediction_tail_of_each_id", "predicted", _TAIL_OF.format(_CHOSEN, "city_key, id"))
_oracle("prediction_tail_of_ids", "predicted readings station", f"""
  SELECT DISTINCT r.city_key, r.id, r."timestamp", r.available_bikes AS nb_bikes,
    s.nb_stations AS nb_stands, s.name, '0' AS "at"
  FROM readings AS r LEFT JOIN station AS s USING (city_key, id)
  WHERE "timestamp" >= TIMESTAMP '2024-01-01' AND "timestamp" < TIMESTAMP '2024-02-01'
    AND r.{_CHOSEN}
  UNION ALL SELECT * FROM ({_TAIL_OF.format(_CHOSEN, "city_key")})""")

# Grids -----------------------------------------------------------------------

_table("bins", "open_rows", """
  SELECT city_key, station_id, time_bucket(INTERVAL 10 MINUTE, ts) AS ts,
    avg(nb_bikes) AS nb_bikes, avg(nb_stands) AS nb_stands, avg(probability) AS probability
  FROM open_rows GROUP BY 1, 2, 3""")
_table("dense", "bins", """
  SELECT g.city_key, g.station_id, g.ts, b.nb_bikes, b.nb_stands, b.probability
  FROM (
    SELECT city_key, station_id,
      unnest(generate_series(min(ts), max(ts), INTERVAL 10 MINUTE)) AS ts
    FROM bins GROUP BY city_key, station_id) AS g
  ASOF JOIN bins AS b ON b.city_key = g.city_key AND b.station_id = g.station_id
    AND g.ts <= b.ts""")
_GRID = """city_key, station_id, ts, round(nb_bikes, 6) AS nb_bikes,
    round(nb_stands, 6) AS nb_stands, round(probability, 6) AS probability"""


def _future(table: str) -> str:
    return f"""
  SELECT a.*, b.probability AS future FROM {table} AS a JOIN {table} AS b
    ON a.city_key = b.city_key AND a.station_id = b.station_id
    AND b.ts = a.ts + INTERVAL 30 MINUTE"""


_oracle("resample_10min", "bins", f"SELECT {_GRID} FROM bins")
_oracle("backfill_grid", "dense", f"SELECT {_GRID} FROM dense")
_oracle("future_label_join", "bins", f"""
  SELECT {_GRID}, round(future, 6) AS future FROM ({_future("bins")})""")
_LABELLED = f"""
  SELECT *, CAST(isodow(ts) - 1 AS INTEGER) AS "day", CAST(hour(ts) AS INTEGER) AS "hour",
    CAST(minute(ts) AS INTEGER) AS "minute" FROM ({_future("dense")})"""
# on a dense grid the partner is three steps ahead
_oracle("future_label", "dense", f"""
  SELECT {_GRID}, round(future, 6) AS future
  FROM (
    SELECT *, lead(probability, 3) OVER w AS future, lead(ts, 3) OVER w AS partner
    FROM dense WINDOW w AS (PARTITION BY city_key, station_id ORDER BY ts))
  WHERE partner IS NOT NULL""")
_oracle("train_split", "dense", f"""
  SELECT part, city_key, station_id, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts,
    round(sum(nb_bikes), 6) AS bikes, round(sum(future), 6) AS future,
    CAST(sum("day" * 1440 + "hour" * 60 + "minute") AS BIGINT) AS minutes
  FROM (
    SELECT 'train' AS part, * FROM ({_LABELLED})
    WHERE ts >= TIMESTAMP '2024-01-01' AND ts <= TIMESTAMP '2024-01-24 23:30:00'
    UNION ALL SELECT 'test' AS part, * FROM ({_LABELLED})
    WHERE ts BETWEEN TIMESTAMP '2024-01-25' AND TIMESTAMP '2024-01-25 01:00:00')
  GROUP BY part, city_key, station_id""")

_table("fine_bins", "readings", """
  SELECT city_key, id AS station_id, time_bucket(INTERVAL 5 MINUTE, "timestamp") AS ts,
    avg(available_bikes) AS nb_bikes
  FROM readings
  WHERE "timestamp" >= TIMESTAMP '2024-01-01' AND "timestamp" < TIMESTAMP '2024-01-31'
    AND (city_key, id) IN (
      SELECT (city_key, id) FROM readings
      WHERE "timestamp" >= TIMESTAMP '2024-01-01' AND "timestamp" < TIMESTAMP '2024-01-31'
      GROUP BY city_key, id HAVING max(available_bikes) > 0)
  GROUP BY 1, 2, 3""")
_table("matrix", "fine_bins", """
  SELECT city_key, station_id, "hour",
    value / nullif(max(value) OVER (PARTITION BY city_key, station_id), 0) AS value
  FROM (
    SELECT g.city_key, g.station_id, CAST(hour(g.ts) AS INTEGER) AS "hour",
      avg(b.nb_bikes) AS value
    FROM (
      SELECT city_key, station_id,
        unnest(generate_series(min(ts), max(ts), INTERVAL 5 MINUTE)) AS ts
      FROM fine_bins GROUP BY city_key, station_id) AS g
    ASOF JOIN fine_bins AS b ON b.city_key = g.city_key AND b.station_id = g.station_id
      AND g.ts <= b.ts
    WHERE isodow(g.ts) <= 5
    GROUP BY 1, 2, 3)""")
_oracle("cluster_matrix", "matrix", """
  SELECT city_key, station_id, "hour", round(value, 6) AS value FROM matrix""")
_oracle("cluster_matrix_wide", "matrix", f"""
  SELECT city_key, station_id, {", ".join(
      f'round(max(value) FILTER ("hour" = {h}), 6) AS {name}'
      for h, name in enumerate(_HOURS))}
  FROM matrix GROUP BY city_key, station_id""")

# Clusters --------------------------------------------------------------------

_LATEST_CLUSTERS = """
  SELECT c.city_key, c.station_id AS id, c.cluster_id, c."start", c."stop", s.name, s.x, s.y
  FROM clustering AS c JOIN station AS s ON s.city_key = c.city_key AND s.id = c.station_id
  QUALIFY rank() OVER (PARTITION BY c.city_key ORDER BY c."stop" DESC) = 1"""
_oracle("latest_clusters", "clustering", _LATEST_CLUSTERS)
_oracle("clusters_of_ids", "clustering", f"""
  SELECT * FROM ({_LATEST_CLUSTERS}) WHERE {_CHOSEN}""")
_oracle("cluster_geojson", "clustering", _feature(
    " || ',' || ".join([
        _text("id"), _text("cluster_id"), _text("name"),
        _text("start", "strftime(\"start\", '%Y-%m-%d')"),
        _text("stop", "strftime(\"stop\", '%Y-%m-%d')")]),
    f"({_LATEST_CLUSTERS})"))
_table("shape", "centroid", """
  SELECT city_key, "start", "stop", cluster_id, stddev_samp(v) AS spread,
    any_value(h21 - h04) AS gain, any_value(h06) AS dawn
  FROM (SELECT *, unnest([""" + ", ".join(_HOURS) + """]) AS v FROM centroid)
  GROUP BY city_key, "start", "stop", cluster_id""")
_table("labels", "shape", """
  SELECT city_key, "start", "stop", cluster_id,
    CASE WHEN is_high THEN 'high' WHEN is_evening THEN 'evening'
      WHEN row_number() OVER (PARTITION BY city_key, "start", "stop"
        ORDER BY is_high OR is_evening, dawn, cluster_id) = 1 THEN 'noon'
      ELSE 'morning' END AS label
  FROM (
    SELECT *, row_number() OVER (PARTITION BY city_key, "start", "stop"
      ORDER BY is_high, gain DESC, cluster_id) = 1 AS is_evening
    FROM (
      SELECT *, row_number() OVER (PARTITION BY city_key, "start", "stop"
        ORDER BY spread, cluster_id) = 1 AS is_high
      FROM shape))""")
_oracle("cluster_labels", "labels", "SELECT * FROM labels")
_oracle("cluster_profiles", "labels centroid", f"""
  SELECT city_key, cluster_id, label, strftime("start", '%Y-%m-%d') AS "start",
    strftime("stop", '%Y-%m-%d') AS "stop",
    list_transform(generate_series(0, 23), lambda h: CAST(h AS INTEGER)) AS "hour",
    [{", ".join(_HOURS)}] AS "values"
  FROM centroid JOIN labels USING (city_key, "start", "stop", cluster_id)
  QUALIFY rank() OVER (PARTITION BY city_key ORDER BY "stop" DESC) = 1""")

# Sources ---------------------------------------------------------------------

_SNAPSHOT = "CAST(CAST(ts AS DATE) AS VARCHAR) AS snapshot"
_oracle("gml_feed", "sourced", f"""
  SELECT 'bordeaux' AS city_key, id, ts AS "timestamp", stands AS available_stands,
    bikes AS available_bikes,
    CASE WHEN event_type = 'error' THEN 'closed' ELSE 'open' END AS status, {_SNAPSHOT}
  FROM sourced""")
_oracle("geojson_feed", "sourced", f"""
  SELECT 'lyon' AS city_key, id, ts AS "timestamp",
    CASE WHEN event_type <> 'view' THEN stands END AS available_stands,
    CASE WHEN event_type <> 'click' THEN bikes END AS available_bikes,
    CASE WHEN event_type = 'error' THEN 'closed' ELSE 'open' END AS status, {_SNAPSHOT}
  FROM sourced""")
_table("gappy", "sourced", f"""
  SELECT city_key, {_SNAPSHOT}, id, ts AS "timestamp",
    CASE WHEN event_type <> 'view' THEN stands END AS available_stands,
    CASE WHEN event_type <> 'click' THEN bikes END AS available_bikes, event_type AS status
  FROM sourced""")


def _fill(partition: str, where: str) -> str:
    return f"""
  SELECT * FROM (
    SELECT city_key, snapshot, id, "timestamp",
      first_value(available_stands IGNORE NULLS) OVER w AS available_stands,
      first_value(available_bikes IGNORE NULLS) OVER w AS available_bikes, status
    FROM gappy WINDOW w AS (PARTITION BY {partition} ORDER BY id, "timestamp", status
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
  WHERE {where}"""


_KNOWN = "available_stands IS NOT NULL AND available_bikes IS NOT NULL"
_oracle("snapshot_fill", "gappy", _fill("snapshot", _KNOWN))
_oracle("snapshot_rejects", "gappy", _fill("snapshot", f"NOT ({_KNOWN})"))
_oracle("station_fill", "gappy", _fill("snapshot, id", _KNOWN))
_oracle("status_recode", "sourced", """
  SELECT 'bordeaux' AS city_key, id, ts AS "timestamp", stands AS available_stands,
    bikes AS available_bikes,
    CASE WHEN event_type = 'view' THEN 'open' ELSE 'closed' END AS status
  FROM sourced""")
_oracle("load_guard", "gappy", """
  SELECT city_key, snapshot, id, "timestamp", available_stands, available_bikes, status
  FROM gappy WHERE status <> 'signup' AND available_stands IS NOT NULL""")

_E = "0.08181919104281579"
_STEP = (
    "SELECT *, pi() / 2 - 2 * atan(t * power((1 - {e} * sin({old})) / (1 + {e} * sin({old})),"
    " {e} / 2)) AS {new} FROM ({source})"
)


def _latitude() -> str:
    source = f"""
    SELECT *, pi() / 2 - 2 * atan(t) AS p0 FROM (
      SELECT *, power(sqrt(dx * dx + dy * dy)
        / (6378137.0::DOUBLE * 1.8428979224021065::DOUBLE), 1 / 0.7256077650532695::DOUBLE) AS t
      FROM (
        SELECT *, 410000.0::DOUBLE + 25 * (c_custkey % 1000) - 700000 AS dx,
          6055612.049875985::DOUBLE
            - (6415000.0::DOUBLE + 25 * (c_custkey // 1000) - 6600000) AS dy
        FROM customer))"""
    for step in range(5):
        source = _STEP.format(
            e=f"{_E}::DOUBLE", old=f"p{step}", new=f"p{step + 1}", source=source
        )
    return source


_oracle("reproject", "station", f"""
  SELECT 'bordeaux' AS city_key, CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
    c_mktsegment AS address, 'bordeaux' AS city, CAST(40 AS INTEGER) AS nb_stations,
    round(degrees(atan2(dx, dy) / 0.7256077650532695::DOUBLE) + 3, 6) AS x,
    round(degrees(p5), 6) AS y
  FROM ({_latitude()})""")

_POINT = "c_custkey % 30 <> 3"
_WHOLE = "c_custkey // 200 <> 2"  # the extract that was cut is lost
_oracle("station_files", "station", f'''
  SELECT city_key, CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS address,
    city_key AS city, CASE WHEN c_custkey % 30 <> 2 THEN CAST(40 AS INTEGER) END AS nb_stations,
    CASE WHEN {_POINT} THEN round(x, 6) END AS x, CASE WHEN {_POINT} THEN round(y, 6) END AS y
  FROM (
    SELECT 'bordeaux' AS city_key, c_custkey, c_name, c_mktsegment,
      degrees(atan2(dx, dy) / 0.7256077650532695::DOUBLE) + 3 AS x, degrees(p5) AS y
    FROM ({_latitude()})
    UNION ALL SELECT 'lyon', c_custkey, c_name, c_mktsegment,
      4.7::DOUBLE + 0.005::DOUBLE * (c_custkey % 40),
      45.7::DOUBLE + 0.005::DOUBLE * (c_custkey // 40)
    FROM customer)
  WHERE {_WHOLE} AND c_custkey % 30 <> 1''')
_oracle("station_file_rejects", "station", f'''
  SELECT city_key, reason, n FROM (
    SELECT 'record' AS reason, count(*) AS n FROM customer WHERE {_WHOLE} AND c_custkey % 30 = 1
    UNION ALL SELECT 'field', count(*) FROM customer WHERE {_WHOLE} AND c_custkey % 30 IN (2, 3)
    UNION ALL SELECT 'document', count(DISTINCT c_custkey // 200) FROM customer
    WHERE NOT ({_WHOLE})) CROSS JOIN (VALUES ('lyon'), ('bordeaux')) AS c(city_key)
  WHERE n > 0''')

_WEATHER = """CAST(event_id AS INTEGER) AS weather_id, event_type AS weather_desc,
    round(value, 6) AS temp, round(value - 1, 6) AS temp_min, round(value + 1, 6) AS temp_max,
    round(value + 1000, 6) AS pressure, CAST(50 AS DOUBLE) AS humidity,
    round(value / 10, 6) AS wind_speed, CAST(floor(value) AS INTEGER) AS cloudiness"""
_oracle("weather_current", "sourced", f"""SELECT ts AS "date", {_WEATHER} FROM sourced""")
_oracle("weather_forecast", "sourced", f"""
  SELECT ts AS forecast_at, date_trunc('second', ts) + INTERVAL 1 HOUR AS ts, {_WEATHER},
    CASE WHEN event_type = 'view' THEN round(value, 6) END AS rain_3h,
    CAST(NULL AS DOUBLE) AS snow_3h
  FROM sourced""")

_MAINT = """CASE event_type WHEN 'error' THEN 'closed' WHEN 'signup' THEN 'MAINT'
    ELSE 'open' END AS status"""
_oracle("legacy_upgrade", "sourced", f"""
  SELECT id, ts AS "timestamp", stands AS available_stands, bikes AS available_bikes, {_MAINT}
  FROM sourced""")
_oracle("legacy_view", "sourced station", """
  SELECT DISTINCT CAST(e.user_id AS INTEGER) AS id, s.name, e.stands AS available_stand,
    e.bikes AS available_bike, e.ts
  FROM sourced AS e LEFT JOIN station AS s ON CAST(s.id AS INTEGER) = e.user_id""")
_oracle("legacy_centroids", "centroid", f"""
  SELECT city_key, cluster_id, "start", "stop",
    {", ".join(_HOURS)} FROM centroid""")

_oracle("centroid_long", "centroid", """
  SELECT city_key, cluster_id, "start", "stop", CAST(h AS INTEGER) AS "hour", v AS value
  FROM (
    SELECT city_key, cluster_id, "start", "stop", unnest(generate_series(0, 23)) AS h,
      unnest([""" + ", ".join(_HOURS) + """]) AS v
    FROM centroid)""")

_oracle("legacy_upgrade_bordeaux", "sourced", """
  SELECT id, ts AS "timestamp", stands AS available_stands, bikes AS available_bikes,
    CASE event_type WHEN 'error' THEN 'closed' WHEN 'signup' THEN 'MAINT' ELSE 'open' END
      AS status
  FROM sourced""")
_oracle("legacy_view_bordeaux", "sourced", """
  SELECT DISTINCT CAST(user_id AS INTEGER) AS id, event_type AS name,
    stands AS available_stand, bikes AS available_bike, ts
  FROM sourced""")

# Files -----------------------------------------------------------------------

_oracle("gml_files", "sourced", """
  SELECT 'bordeaux' AS city_key, id, ts AS "timestamp", stands AS available_stands,
    bikes AS available_bikes,
    CASE WHEN event_type = 'error' THEN 'closed' ELSE 'open' END AS status,
    'Méri ' || event_type AS nom
  FROM sourced""")
_oracle("geojson_files", "sourced", """
  SELECT 'lyon' AS city_key, id, ts AS "timestamp",
    CASE WHEN event_type <> 'view' THEN stands END AS available_stands,
    CASE WHEN event_type <> 'click' THEN bikes END AS available_bikes,
    CASE WHEN event_type = 'error' THEN 'closed' ELSE 'open' END AS status
  FROM sourced""")
_table("documents_of_days", "sourced", """
  SELECT CAST(ts AS DATE) AS "day", user_id % 4 AS quarter, bikes, event_type = 'signup' AS damaged,
    day(ts) % 5 = 0 AS cut,
    event_id = max(event_id) OVER (PARTITION BY CAST(ts AS DATE), user_id % 4) AS is_last
  FROM sourced""")
_DAMAGE = """
  SELECT 'bordeaux' AS city_key, "day", count(*) FILTER (kept) AS readings,
    CAST(coalesce(sum(bikes) FILTER (kept AND NOT damaged), 0) AS BIGINT) AS bikes,
    count(*) FILTER (cut AND is_last) AS cut, count(*) FILTER (kept AND damaged) AS fields,
    0::BIGINT AS records
  FROM (SELECT *, NOT (cut AND is_last) AS kept FROM documents_of_days) GROUP BY "day"
  UNION ALL
  SELECT 'lyon' AS city_key, "day", count(*) FILTER (NOT cut),
    CAST(coalesce(sum(bikes) FILTER (NOT cut AND NOT damaged), 0) AS BIGINT),
    count(*) FILTER (cut AND is_last), count(*) FILTER (NOT cut AND damaged), 0::BIGINT
  FROM documents_of_days GROUP BY "day\""""
_oracle("feed_rejects", "documents_of_days", _DAMAGE)
_oracle("feed_rejects_stream", "documents_of_days",
        f"SELECT * EXCLUDE (bikes) FROM ({_DAMAGE})")
_oracle("weather_files", "sourced", f"""
  SELECT TIMESTAMP '2024-01-31' AS "date", {_WEATHER}, 'lyon' AS city_key FROM sourced""")
_oracle("weather_forecast_files", "sourced", f"""
  SELECT TIMESTAMP '2024-01-31' AS forecast_at,
    date_trunc('second', ts) + INTERVAL 1 HOUR AS ts, {_WEATHER},
    CAST(NULL AS DOUBLE) AS rain_3h, CAST(NULL AS DOUBLE) AS snow_3h, 'lyon' AS city_key
  FROM sourced""")
_oracle("roll_up_csv", "daily", """
  SELECT id, number, "date" FROM daily WHERE "date" = DATE '2024-01-20'""")
_oracle("predictions_csv", "prediction", """
  SELECT "timestamp", '1H' AS frequency, station_id, availability, nb_bikes, nb_stands
  FROM prediction""")

# Fits ------------------------------------------------------------------------

# Shape s is full (1.0) in its hours and 0.1 in the others; centres are numbered in the
# order of their hours: 2 and 3 start low, and of them 3 stays low longer.
_oracle("kmeans_shapes", "station", """
  SELECT city_key, id AS station_id, DATE '2024-01-01' AS "start", DATE '2024-01-31' AS "stop",
    CASE CAST(id AS INTEGER) % 4 WHEN 3 THEN '0' WHEN 2 THEN '1' WHEN 1 THEN '2' ELSE '3' END
      AS cluster_id,
    CASE CAST(id AS INTEGER) % 4 WHEN 3 THEN 'evening' WHEN 2 THEN 'noon' WHEN 1 THEN 'morning'
      ELSE 'high' END AS label
  FROM station""")
_table("places", "station", """
  SELECT city_key, station_id, lat, lon,
    CAST(dense_rank() OVER (PARTITION BY city_key ORDER BY CAST(floor(lat) AS INTEGER)) - 1
      AS INTEGER) AS cluster_id
  FROM (
    SELECT city_key, id AS station_id,
      CAST(id AS INTEGER) % 12 * 7 % 12
        + 0.0001::DOUBLE * (CAST(id AS INTEGER) // 12 % 10) AS lat,
      CAST(CAST(id AS INTEGER) % 12 * 5 % 12 + 40 AS DOUBLE) AS lon
    FROM station)""")
_oracle("geo_store", "places", "SELECT city_key, station_id, cluster_id FROM places")
_oracle("geo_centroid_store", "places", """
  SELECT city_key, cluster_id, round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon
  FROM places GROUP BY city_key, cluster_id""")
_oracle("kmeans_geo_check", "station", """
  SELECT city_key, count(*) AS n, 0::BIGINT AS misplaced, 12::BIGINT AS centres,
    0::BIGINT AS off_centre
  FROM station GROUP BY city_key""")
_oracle("kmeans_profiles_check", "matrix", """
  SELECT city_key, count(*) AS n, 0::BIGINT AS misplaced, 4::BIGINT AS centres,
    0::BIGINT AS off_centre
  FROM (
    SELECT city_key, station_id FROM matrix WHERE value IS NOT NULL
    GROUP BY city_key, station_id HAVING count(DISTINCT "hour") = 24)
  GROUP BY city_key""")
_oracle("forecast_check", "open_rows", """
  SELECT city_key, count(DISTINCT station_id) AS stations, 0::BIGINT AS bad, TRUE AS beaten
  FROM open_rows GROUP BY city_key""")

_oracle("forecast_loss", "dense", f"""
  SELECT city_key, part, count(*) AS n, TRUE AS agrees, TRUE AS falls
  FROM (
    SELECT 'train' AS part, * FROM ({_LABELLED}) WHERE ts <= TIMESTAMP '2024-01-24 23:30:00'
    UNION ALL SELECT 'test' AS part, * FROM ({_LABELLED})
    WHERE ts BETWEEN TIMESTAMP '2024-01-25' AND TIMESTAMP '2024-01-25 01:00:00')
  GROUP BY city_key, part""")

# Rebase ----------------------------------------------------------------------

_oracle("rebase_readings", "readings", """
  SELECT * REPLACE ("timestamp" + (TIMESTAMP '2024-01-31'
    - (SELECT max("timestamp") FROM readings)) AS "timestamp") FROM readings""")
_oracle("rebase_daily", "daily", """
  SELECT * REPLACE ("date" + CAST(DATE '2024-01-31'
    - (SELECT max("date") FROM daily) AS INTEGER) AS "date") FROM daily""")

# Sinks -----------------------------------------------------------------------

_oracle("daily_store", "daily", "SELECT * FROM daily")
_oracle("prediction_store", "prediction", """
  SELECT * REPLACE (CASE WHEN nb_bikes < 10 THEN 0.5::DOUBLE ELSE availability END
    AS availability) FROM prediction""")
_oracle("snapshot_csv", "readings", """
  SELECT id, "timestamp", available_stands, available_bikes, status, city_key FROM readings""")
_oracle("centroid_store", "centroid", "SELECT * FROM centroid")
_oracle("cluster_store", "clustering", "SELECT * FROM clustering")
_oracle("station_store", "station", "SELECT * FROM station")
_oracle("json_export", "daily", """
  SELECT '{"city_key":"' || city_key || '","id":"' || id || '","number":'
    || CAST(number AS VARCHAR) || ',"date":"' || CAST("date" AS VARCHAR) || '"}' AS json
  FROM daily""")

# Streams ---------------------------------------------------------------------

_oracle("stream_daily_transactions", "daily", "SELECT * FROM daily")
_oracle("stream_dedup", "readings", "SELECT DISTINCT * FROM readings")
_oracle("stream_window_means", "readings", """
  SELECT city_key, id, time_bucket(INTERVAL 10 MINUTE, "timestamp") AS ts,
    round(avg(available_bikes), 6) AS mean_bikes, min(available_bikes) AS min_bikes,
    max(available_bikes) AS max_bikes
  FROM readings GROUP BY 1, 2, 3""")
_oracle("stream_latest", "readings", """
  SELECT * FROM readings
  QUALIFY rank() OVER (PARTITION BY city_key, id ORDER BY "timestamp" DESC) = 1""")
_table("landed", "readings", """
  SELECT * FROM readings
  UNION SELECT * REPLACE (available_bikes + 1 AS available_bikes) FROM readings
  UNION SELECT * REPLACE ("timestamp" + INTERVAL 3 DAY AS "timestamp") FROM readings
  UNION SELECT * REPLACE ("timestamp" - INTERVAL 3 DAY AS "timestamp") FROM readings""")
_oracle("stream_ingest_batches", "landed", "SELECT * FROM landed")
_oracle("readings_compacted", "readings", "SELECT DISTINCT * FROM readings")

# Stored hours ----------------------------------------------------------------

_table("scoped", "readings", """
  SELECT DISTINCT city_key, id, 'all' AS scope, "timestamp", available_bikes, available_stands
  FROM readings
  UNION ALL SELECT DISTINCT city_key, id, 'open', "timestamp", available_bikes, available_stands
  FROM readings WHERE status = 'open'""")
_oracle("hours_store", "scoped", """
  SELECT city_key, id, scope, slot AS bucket, CAST(coalesce(sum(d), 0) AS BIGINT) AS total,
    arg_min(available_bikes, place) AS first_value,
    arg_max(available_bikes, place) AS last_value, count(*) AS readings
  FROM (
    SELECT *, row_number() OVER hour AS place,
      abs(available_bikes - lag(available_bikes) OVER hour) AS d
    FROM (SELECT *, date_trunc('hour', "timestamp") AS slot FROM scoped)
    WINDOW hour AS (PARTITION BY city_key, id, scope, slot
      ORDER BY "timestamp", available_bikes, available_stands))
  GROUP BY city_key, id, scope, slot""")
_oracle("daily_of_hours", "daily", "SELECT * FROM daily")
_oracle("hourly_profile_of_hours", "hourly", _HOURLY)
_oracle("stream_late_transactions", "landed", _DAILY.format("landed"))
