"""DuckDB SQL for the queries, composed from shared parts."""

from __future__ import annotations

GPS = """gps AS (SELECT concat('vehicle-', lpad(cast(user_id AS varchar), 6, '0')) AS vehicle,
  1704067200 + (epoch_us(ts) - 1704067200000000) // 120000000 + (user_id % 3) * 86400 + (user_id % 4) * 18000 AS datetime,
  CASE WHEN event_id % 53 = 5 THEN NULL ELSE 106.39e0 + ((user_id * 37) % 711) / 1000e0 + ((event_id * 7919) % 21 - 10) / 2000e0 END AS x,
  CASE WHEN event_id % 59 = 6 THEN NULL ELSE 10.29e0 + ((user_id * 53) % 911) / 1000e0 + ((event_id * 104729) % 21 - 10) / 2000e0 END AS y,
  CASE WHEN event_id % 17 = 3 THEN NULL WHEN event_id % 101 = 4 THEN -value ELSE value END AS speed,
  CASE WHEN event_id % 11 = 2 THEN NULL ELSE cast((event_id * 131) % 360 AS double) END AS heading,
  CASE WHEN event_id % 23 = 9 THEN NULL ELSE event_id % 3 <> 0 END AS ignition,
  CASE WHEN event_id % 29 = 9 THEN NULL ELSE event_id % 4 = 0 END AS aircon,
  event_id % 5 <> 0 AS working,
  CASE WHEN event_id % 7 = 1 THEN NULL ELSE event_id % 2 = 0 END AS doorUp,
  CASE WHEN event_id % 7 = 1 THEN NULL ELSE event_id % 6 = 0 END AS doorDown,
  concat('driver-', cast(user_id % 97 AS varchar)) AS driver, event_id, copy
  FROM (SELECT 0 AS copy, * FROM events UNION ALL SELECT 1 AS copy, * FROM events WHERE event_id % 50 = 7) u),
routes AS (SELECT concat('vehicle-', lpad(cast(c_custkey AS varchar), 6, '0')) AS vehicle, concat('R', cast(c_nationkey AS varchar)) AS route_id, cast(c_nationkey AS varchar) AS route_no
  FROM customer WHERE c_mktsegment <> 'FURNITURE'),
checked AS (SELECT *, CASE WHEN x IS NULL OR y IS NULL THEN 'NULL_COORDS' WHEN x < 106.4e0 OR x > 107.1e0 THEN 'LON_OUT_OF_BOUNDS' WHEN y < 10.3e0 OR y > 11.2e0 THEN 'LAT_OUT_OF_BOUNDS'
  WHEN speed < 0 THEN 'NEGATIVE_SPEED' WHEN speed > 120 THEN 'HARDWARE_FAULT_SPEED' END AS reason FROM gps),
valid AS (SELECT * EXCLUDE (reason) FROM checked WHERE reason IS NULL),
dedup AS (SELECT * FROM valid QUALIFY row_number() OVER (PARTITION BY vehicle, datetime ORDER BY event_id, copy) = 1),
silver AS (SELECT d.*, coalesce(route_no, 'UNKNOWN') AS routeNo, coalesce(route_id, '0') AS routeId FROM dedup d LEFT JOIN routes USING (vehicle))"""


def km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return f"(6371e0 * {angle(lat1, lon1, lat2, lon2)})"


def angle(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    return f"(2 * atan2(sqrt({a}), sqrt(1 - {a})))"


_LAG = ", ".join(f"lag({c}) OVER w AS p{c}" for c in ("x", "y", "datetime", "heading"))
ANOMALIES = f""", lagged AS (SELECT *, {_LAG} FROM silver WINDOW w AS (PARTITION BY vehicle ORDER BY datetime, event_id, copy)),
measured AS (SELECT *, {km('py', 'px', 'y', 'x')} AS distance_km, datetime - pdatetime AS seconds_from_prev FROM lagged WHERE pdatetime IS NOT NULL),
flagged AS (SELECT *, coalesce(speed > 80, false) AS speed_excess, coalesce(seconds_from_prev > 0 AND seconds_from_prev <= 30 AND distance_km > 0.5e0, false) AS gps_jump FROM measured),
anomalies AS (SELECT *, CASE WHEN speed_excess THEN 'SPEED_EXCESS' ELSE 'GPS_JUMP' END AS category FROM flagged WHERE speed_excess OR gps_jump)"""

SLIDING = """, ends AS (SELECT *, unnest(range(datetime - datetime % 30 + 30, datetime - datetime % 30 + 330, 30)) AS window_end FROM silver),
speeds AS (SELECT routeNo AS route_no, window_end * 1000 AS window_end_ms, coalesce(avg(speed), 0) AS avg_speed, coalesce(min(speed), 0) AS min_speed, coalesce(max(speed), 0) AS max_speed,
  count(*) AS vehicle_count, count(*) AS event_count, count(DISTINCT vehicle) AS distinct_vehicle_count FROM ends GROUP BY ALL),
latest AS (SELECT * FROM speeds QUALIFY row_number() OVER (PARTITION BY route_no ORDER BY window_end_ms DESC) = 1)"""

TRIPS = f""", lagged AS (SELECT *, {_LAG} FROM silver WINDOW w AS (PARTITION BY vehicle ORDER BY datetime, event_id, copy)),
marked AS (SELECT *, pdatetime IS NULL OR datetime - pdatetime > 300 AS is_new, {km('py', 'px', 'y', 'x')} AS step_km FROM lagged),
numbered AS (SELECT *, sum(is_new::INT) OVER (PARTITION BY vehicle ORDER BY datetime, event_id, copy) AS trip FROM marked),
trips AS (SELECT vehicle, first(routeNo ORDER BY datetime, event_id, copy) AS route_no, first(routeId ORDER BY datetime, event_id, copy) AS route_id, min(datetime) AS trip_start, max(datetime) AS trip_end,
  max(datetime) - min(datetime) AS duration_s, count(*) AS event_count, coalesce(sum(step_km) FILTER (WHERE NOT is_new), 0) AS total_distance_km, coalesce(avg(speed) FILTER (WHERE NOT is_new), 0) AS avg_speed,
  count(*) FILTER (WHERE NOT is_new AND speed < 2) AS stop_count, first(x ORDER BY datetime, event_id, copy) AS start_lon, first(y ORDER BY datetime, event_id, copy) AS start_lat,
  last(x ORDER BY datetime, event_id, copy) AS end_lon, last(y ORDER BY datetime, event_id, copy) AS end_lat FROM numbered GROUP BY vehicle, trip),
good AS (SELECT *, duration_s / 60e0 AS duration_min, CAST(trip_start // 3600 % 24 AS INT) AS hour, strftime(make_timestamp(trip_start * 1000000), '%Y-%m-%d') AS date FROM trips WHERE duration_s / 60e0 BETWEEN 5 AND 180),
top15 AS (SELECT route_no, count(*) AS n FROM good GROUP BY 1 ORDER BY n DESC, route_no LIMIT 15)"""

FEATURES = f""", lagged AS (SELECT *, datetime - datetime % 3600 AS start, {_LAG} FROM silver WINDOW w AS (PARTITION BY vehicle, datetime - datetime % 3600 ORDER BY datetime, event_id, copy)),
stepped AS (SELECT *, {km('py', 'px', 'y', 'x')} AS step_km, datetime - pdatetime AS gap, CASE WHEN abs(heading - pheading) > 180 THEN 360 - abs(heading - pheading) ELSE abs(heading - pheading) END AS turn FROM lagged),
hours AS (SELECT vehicle, start, first(routeNo ORDER BY datetime, event_id, copy) AS route_no, count(*) AS event_count, coalesce(avg(speed), 0) AS avg_speed, coalesce(max(speed), 0) AS max_speed, coalesce(stddev_pop(speed), 0) AS std_speed,
  count(*) FILTER (WHERE speed < 2) / count(*) AS idle_fraction, coalesce(sum(step_km), 0) AS total_distance_km, coalesce(avg(gap), 0) AS avg_interval_s, coalesce(stddev_pop(gap), 0) AS std_interval_s,
  count(*) FILTER (WHERE turn > 45) AS heading_changes, count(*) FILTER (WHERE ignition) / count(*) AS ignition_fraction, count(*) FILTER (WHERE aircon) / count(*) AS aircon_fraction,
  CAST((start + 25200) // 3600 % 24 AS INT) AS hour_of_day FROM stepped GROUP BY vehicle, start),
features AS (SELECT vehicle, route_no, start * 1000 AS window_start_ms, hour_of_day, event_count, avg_speed, max_speed, std_speed, idle_fraction, total_distance_km, avg_interval_s, std_interval_s,
  sin(2 * pi() * hour_of_day / 24) AS hour_sin, cos(2 * pi() * hour_of_day / 24) AS hour_cos, heading_changes, ignition_fraction, aircon_fraction FROM hours)"""

GRID = """, grid AS (SELECT CAST(round_even(y / 0.005e0, 0) AS BIGINT) AS lat_cell, CAST(round_even(x / 0.005e0, 0) AS BIGINT) AS lon_cell, CAST(datetime // 3600 % 24 AS INT) AS hour, avg(speed) AS mean_speed, count(speed) AS count
  FROM silver GROUP BY ALL HAVING avg(speed) IS NOT NULL)"""

_LAST = ", ".join(f"last({c} ORDER BY datetime, event_id, copy) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in ("driver", "x", "y", "speed", "heading", "ignition", "aircon", "working", "doorUp", "doorDown", "routeNo", "routeId"))
STATE = f", state AS (SELECT vehicle, max(datetime) AS datetime, {_LAST} FROM silver GROUP BY vehicle)"

STOPS = """, kinds AS (SELECT *, CASE WHEN coalesce(speed, 0) < 2 THEN 'slow' WHEN coalesce(speed, 0) >= 5 THEN 'fast' END AS kind FROM silver),
turned AS (SELECT *, lag(kind) OVER (PARTITION BY vehicle ORDER BY datetime, event_id, copy) AS before FROM kinds WHERE kind IS NOT NULL),
edges AS (SELECT * FROM turned WHERE (kind = 'slow' AND coalesce(before, 'fast') = 'fast') OR (kind = 'fast' AND before = 'slow')),
paired AS (SELECT *, lag(y) OVER w AS lat, lag(x) OVER w AS lon, lag(datetime) OVER w AS start_ts FROM edges WINDOW w AS (PARTITION BY vehicle ORDER BY datetime, event_id, copy)),
stops AS (SELECT vehicle, lat, lon, datetime - start_ts AS duration_s, start_ts, datetime AS end_ts FROM paired WHERE kind = 'fast' AND datetime - start_ts >= 60)"""
PLACES = f""", places AS (SELECT lat, lon, count(*) AS weight FROM stops GROUP BY 1, 2),
near AS (SELECT a.lat AS lat, a.lon AS lon, b.lat AS blat, b.lon AS blon, b.weight AS weight FROM places a, places b WHERE (a.lat = b.lat AND a.lon = b.lon) OR {angle('a.lat', 'a.lon', 'b.lat', 'b.lon')} <= 5e-4),
counted AS (SELECT lat, lon, sum(weight) AS neighbours FROM near GROUP BY 1, 2)"""
CLUSTERS = """, core AS (SELECT lat, lon FROM counted WHERE neighbours >= 10),
links AS (SELECT n.* FROM near n JOIN core c ON n.lat = c.lat AND n.lon = c.lon JOIN core d ON n.blat = d.lat AND n.blon = d.lon),
reach AS (SELECT lat, lon, lat AS tlat, lon AS tlon FROM core UNION SELECT r.lat, r.lon, l.blat, l.blon FROM reach r JOIN links l ON r.tlat = l.lat AND r.tlon = l.lon),
label AS (SELECT lat, lon, min({'lat': tlat, 'lon': tlon}) AS label FROM reach GROUP BY 1, 2),
numbers AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS cluster FROM (SELECT DISTINCT label FROM label) t),
border AS (SELECT n.lat, n.lon, min(label) AS least FROM near n JOIN label l ON n.blat = l.lat AND n.blon = l.lon GROUP BY 1, 2),
placed AS (SELECT b.lat, b.lon, cluster FROM border b LEFT JOIN label l ON b.lat = l.lat AND b.lon = l.lon JOIN numbers n ON n.label = coalesce(l.label, b.least)),
clustered AS (SELECT s.*, coalesce(cluster, -1) AS cluster FROM stops s LEFT JOIN placed p ON s.lat = p.lat AND s.lon = p.lon)"""


def sql(select: str, *parts: str) -> str:
    return f"WITH RECURSIVE {GPS}{''.join(parts)}\n{select}"


def rounded(table: str, rounds: tuple[str, ...], *names: str, more: str = "") -> str:
    """SELECT of columns, some rounded to 6 places."""
    cols = [f"round({c}, 6) AS {c}" if c in rounds else c for c in names]
    return f"SELECT {', '.join(cols)} FROM {table} {more}"
