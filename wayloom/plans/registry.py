"""All queries over fleet data, by name, and their SQL.

Each runs an operator on the fixture's pings.  Doubles that are sums or
trigonometry are rounded to 6 places on both sides, as engines add in other orders.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import numbers
from ..operators import analysis, pings, serving, stops, windows
from ..settings import DEFAULTS
from ..sources import fixture, readers
from . import oracle as o

#: The fixture's event day.
SETTINGS = dataclasses.replace(DEFAULTS, event_day="2024-01-02")
LISTING_PREFIX = "2024-01-02"
MAP_HOUR = 10
VEHICLE = "vehicle-000007"

_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict:
    return dict(_SQL)


def _clean(spark: SparkSession, d: str) -> DataFrame:
    return pings.clean(fixture.pings(spark, d), fixture.routes(spark, d), SETTINGS)


def _r(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in names})


PING = "vehicle, driver, datetime, x, y, speed, heading, ignition, aircon, working, doorUp, doorDown"
PING_LIST = PING.split(", ")
KEYED = f"{PING}, event_id, copy"


@_query(o.sql(o.rounded("speeds", ("avg_speed",), "route_no", "window_end_ms", "avg_speed", "min_speed", "max_speed", "vehicle_count", "event_count", "distinct_vehicle_count"), o.SLIDING))
def route_speed_sliding(spark, d):
    return _r(windows.route_speeds(_clean(spark, d), SETTINGS), "avg_speed")


# -- decoding and cleaning


@_query(o.sql(f"SELECT {PING} FROM gps"))
def kafka_round_trip(spark, d):
    """Pings as rows for Kafka, read back as a consumer does."""
    return readers.read_messages(readers.to_kafka_rows(fixture.pings(spark, d))).where(F.col("key") == F.col("vehicle")).select(*PING_LIST)


def _filed(spark, d):
    """Pings dealt to parts and files, as those of a replay are."""
    return fixture.pings(spark, d).withColumn("part", F.expr("cast(event_id % 3 AS int)")).withColumn("file_no", F.expr("cast(event_id div 500 % 7 AS int)"))


_FILED = "(SELECT *, CAST(event_id % 3 AS INT) AS part, CAST(event_id // 500 % 7 AS INT) AS file_no FROM gps) f"


@_query(o.sql(f"SELECT part, file_no, datetime, row_number() OVER (ORDER BY part, file_no, datetime) AS place FROM (SELECT DISTINCT part, file_no, datetime FROM {_FILED} WHERE part = 1 AND file_no = 2) t"))
def replay_order(spark, d):
    """One file's times in the order of their replay."""
    rows = readers.in_replay_order(_filed(spark, d).where("part = 1 and file_no = 2")).groupBy("arrival").agg(F.count(F.lit(1)).alias("n"))
    return rows.select("arrival.*", F.row_number().over(W.partitionBy("arrival.part", "arrival.file_no").orderBy("arrival")).cast("long").alias("place"))


_ENDS = f"(SELECT part, file_no, lag(last_time) OVER (ORDER BY part, file_no) AS earlier FROM (SELECT part, file_no, max(datetime) AS last_time FROM {_FILED} GROUP BY 1, 2) m)"


@_query(o.sql(f"SELECT part, file_no, datetime, greatest(coalesce((datetime - coalesce(lag(datetime) OVER (PARTITION BY part, file_no ORDER BY datetime), earlier)) / 8e0, 0), 0) AS wait_s FROM {_FILED} JOIN {_ENDS} e USING (part, file_no)"))
def replay_waits(spark, d):
    return readers.replay_gaps(_filed(spark, d), 8.0).select("part", "file_no", "datetime", "wait_s")


@_query(o.sql("SELECT concat('n', c_nationkey) AS vehicle, concat('R', max(c_custkey)) AS route_id, concat(max(c_custkey) % 40) AS route_no FROM customer GROUP BY c_nationkey"))
def route_table_last_line(spark, d):
    """Of a route table's lines, padded with blanks, the last of each vehicle."""
    lines = spark.read.parquet(f"{d}/customer.parquet").selectExpr("concat(' n', c_nationkey, '  ') AS vehicle", "concat('R', c_custkey, ' ') AS route_id", "concat(' ', c_custkey % 40) AS route_no", "c_custkey AS line")
    return readers.last_routes(lines)


@_query(o.sql(f"SELECT {KEYED} FROM gps WHERE event_id % 97 NOT IN (1, 2, 3, 4, 5)"))
def json_decode(spark, d):
    return readers.read_messages(fixture.messages(spark, d)).select(*PING_LIST, "event_id", "copy")


@_query(o.sql(f"SELECT {PING} FROM gps WHERE event_id % 89 NOT IN (7, 8) AND event_id % 83 NOT IN (9, 10)"))
def scan_filter_required(spark, d):
    return readers.decode_array_text(fixture.array_files(spark, d)).select(*PING_LIST)


@_query(o.sql("SELECT event_id, copy, reason FROM checked"))
def validate_reason(spark, d):
    return pings.with_reason(fixture.pings(spark, d), SETTINGS).select("event_id", "copy", "reason")


@_query(o.sql("SELECT coalesce(reason, 'VALID') AS reason, count(*) AS n FROM checked GROUP BY 1"))
def validation_counts(spark, d):
    return pings.reason_counts(fixture.pings(spark, d), SETTINGS)


@_query(o.sql(f"SELECT {KEYED} FROM valid"))
def valid_events(spark, d):
    return pings.valid(fixture.pings(spark, d), SETTINGS).select(*PING_LIST, "event_id", "copy")


@_query(o.sql(f"SELECT {KEYED}, reason FROM checked WHERE reason IS NOT NULL"))
def invalid_events(spark, d):
    return pings.invalid(fixture.pings(spark, d), SETTINGS).select(*PING_LIST, "event_id", "copy", "reason")


@_query(o.sql(f"SELECT {KEYED} FROM dedup"))
def dedup_events(spark, d):
    return pings.first_of_each(pings.valid(fixture.pings(spark, d), SETTINGS)).select(*PING_LIST, "event_id", "copy")


@_query(o.sql(f"SELECT {KEYED} FROM valid QUALIFY datetime IS DISTINCT FROM lag(datetime) OVER (PARTITION BY vehicle ORDER BY datetime, event_id, copy)"))
def dedup_consecutive(spark, d):
    return pings.not_repeated(pings.valid(fixture.pings(spark, d), SETTINGS)).select(*PING_LIST, "event_id", "copy")


@_query(o.sql("SELECT vehicle, count(*) AS total_seen, count(*) - count(DISTINCT datetime) AS duplicates_dropped, round((count(*) - count(DISTINCT datetime)) / count(*), 6) AS duplicate_rate FROM valid GROUP BY vehicle"))
def dedup_metrics(spark, d):
    return pings.dedup_metrics(pings.valid(fixture.pings(spark, d), SETTINGS))


@_query(o.sql("SELECT vehicle, total_seen, CAST(dropped AS BIGINT) AS duplicates_dropped, round(dropped / total_seen, 6) AS duplicate_rate FROM (SELECT vehicle, row_number() OVER w AS total_seen, sum(again) OVER w AS dropped FROM (SELECT *, CASE WHEN row_number() OVER (PARTITION BY vehicle, datetime ORDER BY event_id, copy) > 1 THEN 1 ELSE 0 END AS again FROM valid) a WINDOW w AS (PARTITION BY vehicle ORDER BY datetime, event_id, copy)) t WHERE total_seen % 50 = 0"))
def dedup_metrics_running(spark, d):
    return pings.running_dedup_metrics(pings.valid(fixture.pings(spark, d), SETTINGS), every=50)


@_query(o.sql("SELECT concat('DEDUP[', vehicle, '] seen=', n, ' dropped=', n - u, ' rate=', CAST(CAST(round((n - u) / n, 6) AS VARCHAR) AS DECIMAL(9, 3)), ' bloomBytes=0') AS line FROM (SELECT vehicle, count(*) AS n, count(DISTINCT datetime) AS u FROM valid GROUP BY 1) t"))
def dedup_lines(spark, d):
    return pings.dedup_lines(pings.dedup_metrics(pings.valid(fixture.pings(spark, d), SETTINGS)))


@_query(o.sql("SELECT concat('INVALID[', reason, '] vehicle=', vehicle) AS line FROM checked WHERE reason IS NOT NULL"))
def invalid_lines(spark, d):
    return pings.invalid_lines(fixture.pings(spark, d), SETTINGS)


@_query(o.sql("SELECT vehicle, datetime, event_id, copy, routeNo, routeId FROM silver"))
def route_enrichment(spark, d):
    return _clean(spark, d).select("vehicle", "datetime", "event_id", "copy", "routeNo", "routeId")


# -- anomalies


def _anomalies(spark, d):
    return pings.anomalies(_clean(spark, d), SETTINGS)


_FOUND = ("vehicle", "routeNo", "datetime", "speed_excess", "gps_jump", "category", "speed", "lon", "lat", "prev_lon", "prev_lat", "distance_km", "seconds_from_prev")
_FOUND_SQL = "vehicle, routeNo, datetime, speed_excess, gps_jump, category, speed, x AS lon, y AS lat, px AS prev_lon, py AS prev_lat, round(distance_km, 6) AS distance_km, seconds_from_prev"


@_query(o.sql(f"SELECT {_FOUND_SQL} FROM anomalies", o.ANOMALIES))
def anomaly_events(spark, d):
    return _r(_anomalies(spark, d), "distance_km").select(*_FOUND)


@_query(o.sql(f"SELECT {_FOUND_SQL} FROM anomalies ORDER BY datetime DESC, event_id DESC, copy DESC LIMIT 500", o.ANOMALIES))
def recent_anomalies(spark, d):
    rows = _anomalies(spark, d).orderBy(F.desc("datetime"), F.desc("event_id"), F.desc("copy")).limit(SETTINGS.recent_anomalies)
    return _r(rows, "distance_km").select(*_FOUND)


_TOLD = "concat_ws('|', CASE WHEN speed_excess THEN concat('SPEED_EXCESS:', CAST(CAST(speed AS VARCHAR) AS DECIMAL(18, 1))) END, CASE WHEN gps_jump THEN concat('GPS_JUMP:', CAST(CAST(distance_km AS VARCHAR) AS DECIMAL(18, 2)), 'km_in_', seconds_from_prev, 's') END)"


@_query(o.sql(f"SELECT vehicle, datetime, {_TOLD} AS anomaly_type FROM anomalies", o.ANOMALIES))
def anomaly_types(spark, d):
    return _anomalies(spark, d).select("vehicle", "datetime", "anomaly_type")


@_query(o.sql("SELECT category, count(*) AS n, count(*) FILTER (WHERE gps_jump) AS with_jump FROM anomalies GROUP BY 1", o.ANOMALIES))
def anomalies_by_category(spark, d):
    return _anomalies(spark, d).groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.count_if("gps_jump").alias("with_jump"))


@_query(o.sql("SELECT routeNo, count(*) AS n FROM anomalies GROUP BY 1 ORDER BY n DESC, routeNo LIMIT 15", o.ANOMALIES))
def anomalies_by_route(spark, d):
    return analysis.top(_anomalies(spark, d), "routeNo", 15)


@_query(o.sql("SELECT vehicle, count(*) AS n FROM anomalies GROUP BY 1 ORDER BY n DESC, vehicle LIMIT 10", o.ANOMALIES))
def top_anomalous_vehicles(spark, d):
    return analysis.top(_anomalies(spark, d), "vehicle", 10)


@_query(o.sql("SELECT hour_start, count(vehicle) AS n FROM (SELECT unnest(range(a, b + 1, 3600)) AS hour_start FROM (SELECT min(datetime - datetime % 3600) AS a, max(datetime - datetime % 3600) AS b FROM anomalies) t) h LEFT JOIN anomalies n ON n.datetime - n.datetime % 3600 = hour_start GROUP BY 1", o.ANOMALIES))
def anomalies_per_hour(spark, d):
    return analysis.per_hour(_anomalies(spark, d))


@_query(o.sql("SELECT CAST(b AS INT) AS bin, round(low + (high - low) * b / 30, 6) AS low, count(speed) AS n FROM (SELECT unnest(range(30)) AS b) bins CROSS JOIN (SELECT min(speed) AS low, max(speed) AS high FROM anomalies WHERE category = 'SPEED_EXCESS') e LEFT JOIN (SELECT speed FROM anomalies WHERE category = 'SPEED_EXCESS') v ON least(floor((speed - low) / (high - low) * 30), 29) = b GROUP BY b, low, high", o.ANOMALIES))
def speed_excess_histogram(spark, d):
    return _r(analysis.histogram(_anomalies(spark, d).where("category = 'SPEED_EXCESS'"), "speed"), "low")


# -- trips


def _trips(spark, d):
    return windows.trips(_clean(spark, d), SETTINGS)


def _good(spark, d):
    return analysis.plausible(_trips(spark, d), SETTINGS)


_TRIP = ("vehicle", "route_no", "route_id", "trip_start", "trip_end", "duration_s", "event_count", "total_distance_km", "avg_speed", "stop_count", "start_lon", "start_lat", "end_lon", "end_lat")


@_query(o.sql(o.rounded("trips", ("total_distance_km", "avg_speed"), *_TRIP, "concat('trips/', route_no, '/', substr(vehicle, 1, 8), '_', trip_start, '.json') AS path"), o.TRIPS))
def trip_segments(spark, d):
    return _r(_trips(spark, d), "total_distance_km", "avg_speed")


@_query(o.sql(o.rounded("good", ("duration_min",), "vehicle", "route_no", "trip_start", "duration_min", "hour", "date"), o.TRIPS))
def plausible_trips(spark, d):
    return _r(_good(spark, d), "duration_min").select("vehicle", "route_no", "trip_start", "duration_min", "hour", "date")


@_query(o.sql("SELECT route_no, n FROM top15", o.TRIPS))
def top_routes(spark, d):
    return analysis.top(_good(spark, d), "route_no", SETTINGS.top_trip_routes)


@_query(o.sql("SELECT route_no, hour, count(*) AS trips, round(quantile_cont(duration_min, 0.25), 6) AS p25_min, round(quantile_cont(duration_min, 0.5), 6) AS median_min, round(quantile_cont(duration_min, 0.75), 6) AS p75_min FROM good WHERE route_no IN (SELECT route_no FROM top15) GROUP BY 1, 2", o.TRIPS))
def travel_time_heatmap(spark, d):
    return _r(analysis.travel_times(_good(spark, d), SETTINGS), "p25_min", "median_min", "p75_min")


_HOURS = ", ".join(f"round(median(duration_min) FILTER (WHERE hour = {h}), 6) AS \"{h}\"" for h in range(24))


@_query(o.sql(f"SELECT route_no, {_HOURS} FROM good WHERE route_no IN (SELECT route_no FROM top15) GROUP BY 1", o.TRIPS))
def travel_time_pivot(spark, d):
    return _r(analysis.travel_time_table(_good(spark, d), SETTINGS), *[str(h) for h in range(24)])


@_query(o.sql("SELECT route_no, round(e, 6) AS event_min, round(b, 6) AS baseline_min, round(e / b, 6) AS impact FROM (SELECT route_no, median(duration_min) FILTER (WHERE date = '2024-01-02') AS e, median(duration_min) FILTER (WHERE date <> '2024-01-02') AS b FROM good GROUP BY 1) t WHERE e IS NOT NULL AND b IS NOT NULL", o.TRIPS))
def event_day_impact(spark, d):
    return _r(analysis.event_impact(_good(spark, d), SETTINGS), "event_min", "baseline_min", "impact")


@_query(o.sql("SELECT route_no, round(e / b, 6) AS impact FROM (SELECT route_no, median(duration_min) FILTER (WHERE date = '2024-01-02') AS e, median(duration_min) FILTER (WHERE date <> '2024-01-02') AS b FROM good GROUP BY 1) t WHERE e IS NOT NULL AND b IS NOT NULL ORDER BY round(e / b, 6) DESC, route_no LIMIT 10", o.TRIPS))
def most_affected_routes(spark, d):
    rows = _r(analysis.event_impact(_good(spark, d), SETTINGS), "impact")
    return rows.orderBy(F.desc("impact"), "route_no").limit(10).select("route_no", "impact")


# -- features


def _features(spark, d):
    return windows.vehicle_features(_clean(spark, d), SETTINGS)


_SOFT = ("avg_speed", "std_speed", "idle_fraction", "total_distance_km", "avg_interval_s", "std_interval_s", "hour_sin", "hour_cos", "ignition_fraction", "aircon_fraction")
_ALL = ("vehicle", "route_no", "window_start_ms", "hour_of_day", *windows.FEATURE_COLUMNS, "aircon_fraction")


@_query(o.sql(o.rounded("features", _SOFT, *_ALL, "concat('features/vehicle-hourly/', route_no, '/', substr(vehicle, 1, 8), '_', window_start_ms, '.json') AS path"), o.FEATURES))
def vehicle_features(spark, d):
    return _r(_features(spark, d), *_SOFT)


_Z = ", ".join(f"round(coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0), 0), 6) + 0e0 AS {c}" for c in windows.FEATURE_COLUMNS)


@_query(o.sql(f"SELECT vehicle, window_start_ms, {_Z} FROM features", o.FEATURES))
def pca_input(spark, d):
    z = analysis.standardized(_features(spark, d)).select("vehicle", "window_start_ms", *windows.FEATURE_COLUMNS)
    return z.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in windows.FEATURE_COLUMNS})  # no negative zeros


_PAIRS = [(a, b) for i, a in enumerate(windows.FEATURE_COLUMNS) for b in windows.FEATURE_COLUMNS[i:]]


@_query(o.sql(" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0e0 AS r FROM features" for a, b in _PAIRS), o.FEATURES))
def feature_correlation(spark, d):
    return analysis.correlations(_features(spark, d)).withColumn("r", F.round("r", 6) + F.lit(0.0))


@_query()
def pca_explained_variance(spark, d):
    return analysis.explained_variance(_features(spark, d))


@_query()
def pca_loadings(spark, d):
    return analysis.loadings(_features(spark, d))


@_query()
def pca_scores(spark, d):
    return analysis.scores(_features(spark, d))


@_query(o.sql("SELECT route_no, count(*) AS n FROM features GROUP BY 1 ORDER BY n DESC, route_no LIMIT 10", o.FEATURES))
def top_feature_routes(spark, d):
    return analysis.top(_features(spark, d), "route_no", 10)


# -- archive and congestion

_KEY = "concat(strftime(make_timestamp(s * 1000000), '%Y-%m-%d/%H-%M'), '/', routeNo, '_', s * 1000, '.json')"
_MINUTES = "(SELECT routeNo, datetime - datetime % 60 AS s, count(*) AS event_count FROM silver GROUP BY 1, 2) t"


@_query(o.sql(f"SELECT routeNo AS route_no, s * 1000 AS window_start_ms, event_count, {_KEY} AS key FROM {_MINUTES}"))
def archive_manifest(spark, d):
    return windows.archive(_clean(spark, d), SETTINGS)


@_query(o.sql(f"SELECT {_KEY} AS key FROM {_MINUTES} WHERE {_KEY} LIKE '{LISTING_PREFIX}%' ORDER BY key LIMIT 200"))
def archive_listing(spark, d):
    return windows.listing(windows.archive(_clean(spark, d), SETTINGS), LISTING_PREFIX, SETTINGS)


@_query(o.sql("SELECT lat_cell, lon_cell, hour, round(mean_speed, 6) AS mean_speed, count, round(lat_cell * 0.005e0, 6) AS grid_lat, round(lon_cell * 0.005e0, 6) AS grid_lon FROM grid", o.GRID))
def congestion_grid(spark, d):
    return _r(analysis.congestion(_clean(spark, d), SETTINGS), "mean_speed", "grid_lat", "grid_lon")


@_query(o.sql(f"SELECT lat_cell, lon_cell, round(greatest(0, 1 - mean_speed / coalesce(nullif(max(mean_speed) OVER (), 0), 1)), 6) AS intensity FROM grid WHERE hour = {MAP_HOUR}", o.GRID))
def congestion_map(spark, d):
    return _r(analysis.congestion_map(analysis.congestion(_clean(spark, d), SETTINGS), MAP_HOUR), "intensity").select("lat_cell", "lon_cell", "intensity")


@_query(o.sql("SELECT count(DISTINCT vehicle) AS vehicles FROM silver"))
def distinct_vehicles(spark, d):
    return _clean(spark, d).agg(F.count_distinct("vehicle").alias("vehicles"))


# -- serving


def _state(spark, d):
    return serving.current_state(_clean(spark, d))


def _latest(spark, d):
    return serving.latest_speeds(windows.route_speeds(_clean(spark, d), SETTINGS))


_STATE = "vehicle, datetime, driver, x, y, speed, heading, ignition, aircon, working, doorUp, doorDown, routeNo, routeId"


@_query(o.sql(f"SELECT {_STATE} FROM state", o.STATE))
def bus_current_state(spark, d):
    return _state(spark, d)


@_query(o.sql("SELECT vehicle, datetime::VARCHAR AS datetime, driver, ignition::INT::VARCHAR AS ignition, aircon::INT::VARCHAR AS aircon, working::INT::VARCHAR AS working, doorUp::INT::VARCHAR AS door_up, doorDown::INT::VARCHAR AS door_down, routeNo AS route_no, routeId AS route_id FROM state", o.STATE))
def bus_hashes(spark, d):
    return serving.hashes(_state(spark, d)).drop("lon", "lat", "speed", "heading")  # text of doubles differs between engines


@_query(o.sql("SELECT vehicle, x AS lon, y AS lat, speed, heading FROM state", o.STATE))
def bus_hash_numbers(spark, d):
    """The numbers of the hashes, read back from their text."""
    return serving.hashes(_state(spark, d)).select("vehicle", *[F.expr(f"cast({c} AS double) AS {c}") for c in ("lon", "lat", "speed", "heading")])


@_query(o.sql(f"SELECT {_STATE} FROM state WHERE vehicle = '{VEHICLE}'", o.STATE))
def bus_by_id(spark, d):
    return serving.current_state(_clean(spark, d).where(F.col("vehicle") == VEHICLE))


@_query(o.sql("SELECT vehicle, datetime AS score FROM state", o.STATE))
def active_buses(spark, d):
    return serving.active(_state(spark, d))


@_query(o.sql(f"SELECT {_STATE} FROM state WHERE datetime >= (SELECT max(datetime) FROM state) - 3600", o.STATE))
def live_buses(spark, d):
    return serving.live(_state(spark, d), SETTINGS)


@_query(o.sql("SELECT routeNo AS route_no, first(routeId ORDER BY datetime, vehicle) AS route_id FROM state GROUP BY 1", o.STATE))
def routes_listing(spark, d):
    return serving.known_routes(_state(spark, d)).orderBy("route_no")


@_query(o.sql("SELECT coalesce(routeNo, 'UNKNOWN') AS route_no, count(*) AS buses FROM state GROUP BY 1 ORDER BY buses DESC, route_no LIMIT 8", o.STATE))
def live_route_counts(spark, d):
    return serving.live_counts(_state(spark, d))


_LATEST = ("route_no", "window_end_ms", "avg_speed", "min_speed", "max_speed", "vehicle_count", "event_count", "distinct_vehicle_count")


@_query(o.sql(o.rounded("latest", ("avg_speed",), *_LATEST), o.SLIDING))
def route_speed_latest(spark, d):
    return _r(_latest(spark, d), "avg_speed")


@_query(o.sql(o.rounded("latest", ("avg_speed",), *_LATEST, more="WHERE avg_speed > 0 ORDER BY round(avg_speed, 6), route_no LIMIT 10"), o.SLIDING))
def slowest_routes(spark, d):
    return serving.slowest(_r(_latest(spark, d), "avg_speed"))


@_query(o.sql(o.rounded("latest", ("avg_speed",), *_LATEST, more="ORDER BY vehicle_count DESC, route_no LIMIT 10"), o.SLIDING))
def busiest_routes(spark, d):
    return serving.busiest(_r(_latest(spark, d), "avg_speed"))


_TWO = ", ".join(f"CAST(CAST(CAST(round({c}_speed, 6) AS VARCHAR) AS DECIMAL(18, 2)) AS VARCHAR) AS {c}Speed" for c in ("avg", "min", "max"))
_STRINGS = f"{_TWO}, vehicle_count::VARCHAR AS vehicleCount, event_count::VARCHAR AS eventCount, window_end_ms::VARCHAR AS windowEndMs"


@_query(o.sql(f"SELECT concat('route:speed:', route_no) AS key, {_STRINGS} FROM latest", o.SLIDING))
def route_speed_hashes(spark, d):
    return serving.route_speed_hashes(_r(windows.route_speeds(_clean(spark, d), SETTINGS), "avg_speed", "min_speed", "max_speed"))


#: A time at which some routes' speeds have expired: some minutes before the last window's end.
NOW_MS = 1704300000000


@_query(o.sql(f"SELECT route_no, {_STRINGS}, window_end_ms AS written_ms FROM latest WHERE window_end_ms > {NOW_MS} - 120000", o.SLIDING))
def route_speeds_live(spark, d):
    """Route speeds that have not expired, as if each had been written at its window's end."""
    hashes = serving.route_speed_hashes(_r(windows.route_speeds(_clean(spark, d), SETTINGS), "avg_speed", "min_speed", "max_speed"))
    return serving.live_route_speeds(hashes.withColumn("written_ms", F.col("windowEndMs").cast("long")), NOW_MS, SETTINGS)


_COUNTED = f"(SELECT vehicle, datetime * 1000 AS at_ms, heading AS value, lag(heading) OVER (PARTITION BY vehicle ORDER BY datetime) AS before FROM silver WHERE heading IS NOT NULL AND datetime * 1000 BETWEEN {NOW_MS} - 259200000 AND {NOW_MS}) c"


@_query(o.sql(f"SELECT 'heading' AS metric, vehicle AS label, round(sum(CASE WHEN before IS NULL THEN NULL WHEN value >= before THEN value - before ELSE value END) / ((max(at_ms) - min(at_ms)) / 1000e0), 6) AS rate FROM {_COUNTED} GROUP BY vehicle HAVING max(at_ms) > min(at_ms)"))
def counter_rates(spark, d):
    """Headings taken as counters that often start again: their increase a second over three days."""
    samples = _clean(spark, d).where("heading is not null").select(F.lit("heading").alias("metric"), F.col("vehicle").alias("label"), (F.col("datetime") * 1000).alias("at_ms"), F.col("heading").alias("value"))
    return _r(serving.rate(samples, 259200, NOW_MS), "rate")


_SHIFTED = "(h * 32) & 4294967295"
_HUE = f"list_reduce(list_prepend(0::BIGINT, list_transform(string_split(name, ''), lambda c: ord(c)::BIGINT)), lambda h, c: c - h + ({_SHIFTED}) - CASE WHEN ({_SHIFTED}) >= 2147483648 THEN 4294967296 ELSE 0 END)"


@_query(o.sql(f"SELECT name, CASE WHEN name <> 'UNKNOWN' THEN CAST(abs({_HUE}) % 360 AS INT) END AS hue FROM (SELECT DISTINCT routeNo AS name FROM silver UNION SELECT n_name FROM nation UNION SELECT p_name FROM part) n"))
def route_hues(spark, d):
    """Hues of the routes, and of longer names."""
    names = [spark.read.parquet(f"{d}/{t}.parquet").select(F.col(c).alias("name")) for t, c in (("nation", "n_name"), ("part", "p_name"))]
    rows = _clean(spark, d).select(F.col("routeNo").alias("name")).unionByName(names[0]).unionByName(names[1]).distinct()
    return rows.select("name", numbers.route_hue(F.col("name")).alias("hue"))


@_query(o.sql("SELECT 'fleet_active_buses' AS metric, '' AS label, count(*)::DOUBLE AS value FROM state UNION ALL SELECT 'fleet_active_routes', '', count(DISTINCT routeNo)::DOUBLE FROM state UNION ALL SELECT 'route_avg_speed', route_no, round(avg_speed, 6) FROM latest UNION ALL SELECT 'route_vehicle_count', route_no, vehicle_count::DOUBLE FROM latest", o.STATE, o.SLIDING))
def fleet_metrics(spark, d):
    rows = _clean(spark, d)
    return _r(serving.gauges(serving.current_state(rows), serving.latest_speeds(windows.route_speeds(rows, SETTINGS))), "value")


@_query()
def bus_update_messages(spark, d):
    return serving.update_messages(_clean(spark, d))


@_query(o.sql(f"SELECT {_STATE}, event_id, copy FROM silver"))
def bus_update_fields(spark, d):
    """The fields of the update messages, read back from their JSON."""
    kinds = "vehicle string, datetime bigint, driver string, x double, y double, speed double, heading double, ignition boolean, aircon boolean, working boolean, doorUp boolean, doorDown boolean, routeNo string, routeId string"
    return serving.update_messages(_clean(spark, d)).select(F.from_json("message", kinds).alias("m"), "event_id", "copy").select("m.*", "event_id", "copy")


@_query(o.sql(f"SELECT {KEYED} FROM gps WHERE x IS NOT NULL AND y IS NOT NULL"))
def map_updates(spark, d):
    return readers.for_map(fixture.pings(spark, d)).select(*PING_LIST, "event_id", "copy")


# -- stops


def _stops(spark, d):
    return stops.stops(_clean(spark, d), SETTINGS)


@_query(o.sql("SELECT vehicle, lat, lon, duration_s, start_ts, end_ts FROM stops", o.STOPS))
def stop_events(spark, d):
    return _stops(spark, d)


@_query(o.sql("SELECT count(*) AS stops, count(DISTINCT vehicle) AS vehicles, round(avg(duration_s), 6) AS mean_s, round(stddev_samp(duration_s), 6) AS dev_s, min(duration_s) AS min_s, round(quantile_cont(duration_s, 0.25), 6) AS p25_s, round(quantile_cont(duration_s, 0.5), 6) AS median_s, round(quantile_cont(duration_s, 0.75), 6) AS p75_s, max(duration_s) AS max_s FROM stops", o.STOPS))
def stop_summary(spark, d):
    q = F.percentile("duration_s", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    out = _stops(spark, d).agg(
        F.count(F.lit(1)).alias("stops"), F.count_distinct("vehicle").alias("vehicles"), F.avg("duration_s").alias("mean_s"), F.stddev_samp("duration_s").alias("dev_s"),
        F.min("duration_s").alias("min_s"), q.alias("q"), F.max("duration_s").alias("max_s"),
    )
    out = out.withColumns({"p25_s": F.col("q")[0], "median_s": F.col("q")[1], "p75_s": F.col("q")[2]}).drop("q")
    return _r(out, "mean_s", "dev_s", "p25_s", "median_s", "p75_s")


@_query(o.sql("SELECT lat, lon, CAST(neighbours AS BIGINT) AS neighbours FROM counted", o.STOPS, o.PLACES))
def stop_neighbors(spark, d):
    return stops.neighbour_counts(_stops(spark, d), SETTINGS)


@_query(o.sql("SELECT lat, lon, CAST(neighbours AS BIGINT) AS neighbours FROM counted WHERE neighbours >= 10", o.STOPS, o.PLACES))
def stop_core_points(spark, d):
    return stops.neighbour_counts(_stops(spark, d), SETTINGS).where(F.col("neighbours") >= SETTINGS.cluster_min_points)


@_query(o.sql("SELECT CAST(cluster AS INT) AS cluster, count(*) AS stops, round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon, round(avg(duration_s), 6) AS mean_duration_s FROM clustered GROUP BY 1", o.STOPS, o.PLACES, o.CLUSTERS))
def stop_clusters(spark, d):
    return _r(stops.clusters(_stops(spark, d), SETTINGS), "lat", "lon", "mean_duration_s")


@_query(o.sql("SELECT vehicle, start_ts, CAST(cluster AS INT) AS cluster FROM clustered", o.STOPS, o.PLACES, o.CLUSTERS))
def stop_labels(spark, d):
    return stops.with_clusters(_stops(spark, d), SETTINGS).select("vehicle", "start_ts", "cluster")
