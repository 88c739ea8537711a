"""State tables and the queries that serve them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import flag, without_prefix
from ..settings import DEFAULTS, Settings
from .pings import ARRIVAL

STATE_FIELDS = ("driver", "x", "y", "speed", "heading", "ignition", "aircon", "working", "doorUp", "doorDown", "routeNo", "routeId")


def current_state(pings: DataFrame, order: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """Per vehicle, the last value of each field that was not null, and the last time."""
    rank = F.struct(*order)
    last = [F.max_by(f, F.when(F.col(f).isNotNull(), rank)).alias(f) for f in STATE_FIELDS]
    return pings.groupBy("vehicle").agg(F.max_by("datetime", rank).alias("datetime"), *last)


def hashes(state: DataFrame) -> DataFrame:
    """State rows as the strings a key-value store holds."""
    names = {"x": "lon", "y": "lat", "doorUp": "door_up", "doorDown": "door_down", "routeNo": "route_no", "routeId": "route_id"}
    boolean = ("ignition", "aircon", "working", "doorUp", "doorDown")
    return state.select("vehicle", F.col("datetime").cast("string").alias("datetime"), *[(flag(F.col(f)) if f in boolean else F.col(f).cast("string")).alias(names.get(f, f)) for f in STATE_FIELDS])


def update_messages(pings: DataFrame) -> DataFrame:
    """(vehicle, message): each ping's non-null fields as JSON."""
    return pings.select("vehicle", "datetime", "event_id", "copy", F.to_json(F.struct("vehicle", "datetime", *STATE_FIELDS), {"ignoreNullFields": "true"}).alias("message"))


def active(state: DataFrame) -> DataFrame:
    """Vehicles ever seen, with their last time as score."""
    return state.select("vehicle", F.col("datetime").alias("score"))


def live(state: DataFrame, s: Settings = DEFAULTS, as_of: int | None = None) -> DataFrame:
    """Vehicles whose state has not expired; as of the latest time unless given."""
    now = state.agg(F.max("datetime").alias("now")) if as_of is None else state.sparkSession.createDataFrame([(as_of,)], "now long")
    return state.join(F.broadcast(now), F.col("datetime") >= F.col("now") - s.state_ttl_seconds).drop("now")  # now is one row


def known_routes(state: DataFrame) -> DataFrame:
    """Route numbers with the id that the earliest-seen of their vehicles has."""
    return state.groupBy(F.col("routeNo").alias("route_no")).agg(F.min_by("routeId", F.struct("datetime", "vehicle")).alias("route_id")).where("route_no is not null")


def live_counts(state: DataFrame, k: int = 8) -> DataFrame:
    """The routes with most vehicles."""
    return state.groupBy(F.coalesce("routeNo", F.lit("UNKNOWN")).alias("route_no")).agg(F.count(F.lit(1)).alias("buses")).orderBy(F.desc("buses"), "route_no").limit(k)


def latest_speeds(windows: DataFrame) -> DataFrame:
    """The last window of each route."""
    rest = [c for c in windows.columns if c not in ("route_no", "window_end_ms")]
    return windows.where("route_no is not null").groupBy("route_no").agg(F.max("window_end_ms").alias("window_end_ms"), F.max_by(F.struct(*rest), "window_end_ms").alias("w")).select("route_no", "window_end_ms", "w.*")


ROUTE_SPEED_KEY = "route:speed:"


def route_speed_hashes(windows: DataFrame) -> DataFrame:
    """The last window of each route as a key and the strings that a key-value store holds."""
    two = lambda c: F.format_string("%.2f", c)
    return latest_speeds(windows).select(
        F.concat(F.lit(ROUTE_SPEED_KEY), "route_no").alias("key"), two("avg_speed").alias("avgSpeed"), two("min_speed").alias("minSpeed"), two("max_speed").alias("maxSpeed"),
        *[F.col(c).cast("string").alias(n) for c, n in (("vehicle_count", "vehicleCount"), ("event_count", "eventCount"), ("window_end_ms", "windowEndMs"))],
    )


def live_route_speeds(hashes: DataFrame, now_ms: int, s: Settings = DEFAULTS) -> DataFrame:
    """Route speeds (route_no and the strings) that were written, at written_ms, less than their time to live ago."""
    live = hashes.where(F.col("written_ms") > now_ms - s.route_speed_ttl_seconds * 1000)
    return live.withColumn("route_no", without_prefix(F.col("key"), ROUTE_SPEED_KEY)).drop("key")


def rate(samples: DataFrame, seconds: int, now_ms: int) -> DataFrame:
    """Increase a second of each counter (metric, label) over the last so many seconds, from samples (at_ms, value); a fall is a reset to 0."""
    by = W.partitionBy("metric", "label").orderBy("at_ms")
    rows = samples.where(F.col("at_ms").between(now_ms - seconds * 1000, now_ms)).withColumn("before", F.lag("value").over(by))
    step = F.when(F.col("value") >= F.col("before"), F.col("value") - F.col("before")).otherwise(F.when(F.col("before").isNotNull(), F.col("value")))
    out = rows.groupBy("metric", "label").agg(F.sum(step).alias("up"), ((F.max("at_ms") - F.min("at_ms")) / 1000).alias("span"))
    return out.select("metric", "label", F.try_divide(F.col("up"), F.col("span")).alias("rate")).where("rate is not null")


def slowest(latest: DataFrame, k: int = 10) -> DataFrame:
    return latest.where("avg_speed > 0").orderBy("avg_speed", "route_no").limit(k)


def busiest(latest: DataFrame, k: int = 10) -> DataFrame:
    return latest.orderBy(F.desc("vehicle_count"), "route_no").limit(k)


def gauges(state: DataFrame, latest: DataFrame) -> DataFrame:
    """(metric, label, value): what a monitor scrapes."""
    fleet = state.agg(F.count(F.lit(1)).alias("fleet_active_buses"), F.count_distinct("routeNo").alias("fleet_active_routes"))
    both = fleet.select(F.expr("stack(2, 'fleet_active_buses', '', cast(fleet_active_buses as double), 'fleet_active_routes', '', cast(fleet_active_routes as double)) as (metric, label, value)"))
    return both.unionByName(latest.select(F.expr("stack(2, 'route_avg_speed', route_no, avg_speed, 'route_vehicle_count', route_no, cast(vehicle_count as double)) as (metric, label, value)")))
