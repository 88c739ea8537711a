"""Event-time windows: sliding route speeds, trips, hourly features, the archive."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.clock import hour_of, minute_path, window_start
from ..functions.geo import distance_km, heading_change
from ..functions.numbers import or_zero, short_id
from ..settings import DEFAULTS, Settings
from .pings import ARRIVAL

FEATURE_COLUMNS = (
    "event_count", "avg_speed", "max_speed", "std_speed", "idle_fraction", "total_distance_km",
    "avg_interval_s", "std_interval_s", "hour_sin", "hour_cos", "heading_changes", "ignition_fraction",
)


def route_speeds(pings: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Speeds per route in sliding windows.

    Pings are first summed by route and pane (one step), without vehicles, then
    each pane goes into the windows over it, so rows multiply after they have
    shrunk to a row a route and pane.  Vehicles are counted beside that: a
    vehicle's pane adds only the windows that its pane before does not reach, so
    each window gets a vehicle once and no distinct count is needed.
    vehicle_count counts pings, as the serving side expects;
    distinct_vehicle_count counts vehicles.  Windows without speeds have zeros.
    """
    step, length = s.slide_step_seconds, s.slide_window_seconds
    pane = window_start(F.col("datetime"), step).alias("pane")
    panes = pings.groupBy("routeNo", pane).agg(
        F.sum("speed").alias("sum"), F.count("speed").alias("n"), F.min("speed").alias("min"), F.max("speed").alias("max"), F.count(F.lit(1)).alias("events")
    )
    ends = lambda first: F.explode(F.sequence(first, F.col("pane") + length, F.lit(step)))
    speeds = panes.withColumn("window_end", ends(F.col("pane") + step)).groupBy("routeNo", "window_end").agg(
        or_zero(F.try_divide(F.sum("sum"), F.sum("n"))).alias("avg_speed"), or_zero(F.min("min")).alias("min_speed"), or_zero(F.max("max")).alias("max_speed"), F.sum("events").alias("events"),
    )
    seen = pings.select("routeNo", "vehicle", pane).distinct().withColumn("before", F.lag("pane").over(W.partitionBy("routeNo", "vehicle").orderBy("pane")))
    first = F.greatest(F.col("pane") + step, F.col("before") + length + step)
    vehicles = seen.select(F.col("routeNo").alias("_route"), "pane", ends(first).alias("_end")).groupBy("_route", "_end").agg(F.count(F.lit(1)).alias("distinct_vehicle_count"))
    both = speeds.join(vehicles, F.col("routeNo").eqNullSafe(F.col("_route")) & (F.col("window_end") == F.col("_end")))
    return both.select(
        F.col("routeNo").alias("route_no"), (F.col("window_end") * 1000).alias("window_end_ms"), "avg_speed", "min_speed", "max_speed",
        F.col("events").alias("vehicle_count"), F.col("events").alias("event_count"), "distinct_vehicle_count",
    )


def with_steps(pings: DataFrame, keys: tuple[str, ...], order: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """prev: the ping before, within keys; step_km: the way from it."""
    prev = F.lag(F.struct("x", "y", "datetime", "heading")).over(W.partitionBy(*keys).orderBy(*order))
    rows = pings.withColumn("prev", prev)
    return rows.withColumn("step_km", distance_km(F.col("prev.y"), F.col("prev.x"), F.col("y"), F.col("x")))


def trips(pings: DataFrame, s: Settings = DEFAULTS, order: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """Sessions per vehicle that end where the next ping is over a gap away.

    Distances join consecutive pings of a trip; speeds and stops leave out its
    first ping.  One shuffle by vehicle serves the gaps, the numbering and the sums.
    """
    by = W.partitionBy("vehicle").orderBy(*order)
    rows = with_steps(pings, ("vehicle",), order)
    new = F.col("prev").isNull() | (F.col("datetime") - F.col("prev.datetime") > s.session_gap_seconds)
    rows = rows.withColumn("new", new).withColumn("trip", F.sum(F.col("new").cast("long")).over(by.rowsBetween(W.unboundedPreceding, 0)))
    later = lambda c: F.when(~F.col("new"), c)
    rank = F.struct(*order)
    out = rows.groupBy("vehicle", "trip").agg(
        F.min_by(F.struct("routeNo", "routeId", "x", "y"), rank).alias("a"), F.max_by(F.struct("x", "y"), rank).alias("b"),
        F.min("datetime").alias("trip_start"), F.max("datetime").alias("trip_end"), F.count(F.lit(1)).alias("event_count"),
        or_zero(F.sum(later(F.col("step_km")))).alias("total_distance_km"), or_zero(F.avg(later(F.col("speed")))).alias("avg_speed"),
        F.count_if(later(F.col("speed") < s.idle_kmh)).alias("stop_count"),
    )
    return out.select(
        "vehicle", F.col("a.routeNo").alias("route_no"), F.col("a.routeId").alias("route_id"), "trip_start", "trip_end",
        (F.col("trip_end") - F.col("trip_start")).alias("duration_s"), "event_count", "total_distance_km", "avg_speed", "stop_count",
        F.col("a.x").alias("start_lon"), F.col("a.y").alias("start_lat"), F.col("b.x").alias("end_lon"), F.col("b.y").alias("end_lat"),
    ).withColumn("path", trip_path())


def trip_path() -> Column:
    """Where a trip's object stands."""
    return F.concat(F.lit("trips/"), F.col("route_no"), F.lit("/"), short_id(F.col("vehicle")), F.lit("_"), F.col("trip_start"), F.lit(".json"))


def with_hour(rows: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Adds the hour of a feature window, its place on the circle, and the path of the window's object."""
    angle = F.lit(2 * math.pi) * F.col("hour_of_day") / 24
    return (
        rows.withColumn("hour_of_day", hour_of((F.col("window_start_ms") / 1000).cast("long"), s.feature_utc_offset_hours)).withColumn("hour_sin", F.sin(angle)).withColumn("hour_cos", F.cos(angle))
        .withColumn("path", F.concat(F.lit("features/vehicle-hourly/"), F.col("route_no"), F.lit("/"), short_id(F.col("vehicle")), F.lit("_"), F.col("window_start_ms"), F.lit(".json")))
        .select("vehicle", "route_no", "window_start_ms", "hour_of_day", *FEATURE_COLUMNS, "aircon_fraction", "path")
    )


def vehicle_features(pings: DataFrame, s: Settings = DEFAULTS, order: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """Thirteen numbers per vehicle and hour; pairs of pings never cross the hour."""
    rows = pings.withColumn("start", window_start(F.col("datetime"), s.feature_seconds))
    rows = with_steps(rows, ("vehicle", "start"), order).withColumn("gap", F.col("datetime") - F.col("prev.datetime"))
    turned = heading_change(F.col("prev.heading"), F.col("heading")) > s.heading_degrees
    out = rows.groupBy("vehicle", "start").agg(
        F.min_by("routeNo", F.struct(*order)).alias("route_no"), F.count(F.lit(1)).alias("event_count"),
        or_zero(F.avg("speed")).alias("avg_speed"), or_zero(F.max("speed")).alias("max_speed"), or_zero(F.stddev_pop("speed")).alias("std_speed"),
        (F.count_if(F.col("speed") < s.idle_kmh) / F.count(F.lit(1))).alias("idle_fraction"), or_zero(F.sum("step_km")).alias("total_distance_km"),
        or_zero(F.avg("gap")).alias("avg_interval_s"), or_zero(F.stddev_pop("gap")).alias("std_interval_s"), F.count_if(turned).alias("heading_changes"),
        (F.count_if("ignition") / F.count(F.lit(1))).alias("ignition_fraction"), (F.count_if("aircon") / F.count(F.lit(1))).alias("aircon_fraction"),
    )
    return with_hour(out.withColumn("window_start_ms", F.col("start") * 1000), s)


def archive(pings: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """The objects of the archive: one per route and minute."""
    rows = pings.groupBy("routeNo", window_start(F.col("datetime"), s.archive_seconds).alias("start")).agg(F.count(F.lit(1)).alias("event_count"))
    key = F.concat(minute_path(F.col("start")), F.lit("/"), F.col("routeNo"), F.lit("_"), F.col("start") * 1000, F.lit(".json"))
    return rows.select(F.col("routeNo").alias("route_no"), (F.col("start") * 1000).alias("window_start_ms"), "event_count", key.alias("key"))


def archive_rows(pings: DataFrame) -> DataFrame:
    """Pings with the archive's partition columns."""
    at = F.timestamp_seconds("datetime")
    return pings.withColumn("date", F.date_format(at, "yyyy-MM-dd")).withColumn("hhmm", F.date_format(at, "HH-mm"))


def write_archive(pings: DataFrame, path: str, form: str = "parquet") -> None:
    """Append pings by date and minute, routes together, so a prefix read prunes partitions."""
    rows = archive_rows(pings).repartition("date", "hhmm").sortWithinPartitions("date", "hhmm", "routeNo")
    rows.write.mode("append").partitionBy("date", "hhmm").format(form).save(path)


def listing(manifest: DataFrame, prefix: str, s: Settings = DEFAULTS) -> DataFrame:
    """The first keys of the archive under a prefix, in order."""
    return manifest.where(F.col("key").startswith(prefix)).orderBy("key").limit(s.listing_cap).select("key")
