"""From raw pings to clean ones: validation, deduplication, routes, anomalies.

Batch operators order a vehicle's pings by ``order`` columns (arrival).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.geo import distance_km
from ..functions.numbers import ratio
from ..settings import DEFAULTS, Settings

ARRIVAL = ("datetime", "event_id", "copy")


def fault(s: Settings = DEFAULTS) -> Column:
    """Why a ping is invalid, or null: the first rule that it breaks."""
    return (
        F.when(F.col("x").isNull() | F.col("y").isNull(), "NULL_COORDS")
        .when(~F.col("x").between(s.lon_min, s.lon_max), "LON_OUT_OF_BOUNDS")
        .when(~F.col("y").between(s.lat_min, s.lat_max), "LAT_OUT_OF_BOUNDS")
        .when(F.col("speed") < 0, "NEGATIVE_SPEED")
        .when(F.col("speed") > s.fault_speed_kmh, "HARDWARE_FAULT_SPEED")
    )


def with_reason(pings: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    return pings.withColumn("reason", fault(s))


def valid(pings: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    return pings.where(fault(s).isNull())


def invalid(pings: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    return with_reason(pings, s).where("reason is not null")


def with_detection_time(rows: DataFrame) -> DataFrame:
    """detected_at_ms: when the rows were found, in processing time."""
    return rows.withColumn("detected_at_ms", F.unix_millis(F.current_timestamp()))


def invalid_lines(pings: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """A console line for each invalid ping."""
    return invalid(pings, s).select(F.format_string("INVALID[%s] vehicle=%s", "reason", "vehicle").alias("line"))


def reason_counts(pings: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    return with_reason(pings, s).groupBy(F.coalesce("reason", F.lit("VALID")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def first_of_each(pings: DataFrame, order: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """The first arrival of each (vehicle, datetime).

    An aggregate, so equal pings shrink before the shuffle; rows arriving later
    with another payload are dropped too.
    """
    rest = [c for c in pings.columns if c not in ("vehicle", "datetime")]
    rank = F.struct(*[c for c in order if c not in ("vehicle", "datetime")] or ["datetime"])
    return pings.groupBy("vehicle", "datetime").agg(F.min_by(F.struct(*rest), rank).alias("p")).select("vehicle", "datetime", "p.*").select(*pings.columns)


def not_repeated(pings: DataFrame, order: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """Drops a ping whose time equals that of the vehicle's ping before it."""
    before = F.lag("datetime").over(W.partitionBy("vehicle").orderBy(*order))
    return pings.withColumn("_before", before).where(~F.col("datetime").eqNullSafe(F.col("_before"))).drop("_before")


def dedup_metrics(pings: DataFrame) -> DataFrame:
    """Seen, dropped and rate per vehicle."""
    times = pings.groupBy("vehicle", "datetime").agg(F.count(F.lit(1)).alias("n"))
    out = times.groupBy("vehicle").agg(F.sum("n").alias("total_seen"), (F.sum("n") - F.count(F.lit(1))).alias("duplicates_dropped"))
    return out.withColumn("duplicate_rate", F.round(ratio(F.col("duplicates_dropped"), F.col("total_seen")), 6))


def running_dedup_metrics(pings: DataFrame, every: int = 5000, order: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """Seen, dropped and rate of a vehicle so far, at each ``every``-th of its pings."""
    by = W.partitionBy("vehicle").orderBy(*order)
    again = F.row_number().over(W.partitionBy("vehicle", "datetime").orderBy(*[c for c in order if c != "datetime"] or ["datetime"])) > 1
    rows = pings.withColumn("_again", again.cast("long")).withColumn("total_seen", F.row_number().over(by).cast("long"))
    rows = rows.withColumn("duplicates_dropped", F.sum("_again").over(by.rowsBetween(W.unboundedPreceding, 0))).where(F.col("total_seen") % every == 0)
    return rows.select("vehicle", "total_seen", "duplicates_dropped", F.round(ratio(F.col("duplicates_dropped"), F.col("total_seen")), 6).alias("duplicate_rate"))


def dedup_lines(metrics: DataFrame) -> DataFrame:
    """A console line for each row of metrics; deduplication is exact, so there is no filter and its size is 0."""
    line = F.format_string("DEDUP[%s] seen=%d dropped=%d rate=%.3f bloomBytes=0", "vehicle", "total_seen", "duplicates_dropped", "duplicate_rate")
    return metrics.select(line.alias("line"))


def with_routes(pings: DataFrame, routes: DataFrame, s: Settings = DEFAULTS, most_broadcast: int = 1_000_000) -> DataFrame:
    """routeNo and routeId of each ping's vehicle; vehicles without a route get the unknown one.

    ``routes`` has a row a vehicle.  It is broadcast if Spark's statistics put it
    under the broadcast threshold, or its counted rows under ``most_broadcast``.
    """
    table = routes.select("vehicle", "route_no", "route_id")
    if not pings.isStreaming and not table.isStreaming and table.limit(most_broadcast + 1).count() <= most_broadcast:
        table = F.broadcast(table)
    out = pings.join(table, "vehicle", "left")
    return out.withColumn("routeNo", F.coalesce("route_no", F.lit(s.unknown_route))).withColumn("routeId", F.coalesce("route_id", F.lit(s.unknown_route_id))).drop("route_no", "route_id")


def clean(pings: DataFrame, routes: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Valid, first of their time, with routes: what every analysis reads."""
    return with_routes(first_of_each(valid(pings, s)), routes, s)


def _with_previous(pings: DataFrame, order: tuple[str, ...]) -> DataFrame:
    return pings.withColumn("prev", F.lag(F.struct("x", "y", "datetime")).over(W.partitionBy("vehicle").orderBy(*order)))


def anomalies(pings: DataFrame, s: Settings = DEFAULTS, order: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """Pings that are too fast, or too far from the vehicle's ping before.

    A vehicle's first ping is never one.  A jump needs 0 < seconds <= jump_seconds.
    """
    rows = _with_previous(pings, order).where("prev is not null")
    rows = rows.withColumn("distance_km", distance_km(F.col("prev.y"), F.col("prev.x"), F.col("y"), F.col("x"))).withColumn("seconds", F.col("datetime") - F.col("prev.datetime"))
    return anomalous(rows.withColumn("prev_lon", F.col("prev.x")).withColumn("prev_lat", F.col("prev.y")), s, tuple(c for c in order if c not in ("vehicle", "datetime")))


def anomalous(rows: DataFrame, s: Settings = DEFAULTS, keep: tuple[str, ...] = ()) -> DataFrame:
    """The anomalies among pings with the way (distance_km) and time (seconds) from the one before (prev_lon, prev_lat); batches and streams."""
    fast = F.coalesce(F.col("speed") > s.excess_speed_kmh, F.lit(False))
    jump = F.coalesce((F.col("seconds") > 0) & (F.col("seconds") <= s.jump_seconds) & (F.col("distance_km") > s.jump_km), F.lit(False))
    rows = rows.withColumn("speed_excess", fast).withColumn("gps_jump", jump).where("speed_excess or gps_jump")
    told = F.concat_ws(
        "|",
        F.when(F.col("speed_excess"), F.concat(F.lit("SPEED_EXCESS:"), F.format_string("%.1f", "speed"))),
        F.when(F.col("gps_jump"), F.concat(F.lit("GPS_JUMP:"), F.format_string("%.2fkm_in_%ds", "distance_km", "seconds"))),
    )
    return rows.select(
        "vehicle", "routeNo", "datetime", *keep, told.alias("anomaly_type"), "speed_excess", "gps_jump", "speed",
        F.col("x").alias("lon"), F.col("y").alias("lat"), "prev_lon", "prev_lat", "distance_km", F.col("seconds").alias("seconds_from_prev"),
    ).withColumn("category", F.substring_index("anomaly_type", ":", 1))
