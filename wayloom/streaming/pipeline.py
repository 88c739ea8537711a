"""The engine on streams: silver pings, and a query for each branch.

Spark has one sink a query, so silver is appended once and each branch reads it.
Branch windows emit when the watermark passes them (append mode).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.geo import distance_km, heading_change
from ..functions.numbers import or_zero
from ..operators import pings as p
from ..operators import serving, windows
from ..settings import DEFAULTS, Settings
from ..sources.readers import STORED, for_map, read_messages


def message_stream(spark: SparkSession, path: str, files_per_trigger: int = 16) -> DataFrame:
    """Pings of text files with a JSON message a line, and arrival columns."""
    raw = spark.readStream.format("text").option("maxFilesPerTrigger", files_per_trigger).load(path)
    return read_messages(raw)


def with_event_time(rows: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    return rows.withColumn("event_time", F.timestamp_seconds("datetime")).withWatermark("event_time", s.watermark)


def silver(rows: DataFrame, routes: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Valid pings, one for each vehicle and time within the watermark, with routes.

    The time is among the keys, so state older than the watermark goes.
    """
    unique = with_event_time(p.valid(rows, s), s).dropDuplicates(["vehicle", "event_time"])
    return p.with_routes(unique, routes, s)


def counted(rows: DataFrame, s: Settings = DEFAULTS, name: str = "coords") -> DataFrame:
    """The same rows; each batch's progress tells how many were valid and invalid, under observedMetrics."""
    ok = p.fault(s).isNull()
    return rows.observe(name, F.count_if(ok).alias("valid"), F.count_if(~ok).alias("invalid"))


def invalid(rows: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Invalid pings with the reason and the time they were found."""
    return p.with_detection_time(p.invalid(rows, s))


def append(rows: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = (), once: bool = True):
    """Start appending a stream to Parquet; once: take what is there and stop."""
    w = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    return (w.trigger(availableNow=True) if once else w).start()


def archive_stream(rows: DataFrame, path: str, checkpoint: str, once: bool = True):
    return append(windows.archive_rows(rows), path, checkpoint, ("date", "hhmm"), once)


def trip_sink(rows: DataFrame, path: str, checkpoint: str, once: bool = True):
    """Store trips by route, as readers.read_stored finds them."""
    return append(rows, f"{path}/{STORED['trips'][0]}", checkpoint, ("route_no",), once)


def feature_sink(rows: DataFrame, path: str, checkpoint: str, once: bool = True):
    """Store hourly features by route."""
    return append(rows, f"{path}/{STORED['features'][0]}", checkpoint, ("route_no",), once)


def anomaly_sink(rows: DataFrame, path: str, checkpoint: str, once: bool = True):
    """Store every anomaly; recent_anomalies keeps the last ones beside."""
    return append(rows, f"{path}/{STORED['anomalies'][0]}", checkpoint, (), once)


def route_speeds(rows: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """windows.route_speeds on a stream with event_time."""
    w = F.window("event_time", f"{s.slide_window_seconds} seconds", f"{s.slide_step_seconds} seconds")
    out = rows.groupBy(w.alias("w"), F.col("routeNo").alias("route_no")).agg(
        or_zero(F.avg("speed")).alias("avg_speed"), or_zero(F.min("speed")).alias("min_speed"), or_zero(F.max("speed")).alias("max_speed"),
        F.count(F.lit(1)).alias("vehicle_count"), F.count(F.lit(1)).alias("event_count"), F.size(F.collect_set("vehicle")).cast("long").alias("distinct_vehicle_count"),
    )
    return out.select("route_no", F.unix_millis("w.end").alias("window_end_ms"), "avg_speed", "min_speed", "max_speed", "vehicle_count", "event_count", "distinct_vehicle_count")


_KEPT = ("datetime", "x", "y", "speed", "heading", "ignition", "aircon", "routeNo", "routeId")


def _steps(rows: DataFrame) -> DataFrame:
    """Of sorted pings ``ps``: ``ts``, each but the first with the one before."""
    pair = lambda i: F.struct(F.get("ps", i - 1).alias("p"), F.get("ps", i).alias("c"))
    return rows.withColumn("ts", F.when(F.size("ps") > 1, F.transform(F.sequence(F.lit(1), F.size("ps") - 1), pair)).otherwise(F.array().cast("array<struct<p:struct<%s>,c:struct<%s>>>" % ((_TYPES,) * 2))))


_TYPES = "datetime:bigint,x:double,y:double,speed:double,heading:double,ignition:boolean,aircon:boolean,routeNo:string,routeId:string"


def _total(values) -> F.Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + F.coalesce(v, F.lit(0.0)))


def _mean(values) -> F.Column:
    known = F.filter(values, lambda v: v.isNotNull())
    return or_zero(F.try_divide(_total(known), F.size(known).cast("double")))


def _deviation(values) -> F.Column:
    known, mean = F.filter(values, lambda v: v.isNotNull()), _mean(values)
    return or_zero(F.sqrt(F.try_divide(_total(F.transform(known, lambda v: (v - mean) * (v - mean))), F.size(known).cast("double"))))


def _way() -> F.Column:
    return _total(F.transform("ts", lambda t: distance_km(t["p"]["y"], t["p"]["x"], t["c"]["y"], t["c"]["x"])))


def trips(rows: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """windows.trips on a stream with event_time: a session's pings are sorted when it closes."""
    w = F.session_window("event_time", f"{s.session_gap_seconds} seconds")
    got = rows.groupBy(w.alias("w"), "vehicle").agg(F.array_sort(F.collect_list(F.struct(*_KEPT))).alias("ps"))
    got = _steps(got)
    a, b = F.get("ps", F.lit(0)), F.element_at("ps", -1)
    speeds = F.transform("ts", lambda t: t["c"]["speed"])
    return got.select(
        "vehicle", a["routeNo"].alias("route_no"), a["routeId"].alias("route_id"), a["datetime"].alias("trip_start"), b["datetime"].alias("trip_end"),
        (b["datetime"] - a["datetime"]).alias("duration_s"), F.size("ps").cast("long").alias("event_count"), _way().alias("total_distance_km"), _mean(speeds).alias("avg_speed"),
        F.size(F.filter(speeds, lambda v: v < s.idle_kmh)).cast("long").alias("stop_count"), a["x"].alias("start_lon"), a["y"].alias("start_lat"), b["x"].alias("end_lon"), b["y"].alias("end_lat"),
    ).withColumn("path", windows.trip_path())


def vehicle_features(rows: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """windows.vehicle_features on a stream with event_time."""
    w = F.window("event_time", f"{s.feature_seconds} seconds")
    got = _steps(rows.groupBy(w.alias("w"), "vehicle").agg(F.array_sort(F.collect_list(F.struct(*_KEPT))).alias("ps")))
    speeds, gaps = F.transform("ps", lambda q: q["speed"]), F.transform("ts", lambda t: (t["c"]["datetime"] - t["p"]["datetime"]).cast("double"))
    n = F.size("ps").cast("double")
    share = lambda f: F.size(F.filter("ps", f)) / n
    out = got.select(
        "vehicle", F.get("ps", F.lit(0))["routeNo"].alias("route_no"), F.unix_millis("w.start").alias("window_start_ms"), F.size("ps").cast("long").alias("event_count"),
        _mean(speeds).alias("avg_speed"), or_zero(F.array_max(speeds)).alias("max_speed"), _deviation(speeds).alias("std_speed"), share(lambda q: q["speed"] < s.idle_kmh).alias("idle_fraction"),
        _way().alias("total_distance_km"), _mean(gaps).alias("avg_interval_s"), _deviation(gaps).alias("std_interval_s"),
        F.size(F.filter("ts", lambda t: heading_change(t["p"]["heading"], t["c"]["heading"]) > s.heading_degrees)).cast("long").alias("heading_changes"),
        share(lambda q: q["ignition"]).alias("ignition_fraction"), share(lambda q: q["aircon"]).alias("aircon_fraction"),
    )
    return windows.with_hour(out, s)


# -- anomalies: the ping before is keyed state

PAIRED = "vehicle string, routeNo string, datetime long, x double, y double, speed double, px double, py double, pdatetime long"


class PreviousPing(StatefulProcessor):
    """Gives each ping the place and time of its vehicle's ping before, in the order of time within a batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "x double, y double, datetime long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        got = pd.concat(list(rows)).sort_values("datetime", kind="stable")
        before = self.last.get() if self.last.exists() else None
        ahead = pd.DataFrame([before] if before is not None else [(None, None, None)], columns=["x", "y", "datetime"])
        prev = pd.concat([ahead, got[["x", "y", "datetime"]]], ignore_index=True).iloc[:-1]
        end = got.iloc[-1]
        self.last.update((None if pd.isna(end.x) else float(end.x), None if pd.isna(end.y) else float(end.y), int(end.datetime)))
        out = got[["vehicle", "routeNo", "datetime", "x", "y", "speed"]].reset_index(drop=True)
        out["px"], out["py"], out["pdatetime"] = prev.x.astype(float), prev.y.astype(float), prev.datetime.astype("Int64")
        yield out

    def close(self) -> None:
        pass


def anomalies(rows: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """operators.pings.anomalies on a stream; needs the RocksDB state store."""
    paired = rows.select("vehicle", "routeNo", "datetime", "x", "y", "speed").groupBy("vehicle").transformWithStateInPandas(
        statefulProcessor=PreviousPing(), outputStructType=PAIRED, outputMode="Append", timeMode="None"
    )
    km, seconds = distance_km(F.col("py"), F.col("px"), F.col("y"), F.col("x")), F.col("datetime") - F.col("pdatetime")
    found = paired.where("pdatetime is not null").withColumn("distance_km", km).withColumn("seconds", seconds)
    return p.anomalous(found.withColumn("prev_lon", F.col("px")).withColumn("prev_lat", F.col("py")), s)


# -- state tables


def _versions(spark: SparkSession, path: str) -> list[int]:
    """The versions of a state table whose writing ended."""
    to_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = to_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in system.listStatus(to_path(path))] if system.exists(to_path(path)) else []
    return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version=") and system.exists(to_path(f"{path}/{n}/_SUCCESS")))


#: Versions of a state table that stay: a repeated batch needs the one before, and readers may still hold an older one.
VERSIONS_KEPT = 4


def _versioned(path: str, merge, keep: int = VERSIONS_KEPT):
    """foreachBatch writer: merge(batch, last version or None) becomes the next version; a version a batch, so a repeated batch writes the same.

    Versions but the last ``keep`` are deleted once the new one is written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = [v for v in _versions(spark, path) if v < batch_id]
        merge(batch, spark.read.parquet(f"{path}/version={earlier[-1]}") if earlier else None).write.mode("overwrite").parquet(f"{path}/version={batch_id}")
        for old in earlier[: max(0, len(earlier) + 1 - max(2, keep))]:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/version={old}")
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

    return write


def upsert_state(path: str):
    """foreachBatch writer: merges a batch of pings into the vehicles' state."""

    def merge(batch: DataFrame, last: DataFrame | None) -> DataFrame:
        rows = batch.select("vehicle", "datetime", *serving.STATE_FIELDS, F.lit(1).alias("turn"))
        return serving.current_state(rows.unionByName(last.withColumn("turn", F.lit(0))) if last is not None else rows, ("turn", "datetime"))

    return _versioned(path, merge)


def recent_anomalies(path: str, s: Settings = DEFAULTS):
    """foreachBatch writer: keeps the last anomalies, newest first."""

    def merge(batch: DataFrame, last: DataFrame | None) -> DataFrame:
        rows = batch.unionByName(last) if last is not None else batch
        return rows.orderBy(F.desc("datetime"), "vehicle").limit(s.recent_anomalies)

    return _versioned(path, merge)


def upsert_route_speeds(path: str):
    """foreachBatch writer: each route's last window as strings, with the time of writing, from which serving.live_route_speeds counts."""

    def merge(batch: DataFrame, last: DataFrame | None) -> DataFrame:
        rows = serving.route_speed_hashes(batch).withColumn("written_ms", F.unix_millis(F.current_timestamp()))
        if last is None:
            return rows
        return last.join(rows.select("key"), "key", "left_anti").unionByName(rows)

    return _versioned(path, merge)


def fan_out(send):
    """foreachBatch writer: gives each partition's updates, as JSON messages, to ``send`` (an iterator's consumer, such as a push server's client)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        fields = [c for c in ("vehicle", "datetime", *serving.STATE_FIELDS) if c in batch.columns]
        messages = for_map(batch).select(F.to_json(F.struct(*fields), {"ignoreNullFields": "true"}).alias("message"))
        messages.foreachPartition(lambda rows: send(r["message"] for r in rows))

    return write


def latest_state(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of a state table."""
    return spark.read.parquet(f"{path}/version={_versions(spark, path)[-1]}")
