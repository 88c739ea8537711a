"""Streams give what batches give."""

import dataclasses
import json

import pytest
from pyspark.sql import functions as F

from conftest import DATA, rows
from wayloom.operators import pings, serving, windows
from wayloom.settings import DEFAULTS
from wayloom.sources import fixture, readers
from wayloom.streaming import pipeline

FLUSH = 1704067200 + 400 * 86400


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    """Pings through a stream of JSON message files into a Parquet table."""
    at = tmp_path_factory.mktemp("stream")
    raw = fixture.pings(spark, str(DATA)).orderBy(*pings.ARRIVAL)
    body = F.struct("vehicle", "driver", "datetime", "x", "y", "speed", "heading", "ignition", "aircon", "working", F.col("doorUp").alias("door_up"), F.col("doorDown").alias("door_down"))
    raw.select(F.to_json(F.struct(body.alias("msgBusWayPoint"))).alias("value")).coalesce(1).write.text(str(at / "in"))
    stream = pipeline.silver(pipeline.message_stream(spark, str(at / "in")), fixture.routes(spark, str(DATA)))
    pipeline.append(stream, str(at / "silver"), str(at / "c0")).awaitTermination()
    return at


def branch(spark, at, make, name):
    """Run a branch over silver, with a late ping that closes all windows."""
    table = spark.read.parquet(str(at / "silver")).drop("event_time")
    last = table.limit(1).withColumn("datetime", F.lit(FLUSH)).withColumn("vehicle", F.lit("flush")).withColumn("routeNo", F.lit("flush"))
    for i, part in enumerate((table, last)):
        part.coalesce(1).write.mode("append").parquet(str(at / f"{name}-in"))
    schema = table.schema
    rows_in = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(at / f"{name}-in"))
    pipeline.append(make(pipeline.with_event_time(rows_in)), str(at / name), str(at / f"{name}-c")).awaitTermination()
    return spark.read.parquet(str(at / name))


def batch(spark):
    got = pings.clean(fixture.pings(spark, str(DATA)), fixture.routes(spark, str(DATA)))
    return got.drop("event_id", "copy")


ORDER = ("datetime",)


def test_silver(spark, silver):
    got = spark.read.parquet(str(silver / "silver"))
    assert rows(got.select("vehicle", "datetime", "routeNo").toPandas()) == rows(batch(spark).select("vehicle", "datetime", "routeNo").toPandas())


def test_route_speeds(spark, silver):
    got = branch(spark, silver, pipeline.route_speeds, "speeds").where("route_no <> 'flush'")
    want = windows.route_speeds(spark.read.parquet(str(silver / "silver")))
    assert rows(got.toPandas()) == rows(want.toPandas())


def test_trips(spark, silver):
    got = branch(spark, silver, pipeline.trips, "trips").where("vehicle <> 'flush'")
    want = windows.trips(spark.read.parquet(str(silver / "silver")), order=ORDER)
    assert sorted(got.columns) == sorted(want.columns) and rows(got.toPandas()) == rows(want.toPandas())


def test_features(spark, silver):
    got = branch(spark, silver, pipeline.vehicle_features, "features").where("vehicle <> 'flush'")
    want = windows.vehicle_features(spark.read.parquet(str(silver / "silver")), order=ORDER)
    assert sorted(got.columns) == sorted(want.columns) and rows(got.toPandas()) == rows(want.toPandas())


def test_anomalies(spark, silver):
    got = branch(spark, silver, pipeline.anomalies, "anomalies").where("vehicle <> 'flush'")
    want = pings.anomalies(spark.read.parquet(str(silver / "silver")), order=ORDER)
    assert sorted(got.columns) == sorted(want.columns) and rows(got.toPandas()) == rows(want.toPandas())


def test_state_is_merged(spark, tmp_path):
    write = pipeline.upsert_state(str(tmp_path / "state"))
    table = batch(spark)
    write(table.where("datetime < 1704200000"), 0)
    write(table.where("datetime >= 1704200000"), 1)
    write(table.where("datetime >= 1704200000"), 1)  # a batch that is repeated
    assert rows(pipeline.latest_state(spark, str(tmp_path / "state")).toPandas()) == rows(serving.current_state(table, ORDER).toPandas())


def test_old_and_broken_versions_of_state(spark, tmp_path):
    path = tmp_path / "state"
    write = pipeline.upsert_state(str(path))
    table = batch(spark).limit(40)
    for i in range(7):
        write(table.where(f"datetime % 7 = {i}"), i)
    names = lambda: sorted(p.name for p in path.iterdir() if p.name.startswith("version="))
    assert names() == [f"version={i}" for i in (3, 4, 5, 6)]
    (path / "version=7").mkdir()  # a writer that was lost
    want = rows(pipeline.latest_state(spark, str(path)).toPandas())
    write(table.where("datetime % 7 = 6"), 7)
    assert rows(pipeline.latest_state(spark, str(path)).toPandas()) == want and names() == [f"version={i}" for i in (4, 5, 6, 7)]


def test_late_pings_are_dropped_from_windows(spark, tmp_path):
    names = "vehicle string, datetime long, speed double, routeNo string"
    for i, r in enumerate(([("a", 1000, 10.0, "1")], [("a", 9000, 10.0, "1")], [("a", 9001, 10.0, "1")], [("a", 1001, 50.0, "1")], [("a", 99000, 1.0, "1")], [("a", 99001, 1.0, "1")])):
        spark.createDataFrame(r, names).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    pipeline.append(pipeline.route_speeds(pipeline.with_event_time(stream)), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).where("window_end_ms < 2000000")
    assert got.count() == 10 and got.agg(F.max("max_speed")).first()[0] == 10.0


def test_sinks_and_scans(spark, tmp_path):
    table = batch(spark)
    for name, made in (("trips", windows.trips(table, order=ORDER)), ("features", windows.vehicle_features(table, order=ORDER)), ("anomalies", pings.anomalies(table, order=ORDER))):
        made.coalesce(1).write.parquet(str(tmp_path / f"{name}-in"))
        stream = spark.readStream.schema(made.schema).parquet(str(tmp_path / f"{name}-in"))
        {"trips": pipeline.trip_sink, "features": pipeline.feature_sink, "anomalies": pipeline.anomaly_sink}[name](stream, str(tmp_path / "store"), str(tmp_path / f"{name}-c")).awaitTermination()
        got = readers.read_stored(spark, str(tmp_path / "store"), name)
        assert got.count() == made.count() and set(got.columns) == set(made.columns)
    newest = [r["datetime"] for r in readers.read_stored(spark, str(tmp_path / "store"), "anomalies").collect()]
    assert newest == sorted(newest, reverse=True)
    windows.write_archive(table, str(tmp_path / "store" / "archive"))
    one = readers.read_stored(spark, str(tmp_path / "store"), "archive", prefix="2024-01-02", capped=True)
    assert 0 < one.count() <= 300 and {str(r["date"])[:10] for r in one.select("date").distinct().collect()} == {"2024-01-02"}


def test_counters_and_invalid_rows(spark, tmp_path):
    raw = fixture.pings(spark, str(DATA))
    raw.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in"))
    q = pipeline.append(pipeline.invalid(pipeline.counted(stream)), str(tmp_path / "out"), str(tmp_path / "c"))
    q.awaitTermination()
    want = {r["reason"]: r["n"] for r in pings.reason_counts(raw).collect()}
    told = [x.observedMetrics["coords"].asDict() for x in q.recentProgress if "coords" in x.observedMetrics]
    assert sum(t["valid"] for t in told) == want["VALID"] and sum(t["invalid"] for t in told) == sum(want.values()) - want["VALID"]
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == sum(want.values()) - want["VALID"] and got.where("detected_at_ms is null").count() == 0


def test_recent_anomalies_and_route_speeds(spark, tmp_path):
    found = pings.anomalies(batch(spark), order=ORDER).drop("event_id", "copy")
    keep = pipeline.recent_anomalies(str(tmp_path / "recent"), dataclasses.replace(DEFAULTS, recent_anomalies=20))
    keep(found.where("datetime < 1704250000"), 0)
    keep(found.where("datetime >= 1704250000"), 1)
    got = [r["datetime"] for r in pipeline.latest_state(spark, str(tmp_path / "recent")).orderBy(F.desc("datetime")).collect()]
    assert got == [r["datetime"] for r in found.orderBy(F.desc("datetime")).limit(20).collect()]

    schema = "route_no string, window_end_ms long, avg_speed double, min_speed double, max_speed double, vehicle_count long, event_count long"
    write = pipeline.upsert_route_speeds(str(tmp_path / "speeds"))
    write(spark.createDataFrame([("1", 1000, 1.005, 0.0, 2.0, 3, 3), ("1", 2000, 12.345, 0.5, 20.0, 4, 5), ("2", 1000, 7.0, 7.0, 7.0, 1, 1), (None, 1000, 7.0, 7.0, 7.0, 1, 1)], schema), 0)
    write(spark.createDataFrame([("2", 3000, 8.0, 8.0, 8.0, 2, 2)], schema), 1)
    state = pipeline.latest_state(spark, str(tmp_path / "speeds"))
    now = state.agg(F.max("written_ms")).first()[0]
    live = {r["route_no"]: (r["avgSpeed"], r["minSpeed"], r["maxSpeed"], r["vehicleCount"], r["eventCount"], r["windowEndMs"]) for r in serving.live_route_speeds(state, now).collect()}
    assert live["2"] == ("8.00", "8.00", "8.00", "2", "2", "3000") and live["1"] == ("12.35", "0.50", "20.00", "4", "5", "2000") and len(live) == 2
    assert serving.live_route_speeds(state, now + 121_000).count() == 0


def test_fan_out(spark, tmp_path):
    rows_in = batch(spark).limit(30)
    out = str(tmp_path)

    def send(messages):
        import uuid

        with open(f"{out}/{uuid.uuid4().hex}.txt", "w") as f:
            f.writelines(m + "\n" for m in messages)

    pipeline.fan_out(send)(rows_in.withColumn("x", F.when(F.col("datetime") % 2 == 0, F.lit(float("nan"))).otherwise(F.col("x"))), 0)
    told = [json.loads(line) for f in tmp_path.glob("*.txt") for line in f.read_text().splitlines()]
    assert len(told) == rows_in.where("datetime % 2 = 1").count() and all(t["vehicle"] and "x" in t for t in told)
