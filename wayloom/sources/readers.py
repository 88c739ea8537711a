"""Readers: JSON-array files, JSON messages, route tables, Kafka."""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..schema import ENVELOPE, MESSAGE_FIELDS, MESSAGE_TYPE, PING_FILE, ROUTES_CSV


def _named(payload: str) -> list[Column]:
    return [F.col(f"{payload}.{name}").alias(out) for name, (out, _) in MESSAGE_FIELDS.items()]


def has_identity(vehicle: Column, seconds: Column) -> Column:
    """A ping needs a vehicle and a time: null, empty and 0 don't count."""
    return vehicle.isNotNull() & (vehicle != "") & seconds.isNotNull() & (seconds != 0)


def unwrap(rows: DataFrame) -> DataFrame:
    """Pings of rows with the envelope as a struct."""
    extra = [c for c in rows.columns if c != ENVELOPE]
    return rows.select(*extra, *_named(ENVELOPE)).where(has_identity(F.col("vehicle"), F.col("datetime")))


def read_array_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Pings of files that each hold a JSON array of envelopes, with the file's part and number."""
    rows = spark.read.schema(PING_FILE).option("multiLine", True).json(paths)
    name = F.col("_metadata.file_path")
    return unwrap(rows.select(ENVELOPE, F.regexp_extract(name, r"part(\d+)/[^/]*$", 1).cast("int").alias("part"), F.regexp_extract(name, r"sub_raw_(\d+)\.json", 1).cast("int").alias("file_no")))


def decode_array_text(rows: DataFrame, value: str = "value") -> DataFrame:
    """Pings of rows whose text is such an array."""
    return unwrap(rows.select(F.explode(F.from_json(value, f"array<struct<{PING_FILE.replace(' struct', ':struct', 1)}>>")).alias("r")).select("r.*"))


def in_replay_order(pings: DataFrame) -> DataFrame:
    """arrival: the order of replay, by part, file number and time; rows are in it within their files' order."""
    return pings.withColumn("arrival", F.struct("part", "file_no", "datetime")).orderBy("arrival")


def read_messages(rows: DataFrame, value: str = "value") -> DataFrame:
    """Pings of JSON messages, other columns kept.

    Numbers and booleans may come as text or as 1 and 0; what can't be read is
    null.  Broken messages, ones without envelope, and pings without vehicle or
    time are left out.
    """
    extra = [c for c in rows.columns if c != value]
    fields = ", ".join(f"{name}: string" for name in MESSAGE_FIELDS)
    schema = f"{ENVELOPE} struct<{fields}>, _broken string"
    # every field as text, in one parse; the generator keeps the optimiser from parsing again for each field and test
    parsed = F.from_json(value, schema, {"columnNameOfCorruptRecord": "_broken"})
    rows = rows.select(*extra, F.explode_outer(F.array(parsed)).alias("_m")).where("_m._broken is null")

    def field(name: str, kind: str) -> Column:
        text = f"_m.{ENVELOPE}.{name}"
        if kind == "string":
            return F.col(text)
        if kind == "bigint":  # a whole number, or the whole part of another
            return F.expr(f"coalesce(try_cast({text} AS bigint), try_cast(try_cast({text} AS double) AS bigint))")
        return F.expr(f"try_cast({text} AS {kind})")

    out = rows.select(*extra, *[field(name, kind).alias(as_) for name, (as_, kind) in MESSAGE_FIELDS.items()])
    return out.where(has_identity(F.col("vehicle"), F.col("datetime")))


def read_routes_csv(spark: SparkSession, path: str) -> DataFrame:
    """(vehicle, route_id, route_no) of a CSV with a header; short lines are skipped, the last of a vehicle wins.

    A file that can't be found gives no routes, with a warning: every vehicle's is unknown then.
    """
    try:
        raw = spark.read.option("header", True).schema(ROUTES_CSV).option("mode", "PERMISSIVE").csv(path)
    except AnalysisException as error:
        warnings.warn(f"no routes: {error}", stacklevel=2)
        raw = spark.createDataFrame([], ROUTES_CSV)
    return last_routes(raw.withColumn("line", F.monotonically_increasing_id()))


def last_routes(rows: DataFrame, order: str = "line") -> DataFrame:
    trimmed = rows.select(*[F.trim(c).alias(c) for c in ("vehicle", "route_id", "route_no")], order).where("vehicle is not null and route_no is not null")
    return trimmed.groupBy("vehicle").agg(F.max_by(F.struct("route_id", "route_no"), order).alias("r")).select("vehicle", "r.*")


def kafka_pings(spark: SparkSession, servers: str, topic: str, per_trigger: int = 100_000) -> DataFrame:
    """A stream of pings from Kafka, from the earliest offsets; needs the Kafka connector on the class path."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", "earliest").option("maxOffsetsPerTrigger", per_trigger).load()
    return read_messages(raw.select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("received")))


def to_kafka_rows(pings: DataFrame) -> DataFrame:
    """(key, value) rows for a Kafka sink: the vehicle, and the message with its envelope."""
    payload = F.struct(*[F.col(as_).alias(name) for name, (as_, _) in MESSAGE_FIELDS.items()])
    return pings.select(F.col("vehicle").alias("key"), F.to_json(F.struct(F.lit(MESSAGE_TYPE).alias("msgType"), payload.alias(ENVELOPE)), {"ignoreNullFields": "false"}).alias("value"))


def replay_gaps(pings: DataFrame, speed: float) -> DataFrame:
    """wait_s: seconds to wait before each ping when files are replayed one after the other at a speed (0: none).

    A ping waits for the one before it in its file, a file's first for the last
    of the file before; going back in time waits for nothing.  Files' last times
    are a row a file.
    """
    if not speed:
        return pings.withColumn("wait_s", F.lit(0.0))
    lasts = pings.groupBy("part", "file_no").agg(F.max("datetime").alias("_last"))
    lasts = lasts.withColumn("_last", F.lag("_last").over(W.orderBy("part", "file_no")))
    before = F.lag("datetime").over(W.partitionBy("part", "file_no").orderBy("datetime"))
    out = pings.withColumn("_before", before).join(lasts, ["part", "file_no"], "left")
    gap = (F.col("datetime") - F.coalesce("_before", "_last")) / F.lit(float(speed))
    return out.withColumn("wait_s", F.greatest(F.lit(0.0), F.coalesce(gap, F.lit(0.0)))).drop("_before", "_last")


def write_kafka(pings: DataFrame, servers: str, topic: str) -> None:
    """Send pings as messages; needs the Kafka connector on the class path."""
    out = to_kafka_rows(pings).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    out.option("kafka.compression.type", "lz4").option("kafka.linger.ms", 5).save()


#: Where the sinks put what they store, and how many objects the analyses take of each at most.
STORED = {"trips": ("trips", 2000), "features": ("features/vehicle-hourly", 5000), "anomalies": ("anomalies", None), "archive": ("archive", 300)}


def read_stored(spark: SparkSession, path: str, kind: str, prefix: str = "", capped: bool = False) -> DataFrame:
    """Stored trips, features, anomalies or archived pings; of the archive, dates with a prefix; capped: no more rows than the analyses take.

    Anomalies come newest first.
    """
    folder, most = STORED[kind]
    rows = spark.read.parquet(f"{path}/{folder}")
    if kind == "archive":
        rows = rows.where(F.col("date").cast("string").startswith(prefix))
    if kind == "anomalies":
        rows = rows.orderBy(F.desc("datetime"), "vehicle")
    return rows.limit(most) if capped and most else rows


def for_map(messages: DataFrame) -> DataFrame:
    """Updates that a map can show: of a vehicle, with a place that is a number."""
    known = lambda c: F.col(c).isNotNull() & ~F.isnan(c)
    return messages.where(F.col("vehicle").isNotNull() & (F.col("vehicle") != "") & known("x") & known("y"))


