"""GPS-shaped pings and routes derived from the driver's tables, as FIXTURES.md specifies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import ENVELOPE, MESSAGE_TYPE

#: The pings, once as Spark SQL; plans/oracle.py has the same for DuckDB.
GPS = """
SELECT concat('vehicle-', lpad(cast(user_id AS string), 6, '0')) AS vehicle,
  1704067200 + (unix_micros(cast(ts AS timestamp)) - 1704067200000000) div 120000000 + (user_id % 3) * 86400 + (user_id % 4) * 18000 AS datetime,
  CASE WHEN event_id % 53 = 5 THEN NULL ELSE 106.39e0 + ((user_id * 37) % 711) / 1000e0 + ((event_id * 7919) % 21 - 10) / 2000e0 END AS x,
  CASE WHEN event_id % 59 = 6 THEN NULL ELSE 10.29e0 + ((user_id * 53) % 911) / 1000e0 + ((event_id * 104729) % 21 - 10) / 2000e0 END AS y,
  CASE WHEN event_id % 17 = 3 THEN NULL WHEN event_id % 101 = 4 THEN -value ELSE value END AS speed,
  CASE WHEN event_id % 11 = 2 THEN NULL ELSE cast((event_id * 131) % 360 AS double) END AS heading,
  CASE WHEN event_id % 23 = 9 THEN NULL ELSE event_id % 3 <> 0 END AS ignition,
  CASE WHEN event_id % 29 = 9 THEN NULL ELSE event_id % 4 = 0 END AS aircon,
  event_id % 5 <> 0 AS working,
  CASE WHEN event_id % 7 = 1 THEN NULL ELSE event_id % 2 = 0 END AS doorUp,
  CASE WHEN event_id % 7 = 1 THEN NULL ELSE event_id % 6 = 0 END AS doorDown,
  concat('driver-', cast(user_id % 97 AS string)) AS driver, event_id, copy
FROM (SELECT 0 AS copy, * FROM {events} UNION ALL SELECT 1 AS copy, * FROM {events} WHERE event_id % 50 = 7) u
"""
ROUTES = """
SELECT concat('vehicle-', lpad(cast(c_custkey AS string), 6, '0')) AS vehicle, concat('R', cast(c_nationkey AS string)) AS route_id, cast(c_nationkey AS string) AS route_no
FROM {customer} WHERE c_mktsegment <> 'FURNITURE'
"""


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(GPS, events=spark.read.parquet(f"{sf_dir}/events.parquet"))


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ROUTES, customer=spark.read.parquet(f"{sf_dir}/customer.parquet"))


def _payload(as_text: bool):
    kind = lambda c: F.col(c).cast("string") if as_text else F.col(c)
    return F.struct(
        F.when(F.col("event_id") % 97 != 3, F.col("vehicle")).alias("vehicle"), "driver", F.when(F.col("event_id") % 97 != 4, kind("datetime")).alias("datetime"),
        kind("x").alias("x"), kind("y").alias("y"), kind("speed").alias("speed"), kind("heading").alias("heading"),
        (F.col("ignition").cast("int") if as_text else F.col("ignition")).alias("ignition"), "aircon", "working",
        F.col("doorUp").alias("door_up"), F.col("doorDown").alias("door_down"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings as JSON messages (key, value, event_id, copy): some broken, some with numbers as text."""
    wrap = lambda p: F.to_json(F.struct(F.lit(MESSAGE_TYPE).alias("msgType"), p.alias(ENVELOPE)))
    n = F.col("event_id") % 97
    value = (
        F.when(n == 1, F.lit('{"msgType": "broken'))
        .when(n == 2, F.to_json(F.struct(F.lit(MESSAGE_TYPE).alias("msgType"))))
        .when(n == 5, F.lit(None).cast("string"))
        .when(F.col("event_id") % 5 == 0, wrap(_payload(True)))
        .otherwise(wrap(_payload(False)))
    )
    return pings(spark, sf_dir).select(F.col("vehicle").alias("key"), value.alias("value"), "event_id", "copy")


def array_files(spark: SparkSession, sf_dir: str, per_file: int = 500) -> DataFrame:
    """Pings as the text of JSON-array files (n, value); some records lack a vehicle or a time."""
    empty = F.when(F.col("event_id") % 89 == 7, F.lit("")).when(F.col("event_id") % 89 == 8, F.lit(None)).otherwise(F.col("vehicle"))
    when = F.when(F.col("event_id") % 83 == 9, F.lit(0)).when(F.col("event_id") % 83 == 10, F.lit(None)).otherwise(F.col("datetime"))
    payload = F.struct(
        empty.alias("vehicle"), "driver", when.alias("datetime"), "x", "y", "speed", "heading", "ignition", "aircon", "working",
        F.col("doorUp").alias("door_up"), F.col("doorDown").alias("door_down"),
    )
    rows = pings(spark, sf_dir).select((F.col("event_id").cast("long") / per_file).cast("long").alias("n"), F.struct(payload.alias(ENVELOPE)).alias("r"))
    return rows.groupBy("n").agg(F.to_json(F.collect_list("r")).alias("value"))
