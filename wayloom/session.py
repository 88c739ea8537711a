"""A SparkSession with the settings the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "wayloom", **conf: str) -> SparkSession:
    """UTC, adaptive plans, RocksDB state.  Sizes are left to the cluster unless given in conf."""
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    return SparkSession.builder.appName(app).config(map=base | conf).getOrCreate()
