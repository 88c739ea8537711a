"""Shared pieces: tables, the cluster's shared folder, joins with uneven groups, connected components."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes (rows by the width that the caller states) up to which a table is broadcast; beyond it joins shuffle.
BROADCAST_BYTES = 64 << 20
#: Groups that hold more than this share of all rows are joined by broadcast: there are fewer of them than its inverse.
HOT_SHARE = 1 / 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or for local tests a folder of our own."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="wayloom-"))
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most so many rows in this session: texts are long, and executors hold a batch twice."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def lean() -> None:
    """Let Arrow use malloc in this Python worker: its own pool keeps what it has freed beside what NumPy holds.

    Spark keeps workers for later stages, and they count beside the executor's heap.
    """
    if pa.default_memory_pool().backend_name != "system":
        pa.set_memory_pool(pa.system_memory_pool())


def give_back() -> None:
    """Hand freed memory to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def giving_back(batches_to_batches):
    """A lean worker for mapInArrow, which hands memory back when a task has read its last batch."""

    def run(batches):
        lean()
        yield from batches_to_batches(batches)
        give_back()

    return run


def giving_back_group(table_to_table):
    """The same for applyInArrow, after each group."""

    def run(group: pa.Table) -> pa.Table:
        lean()
        out = table_to_table(group)
        give_back()
        return out

    return run


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/wayloom-{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._wayloom_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete what materialize wrote, once nothing reads it."""
    for df in tables:
        if path := getattr(df, "_wayloom_path", None):
            sc = df.sparkSession.sparkContext
            p = sc._jvm.org.apache.hadoop.fs.Path(path.rpartition("/")[0])
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """The tables of one run of an operator; ``result`` writes the last one and deletes the others."""

    def __init__(self) -> None:
        self.held: list[DataFrame] = []

    def table(self, df: DataFrame, name: str) -> DataFrame:
        self.held.append(materialize(df, name))
        return self.held[-1]

    def result(self, df: DataFrame, name: str) -> DataFrame:
        out = materialize(df, name)
        discard(*self.held)
        self.held = []
        return out


def unused(columns: list[str], *wanted: str) -> list[str]:
    """The wanted names, each with underscores before it until no column has it (Spark does not tell capitals)."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def fits(rows: int, row_bytes: int = 64) -> bool:
    """Whether so many rows of a stated width may be broadcast."""
    return rows * row_bytes <= BROADCAST_BYTES


def small(df: DataFrame, rows: int, row_bytes: int = 64) -> DataFrame:
    """df with a broadcast hint if its counted rows, of a stated width, are within the bound; else as it is."""
    return F.broadcast(df) if fits(rows, row_bytes) else df


def match_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int, how: str = "inner") -> DataFrame:
    """rows joined with groups, a row for each key (both written tables), however uneven the groups are.

    ``size`` is the column of groups with the number of rows of a key, ``total``
    the number of all rows.  Groups of over HOT_SHARE of them are fewer than its
    inverse, so those are broadcast, and none of their rows is shuffled; the
    others are joined by key.  ``how`` is inner or left.
    """
    least = max(1000, int(total * HOT_SHARE))
    hot = groups.where(F.col(size) > least)
    if not hot.head(1):
        return rows.join(groups, keys, how)
    rest = groups.where(F.col(size) <= least)
    others = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(rest, keys, how)
    return rows.join(F.broadcast(hot), keys).unionByName(others)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, comp) of an undirected graph with edges (a, b); comp is the smallest node.

    Alternates large-star and small-star steps until no edge changes.  Each step
    is an aggregate and an equi-join, so no component is gathered in one place.
    Steps only ever hang nodes on smaller ones, so they end; the number of
    rounds grows with the logarithm of the longest path.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    now = materialize(e, "edges")
    state = _digest(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(small(least, 2 * state[0]), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        # every edge now has u > v: small-star hangs u's lower neighbours, and u, on the lowest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        step = (
            large.join(small(low, 2 * state[0]), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        )
        after = materialize(step, "edges")
        told = _digest(after)
        discard(now)
        now = after
        if told == state:
            break
        state = told
    return now.groupBy("u").agg(F.min("v").alias("comp")).withColumnRenamed("u", "node").unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    )


def _digest(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.shiftright(F.xxhash64("u", "v"), 16)), F.bit_xor(F.xxhash64("v", "u"))).first()
    return tuple(r)
