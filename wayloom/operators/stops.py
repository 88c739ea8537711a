"""Stops of vehicles, and their clusters."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.geo import central_angle
from ..settings import DEFAULTS, Settings
from .pings import ARRIVAL


def stops(pings: DataFrame, s: Settings = DEFAULTS, order: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """Standing periods: from a ping slower than idle to the next one at restart speed.

    Pings between the two speeds change nothing, so only the others matter; a
    stop starts at a slow one that follows none or a fast one, and ends at a
    fast one that follows a slow one.  A stop still open at the end is left out.
    """
    speed = F.coalesce("speed", F.lit(0.0))
    kind = F.when(speed < s.idle_kmh, "slow").when(speed >= s.restart_kmh, "fast")
    by = W.partitionBy("vehicle").orderBy(*order)
    turns = pings.withColumn("kind", kind).where("kind is not null").withColumn("before", F.lag("kind").over(by))
    turns = turns.where("(kind = 'slow' and coalesce(before, 'fast') = 'fast') or (kind = 'fast' and before = 'slow')")
    turns = turns.withColumn("start", F.lag(F.struct("datetime", "x", "y")).over(by)).where("kind = 'fast'")
    out = turns.select("vehicle", F.col("start.y").alias("lat"), F.col("start.x").alias("lon"), (F.col("datetime") - F.col("start.datetime")).alias("duration_s"), F.col("start.datetime").alias("start_ts"), F.col("datetime").alias("end_ts"))
    return out.where(F.col("duration_s") >= s.stop_seconds)


def _places(points: DataFrame) -> DataFrame:
    """Distinct places with their number of stops: stops at one place are clustered once."""
    return points.where("lat is not null and lon is not null").groupBy("lat", "lon").agg(F.count(F.lit(1)).alias("weight"))


def neighbours(points: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Pairs of places (a, b), each its own neighbour too, within eps; b's weight.

    Places are put in grid cells at least eps wide; a place meets those of the
    nine cells around its own.
    """
    eps = s.cluster_eps_radians
    wide_lat = math.degrees(eps)
    wide_lon = wide_lat / math.cos(math.radians(min(89.0, max(abs(s.lat_min), abs(s.lat_max)) + wide_lat)))
    at = _places(points).withColumn("i", F.floor(F.col("lat") / wide_lat)).withColumn("j", F.floor(F.col("lon") / wide_lon))
    around = at.withColumn("di", F.explode(F.array(*[F.lit(d) for d in (-1, 0, 1)]))).withColumn("dj", F.explode(F.array(*[F.lit(d) for d in (-1, 0, 1)])))
    around = around.select(F.struct("lat", "lon").alias("a"), (F.col("i") + F.col("di")).alias("i"), (F.col("j") + F.col("dj")).alias("j"))
    here = at.select(F.struct("lat", "lon").alias("b"), "weight", "i", "j")
    pairs = around.join(here, ["i", "j"])
    near = central_angle(F.col("a.lat"), F.col("a.lon"), F.col("b.lat"), F.col("b.lon")) <= eps
    return pairs.where((F.col("a") == F.col("b")) | near).select("a", "b", "weight")


def neighbour_counts(points: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Stops within eps of each place, its own included."""
    return neighbours(points, s).groupBy("a").agg(F.sum("weight").alias("neighbours")).select("a.lat", "a.lon", "neighbours")


def _celled(places: DataFrame, s: Settings) -> DataFrame:
    """Adds the cell (i, j) of a place: two places of one cell are always within eps of each other."""
    side = math.degrees(s.cluster_eps_radians) / math.sqrt(2) * (1 - 1e-9)
    return places.withColumn("i", F.floor(F.col("lat") / side)).withColumn("j", F.floor(F.col("lon") / side))


def _around(cells: DataFrame, s: Settings) -> DataFrame:
    """(ci, cj) of rows in cells (i, j): the cells that hold places within eps, the row's own among them."""
    tall = 2
    wide = math.ceil(math.sqrt(2) / math.cos(math.radians(min(89.0, max(abs(s.lat_min), abs(s.lat_max)) + math.degrees(s.cluster_eps_radians)))) + 1e-6)
    out = cells.withColumn("di", F.explode(F.array(*[F.lit(d) for d in range(-tall, tall + 1)]))).withColumn("dj", F.explode(F.array(*[F.lit(d) for d in range(-wide, wide + 1)])))
    return out.withColumn("ci", F.col("i") + F.col("di")).withColumn("cj", F.col("j") + F.col("dj")).drop("di", "dj")


def with_clusters(points: DataFrame, s: Settings = DEFAULTS, folder: str | None = None) -> DataFrame:
    """Adds ``cluster``: density-connected stops share one, -1 is noise.

    Places are put in cells so small that those of one are neighbours.  In a
    cell with enough stops every place is core, without a look at pairs; only
    places of other cells, which are few in each, are compared with the cells
    around.  Core places of a cell share a cluster, so cells are linked, not
    places: two cells by a pair of core places within eps, sought first among a
    few of each cell and then, if there is none, among all.  Labels of cells
    spread to linked cells by minimum until they rest; each round is one join
    and one aggregate, written to ``folder`` (default: the cluster's shared
    checkpoint folder).  A border place joins the least label among its core
    neighbours.  Labels are numbers from 0 in the order of the clusters' least
    core (lat, lon).
    """
    spark = points.sparkSession
    if folder is None:
        folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if folder is None:
        raise ValueError("set spark.checkpoint.dir, or give a folder, that all executors share")

    def settled(df: DataFrame, name: str) -> DataFrame:
        path = f"{folder.rstrip('/')}/wayloom-{uuid.uuid4().hex}/{name}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    near = lambda a, b: central_angle(F.col(f"{a}lat"), F.col(f"{a}lon"), F.col(f"{b}lat"), F.col(f"{b}lon")) <= s.cluster_eps_radians
    places = settled(_celled(_places(points), s), "places")
    dense = places.groupBy("i", "j").agg(F.sum("weight").alias("w")).where(F.col("w") >= s.cluster_min_points).select("i", "j")
    sparse = places.join(dense, ["i", "j"], "left_anti")
    other = places.select(F.col("lat").alias("olat"), F.col("lon").alias("olon"), "weight", F.col("i").alias("ci"), F.col("j").alias("cj"))
    counted = _around(sparse.drop("weight"), s).join(other, ["ci", "cj"])
    counted = counted.where(((F.col("i") == F.col("ci")) & (F.col("j") == F.col("cj"))) | near("", "o")).groupBy("lat", "lon", "i", "j").agg(F.sum("weight").alias("w"))
    core = settled(places.join(dense, ["i", "j"], "left_semi").select("lat", "lon", "i", "j").unionByName(counted.where(F.col("w") >= s.cluster_min_points).select("lat", "lon", "i", "j")), "core")

    # cells with core places, and those near enough to be linked; a few places of each: its ends
    place = F.struct("lat", "lon")
    cells = core.groupBy("i", "j").agg(F.min(place).alias("least"), F.max(place).alias("most"), F.min_by(place, "lon").alias("west"), F.max_by(place, "lon").alias("east"))
    ends = F.array_distinct(F.array("least", "most", "west", "east"))
    few = cells.select("i", "j", F.explode(ends).alias("p")).select("p.lat", "p.lon", "i", "j")
    beside = _around(cells.select("i", "j"), s).where("ci > i or (ci = i and cj > j)").join(cells.select(F.col("i").alias("ci"), F.col("j").alias("cj")), ["ci", "cj"])
    beside = beside.select("i", "j", "ci", "cj")

    def linked(pairs: DataFrame, members: DataFrame) -> DataFrame:
        there = members.select(F.col("lat").alias("olat"), F.col("lon").alias("olon"), F.col("i").alias("ci"), F.col("j").alias("cj"))
        return pairs.join(members.select("lat", "lon", "i", "j"), ["i", "j"]).join(there, ["ci", "cj"]).where(near("", "o")).select("i", "j", "ci", "cj").distinct()

    soon = linked(beside, few)
    links = soon.unionByName(linked(beside.join(soon, ["i", "j", "ci", "cj"], "left_anti"), core))
    links = links.select(F.struct("i", "j").alias("a"), F.struct(F.col("ci").alias("i"), F.col("cj").alias("j")).alias("b"))
    own = cells.select(F.struct("i", "j").alias("a"), F.struct("i", "j").alias("b"))
    links = settled(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).unionByName(own), "links")
    labels = settled(links.groupBy("a").agg(F.min("b").alias("label")), "labels")
    told = lambda df: df.agg(F.sum(F.shiftright(F.xxhash64("a", "label"), 20)), F.bit_xor(F.xxhash64("label", "a"))).first()
    now = told(labels)
    while True:
        spread = links.join(labels.select(F.col("a").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("label"))
        # jump to the label of the label: paths halve each round
        jumped = spread.join(labels.select(F.col("a").alias("label"), F.col("label").alias("further")), "label", "left").select("a", F.least("label", "further").alias("label"))
        after = settled(jumped, "labels")
        before, now, labels = now, told(after), after
        if now == before:  # labels only ever fall, so equal digests are equal labels
            break

    # a cluster's number is the rank of its least core place: ranks within bands of latitude, after the bands before
    owner = cells.join(labels.select("a.i", "a.j", "label"), ["i", "j"])
    heads = owner.groupBy("label").agg(F.min("least").alias("head")).withColumn("band", F.floor(F.col("head.lat") * 100))
    heads = heads.withColumn("n", F.row_number().over(W.partitionBy("band").orderBy("head")))
    bands = heads.groupBy("band").agg(F.max("n").alias("size")).withColumn("before", F.coalesce(F.sum("size").over(W.orderBy("band").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))  # a row a band
    numbers = heads.join(bands.select("band", "before"), "band").select("label", "head", (F.col("before") + F.col("n") - 1).cast("int").alias("cluster"))
    of_cell = owner.join(numbers, "label").select("i", "j", "cluster")
    cored = settled(core.join(of_cell, ["i", "j"]).select("lat", "lon", "i", "j", "cluster"), "core_clusters")

    # the others of sparse cells: the least cluster among core places within eps
    rest = _around(sparse.select("lat", "lon", "i", "j").join(cored.select("lat", "lon"), ["lat", "lon"], "left_anti"), s)
    there = cored.select(F.col("lat").alias("olat"), F.col("lon").alias("olon"), F.col("i").alias("ci"), F.col("j").alias("cj"), "cluster")
    border = rest.join(there, ["ci", "cj"]).where(((F.col("i") == F.col("ci")) & (F.col("j") == F.col("cj"))) | near("", "o")).groupBy("lat", "lon").agg(F.min("cluster").alias("cluster"))
    named = cored.select("lat", "lon", "cluster").unionByName(border)
    return points.join(named, ["lat", "lon"], "left").withColumn("cluster", F.coalesce("cluster", F.lit(-1)))


def clusters(points: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Per cluster (-1: noise): its stops, centre and mean duration."""
    return with_clusters(points, s).groupBy("cluster").agg(F.count(F.lit(1)).alias("stops"), F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.avg("duration_s").alias("mean_duration_s"))
