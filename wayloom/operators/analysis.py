"""Offline analyses: travel times, congestion, anomalies, features' principal components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clock import date_of, hour_of
from ..functions.geo import cell
from ..settings import DEFAULTS, Settings
from .windows import FEATURE_COLUMNS


def plausible(trips: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Trips of a believable length, with minutes, hour and date (UTC)."""
    rows = trips.withColumn("duration_min", F.col("duration_s") / 60).where(F.col("duration_min").between(s.trip_min_minutes, s.trip_max_minutes))
    return rows.withColumn("hour", hour_of(F.col("trip_start"))).withColumn("date", date_of(F.col("trip_start")))


def top(rows: DataFrame, by: str, k: int, name: str = "n") -> DataFrame:
    """The k most frequent values; ties by value."""
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), by).limit(k)


def travel_times(good: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Quartiles of minutes per route and hour, for the routes with most trips (k rows, broadcast)."""
    routes = F.broadcast(top(good, "route_no", s.top_trip_routes).select("route_no"))
    q = F.percentile("duration_min", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    out = good.join(routes, "route_no", "left_semi").groupBy("route_no", "hour").agg(q.alias("q"), F.count(F.lit(1)).alias("trips"))
    return out.select("route_no", "hour", "trips", F.col("q")[0].alias("p25_min"), F.col("q")[1].alias("median_min"), F.col("q")[2].alias("p75_min"))


def travel_time_table(good: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """The medians as a table: a row a route, a column an hour."""
    return travel_times(good, s).groupBy("route_no").pivot("hour", list(range(24))).agg(F.first("median_min"))


def event_impact(good: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Median minutes on the event day against other days, for routes with both."""
    day = F.col("date") == s.event_day
    out = good.groupBy("route_no").agg(F.median(F.when(day, F.col("duration_min"))).alias("event_min"), F.median(F.when(~day, F.col("duration_min"))).alias("baseline_min"))
    return out.where("event_min is not null and baseline_min is not null").withColumn("impact", F.col("event_min") / F.col("baseline_min"))


def congestion(pings: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Mean speed and number of speeds per grid cell and hour (UTC); cells without speeds are left out."""
    out = pings.where("x is not null and y is not null").groupBy(cell(F.col("y"), s.cell_degrees).alias("lat_cell"), cell(F.col("x"), s.cell_degrees).alias("lon_cell"), hour_of(F.col("datetime")).alias("hour")).agg(
        F.avg("speed").alias("mean_speed"), F.count("speed").alias("count")
    ).where("mean_speed is not null")
    return out.withColumn("grid_lat", F.col("lat_cell") * s.cell_degrees).withColumn("grid_lon", F.col("lon_cell") * s.cell_degrees)


def congestion_map(grid: DataFrame, hour: int) -> DataFrame:
    """How congested cells are in one hour: 1 less the share of the fastest cell's mean speed."""
    rows = grid.where(F.col("hour") == hour)
    most = F.broadcast(rows.agg(F.coalesce(F.when(F.max("mean_speed") != 0, F.max("mean_speed")), F.lit(1.0)).alias("most")))  # one row
    return rows.crossJoin(most).withColumn("intensity", F.greatest(F.lit(0.0), 1 - F.col("mean_speed") / F.col("most"))).drop("most")


def per_hour(anomalies: DataFrame) -> DataFrame:
    """Counts for every hour from the first to the last, empty ones too."""
    hour = (F.col("datetime") - F.pmod("datetime", F.lit(3600))).alias("hour_start")
    counts = anomalies.groupBy(hour).agg(F.count(F.lit(1)).alias("n"))
    hours = counts.agg(F.min("hour_start").alias("a"), F.max("hour_start").alias("b")).where("a is not null").select(F.explode(F.sequence("a", "b", F.lit(3600))).alias("hour_start"))
    return hours.join(counts, "hour_start", "left").select("hour_start", F.coalesce("n", F.lit(0)).alias("n"))


def histogram(values: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Counts in equal bins from the least to the greatest value; the greatest is in the last; empty bins too."""
    ends = values.agg(F.min(column).alias("low"), F.max(column).alias("high"))  # one row
    at = F.when(F.col("high") > F.col("low"), F.least(F.floor((F.col(column) - F.col("low")) / (F.col("high") - F.col("low")) * bins), F.lit(bins - 1))).otherwise(0)
    counts = values.where(F.col(column).isNotNull()).crossJoin(F.broadcast(ends)).groupBy(at.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    all_bins = ends.where("low is not null").select("low", "high", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return all_bins.join(counts, "bin", "left").select("bin", (F.col("low") + (F.col("high") - F.col("low")) * F.col("bin") / bins).alias("low"), F.coalesce("n", F.lit(0)).alias("n"))


def standardized(features: DataFrame, columns: tuple[str, ...] = FEATURE_COLUMNS) -> DataFrame:
    """Features less their mean, by their population deviation; constant ones are 0.

    One aggregate gives a row of means and deviations, which is broadcast.
    """
    rows = features.na.fill(0, list(columns))
    stats = rows.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("mean", F.avg), ("dev", F.stddev_pop))])
    z = [F.coalesce(F.when(F.col(f"dev_{c}") > 0, (F.col(c) - F.col(f"mean_{c}")) / F.col(f"dev_{c}")), F.lit(0.0)).alias(c) for c in columns]
    keys = [c for c in rows.columns if c not in columns]
    return rows.crossJoin(F.broadcast(stats)).select(*keys, *z)


def correlations(features: DataFrame, columns: tuple[str, ...] = FEATURE_COLUMNS) -> DataFrame:
    """(a, b, r) for all pairs of features, from one pass over the rows."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = features.na.fill(0, list(columns)).agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}|{b}").alias("r")) for a, b in pairs])
    return row.select(F.explode(cells).alias("c")).select("c.*")


def principal_axes(features: DataFrame, columns: tuple[str, ...] = FEATURE_COLUMNS) -> tuple[np.ndarray, np.ndarray]:
    """Variances and axes (a row each) of standardised features, largest first.

    The correlation matrix, a few dozen numbers, is all that reaches the
    driver.  An axis' largest loading is positive.
    """
    n = len(columns)
    m = np.zeros((n, n))
    for r in correlations(features, columns).collect():
        i, j = columns.index(r["a"]), columns.index(r["b"])
        m[i, j] = m[j, i] = 0.0 if r["r"] is None or np.isnan(r["r"]) else r["r"]
    values, vectors = np.linalg.eigh(m)
    order = np.argsort(-values, kind="stable")
    axes = vectors[:, order].T
    signs = np.sign(axes[np.arange(n), np.argmax(np.abs(axes), axis=1)])
    return np.maximum(values[order], 0), axes * np.where(signs == 0, 1, signs)[:, None]


def explained_variance(features: DataFrame) -> DataFrame:
    values, _ = principal_axes(features)
    share = values / max(values.sum(), 1e-12)
    return features.sparkSession.createDataFrame([(i + 1, float(a), float(b)) for i, (a, b) in enumerate(zip(share, share.cumsum()))], "component int, ratio double, cumulative double")


def loadings(features: DataFrame, k: int = 4) -> DataFrame:
    _, axes = principal_axes(features)
    rows = [(c, *(float(axes[p, i]) for p in range(k))) for i, c in enumerate(FEATURE_COLUMNS)]
    return features.sparkSession.createDataFrame(rows, "feature string, " + ", ".join(f"pc{p + 1} double" for p in range(k)))


def scores(features: DataFrame, k: int = 4) -> DataFrame:
    _, axes = principal_axes(features)
    z = standardized(features)
    pcs = [sum((F.col(c) * F.lit(float(axes[p, i])) for i, c in enumerate(FEATURE_COLUMNS)), F.lit(0.0)).alias(f"pc{p + 1}") for p in range(k)]
    return z.select("vehicle", "route_no", "window_start_ms", *pcs)
