"""Small numeric and text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def r6(c: Column) -> Column:
    return F.round(c, 6)


def or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def flag(c: Column) -> Column:
    """A boolean as '1' or '0'; null stays."""
    return c.cast("int").cast("string")


def short_id(vehicle: Column, n: int = 8) -> Column:
    return F.substring(vehicle, 1, n)


def route_hue(route: Column) -> Column:
    """A stable hue for a route: a shift-and-add hash of its characters, modulo 360; null (grey) for none or the unknown route.

    Only the shifted term has 32 bits; the sum does not wrap.
    """
    codes = F.transform(F.filter(F.split(route, ""), lambda c: c != ""), lambda c: F.ascii(c).cast("long"))
    wrap = lambda v: F.pmod(v + F.lit(1 << 31), F.lit(1 << 32)) - F.lit(1 << 31)
    total = F.aggregate(codes, F.lit(0).cast("long"), lambda h, c: c + (wrap(wrap(h) * 32) - h))
    return F.when(F.coalesce(route, F.lit("")).isin("", "UNKNOWN"), F.lit(None)).otherwise(F.pmod(F.abs(total), F.lit(360))).cast("int")


def without_prefix(key: Column, prefix: str) -> Column:
    """A key without its prefix; other keys stay."""
    return F.when(F.startswith(key, F.lit(prefix)), F.substr(key, F.lit(len(prefix) + 1))).otherwise(key)
