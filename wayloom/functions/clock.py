"""Epoch seconds as hours, dates and paths, in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_time(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def hour_of(seconds: Column, offset_hours: int = 0) -> Column:
    """Hour of day, 0 to 23."""
    return F.pmod(F.floor((seconds + offset_hours * 3600) / 3600), F.lit(24)).cast("int")


def date_of(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd")


def minute_path(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd/HH-mm")


def window_start(seconds: Column, length: int) -> Column:
    """Start, in epoch seconds, of the epoch-aligned window that holds a time."""
    return (seconds - F.pmod(seconds, F.lit(length))).cast("long")
