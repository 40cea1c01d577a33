"""Identifiers and clock times of timetable feeds, as Column expressions; what does not have the form gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _part(c: Column, pattern: str, i: int) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, i), F.lit(""))


def trip_parts(c: Column) -> Column:
    """``struct(route, distinction, trip)`` of ``jdf:trip:<route>:<distinction>:<trip>``."""
    form = r"^jdf:trip:([^:]+):(\d+):(\d+)"
    return F.when(c.rlike(form), F.struct(_part(c, form, 1).alias("route"), _part(c, form, 2).cast("int").alias("distinction"), _part(c, form, 3).cast("int").alias("trip")))


def place_number(c: Column) -> Column:
    """The number of a place ``jdf:stop:<n>``, the whole of which must match."""
    return _part(c, r"^jdf:stop:(\d+)$", 1)


def post_place_number(c: Column) -> Column:
    """The place's number of a boarding place ``jdf:stop:<n>:...``."""
    return _part(c, r"^jdf:stop:(\d+):", 1)


def clock_minutes(c: Column) -> Column:
    """Minutes of ``H:MM:SS``, where hours may pass 24; blank gives null."""
    at = F.split(F.nullif(F.trim(c), F.lit("")), ":")
    part = lambda i: F.get(at, F.lit(i)).cast("double")
    return part(0) * 60 + part(1) + F.coalesce(part(2), F.lit(0.0)) / 60


def place_of(stop_id: Column, parent: Column) -> Column:
    """The parent station, else the stop itself."""
    return F.coalesce(F.nullif(F.trim(parent), F.lit("")), stop_id)
