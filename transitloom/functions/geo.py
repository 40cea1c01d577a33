"""Distances and boxes on coordinates in degrees, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Metres of a degree of latitude.
DEGREE = 111320.0


def distance_metres(lat: Column, lon: Column, lat2: Column, lon2: Column) -> Column:
    """Distance on a plane at the middle latitude."""
    return F.hypot((lat - lat2) * DEGREE, (lon - lon2) * DEGREE * F.cos(F.radians((lat + lat2) / 2)))


def box(lat: Column, lon: Column, radius: float) -> Column:
    """``south,west,north,east`` with six decimals, widened to the east and west by latitude."""
    wide = F.lit(radius) / F.greatest(F.lit(0.35), F.abs(F.cos(F.radians(lat))))
    return F.format_string("%.6f,%.6f,%.6f,%.6f", lat - radius, lon - wide, lat + radius, lon + wide)


def box_lon_first(lat: Column, lon: Column, radius: float = 0.2) -> Column:
    """``west,south,east,north``, the order that some services ask for."""
    wide = F.lit(radius) / F.greatest(F.lit(0.35), F.abs(F.cos(F.radians(lat))))
    return F.format_string("%.6f,%.6f,%.6f,%.6f", lon - wide, lat - radius, lon + wide, lat + radius)


def spread_metres(lat: Column, lon: Column, mean_lat: Column, mean_lon: Column) -> Column:
    """Distance to a mean point on a plane at the mean's latitude."""
    return F.hypot((lat - mean_lat) * DEGREE, (lon - mean_lon) * DEGREE * F.cos(F.radians(mean_lat)))


def ten_thousandths(c: Column) -> Column:
    """The number of ten-thousandths next to the exact binary value of a double below 2^30, ties to even.

    ``round`` works on decimal text and differs where the binary value lies just
    beside a tie. Here the value is split in two halves whose products with 20000
    are exact, so the comparison with the tie is.
    """
    low = F.floor(c * 10000).cast("long")
    spread = c * F.lit(134217729.0)
    high = spread - (spread - c)
    beside = (high * 20000 - (2 * low + 1).cast("double")) + (c - high) * 20000
    return low + F.when((beside > 0) | ((beside == 0) & (F.abs(low) % 2 == 1)), 1).otherwise(0)


def travel_budget(minutes: Column) -> Column:
    """Metres that a vehicle may have come in so many minutes."""
    return F.lit(2000.0) + minutes * 2500.0


def preference_radius(minutes: Column) -> Column:
    """Metres around anchors in which candidates are preferred, from the minutes to each; half to even."""
    budgets = F.transform(minutes, travel_budget)
    return F.bround(F.least(F.lit(20000.0), F.greatest(F.lit(2000.0), F.coalesce(F.array_max(budgets), F.lit(2000.0))))).cast("long")


def in_polygon(lat: Column, lon: Column, ring: Column) -> Column:
    """Even-odd rule over ``ring``, an array of ``struct(lat, lon)`` whose last point is not the first."""
    n = F.size(ring)
    crossings = F.aggregate(
        F.sequence(F.lit(0), n - 1),
        F.lit(0),
        lambda acc, i: acc
        + F.when(
            ((F.get(ring, i)["lat"] > lat) != (F.get(ring, (i + 1) % n)["lat"] > lat))
            & (lon < (F.get(ring, (i + 1) % n)["lon"] - F.get(ring, i)["lon"]) * (lat - F.get(ring, i)["lat"]) / (F.get(ring, (i + 1) % n)["lat"] - F.get(ring, i)["lat"]) + F.get(ring, i)["lon"]),
            1,
        ).otherwise(0),
    )
    return crossings % 2 == 1
