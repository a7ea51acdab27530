"""Great-circle distance and speed."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius in metres and the degree-to-radian factor.
EARTH_RADIUS_M = 6370693.5
RADIANS = 0.01745329252
KM_A_DEGREE = EARTH_RADIUS_M * RADIANS / 1000


# The parts of a position that every distance from it needs, computed once per row.
SPHERE = ["east", "sin_north", "cos_north"]


def sphere_columns(lon: Column, lat: Column) -> list[Column]:
    angle = lat * F.lit(RADIANS)
    return [
        (lon * F.lit(RADIANS)).alias("east"),
        F.sin(angle).alias("sin_north"),
        F.cos(angle).alias("cos_north"),
    ]


def sphere_distance_km(a: list[Column], b: list[Column]) -> Column:
    """Whole kilometres between two positions given by their ``SPHERE`` parts."""
    east_a, sin_a, cos_a = a
    east_b, sin_b, cos_b = b
    cosine = sin_a * sin_b + cos_a * cos_b * F.cos(east_a - east_b)
    metres = F.lit(EARTH_RADIUS_M) * F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))
    return F.round(metres / F.lit(1000.0)).cast("long")


def distance_km(lon_a: Column, lat_a: Column, lon_b: Column, lat_b: Column) -> Column:
    return sphere_distance_km(sphere_columns(lon_a, lat_a), sphere_columns(lon_b, lat_b))


def speed_kmh(km: Column, hours: Column) -> Column:
    """Truncated km/h; no time between the sightings gives 0."""
    return F.when(hours == 0, F.lit(0)).otherwise(F.floor(km / hours)).cast("long")


def widest_distance_km(west: float, south: float, east: float, north: float) -> float:
    """No two points of the box are further apart than this (haversine over its extents)."""
    half_height = min(north - south, 180.0) * RADIANS / 2
    half_width = min(east - west, 180.0) * RADIANS / 2
    nearest_equator = 0.0 if south <= 0.0 <= north else min(abs(south), abs(north))
    chord = math.sin(half_height) ** 2 + (math.cos(nearest_equator * RADIANS) * math.sin(half_width)) ** 2
    return 2 * math.asin(min(1.0, math.sqrt(chord))) * EARTH_RADIUS_M / 1000 + 1


def longest_flagged_gap_s(widest_km: float, max_kmh: float) -> int:
    """Seconds beyond which no pair within ``widest_km`` can be faster than ``max_kmh``.

    A speed is truncated before it is compared, so a flagged one is at least the next
    whole km/h; hours are rounded to four decimals, which is worth under a second.
    """
    if max_kmh < 0:
        raise ValueError("a speed limit is not negative")
    return math.ceil(3600 * widest_km / (math.floor(max_kmh) + 1)) + 1
