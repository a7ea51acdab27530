import pytest
from pyspark.sql import functions as F

from platewatch.functions.clock import (
    epoch_seconds,
    format_time,
    gap_hours,
    moment_literal,
    parse_time,
    whole_second,
)
from platewatch.functions.geo import (
    distance_km,
    longest_flagged_gap_s,
    speed_kmh,
    widest_distance_km,
)
from tests.fixtures import distance, speed


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "a, b, km",
    [
        ((113, 0), (114, 0), 111),
        ((113, 22), (113, 23), 111),
        ((0, 0), (180, 0), 20014),
        ((113.55, 22.27), (113.55, 22.27), 0),
        ((113.55, 22.27), (113.26, 23.13), 100),
        ((113.55, 22.27), (114.06, 22.54), 60),
        ((113.55, 22.27), (116.40, 39.90), 1979),
        ((116.40, 39.90), (121.47, 31.23), 1067),
    ],
)
def test_distance(spark, a, b, km):
    got = value(spark, distance_km(*[F.lit(float(x)) for x in (*a, *b)]))
    assert got == km == distance(*a, *b)


@pytest.mark.parametrize(
    "km, gap, hours, kmh",
    [
        (111, 1800, 0.5, 222),
        (111, 2200, 0.6111, 181),
        (111, 2210, 0.6139, 180),
        (111, 2220, 0.6167, 179),
        (111, 0, 0.0, 0),
        (1, 1, 0.0003, 3333),
        (0, 60, 0.0167, 0),
    ],
)
def test_speed(spark, km, gap, hours, kmh):
    assert value(spark, gap_hours(F.lit(gap))) == hours
    assert value(spark, speed_kmh(F.lit(km), gap_hours(F.lit(-gap)))) == kmh == speed(km, gap)


@pytest.mark.parametrize(
    "text, moment",
    [
        ("2024-01-01 10:00:00", "2024-01-01 10:00:00"),
        ("2024-1-2 3:04:05", "2024-01-02 03:04:05"),
        ("2024-01-01 10:00:00.5 more", "2024-01-01 10:00:00"),
        ("2024-02-30 10:00:00", None),
        ("2024-01-01", None),
        ("bad", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_time(spark, text, moment):
    assert value(spark, format_time(parse_time(F.lit(text).cast("string")))) == moment


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Shanghai"])
def test_seconds_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist in New York on this day.
        moment = moment_literal("2024-03-10 02:30:15.75")
        assert value(spark, epoch_seconds(moment)) == 1710037815
        assert value(spark, whole_second(moment).cast("string")) == "2024-03-10 02:30:15"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_twelve_hour_clock(spark):
    def seconds(text):
        return value(spark, epoch_seconds(moment_literal(text), clock12=True)) % 86400

    assert seconds("2024-01-01 12:30:00") == 1800
    assert seconds("2024-01-01 00:40:00") == 2400
    assert seconds("2024-01-01 13:00:00") == 13 * 3600


def test_no_pair_of_a_box_is_wider_than_its_bound():
    import random

    rng = random.Random(5)
    for _ in range(300):
        west, east = sorted(rng.uniform(-180, 180) for _ in range(2))
        south, north = sorted(rng.uniform(-90, 90) for _ in range(2))
        bound = widest_distance_km(west, south, east, north)
        corners = [(x, y) for x in (west, east) for y in (south, north)]
        points = corners + [(rng.uniform(west, east), rng.uniform(south, north)) for _ in range(10)]
        assert max(distance(*a, *b) for a in points for b in points) <= bound


def test_longest_gap_misses_no_fast_pair():
    for km in (1, 60, 1979, 20014):
        for limit in (80, 180, 180.5, 10_000):
            gap = longest_flagged_gap_s(km, limit)
            assert all(speed(km, g) <= limit for g in range(gap + 1, gap + 2000))
