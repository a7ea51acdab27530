import pytest

from platewatch.operators import membership
from platewatch.plans.analyses import first_entries
from tests.fixtures import at, plain, plan_of, sightings


@pytest.fixture
def arrivals(spark):
    times = ["10:00:00", "10:01:00", "10:02:00", "10:03:00"]
    return sightings(spark, [(p, t, "k1", 1.0, 1.0) for p, t in zip("AZBZ", times)])


@pytest.fixture
def known(spark):
    return spark.createDataFrame([("A",), ("B",), ("B",), (None,)], "plate string")


def plates(frame):
    return sorted(r.plate for r in frame.collect())


def test_table_joins(arrivals, known):
    once, counts = membership.plate_set(known), membership.plate_counts(known)
    assert plates(membership.watchlist_alerts(arrivals, once)) == ["A", "B"]
    assert plates(membership.seen_before(arrivals, once)) == ["A", "B"]
    assert plates(membership.seen_before_repeated(arrivals, counts)) == ["A", "B", "B"]
    assert plain(membership.seen_before_counted(arrivals, counts).select("plate", "times_seen")) == [("A", 1), ("B", 2)]
    assert plates(membership.first_entry(arrivals, once)) == ["Z", "Z"]
    assert plates(first_entries(arrivals, known, since=at("10:02:00"))) == ["Z"]


def test_repeats_are_numbered_across_blocks(spark, arrivals):
    counts = spark.createDataFrame([("A", 25_001), ("B", 20_000)], "plate string, times_seen long")
    rows = membership.seen_before_repeated(arrivals, counts)
    got = rows.groupBy("plate").agg({"copy": "max", "*": "count"}).select("plate", "max(copy)", "count(1)")
    assert plain(got) == [("A", 25_001, 25_001), ("B", 20_000, 20_000)]
    assert rows.distinct().count() == 45_001


def test_only_a_measured_small_set_is_broadcast(spark, known):
    once = membership.plate_set(known)
    assert "ResolvedHint (strategy=broadcast)" in plan_of(membership.frozen(once))
    large = membership.frozen(once, max_bytes=10)
    assert "broadcast" not in plan_of(large)
    assert plain(large) == [("A",), ("B",)]


def test_an_empty_set_is_fine(spark, arrivals, known):
    nothing = membership.frozen(membership.plate_set(known.where("false")))
    assert plates(membership.first_entry(arrivals, nothing)) == ["A", "B", "Z", "Z"]
    assert plates(membership.seen_before(arrivals, nothing)) == []


def test_a_large_set_joins_without_being_shuffled(spark):
    rows = spark.createDataFrame([("A", 1), ("B", 2), ("Z", 3), (None, 4)], "plate string, id long")
    known = spark.createDataFrame([("A",), ("B",), ("B",), (None,)], "plate string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = membership.frozen(membership.plate_set(known), max_bytes=0)
        for join, expected in ((membership.seen_before, ["A", "B"]), (membership.first_entry, [None, "Z"])):
            found = join(rows, kept)
            plan = found._jdf.queryExecution().executedPlan().toString()
            # One exchange, on the side of the sightings; the buckets are read as they lie.
            assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
            assert sorted((r.plate for r in found.collect()), key=str) == sorted(expected, key=str)
        counts = membership.frozen(membership.plate_counts(known), max_bytes=0)
        assert membership.seen_before_repeated(rows, counts).count() == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
