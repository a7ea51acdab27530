import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from platewatch.operators.clone import clone_plate_pairs
from platewatch.plans.daily import kept_clone_pairs, refresh_clone_pairs, stretches
from platewatch.sources.store import append_to_store, read_store, stored_days

FIELDS = "id string, plate string, brand string, colour string, pass_time string, site_id string, lon double, lat double"
WIDE_KM = 4000


def week(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(250):
        second = rng.randrange(7 * 86_400)
        day, rest = divmod(second, 86_400)
        time = f"2024-01-{day + 1:02} {rest // 3600:02}:{rest // 60 % 60:02}:{rest % 60:02}"
        rows.append((str(i), f"p{rng.randrange(5)}", "b", "c", time, "k", 100 + rng.random() * 20, 20 + rng.random() * 20))
    rows += [("n", "p0", None, None, None, "k", 100.0, 20.0), ("m", None, None, None, "2024-01-02 00:00:00", "k", 100.0, 20.0)]
    return spark.createDataFrame(rows, FIELDS).withColumn("pass_time", F.col("pass_time").cast("timestamp_ntz"))


def listed(pairs):
    return sorted(map(str, pairs.collect()))


@pytest.mark.parametrize("order", [[1, 2, 3, 4, 5, 6, 7], [5, 1, 7, 2, 6, 3, 4]])
def test_day_by_day_equals_the_full_run(spark, tmp_path, order):
    sightings, store, kept = week(spark, len(order)), str(tmp_path / "store"), str(tmp_path / "kept")
    for day in order:
        append_to_store(sightings.where(F.dayofmonth("pass_time") == day), store, f"day-{day}")
        refresh_clone_pairs(spark, store, kept, [date(2024, 1, day)], widest_km=WIDE_KM)
    whole = listed(clone_plate_pairs(read_store(spark, store)))
    assert len(whole) > 100 and listed(kept_clone_pairs(spark, kept)) == whole
    refresh_clone_pairs(spark, store, kept, [date(2024, 1, 3)], widest_km=WIDE_KM)
    assert listed(kept_clone_pairs(spark, kept)) == whole


def test_late_sightings_of_a_day_that_was_done(spark, tmp_path):
    sightings, store, kept = week(spark, 3), str(tmp_path / "store"), str(tmp_path / "kept")
    late = F.pmod(F.xxhash64("id"), F.lit(10)) == 0
    for name, part in (("first", ~late), ("late", late)):
        append_to_store(sightings.where(part), store, name)
        refresh_clone_pairs(spark, store, kept, stored_days(spark, store, name), widest_km=WIDE_KM)
    assert listed(kept_clone_pairs(spark, kept)) == listed(clone_plate_pairs(read_store(spark, store)))


def test_pairs_without_a_bound_on_distance(spark, tmp_path):
    sightings, store, kept = week(spark, 4), str(tmp_path / "store"), str(tmp_path / "kept")
    append_to_store(sightings, store, "all")
    refresh_clone_pairs(spark, store, kept, stored_days(spark, store, "all"), flag_simultaneous=True)
    assert listed(kept_clone_pairs(spark, kept)) == listed(clone_plate_pairs(read_store(spark, store), flag_simultaneous=True))


def test_stretches():
    day = date(2024, 1, 1)
    days = [day + timedelta(days=n) for n in (0, 2, 10)]
    one = timedelta(days=1)
    assert stretches(days, one) == [(day, day + 3 * one), (day + 10 * one, day + 11 * one)]
    assert stretches([], one) == []
