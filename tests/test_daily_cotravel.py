import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from platewatch.operators import cotravel
from platewatch.plans.daily_cotravel import kept_cotravel_members, refresh_cotravel
from platewatch.plans.stretches import stretches_kept
from platewatch.sources.store import append_to_store, read_store, stored_days
from tests.fixtures import DAY, random_rows, sightings

NIGHT = {"tolerance_s": 7200}


def week(spark, seed, count=500):
    """Six days; runs and company often go across midnight, and some plates rest for days."""
    rows = random_rows(random.Random(seed), count, plates=12, sites=3, span=6 * 86_400)
    rows += [("rest", DAY + timedelta(days=d, hours=5), f"k{d % 3}", 113.0, 22.0) for d in (0, 4, 5)]
    rows += [(None, DAY, "k0", 113.0, 22.0), ("p0", DAY, None, 113.0, 22.0)]
    return sightings(spark, rows)


def listed(members):
    return sorted((tuple(r["gram"]), r["plate"]) for r in members.select("gram", "plate").collect())


@pytest.mark.parametrize("order", [[1, 2, 3, 4, 5, 6], [4, 1, 6, 2, 5, 3]])
def test_day_by_day_equals_the_full_run(spark, tmp_path, order):
    rows, store, kept = week(spark, len(order)), str(tmp_path / "store"), str(tmp_path / "kept")
    for day in order:
        append_to_store(rows.where(F.dayofmonth("pass_time") == day), store, f"day-{day}")
        refresh_cotravel(spark, store, kept, [date(2024, 1, day)], **NIGHT)
    whole = listed(cotravel.cotravel_members(read_store(spark, store), **NIGHT))
    assert len(whole) > 50 and listed(kept_cotravel_members(spark, kept)) == whole
    if order == sorted(order):
        assert len(stretches_kept(spark, kept)) == 6
        refresh_cotravel(spark, store, kept, [date(2024, 1, 3)], **NIGHT)
        assert [s.last.day for s in stretches_kept(spark, kept)] == [1, 2, 6]
        assert listed(kept_cotravel_members(spark, kept)) == whole


@pytest.mark.parametrize(("most_open", "allow_self"), [(0, False), (50_000, False), (50_000, True)])
def test_the_first_position_alone_settles_no_more_than_all_of_them(spark, most_open, allow_self):
    """However many members it leaves open; runs that are only company may lack their first place."""
    runs, crowded = cotravel.sequence_runs(week(spark, 3), tolerance_s=7200)
    positions = cotravel.run_positions(runs)
    own, later = positions.where("plate < 'p5'"), positions.where("plate >= 'p5' and pos > 0")
    for rows, others in ((positions, None), (own, later)):
        every = rows if others is None else rows.unionByName(others)
        plain = cotravel._sites(cotravel._neighbours(every, crowded, 7200, allow_self).distinct())
        got = cotravel.members_among(rows, crowded, 7200, allow_self, others, most_open)
        assert crowded is None and listed(got if others is None else got.distinct()) == listed(plain) != []


def test_a_stretch_keeps_one_row_a_run(spark, tmp_path):
    rows, store, kept = week(spark, 4), str(tmp_path / "store"), str(tmp_path / "kept")
    append_to_store(rows, store, "all")
    refresh_cotravel(spark, store, kept, stored_days(spark, store, "all"), **NIGHT)
    folder = stretches_kept(spark, kept)[0].folder
    sizes = dict(rows.dropna(subset=["plate", "site_id", "pass_time"]).groupBy("plate").count().collect())
    assert spark.read.parquet(f"{folder}/runs").count() == sum(max(0, n - 2) for n in sizes.values())


def test_a_late_sighting_takes_members_back(spark, tmp_path):
    store, kept = str(tmp_path / "store"), str(tmp_path / "kept")
    walk = [(p, DAY + timedelta(hours=h, seconds=s), f"k{h}", 113.0, 22.0) for p, s in (("a", 0), ("b", 9)) for h in (1, 2, 3)]
    append_to_store(sightings(spark, walk), store, "walk")
    refresh_cotravel(spark, store, kept, stored_days(spark, store, "walk"))
    assert listed(kept_cotravel_members(spark, kept)) == [(("k1", "k2", "k3"), "a"), (("k1", "k2", "k3"), "b")]
    late = sightings(spark, [("a", DAY + timedelta(hours=1, minutes=30), "k9", 113.0, 22.0)])
    append_to_store(late, store, "late")
    refresh_cotravel(spark, store, kept, stored_days(spark, store, "late"))
    assert listed(kept_cotravel_members(spark, kept)) == []


def test_heavy_plates_and_company_with_oneself(spark, tmp_path):
    rows, store, kept = week(spark, 8, 300), str(tmp_path / "store"), str(tmp_path / "kept")
    rule = NIGHT | {"allow_self": True, "heavy": {"p0": 30, "p1": 30}, "heavy_places": {}, "piece_rows": 7}
    for name, part in (("one", F.dayofmonth("pass_time") < 4), ("two", F.dayofmonth("pass_time") >= 4)):
        append_to_store(rows.where(part), store, name)
        refresh_cotravel(spark, store, kept, stored_days(spark, store, name), **rule)
    whole = listed(cotravel.cotravel_members(read_store(spark, store), allow_self=True, **NIGHT))
    assert listed(kept_cotravel_members(spark, kept)) == whole


def test_nothing_kept_and_nothing_new(spark, tmp_path):
    store, kept = str(tmp_path / "store"), str(tmp_path / "kept")
    assert listed(kept_cotravel_members(spark, kept)) == []
    refresh_cotravel(spark, store, kept, [])
    append_to_store(sightings(spark, [("a", DAY, "k0", 113.0, 22.0)]), store, "one")
    refresh_cotravel(spark, store, kept, [DAY.date()])
    refresh_cotravel(spark, store, kept, [DAY.date() + timedelta(days=1)])
    assert listed(kept_cotravel_members(spark, kept)) == []


def test_new_days_leave_the_stored_history_unread(spark, tmp_path):
    """The second stretch is computed from a store that no longer holds the first one's days."""
    rows, kept = week(spark, 5), str(tmp_path / "kept")
    first, second = F.dayofmonth("pass_time") < 5, F.dayofmonth("pass_time") >= 5
    append_to_store(rows.where(first), str(tmp_path / "old"), "one")
    refresh_cotravel(spark, str(tmp_path / "old"), kept, [date(2024, 1, 4)], **NIGHT)
    append_to_store(rows.where(second), str(tmp_path / "new"), "two")
    refresh_cotravel(spark, str(tmp_path / "new"), kept, [date(2024, 1, 5), date(2024, 1, 6)], **NIGHT)
    assert listed(kept_cotravel_members(spark, kept)) == listed(cotravel.cotravel_members(rows, **NIGHT))
