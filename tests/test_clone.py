import random
from datetime import timedelta

import pytest

from platewatch.operators import clone
from platewatch.operators.clone import (
    clone_plate_adjacent,
    clone_plate_pairs,
    clone_plate_report,
    clone_watchlist,
    leg_speeds,
)
from platewatch.sinks.results import clone_result
from tests.fixtures import at, fast_pairs, hot_copies, plain, plan_of, random_rows, sightings


# Seconds and degrees of three sightings on the equator, 1.28 km and 20 s apart: each leg
# counts as 1 km, the whole way as 3 km.
DRIFT = [(0, 0.0), (20, 0.0115), (40, 0.023)]


def two(start, end):
    return [("T", start, "k1", 113.0, 0.0), ("T", end, "k2", 114.0, 0.0)]


@pytest.mark.parametrize(
    "start, end, usual, clock12",
    [
        ("10:00:00", "10:30:00", [222], [222]),
        ("10:00:00", "10:36:40", [181], [181]),
        ("10:00:00", "10:36:50", [], []),
        ("10:00:00", "10:37:00", [], []),
        ("10:00:00", "10:00:00", [], []),
        ("12:30:00", "13:00:00", [222], []),
        ("12:30:00", "00:40:00", [], [665]),
    ],
)
def test_cases(spark, start, end, usual, clock12):
    rows = sightings(spark, two(start, end))
    assert [r.speed_kmh for r in clone_plate_pairs(rows).collect()] == usual
    assert [r.speed_kmh for r in clone_plate_pairs(rows, clock12=True).collect()] == clock12
    assert [r.speed_kmh for r in clone_plate_adjacent(rows).collect()] == usual


def test_two_places_at_once_only_on_request(spark):
    rows = sightings(spark, two("10:00:00", "10:00:00"))
    for find in (clone_plate_pairs, clone_plate_adjacent):
        assert find(rows).count() == 0
        assert [(r.id_a, r.id_b, r.speed_kmh) for r in find(rows, flag_simultaneous=True).collect()] == [(1, 2, 0)]


def test_all_pairs_and_adjacent_pairs(spark):
    rows = sightings(
        spark,
        [
            ("T", "10:00:00", "k1", 113.0, 0.0),
            ("T", "10:30:00", "k2", 114.0, 0.0),
            ("T", "11:00:00", "k3", 115.0, 0.0),
        ],
    )
    assert [r.speed_kmh for r in clone_plate_pairs(rows).collect()] == [222] * 3
    assert plain(clone_plate_adjacent(rows).select("id_a", "id_b")) == [(1, 2), (2, 3)]
    assert leg_speeds(rows).count() == 2


def test_cutoff_is_strict(spark):
    rows = sightings(spark, two("10:00:00", "10:30:00"))
    assert clone_plate_pairs(rows, since=at("9:59:59")).count() == 1
    assert clone_plate_pairs(rows, since=at("10:00:00")).count() == 0


def test_missing_positions_match_nothing(spark):
    rows = sightings(spark, [("T", "10:00:00", "k1", None, None), ("T", "10:01:00", "k2", None, 3.0)])
    assert clone_plate_pairs(rows).count() == 0


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("heavy", [{}, {"p0": 100}, clone.EVERY_PLATE])
def test_pairs_are_those_of_brute_force(spark, seed, heavy):
    rng = random.Random(seed)
    rows = hot_copies(rng, 150) if seed else random_rows(rng, 200, hot="p0")
    frame = sightings(spark, rows)
    pairs = clone_plate_pairs(frame, heavy=heavy).collect()
    got = [(min(r.id_a, r.id_b), max(r.id_a, r.id_b)) for r in pairs]
    assert len(got) == len(set(got))
    assert set(got) == fast_pairs(rows)
    assert all(r.pass_time_a < r.pass_time_b for r in pairs)
    plates = {rows[i - 1][0] for i, _ in got}
    assert {r.plate for r in clone_watchlist(frame, heavy=heavy).collect()} == plates


def test_heavy_plates_are_found(spark, monkeypatch):
    rows = random_rows(random.Random(3), 120, hot="p0")
    frame, seen = sightings(spark, rows), []
    split = clone._split
    monkeypatch.setattr(clone, "_split", lambda r, heavy: (seen.append(heavy), split(r, heavy))[1])
    for many, plates in ((1000, 10), (30, 10), (5, 2)):
        monkeypatch.setattr(clone, "HEAVY_ROWS", many)
        monkeypatch.setattr(clone, "HEAVY_PLATES", plates)
        pairs = {tuple(sorted((r.id_a, r.id_b))) for r in clone_plate_pairs(frame).collect()}
        assert pairs == fast_pairs(rows)
    assert seen == [{}, {"p0": frame.where("plate = 'p0'").count()}, clone.EVERY_PLATE]


def test_a_heavy_plate_with_only_a_distant_fast_pair_is_listed(spark):
    # Rounding makes the whole way fast although neither of its legs is.
    rows = [("T", at("10:00:00") + timedelta(seconds=s), f"k{s}", 113 + x, 0.0) for s, x in DRIFT]
    frame = sightings(spark, rows)
    assert clone_plate_adjacent(frame).count() == 0 and fast_pairs(rows)
    for heavy in ({}, {"T": 3}):
        assert [r.plate for r in clone_watchlist(frame, heavy=heavy).collect()] == ["T"]


def test_heavy_way_gives_the_same_rows(spark):
    rows = sightings(spark, hot_copies(random.Random(9), 120, span=300))
    for simultaneous in (False, True):
        usual = clone_plate_pairs(rows, flag_simultaneous=simultaneous, heavy={})
        heavy = clone_plate_pairs(rows, flag_simultaneous=simultaneous, heavy={"p0": 60, "p1": 10})
        assert plain(usual) == plain(heavy)


def test_report_has_two_rows_per_pair(spark):
    rows = sightings(spark, two("10:00:00", "10:30:00"))
    report = clone_plate_report(clone_plate_pairs(rows), rows, 3, "2024-02-01 00:00:00")
    assert [(r.id, r.run_id, str(r.created_at)) for r in report.orderBy("id").collect()] == [
        (1, 3, "2024-02-01 00:00:00"),
        (2, 3, "2024-02-01 00:00:00"),
    ]
    assert len({r.pair_key for r in report.collect()}) == 1
    table = clone_result(report)
    assert table.columns == ["id", "hphm", "clpp", "clys", "tgsj", "kkbh", "jsbh", "create_time"]
    assert [f.dataType.simpleString() for f in table.schema] == ["string"] * 6 + ["bigint", "timestamp"]


def test_plans_join_on_keys_without_python(spark):
    rows = sightings(spark, random_rows(random.Random(1), 50))
    for frame in (
        clone_plate_pairs(rows),
        clone_plate_pairs(rows, heavy={"p0": 10}),
        clone_watchlist(rows),
        clone_plate_adjacent(rows, heavy={"p0": 10}),
    ):
        plan = plan_of(frame)
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        assert "Python" not in plan
    assert "SortMergeJoin" in plan_of(clone_plate_pairs(rows))


@pytest.mark.parametrize("heavy", [{}, {"T": 2}, clone.EVERY_PLATE])
def test_missing_sites_are_places_like_others(spark, heavy):
    rows = sightings(
        spark, [("T", "10:00:00", None, 113.0, 0.0), ("T", "10:00:00", None, 113.0, 0.0), ("T", "10:30:00", "k2", 114.0, 0.0)]
    )
    assert sorted((r.id_a, r.id_b) for r in clone_plate_pairs(rows, heavy=heavy).collect()) == [(1, 3), (2, 3)]


def far_away(rng, rows):
    """Some positions spoilt: half a world away, and beside the date line."""
    return [(p, t, s, *rng.choice([(0.0, 0.0), (179.99, -5.0), (-179.99, -5.0)])) if rng.random() < 0.06 else (p, t, s, x, y)
            for p, t, s, x, y in rows]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("heavy", [{}, {"p0": 100}, clone.EVERY_PLATE])
def test_layers_give_the_pairs_of_brute_force(spark, seed, heavy):
    rng = random.Random(seed)
    rows = far_away(rng, random_rows(rng, 200, hot="p0", span=200_000))
    frame = sightings(spark, rows)
    pairs = clone_plate_pairs(frame, heavy=heavy, layered=True).collect()
    got = [(min(r.id_a, r.id_b), max(r.id_a, r.id_b)) for r in pairs]
    assert len(got) == len(set(got)) and set(got) == fast_pairs(rows)
    same = clone_plate_pairs(frame, heavy=heavy, layered=False, flag_simultaneous=True)
    assert plain(same) == plain(clone_plate_pairs(frame, heavy=heavy, layered=True, flag_simultaneous=True))


def test_a_wrong_position_costs_few_candidates(spark):
    rng = random.Random(1)
    rows = random_rows(rng, 3000, plates=20, span=30 * 86_400)
    counts = {}
    for name, part in (("clean", rows), ("spoilt", [(*r[:3], 0.0, 0.0) if i % 300 == 0 else r for i, r in enumerate(rows)])):
        frame, gap, _, layered = clone._measure(sightings(spark, part), 180, None, None, None)
        timed = clone._timed(frame, False)
        counts[name] = clone._meetings(timed, gap, 180, layered).count()
        assert layered == (name == "spoilt")
        counts[f"{name} in one width"] = clone._meetings(timed, gap, 180, False).count()
    assert counts["spoilt"] <= 1.5 * counts["clean"] and counts["spoilt in one width"] > 5 * counts["clean"], counts


def test_report_leaves_other_plates_out_before_the_shuffle(spark):
    rows = sightings(spark, [*two("10:00:00", "10:30:00"), ("Q", "10:00:00", "k1", 113.0, 0.0)])
    report = clone_plate_report(clone_plate_pairs(rows), rows, 3, "2024-02-01 00:00:00")
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and sorted(r.id for r in report.collect()) == [1, 2]
    assert "BroadcastHashJoin" in plan_of(report)
