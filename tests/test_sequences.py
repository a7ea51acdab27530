import random

import pytest

from platewatch.operators.sequences import consecutive, plate_trail, site_sequences
from platewatch.operators.skew import EveryKey, heavy_keys, in_pieces
from tests.fixtures import hot_copies, plain, random_rows, runs, sightings


def got_runs(frame):
    return sorted((r.plate, r.first_id, tuple(r.gram), tuple(r.seconds)) for r in frame.collect())


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("n", [2, 3, 5])
@pytest.mark.parametrize("heavy, piece_rows", [({}, 1), ({"p0": 60, "p1": 20}, 1), ({"p0": 60}, 7)])
def test_runs_are_those_of_brute_force(spark, seed, n, heavy, piece_rows):
    rows = (random_rows if seed else hot_copies)(random.Random(seed), 150)
    frame = site_sequences(sightings(spark, rows), n, heavy=heavy, piece_rows=piece_rows)
    assert got_runs(frame) == sorted(runs(rows, n))


def test_short_trails_have_no_runs(spark):
    rows = sightings(spark, [("A", "10:00:00", "k1", 1.0, 1.0), ("A", "10:01:00", "k2", 1.0, 1.0)])
    assert site_sequences(rows).count() == 0
    with pytest.raises(ValueError):
        consecutive(rows, 1, ["id"])


@pytest.mark.parametrize("heavy", [{}, {"p0": 100}])
def test_trails_hold_every_sighting_in_order_in_bounded_rows(spark, heavy):
    rows = hot_copies(random.Random(4), 200)
    parts = plate_trail(sightings(spark, rows), trail_rows=9, heavy=heavy, piece_rows=20).collect()
    assert max(r.n for r in parts) <= 9 and all(r.n == len(r.trail) for r in parts)
    trails = {}
    for r in sorted(parts, key=lambda r: r.part):
        trails.setdefault(r.plate, []).extend(stop.id for stop in r.trail)
    expected = {}
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][1], i)):
        expected.setdefault(rows[i][0], []).append(i + 1)
    assert trails == expected


def test_heavy_keys_are_few_and_measured(spark):
    rows = sightings(spark, random_rows(random.Random(2), 300, hot="p0"))
    assert heavy_keys(rows, "plate") == {}
    sizes = {r["plate"]: r["count"] for r in rows.groupBy("plate").count().collect()}
    limit = sizes["p0"] - 1
    heavy = heavy_keys(rows, "plate", min_rows=limit)
    assert heavy == {p: n for p, n in sizes.items() if n > limit} and "p0" in heavy
    every = heavy_keys(rows, "plate", min_rows=1, most_keys=1)
    assert isinstance(every, EveryKey) and every == {None: 300}


def test_trails_are_cut_alike_for_ordinary_and_heavy_plates(spark):
    rows = sightings(spark, hot_copies(random.Random(5), 200))
    light = plain(plate_trail(rows, trail_rows=9, heavy={}))
    for heavy in ({"p0": 100}, EveryKey(200)):
        assert plain(plate_trail(rows, trail_rows=9, heavy=heavy, piece_rows=20)) == light


def test_copies_of_one_moment_spread_over_pieces(spark):
    rows = sightings(spark, [("p0", "10:00:00", "k1", 1.0, 1.0)] * 200)
    pieces = in_pieces(rows, {"p0": 200}, ["plate", "pass_time", "id"], piece_rows=20)
    sizes = [r["count"] for r in pieces.groupBy("_piece").count().collect()]
    assert sum(sizes) == 200 and max(sizes) <= 60


def test_input_order_does_not_matter(spark):
    rows = sightings(spark, random_rows(random.Random(3), 80))
    assert plain(site_sequences(rows)) == plain(site_sequences(rows.orderBy("lat", "id")))
