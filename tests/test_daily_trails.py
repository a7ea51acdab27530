import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from platewatch.operators.sequences import plate_trail
from platewatch.plans.daily_trails import kept_trails, refresh_trails
from platewatch.plans.stretches import next_stretch, stretches_kept
from platewatch.sources.store import append_to_store, read_store
from tests.fixtures import DAY, random_rows, sightings


def stored_week(spark, seed):
    rows = random_rows(random.Random(seed), 200, plates=5, span=6 * 86_400, hot="p0")
    return sightings(spark, [*rows, (None, DAY, "k0", 113.0, 22.0), ("p1", DAY, None, 113.0, 22.0)])


def listed(trails):
    return sorted(str((r["plate"], r["part"], r["n"], r["trail"])) for r in trails.collect())


@pytest.mark.parametrize("order", [[1, 2, 3, 4, 5, 6], [3, 6, 1, 5, 2, 4]])
@pytest.mark.parametrize("skew", [{}, {"heavy": {"p0": 90}, "piece_rows": 9}])
def test_appended_days_equal_the_full_trails(spark, tmp_path, order, skew):
    rows, store, kept = stored_week(spark, len(skew)), str(tmp_path / "store"), str(tmp_path / "kept")
    for day in order:
        append_to_store(rows.where(F.dayofmonth("pass_time") == day), store, f"day-{day}")
        refresh_trails(spark, store, kept, [date(2024, 1, day)], trail_rows=7, **skew)
    whole = listed(plate_trail(read_store(spark, store), trail_rows=7))
    assert len(whole) > 20 and listed(kept_trails(spark, kept, 7)) == whole
    refresh_trails(spark, store, kept, [date(2024, 1, 4)], trail_rows=7)
    assert listed(kept_trails(spark, kept, 7)) == whole


def test_new_days_read_the_counts_only(spark, tmp_path):
    """The second stretch comes from a store without the first one's days."""
    rows, kept = stored_week(spark, 9), str(tmp_path / "kept")
    append_to_store(rows.where(F.dayofmonth("pass_time") < 4), str(tmp_path / "old"), "one")
    refresh_trails(spark, str(tmp_path / "old"), kept, [date(2024, 1, 3)], trail_rows=7)
    append_to_store(rows.where(F.dayofmonth("pass_time") >= 4), str(tmp_path / "new"), "two")
    refresh_trails(spark, str(tmp_path / "new"), kept, [date(2024, 1, 6)], trail_rows=7)
    append_to_store(rows, str(tmp_path / "both"), "all")
    assert listed(kept_trails(spark, kept, 7)) == listed(plate_trail(read_store(spark, str(tmp_path / "both")), trail_rows=7))


def test_a_stretch_not_published_is_not_read(spark, tmp_path):
    rows, store, kept = stored_week(spark, 2), str(tmp_path / "store"), str(tmp_path / "kept")
    assert kept_trails(spark, kept).count() == 0 and next_stretch(spark, kept, []) is None
    append_to_store(rows.where(F.dayofmonth("pass_time") < 3), store, "one")
    refresh_trails(spark, store, kept, [date(2024, 1, 2)])
    held = listed(kept_trails(spark, kept))
    lost = next_stretch(spark, kept, [date(2024, 1, 3)])
    plate_trail(rows).write.parquet(f"{lost.folder}/runs")
    assert listed(kept_trails(spark, kept)) == held
    assert [s.number for s in stretches_kept(spark, kept)] == [1] and (lost.number, lost.first) == (2, date(2024, 1, 3))
