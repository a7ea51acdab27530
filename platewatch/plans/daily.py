"""Results kept by day, so that new sightings cost the days around them and not the whole history."""

from collections.abc import Iterable
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewatch.functions.clock import moment_literal
from platewatch.functions.geo import longest_flagged_gap_s
from platewatch.model import MAX_KMH
from platewatch.operators.clone import clone_plate_pairs
from platewatch.sources.store import read_store

# No two places are further apart than half of a great circle.
WIDEST_KM = 20_040.0
DAY_S = 86_400
_DAY = "later_day"


def refresh_clone_pairs(
    spark: SparkSession,
    store: str,
    kept: str,
    days: Iterable[date],
    max_kmh: float = MAX_KMH,
    widest_km: float = WIDEST_KM,
    **options,
) -> None:
    """Bring the fast pairs kept under ``kept`` up to date after sightings of ``days`` entered the store.

    Pairs are kept by the day of their later sighting.  A pair's two days are no further apart than the longest
    gap in which ``widest_km`` can be covered too fast, so only that many days after a changed one can have new
    pairs, and only that many days before are read for them.  The days written replace what was kept
    of them, so a repeated call, or one after a failure, gives the same rows.  Days may come in any order.
    ``options`` are those of ``clone_plate_pairs`` and have to be the same in every call.
    """
    reach = timedelta(days=-(-longest_flagged_gap_s(widest_km, max_kmh) // DAY_S))
    for first, last in stretches(days, reach):
        before, after = midnight(first - reach) - timedelta(seconds=1), midnight(last + timedelta(days=1))
        sightings = read_store(spark, store, since=before, until=after)
        pairs = clone_plate_pairs(sightings, None, max_kmh, **options)
        fresh = pairs.where(F.col("pass_time_b") >= moment_literal(midnight(first))).withColumn(_DAY, F.to_date("pass_time_b"))
        writer = fresh.repartition(_DAY, F.pmod(F.xxhash64("plate", "id_a", "id_b"), F.lit(16))).write
        writer.partitionBy(_DAY).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(kept)


def kept_clone_pairs(spark: SparkSession, kept: str) -> DataFrame:
    """The pairs of all days brought up to date, in the columns of ``clone_plate_pairs``."""
    return spark.read.parquet(kept).drop(_DAY)


def stretches(days: Iterable[date], reach: timedelta) -> list[tuple[date, date]]:
    """The first and last day of every run of days that a change can touch."""
    runs: list[tuple[date, date]] = []
    for day in sorted(set(days)):
        if runs and day <= runs[-1][1] + timedelta(days=1):
            runs[-1] = (runs[-1][0], day + reach)
        else:
            runs.append((day, day + reach))
    return runs


def midnight(day: date) -> datetime:
    return datetime.combine(day, time())
