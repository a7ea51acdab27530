"""Co-travel kept up to date stretch by stretch, so that new days do not cost the whole history."""

from collections.abc import Iterable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from platewatch.model import SEQUENCE_LENGTH, TOLERANCE_S
from platewatch.operators.cotravel import members_among, run_positions, sequence_runs
from platewatch.operators.sequences import ORDER
from platewatch.plans.daily import DAY_S
from platewatch.plans.stretches import next_stretch, stretches_kept

MEMBERS = "gram array<string>, plate string"
RUNS = "gram string, plate string, seconds array<bigint>, day date"
_DAY = "day"


def refresh_cotravel(
    spark: SparkSession,
    store: str,
    kept: str,
    days: Iterable[date],
    n: int = SEQUENCE_LENGTH,
    tolerance_s: int = TOLERANCE_S,
    allow_self: bool = False,
    clock12: bool = False,
    **skew,
) -> None:
    """Bring the members kept under ``kept`` up to date after sightings of ``days`` entered the store.

    A run of sites belongs to the stretch its last sighting lies in.  A stretch keeps its runs by the day of
    that sighting, the members found among them and the runs kept before, and the last ``n - 1`` sightings of every
    plate, which is all that a later run can begin with.  New days are read from the store alone; of the kept
    runs, those that end on or after the first day that new runs touch within the tolerance are read, of them the
    places on touched days, and on days before the new ones only the sequences that new runs have.

    A late day sets aside every stretch that reaches it and does it anew with all days after it; so does a
    repeated call.  A stretch is published by one row of a list once all of it is written, so after a
    failure the stretches from before are still what is read.  The first call takes all the store
    holds.  The rules (``n`` to ``clock12``) have to be the same in every call; ``match`` is 'any'.
    One refresh runs at a time.
    """
    stretch = next_stretch(spark, kept, days)
    if stretch is None:
        return
    before, folder = stretch.before, stretch.folder
    rows = stretch.sightings(spark, store).dropna(subset=["plate", "site_id", "pass_time"]).select("plate", *ORDER, "site_id")
    if before:
        rows = spark.read.schema(rows.schema).parquet(f"{before[-1].folder}/tails").unionByName(rows)

    runs, crowded = sequence_runs(rows, n, tolerance_s, clock12, **skew)
    runs = runs.withColumn(_DAY, _day_of(F.element_at("seconds", -1)))
    dealt = runs.repartition(_DAY, F.pmod(F.xxhash64("gram"), F.lit(16)))
    dealt.write.partitionBy(_DAY).parquet(f"{folder}/runs")
    new = _kept_runs(spark, folder)
    old = list(_places_touched(spark, new, before, stretch.first, tolerance_s))
    others = reduce(DataFrame.unionByName, old) if old else None
    members_among(run_positions(new), crowded, tolerance_s, allow_self, others).write.parquet(f"{folder}/members")

    latest = Window.partitionBy("plate").orderBy(*[F.col(c).desc() for c in ORDER])
    tails = rows.withColumn("_back", F.row_number().over(latest)).where(F.col("_back") < n).drop("_back")
    tails.write.parquet(f"{folder}/tails")

    stretch.publish(spark, kept)


def kept_cotravel_members(spark: SparkSession, kept: str) -> DataFrame:
    """The members of all stretches, as ``cotravel_members`` gives them."""
    folders = [f"{s.folder}/members" for s in stretches_kept(spark, kept)]
    if not folders:
        return spark.createDataFrame([], MEMBERS)
    members = spark.read.schema(MEMBERS).parquet(*folders)
    # A stretch has no member twice.
    return members.distinct() if len(folders) > 1 else members


def _kept_runs(spark, folder):
    return spark.read.schema(RUNS).parquet(f"{folder}/runs")


def _day_of(second):
    return F.date_from_unix_date(F.floor(second / DAY_S).cast("int"))


def _places_touched(spark, new, before, first, tolerance_s):
    """Kept places that may be company of new ones, in two parts without a place in common."""
    if not before:
        return
    reach = timedelta(days=-(-tolerance_s // DAY_S))
    days = new.select(F.explode(F.transform("seconds", _day_of)).alias(_DAY)).distinct()
    touched = {r[_DAY] for r in days.collect()}  # one row per day
    wanted = {day + timedelta(days=d) for day in touched for d in range(-reach.days, reach.days + 1)}
    if not wanted:
        return
    near = first - reach
    day = _day_of(F.col("sec"))
    for stretch in before:
        kept = _kept_runs(spark, stretch.folder)
        recent, old = sorted(d for d in wanted if d >= near), sorted(d for d in wanted if d < near)
        if recent:
            yield run_positions(kept.where(F.col(_DAY) >= recent[0])).where(day.isin(recent))
        if old:
            # Runs that began long ago: few, so few sequences have to be looked at.
            sequences = run_positions(new).where(day < near + reach).select("gram", "pos").distinct()
            places = run_positions(kept.where(F.col(_DAY) >= old[0])).where(day.isin(old))
            yield places.join(sequences, ["gram", "pos"], "left_semi")
