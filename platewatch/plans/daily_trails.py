"""Trails that grow: every stretch of days adds its sorted runs, and readers join those of one part."""

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewatch.operators.sequences import TRAIL_ROWS, plate_trail
from platewatch.plans.stretches import next_stretch, stretches_kept

RUNS = "plate string, part long, n long, trail array<struct<pass_time: timestamp_ntz, id: string, site_id: string>>"
STARTS = "plate string, n long"


def refresh_trails(
    spark: SparkSession, store: str, kept: str, days: Iterable[date], trail_rows: int = TRAIL_ROWS, **skew
) -> None:
    """Bring the trails kept under ``kept`` up to date after sightings of ``days`` entered the store.

    A stretch keeps its sightings as sorted runs by plate and part, and the number of sightings of every plate so far,
    from which the next one goes on: new days are read from the store, and of what was kept one
    row per plate.  Late days and repeated calls do anew the stretches they reach.  ``trail_rows`` has to be the same in every call.
    """
    stretch = next_stretch(spark, kept, days)
    if stretch is None:
        return
    starts = None
    if stretch.before:
        starts = spark.read.schema(STARTS).parquet(f"{stretch.before[-1].folder}/starts")
    runs = plate_trail(stretch.sightings(spark, store), trail_rows=trail_rows, starts=starts, **skew)
    runs.write.parquet(f"{stretch.folder}/runs")
    counts = spark.read.schema(RUNS).parquet(f"{stretch.folder}/runs").select("plate", "n")
    if starts is not None:
        counts = counts.unionByName(starts)
    counts.groupBy("plate").agg(F.sum("n").alias("n")).write.parquet(f"{stretch.folder}/starts")
    stretch.publish(spark, kept)


def kept_trails(spark: SparkSession, kept: str, trail_rows: int = TRAIL_ROWS) -> DataFrame:
    """The trails of all stretches, as ``plate_trail`` gives them.

    Runs that fill a part are read as they lie; only the others, two or more of which can make up one part, are shuffled.
    """
    folders = [f"{s.folder}/runs" for s in stretches_kept(spark, kept)]
    if not folders:
        return spark.createDataFrame([], RUNS)
    runs = spark.read.schema(RUNS).parquet(*folders)
    merged = runs.where(F.col("n") < trail_rows).groupBy("plate", "part").agg(
        F.sum("n").alias("n"), F.array_sort(F.flatten(F.collect_list("trail"))).alias("trail")
    )
    return runs.where(F.col("n") >= trail_rows).unionByName(merged)
