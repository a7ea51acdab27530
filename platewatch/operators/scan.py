"""Row-level operators."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewatch.functions.clock import moment_literal


def sightings_since(sightings: DataFrame, cutoff: datetime | str | None) -> DataFrame:
    """Sightings strictly later than the cutoff; all of them without one."""
    if cutoff is None:
        return sightings
    return sightings.where(F.col("pass_time") > moment_literal(cutoff))


def stamp_run(rows: DataFrame, run_id: int, run_time: datetime | str) -> DataFrame:
    """Add the run number and one creation time for the whole run."""
    return rows.withColumn("run_id", F.lit(run_id).cast("long")).withColumn(
        "created_at", moment_literal(run_time)
    )
