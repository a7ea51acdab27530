"""The benchmark's ``events`` table seen as sightings."""

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewatch.functions.clock import moment_literal, whole_second

# Longitude and latitude given to the five event types.
SITES = {
    "click": (113.55, 22.27),
    "error": (113.26, 23.13),
    "purchase": (114.06, 22.54),
    "signup": (116.40, 39.90),
    "view": (121.47, 31.23),
}


def read_events(
    spark: SparkSession, folder: str, since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    return events_as_sightings(spark.read.parquet(f"{folder}/events.parquet"), since, until)


def events_as_sightings(events: DataFrame, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
    """Map events to sightings; works on tables and on streams.

    Passing times are cut to whole seconds.  ``since`` keeps what passed strictly later,
    ``until`` what passed strictly earlier; both are put on the stored column, where the
    Parquet scan can skip row groups.
    """
    if since is not None:
        after = since.replace(microsecond=0) + timedelta(seconds=1)
        events = events.where(F.col("ts") >= moment_literal(after))
    if until is not None:
        # Cut to its second, a time is before a moment if it is before the next whole second.
        before = until if not until.microsecond else until.replace(microsecond=0) + timedelta(seconds=1)
        events = events.where(F.col("ts") < moment_literal(before))
    site = F.col("event_type")
    return events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").cast("string").alias("plate"),
        F.concat(F.lit("b"), F.get_json_object("props", "$.k")).alias("brand"),
        F.substring(site, 1, 1).alias("colour"),
        whole_second(F.col("ts")).alias("pass_time"),
        site.alias("site_id"),
        _coordinate(site, 0).alias("lon"),
        _coordinate(site, 1).alias("lat"),
    )


def _coordinate(site, axis):
    choice = None
    for name, position in SITES.items():
        branch = F.when if choice is None else choice.when
        choice = branch(site == name, F.lit(position[axis]))
    return choice
