"""Sightings from headered CSV files or tables, typed once at the door."""

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewatch.functions.clock import parse_time
from platewatch.model import CSV_FIELDS


class Ingest(NamedTuple):
    sightings: DataFrame
    rejected: DataFrame


# What a row can lack.  Clone search uses all of it, co-travel no position (runs are told apart by
# id), a history plate and time only.
NEEDS = ("id", "plate", "time", "site", "position")
COTRAVEL_NEEDS = ("id", "plate", "time", "site")
HISTORY_NEEDS = ("plate", "time")


def read_sightings(spark: SparkSession, *paths: str, needs=NEEDS) -> Ingest:
    """Read headered CSV.  Columns are found by header name; further ones are ignored.

    All files of one path have the same header: a file with another one fails the read instead of
    having its columns taken for others.  Files of another layout are given as a further path.
    """
    layouts = [spark.read.option("header", True).option("enforceSchema", False).csv(p) for p in paths]
    read = [typed_sightings(raw, needs) for raw in layouts]
    return Ingest(*[reduce(DataFrame.unionByName, part) for part in zip(*read)])


def read_sighting_table(spark: SparkSession, name: str, needs=NEEDS) -> Ingest:
    """The same columns from a catalogue table."""
    return typed_sightings(spark.table(name), needs)


def typed_sightings(raw: DataFrame, needs=NEEDS) -> Ingest:
    """Split text rows into typed sightings and rows set aside with a reason.

    A row is set aside only for something that the analysis ``needs``; what else is missing or
    unreadable is NULL.  Nothing is dropped: each input row is in exactly one of the two results.
    """
    if unknown := set(needs) - set(NEEDS):
        raise ValueError(f"needs are some of {NEEDS}, not {sorted(unknown)}")
    known = {name.upper(): name for name in raw.columns}

    def text(field):
        header = CSV_FIELDS[field]
        column = F.col(f"`{known[header]}`") if header in known else F.lit(None)
        return column.cast("string")

    position = F.split(text("position"), "_")
    rows = raw.select(
        text("id").alias("id"),
        text("plate").alias("plate"),
        text("brand").alias("brand"),
        text("colour").alias("colour"),
        text("pass_time").alias("time_text"),
        text("site_id").alias("site_id"),
        text("position").alias("position_text"),
        parse_time(text("pass_time")).alias("pass_time"),
        F.try_element_at(position, F.lit(1)).try_cast("double").alias("lon"),
        F.try_element_at(position, F.lit(2)).try_cast("double").alias("lat"),
    )
    placed = ~(_off_globe("lon", 180) | _off_globe("lat", 90))
    lacks = {
        "id": F.col("id").isNull(),
        "plate": F.col("plate").isNull(),
        "time": F.col("pass_time").isNull(),
        "site": F.col("site_id").isNull(),
        "position": ~placed,
    }
    reason = F.coalesce(F.lit(None).cast("string"), *[F.when(lacks[n], n) for n in NEEDS if n in needs])
    judged = rows.withColumn("reason", reason).withColumns(
        {"lon": F.when(placed, F.col("lon")), "lat": F.when(placed, F.col("lat"))}
    )
    sightings = judged.where(F.col("reason").isNull()).select(
        "id", "plate", "brand", "colour", "pass_time", "site_id", "lon", "lat"
    )
    rejected = judged.where(F.col("reason").isNotNull()).select(
        "id", "plate", "brand", "colour", "time_text", "site_id", "position_text", "reason"
    )
    return Ingest(sightings, rejected)


def _off_globe(name, bound):
    # NaN sorts above every number in Spark, so the comparison catches it too.
    return F.col(name).isNull() | (F.abs(F.col(name)) > bound)
