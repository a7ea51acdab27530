"""Sightings joined with a set of plates: watchlist, history, first entry.

All of these take a table or a stream on the left and a table on the right.
"""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewatch.session import new_folder, written

# Largest plate set that is sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024
# About how much of a larger set one bucket holds.
BUCKET_BYTES = 32 * 1024 * 1024


def plate_set(rows: DataFrame) -> DataFrame:
    """Distinct plates, without NULL."""
    return rows.select("plate").where(F.col("plate").isNotNull()).distinct()


def plate_counts(rows: DataFrame) -> DataFrame:
    """How often each plate was seen: ``plate``, ``times_seen``."""
    return (
        rows.where(F.col("plate").isNotNull())
        .groupBy("plate")
        .agg(F.count("*").alias("times_seen"))
    )


def frozen(plates: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Write the plates to the checkpoint folder once, and measure them.

    What was read stays the same for the life of a stream, also after executors are lost.
    Only a set measured to be small is broadcast; a larger one is kept in buckets, so that joins with it
    shuffle the other side alone.
    """
    kept = written(plates)
    size = F.count("*") * 16 * len(kept.columns) + F.sum(F.octet_length(F.col("plate")))
    measured = kept.agg(size).first()[0] or 0
    return F.broadcast(kept) if measured <= max_bytes else bucketed(kept, 1 + measured // BUCKET_BYTES)


def bucketed(plates: DataFrame, buckets: int) -> DataFrame:
    """The plates as a table of hash buckets in the shared folder, one sorted file each.

    There are at least as many buckets as the session has shuffle partitions, so that a join takes over their number.
    """
    spark = plates.sparkSession
    buckets = max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    name = f"plates_{uuid.uuid4().hex}"
    rows = plates.repartition(buckets, "plate").write.bucketBy(buckets, "plate").sortBy("plate")
    rows.option("path", new_folder(spark, "plates")).saveAsTable(name)
    return spark.table(name)


def watchlist_alerts(sightings: DataFrame, watchlist: DataFrame) -> DataFrame:
    """Sightings of plates on the list, which holds each plate once."""
    return sightings.join(watchlist.select("plate"), "plate", "left_semi")


def first_entry(sightings: DataFrame, known: DataFrame) -> DataFrame:
    """Sightings of plates that are not known."""
    return sightings.join(known.select("plate"), "plate", "left_anti")


def seen_before(sightings: DataFrame, history: DataFrame) -> DataFrame:
    """Sightings of plates in the history, once each."""
    return sightings.join(history.select("plate"), "plate", "left_semi")


def seen_before_counted(sightings: DataFrame, counts: DataFrame) -> DataFrame:
    """Sightings of plates in the history with the number of times it holds them."""
    return sightings.join(counts, "plate")


def seen_before_repeated(sightings: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per sighting and time the history holds its plate, numbered by ``copy``.

    The history is counted before it is joined, and the rows are repeated afterwards in
    place, in two steps so that no array is longer than the root of a long count.
    """
    block = F.lit(10_000)
    blocks = F.explode(F.sequence(F.lit(0), F.floor((F.col("times_seen") - 1) / block)))
    counted = seen_before_counted(sightings, counts).withColumn("_block", blocks)
    start = F.col("_block") * block
    stop = F.least(F.col("times_seen"), start + block)
    return counted.withColumn("copy", F.explode(F.sequence(start + 1, stop))).drop("_block", "times_seen")
