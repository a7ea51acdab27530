"""A typed store of sightings: Parquet, one folder per day and batch.

Texts are read and checked once, when sightings enter the store.  Analyses with a time range
then open only the days they need, and within a day only the row groups.
"""

import uuid
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewatch.functions.clock import moment_literal
from platewatch.model import SIGHTING

_DAY = "day"
_BATCH = "batch"
# Columns that single values are looked up by: each row group tells which it cannot hold.
LOOKUP = ("id", "plate")


def append_to_store(sightings: DataFrame, path: str, batch: str | None = None) -> None:
    """Add sightings; ids become text, sightings without a time go to a folder of their own.

    ``batch`` names the sightings, as a file's name or a micro-batch's number does.  Added again under the
    name they had, also after a failure half way, they replace themselves instead of doubling; a batch that
    has changed must not have fewer days than before.  Without a name every call adds.

    Rows are dealt by ranges of day and time, so a day has few files, a crowded day is
    written by several tasks, and each file covers a short stretch of time.  Row groups carry Bloom
    filters of ids and plates, as large as their values need.
    """
    rows = sightings.select(*[F.col(c).cast(kind).alias(c) for c, kind in SIGHTING.items()])
    rows = rows.withColumn(_DAY, F.to_date("pass_time")).withColumn(_BATCH, F.lit(batch or uuid.uuid4().hex))
    order = [_DAY, "pass_time", "plate", "id"]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    filters = {f"parquet.bloom.filter.enabled#{c}": "true" for c in LOOKUP} | {"parquet.bloom.filter.adaptive.enabled": "true"}
    # Only the folders of this batch are replaced.
    writer = ranges.write.options(**filters).partitionBy(_DAY, _BATCH).option("partitionOverwriteMode", "dynamic")
    writer.mode("overwrite").parquet(path)


def stored_days(spark: SparkSession, path: str, batch: str) -> list[date]:
    """The days that a batch has sightings of, from the folders' names."""
    rows = _stored(spark, path).where((F.col(_BATCH) == batch) & F.col(_DAY).isNotNull())
    return [r[_DAY] for r in rows.select(_DAY).distinct().orderBy(_DAY).collect()]  # one row per day


def look_up(spark: SparkSession, path: str, values: list[str], column: str = "id", **span) -> DataFrame:
    """Sightings with one of a few ids, or plates; row groups that cannot hold any are skipped.

    ``span`` is ``since`` and ``until`` of ``read_store``.  Values go to the scan ten at a time, as that many are looked up one by one.
    """
    if column not in LOOKUP:
        raise ValueError(f"look up by one of {LOOKUP}")
    found = [read_store(spark, path, **span).where(F.col(column).isin(values[i : i + 10])) for i in range(0, len(values), 10)]
    return reduce(DataFrame.unionByName, found) if found else read_store(spark, path, **span).where(F.lit(False))


def read_store(
    spark: SparkSession, path: str, since: datetime | str | None = None, until: datetime | str | None = None
) -> DataFrame:
    """Sightings strictly later than ``since`` and strictly earlier than ``until``; all of them without."""
    rows = _stored(spark, path)
    if since is not None:
        after = moment_literal(since)
        rows = rows.where((F.col(_DAY) >= F.to_date(after)) & (F.col("pass_time") > after))
    if until is not None:
        before = moment_literal(until)
        rows = rows.where((F.col(_DAY) <= F.to_date(before)) & (F.col("pass_time") < before))
    return rows.drop(_DAY, _BATCH)


def _stored(spark, path):
    fields = ", ".join(f"{name} {kind}" for name, kind in SIGHTING.items())
    return spark.read.schema(f"{fields}, {_DAY} date, {_BATCH} string").parquet(path)
