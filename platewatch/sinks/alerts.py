"""Where a stream of alerts goes.  Writing the same micro-batch again adds nothing."""

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platewatch.functions.clock import format_time
from platewatch.model import ALERT_TABLE, SIGHTING
from platewatch.sources.jdbc import Database, read_table

EMPTY_ALERTS = ", ".join(f"{name} {kind}" for name, kind in (SIGHTING | {"copy": "long", "stream": "string", "batch_id": "int"}).items())
PUBLISHED = "stream string, batch_id int, attempt string"


@dataclass(frozen=True)
class ParquetAlerts:
    """A Parquet table of micro-batches, each seen whole or not at all.

    A batch is written to a folder of its own and then published by one row of a list of batches; only
    what the list names is read.  A failure in between shows no rows, and a batch that is repeated after it was
    published adds none.  A stream is known by the identity that its checkpoint keeps, so several streams, or a
    stream begun anew, can share a table.  ``stream`` names it for batches written by hand.
    """

    path: str
    stream: str | None = None

    def append(self, alerts: DataFrame, batch_id: int) -> None:
        spark = alerts.sparkSession
        running = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        stream = self.stream or running or "by-hand"
        known = self._published(spark)
        if not known.where((F.col("stream") == stream) & (F.col("batch_id") == batch_id)).isEmpty():
            return
        attempt = uuid.uuid4().hex
        alerts.write.parquet(f"{self.path}/data/stream={stream}/batch_id={batch_id}/attempt={attempt}")
        self._publish(spark, stream, batch_id, attempt)

    def _publish(self, spark, stream, batch_id, attempt):
        entry = spark.range(1).select(F.lit(stream).alias("stream"), F.lit(batch_id).cast("int").alias("batch_id"), F.lit(attempt).alias("attempt"))
        entry.coalesce(1).write.mode("append").parquet(f"{self.path}/published")

    def _published(self, spark):
        return read_or_empty(spark, f"{self.path}/published", PUBLISHED)

    def read(self, spark: SparkSession) -> DataFrame:
        """All alerts of published batches; before the first batch a table without rows."""
        # Should two drivers have published one batch, the first attempt by name counts.
        chosen = self._published(spark).groupBy("stream", "batch_id").agg(F.min("attempt").alias("attempt"))
        rows = read_or_empty(spark, f"{self.path}/data", f"{EMPTY_ALERTS}, attempt string")
        return rows.join(chosen, ["stream", "batch_id", "attempt"], "left_semi").drop("attempt")


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table that may not have been begun yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


@dataclass(frozen=True)
class JdbcAlerts:
    """A relational table.

    Row ids carry stream, micro-batch and sighting.  A repeated batch reads back only the
    rows of its own number and appends what is missing.  Give ``id`` a unique index to
    also shut out the rare task that commits and is then run again.
    """

    database: Database
    stream: str
    table: str = ALERT_TABLE

    def append(self, alerts: DataFrame, batch_id: int) -> None:
        # The length keeps names that end in digits apart from others.
        prefix = f"{len(self.stream)}-{self.stream}-{batch_id}-"
        rows = alert_rows(alerts, F.concat(F.lit(prefix), alert_key(alerts)))
        written = read_table(alerts.sparkSession, self.database, self.table)
        written = written.where(F.col("id").startswith(prefix)).select("id")
        missing_rows(rows, written).write.format("jdbc").options(
            **self.database.options(self.table)
        ).mode("append").save()


def missing_rows(rows: DataFrame, written: DataFrame) -> DataFrame:
    return rows.join(written, "id", "left_anti")


def alert_key(alerts: DataFrame) -> Column:
    """Identity of an alert: the sighting and, where a sighting repeats, its copy number."""
    parts = ["id", "copy"] if "copy" in alerts.columns else ["id"]
    return F.concat_ws("-", *[F.col(p).cast("string") for p in parts])


def alert_rows(alerts: DataFrame, key: Column) -> DataFrame:
    """Alerts as rows of the alert table, all text."""
    return alerts.select(
        key.alias("id"),
        F.col("plate").alias("hphm"),
        F.col("brand").alias("clpp"),
        F.col("colour").alias("clys"),
        format_time(F.col("pass_time")).alias("tgsj"),
        F.col("site_id").alias("kkbh"),
        F.current_timestamp().cast("string").alias("create_time"),
    )
