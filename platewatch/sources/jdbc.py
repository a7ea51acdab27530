"""Relational tables, read and named through Spark's JDBC source."""

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewatch.model import CLONE_TABLE
from platewatch.operators.membership import plate_set


@dataclass(frozen=True)
class Database:
    """Where a relational database is.

    User and password come from the caller or from ``PLATEWATCH_JDBC_USER`` and
    ``PLATEWATCH_JDBC_PASSWORD``; they are never part of the code.
    """

    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    batch_rows: int = 5000
    fetch_rows: int = 10000

    def options(self, table: str) -> dict[str, str]:
        user = self.user or os.environ.get("PLATEWATCH_JDBC_USER")
        password = self.password or os.environ.get("PLATEWATCH_JDBC_PASSWORD")
        values = {
            "url": self.url,
            "dbtable": table,
            "user": user,
            "password": password,
            "driver": self.driver,
            "batchsize": str(self.batch_rows),
            "fetchsize": str(self.fetch_rows),
        }
        return {k: v for k, v in values.items() if v is not None}


@dataclass(frozen=True)
class Slices:
    """How to read a table in parallel: ranges of a numeric, date or timestamp column."""

    column: str
    lower: str
    upper: str
    count: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": str(self.count),
        }


def read_table(
    spark: SparkSession, database: Database, table: str, slices: Slices | None = None
) -> DataFrame:
    """A whole table; Spark sends column choice and filters on to the database."""
    options = database.options(table)
    if slices is not None:
        options |= slices.options()
    return spark.read.format("jdbc").options(**options).load()


def read_watchlist(
    spark: SparkSession,
    database: Database,
    table: str = CLONE_TABLE,
    slices: Slices | None = None,
) -> DataFrame:
    """The distinct plates of a report table."""
    return watchlist_of(read_table(spark, database, table, slices))


def watchlist_of(report: DataFrame) -> DataFrame:
    return plate_set(report.select(F.col("hphm").alias("plate")))
