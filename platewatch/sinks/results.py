"""Appending batch results to relational tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewatch.functions.clock import format_time
from platewatch.sources.jdbc import Database


def write_results(rows: DataFrame, database: Database, table: str) -> None:
    rows.write.format("jdbc").options(**database.options(table)).mode("append").save()


def write_probe(spark: SparkSession, database: Database, table: str) -> None:
    """Append one row with a ``value`` to see whether the database can be written."""
    write_results(spark.createDataFrame([("test",)], "value string"), database, table)


def clone_result(report: DataFrame) -> DataFrame:
    """A clone report as rows of the clone table."""
    return report.select(
        F.col("id").cast("string").alias("id"),
        F.col("plate").alias("hphm"),
        F.col("brand").alias("clpp"),
        F.col("colour").alias("clys"),
        format_time(F.col("pass_time")).alias("tgsj"),
        F.col("site_id").alias("kkbh"),
        F.col("run_id").alias("jsbh"),
        F.col("created_at").cast("timestamp").alias("create_time"),
    )
