"""Small helpers that the operators of this subpackage share."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platewatch.session import new_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_name(rows: DataFrame, base: str) -> str:
    """A column name that the table does not have yet, whatever its letter case."""
    taken = {c.lower() for c in rows.columns}
    while base.lower() in taken:
        base += "_"
    return base


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Rows written once to the folder that all executors share, and read from there."""
    path = new_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def row_keys(doc_id: str, text: str) -> dict[str, Column]:
    """Key columns that hold no null and are equal for equal (doc_id, text)."""
    return {
        "_no_id": F.col(doc_id).isNull().cast("int"),
        "_id": F.coalesce(F.col(doc_id).cast("long"), F.lit(0).cast("long")),
        "_hash": F.xxhash64(F.col(text)),
        "_no_text": F.col(text).isNull().cast("int"),
    }
