"""From raw documents to shuffled training shards, stage by stage."""

from pyspark.sql import DataFrame, SparkSession

from platewatch.llm.common import table
from platewatch.llm.decontaminate import decontaminate
from platewatch.llm.mixing import mixed
from platewatch.llm.quality import keep_good
from platewatch.llm.sharding import sharded
from platewatch.llm.simhash import keep_one
from platewatch.session import new_folder


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return keep_one(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated up to the limit; every document is drawn at least once."""
    return mixed(docs).select(*docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in random order, with shard and slot."""
    return sharded(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", no_benchmark),
    ("source mixing", mixed_sources),
    ("sharding", shards),
]

# A trained classifier and numpy's shuffle have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over what the one before kept, written between as Parquet in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
