"""Message topics.  The settings are plain maps; Spark's Kafka connector must be deployed."""

import json

from pyspark.sql import DataFrame, SparkSession

from platewatch.model import TOPIC


def subscription(servers: str, topics: str = TOPIC, group: str | None = None, **more) -> dict[str, str]:
    """Follow all partitions of comma-separated topics, starting at the latest message."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics,
        "startingOffsets": "latest",
    }
    if group:
        options["kafka.group.id"] = group
    return options | more


def assignment(servers: str, offsets: dict[str, dict[int, int]], group: str | None = None, **more) -> dict[str, str]:
    """Follow given partitions from given offsets: ``{topic: {partition: offset}}``.

    The offsets count only when a stream starts for the first time; from then on its
    checkpoint knows where it is.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "assign": json.dumps({topic: sorted(parts) for topic, parts in offsets.items()}),
        "startingOffsets": json.dumps(
            {topic: {str(p): o for p, o in sorted(parts.items())} for topic, parts in offsets.items()}
        ),
    }
    if group:
        options["kafka.group.id"] = group
    return options | more


def stored_offset(offsets: DataFrame, default: int = 1) -> int:
    """The last row of a one-column table of offsets, or the default when it is empty."""
    last = offsets.select("offset").tail(1)
    return int(last[0][0]) if last and last[0][0] is not None else default


def read_message_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Messages with ``value`` as text and the place they had in the topic."""
    return (
        spark.readStream.format("kafka")
        .options(**options)
        .load()
        .selectExpr("CAST(value AS STRING) AS value", "topic", "partition", "offset")
    )


def read_message_files(spark: SparkSession, path: str) -> DataFrame:
    """The same from a folder of text files with one message per line."""
    return spark.readStream.schema("value string").text(path)
