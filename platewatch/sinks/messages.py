"""Publishing sightings as messages."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewatch.functions.clock import format_time
from platewatch.model import MESSAGE_FIELDS, TOPIC

MESSAGE_ROWS = 500


def encode_messages(sightings: DataFrame, message_rows: int = MESSAGE_ROWS) -> DataFrame:
    """Messages of at most ``message_rows`` sightings each, in one ``value`` column.

    Rows are numbered inside their partition, after a local sort that makes the numbering
    repeatable when a task runs again, and grouped by that number; so equal sightings,
    however many, spread over messages like any others.
    """
    fields = {
        key: format_time(F.col(name)) if name == "pass_time" else F.col(name).cast("string")
        for name, key in MESSAGE_FIELDS.items()
    }
    rows = sightings.select(*[column.alias(key) for key, column in fields.items()])
    # Partition number in the upper bits, row number in the lower 33.
    number = F.monotonically_increasing_id()
    within = number.bitwiseAND(F.lit((1 << 33) - 1))
    numbered = rows.sortWithinPartitions(*fields).select(
        F.shiftright(number, 33).alias("_partition"),
        F.floor(within / message_rows).alias("_message"),
        F.struct(*fields).alias("entry"),
    )
    return (
        numbered.groupBy("_partition", "_message")
        .agg(F.to_json(F.collect_list("entry")).alias("value"))
        .select("value")
    )


def publish_sightings(
    sightings: DataFrame, servers: str, topic: str = TOPIC, message_rows: int = MESSAGE_ROWS
) -> None:
    """Send the sightings to a topic, without keys."""
    (
        encode_messages(sightings, message_rows)
        .write.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "topic": topic})
        .save()
    )


def publish_to_files(sightings: DataFrame, path: str, message_rows: int = MESSAGE_ROWS) -> None:
    """The same as text files with one message per line."""
    encode_messages(sightings, message_rows).write.mode("append").text(path)
