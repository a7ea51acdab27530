"""Decoding messages: a JSON array of flat string maps becomes one row per sighting.

What cannot be read is kept beside: whole messages, and single entries of readable messages.
"""

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewatch.functions.clock import parse_time
from platewatch.model import MESSAGE_FIELDS, MESSAGE_TYPE


class Decoded(NamedTuple):
    sightings: DataFrame
    dead_letters: DataFrame


def decode_messages(messages: DataFrame) -> Decoded:
    """Sightings, and the messages that cannot be read.

    A message is one JSON array of flat maps and nothing after it.  Entries that are no sighting are
    left to ``dead_entries``; other missing keys give NULL.  ``id`` is the place in the topic where the
    message has one, so that the same content sent twice stays two sightings; else it is made of the content.
    """
    parsed = _parsed(messages)
    sightings = _entries(parsed).where(F.col("reason").isNull()).select(
        "id",
        "plate",
        F.col("entry")[MESSAGE_FIELDS["brand"]].alias("brand"),
        F.col("entry")[MESSAGE_FIELDS["colour"]].alias("colour"),
        parse_time(F.col("time_text")).alias("pass_time"),
        F.col("entry")[MESSAGE_FIELDS["site_id"]].alias("site_id"),
    )
    return Decoded(sightings, parsed.where(F.col("entries").isNull()).drop("entries"))


def dead_entries(messages: DataFrame) -> DataFrame:
    """Entries of readable messages without a plate, with a nested plate or with an unreadable time.

    They come with their place, plate and time as received, their whole text and the reason.
    """
    rows = _entries(_parsed(messages)).where(F.col("reason").isNotNull())
    return rows.withColumn("entry", F.to_json("entry"))


def _parsed(messages):
    """Messages with their ``entries``, NULL where they cannot be read."""
    # The parser stops at the end of an array.  So the message is put into a further array, before a mark
    # that no message can hold: the mark comes second only if the message is one array.
    mark = F.md5("value")
    line = F.concat(F.lit("["), "value", F.lit(',[{"mark":"'), mark, F.lit('"}]]'))
    whole = F.from_json(line, f"array<{MESSAGE_TYPE}>")
    single = (F.size(whole) == 2) & (F.get(F.get(whole, F.lit(1)), F.lit(0))["mark"] == mark)
    return messages.withColumn("entries", F.when(single, F.get(whole, F.lit(0))))


def _entries(parsed):
    """One row per entry: id, plate, time_text, entry, and the reason why it is no sighting, if there is one."""
    if {"topic", "partition", "offset"} <= set(parsed.columns):
        origin = F.concat_ws("-", *[F.col(c).cast("string") for c in ("topic", "partition", "offset")])
    else:
        origin = F.md5("value")
    rows = parsed.where(F.col("entries").isNotNull()).select(
        origin.alias("origin"), F.posexplode("entries").alias("place", "entry")
    )
    plate, time = (F.col("entry")[MESSAGE_FIELDS[name]] for name in ("plate", "pass_time"))
    bad_plate = plate.isNull() | (F.trim(plate) == "") | F.substring(plate, 1, 1).isin("{", "[")
    return rows.select(
        F.concat_ws("-", "origin", F.col("place").cast("string")).alias("id"),
        plate.alias("plate"),
        time.alias("time_text"),
        "entry",
        F.when(bad_plate, "plate").when(parse_time(time).isNull(), "time").alias("reason"),
    )
