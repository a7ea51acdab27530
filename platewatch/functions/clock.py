"""Time expressions on zone-less timestamps at whole-second resolution."""

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

_TIME_TEXT = r"^\s*(\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2})"


def parse_time(text: Column) -> Column:
    """Timestamp of a ``yyyy-MM-dd HH:mm:ss`` text, NULL where it is not one."""
    return F.regexp_extract(text, _TIME_TEXT, 1).try_cast("timestamp_ntz")


def format_time(moment: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a whole-second timestamp."""
    return moment.cast("string")


def moment_literal(moment: datetime | str) -> Column:
    """A zone-less constant.  (``lit(datetime)`` would be read in the session time zone.)"""
    return F.lit(str(moment)).cast("timestamp_ntz")


def epoch_seconds(moment: Column, clock12: bool = False) -> Column:
    """Whole seconds since 1970 of a zone-less timestamp, whatever the session time zone.

    ``clock12`` reads the hour as a 12-hour field, so that 12:xx counts as 00:xx.
    """
    since = moment - moment_literal("1970-01-01 00:00:00")
    seconds = since.cast("interval second").cast("long")
    if clock12:
        return F.when(F.hour(moment) == 12, seconds - 43200).otherwise(seconds)
    return seconds


def whole_second(moment: Column) -> Column:
    """Cut the fraction of a second."""
    return moment_literal("1970-01-01 00:00:00") + F.expr("INTERVAL '1' SECOND") * epoch_seconds(moment)


def gap_hours(gap_seconds: Column) -> Column:
    """Hours in a gap, to four decimals."""
    return F.round(F.abs(gap_seconds) / F.lit(3600.0), 4)
