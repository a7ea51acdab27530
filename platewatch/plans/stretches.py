"""Results kept by stretches of days: which are valid, and what the next one has to do."""

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewatch.functions.clock import moment_literal
from platewatch.plans.daily import midnight
from platewatch.sinks.alerts import read_or_empty
from platewatch.sources.store import read_store

STRETCHES = "number long, first date, last date, folder string"


@dataclass(frozen=True)
class Stretch:
    """A run of days done in one go: its results lie in ``folder``. ``first`` is None for all there was.

    A late day sets aside every stretch that reaches it and does it anew with all days after it; so does
    a repeated call.  A stretch is published by one row of a list once all of it is written, so after a
    failure the stretches from before are still what is read.  One refresh runs at a time.
    """

    number: int
    first: date | None
    last: date
    folder: str
    before: tuple["Stretch", ...] = field(default=(), repr=False, compare=False)

    def sightings(self, spark: SparkSession, store: str) -> DataFrame:
        """The store's sightings of these days; those without a time lie in no stretch."""
        until = midnight(self.last + timedelta(days=1))
        if self.first is None:
            return read_store(spark, store, until=until)
        begin = midnight(self.first)
        rows = read_store(spark, store, since=begin - timedelta(seconds=1), until=until)
        return rows.where(F.col("pass_time") >= moment_literal(begin))

    def publish(self, spark: SparkSession, kept: str) -> None:
        row = spark.createDataFrame([(self.number, self.first, self.last, self.folder)], STRETCHES)
        row.coalesce(1).write.mode("append").parquet(f"{kept}/stretches")


def next_stretch(spark: SparkSession, kept: str, days: Iterable[date]) -> Stretch | None:
    """The stretch that brings the results under ``kept`` up to date with ``days``, after the ones that stay valid."""
    changed = set(days)
    if not changed:
        return None
    done = stretches_kept(spark, kept)
    before = tuple(s for s in done if s.last < min(changed))
    first = before[-1].last + timedelta(days=1) if before else None
    last = max(changed | {s.last for s in done})
    number = max((s.number for s in done), default=0) + 1
    return Stretch(number, first, last, f"{kept}/data/{uuid.uuid4().hex}", before)


def stretches_kept(spark: SparkSession, kept: str) -> list[Stretch]:
    """The published stretches that no later one has replaced, in order of their days; one row per refresh is read."""
    live: list[Stretch] = []
    for row in read_or_empty(spark, f"{kept}/stretches", STRETCHES).orderBy("number").collect():
        stretch = Stretch(**row.asDict())
        # A stretch replaces all that reach its first day or lie after it.
        live = [s for s in live if stretch.first is not None and s.last < stretch.first] + [stretch]
    return live
