"""Micro-batches of sightings joined with a set of plates.

The join runs inside ``foreachBatch``, where a micro-batch is an ordinary DataFrame:
adaptive execution then sees its real size, splits a plate that fills it, and the set of
plates can be read anew when asked for.
"""

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from platewatch.model import TRIGGER
from platewatch.operators.membership import (
    BROADCAST_BYTES,
    first_entry,
    frozen,
    plate_counts,
    plate_set,
    seen_before,
    seen_before_repeated,
    watchlist_alerts,
)
from platewatch.sources.versions import PlateVersions

Join = Callable[[DataFrame, DataFrame], DataFrame]


def start_alerts(
    sightings: DataFrame,
    join: Join,
    load_plates: Callable[[], DataFrame],
    target,
    checkpoint: str,
    trigger: dict | None = None,
    refresh_plates: bool = False,
    name: str | None = None,
    max_broadcast: int = BROADCAST_BYTES,
) -> StreamingQuery:
    """Join each micro-batch with the plates and append the result to the target.

    Plates are read, frozen and measured once when the stream starts; beyond ``max_broadcast`` bytes they are
    kept in buckets, and a micro-batch shuffles its own rows only.  With
    ``refresh_plates`` each micro-batch reads them anew, and the join goes by what the
    adaptive execution measures; that is for plates that are cheap to read, such as a table of
    them, not for a whole analysis per micro-batch.
    """
    fixed = None if refresh_plates else frozen(load_plates(), max_broadcast)

    def write(batch: DataFrame, batch_id: int) -> None:
        plates = load_plates() if refresh_plates else fixed
        target.append(join(batch, plates), batch_id)

    return _started(sightings, write, checkpoint, trigger, name)


def start_versioned_alerts(
    sightings: DataFrame,
    join: Join,
    versions: PlateVersions,
    target,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Join each micro-batch with the version of the plates that is the latest when it first runs.

    A micro-batch that is repeated after a failure sees the version it saw before, whatever was published since;
    a version is read and measured once, not for every micro-batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        target.append(join(batch, versions.seen_by(spark, stream, batch_id)), batch_id)

    return _started(sightings, write, checkpoint, trigger, name)


def _started(rows, write, checkpoint, trigger, name, mode="append"):
    writer = rows.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or {"processingTime": TRIGGER})).start()


def start_watchlist_alerts(sightings, load_watchlist, target, checkpoint, **options) -> StreamingQuery:
    """Sightings of plates on the watchlist."""
    return start_alerts(
        sightings, watchlist_alerts, lambda: plate_set(load_watchlist()), target, checkpoint, **options
    )


def start_first_entry(sightings, load_known, target, checkpoint, **options) -> StreamingQuery:
    """Sightings of plates that are not known."""
    return start_alerts(
        sightings, first_entry, lambda: plate_set(load_known()), target, checkpoint, **options
    )


def start_first_entry_once(
    sightings,
    load_known,
    target,
    checkpoint,
    forget_after_s: int | None = None,
    trigger: dict | None = None,
    name: str | None = None,
    max_broadcast: int = BROADCAST_BYTES,
) -> StreamingQuery:
    """The first sighting of each plate that is not known, reported once over all micro-batches and restarts.

    Of a plate's sightings in the micro-batch that brings it the earliest is reported, ties by the smaller id;
    sightings without a time come last.  With ``forget_after_s`` a plate not seen for so long, by the sightings'
    own times, is forgotten and reported anew; without it the state keeps one entry per unknown plate.
    """
    known = frozen(plate_set(load_known()), max_broadcast)
    entries = first_of_each_plate(first_entry(sightings, known), forget_after_s)
    return _started(entries, target.append, checkpoint, trigger, name)


def first_of_each_plate(sightings: DataFrame, forget_after_s: int | None = None) -> DataFrame:
    """The first row of each plate in a stream; a null plate is none."""
    columns, layout = sightings.columns, {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    moment = F.date_format("pass_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    id_text = F.col("id").cast("string")
    order = F.concat(F.coalesce(moment, F.lit("~")), F.lpad(F.length(id_text).cast("string"), 9, "0"), id_text)
    rows = sightings.where(F.col("plate").isNotNull()).select(
        F.col("plate").alias("key"),
        F.col("pass_time").cast("timestamp").alias("at"),
        F.coalesce(order, F.lit("~~")).alias("rank"),
        F.to_json(F.struct(*columns), layout).alias("row"),
    )
    if forget_after_s is not None:
        rows = rows.withWatermark("at", "0 seconds")

    def first(key, frames, state):
        if state.hasTimedOut:
            state.remove()
            return
        least = latest = None
        for frame in frames:
            own = min(zip(frame["rank"], frame["row"]))
            least = own if least is None else min(least, own)
            latest = max((t for t in (latest, frame["at"].max()) if t is not None and t == t), default=None)
        if forget_after_s is not None and latest is not None:
            seen = max(int(latest.timestamp() * 1000), state.get[0] if state.exists else 0)
            due = max(seen + 1000 * forget_after_s, state.getCurrentWatermarkMs() + 1)
        else:
            seen, due = (state.get[0] if state.exists else 0), None
        if not state.exists:
            yield pd.DataFrame({"row": [least[1]]})
        state.update((seen,))
        if due is not None:
            state.setTimeoutTimestamp(due)

    timeout = GroupStateTimeout.NoTimeout if forget_after_s is None else GroupStateTimeout.EventTimeTimeout
    found = rows.groupBy("key").applyInPandasWithState(first, "row string", "seen long", "append", timeout)
    return found.select(F.from_json("row", sightings.schema, layout).alias("r")).select("r.*")


def start_seen_before(
    sightings, load_history, target, checkpoint, repeated: bool = False, **options
) -> StreamingQuery:
    """Sightings of plates in the history, once or as often as it holds them."""
    if repeated:
        return start_alerts(
            sightings,
            seen_before_repeated,
            lambda: plate_counts(load_history()),
            target,
            checkpoint,
            **options,
        )
    return start_alerts(
        sightings, seen_before, lambda: plate_set(load_history()), target, checkpoint, **options
    )


def start_dead_letters(dead_letters: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep unreadable messages, or unreadable entries, in a Parquet table."""
    return (
        dead_letters.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .start(path)
    )
