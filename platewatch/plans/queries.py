"""The registered queries: every operator on the benchmark's ``events`` table."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from platewatch.functions.clock import format_time, moment_literal
from platewatch.model import CSV_FIELDS
from platewatch.operators import clone, cotravel, membership, sequences
from platewatch.operators.scan import sightings_since as since_cutoff
from platewatch.operators.skew import EveryKey
from platewatch.plans import analyses, daily, daily_cotravel, daily_trails
from platewatch.session import new_folder
from platewatch.sinks.alerts import ParquetAlerts
from platewatch.sinks.messages import encode_messages, publish_to_files
from platewatch.sources.events import events_as_sightings, read_events
from platewatch.sources.files import COTRAVEL_NEEDS, HISTORY_NEEDS, read_sighting_table, read_sightings
from platewatch.sources.kafka import read_message_files, stored_offset
from platewatch.sources.messages import dead_entries as entries_set_aside
from platewatch.sources.messages import decode_messages as decode
from platewatch.sources.store import append_to_store, look_up, read_store, stored_days
from platewatch.sources.versions import PlateVersions
from platewatch.streaming import alerts

CUTOFF = datetime(2024, 1, 15)
KNOWN_UNTIL = datetime(2024, 1, 1, 12)
RUN_ID = 7
RUN_TIME = datetime(2024, 2, 1)
FAST_KMH = 10_000
REGION_KM = 3_000
WIDE_S = 7_200
WIDER_S = 172_800
MESSAGE_ROWS = 200
TRAIL_ROWS = 7
GROUP_PLATES = 3
PIECE_ROWS = 2_000
SOUGHT = tuple(str(n) for n in range(3, 60, 5))
ALERT_FIELDS = ["id", "plate", "brand", "colour", "pass_time", "site_id"]


def sightings_since(spark, folder):
    return read_events(spark, folder, CUTOFF).select(*ALERT_FIELDS)


def sightings_since_sql(spark, folder):
    """The same through a view and SQL text with a named parameter."""
    read_events(spark, folder).createOrReplaceTempView("sightings")
    return spark.sql(
        f"SELECT {', '.join(ALERT_FIELDS)} FROM sightings WHERE pass_time > CAST(:cutoff AS TIMESTAMP_NTZ)",
        args={"cutoff": str(CUTOFF)},
    )


def _store(spark, folder):
    path = f"{new_folder(spark, 'store')}/sightings"
    append_to_store(read_events(spark, folder), path)
    return path


def stored_sightings_since(spark, folder):
    return read_store(spark, _store(spark, folder), since=CUTOFF).select(*ALERT_FIELDS)


def stored_lookup(spark, folder):
    """All sightings of a few plates, by the filters that the store keeps."""
    return look_up(spark, _store(spark, folder), list(SOUGHT), "plate").select(*ALERT_FIELDS)


def first_entry_stored(spark, folder):
    path = _store(spark, folder)
    known = read_store(spark, path, until=KNOWN_UNTIL)
    return analyses.first_entries(read_store(spark, path), known).select(*ALERT_FIELDS)


def _every(sightings):
    """Sends every key the way of heavy ones, which has to give the same rows."""
    return {"heavy": EveryKey(sightings.count()), "piece_rows": PIECE_ROWS}


def plate_trail(spark, folder):
    return _trail_text(sequences.plate_trail(read_events(spark, folder)))


def plate_trail_parts(spark, folder):
    return _trail_text(sequences.plate_trail(read_events(spark, folder), trail_rows=TRAIL_ROWS))


def plate_trail_parts_heavy(spark, folder):
    rows = read_events(spark, folder)
    return _trail_text(sequences.plate_trail(rows, trail_rows=TRAIL_ROWS, **_every(rows)))


def plate_trail_daily(spark, folder):
    """Trails grown by three batches, the last of them before the second."""
    kept = _in_three_batches(spark, folder, daily_trails.refresh_trails, trail_rows=TRAIL_ROWS)
    return _trail_text(daily_trails.kept_trails(spark, kept, TRAIL_ROWS))


def _trail_text(trails):
    stops = F.transform("trail", lambda s: F.concat_ws("@", s["site_id"], format_time(s["pass_time"])))
    return trails.select("plate", "part", "n", F.array_join(stops, ";").alias("trail"))


def site_sequences(spark, folder):
    return _sequence_text(sequences.site_sequences(read_events(spark, folder)))


def site_sequences_of_five(spark, folder):
    return _sequence_text(sequences.site_sequences(read_events(spark, folder), n=5))


def site_sequences_heavy(spark, folder):
    rows = read_events(spark, folder)
    return _sequence_text(sequences.site_sequences(rows, **_every(rows)))


def _sequence_text(runs):
    return runs.select(
        "plate",
        "first_id",
        F.array_join("gram", ",").alias("gram"),
        F.array_join(F.col("seconds").cast("array<string>"), ",").alias("seconds"),
    )


def clone_plate_pairs(spark, folder):
    return clone.clone_plate_pairs(read_events(spark, folder))


def clone_plate_pairs_since(spark, folder):
    return clone.clone_plate_pairs(read_events(spark, folder, CUTOFF))


def clone_plate_pairs_clock12(spark, folder):
    return clone.clone_plate_pairs(read_events(spark, folder), clock12=True)


def clone_plate_pairs_simultaneous(spark, folder):
    return clone.clone_plate_pairs(read_events(spark, folder), flag_simultaneous=True)


def clone_plate_pairs_same_hour(spark, folder):
    """Times cut to the hour, so that many sightings share a moment."""
    minutes = F.make_dt_interval(mins=F.minute("pass_time"), secs=F.second("pass_time").cast("decimal(18,6)"))
    rows = read_events(spark, folder).withColumn("pass_time", F.col("pass_time") - minutes)
    return clone.clone_plate_pairs(rows, flag_simultaneous=True)


def clone_plate_pairs_heavy(spark, folder):
    return clone.clone_plate_pairs(read_events(spark, folder), heavy=clone.EVERY_PLATE)


def clone_plate_pairs_outlier(spark, folder):
    """One site's position is sometimes read as (0, 0), half a world away from the others."""
    lost = F.col("id") % 500 == 0
    rows = read_events(spark, folder).withColumns({c: F.when(lost, 0.0).otherwise(F.col(c)) for c in ("lon", "lat")})
    return clone.clone_plate_pairs(rows)


def _in_three_batches(spark, folder, refresh, **rule):
    """Sightings enter the store in three batches, the last before the second; each is followed by a refresh of what is kept."""
    place = new_folder(spark, "daily")
    second = timedelta(seconds=1)
    spans = {
        "early": {"until": KNOWN_UNTIL},
        "late": {"since": CUTOFF - second},
        "between": {"since": KNOWN_UNTIL - second, "until": CUTOFF},
    }
    for name, span in spans.items():
        append_to_store(read_events(spark, folder, **span), f"{place}/store", name)
        days = stored_days(spark, f"{place}/store", name)
        refresh(spark, f"{place}/store", f"{place}/kept", days, **rule)
    return f"{place}/kept"


def clone_plate_pairs_daily(spark, folder):
    """Each time only the days around the new ones are paired anew."""
    kept = _in_three_batches(spark, folder, daily.refresh_clone_pairs, widest_km=REGION_KM)
    return daily.kept_clone_pairs(spark, kept)


def clone_plate_adjacent(spark, folder):
    return clone.clone_plate_adjacent(read_events(spark, folder))


def leg_speeds(spark, folder):
    return clone.leg_speeds(read_events(spark, folder))


def leg_speeds_clock12(spark, folder):
    return clone.leg_speeds(read_events(spark, folder), clock12=True)


def clone_plate_report(spark, folder):
    sightings = read_events(spark, folder)
    return clone.clone_plate_report(clone.clone_plate_pairs(sightings), sightings, RUN_ID, RUN_TIME)


def clone_report_adjacent(spark, folder):
    rows = analyses.cloned_plates(read_events(spark, folder), RUN_ID, RUN_TIME, scope="adjacent")
    return rows.drop("create_time")


def clone_report_all_pairs(spark, folder):
    return analyses.cloned_plates(read_events(spark, folder), RUN_ID, RUN_TIME).drop("create_time")


def clone_watchlist_at_limit(spark, folder):
    """At the speed that is the default."""
    return clone.clone_watchlist(read_events(spark, folder))


def clone_watchlist(spark, folder):
    return clone.clone_watchlist(read_events(spark, folder), max_kmh=FAST_KMH)


def clone_watchlist_heavy(spark, folder):
    return clone.clone_watchlist(read_events(spark, folder), max_kmh=FAST_KMH, heavy=clone.EVERY_PLATE)


def cotravel_members(spark, folder):
    return _gram_text(cotravel.cotravel_members(read_events(spark, folder)))


def cotravel_members_heavy(spark, folder):
    rows = read_events(spark, folder)
    return _gram_text(cotravel.cotravel_members(rows, heavy_places={}, **_every(rows)))


def cotravel_groups_parts(spark, folder):
    members = cotravel.cotravel_members(read_events(spark, folder))
    return _group_text(members, group_plates=GROUP_PLATES, piece_rows=PIECE_ROWS)


def cotravel_groups(spark, folder):
    return _group_text(cotravel.cotravel_members(read_events(spark, folder)))


def cotravel_groups_daily(spark, folder):
    """Groups from what was kept of three batches, the last of them before the second."""
    kept = _in_three_batches(spark, folder, daily_cotravel.refresh_cotravel)
    return _group_text(daily_cotravel.kept_cotravel_members(spark, kept))


def cotravel_groups_self(spark, folder):
    return _group_text(cotravel.cotravel_members(read_events(spark, folder), allow_self=True))


def cotravel_groups_self_wide(spark, folder):
    """A tolerance that lets plates keep company with themselves."""
    return _group_text(cotravel.cotravel_members(read_events(spark, folder), tolerance_s=WIDE_S, allow_self=True))


def cotravel_all(spark, folder):
    members = cotravel.cotravel_members(read_events(spark, folder), tolerance_s=WIDE_S, match="all")
    return _group_text(members)


def cotravel_all_of_five(spark, folder):
    rows = read_events(spark, folder)
    return _group_text(cotravel.cotravel_members(rows, n=5, tolerance_s=WIDER_S, match="all"))


def cotravel_pairs(spark, folder):
    return _gram_text(cotravel.cotravel_pairs(read_events(spark, folder)))


def cotravel_result(spark, folder):
    return analyses.travelling_together(read_events(spark, folder), RUN_ID, RUN_TIME)


def _gram_text(rows):
    return rows.withColumn("gram", F.array_join("gram", ","))


def _group_text(members, **limits):
    groups = cotravel.cotravel_groups(members, **limits)
    return _gram_text(groups).withColumn("plates", F.array_join("plates", ","))


def _history(sightings):
    return sightings.where(F.col("pass_time") < F.lit(str(KNOWN_UNTIL)).cast("timestamp_ntz"))


def _known(spark, folder):
    return read_events(spark, folder, until=KNOWN_UNTIL)


def first_entry(spark, folder):
    return analyses.first_entries(read_events(spark, folder), _known(spark, folder)).select(*ALERT_FIELDS)


def seen_before(spark, folder):
    sightings = read_events(spark, folder)
    seen = membership.seen_before(sightings, membership.plate_set(_known(spark, folder)))
    return since_cutoff(seen, KNOWN_UNTIL).select(*ALERT_FIELDS)


def seen_before_counted(spark, folder):
    sightings = read_events(spark, folder)
    counts = membership.plate_counts(_known(spark, folder))
    return membership.seen_before_counted(sightings, counts).select(*ALERT_FIELDS, "times_seen")


def seen_before_repeated(spark, folder):
    sightings = read_events(spark, folder)
    counts = membership.plate_counts(_known(spark, folder))
    return membership.seen_before_repeated(sightings, counts).select(*ALERT_FIELDS, "copy")


def watchlist_alerts(spark, folder):
    sightings = read_events(spark, folder)
    watchlist = clone.clone_watchlist(sightings, max_kmh=FAST_KMH)
    return membership.watchlist_alerts(sightings, watchlist).select(*ALERT_FIELDS)


def _event_stream(spark, folder):
    path = f"{folder}/events.parquet"
    schema = spark.read.parquet(path).schema
    # As a pattern the path may be a file as well as a folder.
    return events_as_sightings(spark.readStream.schema(schema).parquet(f"{folder}/events.{{parquet}}"))


def _alerts_of(spark, start, sightings, load_plates, fields=ALERT_FIELDS, **options):
    place = new_folder(spark, "alerts")
    target = ParquetAlerts(f"{place}/table")
    query = start(
        sightings,
        load_plates,
        target,
        f"{place}/checkpoint",
        trigger={"availableNow": True},
        **options,
    )
    query.awaitTermination()
    return target.read(spark).select(*fields)


def watchlist_alerts_stream(spark, folder):
    return _alerts_of(
        spark,
        alerts.start_watchlist_alerts,
        _event_stream(spark, folder),
        lambda: clone.clone_watchlist(read_events(spark, folder), max_kmh=FAST_KMH),
    )


def watchlist_alerts_refreshed(spark, folder):
    """The watchlist, stored as a table, is read anew for each micro-batch."""
    path = new_folder(spark, "watchlist")
    clone.clone_watchlist(read_events(spark, folder), max_kmh=FAST_KMH).write.parquet(path)
    return _alerts_of(
        spark,
        alerts.start_watchlist_alerts,
        _event_stream(spark, folder),
        lambda: spark.read.parquet(path),
        refresh_plates=True,
    )


def watchlist_alerts_as_of(spark, folder):
    """Between two runs of a stream the watchlist gets a second version; alerts keep to what was the latest when they were raised."""
    place = new_folder(spark, "alerts")
    target, versions = ParquetAlerts(f"{place}/table"), PlateVersions(f"{place}/watchlist")
    sightings = read_events(spark, folder)
    events = spark.read.parquet(f"{folder}/events.parquet")
    early = F.col("ts") < moment_literal(CUTOFF)
    for part, since in ((early, None), (~early, CUTOFF)):
        versions.publish(clone.clone_watchlist(sightings, since, FAST_KMH))
        events.where(part).write.mode("append").parquet(f"{place}/events")
        stream = events_as_sightings(spark.readStream.schema(events.schema).parquet(f"{place}/events"))
        alerts.start_versioned_alerts(
            stream, membership.watchlist_alerts, versions, target, f"{place}/checkpoint", trigger={"availableNow": True}
        ).awaitTermination()
    return target.read(spark).select(*ALERT_FIELDS)


def watchlist_alerts_two_streams(spark, folder):
    """Two streams append to one table: what passes one site, and the rest."""
    place = new_folder(spark, "alerts")
    target = ParquetAlerts(f"{place}/table")
    view = F.col("site_id") == "view"
    for number, part in enumerate((view, ~view)):
        _run_once(spark, folder, _event_stream(spark, folder).where(part), target, f"{place}/checkpoint-{number}")
    return target.read(spark).select(*ALERT_FIELDS)


def watchlist_alerts_restarted(spark, folder):
    """A stream is stopped and goes on from its checkpoint when more events have come."""
    place = new_folder(spark, "alerts")
    target = ParquetAlerts(f"{place}/table")
    events = spark.read.parquet(f"{folder}/events.parquet")
    early = F.col("ts") < F.lit(str(CUTOFF)).cast("timestamp_ntz")
    for part in (early, ~early):
        events.where(part).write.mode("append").parquet(f"{place}/events")
        stream = events_as_sightings(spark.readStream.schema(events.schema).parquet(f"{place}/events"))
        _run_once(spark, folder, stream, target, f"{place}/checkpoint")
    return target.read(spark).select(*ALERT_FIELDS)


def _run_once(spark, folder, stream, target, checkpoint):
    alerts.start_watchlist_alerts(
        stream,
        lambda: clone.clone_watchlist(read_events(spark, folder), max_kmh=FAST_KMH),
        target,
        checkpoint,
        trigger={"availableNow": True},
    ).awaitTermination()


def first_entry_stream(spark, folder):
    return _alerts_of(
        spark,
        alerts.start_first_entry,
        _event_stream(spark, folder),
        lambda: _known(spark, folder),
    )


def seen_before_stream(spark, folder):
    return _alerts_of(
        spark,
        alerts.start_seen_before,
        _event_stream(spark, folder),
        lambda: _known(spark, folder),
    )


def first_entry_stream_once(spark, folder):
    """The events come in three parts, each followed by a stream that is stopped and started again."""
    place = new_folder(spark, "alerts")
    target = ParquetAlerts(f"{place}/table")
    events = spark.read.parquet(f"{folder}/events.parquet")
    day = [F.lit(str(t)).cast("timestamp_ntz") for t in (KNOWN_UNTIL, CUTOFF)]
    for part in (F.col("ts") < day[0], (F.col("ts") >= day[0]) & (F.col("ts") < day[1]), F.col("ts") >= day[1]):
        events.where(part).write.mode("append").parquet(f"{place}/events")
        stream = events_as_sightings(spark.readStream.schema(events.schema).parquet(f"{place}/events"))
        alerts.start_first_entry_once(
            stream, lambda: _known(spark, folder), target, f"{place}/checkpoint", trigger={"availableNow": True}
        ).awaitTermination()
    return target.read(spark).select(*ALERT_FIELDS)


def seen_before_bucketed(spark, folder):
    """The history is kept in buckets, as one too large to be broadcast."""
    return _alerts_of(
        spark,
        alerts.start_seen_before,
        _event_stream(spark, folder),
        lambda: _known(spark, folder),
        [*ALERT_FIELDS, "copy"],
        repeated=True,
        max_broadcast=0,
    )


def seen_before_repeated_stream(spark, folder):
    return _alerts_of(
        spark,
        alerts.start_seen_before,
        _event_stream(spark, folder),
        lambda: _known(spark, folder),
        [*ALERT_FIELDS, "copy"],
        repeated=True,
    )


def message_alerts_stream(spark, folder):
    """Publish all sightings as messages, follow them, and alert on the watchlist."""
    messages = f"{new_folder(spark, 'messages')}/topic"
    publish_to_files(read_events(spark, folder), messages, MESSAGE_ROWS)
    return _alerts_of(
        spark,
        alerts.start_watchlist_alerts,
        decode(read_message_files(spark, messages)).sightings,
        lambda: clone.clone_watchlist(read_events(spark, folder), max_kmh=FAST_KMH),
        [f for f in ALERT_FIELDS if f != "id"],
    )


def message_alerts_bad_time(spark, folder):
    """The same where the times of one site are missing: its sightings are set aside."""
    messages = f"{new_folder(spark, 'messages')}/topic"
    time = F.when(F.col("site_id") != "signup", F.col("pass_time"))
    publish_to_files(read_events(spark, folder).withColumn("pass_time", time), messages, MESSAGE_ROWS)
    return _alerts_of(
        spark,
        alerts.start_watchlist_alerts,
        decode(read_message_files(spark, messages)).sightings,
        lambda: clone.clone_watchlist(read_events(spark, folder), max_kmh=FAST_KMH),
        [f for f in ALERT_FIELDS if f != "id"],
    )


def last_offset(spark, folder):
    """The offset that a table holds last, here that of the last event."""
    offsets = spark.read.parquet(f"{folder}/events.parquet").select(F.col("event_id").alias("offset"))
    return spark.range(1).select(F.lit(stored_offset(offsets.orderBy("offset"))).cast("long").alias("offset"))


def dead_entries(spark, folder):
    """Entries of one site come without plate, those of another with a spoilt time; only these come back."""
    rows = read_events(spark, folder)
    time = F.when(F.col("site_id") == "signup", F.lit("bad")).otherwise(format_time(F.col("pass_time")))
    plate = F.when(F.col("site_id") != "error", F.col("plate"))
    entry = F.struct(plate.alias("HPHM"), time.alias("TGSJ"))
    messages = rows.select(F.to_json(F.array(entry)).alias("value"))
    return entries_set_aside(messages).select("plate", "time_text", "reason")


def decode_messages(spark, folder):
    messages = encode_messages(read_events(spark, folder), MESSAGE_ROWS)
    return decode(messages).sightings.drop("id")


def publish_sightings(spark, folder):
    """Every sighting is in a message, and no message is over the limit."""
    messages = encode_messages(read_events(spark, folder), MESSAGE_ROWS)
    size = F.json_array_length("value").cast("long")
    return messages.agg(
        F.sum(size).alias("sightings"), (F.max(size) <= MESSAGE_ROWS).alias("within_limit")
    )


def dead_letters(spark, folder):
    """Messages of which those of one site are spoilt; only these come back."""
    site, entry = F.col("event_type"), F.to_json(F.array(F.create_map(F.lit("KKBH"), F.col("event_type"))))
    events = spark.read.parquet(f"{folder}/events.parquet")
    messages = events.select(
        "event_id", F.when(site == "error", F.concat(F.lit("{"), entry)).otherwise(entry).alias("value")
    )
    return decode(messages).dead_letters


def _written_csv(spark, folder, spoilt, some=None, layout=tuple(CSV_FIELDS)):
    """The sightings as headered CSV; ``spoilt`` breaks the times and places of two sites."""
    rows = read_events(spark, folder)
    if some is not None:
        rows = rows.where(some)
    time = format_time(F.col("pass_time"))
    position = F.concat_ws("_", F.col("lon").cast("string"), F.col("lat").cast("string"))
    if spoilt:
        time = F.when(F.col("site_id") == "signup", F.lit("bad")).otherwise(time)
        position = F.when(F.col("site_id") == "error", F.lit("x_y")).otherwise(position)
    columns = {name: F.col(name) for name in CSV_FIELDS if name not in ("pass_time", "position")}
    columns |= {"pass_time": time, "position": position}
    path = f"{new_folder(spark, 'csv')}/sightings"
    named = [columns[name].cast("string").alias(CSV_FIELDS[name]) for name in layout]
    rows.select(*named).write.option("header", True).csv(path)
    return path


def csv_sightings(spark, folder):
    return read_sightings(spark, _written_csv(spark, folder, spoilt=False)).sightings


def csv_rejected(spark, folder):
    return read_sightings(spark, _written_csv(spark, folder, spoilt=True)).rejected


def csv_mixed_headers(spark, folder):
    """Two layouts, the columns of the second in the opposite order."""
    view, reverse = F.col("site_id") == "view", tuple(CSV_FIELDS)[::-1]
    one = _written_csv(spark, folder, False, ~view)
    return read_sightings(spark, one, _written_csv(spark, folder, False, view, reverse)).sightings


def table_sightings(spark, folder):
    """The same through a table of text columns."""
    raw = spark.read.option("header", True).csv(_written_csv(spark, folder, spoilt=False))
    raw.createOrReplaceTempView("sighting_texts")
    return read_sighting_table(spark, "sighting_texts").sightings


def first_entry_without_positions(spark, folder):
    """A known plate stays known where its position cannot be read."""
    rows = read_sightings(spark, _written_csv(spark, folder, spoilt=True), needs=HISTORY_NEEDS).sightings
    return analyses.first_entries(rows, _history(rows)).select(*ALERT_FIELDS)


def cotravel_without_positions(spark, folder):
    rows = read_sightings(spark, _written_csv(spark, folder, spoilt=True), needs=COTRAVEL_NEEDS).sightings
    return _gram_text(cotravel.cotravel_members(rows))


QUERIES = {
    q.__name__: q
    for q in (
        sightings_since,
        sightings_since_sql,
        stored_sightings_since,
        plate_trail,
        plate_trail_parts,
        plate_trail_parts_heavy,
        plate_trail_daily,
        site_sequences,
        site_sequences_of_five,
        site_sequences_heavy,
        clone_plate_pairs,
        clone_plate_pairs_since,
        clone_plate_pairs_clock12,
        clone_plate_pairs_simultaneous,
        clone_plate_pairs_same_hour,
        clone_plate_pairs_heavy,
        clone_plate_pairs_outlier,
        clone_plate_pairs_daily,
        clone_plate_adjacent,
        leg_speeds,
        leg_speeds_clock12,
        clone_plate_report,
        clone_report_adjacent,
        clone_report_all_pairs,
        clone_watchlist,
        clone_watchlist_at_limit,
        clone_watchlist_heavy,
        cotravel_members,
        cotravel_members_heavy,
        cotravel_groups,
        cotravel_groups_daily,
        cotravel_groups_self,
        cotravel_groups_self_wide,
        cotravel_groups_parts,
        cotravel_all,
        cotravel_all_of_five,
        cotravel_pairs,
        cotravel_result,
        first_entry,
        first_entry_stored,
        stored_lookup,
        seen_before,
        seen_before_counted,
        seen_before_repeated,
        watchlist_alerts,
        watchlist_alerts_stream,
        watchlist_alerts_refreshed,
        watchlist_alerts_as_of,
        watchlist_alerts_two_streams,
        watchlist_alerts_restarted,
        first_entry_stream,
        seen_before_stream,
        seen_before_repeated_stream,
        seen_before_bucketed,
        first_entry_stream_once,
        message_alerts_stream,
        message_alerts_bad_time,
        decode_messages,
        publish_sightings,
        dead_letters,
        dead_entries,
        last_offset,
        csv_sightings,
        csv_rejected,
        csv_mixed_headers,
        table_sightings,
        first_entry_without_positions,
        cotravel_without_positions,
    )
}
