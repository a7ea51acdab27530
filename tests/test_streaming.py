import json

import pytest
from pyspark.sql import functions as F

from platewatch.operators import membership
from platewatch.sinks.alerts import ParquetAlerts, alert_key, alert_rows, missing_rows
from platewatch.sinks.messages import encode_messages, publish_to_files
from platewatch.sources.kafka import read_message_files
from platewatch.sources.messages import decode_messages
from platewatch.sources.versions import PlateVersions
from platewatch.streaming.alerts import (
    start_dead_letters,
    start_first_entry,
    start_first_entry_once,
    start_seen_before,
    start_versioned_alerts,
    start_watchlist_alerts,
)
from tests.fixtures import at, plain, sightings

ONCE = {"availableNow": True}


def message(*plates):
    return json.dumps(
        [
            {"HPHM": p, "CLPP": "b", "CLYS": "c", "TGSJ": "2024-01-01 10:00:00", "KKBH": f"k{i}"}
            for i, p in enumerate(plates)
        ]
    )


def send(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


@pytest.fixture
def known(spark):
    return spark.createDataFrame([("A",), ("B",), ("B",)], "plate string")


def plates(frame):
    return sorted(r.plate for r in frame.collect())


@pytest.mark.parametrize(
    "start, options, expected",
    [
        (start_watchlist_alerts, {}, ["A", "B"]),
        (start_seen_before, {}, ["A", "B"]),
        (start_seen_before, {"repeated": True}, ["A", "B", "B"]),
        (start_first_entry, {}, ["Z", "Z"]),
        (start_first_entry, {"refresh_plates": True}, ["Z", "Z"]),
    ],
)
def test_streams_from_messages(spark, tmp_path, known, start, options, expected):
    send(tmp_path / "in", "1.json", message("A", "Z"), "bad", message("B", "Z"))
    stream = decode_messages(read_message_files(spark, str(tmp_path / "in"))).sightings
    target = ParquetAlerts(str(tmp_path / "out"))
    start(stream, lambda: known, target, str(tmp_path / "cp"), trigger=ONCE, **options).awaitTermination()
    assert plates(target.read(spark)) == expected


def test_a_restarted_stream_goes_on_where_it_was(spark, tmp_path, known):
    target = ParquetAlerts(str(tmp_path / "out"))

    def run():
        stream = decode_messages(read_message_files(spark, str(tmp_path / "in"))).sightings
        start_watchlist_alerts(stream, lambda: known, target, str(tmp_path / "cp"), trigger=ONCE).awaitTermination()

    send(tmp_path / "in", "1.json", message("A", "Z"))
    run()
    run()
    send(tmp_path / "in", "2.json", message("B", "Z"))
    run()
    assert plates(target.read(spark)) == ["A", "B"]


def test_refreshed_plates_are_seen_by_later_batches(spark, tmp_path):
    send(tmp_path / "in", "1.json", message("A"))
    send(tmp_path / "in", "2.json", message("A"))
    files = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(str(tmp_path / "in"))
    loads = []

    def load():
        loads.append(1)
        return spark.createDataFrame([("A",)] if len(loads) > 1 else [("Q",)], "plate string")

    for refresh, alerts in ((True, 1), (False, 0)):
        loads.clear()
        target = ParquetAlerts(str(tmp_path / f"out{refresh}"))
        start_watchlist_alerts(
            decode_messages(files).sightings,
            load,
            target,
            str(tmp_path / f"cp{refresh}"),
            trigger=ONCE,
            refresh_plates=refresh,
        ).awaitTermination()
        assert target.read(spark).count() == alerts
        assert len(loads) == (2 if refresh else 1)


def test_declared_stream_joins(spark, tmp_path, known):
    send(tmp_path / "in", "1.json", message("A", "Z", "B", "Z"))
    once, counts = membership.plate_set(known), membership.plate_counts(known)
    for i, (join, side, expected) in enumerate(
        [
            (membership.watchlist_alerts, once, ["A", "B"]),
            (membership.first_entry, once, ["Z", "Z"]),
            (membership.seen_before_repeated, counts, ["A", "B", "B"]),
        ]
    ):
        stream = decode_messages(read_message_files(spark, str(tmp_path / "in"))).sightings
        query = (
            join(stream, side)
            .writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / f"cp{i}"))
            .trigger(**ONCE)
            .start(str(tmp_path / f"out{i}"))
        )
        query.awaitTermination()
        assert plates(spark.read.parquet(str(tmp_path / f"out{i}"))) == expected


def test_dead_letters_are_kept(spark, tmp_path):
    send(tmp_path / "in", "1.json", message("A"), "bad", "{}")
    dead = decode_messages(read_message_files(spark, str(tmp_path / "in"))).dead_letters
    start_dead_letters(dead, str(tmp_path / "out"), str(tmp_path / "cp"), trigger=ONCE).awaitTermination()
    assert sorted(r.value for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["bad", "{}"]


def test_a_new_checkpoint_on_an_old_table_loses_nothing(spark, tmp_path, known):
    target = ParquetAlerts(str(tmp_path / "out"))
    for run, plate in enumerate("AB"):
        send(tmp_path / f"in{run}", "1.json", message(plate))
        stream = decode_messages(read_message_files(spark, str(tmp_path / f"in{run}"))).sightings
        start_watchlist_alerts(stream, lambda: known, target, str(tmp_path / f"cp{run}"), trigger=ONCE).awaitTermination()
    assert plates(target.read(spark)) == ["A", "B"]


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    rows = sightings(spark, [("A", "10:00:00", "k1", 1.0, 1.0), ("B", "10:00:00", "k1", 1.0, 1.0)])
    target = ParquetAlerts(str(tmp_path / "out"))
    for batch in (0, 1, 1):
        target.append(rows, batch)
    assert target.read(spark).count() == 4


def test_alert_rows_and_keys(spark):
    rows = sightings(spark, [("A", "10:00:00", "k1", 1.0, 1.0), ("B", "11:00:00", "k2", 1.0, 1.0)])
    table = alert_rows(rows, F.concat(F.lit("s-4-"), alert_key(rows)))
    assert table.columns == ["id", "hphm", "clpp", "clys", "tgsj", "kkbh", "create_time"]
    assert {f.dataType.simpleString() for f in table.schema} == {"string"}
    assert plain(table.drop("create_time"))[0] == ("s-4-1", "A", "b", "c", "2024-01-01 10:00:00", "k1")
    written = table.where("hphm = 'A'").select("id")
    assert [r.hphm for r in missing_rows(table, written).collect()] == ["B"]
    repeated = membership.seen_before_repeated(rows, spark.createDataFrame([("A", 2)], "plate string, times_seen long"))
    assert {r.k for r in repeated.select(alert_key(repeated).alias("k")).collect()} == {"1-1", "1-2"}


@pytest.mark.parametrize("copies", [1, 300])
def test_messages_hold_every_row_and_no_more_than_allowed(spark, copies):
    rows = [(f"p{i}", "10:00:00", "k1", 1.0, 1.0) for i in range(100)] + [("p", "10:00:00", "k1", 1.0, 1.0)] * copies
    frame = sightings(spark, rows).repartition(3)
    messages = encode_messages(frame, message_rows=40)
    sizes = [len(json.loads(r.value)) for r in messages.collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 40
    fields = ["plate", "brand", "colour", "pass_time", "site_id"]
    assert plain(decode_messages(messages).sightings.select(*fields)) == plain(frame.select(*fields))
    first = json.loads(messages.first().value)[0]
    assert first.keys() == {"HPHM", "CLPP", "CLYS", "TGSJ", "KKBH"}
    assert first["TGSJ"] == str(at("10:00:00"))


def test_published_files_are_read_back(spark, tmp_path):
    frame = sightings(spark, [("A", "10:00:00", "k1", 1.0, 1.0)])
    publish_to_files(frame, str(tmp_path / "topic"))
    assert [r.plate for r in decode_messages(spark.read.text(str(tmp_path / "topic"))).sightings.collect()] == ["A"]


def test_streams_share_a_table(spark, tmp_path):
    target = ParquetAlerts(str(tmp_path / "out"))
    (tmp_path / "in").mkdir()
    spark.range(3).write.mode("overwrite").parquet(str(tmp_path / "in"))
    for checkpoint in ("a", "b", "a"):
        stream = spark.readStream.schema("id bigint").parquet(str(tmp_path / "in"))
        query = (
            stream.writeStream.foreachBatch(target.append)
            .option("checkpointLocation", str(tmp_path / checkpoint))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination(60)
    rows = target.read(spark).collect()
    assert sorted(r["id"] for r in rows) == [0, 0, 1, 1, 2, 2]
    assert len({r["stream"] for r in rows}) == 2


def arrive(spark, folder, name, rows):
    """Sightings (plate, moment) as one more file of a stream."""
    frame = sightings(spark, [(p, m, "k", 1.0, 2.5) for p, m in rows])
    frame.withColumn("id", F.col("id") + F.lit(100 * name)).coalesce(1).write.mode("append").parquet(folder)
    return frame.schema


@pytest.mark.parametrize("max_broadcast", [0, 1 << 20])
def test_a_new_plate_is_reported_once_over_batches_and_restarts(spark, tmp_path, known, max_broadcast):
    folder, target = str(tmp_path / "in"), ParquetAlerts(str(tmp_path / "out"))
    parts = [
        [("Z", "10:05:00"), ("Z", "10:00:00"), ("A", "10:00:00")],
        [("Z", "11:00:00"), ("Y", "11:00:00"), ("Y", "11:00:00"), (None, "11:00:00")],
        [("Y", "9:00:00"), ("B", "9:00:00"), ("X", "9:00:00")],
    ]
    for number, part in enumerate(parts):
        schema = arrive(spark, folder, number, part)
        stream = spark.readStream.schema(schema).parquet(folder)
        start_first_entry_once(
            stream, lambda: known, target, str(tmp_path / "cp"), trigger=ONCE, max_broadcast=max_broadcast
        ).awaitTermination()
    # Of a batch the earliest, of equal times the smaller id; whole rows come back as they were.
    assert plain(target.read(spark).select("plate", "id", "pass_time", "lon", "lat")) == [
        ("X", 203, at("9:00:00"), 1.0, 2.5), ("Y", 102, at("11:00:00"), 1.0, 2.5), ("Z", 2, at("10:00:00"), 1.0, 2.5)]


def test_a_plate_not_seen_for_long_is_new_again(spark, tmp_path, known):
    folder, target = str(tmp_path / "in"), ParquetAlerts(str(tmp_path / "out"))
    for number, part in enumerate(([("Z", "10:00:00")], [("Z", "10:30:00"), ("Y", "10:30:00")], [("Y", "13:00:00")], [("Y", "13:30:00")], [("Z", "14:00:00")])):
        schema = arrive(spark, folder, number, part)
        stream = spark.readStream.schema(schema).parquet(folder)
        start_first_entry_once(stream, lambda: known, target, str(tmp_path / "cp"), forget_after_s=3600, trigger=ONCE).awaitTermination()
    found = plain(target.read(spark).select("plate", "pass_time"))
    assert found.count(("Z", at("10:00:00"))) == 1 and found.count(("Z", at("14:00:00"))) == 1
    assert ("Z", at("10:30:00")) not in found and ("Y", at("13:30:00")) not in found


def test_a_batch_that_was_not_published_shows_no_rows(spark, tmp_path, monkeypatch):
    rows = sightings(spark, [("A", "10:00:00", "k1", 1.0, 1.0), ("B", "10:00:00", "k1", 1.0, 1.0)])
    target = ParquetAlerts(str(tmp_path / "out"), stream="s")
    with monkeypatch.context() as broken:
        broken.setattr(ParquetAlerts, "_publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            target.append(rows, 0)
    assert target.read(spark).count() == 0
    target.append(rows.limit(1), 1)
    assert target.read(spark).count() == 1
    target.append(rows, 0)
    target.append(rows, 0)
    assert target.read(spark).count() == 3 and {r.batch_id for r in target.read(spark).collect()} == {0, 1}


def test_a_repeated_batch_sees_the_version_it_saw_before(spark, tmp_path, known):
    versions = PlateVersions(str(tmp_path / "list"))
    assert versions.latest(spark) == 0
    with pytest.raises(ValueError):
        versions.seen_by(spark, "s", 0)
    assert versions.publish(known.distinct()) == 1
    assert plates(versions.seen_by(spark, "s", 0)) == ["A", "B"]
    assert plates(versions.seen_by(spark, "s", 1)) == ["A", "B"]
    assert versions.publish(known.where("plate = 'A'").distinct()) == 2
    again = PlateVersions(str(tmp_path / "list"))
    assert plates(again.seen_by(spark, "s", 1)) == ["A", "B"]
    assert plates(again.seen_by(spark, "s", 2)) == plates(again.seen_by(spark, "other", 1)) == ["A"]
    assert plates(again.read(spark, 1)) == ["A", "B"]


def test_versioned_alerts_take_the_latest_list_and_fail_whole(spark, tmp_path, known):
    class Failing(ParquetAlerts):
        def append(self, alerts, batch_id):
            alerts.collect()
            raise RuntimeError("lost")

    versions, checkpoint = PlateVersions(str(tmp_path / "list")), str(tmp_path / "cp")
    versions.publish(known.distinct())
    send(tmp_path / "in", "1.json", message("A", "B", "Z"))

    def run(target):
        stream = decode_messages(read_message_files(spark, str(tmp_path / "in"))).sightings
        start_versioned_alerts(stream, membership.watchlist_alerts, versions, target, checkpoint, trigger=ONCE).awaitTermination()

    with pytest.raises(Exception, match="lost"):
        run(Failing(str(tmp_path / "out")))
    versions.publish(known.where("plate = 'B'").distinct())
    target = ParquetAlerts(str(tmp_path / "out"))
    run(target)
    assert plates(target.read(spark)) == ["A", "B"]  # the batch that failed had seen the first list
    send(tmp_path / "in", "2.json", message("A", "B"))
    run(target)
    assert plates(target.read(spark)) == ["A", "B", "B"]
