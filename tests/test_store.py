import pytest
from pyspark.sql import functions as F

from platewatch.model import SIGHTING
from platewatch.sinks.alerts import ParquetAlerts
from platewatch.sources.messages import dead_entries, decode_messages
from platewatch.sources.store import append_to_store, look_up, read_store, stored_days

FIELDS = ", ".join(f"{n} {'string' if n == 'pass_time' else k}" for n, k in SIGHTING.items())
TIMES = ["2024-01-01 23:59:59", "2024-01-02 00:00:00", "2024-01-02 12:00:00", "2024-01-03 00:00:00", None]


@pytest.fixture
def store(spark, tmp_path):
    rows = [(str(i), "A", None, "", t, "k", None, None) for i, t in enumerate(TIMES)]
    frame = spark.createDataFrame(rows, FIELDS).withColumn("pass_time", F.col("pass_time").cast("timestamp_ntz"))
    append_to_store(frame.withColumn("Day", F.lit("a clashing name")), str(tmp_path / "store"))
    return str(tmp_path / "store")


def ids(frame):
    return sorted(r.id for r in frame.collect())


def test_whole_store_keeps_every_row(spark, store):
    rows = read_store(spark, store)
    assert ids(rows) == ["0", "1", "2", "3", "4"]
    assert rows.columns == list(SIGHTING)


@pytest.mark.parametrize(
    "since, until, expected",
    [
        ("2024-01-01 23:59:59", None, ["1", "2", "3"]),
        ("2024-01-02 00:00:00", "2024-01-03 00:00:00", ["2"]),
        (None, "2024-01-02 00:00:00", ["0"]),
        ("2024-02-01 00:00:00", None, []),
    ],
)
def test_time_range_is_open(spark, store, since, until, expected):
    assert ids(read_store(spark, store, since, until)) == expected


def test_range_prunes_days_and_reaches_the_scan(spark, store):
    rows = read_store(spark, store, "2024-01-02 06:00:00", "2024-01-02 18:00:00").select("plate")
    plan = rows._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    days = next(line for line in plan.splitlines() if line.startswith("PartitionFilters"))
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert "day" in days and ">=" in days and "<=" in days
    assert "GreaterThan(pass_time" in pushed and "LessThan(pass_time" in pushed


def test_append_adds_and_an_empty_store_has_no_rows(spark, store, tmp_path):
    append_to_store(read_store(spark, store, "2024-01-02 06:00:00"), store)
    assert ids(read_store(spark, store)) == ["0", "1", "2", "2", "3", "3", "4"]
    append_to_store(read_store(spark, store).where("false"), str(tmp_path / "none"))
    assert ids(read_store(spark, str(tmp_path / "none"))) == []


def test_a_named_batch_replaces_itself(spark, tmp_path):
    rows = [(str(i), "A", None, "", t, "k", None, None) for i, t in enumerate(TIMES)]
    frame = spark.createDataFrame(rows, FIELDS).withColumn("pass_time", F.col("pass_time").cast("timestamp_ntz"))
    path = str(tmp_path / "store")
    append_to_store(frame, path, "one")
    append_to_store(frame.where("id < 3"), path, "two")
    append_to_store(frame, path, "one")
    assert ids(read_store(spark, path)) == ["0", "0", "1", "1", "2", "2", "3", "4"]
    assert [str(d) for d in stored_days(spark, path, "two")] == ["2024-01-01", "2024-01-02"]


def test_alert_table_before_its_first_batch(spark, tmp_path):
    rows = ParquetAlerts(str(tmp_path / "none")).read(spark)
    assert rows.count() == 0 and {"id", "plate", "pass_time", "copy"} <= set(rows.columns)


GOOD = '{"HPHM":"A","TGSJ":"2024-01-01 10:00:00"}'


@pytest.mark.parametrize(
    "text",
    [f"[{GOOD}] junk", f"[{GOOD}],[{GOOD}]", f"[{GOOD}] [{GOOD}]", f"[{GOOD}]] ]", f"[{GOOD}],[]] ]", "{}", "bad", "", None, f"[{GOOD}, 7]"],
)
def test_message_has_to_be_one_array(spark, text):
    messages = spark.createDataFrame([(text,)], "value string")
    read = decode_messages(messages)
    assert [r.value for r in read.dead_letters.collect()] == [text]
    assert read.sightings.count() == 0 and dead_entries(messages).count() == 0


@pytest.mark.parametrize(
    "entry, reason",
    [
        ("null", "plate"),
        ('{"TGSJ":"2024-01-01 10:00:00"}', "plate"),
        ('{"HPHM":" ","TGSJ":"2024-01-01 10:00:00"}', "plate"),
        ('{"HPHM":{"x":1},"TGSJ":"2024-01-01 10:00:00"}', "plate"),
        ('{"HPHM":"B","TGSJ":"2024-13-01 10:00:00"}', "time"),
        ('{"HPHM":"B"}', "time"),
    ],
)
def test_entry_without_plate_or_time_is_set_aside(spark, entry, reason):
    messages = spark.createDataFrame([(f" [{GOOD}, {entry}] ",)], "value string")
    read = decode_messages(messages)
    assert [r.plate for r in read.sightings.collect()] == ["A"]
    (dead,) = dead_entries(messages).collect()
    assert dead.reason == reason and dead.id.endswith("-1")
    if "2024-13" in entry:
        assert dead.time_text == "2024-13-01 10:00:00" and '"HPHM":"B"' in dead.entry
    assert read.dead_letters.count() == 0


def test_a_lookup_skips_row_groups_that_cannot_hold_the_value(spark, tmp_path):
    rows = spark.range(40_000).select(
        F.concat(F.lit("id"), F.crc32(F.col("id").cast("string"))).alias("id"), F.concat(F.lit("p"), F.col("id") % 5000).alias("plate"),
        F.lit(None).cast("string").alias("brand"), F.lit("").alias("colour"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("pass_time"),
        F.lit("k").alias("site_id"), F.lit(1.0).alias("lon"), F.lit(2.0).alias("lat"))
    path = str(tmp_path / "store")
    # So many files as the table has stretches of time, though it is small.
    usual = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in usual}
    try:
        for key, value in usual.items():
            spark.conf.set(key, value)
        append_to_store(rows, path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    sought = [r.id for r in rows.limit(3).collect()]
    found = look_up(spark, path, sought)
    assert ids(found) == sorted(sought)
    plan = found._jdf.queryExecution().executedPlan()
    scans = plan.collectLeaves()
    read = sum(scans.apply(i).metrics().apply("numOutputRows").value() for i in range(scans.length()))
    # Ids are in no order, so least and largest values rule nothing out: the filters do.
    assert 0 < read < 20_000
    assert look_up(spark, path, []).count() == 0
    many = [r.plate for r in rows.select("plate").distinct().limit(25).collect()]
    assert look_up(spark, path, many, "plate").count() == 25 * 8
    with pytest.raises(ValueError):
        look_up(spark, path, ["x"], "brand")
