import math

import pytest
from pyspark.sql import functions as F

from platewatch.llm import mixing, queries
from tests.llm.cases import ROWS, awkward, nothing
from tests.oracle_check import database, difference


def sources(spark, tokens):
    return spark.createDataFrame([(f"+{i}", t) for i, t in enumerate(tokens)], "_source string, tokens bigint")


def test_power_for_a_repetition_limit(spark):
    found = mixing.find_power(sources(spark, [1000, 10, 100]), repeat_limit=2.0)
    exact = 1 - math.log(2) / math.log(100)
    assert exact <= found <= exact + 2 / (1 << mixing.LEVELS)
    assert mixing.find_power(sources(spark, [5, 5]), repeat_limit=1.0) == 0
    assert mixing.find_power(sources(spark, [5, 50]), repeat_limit=1.0) == 1


def entropy(tokens, power):
    weights = [t**power for t in tokens]
    return -sum(w / sum(weights) * math.log(w / sum(weights)) for w in weights)


def test_power_for_an_entropy(spark):
    tokens = [1000, 10, 100, 7]
    table = sources(spark, tokens)
    found = mixing.find_power(table, entropy=1.2, repeat_limit=None)
    assert entropy(tokens, found) >= 1.2 > entropy(tokens, found + 4 / (1 << mixing.LEVELS))
    assert mixing.find_power(table, entropy=0.0) == 1 and mixing.find_power(table, entropy=9.0) == 0


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_rows_against_sql(spark, scale):
    folder = f"/root/testdata/{scale}"
    got = queries.QUERIES["op4_mixing"](spark, folder).toPandas()
    assert difference(got, database(folder).execute(mixing.ORACLE).df()) is None


def test_blocks_hold_sources_in_proportion(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.when(F.col("id") < 2000, "big").otherwise("small").alias("source")
    )
    rows = mixing.mixed(docs, block_tokens=2000, repeat_limit=1.5).collect()
    drawn = [(r["source"], r["doc_id"]) for r in rows]
    assert set(drawn) == {(r["source"], r["doc_id"]) for r in docs.collect()}
    assert sum(s == "small" for s, _ in drawn) == pytest.approx(1500, abs=2)
    for b in {r["block"] for r in rows}:
        own = [r for r in rows if r["block"] == b]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert sum(r["source"] == "big" for r in own) / len(own) == pytest.approx(2000 / 3500, abs=0.02)


def test_a_budget_cuts_and_repeats(spark):
    docs = awkward(spark, [(i, "w w w", "en", "a" if i < 90 else "b", 5) for i in range(100)])
    rows = mixing.mixed(docs, budget_tokens=200, repeat_limit=3.0)
    assert rows.agg(F.sum("n_tokens")).first()[0] == pytest.approx(200, abs=8)


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = mixing.mixed(docs)
    assert rows.columns == [*docs.columns, "epoch_", "block", "slot_", "n_tokens"]
    first = [(r["doc_id"], r["text"]) for r in rows.collect() if r["epoch_"] == 0]
    assert sorted(first, key=str) == sorted([r[:2] for r in ROWS], key=str)
    assert mixing.mixed(nothing(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    rows = mixing.mixed(awkward(spark))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_pieces_follow_the_largest_source_and_change_nothing(spark, monkeypatch):
    assert [mixing.piece_digits(t) for t in (0, 4_000_000 * 16**3, 4_000_000 * 16**3 + 1, 10**30)] == [3, 3, 4, 8]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted(map(str, mixing.mixed(docs, columns=["doc_id"]).collect()))
    monkeypatch.setattr(mixing, "LEAST_DIGITS", 1)
    assert sorted(map(str, mixing.mixed(docs, columns=["doc_id"]).collect())) == rows
    monkeypatch.setattr(mixing, "PIECE_TOKENS", 1)
    assert sorted(map(str, mixing.mixed(docs, columns=["doc_id"]).collect())) == rows


def test_texts_join_the_places_of_their_own_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("_row", F.concat(F.lit("x"), "doc_id"))
    docs = docs.unionByName(docs.where("doc_id % 7 = 0"))
    rows = mixing.mixed(docs)
    places = ["doc_id", "epoch", "block", "slot", "n_tokens"]
    light = mixing.mixed(docs, columns=["doc_id"]).select(places)
    assert sorted(map(str, rows.select(places).collect())) == sorted(map(str, light.collect()))
    own = {r["doc_id"]: tuple(r) for r in docs.collect()}
    assert all(tuple(r) == own[r["doc_id"]] for r in rows.select(docs.columns).collect())


def test_texts_stay_out_of_the_windows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = mixing.mixed(docs)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line]
    assert windows and not any("text#" in line for line in windows)
    scans = [line for line in plan.splitlines() if line.lstrip(":+- ").startswith("Relation")]
    assert sum("text#" in line for line in scans) >= 1
