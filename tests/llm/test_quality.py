import numpy as np
from pyspark.sql import functions as F

from platewatch.llm import quality
from tests.llm.cases import LONG, ROWS, awkward, nothing


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.with_quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 80
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95
    good = [r["predicted"] for r in rows if r["quality"] == 1]
    assert np.mean(good) > 0.97


def test_accuracy_by_class_where_there_are_thousands_of_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.with_quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    by = {q: np.mean([r["predicted"] == q for r in rows if r["quality"] == q]) for q in (0, 1)}
    assert by[1] > 0.97 and by[0] >= 0.78, by


def test_held_out_labels_and_other_columns_are_never_used(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    stripped = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("yy")})
    one, other = quality.fit(docs, labels), quality.fit(stripped, turned)
    assert (one.weights == other.weights).all() and one.bias == other.bias


def test_features_of_parts_do_not_depend_on_their_neighbours():
    texts = ["some words", "", None, "é", LONG[:5000], " \n"]
    alone = [sorted(ids.tolist()) for t in texts for _, ids, _ in quality.chunks([t])]
    (at, ids, owner), = quality.chunks(texts)
    assert [sorted(ids[owner == i].tolist()) for i in at] == alone
    assert alone[1] == alone[2] == alone[5] == []


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1), (5, 0), (5, 0), (9, None), (None, 1), (77, 0)], "doc_id bigint, quality int")
    rows = quality.with_quality(awkward(spark), labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["held_out"] for r in rows if r["doc_id"] is None} == {False}
    assert quality.with_quality(nothing(spark), labels).count() == 0
    none = quality.with_quality(awkward(spark), labels.where("false")).collect()
    assert {(r["score"], r["predicted"]) for r in none} == {(0.5, 1)}
    kept = quality.keep_good(awkward(spark), labels.where("false"))
    assert kept.columns == awkward(spark).columns and kept.count() == len(ROWS)
