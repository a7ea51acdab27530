from collections import Counter, defaultdict

from pyspark.sql import functions as F

from platewatch.llm import queries, sharding
from tests.llm.cases import LONG, ROWS, awkward, nothing


def test_law_slots_and_whole_rows(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op9_sharding"](spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((d["doc_id"], len(d["text"].encode()) + 8) for d in docs)
    shards = defaultdict(list)
    for r in rows:
        shards[r["shard"]].append(r["slot"])
    assert set(shards) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1


def test_many_buckets_give_a_repeatable_random_order(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    runs = []
    for parts in (2, 7):
        rows = sharding.sharded(docs.repartition(parts), shards=3, bucket_bytes=20_000).collect()
        runs.append([r["doc_id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))])
    assert runs[0] == runs[1] and sorted(runs[0]) != runs[0]
    other = sharding.sharded(docs, shards=3, bucket_bytes=20_000, seed=12).collect()
    assert [r["doc_id"] for r in sorted(other, key=lambda r: (r["shard"], r["slot"]))] != runs[0]


def test_equal_rows_are_scattered_over_buckets(spark):
    """A third of all rows are one; no bucket is much larger than the others, and the order is repeatable."""
    docs = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "the same text").otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"),
        F.lit("taken").alias("_piece"),
    )
    keyed = docs.withColumn("_key", F.xxhash64(F.lit(1), "doc_id", "text"))
    buckets = sharding._scattered(keyed, "_key", 2000).groupBy(F.pmod("_key", F.lit(30)).alias("b")).count()
    assert buckets.agg(F.max("count")).first()[0] <= 200
    runs = []
    for parts in (2, 7):
        rows = sharding.sharded(docs.repartition(parts), shards=3, bucket_bytes=2000).collect()
        runs.append([r["doc_id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))])
    assert runs[0] == runs[1] and Counter(runs[0])[-1] == 1000 and len(runs[0]) == 3000
    third = [sum(d == -1 for d in runs[0][i : i + 1000]) for i in (0, 1000, 2000)]
    assert min(third) > 200


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = sharding.sharded(docs, shards=4, bucket_bytes=100)
    assert rows.columns[: len(docs.columns)] == docs.columns or set(docs.columns) < set(rows.columns)
    got = rows.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(r[:2] for r in ROWS)
    assert {r["slot"] for r in got} == {"y"} and all(r["_key"] == {"k": 1} for r in got)
    assert sorted(Counter(r["shard_"] for r in got).values()) == [2, 3, 3, 3]
    assert max(len(r["text"] or "") for r in got) == len(LONG)
    assert sharding.sharded(nothing(spark)).count() == 0
