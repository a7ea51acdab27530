"""Two-pass external shuffle into shards.

The first pass scatters records over buckets of a size that memory holds, by a seeded hash.  The
second shuffles each bucket by Fisher and Yates and writes it.  Buckets follow each other
in the global order; shards are equal runs of that order, so their counts differ by one at most.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from platewatch.llm.common import free_name, stored
from platewatch.session import new_folder

SHARDS = 24
BUCKET_BYTES = 16 << 20
SEED = 11


def record_size(text: str = "text"):
    """UTF-8 bytes of the text (null: none) and 8 for the id."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def write_shards(
    docs: DataFrame, folder: str, shards: int = SHARDS, bucket_bytes: int = BUCKET_BYTES, seed: int = SEED
) -> DataFrame:
    """Write all rows, shuffled, as Parquet under ``folder``, a folder per shard; return them as read back.

    The columns shard and slot (from 0 in each shard) are added; names that are taken get a
    trailing underscore.  Rows are never merged or left out: nulls, empty texts and repeated
    rows are records like any other.  The order follows from seed, ids and texts alone; rows
    that are equal in both may change places.  Equal rows that fill a quarter of a bucket are numbered and
    scattered like different ones.  An empty table gives no rows.
    """
    shard, slot = free_name(docs, "shard"), free_name(docs, "slot")
    key, bucket, start = (free_name(docs, c) for c in ("_key", "_bucket", "_start"))
    keyed = docs.withColumn(key, F.xxhash64(F.lit(seed), "doc_id", "text"))
    total, size = docs.agg(F.count("*"), F.coalesce(F.sum(record_size()), F.lit(0))).first()
    buckets = max(1, -(-int(size) // bucket_bytes))
    if buckets > 1:
        keyed = _scattered(keyed, key, bucket_bytes)
    placed = keyed.withColumn(bucket, F.pmod(F.col(key), F.lit(buckets)))
    counts = placed.groupBy(bucket).agg(F.count("*").alias("n"))
    # One row per bucket: a small table for one window, however long the records.
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(bucket, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(start))
    schema = StructType([*docs.schema.fields, StructField(shard, IntegerType()), StructField(slot, LongType())])
    names = docs.columns

    def shuffled(records: pa.Table) -> pa.Table:
        records = records.combine_chunks()
        # Shuffle blocks arrive in any order: begin from one that does not depend on it.
        first = pc.sort_indices(records, sort_keys=[(key, "ascending")]).to_numpy()
        number, offset = records[bucket][0].as_py(), records[start][0].as_py()
        order = first.copy()
        np.random.default_rng([seed, number]).shuffle(order)  # Fisher-Yates
        place = np.arange(offset, offset + len(order), dtype=np.int64)
        to = place * shards // total
        begins = -(-to * total // shards)
        out = records.select(names).take(pa.array(order))
        return out.append_column(shard, pa.array(to.astype(np.int32))).append_column(slot, pa.array(place - begins))

    rows = placed.join(starts, bucket).groupBy(bucket).applyInArrow(shuffled, schema)
    rows.sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(folder)
    return docs.sparkSession.read.schema(schema).parquet(folder)


def _scattered(keyed, key, bucket_bytes):
    """The rows with a key of their own each where rows of one key would fill a quarter of a bucket.

    Such rows are numbered, in pieces that a task holds, so the same numbers are given however they lie.
    """
    piece, start, number = (free_name(keyed, c) for c in ("_piece", "_before", "_number"))
    # Fewer than four keys for each bucket can be as large as this.
    large = keyed.groupBy(key).agg(F.sum(record_size()).alias("size")).where(F.col("size") * 4 > bucket_bytes)
    large = stored(large.select(key, F.ceil(F.col("size") / bucket_bytes).alias(piece)), "large-keys")
    if large.isEmpty():
        return keyed
    lie = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col(piece))
    copies = stored(keyed.join(large, key).withColumn(piece, lie), "copies")
    before = Window.partitionBy(key).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    starts = copies.groupBy(key, piece).agg(F.count("*").alias("n"))
    starts = starts.select(key, piece, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(start))
    inside = Window.partitionBy(key, piece).orderBy(F.lit(0))
    numbered = copies.join(starts, [key, piece]).withColumn(number, F.col(start) + F.row_number().over(inside))
    own = numbered.withColumn(key, F.xxhash64(key, number)).select(*keyed.columns)
    return keyed.join(large.select(key), key, "left_anti").select(*keyed.columns).unionByName(own)


def sharded(docs: DataFrame, **rule) -> DataFrame:
    """``write_shards`` into a fresh folder of the shared place."""
    return write_shards(docs, new_folder(docs.sparkSession, "shards"), **rule)
