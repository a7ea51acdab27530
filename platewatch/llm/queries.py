"""The registered queries of this subpackage, and the SQL of those that have one."""

import hashlib

from pyspark.sql import functions as F

from platewatch.llm import (
    chat,
    decontaminate,
    extraction,
    minhash,
    mixing,
    nearest,
    pseudonyms,
    quality,
    repair,
    sharding,
    simhash,
    spelling,
    token_shards,
)
from platewatch.llm.common import table

# Where the public tokenizer files lie on the driver, unless a call names another file.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def op1_decontaminate(spark, folder):
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op2_extraction(spark, folder):
    return extraction.extract(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


def op3_simhash(spark, folder):
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op4_mixing(spark, folder):
    return mixing.mixed(table(spark, folder, "documents"), columns=["doc_id", "source"])


def op5_token_shards(spark, folder, vocabulary=VOCABULARY):
    return token_shards.token_shards(table(spark, folder, "documents"), vocabulary, with_ids=False)


def op6_pseudonyms(spark, folder):
    rows = pseudonyms.with_pseudonyms(table(spark, folder, "documents"))
    return rows.select("doc_id", "text", F.size("spans").alias("n_replaced"), "spans")


def op7_quality(spark, folder):
    return quality.with_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_nearest(spark, folder):
    return nearest.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_sharding(spark, folder):
    rows = sharding.sharded(table(spark, folder, "documents"))
    return rows.select(
        "doc_id",
        sharding.record_size().alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_chat(spark, folder):
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.formatted(rows.unionByName(added)))


def op11_minhash(spark, folder):
    return minhash.near_duplicates(table(spark, folder, "documents"))


def op12_repair(spark, folder):
    rows = table(spark, folder, "conversations")
    found = repair.summaries(repair.damaged(rows)).withColumnRenamed("conv_id", "found_id")
    every = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    nothing = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    columns = [F.coalesce(c, F.lit(nothing.get(c, 0))).alias(c) for c in found.columns[1:]]
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left").select("conv_id", *columns)


def op13_spelling(spark, folder):
    rows = spelling.runs(table(spark, folder, "documents"), min_length=spelling.MIN_LENGTH)
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run")
    marked = rows.select("run", F.crc32(F.encode(name, "UTF-8")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = marked.select(F.when(F.col("h") % 31 == 0, less).otherwise(F.col("run")).alias("word"))
    return spelling.spelling_groups(spelling.counted(words))


_OWN = (
    op1_decontaminate, op2_extraction, op3_simhash, op4_mixing, op5_token_shards, op6_pseudonyms, op7_quality,
    op8_nearest, op9_sharding, op10_chat, op11_minhash, op12_repair, op13_spelling,
)
QUERIES = {f.__name__: f for f in _OWN}
ORACLE = {"op4_mixing": mixing.ORACLE}
