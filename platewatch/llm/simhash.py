"""Near-duplicate documents by SimHash fingerprints and multi-index hashing.

A fingerprint is cut into segments.  Two fingerprints within the distance agree to one bit in at
least one segment, so every fingerprint looks up the ball of one bit around each of its
segments in a table of all segments; the whole distance is verified on what is found.  Equal
fingerprints are one entry throughout, so groups of copies do not meet in pairs.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from platewatch.llm.common import free_name, row_keys, stored
from platewatch.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42

_PLACE = np.arange(8) * 256
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64 bits set in over half of the shingles' hashes; 0 without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    width = min(shingle_words, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(line[s:e], SEED) for s, e in spans]), np.uint8)
    # How often each byte value stands at each of the eight places of a hash.
    counts = np.bincount((hashes.reshape(-1, 8) + _PLACE).ravel(), minlength=2048).reshape(8, 256)
    bits = (counts @ _BITS).ravel() * 2 > len(hashes) // 8
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def fingerprint_column(text, shingle_words: int = SHINGLE_WORDS):
    """The fingerprint of a text column as a long with the same bits."""

    @F.arrow_udf("long")
    def prints(texts: pa.Array) -> pa.Array:
        found = [fingerprint(t, shingle_words) for t in texts.to_pylist()]
        return pa.array(np.array(found, np.uint64).view(np.int64))

    return prints(text)


def near_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (fp_a < fp_b, distance) of the distinct ``fp`` values within ``max_bits`` bits."""
    count = max_bits // 2 + 1
    edges = [64 * i // count for i in range(count + 1)]

    def segment(i):
        width = edges[i + 1] - edges[i]
        part = F.shiftrightunsigned("fp", 64 - edges[i + 1])
        return part if width == 64 else part.bitwiseAND(F.lit((1 << width) - 1))

    def ball(i):
        # Of two values one bit apart one has an odd number of bits: that one does the looking.
        width, value = edges[i + 1] - edges[i], segment(i)
        flips = [value.bitwiseXOR(F.lit(_signed(1 << b))) for b in range(width)]
        odd = F.bit_count(value) % 2 == 1
        return F.when(odd, F.array(value, *flips)).otherwise(F.array(value))

    rows = prints.select("fp")
    entries = rows.select(
        F.explode(F.array(*[F.struct(F.lit(i).alias("seg"), segment(i).alias("key")) for i in range(count)])).alias("e"),
        F.col("fp").alias("fp_b"),
    ).select("e.seg", "e.key", "fp_b")
    balls = F.array(*[F.struct(F.lit(i).alias("seg"), ball(i).alias("keys")) for i in range(count)])
    probes = (
        rows.select(F.explode(balls).alias("e"), F.col("fp").alias("fp_a"))
        .select("e.seg", F.explode("e.keys").alias("key"), "fp_a")
    )
    distance = F.bit_count(F.col("fp_a").bitwiseXOR(F.col("fp_b")))
    # The planner takes no account of how long the exploded lists are: without the hint it may broadcast them.
    return (
        probes.hint("merge").join(entries, ["seg", "key"])
        .where((F.col("fp_a") != F.col("fp_b")) & (distance <= max_bits))
        .select(F.least("fp_a", "fp_b").alias("fp_a"), F.greatest("fp_a", "fp_b").alias("fp_b"), distance.alias("distance"))
        .distinct()
    )


def _signed(number):
    return number - (1 << 64) if number >= 1 << 63 else number


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex digits), component_id, fp, row keys.

    ``component_id`` is the smallest id reachable over links of ``max_bits`` bits or
    fewer.  Texts without words, and null texts, have the fingerprint 0 and link like any other.
    Documents without id count as members; a component of such documents only has a
    null ``component_id``.  Repeated rows stay rows.  No documents give no rows.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), *[c.alias(n) for n, c in row_keys(doc_id, text).items()],
        fingerprint_column(F.col(text), shingle_words).alias("fp"),
    )
    rows = stored(rows, "fingerprints")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "prints")
    tree = components(near_links(prints, max_bits), "fp_a", "fp_b")
    rooted = prints.join(tree.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    rooted = stored(rooted, "rooted")
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(smallest, "root").select("fp", "root", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(classes, "fp").withColumn("fingerprint", hexed)


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **rule) -> DataFrame:
    """The documents with one row left of every component, all columns as they are.

    The smallest id stays, ties by the hash of the text; among wholly repeated rows any one.
    Where no member has an id, the text with the smallest hash stays.
    """
    keys = list(row_keys(doc_id, text))
    members = near_duplicates(docs, text, doc_id, **rule)
    chosen = members.groupBy("root").agg(F.min(F.struct(*keys)).alias("key")).select("key.*")
    own = {k: free_name(docs, k) for k in keys}
    rows = docs.withColumns({own[k]: c for k, c in row_keys(doc_id, text).items()})
    kept = rows.join(chosen.toDF(*[own[k] for k in keys]), list(own.values()))
    # The join has sorted by these keys: numbering repeats costs no further shuffle.
    turn = free_name(docs, "_turn")
    repeats = Window.partitionBy(*own.values()).orderBy(F.lit(1))
    return kept.withColumn(turn, F.row_number().over(repeats)).where(F.col(turn) == 1).select(*docs.columns)
