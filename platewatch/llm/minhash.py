"""Near-duplicate documents by b-bit MinHash, every link confirmed on full shingle sets.

A set of word shingles gives ``HASHES`` minima.  Bands of whole minima are the candidate keys; of each
minimum only the low ``BITS`` bits are kept, packed into a few words, and the similarity
of a pair is estimated from the number of equal places, corrected for those that agree by chance.
Pairs whose estimate is not hopelessly low are confirmed by the intersection of the full sets.

Equal sets are one node throughout.  A bucket's members do not meet in pairs.  Each node is first compared
with the most central member, the lead, of its buckets.  Nodes that this leaves apart from a bucket's lead
meet all that the lead has in its buckets, in blocks of bounded size whose task compares signatures, then full
sets, and puts out only links that join something.  That loses no link and lists no pairs.
"""

from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewatch.llm.common import row_keys, stored
from platewatch.llm.components import components

SHINGLE_WORDS = 2
PERCENT = 80
BITS = 4
BAND_ROWS = 4
BANDS = 32
HASHES = BANDS * BAND_ROWS
SEED = 11
# Chance that the estimate of a pair right at the threshold falls below the cut.
LOSS = 1e-6
# Nodes of a group that one task compares with as many others.
BLOCK = 512

_PACKED = HASHES * BITS // 64
_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIXERS = np.random.default_rng(SEED + 1).integers(0, 1 << 63, (BANDS, BAND_ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CELLS = 1 << 18  # of the table of products held at once


def shingles(text: str | None, width: int = SHINGLE_WORDS) -> set[bytes]:
    """Distinct runs of ``width`` words with A-Z in lower case; all words as one where there are fewer."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return set()
    return {b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def hashed(found: set[bytes]) -> np.ndarray:
    """The hashes of a set of shingles in rising order."""
    digest = xxhash.xxh64_intdigest
    return np.sort(np.fromiter((digest(s, SEED) for s in found), np.uint64, len(found)))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least of every hash function over a set that is not empty."""
    least = np.full(HASHES, (1 << 64) - 1, np.uint64)
    step = max(1, _CELLS // HASHES)
    for begin in range(0, len(hashes), step):
        np.minimum(least, (_FACTORS[:, None] * hashes[None, begin : begin + step]).min(1), out=least)
    return least


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima's upper halves, side by side in 64-bit words."""
    low = (least >> np.uint64(32)) & np.uint64((1 << BITS) - 1)
    places = np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)
    return (low.reshape(_PACKED, -1) << places).sum(1, dtype=np.uint64)


def band_keys(least: np.ndarray) -> np.ndarray:
    """One number for each band's whole minima."""
    mixed = (least.reshape(BANDS, BAND_ROWS) ^ _MIXERS) * _MIXERS
    mixed = (mixed ^ mixed >> np.uint64(29)) * _MIXERS
    total = mixed.sum(1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return total ^ total >> np.uint64(32)


_SIGNED = pa.struct([("n", pa.int64()), ("set_key", pa.binary()), ("low", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64()))])


def signature_column(text, width: int = SHINGLE_WORDS):
    """n (size of the set), set_key, low (packed bits), bands; all but n null for an empty set."""

    @F.arrow_udf("struct<n:bigint,set_key:binary,low:array<bigint>,bands:array<bigint>>")
    def signed(texts: pa.Array) -> pa.Array:
        sizes, keys, low, bands = [], [], [], []
        for scalar in texts:
            found = shingles(scalar.as_py(), width)
            sizes.append(len(found))
            if not found:
                for column in (keys, low, bands):
                    column.append(None)
                continue
            hashes = hashed(found)
            least = minima(hashes)
            keys.append(xxhash.xxh3_128_digest(hashes.tobytes()))
            low.append(packed(least).view(np.int64))
            bands.append(band_keys(least).view(np.int64))
        columns = [pa.array(v, f.type) for v, f in zip((sizes, keys, low, bands), _SIGNED)]
        return pa.StructArray.from_arrays(columns, fields=list(_SIGNED))

    return signed(text)


def shingle_column(text, width: int = SHINGLE_WORDS):
    """All hashes of a text's shingles."""

    @F.arrow_udf("array<bigint>")
    def whole(texts: pa.Array) -> pa.Array:
        return pa.array([hashed(shingles(t.as_py(), width)).view(np.int64) for t in texts], pa.list_(pa.int64()))

    return whole(text)


def least_matches(percent: int = PERCENT) -> int:
    """Equal places below which a pair at the threshold falls with a chance of at most ``LOSS``."""
    chance = 2.0**-BITS + (1 - 2.0**-BITS) * percent / 100
    below = 0.0
    for m in range(HASHES + 1):
        below += comb(HASHES, m) * chance**m * (1 - chance) ** (HASHES - m)
        if below > LOSS:
            return m
    return HASHES


def matches(a, b):
    """Number of equal places of two packed signatures (array columns), by bit counts."""
    total = F.lit(0)
    for i in range(_PACKED):
        differ, width = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i))), 1
        while width < BITS:
            differ = differ.bitwiseOR(F.shiftrightunsigned(differ, width))
            width *= 2
        lowest = sum(1 << j for j in range(0, 64, BITS))
        total += F.bit_count(differ.bitwiseAND(F.lit(lowest - (1 << 64) if lowest >> 63 else lowest)))
    return F.lit(HASHES) - total


def similarity(count):
    """Estimated similarity of a pair with ``count`` equal places, corrected for chance agreement."""
    chance = 2.0**-BITS
    return (count / HASHES - chance) / (1 - chance)


def _alike(a, b, n_a, n_b, percent):
    """Neither the sizes nor the estimate rule the link out."""
    sizes = 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)
    return sizes & (similarity(matches(a, b)) >= similarity(F.lit(least_matches(percent))))


def _likely(pairs, sets, percent):
    """Distinct pairs (a, b) that their signatures do not rule out."""
    side = sets.select("node", "low", "n")
    both = pairs.join(side.toDF("a", "low_a", "n_a"), "a").join(side.toDF("b", "low_b", "n_b"), "b")
    return both.where(_alike("low_a", "low_b", "n_a", "n_b", percent)).select("a", "b")


def _full_sets(nodes, sets, docs, width):
    """node, full: the whole sets of some nodes; ``docs`` has the row keys and ``_text``."""
    needed = sets.join(nodes.select("node").distinct(), "node").select("node", "key.*")
    keys = [c for c in needed.columns if c != "node"]
    texts = docs.join(needed, keys).select("node", "_text").dropDuplicates(["node"])
    return stored(texts.select("node", shingle_column(F.col("_text"), width).alias("full")), "full-sets")


def _confirmed(pairs, full, percent):
    """The pairs whose full sets are as similar as asked."""
    both = pairs.join(full.toDF("a", "full_a"), "a").join(full.toDF("b", "full_b"), "b")
    shared = F.size(F.array_intersect("full_a", "full_b"))
    linked = 100 * shared >= percent * (F.size("full_a") + F.size("full_b") - shared)
    return stored(both.where(linked).select("a", "b"), "confirmed")


def _star_links(pairs, sets, docs, percent, width):
    """The links among pairs (a, b), by signature, then by full sets."""
    pairs = stored(_likely(pairs, sets, percent), "candidates")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    return _confirmed(pairs, _full_sets(ends, sets, docs, width), percent)


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _block_links(apart: pa.Table, others: pa.Table, percent: int) -> pa.Table:
    """Links (a, b) between the rows of two blocks, as many as join different components."""
    if not apart.num_rows or not others.num_rows:
        return _LINKS.empty_table()

    def columns(table):
        table = table.combine_chunks()
        full = table.column("full").chunk(0)
        low = table.column("low").chunk(0).flatten().to_numpy().view(np.uint64).reshape(-1, _PACKED)
        return table.column("node").to_numpy(), table.column("root").to_numpy(), low, full.flatten().to_numpy(), np.diff(full.offsets.to_numpy())

    nodes, roots, low, values, sizes = columns(others)
    order = np.argsort(values, kind="stable")
    values, owners = values[order], np.repeat(np.arange(len(nodes)), sizes)[order]
    fold, least = np.uint64(sum(1 << j for j in range(0, 64, BITS))), least_matches(percent)
    found, at, top = [], 0, {}

    def component(root):
        while root in top:
            root = top[root]
        return root

    x_nodes, x_roots, x_low, x_values, x_sizes = columns(apart)
    for node, root, own_low, size in zip(x_nodes, x_roots, x_low, x_sizes):
        own, at = x_values[at : at + size], at + size
        likely = (roots != root) & (100 * np.minimum(sizes, size) >= percent * np.maximum(sizes, size))
        differ, width = low ^ own_low, 1
        while width < BITS:
            differ = differ | differ >> np.uint64(width)
            width *= 2
        likely &= HASHES - np.bitwise_count(differ & fold).sum(1, dtype=np.int64) >= least
        if not likely.any():
            continue
        # How many of the node's shingles each of the others owns: runs of equal values, all owners together.
        begin, end = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
        runs = end - begin
        places = np.repeat(begin - np.cumsum(runs) + runs, runs) + np.arange(runs.sum())
        shared = np.bincount(owners[places], minlength=len(nodes))
        linked = np.flatnonzero(likely & (100 * shared >= percent * (sizes + size - shared)))
        for other, other_root in zip(nodes[linked].tolist(), roots[linked].tolist()):
            mine, theirs = component(int(root)), component(other_root)
            if mine != theirs:
                top[max(mine, theirs)] = min(mine, theirs)
                found.append((min(int(node), other), max(int(node), other)))
    return pa.table([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], schema=_LINKS)


def _apart_links(known, sets, docs, percent, width):
    """Links of nodes apart from the component of a node that leads one of their buckets, with all that it leads.

    ``known`` has lead, node, root and apart.  Nodes meet in blocks of at most ``BLOCK``: what a task holds does not
    grow with a group, and it puts out links only, never the pairs that it looks at.
    """
    known = stored(known, "led-nodes")
    groups = known.groupBy("lead").agg(F.count("*").alias("others"), F.count_if("apart").alias("aparts")).where(F.col("aparts") > 0)
    known = known.join(groups, "lead")
    full = _full_sets(known, sets, docs, width)
    rich = known.join(sets.select("node", "low").join(full, "node"), "node")

    def dealt(rows, own, other):
        blocks = {c: F.ceil(F.col(c) / BLOCK).cast("int") for c in (own, other)}
        mine, every = F.pmod(F.xxhash64("node"), blocks[own]).cast("int"), F.explode(F.sequence(F.lit(0), blocks[other] - 1))
        # New names for the same columns keep the two sides apart.
        columns = [F.col(c).alias(c) for c in ("lead", "node", "root", "low", "full")]
        return rows.select(*columns, mine.alias(own), every.alias(other)).groupBy("lead", "aparts", "others")

    meet = dealt(rich.where("apart"), "aparts", "others").cogroup(dealt(rich, "others", "aparts"))
    return stored(meet.applyInArrow(lambda a, b: _block_links(a, b, percent), "a bigint, b bigint"), "apart-links")


def set_links(sets: DataFrame, docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE_WORDS) -> DataFrame:
    """Links (a, b) whose components are those of all links between the nodes of ``sets``."""
    entries = sets.select(F.explode("bands").alias("band"), "node")
    # Most keys are those of a single set.
    crowded = entries.groupBy("band").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    members = stored(entries.join(stored(crowded, "buckets"), "band"), "members")
    # The more company a node has over all its buckets, the more central it is.
    central = members.groupBy("node").agg(F.sum("size").alias("company"))
    leads = members.join(central, "node").groupBy("band").agg(F.max_by("node", "company").alias("lead"), F.max("company").alias("company"))
    members = stored(members.join(leads, "band").select("node", "lead", "company"), "led")
    pairs = members.groupBy("node").agg(F.max_by("lead", "company").alias("lead")).where(F.col("node") != F.col("lead"))
    links = _star_links(pairs.toDF("a", "b"), sets, docs, percent, width)

    # Who follows the same lead, or leads that follow the same one, is linked; that is known without rounds.
    follows = links.select(F.col("a").alias("node"), F.col("b").alias("next"))
    further = follows.toDF("next", "last")
    roots = follows.join(further, "next", "left").select("node", F.coalesce("last", "next").alias("root"))
    known = members.select("lead", "node").distinct()
    for name, root in (("node", "root"), ("lead", "lead_root")):
        known = known.join(roots.toDF(name, root), name, "left").withColumn(root, F.coalesce(root, name))
    known = known.select("lead", "node", "root", (F.col("root") != F.col("lead_root")).alias("apart"))
    return links.unionByName(_apart_links(known, sets, docs, percent, width))


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT, shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked whose shingle sets share at least ``percent`` of their union;
    ``component_id`` is the smallest id reachable over links, ``kept`` says that it is the document's own.
    Null texts and texts without words have an empty set and are linked with nothing.  Documents
    without id count as members; a component of such documents only has a null ``component_id`` and
    all of them are kept.  Repeated rows stay rows.  No documents give no rows.
    """
    keyed = {n: c for n, c in row_keys(doc_id, text).items()}
    signed = docs.select(
        F.col(doc_id).alias("doc_id"), F.struct(*[c.alias(n) for n, c in keyed.items()]).alias("key"),
        signature_column(F.col(text), shingle_words).alias("s"),
    )
    rows = stored(signed.select("doc_id", "key", "s.*"), "signatures")
    sets = rows.where(F.col("n") > 0).groupBy("set_key").agg(
        F.min("doc_id").alias("first_id"), F.min("key").alias("key"), F.first("n").alias("n"),
        F.first("low").alias("low"), F.first("bands").alias("bands"))
    # Numbers given while writing: what is read back is the same for every use.
    sets = stored(sets.withColumn("node", F.monotonically_increasing_id()), "sets")
    texts = docs.select(*[c.alias(n) for n, c in keyed.items()], F.col(text).alias("_text"))
    tree = components(set_links(sets, texts, percent, shingle_words), "a", "b")
    rooted = sets.select("set_key", "node", "first_id").join(tree, "node", "left").select(
        "set_key", "first_id", F.coalesce("root", "node").alias("root"))
    rooted = stored(rooted, "rooted")
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(smallest, "root").select("set_key", "component_id")
    found = rows.select("doc_id", F.col("n").alias("n_shingles"), "set_key").join(classes, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
