"""Groups of spelling variants: frequent words and the rare words one edit away from them.

Near words are found by pivotal grams.  A word's bigrams are ranked by how few words hold
them; its prefix is every bigram up to the third-rarest place.  Two bigrams of the prefix
that share no letter are its pivots, chosen by dynamic programming for the shortest lists.  One
edit can spoil only one pivot, so of two near words the one whose prefix ends earlier has a pivot that
stands in the other's prefix, shifted by at most one place, and with it all that lies before
it or all that lies behind it is the same.  Pivot, place, length and that half are the key of the
index; what is found is verified by the edit distance.
"""

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewatch.llm.common import stored

# Fixed value: the letters of words.
LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH = 7
MIN_COUNT = 2
MIN_RATIO = 10
GRAM = 2
PIVOTS = 2  # one more than the edits
PREFIX = GRAM * (PIVOTS - 1) + 1
# Bigrams of the 26 + 64 letters, a bound on what the driver holds of them.
MAX_GRAMS = 90 * 90

# An edit takes away at most GRAM bigrams and puts in as many, each one bit of a word's mask.
MAX_BITS = 2 * GRAM

_CHOSEN_DDL = "struct<prefix:array<int>,pivots:array<int>,last:int,mask:bigint>"
_CHOSEN = pa.struct([("prefix", pa.list_(pa.int32())), ("pivots", pa.list_(pa.int32())), ("last", pa.int32()), ("mask", pa.int64())])


def runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_length: int = 1) -> DataFrame:
    """doc_id, run: maximal runs of letters, A-Z in lower case, one row per occurrence.

    Null and empty texts have none.
    """
    found = F.regexp_extract_all(F.col(text), F.lit(f"([{LETTERS}]{{{min_length},}})"), F.lit(1))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.explode(found).alias("run"))
    return rows.withColumn("run", F.translate("run", string.ascii_uppercase, string.ascii_lowercase))


def counted(words: DataFrame, word: str = "word", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n of the words long and frequent enough; nulls do not count."""
    enough = words.where(F.length(word) >= min_length)
    return enough.groupBy(F.col(word).alias("word")).agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def disjoint(places: list[int], weights: list[int], count: int = PIVOTS, width: int = GRAM) -> list[int]:
    """The ``count`` places at least ``width`` apart with the least sum of weights.

    Places come in rising order.  Of choices that weigh the same the one that ends earlier counts.
    """
    best = [[(0, ())] * (len(places) + 1)]
    for taken in range(1, count + 1):
        row, before = [None], 0
        for i, place in enumerate(places):
            while places[before] <= place - width:
                before += 1
            shorter = best[taken - 1][before]
            with_it = shorter and (shorter[0] + weights[i], (*shorter[1], place))
            row.append(min((x for x in (row[-1], with_it) if x), key=lambda x: x[0], default=None))
        best.append(row)
    return list(best[count][-1][1])


def choose(word: str, ranks: dict[str, tuple[int, int]]) -> tuple[list[int], list[int], int, int]:
    """Places of the prefix and of the pivots, rank of the prefix's last bigram, mask of all bigrams.

    ``ranks`` has the rank and the number of words of every bigram.
    """
    known = [ranks[word[i : i + GRAM]] for i in range(len(word) - GRAM + 1)]
    last = sorted(rank for rank, _ in known)[PREFIX - 1]
    prefix = [i for i, (rank, _) in enumerate(known) if rank <= last]
    mask = 0
    for rank, _ in known:
        mask |= 1 << rank % 64
    return prefix, disjoint(prefix, [known[i][1] for i in prefix]), last, mask


def _half(length, place, whole, tail):
    """The key of a bigram's place with what lies up to its end, or from its start on."""
    part = F.substr(whole, F.lit(1), place + GRAM) if not tail else F.substr(whole, place + 1, F.length(whole))
    return length, place, F.lit(tail), part


def _key(length, place, tail, part):
    return F.xxhash64(length.cast("int"), place.cast("int"), tail, part)


def near_words(words: DataFrame) -> DataFrame:
    """a, n_a, b, n_b (a < b) of the distinct words of ``word, n`` that are one edit apart.

    An edit is an inserted, deleted or replaced code point.  Words need four code points or more
    (three bigrams); shorter ones are near none.
    """
    words = words.where(F.length("word") >= PREFIX + 1)
    grams = words.select(F.explode(F.transform(
        F.sequence(F.lit(1), F.length("word") - GRAM + 1), lambda i: F.substr("word", i, F.lit(GRAM)))).alias("gram"))
    lists = grams.groupBy("gram").agg(F.count("*").alias("n")).orderBy("n", "gram")
    ranks = {r["gram"]: (i, r["n"]) for i, r in enumerate(lists.collect())}
    if len(ranks) > MAX_GRAMS:
        raise ValueError(f"words hold {len(ranks)} different bigrams, more than {MAX_GRAMS}: other letters than {LETTERS}")

    @F.arrow_udf(_CHOSEN_DDL)
    def chosen(batch: pa.Array) -> pa.Array:
        found = [choose(w, ranks) for w in batch.to_pylist()]
        lists = [_lists([f[i] for f in found]) for i in (0, 1)]
        masks = np.array([f[3] for f in found], np.uint64).view(np.int64)
        return pa.StructArray.from_arrays([*lists, pa.array([f[2] for f in found], pa.int32()), pa.array(masks)], fields=list(_CHOSEN))

    rows = stored(words.select("word", "n", chosen("word").alias("c")), "pivots").select("word", "n", "c.*")
    word, length, place = F.col("word"), F.length("word"), F.col("place")
    entries = rows.select(F.explode("prefix").alias("place"), "word", "n", "last", "mask").select(
        F.explode(F.array(*[_key(*_half(length, place, word, tail)) for tail in (0, 1)])).alias("key"),
        F.col("word").alias("w_r"), F.col("n").alias("n_r"), F.col("last").alias("last_r"), F.col("mask").alias("mask_r"),
    )

    def probe(longer, shift, tail):
        own, at, side, part = _half(length, place, word, tail)
        return _key(own + longer, at + shift, side, part)

    # The other word as long, longer or shorter by one; an edit before the pivot moves it and leaves its tail.
    looks = [probe(longer, longer * tail, tail) for longer in (0, 1, -1) for tail in (0, 1)]
    probes = rows.select(F.explode("pivots").alias("place"), "word", "n", "last", "mask").select(
        F.explode(F.array(*looks)).alias("key"),
        F.col("word").alias("w_s"), F.col("n").alias("n_s"), F.col("last").alias("last_s"), F.col("mask").alias("mask_s"),
    )
    # The planner takes no account of how long the exploded lists are: without the hint it may broadcast them.
    found = probes.hint("merge").join(entries, "key").where(
        (F.col("last_s") <= F.col("last_r")) & (F.bit_count(F.col("mask_s").bitwiseXOR(F.col("mask_r"))) <= MAX_BITS)
        & (F.col("w_s") != F.col("w_r")) & (F.levenshtein("w_s", "w_r", 1) == 1)
    )
    turned = F.col("w_s") > F.col("w_r")
    ends = [F.when(turned, F.col(y)).otherwise(F.col(x)).alias(name) for x, y, name in
            (("w_s", "w_r", "a"), ("n_s", "n_r", "n_a"), ("w_r", "w_s", "b"), ("n_r", "n_s", "n_b"))]
    return found.select(*ends).distinct()


def _lists(rows):
    ends = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array([x for r in rows for x in r], pa.int32()))


def spelling_groups(words: DataFrame, min_ratio: int = MIN_RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row of ``word, n`` (distinct words).

    The form is the near word with the largest n, ties the smallest word, if that is at
    least ``min_ratio`` times the word's own; the root is what following forms ends at, the word
    itself where it has none.  No words give no rows.
    """
    words = stored(words.select("word", "n"), "words")
    pairs = stored(near_words(words), "near-words")
    sides = pairs.select("a", "n_a", "b", "n_b").unionByName(
        pairs.select(F.col("b").alias("a"), F.col("n_b").alias("n_a"), F.col("a").alias("b"), F.col("n_a").alias("n_b")))
    # The least of (-n, word) is the largest n and among those the smallest word.
    near = sides.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("form"))).alias("best"))
    enough = -F.col("best.less") >= min_ratio * F.col("n")
    rows = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"))
    rows = stored(rows, "forms")
    # Following forms twice as far each time; n grows with every step, so there are no circles.
    roots = rows.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = stored(roots.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                                  F.col("further").isNotNull().alias("moved")), "roots")
        if roots.where("moved").isEmpty():
            break
        roots = roots.drop("moved")
    return rows.join(roots.drop("moved"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
