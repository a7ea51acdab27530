import random

import numpy as np
import pytest

from platewatch.llm import minhash
from tests.llm.cases import ROWS, awkward, nothing
from tests.llm.test_simhash import classes


def brute(texts, percent=80, width=2):
    sets = {k: minhash.shingles(t, width) for k, t in texts.items()}

    def linked(a, b):
        a, b = sets[a], sets[b]
        if not a or not b or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
            return False
        shared = len(a & b)
        return 100 * shared >= percent * (len(a) + len(b) - shared)

    return classes(list(texts), linked), {k: len(s) for k, s in sets.items()}


def check(spark, docs):
    got = minhash.near_duplicates(docs).collect()
    component, sizes = brute({r["doc_id"]: r["text"] for r in docs.collect()})
    assert {r["doc_id"]: r["component_id"] for r in got} == component
    assert {r["doc_id"]: r["n_shingles"] for r in got} == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_classes_of_a_table_against_brute_force(spark):
    check(spark, spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_chains_and_groups_right_at_the_threshold(spark):
    r = random.Random(5)
    rows = []
    for group in range(12):
        words = [f"w{group}x{i}" for i in range(r.choice([5, 9, 18, 40, 41]))]
        for _ in range(12):
            rows.append(" ".join(words))
            # One replaced word changes two shingles: a walk away from the first text, link by link.
            for _ in range(max(1, len(words) // 20)):
                words[r.randrange(len(words))] = f"n{r.random()}"
    rows += ["a b", "A  B", "a b c", "a", "A", "b a", ""]
    check(spark, spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string").repartition(3))


@pytest.mark.parametrize("block", [512, 16])
def test_variants_of_one_text_of_which_only_some_are_linked(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    r = random.Random(4)
    words, rows = [f"b{i}" for i in range(60)], []
    for _ in range(70):
        own = list(words)
        for _ in range(r.randint(1, 9)):
            own[r.randrange(60)] = f"n{r.random()}"
        rows.append(" ".join(own))
    check(spark, spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string"))


def test_a_bucket_of_many_that_are_not_all_linked(spark):
    # All share most minima with the same passage.
    r = random.Random(9)
    passage = [f"p{i}" for i in range(60)]
    rows = [" ".join(passage + [f"t{r.randrange(60)}_{i}" for i in range(r.randint(5, 40))]) for _ in range(60)]
    check(spark, spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string"))


def test_estimate_follows_the_true_similarity():
    r = np.random.default_rng(1)
    for shared in (0, 300, 800, 1000):
        pool = r.integers(0, 1 << 63, 2000 - shared, dtype=np.uint64)
        a, b = pool[:1000], pool[1000 - shared :]
        low = [minhash.packed(minhash.minima(x)) for x in (a, b)]
        nibbles = [[int(w) >> s & 15 for w in x for s in range(0, 64, 4)] for x in low]
        equal = sum(x == y for x, y in zip(*nibbles))
        true = shared / (2000 - shared)
        assert abs((equal / minhash.HASHES - 1 / 16) / (15 / 16) - true) < 0.16


def test_matches_count_equal_places(spark):
    r = random.Random(2)
    a = [r.getrandbits(64) - (1 << 63) for _ in range(8)]
    b = [x ^ r.choice([0, 1, 0xF0, 1 << 62]) for x in a]
    row = spark.createDataFrame([(a, b)], "a array<bigint>, b array<bigint>").select(minhash.matches("a", "b").alias("m")).first()
    expected = sum((x >> s & 15) == (y >> s & 15) for x, y in zip(a, b) for s in range(0, 64, 4))
    assert row["m"] == expected


def test_awkward_rows(spark):
    got = minhash.near_duplicates(awkward(spark)).collect()
    assert len(got) == len(ROWS)
    found = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got), key=str)
    assert found == sorted([
        (1, 10, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (5, 5, 5, True), (6, 10, 1, False), (6, 10, 1, False),
        (None, 7, None, True), (None, 0, None, True), (9, 1, 9, True), (9, 1, 9, True)], key=str)
    assert minhash.near_duplicates(nothing(spark)).count() == 0
