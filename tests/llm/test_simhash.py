import random

import pytest
import xxhash

from platewatch.llm import simhash
from platewatch.llm.components import components
from tests.llm.cases import LONG, ROWS, awkward, nothing


def plain_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(nodes, linked):
    top = {n: n for n in nodes}

    def find(n):
        while top[n] != n:
            n = top[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("text", ["", None, "A", "a b", "a b c", "É é E\x0bf\x1cg h", "x y " * 50, LONG[:999]])
def test_fingerprint_by_the_definition(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 5])
def test_links_against_all_pairs(spark, bits):
    r = random.Random(bits)
    found = {r.getrandbits(64) for _ in range(20)} | {0, (1 << 64) - 1}
    for f in list(found):
        for n in range(1, 8):
            for b in r.sample(range(64), n):
                f ^= 1 << b
            found.add(f)
    signed = [simhash._signed(f) for f in found]
    table = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    rows = [tuple(x) for x in simhash.near_links(table, bits).collect()]
    expected = {(a, b, ((a ^ b) & (1 << 64) - 1).bit_count()) for a in signed for b in signed if a < b}
    assert sorted(rows) == sorted(p for p in expected if p[2] <= bits)


def test_components_of_chains_stars_and_repeats(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 3), (3, 7), (200, 200)]
    table = spark.createDataFrame(links + [(None, 4)], "a bigint, b bigint")
    got = dict(tuple(r) for r in components(table, "a", "b").collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert components(table.where("false"), "a", "b").count() == 0


def test_classes_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in docs.collect()}
    expected = classes(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    got = simhash.near_duplicates(docs).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == expected
    assert {r["doc_id"]: int(r["fingerprint"], 16) for r in got} == prints


def test_awkward_rows(spark):
    got = simhash.near_duplicates(awkward(spark)).collect()
    assert len(got) == len(ROWS)
    by = {(r["doc_id"], r["fp"] == 0): r["component_id"] for r in got}
    # Null, empty and blank texts share the fingerprint 0; a row without id joins them.
    assert by[2, True] == by[3, True] == by[4, True] == by[None, True] == 2
    assert by[6, False] == 1 and by[None, False] is None
    assert simhash.near_duplicates(nothing(spark)).count() == 0


def test_one_of_each_group_stays(spark):
    docs = awkward(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        [(1, ROWS[0][1]), (2, None), (5, LONG), (None, ROWS[7][1]), (9, "one"), (9, "two")], key=str
    )
    twice = spark.createDataFrame([(7, "same words in a row", "s")] * 5, "doc_id bigint, text string, _id string")
    assert simhash.keep_one(twice).count() == 1
    assert simhash.keep_one(nothing(spark)).count() == 0
