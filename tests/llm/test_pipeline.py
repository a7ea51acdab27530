from collections import Counter

import corpus_pipeline
import __spark_entry__ as contract
from platewatch.llm import decontaminate, quality, queries, simhash
from platewatch.llm.common import stored, table
from tests.llm.cases import awkward, nothing
from tests.llm.test_simhash import classes, plain_fingerprint

FOLDER = "/root/testdata/sf0.001"


def test_registered():
    names = contract.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
    assert set(queries.QUERIES) <= set(names) and corpus_pipeline.ORACLE_SQL is None


def test_stages_against_brute_force(spark):
    docs = table(spark, FOLDER, "documents")
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, FOLDER), "test")
        if name != "sharding":
            assert after.columns == docs.columns
        steps[name] = (docs.collect(), after.collect())
        docs = after

    before, after = steps["quality classifier"]
    model = quality.fit(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))
    good = model.score([r["text"] for r in before]) >= 0.5
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r, g in zip(before, good) if g) and not good.all()

    before, after = steps["near duplicates"]
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in before}
    tops = classes(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    assert sorted(r["doc_id"] for r in after) == sorted(set(tops.values())) and len(after) < len(before)

    before, after = steps["benchmark decontamination"]
    items = [b" ".join(decontaminate.words_of(r["text"])) for r in table(spark, FOLDER, "benchmark").collect()]
    lines = {r["doc_id"]: b" ".join(decontaminate.words_of(r["text"])) for r in before}
    leaks = {d for d, line in lines.items() if any(i in line for i in items)}
    assert leaks and {r["doc_id"] for r in after} == set(lines) - leaks

    before, after = steps["source mixing"]
    drawn = Counter(r["doc_id"] for r in after)
    assert set(drawn) == {r["doc_id"] for r in before} and set(drawn.values()) <= {1, 2}

    before, after = steps["sharding"]
    assert Counter(r["doc_id"] for r in after) == Counter(r["doc_id"] for r in before)
    sizes = Counter(r["shard"] for r in after).values()
    assert len(sizes) == 24 and max(sizes) - min(sizes) <= 1


def test_stages_take_awkward_and_no_rows(spark):
    for docs in (awkward(spark), nothing(spark)):
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = stored(stage(spark, docs, FOLDER), "test")
            assert docs.columns == columns or name == "sharding"
    assert simhash.keep_one(nothing(spark)).count() == 0
