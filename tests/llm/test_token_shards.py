import base64
import zlib
from collections import defaultdict

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from platewatch.llm import token_shards as t
from platewatch.llm.queries import VOCABULARY
from platewatch.session import new_folder
from tests.llm.cases import LONG, ROWS, awkward, nothing


@pytest.fixture(scope="module")
def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    return tiktoken.Encoding("own", pat_str=t.PATTERN, mergeable_ranks=ranks, special_tokens={})


def documents(rows):
    pieces = defaultdict(dict)
    for r in rows:
        pieces[r["doc_id"]].setdefault(r["piece"], []).append(r["ids"])
    return pieces


def test_texts_come_back_and_slots_are_dense(spark, encoding):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    folder = new_folder(spark, "test-shards")
    total = t.write_token_shards(docs.repartition(3), VOCABULARY, folder, length=64)
    rows = t.read_token_shards(spark, folder, 64).collect()
    assert sorted(r["slot"] for r in rows) == list(range(total))
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: r["slot"])]
    assert np.mean(np.diff(order) == 0) < 0.5  # neighbours in training order are strangers
    pieces = documents(rows)
    for d in docs.collect():
        ids = [i for n in range(len(pieces[d["doc_id"]])) for i in pieces[d["doc_id"]][n][0]]
        assert ids[-1] == 50256 and encoding.decode(ids[:-1]) == d["text"]
    later = t.read_token_shards(spark, folder, 64, from_slot=total // 2)
    assert sorted(r["slot"] for r in later.select("slot").collect()) == list(range(total // 2, total))


def test_slots_and_ids_against_a_plain_permutation(spark, encoding):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").coalesce(1)
    rows = t.token_shards(docs, VOCABULARY, length=64).collect()
    records = []
    for d in docs.collect():
        ids = [*encoding.encode_ordinary(d["text"]), 50256]
        records += [(d["doc_id"], i // 64, ids[i : i + 64]) for i in range(0, len(ids), 64)]
    # A permutation by whole numbers, step by step, with cycle-walking.
    half = max(1, ((len(records) - 1).bit_length() + 1) // 2)
    keys = [int(k) for k in np.random.default_rng(t.SEED).integers(0, 1 << 63, 8, dtype=np.uint64)]

    def slot(value):
        while True:
            left, right = value >> half, value & (1 << half) - 1
            for k in keys:
                noise = (right + k) * 0xBF58476D1CE4E5B9 % (1 << 64)
                noise = (noise ^ noise >> 31) * 0x94D049BB133111EB % (1 << 64)
                left, right = right, left ^ (noise >> 20) & (1 << half) - 1
            value = left << half | right
            if value < len(records):
                return value

    expected = {slot(i): (doc, piece, len(ids), zlib.crc32(np.array(ids, "<u2").tobytes()), ids) for i, (doc, piece, ids) in enumerate(records)}
    assert {r["slot"]: (r["doc_id"], r["piece"], r["n_tokens"], r["ids_crc32"], r["ids"]) for r in rows} == expected
    slim = t.token_shards(docs, VOCABULARY, with_ids=False, length=64)
    assert "ids" not in slim.columns
    assert {r["slot"]: r["ids_crc32"] for r in slim.collect()} == {s: e[3] for s, e in expected.items()}


def test_too_large_ids_are_refused_before_any_task(spark):
    with pytest.raises(ValueError, match="70000"):
        t.token_shards(awkward(spark), VOCABULARY, end_token=70_000)


def test_records_have_one_stride_and_files_ranges_of_slots(spark, monkeypatch):
    monkeypatch.setattr(t, "SHARD_RECORDS", 1 << 8)
    folder = new_folder(spark, "test-shards")
    t.write_token_shards(awkward(spark), VOCABULARY, folder, length=16)
    blocks = spark.read.parquet(folder)
    files = blocks.groupBy(F.input_file_name().alias("f")).agg(F.min("first_slot").alias("a"), F.max("first_slot").alias("b")).orderBy("a").collect()
    assert len(files) > 2 and all(x["b"] < y["a"] for x, y in zip(files, files[1:]))
    assert blocks.where(F.length("payload") != F.col("records") * t.stride(16)).count() == 0


def test_awkward_rows(spark, encoding):
    rows = t.token_shards(awkward(spark), VOCABULARY, length=128).collect()
    pieces = documents(rows)
    assert pieces[2][0] == pieces[3][0] == [[50256]]
    assert len(pieces[6][0]) == 2 and len(pieces[None][0]) == 2
    long = [i for n in range(len(pieces[5])) for i in pieces[5][n][0]]
    assert encoding.decode(long[:-1]) == LONG
    assert t.token_shards(nothing(spark), VOCABULARY).count() == 0
