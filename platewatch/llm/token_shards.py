"""Token ids in training order: every sequence at its slot in shards of fixed stride.

Documents are tokenised and cut into sequences; each task numbers its own.  The counts per task turn
these into numbers from 0 without gaps, a keyed Feistel permutation with cycle-walking turns a
number into a slot.  A shard holds a range of slots as records of one size, so any slot is found by
multiplication, and reading can resume anywhere.  A task writes whole ranges of slots, in order.

Shards are written by Spark as Parquet rows of whole blocks (binary payload), so they go
to any store and a lost task leaves nothing half done.  Blocks are small, as tasks hold thousands at once.
"""

import base64
import zlib

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewatch.llm.feistel import permute_array
from platewatch.session import new_folder

LENGTH = 256
SHARD_RECORDS = 1 << 15
BLOCK_RECORDS = 1 << 6
MAX_PARTITIONS = 10_000
MAX_ID = (1 << 16) - 1
# Records that the reader gives at once.
READ_RECORDS = 1 << 12
SEED = 23
NO_ID = -(1 << 63)
# Fixed value: how the public vocabulary splits text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"

_HEAD = np.dtype([("doc_id", "<i8"), ("piece", "<i4"), ("n_tokens", "<i4")])
_SHARDS = "shard int, first_slot bigint, records int, payload binary"


def _ranks(vocabulary: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}


def _encoding(vocabulary: bytes) -> tiktoken.Encoding:
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=_ranks(vocabulary), special_tokens={})


def stride(length: int = LENGTH) -> int:
    """Bytes of a record: document, piece, number of tokens, then the ids as unsigned 16-bit numbers."""
    return _HEAD.itemsize + 2 * length


def write_token_shards(
    docs: DataFrame, vocabulary_path: str, folder: str, length: int = LENGTH, end_token: int = 50256, seed: int = SEED
) -> int:
    """Write the shards under ``folder``; the number of sequences.

    Every document ends with ``end_token`` and is cut into sequences of ``length``; the last is filled up
    with ``end_token``, its record tells how many ids count.  Null and empty texts are the end
    token alone; a null doc_id is written as the smallest number.  Repeated rows are
    written as often as they come.  A vocabulary with ids over 16 bits is refused.
    """
    spark = docs.sparkSession
    with open(vocabulary_path, "rb") as file:
        vocabulary = file.read()  # one tokenizer file of a few MB
    largest = max([end_token, *_ranks(vocabulary).values()])
    if largest > MAX_ID:
        raise ValueError(f"{vocabulary_path} has ids up to {largest}; a record holds ids up to {MAX_ID}")
    loose = new_folder(spark, "sequences")

    def sequences(batches):
        encode, part, count = _encoding(vocabulary).encode_ordinary, TaskContext.get().partitionId(), 0
        for batch in batches:
            heads, lines = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text or "")
                ids.append(end_token)
                pieces = -(-len(ids) // length)
                line = np.full(pieces * length, end_token, "<u2")
                line[: len(ids)] = ids
                lines.append(line)
                for i in range(pieces):
                    heads.append((NO_ID if doc_id is None else doc_id, i, min(length, len(ids) - i * length)))
            if heads:
                yield _packed(part, count, np.array(heads, _HEAD), np.concatenate(lines).reshape(-1, length))
                count += len(heads)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    slim.mapInArrow(sequences, "part int, number bigint, record binary").write.option("compression", "zstd").parquet(loose)
    rows = spark.read.schema("part int, number bigint, record binary").parquet(loose)
    # One count per task of the first pass.
    counts = {r["part"]: r["n"] for r in rows.groupBy("part").agg(F.count("*").alias("n")).collect()}
    offsets = np.zeros(max(counts, default=0) + 2, np.int64)
    for part, n in counts.items():
        offsets[part + 1] = n
    offsets = np.cumsum(offsets)
    total = int(offsets[-1])

    @F.arrow_udf("bigint")
    def slot_of(part: pa.Array, number: pa.Array) -> pa.Array:
        dense = offsets[part.to_numpy()] + number.to_numpy()
        return pa.array(permute_array(dense, total, seed).astype(np.int64))

    def blocks(batches):
        held, done = None, []
        for batch in batches:
            for slot, record in zip(batch.column("slot").to_pylist(), batch.column("record").to_pylist()):
                if held and (slot % BLOCK_RECORDS == 0 or slot != held[0] + len(held[1])):
                    done.append(held)
                    held = None
                if held is None:
                    held = (slot, [])
                held[1].append(record)
            if done:
                yield _blocks(done)
                done = []
        if held:
            yield _blocks([held])

    placed = rows.select(slot_of("part", "number").alias("slot"), "record")
    shards = max(1, -(-total // SHARD_RECORDS))
    parts = min(shards, MAX_PARTITIONS)
    # Neighbouring shards go to one task in order: slots are known to be spread evenly, so nothing is sampled.
    place = F.expr(f"cast(slot div {SHARD_RECORDS} * {parts} div {shards} as int)")
    ranges = placed.repartitionById(parts, place).sortWithinPartitions("slot")
    ranges.mapInArrow(blocks, _SHARDS).write.option("compression", "zstd").parquet(folder)
    return total


def _packed(part, count, heads, ids):
    records = np.concatenate([heads.view(np.uint8).reshape(len(heads), -1), ids.view(np.uint8)], axis=1)
    data = pa.py_buffer(np.ascontiguousarray(records))
    ends = np.arange(len(heads) + 1, dtype=np.int32) * records.shape[1]
    binary = pa.Array.from_buffers(pa.binary(), len(heads), [None, pa.py_buffer(ends), data])
    number = pa.array(np.arange(count, count + len(heads), dtype=np.int64))
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(heads), part, np.int32)), number, binary], ["part", "number", "record"])


def _blocks(held):
    firsts = [first for first, _ in held]
    columns = [pa.array([f // SHARD_RECORDS for f in firsts], pa.int32()), pa.array(firsts, pa.int64()),
               pa.array([len(r) for _, r in held], pa.int32()), pa.array([b"".join(r) for _, r in held], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["shard", "first_slot", "records", "payload"])


def read_token_shards(spark: SparkSession, folder: str, length: int = LENGTH, from_slot: int = 0, with_ids: bool = True) -> DataFrame:
    """slot, shard, doc_id, piece, n_tokens, ids_crc32 (of the ids that count), ids from a slot on.

    Blocks before the slot are not read.  Without ``with_ids`` every id is read and checked all the same, but the
    column is left out.
    """
    rows = spark.read.schema(_SHARDS).parquet(folder)
    if from_slot:
        rows = rows.where(F.col("first_slot") > from_slot - BLOCK_RECORDS)
    size = stride(length)

    def records(batches):
        held, count = [], 0
        for batch in batches:
            payloads = batch.column("payload")
            for i, first in enumerate(batch.column("first_slot").to_pylist()):
                # The block is looked at where it lies in the batch; ids are copied once, all of a portion together.
                raw = np.frombuffer(payloads[i].as_buffer(), np.uint8).reshape(-1, size)
                skipped = max(0, from_slot - first)
                held.append((first + skipped, raw[skipped:]))
                count += len(raw) - skipped
                if count >= READ_RECORDS:
                    yield _read(held, with_ids)
                    held, count = [], 0
            if held:
                yield _read(held, with_ids)
                held, count = [], 0

    columns = "slot bigint, shard int, doc_id bigint, piece int, n_tokens int, ids_crc32 bigint"
    return rows.select("first_slot", "payload").mapInArrow(records, columns + (", ids array<int>" if with_ids else ""))


def _read(held, with_ids):
    """One batch of the records of some blocks."""
    raw = np.concatenate([block for _, block in held])
    slots = np.concatenate([first + np.arange(len(block), dtype=np.int64) for first, block in held])
    heads = np.ascontiguousarray(raw[:, : _HEAD.itemsize]).view(_HEAD).ravel()
    ids = np.ascontiguousarray(raw[:, _HEAD.itemsize :])
    used = heads["n_tokens"].astype(np.int64)
    flat, width = memoryview(ids.ravel()), ids.shape[1]
    sums = np.fromiter((zlib.crc32(flat[i * width : i * width + 2 * n]) for i, n in enumerate(used.tolist())), np.int64, len(ids))
    columns = {
        "slot": pa.array(slots), "shard": pa.array((slots // SHARD_RECORDS).astype(np.int32)),
        "doc_id": pa.array(heads["doc_id"], mask=heads["doc_id"] == NO_ID), "piece": pa.array(heads["piece"]),
        "n_tokens": pa.array(heads["n_tokens"]), "ids_crc32": pa.array(sums),
    }
    if with_ids:
        ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(used))).astype(np.int32)
        counted = np.arange(width // 2) < used[:, None]
        columns["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.view("<u2")[counted].astype(np.int32)))
    return pa.RecordBatch.from_pydict(columns)


def token_shards(docs: DataFrame, vocabulary_path: str, with_ids: bool = True, **rule) -> DataFrame:
    """Write into a fresh folder of the shared place and read back."""
    folder = new_folder(docs.sparkSession, "token-shards")
    write_token_shards(docs, vocabulary_path, folder, **rule)
    return read_token_shards(docs.sparkSession, folder, rule.get("length", LENGTH), with_ids=with_ids)
