"""Supervised subword embeddings for text quality.

A document is the mean of the learned vectors of its hashed words and byte n-grams; a softmax
over that mean gives the classes.  Training is stochastic gradient descent in numpy on a
bounded sample of labelled rows, in one task.  As the mean and the layer before the softmax are linear, a
feature's vector is folded into one number per class difference before scoring, so executors
receive one small table.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_BITS = 17
DIMENSIONS = 8
GRAMS = (3, 4, 5)
EPOCHS = 12
RATE = 0.5
SAMPLE_ROWS = 5000
CHUNK_BYTES = 1 << 20
SEED = 17

_MUL32 = np.uint32(0x01000193)
_MIX32 = np.uint32(0x9E3779B1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


@dataclass
class Model:
    """One number per hashed feature, and the bias, of label 1 against label 0."""

    weights: np.ndarray
    bias: float

    def score(self, texts: list) -> np.ndarray:
        """The probability of label 1 for each text; a text without features gets that of the bias."""
        logits = np.full(len(texts), self.bias)
        for at, ids, owner in chunks(texts):
            sums = np.bincount(owner, self.weights[ids], len(at))
            logits[at] += sums / np.maximum(np.bincount(owner, minlength=len(at)), 1)
        return 1 / (1 + np.exp(-np.clip(logits, -60, 60)))


def chunks(texts: list):
    """For bounded portions of the texts: their positions, feature ids and the owner of each.

    One text larger than the portion is a portion of its own.
    """
    held, size, at = [], 0, []
    for i, text in enumerate(texts):
        data = b" " + (text or "").encode("utf-8", "replace") + b" "
        if held and size + len(data) > CHUNK_BYTES:
            yield at, *features(held)
            held, size, at = [], 0, []
        held.append(data)
        at.append(i)
        size += len(data)
    if held:
        yield at, *features(held)


def features(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids of all parts together, and for each id the number of its part."""
    raw = np.frombuffer(b"".join(parts), np.uint8)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    owner = np.repeat(np.arange(len(parts), dtype=np.int32), lengths)
    shift = np.uint32(32 - BUCKET_BITS)
    ids, owners = [], []
    # A text of white space only has no features.
    worded = np.bincount(owner, ~_SPACE[raw], len(parts)) > 0
    wide, hashed = raw.astype(np.uint32), raw.astype(np.uint32)
    for n in range(2, max(GRAMS) + 1):
        if len(raw) < n:
            break
        hashed = hashed[: len(raw) - n + 1] * _MUL32 + wide[n - 1 :]
        if n in GRAMS:
            first = owner[: len(raw) - n + 1]
            inside = (first == owner[n - 1 :]) & worded[first]
            ids.append(((hashed + np.uint32(n)) * _MIX32 >> shift)[inside])
            owners.append(first[inside])
    space = _SPACE[raw]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    # Hash of a word: difference of prefix sums of byte * base^place, moved to place 0.
    powers = np.full(len(raw), _BASE)
    powers[:1] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(raw * powers, dtype=np.uint64)))
    back = np.full(len(raw), _INVERSE)
    back[:1] = 1
    back = np.cumprod(back, dtype=np.uint64)
    words = (sums[ends] - sums[starts]) * back[starts] * _BASE
    ids.append((words >> np.uint64(64 - BUCKET_BITS)).astype(np.uint32))
    owners.append(owner[starts])
    return np.concatenate(ids), np.concatenate(owners)


def train(texts: list, labels: list, epochs: int = EPOCHS, rate: float = RATE) -> Model:
    """Fit vectors and softmax; without rows every score is 0.5, with one class it is that class."""
    size, random = 1 << BUCKET_BITS, np.random.default_rng(SEED)
    vectors = random.uniform(-1, 1, (size, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer, bias = np.zeros((2, DIMENSIONS), np.float32), np.zeros(2)
    # A row is a view into the few large arrays of its portion: the driver gives their memory back.
    rows = []
    for at, ids, owner in chunks(texts):
        pairs, counts = np.unique(owner.astype(np.int64) << BUCKET_BITS | ids, return_counts=True)
        own, total = pairs >> BUCKET_BITS, np.bincount(owner, minlength=len(at))
        seen_all, share_all = (pairs & (size - 1)).astype(np.int32), (counts / total[own]).astype(np.float32)
        ends = np.cumsum(np.bincount(own, minlength=len(at))).tolist()
        rows += [(seen_all[a:b], share_all[a:b], int(labels[i])) for a, b, i in zip([0, *ends], ends, at)]
    steps, step = max(1, epochs * len(rows)), 0
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            seen, share, label = rows[i]
            own = vectors[seen]
            mean = share @ own
            raw = layer @ mean + bias
            chance = np.exp(raw - raw.max())
            error = chance / chance.sum()
            error[label] -= 1
            pace = rate * (1 - step / steps)
            # The share of one feature is tiny: its vector moves by the whole gradient of the mean,
            # weighted by how much more than average it occurs.
            weight = share * min(len(share), 200)
            vectors[seen] = own - pace * np.outer(weight, error @ layer)
            layer -= (pace * np.outer(error, mean)).astype(np.float32)
            bias -= pace * 0.1 * error
            step += 1
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float64), float(bias[1] - bias[0]))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows never learned from: crc32 of the id's digits has the remainder 1 by 3; null ids are not among them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Train on at most ``sample_rows`` labelled documents, those whose id hashes lowest.

    One task learns; ``sample_rows`` bounds what it holds, and the driver receives the finished model only.  Conflicting labels of one id are averaged, ties
    count as 1; a repeated id is learned from once, by its smallest text.
    """
    marked = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
        .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("_label"))
    )
    # Rank among labelled ids that have a document.
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    order = F.xxhash64(F.lit(SEED), "doc_id")
    chosen = marked.join(ids, "doc_id", "left_semi").orderBy(order, "doc_id").limit(sample_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    rows = texts.groupBy("doc_id", "_label").agg(F.min("text").alias("text"))

    def learn(batches):
        columns = ("doc_id", "_label", "text")
        rows = [row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in columns))]
        rows.sort(key=lambda row: row[0])
        model = train([text for _, _, text in rows], [label for _, label, _ in rows])
        yield pa.RecordBatch.from_pydict({"weights": [model.weights.tobytes()], "bias": [model.bias]})

    learned = rows.repartition(1).mapInArrow(learn, "weights binary, bias double").first()
    return Model(np.frombuffer(learned["weights"]), learned["bias"]) if learned else train([], [])


def score_column(model: Model, text: Column) -> Column:
    """Probability of label 1 of a text column, whole texts; null counts as empty."""

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(texts.to_pylist()), pa.float64())

    return scores(text)


def with_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every document; repeated rows stay rows."""
    score = score_column(fit(docs, labels, sample_rows), F.col("text"))
    return docs.select("doc_id", held_out().alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def keep_good(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that the classifier takes for label 1, all columns as they are."""
    score = score_column(fit(docs, labels, sample_rows), F.col("text"))
    return docs.where(score >= 0.5)
