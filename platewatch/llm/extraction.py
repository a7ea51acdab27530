"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

Every block is described by its ancestors (tags and pieces of class, id and role names) and by the
shape of its text.  The field scores the labels article and other for each block and each
pair of neighbours; it is trained on labelled pages by gradient ascent of the likelihood, with
forward and backward sums, and decoded by Viterbi.
"""

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewatch.llm.common import free_name
from platewatch.llm.html_blocks import Block, blocks
from platewatch.llm.labelled_pages import labelled_page

BUCKETS = 1 << 13
TRAINING_PAGES = 800
STEPS = 100
RATE = 0.1
SHRINK = 1e-4


def path_features(path: tuple) -> list[str]:
    """Features of the ancestors: tags, names, and names by the two nearest elements."""
    found = {f"tag {tag}" for tag, _ in path} | {f"name {n}" for _, names in path for n in names}
    own = [tag for tag, _ in path if tag not in ("b", "i", "em", "strong", "a", "span", "html", "body", "font", "u", "small", "code", "ins")]
    found.add(f"own {own[-1] if own else 'none'}")
    found.add(f"pair {'/'.join(own[-2:])}")
    found.add("in body" if any(tag == "body" for tag, _ in path) else "no body")
    return sorted(found)


def text_features(block: Block) -> list[str]:
    text, size = block.text, len(block.text)
    words = text.count(" ") + 1
    found = [
        f"words {min(words.bit_length(), 7)}",
        f"linked {round(block.linked * 4)}",
        f"ends {text[-1] if text[-1] in '.!?:,…' else 'other'}",
        f"marks {min(3, text.count('. ') + text.count(', '))}",
    ]
    if "\N{COPYRIGHT SIGN}" in text[:40]:
        found.append("copyright")
    if words > 1 and sum(w[0].isupper() for w in text[:300].split()) * 2 > min(words, len(text[:300].split())):
        found.append("capitals")
    if size and sum(c.isdigit() for c in text[:200]) * 4 > min(size, 200):
        found.append("digits")
    return found


def bucket(feature: str) -> int:
    return crc32(feature.encode()) % BUCKETS


@dataclass
class Field:
    """Weights of article against other by feature, and of neighbouring labels (from, to)."""

    weights: np.ndarray
    moves: np.ndarray

    def keep(self, page: list[Block], paths: dict) -> list[bool]:
        """The most likely labels; ``paths`` remembers scores of ancestors between pages."""
        if not page:
            return []
        scores = []
        for block in page:
            above = paths.get(block.path)
            if above is None:
                if len(paths) > 100_000:
                    paths.clear()
                above = paths[block.path] = float(sum(self.weights[bucket(f)] for f in path_features(block.path)))
            scores.append(above + float(sum(self.weights[bucket(f)] for f in text_features(block))))
        (stay, into), (out, on) = self.moves.tolist()
        other, article, back = 0.0, scores[0], []
        for score in scores[1:]:
            from_other = (other + stay >= article + out, other + into > article + on)
            other, article = max(other + stay, article + out), max(other + into, article + on) + score
            back.append(from_other)
        label = article > other
        labels = [label]
        for to_other, to_article in reversed(back):
            label = not (to_article if label else to_other)
            labels.append(label)
        return labels[::-1]


def train(pages: list[tuple[list[Block], list[int]]], steps: int = STEPS, rate: float = RATE) -> Field:
    """Fit the field to pages with one label (1 article, 0 other) per block."""
    pages = [(b, l) for b, l in pages if b]
    longest, count = max((len(b) for b, _ in pages), default=0), len(pages)
    gold = np.zeros((count, longest), int)
    real = np.zeros((count, longest), bool)
    ids, cells = [], []
    for p, (own, labels) in enumerate(pages):
        gold[p, : len(own)], real[p, : len(own)] = labels, True
        for b, block in enumerate(own):
            features = {bucket(f) for f in path_features(block.path) + text_features(block)}
            ids.extend(features)
            cells.extend([p * longest + b] * len(features))
    ids, cells = np.array(ids, int), np.array(cells, int)
    weights, moves = np.zeros(BUCKETS), np.zeros((2, 2))
    speed = [np.zeros(BUCKETS), np.zeros((2, 2))]
    pairs = real[:, 1:]
    seen = np.zeros((2, 2))
    np.add.at(seen, (gold[:, :-1][pairs], gold[:, 1:][pairs]), 1)
    for _ in range(steps if count else 0):
        score = np.bincount(cells, weights[ids], count * longest).reshape(count, longest)
        chance, moved = _marginals(score, moves, real)
        push = np.where(real, gold - chance, 0).ravel() / count
        slopes = [np.bincount(ids, push[cells], BUCKETS) - SHRINK * weights, (seen - moved) / count - SHRINK * moves]
        # Steps are divided by the root of the squared slopes so far.
        for values, slope, total in zip((weights, moves), slopes, speed):
            total += slope**2
            values += rate * 5 * slope / np.sqrt(total + 1e-8)
    return Field(weights, moves)


def _marginals(score, moves, real):
    """Chance of article per block, and expected number of each pair of neighbouring labels."""
    count, longest = score.shape
    emit = np.stack([np.zeros_like(score), score], axis=2)
    ahead, behind = np.zeros((count, longest, 2)), np.zeros((count, longest, 2))
    ahead[:, 0] = emit[:, 0]
    for t in range(1, longest):
        step = np.logaddexp.reduce(ahead[:, t - 1, :, None] + moves, axis=1) + emit[:, t]
        ahead[:, t] = np.where(real[:, t, None], step, ahead[:, t - 1])
    total = np.logaddexp.reduce(ahead[:, -1], axis=1)
    for t in range(longest - 2, -1, -1):
        step = np.logaddexp.reduce(moves + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
        behind[:, t] = np.where(real[:, t + 1, None], step, 0)
    chance = np.exp(ahead[:, :, 1] + behind[:, :, 1] - total[:, None])
    joint = ahead[:, :-1, :, None] + moves + (emit[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
    moved = np.where(real[:, 1:, None, None], np.exp(np.minimum(joint, 0)), 0).sum((0, 1))
    return chance, moved


def labelled(pages: int = TRAINING_PAGES, first: int = 0) -> list[tuple[list[Block], list[int]]]:
    """Training pages as blocks with labels; the number of pages bounds the training."""
    found = []
    for seed in range(first, first + pages):
        page, labels = labelled_page(seed)
        own = blocks(page)
        if len(own) != len(labels):
            raise ValueError(f"page {seed}: {len(own)} blocks, {len(labels)} labels")
        found.append((own, labels))
    return found


def main_text(field: Field, page: str | None, paths: dict | None = None) -> str:
    """The article's blocks joined by empty lines; empty for null and text-free pages."""
    own = blocks(page)
    kept = field.keep(own, {} if paths is None else paths)
    return "\n\n".join(b.text for b, k in zip(own, kept) if k)


def text_column(field: Field, page: Column) -> Column:
    @F.arrow_udf("string")
    def texts(pages: pa.Array) -> pa.Array:
        paths: dict = {}
        return pa.array([main_text(field, p, paths) for p in pages.to_pylist()], pa.string())

    return texts(page)


def extract(pages: DataFrame, html: str = "html", field: Field | None = None) -> DataFrame:
    """All rows with the columns text and n_chars (code points); taken names get a trailing underscore.

    Null pages have an empty text; repeated rows stay rows; no pages give no rows.
    """
    field = field or train(labelled())
    text, size = free_name(pages, "text"), free_name(pages, "n_chars")
    return pages.withColumn(text, text_column(field, F.col(html))).withColumn(size, F.length(text).cast("long"))
