"""Benchmark passages in documents, found by edit distance over words.

Every window of an item's number of words is a candidate.  The CGK embedding walks through a
window, staying or moving on at each step as a random function of the word says, so
that two texts a few edits apart read the same words at most steps: edit distance becomes
Hamming distance.  A sample of the steps is a hash key; repeated with fresh walks and samples
until simulated edits at the limit are found with the wanted recall.  What shares a key
with an item is verified by its exact edit distance, the smallest over all starts and ends around
the window, as a copy with words dropped or inserted is shorter or longer than its item.

Three savings lose nothing.  Words that no item has are one symbol, as they match nothing.  An
item cut into one piece more than the edits allowed has a piece that stays whole, so only windows
with the first words of some piece are embedded, and of these only windows with as many words of
items as the limit demands.

Items too short to be embedded are found by their pieces alone: an item, or each half of one that
allows an edit, is looked up among all runs of as many words, and verified in the same way.
"""

import re
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 8
EDITS_SHARE = 0.2
RECALL = 0.99
SAMPLED_STEPS = 3
MAX_REPEATS = 256
BLOCK_BYTES = 1 << 23
CALIBRATION_ITEMS = 64
SEED = 29
# Pieces have three words at least, whatever the length of the item.
SEED_WORDS = 3
SEED_BITS = 20

# Scripts written without spaces (Thai, Lao, Burmese, Khmer, kana, Han).
_UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")
_FOREIGN_MARKS = re.compile(r"[^\w\x00-\x7f]+")
_PLAIN = bytes(c if c > 127 or chr(c).isalnum() or chr(c) == "_" else 32 for c in range(256))
_HITS = pa.list_(pa.struct([("item", pa.int64()), ("edits", pa.int32()), ("start", pa.int32())]))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters, digits and underscores, in UTF-8; single characters in scripts without spaces."""
    text = (text or "").lower()
    if not text.isascii():
        text = _FOREIGN_MARKS.sub(" ", text)
        if _UNSPACED.search(text):
            text = _UNSPACED.sub(r" \1 ", text)
    return text.encode("utf-8", "replace").translate(_PLAIN).split()


def edit_limit(count: int, share: float = EDITS_SHARE) -> int:
    return int(count * share + 1e-9)


def seed_codes(codes: np.ndarray) -> np.ndarray:
    """A number for every three codes in a row."""
    return (codes[:-2] * np.uint64(0x9E3779B97F4A7C15) + codes[1:-1]) * np.uint64(0xBF58476D1CE4E5B9) + codes[2:]


def edit_distance(masks: dict, length: int, window) -> int:
    """Edits between an item, given as bit masks of its words' places, and a window.

    The columns of the dynamic programme are kept as bit vectors of their differences.
    """
    full = (1 << length) - 1
    plus, minus, score, last = full, 0, length, 1 << (length - 1)
    for symbol in window:
        match = masks.get(symbol, 0)
        down = match | minus
        across = (((match & plus) + plus) ^ plus) | match
        up = minus | (full & ~(across | plus))
        same = plus & across
        if up & last:
            score += 1
        elif same & last:
            score -= 1
        up = ((up << 1) | 1) & full
        same = (same << 1) & full
        plus = same | (full & ~(down | up))
        minus = up & down
    return score


def nearest_part(masks: dict, length: int, line: list, limit: int) -> tuple[int, int] | None:
    """Smallest number of edits between an item and any part of a line, and the first start of such a part.

    None if every part is more than ``limit`` edits away.  The columns are those of ``edit_distance``
    with a first row of zeros, as a part starts anywhere.
    """
    edits, end = min((score, place) for place, score in enumerate(_columns(masks, length, line, 0), 1))
    if edits > limit:
        return None
    # Backwards from the first end.  Alignments of two ends cross, so no later end has an earlier start.
    back = {symbol: int(f"{mask:0{length}b}"[::-1], 2) for symbol, mask in masks.items()}
    sizes = [n for n, score in enumerate(_columns(back, length, line[max(0, end - length - limit) : end][::-1], 1), 1) if score == edits]
    return edits, end - max(sizes)


def _columns(masks: dict, length: int, line: list, step: int):
    """After every symbol, the edits between the item and the line so far (step 1) or its best ending (step 0)."""
    full = (1 << length) - 1
    plus, minus, score, last = full, 0, length, 1 << (length - 1)
    for symbol in line:
        match = masks.get(symbol, 0)
        down = match | minus
        across = (((match & plus) + plus) ^ plus) | match
        up = minus | (full & ~(across | plus))
        same = plus & across
        if up & last:
            score += 1
        elif same & last:
            score -= 1
        up = ((up << 1) | step) & full
        same = (same << 1) & full
        plus = same | (full & ~(down | up))
        minus = up & down
        yield score


class Walks:
    """CGK walks and sampled steps for strings of one length."""

    def __init__(self, length: int, repeats: int, steps: int, seed: int):
        random = np.random.default_rng([seed, length])
        total = 3 * length
        self.length, self.repeats = length, repeats
        self.turns = random.integers(0, 1 << 63, (repeats, total), dtype=np.uint64) << np.uint64(1) | np.uint64(1)
        self.sampled = np.stack([np.sort(random.choice(total, min(steps, total), replace=False)) for _ in range(repeats)])

        self.last = int(self.sampled.max())
        self.taken = [np.flatnonzero((self.sampled == step).any(1)) for step in range(self.last + 1)]

    def keys(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The hash key of every window in every repeat; codes are the words' random numbers, 0 after a window's end."""
        places = starts[:, None] + np.arange(self.length + 1)
        cells = codes[np.minimum(places, len(codes) - 1)]
        cells[places >= len(codes)] = 0
        cells[:, -1] = 0
        first = np.tile(np.arange(len(starts)) * (self.length + 1), (self.repeats, 1))
        at, end, cells = first.copy(), first + self.length, cells.ravel()
        key = np.zeros(at.shape, np.uint64)
        for step, taken in enumerate(self.taken):
            code = cells[at]
            if len(taken):
                mixed = (key[taken] ^ code[taken]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(step)
                key[taken] = mixed ^ mixed >> np.uint64(29)
            at += (code * self.turns[:, step, None] >> np.uint64(63)).view(np.int64)
            np.minimum(at, end, out=at)
        return key


@dataclass
class Index:
    """All items of one block, ready to be sent to tasks."""

    vocabulary: dict
    codes: np.ndarray
    groups: list
    seeds: dict
    seeded: np.ndarray

    def search(self, text: str | None, any_length: bool = False) -> list[dict]:
        """Item, smallest number of edits, and first word of the best (first) window, per item found.

        Windows have the item's number of words, or with ``any_length`` every number the limit allows.
        """
        words = words_of(text)
        if len(words) < SEED_WORDS:
            return []
        get = self.vocabulary.get
        symbols = np.array(list(map(get, words, repeat(0))))
        codes = self.codes[symbols]
        triples = seed_codes(codes)
        near: dict[int, list[int]] = {}
        for place in np.flatnonzero(self.seeded[triples >> np.uint64(64 - SEED_BITS)]).tolist():
            for g in self.seeds.get(int(triples[place]), ()):
                near.setdefault(g, []).append(place)
        best: dict[int, tuple[int, int]] = {}
        for g, places in near.items():
            group = self.groups[g]
            length, walks = group["length"], group["walks"]
            if len(words) + group["limit"] < length:
                continue
            # Every window that holds a seed; a text a few words short of the item is one window.
            # Words put in before the seed move it on; a copy with words dropped may end with the text.
            spare = group["limit"] if any_length else 0
            reach = np.array(places)[:, None] - np.arange(length - SEED_WORDS + 1 + spare)
            starts = np.unique(np.clip(reach, 0, max(0, len(words) - length + spare)))
            inside = starts[:, None] + np.arange(length)
            known = group["member"][symbols[np.minimum(inside, len(words) - 1)]]
            if any_length:
                known &= inside < len(words)
            starts = starts[known.sum(1) >= length - group["limit"]]
            if not len(starts):
                continue
            pairs = set()
            if walks is None:
                pairs = {(int(s), i) for s in starts for i in range(len(group["items"]))}
            else:
                for keys, table, seen in zip(walks.keys(codes, starts), group["tables"], group["seen"]):
                    for place in np.flatnonzero(np.isin(keys, seen)):
                        pairs.update((int(starts[place]), i) for i in table[int(keys[place])])
            if any_length:
                self._verify(group, pairs, symbols, best)
                continue
            # Moving on by one word changes the distance by two at most: that rules out some starts.
            reach: dict[int, int] = {}
            for start, i in sorted(pairs):
                number, masks = group["items"][i]
                if start < reach.get(i, 0) or best.get(number, (1,))[0] == 0:
                    continue
                edits = edit_distance(masks, length, symbols[start : start + length].tolist())
                wanted = min(group["limit"], best.get(number, (length,))[0])
                reach[i] = start + max(0, edits - wanted) // 2
                if edits <= group["limit"] and (number not in best or edits < best[number][0]):
                    best[number] = (edits, start)
        return [{"item": n, "edits": e, "start": s} for n, (e, s) in sorted(best.items())]

    @staticmethod
    def _verify(group: dict, pairs: set, symbols: np.ndarray, best: dict) -> None:
        """Put the best part around each item's candidate windows into ``best``; windows that overlap are read once."""
        length, limit = group["length"], group["limit"]
        areas: dict[int, list[list[int]]] = {}
        for start, i in sorted(pairs):
            first, end = max(0, start - limit), min(len(symbols), start + length + limit)
            own = areas.setdefault(i, [])
            if own and first <= own[-1][1]:
                own[-1][1] = end
            else:
                own.append([first, end])
        for i, own in areas.items():
            number, masks = group["items"][i]
            for first, end in own:
                found = nearest_part(masks, length, symbols[first:end].tolist(), limit)
                if found and (number not in best or found[0] < best[number][0]):
                    best[number] = (found[0], first + found[1])


class ShortIndex:
    """Items of a few words, found by pieces that the edits allowed leave whole."""

    def __init__(self, items: list[tuple], share: float = EDITS_SHARE, **_):
        self.vocabulary: dict[bytes, int] = {}
        self.items, self.pieces = [], {}
        for number, words in items:
            symbols = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            length, limit = len(symbols), edit_limit(len(symbols), share)
            masks: dict[int, int] = {}
            for place, symbol in enumerate(symbols):
                masks[symbol] = masks.get(symbol, 0) | 1 << place
            cuts = [i * length // (limit + 1) for i in range(limit + 2)]
            for first, end in zip(cuts, cuts[1:]):
                piece = tuple(symbols[first:end])
                self.pieces.setdefault(len(piece), {}).setdefault(piece, []).append((len(self.items), first))
            self.items.append((number, masks, length, limit))

    def search(self, text: str | None, any_length: bool = True) -> list[dict]:
        """item, edits, start (word) of every item within its limit; the earliest of the places with the fewest edits."""
        line = [self.vocabulary.get(w, 0) for w in words_of(text)]
        best: dict[int, tuple[int, int]] = {}
        for size, pieces in self.pieces.items():
            begins = {piece[0] for piece in pieces}
            for i in range(len(line) - size + 1):
                if line[i] not in begins:
                    continue
                for at, place in pieces.get(tuple(line[i : i + size]), ()):
                    number, masks, length, limit = self.items[at]
                    first = max(0, i - place - limit)
                    found = nearest_part(masks, length, line[first : i - place + length + limit], limit)
                    if found:
                        own = (found[0], first + found[1])
                        best[number] = min(best.get(number, own), own)
        return [{"item": n, "edits": edits, "start": start} for n, (edits, start) in sorted(best.items())]


def repeats_needed(items: list[list[int]], codes: np.ndarray, share: float, recall: float, seed: int = SEED) -> int | None:
    """How many walks find simulated copies with the most edits allowed; None if the limit is not enough.

    At most ``CALIBRATION_ITEMS`` items are edited, eight times each, by replacing, dropping and
    inserting words in turn.  Copies within the limit that share a key are verified hits, as
    ``search`` with ``any_length`` tries all starts and ends around a candidate.
    """
    random = np.random.default_rng(seed)
    chosen = [items[i] for i in random.permutation(len(items))[:CALIBRATION_ITEMS]]
    missed, total, failing = 0, 0, []
    for item in chosen:
        limit = edit_limit(len(item), share)
        if not limit:
            continue
        walks = Walks(len(item), MAX_REPEATS, SAMPLED_STEPS, seed)
        copies = []
        for _ in range(8):
            copy = list(item)
            for edit in random.integers(0, 3, limit):
                at = int(random.integers(0, max(1, len(copy))))
                if edit == 0 and copy:
                    copy[at] = 0
                elif edit == 1 and copy:
                    del copy[at]
                else:
                    copy.insert(at, 0)
            copies.append((copy + [0] * len(item))[: len(item)])
        lines = codes[np.array([item, *copies])].ravel()
        starts = np.arange(9) * len(item)
        keys = walks.keys(lines, starts)
        met = keys[:, 1:] == keys[:, :1]
        first = np.where(met.any(0), met.argmax(0), MAX_REPEATS)
        failing.extend(first.tolist())
        total += 8
    if not total:
        return 1
    needed = int(np.quantile(failing, recall, method="higher")) + 1
    return None if needed > MAX_REPEATS else needed


def build_index(items: list[tuple], share: float = EDITS_SHARE, recall: float = RECALL, seed: int = SEED) -> Index:
    """Index (number, words) pairs; the numbers are the caller's."""
    vocabulary: dict[str, int] = {}
    coded = [(n, [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words]) for n, words in items]
    random = np.random.default_rng(seed)
    codes = random.integers(1, 1 << 63, len(vocabulary) + 1, dtype=np.uint64)
    repeats = repeats_needed([c for _, c in coded], codes, share, recall, seed)
    lengths: dict[int, list] = {}
    for number, symbols in coded:
        lengths.setdefault(len(symbols), []).append((number, symbols))
    groups, seeds, seeded = [], {}, np.zeros(1 << SEED_BITS, bool)
    for length, own in sorted(lengths.items()):
        limit = edit_limit(length, share)
        walks = None if repeats is None else Walks(length, 1 if limit == 0 else repeats, SAMPLED_STEPS, seed)
        member = np.zeros(len(vocabulary) + 1, bool)
        group_items, lines = [], []
        cuts = np.arange(limit + 1) * length // (limit + 1)
        for number, symbols in own:
            triples = seed_codes(codes[symbols])[cuts]
            seeded[triples >> np.uint64(64 - SEED_BITS)] = True
            for seed_code in triples.tolist():
                seeds.setdefault(seed_code, set()).add(len(groups))
            masks: dict[int, int] = {}
            for place, symbol in enumerate(symbols):
                masks[symbol] = masks.get(symbol, 0) | 1 << place
            member[symbols] = True
            group_items.append((number, masks))
            lines.extend(symbols)
        tables, seen = [], []
        for keys in walks.keys(codes[lines], np.arange(len(own)) * length) if walks else ():
            table: dict[int, list[int]] = {}
            for i, key in enumerate(keys.tolist()):
                table.setdefault(key, []).append(i)
            tables.append(table)
            seen.append(np.unique(keys))
        groups.append({"length": length, "limit": limit, "walks": walks, "member": member,
                       "items": group_items, "tables": tables, "seen": seen})
    return Index(vocabulary, codes, groups, seeds, seeded)


def indexes(benchmark: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES, **rule) -> list[tuple[Index | ShortIndex, list]]:
    """The benchmark as indexes of about ``block_bytes`` of text each, with the item ids of each.

    The benchmark is the stated query set: it is read in blocks whose size is measured
    first, so no task holds more than one block at a time per index.  Items with fewer than
    ``MIN_WORDS`` words have an index of their own; null items and those without words are not
    searched.  Equal texts are searched once and reported for every item.
    """
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    count = max(1, -(-int(size) // block_bytes))
    found = []
    for block in range(count):
        rows = benchmark.where(F.pmod(F.xxhash64(text), F.lit(count)) == block)
        texts: dict[bool, dict[tuple, list]] = {True: {}, False: {}}
        for row in rows.select("item_id", text).distinct().collect():
            words = tuple(words_of(row[1]))
            if words:
                texts[len(words) >= MIN_WORDS].setdefault(words, []).append(row[0])
        for build, own in ((build_index, texts[True]), (ShortIndex, texts[False])):
            if own:
                ordered = sorted(own)
                ids = [sorted(own[w], key=lambda i: (i is not None, i or 0)) for w in ordered]
                found.append((build(list(enumerate(ordered)), **rule), ids))
    return found


def hits_column(index: Index | ShortIndex, ids: list, text: Column) -> Column:
    """Array of (item, edits, start) per document, one entry per item id within the edit limit."""

    @F.arrow_udf("array<struct<item:bigint,edits:int,start:int>>")
    def hits(texts: pa.Array) -> pa.Array:
        found = []
        for value in texts.to_pylist():
            own = index.search(value, any_length=True)
            found.append([{**h, "item": i} for h in own for i in ids[h["item"]]])
        return pa.array(found, _HITS)

    return hits(text)


def contaminated(docs: DataFrame, benchmark: DataFrame, **rule) -> DataFrame:
    """doc_id, item_id, edits, start (word, from 0) for every benchmark item a document holds.

    Null and empty texts hold nothing; repeated documents are reported as often as they
    come; no documents or no items give no rows.
    """
    blocks = indexes(benchmark, **rule)
    if not blocks:
        return docs.select("doc_id", F.lit(None).cast("long").alias("item_id"), F.lit(0).alias("edits"), F.lit(0).alias("start")).where(F.lit(False))
    arrays = [hits_column(index, ids, F.col("text")) for index, ids in blocks]
    rows = docs.select("doc_id", *[a.alias(f"h{i}") for i, a in enumerate(arrays)])
    hit = F.explode(F.concat(*[F.col(f"h{i}") for i in range(len(arrays))]))
    return rows.select("doc_id", hit.alias("hit")).select(
        "doc_id", F.col("hit.item").alias("item_id"), "hit.edits", "hit.start"
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **rule) -> DataFrame:
    """The documents that hold no benchmark item, all columns as they are."""
    for index, ids in indexes(benchmark, **rule):
        docs = docs.where(F.size(hits_column(index, ids, F.col("text"))) == 0)
    return docs
