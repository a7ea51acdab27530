import random

import pytest

from platewatch.llm import decontaminate as d
from tests.llm.cases import ROWS, awkward, nothing


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def masks(item):
    out = {}
    for i, w in enumerate(item):
        out[w] = out.get(w, 0) | 1 << i
    return out


def test_edit_distance_against_the_table():
    r = random.Random(1)
    for _ in range(300):
        a = [r.randint(1, 5) for _ in range(r.randint(1, 80))]
        b = [r.randint(0, 5) for _ in range(r.randint(0, 80))]
        assert d.edit_distance(masks(a), len(a), b) == plain_distance(a, b)


def test_words():
    assert d.words_of("Éa, b_1—c　D’e") == [w.encode() for w in ("éa", "b_1", "c", "d", "e")]
    assert d.words_of(None) == []


def brute(words, items):
    found = {}
    for number, item in items:
        n, limit = len(item), d.edit_limit(len(item))
        starts = range(max(1, len(words) - n + 1)) if len(words) + limit >= n else ()
        best = min(((plain_distance(item, words[s : s + n]), s) for s in starts), default=(n, 0))
        if best[0] <= limit:
            found[number] = best
    return found


def made_up(seed):
    r = random.Random(seed)
    lexicon = [f"w{i}".encode() for i in range(300)]
    items = [(i, [r.choice(lexicon) for _ in range(r.randint(8, 45))]) for i in range(25)]
    texts = []
    for n in range(120):
        line = [r.choice(lexicon) for _ in range(r.randint(0, 60))]
        if n % 2:
            copy = list(r.choice(items)[1])
            for _ in range(r.randint(0, d.edit_limit(len(copy)))):
                at = r.randrange(len(copy))
                copy[at : at + r.randint(0, 1)] = [r.choice(lexicon)] * r.randint(0, 1)
            at = r.randint(0, len(line))
            line[at:at] = copy
        texts.append(line)
    return items, texts


@pytest.mark.parametrize("seed", range(3))
def test_search_against_every_window(seed):
    items, texts = made_up(seed)
    index = d.build_index(items)
    expected = found = 0
    for line in texts:
        want = brute(line, items)
        got = {h["item"]: (h["edits"], h["start"]) for h in index.search(b" ".join(line).decode())}
        assert set(got) <= set(want)
        expected, found = expected + len(want), found + len(got)
    assert expected > 40 and found >= 0.97 * expected


def test_without_hashing_every_window_is_verified(monkeypatch):
    monkeypatch.setattr(d, "repeats_needed", lambda *a: None)
    items, texts = made_up(9)
    index = d.build_index(items)
    for line in texts:
        got = {h["item"]: (h["edits"], h["start"]) for h in index.search(b" ".join(line).decode())}
        assert got == brute(line, items)


def brute_any_length(words, items):
    found = {}
    for number, item in items:
        n, limit = len(item), d.edit_limit(len(item))
        best = min(((plain_distance(item, words[s : s + m]), s) for m in range(n - limit, n + limit + 1)
                    for s in range(len(words) - m + 1)), default=(n, 0))
        if best[0] <= limit:
            found[number] = best
    return found


def test_windows_of_all_lengths_without_hashing(monkeypatch):
    monkeypatch.setattr(d, "repeats_needed", lambda *a: None)
    items, texts = made_up(4)
    items = [(i, item[:20]) for i, item in items[:4]]
    index = d.build_index(items)
    for n, line in enumerate(texts[:16]):
        if n % 2:
            copy = list(items[n % 4][1])
            for k in range(d.edit_limit(len(copy))):
                at = (7 * k + n) % len(copy)
                copy[at : at + n // 2 % 2] = [b"new"] * (1 - n // 2 % 2)
            line[n % 5 : n % 5] = copy
        got = {h["item"]: (h["edits"], h["start"]) for h in index.search(b" ".join(line).decode(), any_length=True)}
        assert got == brute_any_length(line, items)


@pytest.mark.parametrize("length", [20, 45])
@pytest.mark.parametrize("kind", ["drop", "insert"])
@pytest.mark.parametrize("last", [False, True])
def test_copies_with_all_edits_of_one_kind(spark, length, kind, last):
    r = random.Random(length)
    items = [[f"i{n}x{r.randrange(999)}" for _ in range(length)] for n in range(60)]
    texts = []
    for item in items:
        copy = list(item)
        for _ in range(d.edit_limit(length)):
            at = r.randrange(len(copy))
            copy[at : at + (kind == "drop")] = ["new"] * (kind == "insert")
        texts.append(" ".join(["before"] * 30 + copy + ["after"] * (0 if last else 30)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(n, " ".join(item)) for n, item in enumerate(items)], "item_id bigint, text string")
    got = {(row["doc_id"], row["item_id"]) for row in d.contaminated(docs, benchmark).collect()}
    assert got <= {(n, n) for n in range(60)} and len(got) >= 58


def test_awkward_rows(spark):
    benchmark = spark.createDataFrame(
        [(1, "plain words that STAND here, for a text of some length"), (1, "too short"), (2, None), (None, ""),
         (3, "plain words that stand here for a text of some length!"), (4, " ".join(f"n{i}" for i in range(400)))],
        "item_id bigint, text string",
    )
    got = sorted(tuple(r) for r in d.contaminated(awkward(spark), benchmark, block_bytes=64).collect())
    assert got == sorted([(i, item, 0, 0) for i in (1, 6, 6) for item in (1, 3)])
    kept = d.decontaminate(awkward(spark), benchmark)
    assert kept.columns == awkward(spark).columns and kept.count() == len(ROWS) - 3
    assert d.contaminated(nothing(spark), benchmark).count() == 0
    assert d.contaminated(awkward(spark), benchmark.where("false")).count() == 0
    assert d.decontaminate(awkward(spark), benchmark.where("false")).count() == len(ROWS)


def test_every_planted_passage_is_found(spark):
    folder = "/root/testdata/sf0.01"
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    lines = {r["item_id"]: b" ".join(d.words_of(r["text"])) for r in items.collect()}
    expected = set()
    for row in docs.collect():
        line = b" " + b" ".join(d.words_of(row["text"])) + b" "
        expected |= {(row["doc_id"], i) for i, item in lines.items() if b" " + item + b" " in line}
    got = {(r["doc_id"], r["item_id"]) for r in d.contaminated(docs, items).collect()}
    assert expected and expected <= got and len(got) <= len(expected) + 2


def test_short_items_against_brute_force():
    r = random.Random(8)
    items = [(n, tuple(r.choice([b"a", b"b", b"c", b"d", b"e"]) for _ in range(n % 7 + 1))) for n in range(40)]
    index = d.ShortIndex(items)
    for _ in range(150):
        words = [r.choice("abcdefgh") for _ in range(r.randint(0, 25))]
        line = [w.encode() for w in words]
        expected = {}
        for number, item in items:
            limit = d.edit_limit(len(item))
            for size in range(max(1, len(item) - limit), len(item) + limit + 1):
                for start in range(len(line) - size + 1):
                    edits = plain_distance(item, line[start : start + size])
                    if edits <= limit:
                        expected[number] = min(expected.get(number, edits), edits)
        assert {h["item"]: h["edits"] for h in index.search(" ".join(words))} == expected


def test_short_questions_and_scripts_without_spaces(spark):
    chinese, long = "法国的首都是哪里", "这是一个很长的问题它没有空格但是有许多汉字所以要逐字比较"
    benchmark = spark.createDataFrame([(1, "What is the capital of France?"), (2, chinese), (3, "  ?! "), (4, long), (5, "Zxqv")], "item_id bigint, text string")
    rows = [(10, "So: what is the capital city of France? Paris."), (11, f"请问{chinese}？"), (12, "Nothing to see here, ?!"),
            (13, "前言。" + long.replace("空格", "間隔") + "。后记"), (14, "what is the capital of Spain, and of Rome"), (15, "法国的天气"), (16, "zxqv"), (17, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {(h["doc_id"], h["item_id"], h["edits"]) for h in d.contaminated(docs, benchmark).collect()}
    assert found == {(10, 1, 1), (11, 2, 0), (13, 4, 2), (14, 1, 1), (16, 5, 0)}
    assert {x["doc_id"] for x in d.decontaminate(docs, benchmark).collect()} == {12, 15, 17}
