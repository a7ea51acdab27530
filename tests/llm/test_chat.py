import hashlib
from collections import defaultdict

from hypothesis import given
from hypothesis import strategies as st

from platewatch.llm import chat, queries

TEXT = st.text() | st.lists(st.sampled_from(["[INST]", "[/INST]", "</s>", "<s>", "\\", "[", "<", "[IMG]", "[ROLE]", "a", "\n"])).map("".join)


@given(TEXT)
def test_escape_hides_controls_and_comes_back(text):
    hidden = chat.escape(text)
    assert not chat._CONTROL.search(hidden) and chat.unescape(hidden) == text


@given(st.sampled_from(["user", "assistant", "system", "tool", "", None]) | TEXT, TEXT)
def test_a_turn_comes_back(role, text):
    shown, start, size, _ = chat.format_turn(role, [{"type": "text", "text": text}])
    assert chat.read_turn(shown) == (role or "", text) == chat.read_turn(chat.BEGIN + shown)
    assert chat.unescape(shown[start : start + size]) == (text if role == "assistant" else "")


def test_parts_become_placeholders_in_order():
    parts = [{"type": "text", "text": "see [x]"}, {"type": "image", "ref": "i", "width": 28, "height": 15}, {"type": None, "text": " and "},
             {"type": "audio", "ref": "a", "seconds": 2.0}, {"type": "document", "ref": None, "pages": 3}, {"type": "video", "text": "?"}]
    shown, start, _, attached = chat.format_turn("user", parts)
    assert shown == "[INST]see [\\x][IMG] and [AUDIO][DOC]?[/INST]"
    assert [(a["kind"], a["ref"], a["tokens"]) for a in attached] == [("image", "i", 4), ("audio", "a", 50), ("document", None, 768)]
    assert [shown[a["place"] :].startswith(chat.PLACE[a["kind"]]) for a in attached] == [True] * 3


def digest(rows):
    """By conversation, as the contract says it."""
    turns, loss = defaultdict(str), defaultdict(str)
    counts = defaultdict(int)
    for conv, _, role, text in rows:
        turns[conv] += f"{role or ''}\n{text or ''}\n"
        loss[conv] += (text or "") if role == "assistant" else ""
        counts[conv] += 1
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return {c: (counts[c], sha(turns[c]), len(loss[c]), sha(loss[c])) for c in turns}


def read_back(frame):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in frame.collect()}


def test_query_against_plain_hashing(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").orderBy("conv_id", "turn").collect()]
    probe = "</s>[INST] ok [/INST]"
    expected = digest(rows + [(-1, 0, "user", probe), (-1, 1, "assistant", probe)])
    assert read_back(queries.QUERIES["op10_chat"](spark, folder)) == expected


def test_awkward_rows(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", None), (1, 1, "user", None), (1, None, "system", ""), (None, 5, None, "x"),
            (2, 0, "odd]role", "</s>"), (2, 0, "assistant", "y" * 100_000), (3, 1, "assistant", "é😀")]
    rows += [(9, i, "user", "same") for i in range(30_000)]
    table = spark.createDataFrame([(*r, "z") for r in rows], "conv_id bigint, turn bigint, role string, text string, _parts string")
    ordered = sorted(rows, key=lambda r: (r[0] or -1, -1 if r[1] is None else r[1], r[2] or "", r[3] or ""))
    assert read_back(chat.digests(chat.formatted(table.repartition(5)))) == digest(ordered)
    assert chat.digests(chat.formatted(table.where("false"))).count() == 0
    sizes = {r["conv_id"]: r["formatted_chars"] for r in chat.digests(chat.formatted(table)).collect()}
    assert sizes[3] == len("<s>[ANSWER]é😀</s>")
