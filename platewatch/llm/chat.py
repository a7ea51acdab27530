"""Chat formatting with typed content parts.

A turn's content is a list of parts.  A visitor flattens them in order: text is escaped, an image,
audio or document part becomes a placeholder whose reference and expanded number of tokens are
recorded.  Turns are marked by control strings; inside texts every control string is broken
by an escape, so that the formatted text can be read back exactly.

The rows of a conversation are ordered by one local sort and pass through a task as a stream: a
conversation of any length needs the memory of one turn.
"""

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewatch.llm.common import free_name

# The control strings of the template.
BEGIN, END = "<s>", "</s>"
OPEN = {"system": "[SYS]", "user": "[INST]", "assistant": "[ANSWER]", "tool": "[TOOL]"}
CLOSE = {"system": "[/SYS]", "user": "[/INST]", "assistant": "</s>", "tool": "[/TOOL]"}
OTHER, OTHER_NAME_END, OTHER_CLOSE = "[ROLE]", "[/ROLE]", "[/TURN]"
PLACE = {"image": "[IMG]", "audio": "[AUDIO]", "document": "[DOC]"}

# Every control string begins with one of these and is broken by what an escape puts after it.
_BREAK = re.compile(r"[\[<\\]")
_JOIN = re.compile(r"([\[<\\])\\")
_CONTROL = re.compile("|".join(map(re.escape, sorted({
    BEGIN, END, *OPEN.values(), *CLOSE.values(), OTHER, OTHER_NAME_END, OTHER_CLOSE, *PLACE.values()}, key=len, reverse=True))))

PATCH = 14
AUDIO_TOKENS_A_SECOND = 25
DOCUMENT_TOKENS_A_PAGE = 256

PARTS = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
FORMATTED = (
    "conv_id bigint, turn bigint, role string, formatted string, mask_start int, mask_chars int, "
    "attachments array<struct<kind:string,ref:string,tokens:int,place:int>>"
)
DIGEST = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


def escape(text: str) -> str:
    """Put a backslash after every character that can begin a control string, and after backslashes."""
    return _BREAK.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _JOIN.sub(r"\1", text)


class Flatten:
    """Visits the parts of one turn in order and gathers text and attachments."""

    def __init__(self):
        self.pieces, self.attachments, self.size = [], [], 0

    def visit(self, part: dict):
        """Parts of an unknown or missing type are read as text."""
        handler = getattr(self, f"visit_{part.get('type') or 'text'}", self.visit_text)
        handler(part)

    def visit_text(self, part):
        self._add(escape(part.get("text") or ""))

    def visit_image(self, part):
        across, down = (-(-max(1, part.get(side) or 1) // PATCH) for side in ("width", "height"))
        self._attach("image", part, across * down)

    def visit_audio(self, part):
        self._attach("audio", part, max(1, round((part.get("seconds") or 0) * AUDIO_TOKENS_A_SECOND)))

    def visit_document(self, part):
        self._attach("document", part, max(1, (part.get("pages") or 1) * DOCUMENT_TOKENS_A_PAGE))

    def _attach(self, kind, part, tokens):
        self.attachments.append({"kind": kind, "ref": part.get("ref"), "tokens": tokens, "place": self.size})
        self._add(PLACE[kind])

    def _add(self, piece):
        self.pieces.append(piece)
        self.size += len(piece)


def format_turn(role: str | None, parts: list[dict]) -> tuple[str, int, int, list[dict]]:
    """Formatted turn, start and length (code points) of its loss mask, attachments."""
    role = role or ""
    content = Flatten()
    for part in parts:
        content.visit(part)
    if role in OPEN:
        head, tail = OPEN[role], CLOSE[role]
    else:
        head, tail = f"{OTHER}{escape(role)}{OTHER_NAME_END}", OTHER_CLOSE
    body = "".join(content.pieces)
    for attachment in content.attachments:
        attachment["place"] += len(head)
    return head + body + tail, len(head), len(body) if role == "assistant" else 0, content.attachments


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text (placeholders left out) of a formatted turn."""
    first = _CONTROL.match(formatted)
    if first[0] == BEGIN:
        formatted = formatted[len(BEGIN) :]
        first = _CONTROL.match(formatted)
    if first[0] == OTHER:
        end = formatted.index(OTHER_NAME_END)
        role, body = unescape(formatted[len(OTHER) : end]), formatted[end + len(OTHER_NAME_END) : -len(OTHER_CLOSE)]
    else:
        role = next(r for r, mark in OPEN.items() if mark == first[0])
        body = formatted[len(first[0]) : -len(CLOSE[role])]
    return role, unescape(_CONTROL.sub("", body))


def formatted(rows: DataFrame, parts: str | None = None) -> DataFrame:
    """One row per turn: conv_id, turn, role, formatted, loss mask (start and length), attachments.

    Rows are ordered by turn within a conversation, ties by role and text; null turns come first,
    rows without conv_id are one conversation.  Null roles count as empty, null texts and empty lists
    as no text.  ``parts`` names an optional column of typed parts, which follow the text.  A
    conversation's first turn begins with the mark of the conversation.
    """
    first = free_name(rows, "_parts")
    content = F.col(parts).cast(PARTS) if parts else F.lit(None).cast(PARTS)
    slim = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text", content.alias(first)
    )
    ordered = slim.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "role", "text")

    def turns(batches):
        current = ()
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                own = [{"type": "text", "text": row["text"]}, *(row[first] or [])]
                text, start, size, attached = format_turn(row["role"], own)
                if current != (row["conv_id"],):
                    current, shift = (row["conv_id"],), len(BEGIN)
                    text, start = BEGIN + text, start + shift
                    for a in attached:
                        a["place"] += shift
                out.append({"conv_id": row["conv_id"], "turn": row["turn"], "role": row["role"], "formatted": text,
                            "mask_start": start, "mask_chars": size, "attachments": attached})
            yield pa.RecordBatch.from_pylist(out, _FORMATTED)

    return ordered.mapInArrow(turns, FORMATTED)


_FORMATTED = pa.schema([
    ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("formatted", pa.string()),
    ("mask_start", pa.int32()), ("mask_chars", pa.int32()),
    ("attachments", pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int32()), ("place", pa.int32())]))),
])
_DIGEST = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
])


class Digest:
    """What a conversation's formatted turns say when read back, one after the other."""

    def __init__(self, conv_id):
        self.row = {"conv_id": conv_id, "n_turns": 0, "loss_chars": 0, "formatted_chars": 0}
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted, start, size):
        role, text = read_turn(formatted)
        learned = unescape(_CONTROL.sub("", formatted[start : start + size]))
        self.turns.update(f"{role}\n{text}\n".encode("utf-8", "replace"))
        self.loss.update(learned.encode("utf-8", "replace"))
        self.row["n_turns"] += 1
        self.row["loss_chars"] += len(learned)
        self.row["formatted_chars"] += len(formatted)

    def result(self):
        return {**self.row, "turns_sha256": self.turns.hexdigest(), "loss_sha256": self.loss.hexdigest()}


def digests(turns: DataFrame) -> DataFrame:
    """One row per conversation, read back from the turns that ``formatted`` gave, in their order."""

    def read(batches):
        own, key = None, ()
        for batch in batches:
            done = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "formatted", "mask_start", "mask_chars")]
            for conv_id, text, start, size in zip(*columns):
                if key != (conv_id,):
                    if own:
                        done.append(own.result())
                    own, key = Digest(conv_id), (conv_id,)
                own.add(text, start, size)
            if done:
                yield pa.RecordBatch.from_pylist(done, _DIGEST)
        if own:
            yield pa.RecordBatch.from_pylist([own.result()], _DIGEST)

    return turns.select("conv_id", "formatted", "mask_start", "mask_chars").mapInArrow(read, DIGEST)
