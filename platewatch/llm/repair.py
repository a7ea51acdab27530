"""Conversations brought back to the form ``(system)? (user assistant)+`` by the cheapest edits.

A repair is a derivation in a weighted hypergraph.  Items are "the first i rows are read and the output
stands at state q"; an item and an edit of the next row, or an inserted turn, give another item.  The
weight is (cost, audit): costs add up and audits, one letter per edit, are joined.  Joining never makes a weight
less and keeps the order of weights, as of two audits of the same item and cost neither begins
the other.  So Knuth's agenda applies: items are popped by weight and final when popped.

A long conversation is cut into pieces of bounded size wherever its rows lie.  A piece is
derived from every state it may be entered in; pieces are joined in order.  Texts are read
once more in order, beside the audit, to give the repaired turns.
"""

import hashlib
from heapq import heapify, heappop, heappush
from itertools import count, groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewatch.llm.common import stored

KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3
PIECE = 1024

# State of the output: nothing yet, a system turn, a user turn, whole pairs; and where an initial leads.
START, SYSTEM, USER, PAIRS = range(4)
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): PAIRS, (PAIRS, "u"): USER}
WHOLE = (START, PAIRS)
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")

# A row's code: what is wrong with it, and the initial of its role.
SOUND, CUT_OFF, GONE = range(3)
INITIALS = "sua?"


def code_letter(fault: int, initial: str) -> str:
    return chr(65 + 4 * fault + INITIALS.index(initial))


def read_code(letter: str) -> tuple[int, str]:
    fault, initial = divmod(ord(letter) - 65, 4)
    return fault, INITIALS[initial]


def lightest(axioms, conclude, goals):
    """Weights of the items reached, by Knuth's generalisation of Dijkstra's method.

    ``axioms`` are (weight, item); ``conclude(item, chart)`` gives the (weight, item) that follow from an
    item and those already final.  Ends when all ``goals`` are final or nothing is left.
    """
    order = count()  # items themselves are not compared
    agenda, chart, open_goals = [(weight, next(order), item) for weight, item in axioms], {}, set(goals)
    heapify(agenda)
    while agenda and open_goals:
        weight, _, item = heappop(agenda)
        if item in chart:
            continue
        chart[item] = weight
        open_goals.discard(item)
        for weight, item in conclude(item, chart):
            if item not in chart:
                heappush(agenda, (weight, next(order), item))
    return chart


def _edits(place, letter):
    """Axioms (weight, item) for the edits of one row: what they cost, and the initial that they put out."""
    fault, initial = read_code(letter)
    yield (COST[DELETE], DELETE), (place, DELETE, "")
    if fault != GONE:
        more = TRUNCATED_COST if fault == CUT_OFF else 0
        if initial != "?":
            yield (COST[KEEP] + more, KEEP), (place, KEEP, initial)
        for other in ROLES:
            yield (COST[REROLE] + more, REROLE), (place, REROLE, other)


def derive(codes: str, enter: int = START, leave=range(4)) -> dict[int, tuple[int, str]]:
    """state -> least (cost, audit) of reading all rows, entered in one state."""
    inserts = [((COST[INSERT], INSERT), (-1, INSERT, other)) for other in ROLES]
    rows = [list(_edits(i, letter)) for i, letter in enumerate(codes)]
    edits_of = [[item for _, item in row] for row in rows]
    insert_items = [item for _, item in inserts]
    axioms = [((0, ""), (0, enter)), *inserts, *(a for row in rows for a in row)]
    states_at = [[] for _ in range(len(codes) + 1)]

    def joined(at, edit, chart):
        (place, state), (cost, audit), (more, letter) = at, chart[at], chart[edit]
        to = STEPS.get((state, edit[2])) if edit[2] else state
        if to is not None:
            yield (cost + more, audit + letter), (place if edit[0] < 0 else place + 1, to)

    def conclude(item, chart):
        if len(item) == 2:
            states_at[item[0]].append(item)
            partners = insert_items + (edits_of[item[0]] if item[0] < len(codes) else [])
            for edit in partners:
                if edit in chart:
                    yield from joined(item, edit, chart)
        else:
            for states in states_at if item[0] < 0 else states_at[item[0] : item[0] + 1]:
                for at in states:
                    yield from joined(at, item, chart)

    goals = [(len(codes), state) for state in leave]
    chart = lightest(axioms, conclude, goals)
    return {state: chart[at] for at in goals for state in at[1:] if at in chart}


def join_pieces(pieces: list[list[tuple[int, int, int, str]]]) -> tuple[int, str]:
    """Least (cost, audit) of pieces in order, each given as (enter, leave, cost, audit)."""
    best = {START: (0, "")}
    for moves in pieces:
        reached = {}
        for enter, leave, cost, audit in moves:
            if enter in best:
                weight = (best[enter][0] + cost, best[enter][1] + audit)
                if leave not in reached or weight < reached[leave]:
                    reached[leave] = weight
        best = reached
    return min(best[state] for state in WHOLE if state in best)


def apply_audit(audit: str):
    """A function that takes the next row's (role, text) and yields the turns put out up to it; None ends it."""
    place, state = 0, START

    def turn(row):
        nonlocal place, state
        while place < len(audit):
            letter = audit[place]
            if letter != INSERT and row is None:
                break
            place += 1
            due = "a" if state == USER else "u"
            if letter == INSERT:
                state = STEPS[state, due]
                yield INSERT, ROLES[due], ""
                continue
            if letter == KEEP:
                state = STEPS[state, row[0][0]]
                yield KEEP, row[0], row[1]
            elif letter == REROLE:
                state = STEPS[state, due]
                yield REROLE, ROLES[due], row[1]
            return

    return turn


def found_faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, mark, text, copies, code, fault: equal rows as one, each with what is wrong.

    ``code`` is the first copy's; the copies after it are duplicates (or blank as the first).  ``mark`` is a digest of the text.
    """
    slim = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    same = stored(slim.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies")), "equal-turns")
    same = same.withColumn("mark", F.unhex(F.md5(F.encode("text", "UTF-8"))))
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut_off = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*+\z")
    # Nulls first: false is less than true.
    when = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    first = same.groupBy(F.coalesce("conv_id", F.lit(0).cast("long")).alias("c"), F.col("conv_id").isNull().alias("c0"),
                         F.col("role").alias("r"), F.col("mark").alias("m")).agg(F.min(when).alias("first"))
    on = (F.coalesce("conv_id", F.lit(0).cast("long")) == F.col("c")) & (F.col("conv_id").isNull() == F.col("c0")) & (
        F.col("role") == F.col("r")) & (F.col("mark") == F.col("m"))
    later = ~when.eqNullSafe(F.col("first"))
    fault = F.when(blank, "blank").when(later, "duplicate").when(cut_off, "truncated").otherwise("")
    initial = F.substring("role", 1, 1)
    at = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    level = F.when(F.col("fault") == "", SOUND).when(F.col("fault") == "truncated", CUT_OFF).otherwise(GONE)
    return same.join(first, on).withColumn("fault", fault).withColumn("code", F.char(65 + 4 * level + at)).select(
        "conv_id", "turn", "role", "mark", "text", "copies", "code", "fault")


_MOVES = "array<struct<enter:int,leave:int,cost:bigint,audit:string>>"
_PIECES = f"conv_id bigint, part int, number bigint, first string, last string, illegal bigint, moves {_MOVES}"
_PIECES_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("number", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("illegal", pa.int64()),
    ("moves", pa.list_(pa.struct([("enter", pa.int32()), ("leave", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
])


def _codes(batches):
    """(conv_id, code) of every copy in order."""
    for batch in batches:
        for conv_id, code, copies in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "code", "copies"))):
            yield conv_id, code
            spare = code_letter(GONE, read_code(code)[1])
            for _ in range(copies - 1):
                yield conv_id, spare


def _illegal(initials):
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def _piece(conv_id, number, codes, begins):
    """One piece's row; ``begins`` tells that the conversation begins with it for certain."""
    moves = [{"enter": enter, "leave": leave, "cost": cost, "audit": audit}
             for enter in ((START,) if begins else range(4)) for leave, (cost, audit) in derive(codes, enter).items()]
    initials = [read_code(c)[1] for c in codes]
    return {"conv_id": conv_id, "part": TaskContext.get().partitionId(), "number": number, "first": initials[0], "last": initials[-1],
            "illegal": _illegal(initials), "moves": moves}


def _pieces(batches):
    out, number = [], 0
    for which, (conv_id, rows) in enumerate(groupby(_codes(batches), key=lambda r: r[0])):
        codes, cut = [], 0
        for _, code in rows:
            if len(codes) == PIECE:
                out.append(_piece(conv_id, number, "".join(codes), which > 0 and cut == 0))
                codes, cut, number = [], cut + 1, number + 1
            codes.append(code)
        out.append(_piece(conv_id, number, "".join(codes), which > 0 and cut == 0))
        number += 1
        if len(out) >= 256 or cut:
            yield pa.RecordBatch.from_pylist(out, _PIECES_ARROW)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, _PIECES_ARROW)


_JOINED = pa.struct([("cost", pa.int64()), ("audit", pa.string()), ("illegal", pa.int64())])


def _join(pieces: pa.Array) -> pa.Array:
    rows = []
    for scalar in pieces:
        own = scalar.as_py()
        cost, audit = join_pieces([[tuple(m.values()) for m in p["moves"]] for p in own])
        seams = sum(a["last"] + b["first"] not in LEGAL for a, b in zip(own, own[1:]))
        rows.append({"cost": cost, "audit": audit, "illegal": seams + sum(p["illegal"] for p in own)})
    return pa.array(rows, _JOINED)


_ORDER = ("conv_id", "turn", "role", "mark")


def derivations(faults: DataFrame) -> DataFrame:
    """conv_id, cost, audit, illegal (neighbouring roles that may not follow each other) per conversation."""
    slim = faults.select(*_ORDER, "code", "copies")
    ordered = slim.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    # A conversation over several ranges comes in several pieces, numbered as they follow each other.
    pieces = stored(ordered.mapInArrow(_pieces, _PIECES), "pieces")
    whole = pieces.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("part", "number", "first", "last", "illegal", "moves"))).alias("pieces"))
    join = F.arrow_udf(_join, "struct<cost:bigint,audit:string,illegal:bigint>")
    return whole.select("conv_id", join("pieces").alias("j")).select("conv_id", "j.*")


_TURNS = "conv_id bigint, place bigint, edit string, role string, text string"
_TURNS_ARROW = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])


def _repaired(batches):
    """Rows of a conversation come after its audit."""
    out, size, turn, current, place = [], 0, None, None, 0

    def put(row):
        nonlocal place, size
        for edit, role, text in turn(row):
            out.append((current, place, edit, role, text))
            place, size = place + 1, size + len(text)

    def taken():
        nonlocal out, size
        columns = [pa.array(c, f.type) for c, f in zip(zip(*out), _TURNS_ARROW)]
        out, size = [], 0
        return pa.RecordBatch.from_arrays(columns, schema=_TURNS_ARROW)

    for batch in batches:
        for conv_id, audit, role, text, copies in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text", "copies"))):
            if audit is not None:
                if turn:
                    put(None)
                turn, current, place = apply_audit(audit), conv_id, 0
            for _ in range(copies):
                put((role, text))
            if size > 1 << 20 or len(out) > 1 << 12:
                yield taken()
    if turn:
        put(None)
    if out:
        yield taken()


def repaired(faults: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, place, edit, role, text: the turns after repair, in order within each partition.

    Takes what ``found_faults`` and ``derivations`` gave.
    """
    # Texts of rows that only can be deleted are not carried.
    texts = faults.select(*_ORDER, "copies", F.when(F.col("fault").isin("blank", "duplicate"), "").otherwise(F.col("text")).alias("text"),
                          F.lit(None).cast("string").alias("audit"), F.lit(1).alias("kind"))
    heads = found.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(None).cast("binary").alias("mark"),
                         F.lit(0).cast("long").alias("copies"), F.lit("").alias("text"), "audit", F.lit(0).alias("kind"))
    both = texts.unionByName(heads).repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "kind", "turn", "role", "mark")
    return both.select("conv_id", "audit", "role", "text", "copies").mapInArrow(_repaired, _TURNS)


_DIGESTS_ARROW = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])


def digests(turns: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 (of ``role:text`` joined by newlines), read as ``repaired`` gives the turns."""

    def read(batches):
        digest, current = None, None
        for batch in batches:
            done = []
            for conv_id, place, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text"))):
                if place == 0:
                    if digest:
                        done.append((current, digest.hexdigest()))
                    digest, current = hashlib.sha256(), conv_id
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode("utf-8", "replace"))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), _DIGESTS_ARROW)], schema=_DIGESTS_ARROW)
        if digest:
            yield pa.RecordBatch.from_arrays([pa.array([current], pa.int64()), pa.array([digest.hexdigest()])], schema=_DIGESTS_ARROW)

    return turns.select("conv_id", "place", "role", "text").mapInArrow(read, "conv_id bigint, repaired_sha256 string")


def summaries(rows: DataFrame) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are taken by turn, nulls first, ties by role and then by the text's digest; equal rows are
    copies next to each other.  Rows without conv_id are one conversation.  Null roles and texts count
    as one space; a role that does not begin with s, u or a cannot be kept.  A conversation of which nothing is left
    has the digest of nothing.  No rows give no rows.
    """
    faults = stored(found_faults(rows), "faults")
    found = stored(derivations(faults), "derivations")
    copies = F.col("copies")
    fault = F.col("fault")
    # A conversation's turns first, so that a long one is not counted in one place.
    turns = faults.groupBy("conv_id", "turn").agg(
        F.sum(F.when(fault == "blank", copies).otherwise(0)).alias("blank"),
        F.sum(F.when(fault == "duplicate", copies).when(fault != "blank", copies - 1).otherwise(0)).alias("duplicate"),
        F.sum(F.when(fault == "truncated", 1).otherwise(0)).alias("truncated"))
    counts = turns.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated")])
    hashes = digests(repaired(faults, found))
    nothing = hashlib.sha256().hexdigest()
    key = F.struct(F.col("conv_id").isNull(), F.coalesce("conv_id", F.lit(0).cast("long")))
    keyed = [t.withColumn("_key", key) for t in (counts, found, hashes)]
    return keyed[0].join(keyed[1].drop("conv_id"), "_key").join(keyed[2].drop("conv_id"), "_key", "left").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults put in by a checksum of ``conv_id:turn`` (nulls: one space), for trials of the repair.

    Of twenty remainders 0 drops the row, 1 empties its text, 2 removes its ends of sentences, 3 repeats it, 4
    makes it the user's.
    """
    slim = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    which = F.col("_which")
    times = F.array_repeat(F.lit(0), F.when(which == 3, 2).otherwise(1))
    return slim.withColumn("_which", F.crc32(F.encode(name, "UTF-8")) % 20).where(which != 0).select(
        "conv_id", "turn",
        F.when(which == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(which == 1, "").when(which == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(times).alias("_time")).drop("_time")
