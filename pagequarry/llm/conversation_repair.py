"""Conversation structure repair by Hirschberg's divide and conquer.

A conversation is legal if its role initials are ``(s?(ua)+)?``, which four states read: nothing yet, after s, after u, after a. Repair is
a cheapest path of edits through them: Keep, Rerole, Delete a row, Insert a row. A stretch of rows with a known state before and behind is cut
in the middle: cost vectors over the four states come forward from its start and backward from its end, and where they add up to the least they may cross.
Of several crossings the one is taken whose edits so far are ASCII-least. Then both halves are solved alike. Only vectors are kept, never a
table of rows by states.

The state at a cut is the one right after a row was used up, before any insertion. So the edits that lead to different
states at a cut are never a prefix of one another, and to compare whole audits it is enough to rank the four states by their edits so far. The forward
pass carries that rank next to the cost.

In Spark: rows are damaged and judged by built-in functions, first occurrences are counted by groups. Tasks walk over each conversation's sorted rows
without their texts, one byte a row, and give its audit. Then the texts follow in the same order, are repaired by the audit and hashed on the way, so that no
task holds a conversation's texts. A hash of the whole is a serial result: the texts of one conversation pass through one task, row by row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.llm.hot import attach
from pagequarry.session import materialize

MODULUS = 20
RETYPE, REMOVE, ADD, CUT = 2, 3, 2, 1  # costs of Rerole, Delete, Insert, and of a truncated row that stays
NONE, SYSTEM, USER, ASSISTANT = range(4)  # states
_AFTER = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # the state that an inserted or retyped row leads to
_KEPT = {(NONE, "s"): SYSTEM, (NONE, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_INITIALS = "sua"
GONE = len(_INITIALS) * 2 + 2  # kind of a row that must be deleted; others: 2 * role + truncated, roles s, u, a and any other
_FAR = 1 << 60


def kind_of(initial: str, truncated: bool) -> int:
    at = _INITIALS.find(initial) if initial else -1
    return 2 * (at if at >= 0 else len(_INITIALS)) + truncated


def _steps(kind: int) -> dict[tuple[int, int], tuple[int, str]]:
    """Cheapest edits, ASCII-least of equals, that use up a row of this kind: by state before and after."""
    out: dict[tuple[int, int], tuple[int, str]] = {}
    for before, added in product(range(4), range(3)):
        at = before
        for _ in range(added):
            at = _AFTER[at]
        ways = [(at, REMOVE, "D")]
        if kind != GONE:
            cut, initial = CUT * (kind % 2), (_INITIALS + "?")[kind // 2]
            ways.append((_AFTER[at], RETYPE + cut, "R"))
            if (at, initial) in _KEPT:
                ways.append((_KEPT[at, initial], cut, "K"))
        for after, cost, edit in ways:
            made = (added * ADD + cost, "I" * added + edit)
            out[before, after] = min(out.get((before, after), made), made)
    return out


STEPS = [_steps(kind) for kind in range(GONE + 1)]


def forward(kinds: bytes, start: int) -> tuple[list[int], list[int]]:
    """Cost of reaching each state from ``start``, and the states' ranks by their ASCII-least edits of that cost."""
    cost, rank = [_FAR] * 4, [0] * 4
    cost[start] = 0
    for kind in kinds:
        best: list[tuple[int, int, str] | None] = [None] * 4
        for (before, after), (price, edits) in STEPS[kind].items():
            if cost[before] < _FAR:
                made = (cost[before] + price, rank[before], edits)
                if best[after] is None or made < best[after]:
                    best[after] = made
        cost = [b[0] if b else _FAR for b in best]
        order = sorted((b[1:], s) for s, b in enumerate(best) if b)
        rank = [0] * 4
        for place, (_, s) in enumerate(order):
            rank[s] = place
    return cost, rank


def backward(kinds: bytes, end: int) -> list[int]:
    """Cost of reaching ``end`` from each state."""
    cost = [_FAR] * 4
    cost[end] = 0
    for kind in reversed(kinds):
        before = [_FAR] * 4
        for (b, a), (price, _) in STEPS[kind].items():
            before[b] = min(before[b], cost[a] + price)
        cost = before
    return cost


def audit_of(kinds: bytes) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits of a conversation with these rows, the ASCII-least of equals."""
    cost, rank = forward(kinds, NONE)
    # what is missing at the end is inserted: an assistant after a user, a user and an assistant after a system row
    total, _, end = min((cost[s] + ADD * tail, rank[s], s) for s, tail in ((NONE, 0), (SYSTEM, 2), (USER, 1), (ASSISTANT, 0)))
    edits: list[str] = []
    todo = [(0, len(kinds), NONE, end)]
    while todo:
        lo, hi, start, stop = todo.pop()
        if hi - lo == 1:
            edits.append(STEPS[kinds[lo]][start, stop][1])
        elif hi > lo:
            mid = (lo + hi) // 2
            to, rank = forward(kinds[lo:mid], start)
            on = backward(kinds[mid:hi], stop)
            cross = min(range(4), key=lambda s: (to[s] + on[s], rank[s]))
            todo += [(mid, hi, cross, stop), (lo, mid, start, cross)]
    return total, "".join(edits) + "I" * {NONE: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}[end]


class Repair:
    """Applies an audit to a conversation's rows as they come; gives the repaired (role, text) rows."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, NONE

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at, self.state = self.at + 1, _AFTER[self.state]
            yield _ROLE[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "R":
            self.state = _AFTER[self.state]
            yield _ROLE[self.state], text
        elif edit == "K":
            self.state = _KEPT[self.state, role[0]]
            yield role, text


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies after damage; rows that were dropped have no copies."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    hit = F.crc32(F.concat_ws(":", *shown)) % MODULUS
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return rows.select(
        F.col("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(hit == 4, "user").otherwise(role).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).alias("copies"))


def _last_seen(text: Column) -> Column:
    """The last character but U+0020 and U+0009 to U+000D; empty if there is none."""
    return F.right(F.rtrim(text, F.lit(" \t\n\x0b\x0c\r")), F.lit(1))


_AUDITS = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_LEGAL = {"su", "ua", "au"}


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per conversation, from rows sorted by conv_id, turn, role and digest."""
    fields = [f.split()[0] for f in _AUDITS.split(", ")]
    out: list[tuple] = []

    def close() -> tuple:
        cost, audit = audit_of(bytes(kinds))
        return (held, max(turns[1] - turns[0] + 1 - turns[2], 0) if turns else 0, *faults, illegal, cost, audit)

    def packed(kind_of_id: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*out))
        types = [kind_of_id, *[pa.int64()] * 6, pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["conv_id", *fields])

    started, held, id_type = False, None, pa.int64()
    for batch in batches:
        id_type = batch.schema.field("conv_id").type
        for conv, turn, role, digest, copies, first, last in zip(*(c.to_pylist() for c in batch.columns)):
            if not started or conv != held:
                if started:
                    out.append(close())
                started, held, kinds, faults, illegal, turns, before, initial = True, conv, bytearray(), [0, 0, 0], 0, None, None, None
            for _ in range(copies):
                seen = not first or before == (turn, role, digest)
                before = (turn, role, digest)
                fault = 0 if not last else 1 if seen else 2 if last not in ".!?" else None
                if fault is not None:
                    faults[fault] += 1
                kinds.append(GONE if fault in (0, 1) else kind_of(role[:1], fault == 2))
                illegal += initial is not None and initial + role[:1] not in _LEGAL
                initial = role[:1]
                if turn is not None:
                    turns = [turn, turn, 1] if turns is None else [turns[0], turn, turns[2] + (turn != turns[1])]
        if out:
            yield packed(id_type)
            out = []
    if started:
        out.append(close())
        yield packed(id_type)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The conversations with the hash of their repaired rows, from rows sorted so that a conversation's audit comes before its texts."""
    done: list[tuple] = []

    def feed(rows: Iterable[tuple[str, str]]) -> None:
        nonlocal empty
        for role, text in rows:
            state.update(f"{'' if empty else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
            empty = False

    def close() -> tuple:
        feed(repair.inserted())
        return (*record, state.hexdigest())

    record, names, types = None, [], []
    for batch in batches:
        names = batch.schema.names[:8] + ["repaired_sha256"]
        types = [f.type for f in list(batch.schema)[:8]] + [pa.string()]
        columns = [c.to_pylist() for c in batch.columns]
        for i, (role, text, copies) in enumerate(zip(*columns[8:11])):
            if copies is None:  # the audit
                if record is not None:
                    done.append(close())
                record, state, empty = [c[i] for c in columns[:8]], hashlib.sha256(), True
                repair = Repair(record[-1])
            else:
                for _ in range(copies):
                    feed(repair.row(role, text))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names)
            done = []
    if record is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(close(), types)], names)


def repair_conversations(rows: DataFrame) -> DataFrame:
    """One row per conv_id of ``rows`` (conv_id, turn, role, text) after damage: gaps, blank, duplicate, truncated, illegal, cost, audit
    and repaired_sha256.

    Null roles and texts are one space, as are null ids and turns where the damage is drawn; a null conv_id is a conversation of its own; null turns come first.
    Rows of one turn are ordered by role, then by their text's SHA-256; of rows that are equal in all, the first is no duplicate. An empty role can't be kept.
    A conversation without rows after damage has zeros, an empty audit and the hash of nothing. An empty table gives no rows; texts may be of any length; other
    columns are ignored, whatever their names. A task holds a byte and an edit per row of a conversation, as its audit is one value.
    """
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    text_rows = damaged(rows)
    digest = F.unhex(F.sha2("text", 256))
    place = F.struct(F.col("turn").isNotNull().alias("dated"), "turn")
    slim = materialize(text_rows.select("conv_id", "turn", "role", digest.alias("digest"), "copies", _last_seen(F.col("text")).alias("last")), "rows")
    dropped = slim.where("copies = 0").select("*", F.lit(True).alias("first"))
    seen = materialize(slim.where("copies > 0").groupBy("conv_id", "role", "digest")
                       .agg(F.min(place)["turn"].alias("first_turn"), F.count(F.lit(1)).alias("rows")), "first")
    judged = (attach(slim.where("copies > 0"), seen, ["conv_id", "role", "digest"], "rows")
              .withColumn("first", F.col("turn").eqNullSafe(F.col("first_turn"))).drop("first_turn").unionByName(dropped))
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "digest"]
    audits = (judged.select("conv_id", "turn", "role", "digest", "copies", "first", "last").repartition(width, "conv_id").sortWithinPartitions(*order)
              .mapInArrow(_audits, f"conv_id {kind}, {_AUDITS}"))
    names = [f.split()[0] for f in _AUDITS.split(", ")]
    empty = [F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in _AUDITS.split(", ")]
    told = audits.select("conv_id", *names, F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
                         F.lit(None).cast("int").alias("copies"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("digest"), F.lit(0).alias("step"))
    texts = text_rows.where("copies > 0").select("conv_id", *empty, "role", "text", "copies", "turn", digest.alias("digest"), F.lit(1).alias("step"))
    return (told.union(texts).repartition(width, "conv_id").sortWithinPartitions("conv_id", "step", F.asc_nulls_first("turn"), "role", "digest")
            .mapInArrow(_hashes, f"conv_id {kind}, {_AUDITS}, repaired_sha256 string"))
