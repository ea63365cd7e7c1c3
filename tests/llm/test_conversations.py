"""Conversation repair against all edit sequences of small conversations, and against plain SQL over odd rows."""

import hashlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from pagequarry.llm import conversation_repair as R
from pagequarry.llm.queries import ORACLE

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
KEEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
SCHEMA = "conv_id long, turn long, role string, text string, kind int, audit string, step int, digest string"


def all_repairs(kinds, state="", cost=0, audit="", added=0):
    """(cost, audit) of every edit sequence with at most two insertions in a row."""
    if not kinds and state in ("", "a"):
        yield cost, audit
    if added < 2:
        yield from all_repairs(kinds, NEXT[state], cost + 2, audit + "I", added + 1)
    if kinds:
        kind, rest = kinds[0], kinds[1:]
        yield from all_repairs(rest, state, cost + 3, audit + "D")
        if kind != R.GONE:
            initial, cut = "sua?"[kind // 2], kind % 2
            yield from all_repairs(rest, NEXT[state], cost + 2 + cut, audit + "R")
            if (state, initial) in KEEP:
                yield from all_repairs(rest, KEEP[state, initial], cost + cut, audit + "K")


def test_audits_are_the_least_of_all_edit_sequences():
    rng = np.random.default_rng(11)
    for n in (0, 1, 2, 3, 4):
        for _ in range(40 if n else 1):
            kinds = bytes(rng.integers(0, R.GONE + 1, n).astype(np.uint8))
            assert R.audit_of(kinds) == min(all_repairs(list(kinds))), list(kinds)


def test_a_long_conversation_is_halved_again_and_again():
    rng = np.random.default_rng(12)
    kinds = bytes(rng.integers(0, R.GONE + 1, 3000).astype(np.uint8))
    cost, audit = R.audit_of(kinds)
    best = {"": (0, "")}  # one state after the other, whole audits in hand
    for kind in kinds:
        reach = {}
        for state, (c, a) in best.items():
            for added in range(3):
                for total, edits, to in [(3, "D", state)] + ([] if kind == R.GONE else [(2 + kind % 2, "R", NEXT[state])] + (
                        [(kind % 2, "K", KEEP[state, "sua?"[kind // 2]])] if (state, "sua?"[kind // 2]) in KEEP else [])):
                    made = (c + total, a + edits)
                    reach[to] = min(reach.get(to, made), made)
                c, a, state = c + 2, a + "I", NEXT[state]
        best = reach
    ends = [(c + 2 * k, a + "I" * k) for s, (c, a) in best.items() for k in [{"": 0, "a": 0, "u": 1, "s": 2}[s]]]
    assert (cost, audit) == min(ends)


def talk(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], SCHEMA)


def expected(rows):
    columns = list(zip(*rows))
    conversations = pa.table({n: pa.array(c, t) for n, c, t in zip(  # noqa: F841 - read by the SQL
        ("conv_id", "turn", "role", "text"), columns, (pa.int64(), pa.int64(), pa.string(), pa.string()))})
    db = duckdb.connect()
    db.register("conversations", conversations)
    rel = db.sql(ORACLE["op11_conversation_repair"])
    return rel.columns, sorted(rel.fetchall(), key=repr)


def test_repair_against_plain_sql_over_odd_rows(spark):
    rng = np.random.default_rng(13)
    roles = ["user", "assistant", "system", "tool", "", None, "unit", "User"]
    texts = ["Fine.", "cut", "", " \t\n", None, "Why? ", "x" * 50_000, "é😀!", "Fine.", "no end\v"]
    rows = [(int(c), None if rng.random() < 0.1 else int(rng.integers(0, 9)), roles[rng.choice(8, p=[.35, .35, .1, .04, .04, .04, .04, .04])], texts[rng.integers(10)])
            for c in rng.integers(0, 25, 220)]
    rows += [(None, 1, "user", "Hi."), (None, None, "assistant", "Yes."), (None, 1, "user", "Hi."), *[(900, t, ("user", "assistant")[t % 2], "Same.") for t in range(60)]]
    columns, want = expected(rows)
    found = R.repair_conversations(talk(spark, rows)).select(*columns).collect()
    assert sorted((tuple(r) for r in found), key=repr) == want


def test_dropped_conversations_stay_and_empty_tables_give_no_rows(spark):
    import zlib

    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:5".encode()) % 20 == 0)
    found = R.repair_conversations(talk(spark, [(gone, 5, "user", "Hi.")])).collect()
    assert [tuple(r) for r in found] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert R.repair_conversations(talk(spark, [(1, 1, "user", "x")]).where("false")).count() == 0


@pytest.mark.parametrize("batch", [1, 3])
def test_conversations_go_on_across_batches(spark, batch):
    rows = [(c, t, ("user", "assistant")[t % 2], f"{c} {t}.") for c in range(6) for t in range(11)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        columns, want = expected(rows)
        found = R.repair_conversations(talk(spark, rows)).select(*columns).collect()
        assert sorted((tuple(r) for r in found), key=repr) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
