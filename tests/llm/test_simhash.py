"""SimHash near-dedup against plain versions; cells are proved complete on random pairs."""

import re

import numpy as np
import pytest
import xxhash

from pagequarry.llm import simhash_dedup as S

SCHEMA = "doc_id long, text string, lang string, print int, cell string, root long, rows int, _hot_0 int"


def plain_print(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(g.encode(), 42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [plain_print(t) for _, t, *_ in rows]
    root = list(range(len(rows)))
    for _ in range(len(rows)):
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 4:
                    root[i] = root[j] = min(root[i], root[j])
    least = {}
    for (d, *_), r in zip(rows, root):
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return sorted(((d, f"{p:016x}", least.get(r)) for (d, *_), p, r in zip(rows, prints, root)), key=repr)


def docs(spark, rows):
    return spark.createDataFrame([(*r, 1, "c", 2, 3, 4) for r in rows], SCHEMA)


def near_rows():
    rng = np.random.default_rng(1)
    rows = []
    for g in range(8):
        base = [f"W{g}-{i}" for i in range(150)]
        for c in range(10):
            w = list(base)
            for k in rng.choice(150, c // 2, replace=False):
                w[k] = f"new{g}-{c}-{k}"
            rows.append((100 * g + c, " ".join(w).lower() if c % 3 else "\n".join(w), "en"))
    return rows + [(None, rows[3][1], None), (5000, None, "en"), (4000, "", "en"), (None, " \t", "en"), (4001, "one two", "en"), (4001, "three Four five", "fr"),
                   (4002, "a b c d " * 40_000, "en"), (7, rows[55][1], "en")]


@pytest.mark.parametrize("held", [S.HELD, 8])
def test_simhash_against_brute_force(spark, held, monkeypatch):
    monkeypatch.setattr(S, "NEAR_ROWS", S.NEAR_ROWS if held > 8 else 4)
    rows = near_rows()
    found = S.simhash_dedup(docs(spark, rows), held=held).collect()
    want = brute(rows)
    assert len({w[2] for w in want}) < len(rows) - 20
    assert sorted((tuple(r) for r in found), key=repr) == want


def test_a_full_cell_is_compared_in_blocks(spark):
    """Prints that differ in few bits of one half share cells; with a small bound they are set aside and found again."""
    rng = np.random.default_rng(3)
    base = np.uint64(0x0123456789ABCDEF)
    prints = np.unique([base ^ np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, n, replace=False).astype(np.uint64)) for n in rng.integers(1, 7, 300)])
    entered = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "print long").mapInArrow(S._enter, "cell bigint, print bigint")
    full = entered.groupBy("cell").count().where("count > 40").select(entered["cell"].alias("full"))
    assert not full.isEmpty()
    got = S._full_cells(entered, full, 4, 40).collect()
    joined = {(r.a, r.b) for r in got}
    cells = {}
    for r in entered.join(full, entered["cell"] == full["full"]).collect():
        cells.setdefault(r.cell, []).append(r.print)
    root = {int(p): int(p) for p in prints.view(np.int64)}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in joined:
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= 4
        root[max(find(a), find(b))] = min(find(a), find(b))
    for members in cells.values():
        for a in members:
            for b in members:
                if ((a ^ b) & (2**64 - 1)).bit_count() <= 4:
                    assert find(a) == find(b)


def test_every_pair_within_the_distance_shares_a_cell():
    rng = np.random.default_rng(2)
    for n in range(6):
        for _ in range(200):
            a = rng.integers(0, 2**64, 1, dtype=np.uint64)
            b = a.copy()
            for bit in rng.choice(64, n, replace=False):
                b ^= np.uint64(1) << np.uint64(bit)
            share = [np.concatenate([c for c, _ in S.cells(x)]) for x in (a, b)]
            assert np.isin(*share).any()


def test_simhash_of_an_empty_table_and_wrong_distance(spark):
    assert S.simhash_dedup(docs(spark, near_rows()).where("false")).count() == 0
    with pytest.raises(ValueError):
        S.simhash_dedup(docs(spark, near_rows()), distance=6)
