"""Vector codes against plain integers; exact products of limbs."""

import hashlib
import math

import numpy as np
import pytest

from pagequarry.llm import vector_codes as C

SCHEMA = "vec_id long, embedding array<float>, label int, code int, q string, rows int"


def plain(rows, parts=16, entries=64):
    kept = [(v, [math.floor(256 * float(np.float32(x))) for x in e], lab) for v, e, lab in rows
            if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    if not kept:
        return []
    width = max(1, -(-max(len(q) for _, q, _ in kept) // parts))
    kept = [(v, q + [0] * (parts * width - len(q)), lab, q) for v, q, lab in kept]
    first = {}
    for v, q, _, raw in kept:
        if v not in first or raw < first[v][0]:
            first[v] = (raw, q)
    start = [first[v][1] for v in sorted(first, key=lambda v: (v is None, v or 0))[:entries]]
    cut = [[q[p * width:(p + 1) * width] for p in range(parts)] for _, q, _, _ in kept]
    book = [[s[p * width:(p + 1) * width] for s in start] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book[p]))

    for _ in range(2):
        chosen = [[nearest(p, x[p])[1] for p in range(parts)] for x in cut]
        for p in range(parts):
            for e in range(len(start)):
                mine = [x[p] for x, c in zip(cut, chosen) if c[p] == e]
                if mine:
                    book[p][e] = [sum(col) // len(mine) for col in zip(*mine)]
    best = [[nearest(p, x[p]) for p in range(parts)] for x in cut]
    digest = hashlib.sha256(",".join(str(v) for part in book for entry in part for v in entry).encode()).hexdigest()
    errors = [sum(d for d, _ in b) for b in best]
    by_label = {}
    for (_, _, lab, _), e in zip(kept, errors):
        by_label[lab] = by_label.get(lab, 0) + e
    return sorted(((v, "".join(f"{e:02x}" for _, e in b), err, by_label[lab], digest) for (v, _, lab, _), b, err in zip(kept, best, errors)), key=repr)


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)


def some(n, width, seed):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(x) for x in rng.normal(0, 0.3, width).astype(np.float32)], None if i % 7 == 0 else int(i % 3)) for i in rng.permutation(n)]


@pytest.mark.parametrize("n, width", [(150, 64), (20, 32), (90, 16)])
def test_codes_against_plain_integers(spark, n, width):
    rows = some(n, width, n)
    assert sorted((tuple(r) for r in C.vector_codes(vectors(spark, rows)).collect()), key=repr) == plain(rows)


def test_codes_of_odd_rows(spark):
    rows = some(70, 32, 5)
    rows += [(None, rows[0][1], None), (3, rows[1][1], 1), (3, rows[2][1], 1), (500, None, 1), (501, [1.0, None], 1), (502, [float("nan")] * 32, 2),
             (503, [float("inf")] * 32, 2), (504, [], 1), (505, [0.5] * 21, 9), (506, [-1e4] * 40, 9), (507, [9e3] * 32, None), (508, rows[0][1], 0)]
    assert sorted((tuple(r) for r in C.vector_codes(vectors(spark, rows)).collect()), key=repr) == plain(rows)
    only_bad = vectors(spark, [(1, None, 1), (2, [float("nan")], 1)])
    assert C.vector_codes(only_bad).collect() == [] and C.vector_codes(only_bad).columns == C.vector_codes(vectors(spark, rows)).columns
    assert C.vector_codes(vectors(spark, rows).where("false")).count() == 0
    assert {r.code for r in C.vector_codes(vectors(spark, [(1, [], 1), (2, [], 1)])).collect()} == {"00" * 16}


def test_products_of_limbs_are_exact():
    rng = np.random.default_rng(6)
    for top in (3, 2**20, 2**26, 2**28):
        a, b = (rng.integers(-top, top, s) for s in ((3, 50, 7), (3, 7, 9)))
        want = np.array([[[sum(int(x) * int(y) for x, y in zip(r, c)) for c in m.T] for r in k] for k, m in zip(a, b)])
        assert (C.products(a, b) == want).all()
    wide = np.array([[[2**40 + 1, -(2**40) - 3]]])
    assert C.products(wide, np.array([[[2**20 + 1], [5 - 2**20]]])).item() == (2**40 + 1) * (2**20 + 1) + (2**40 + 3) * (2**20 - 5)
    for x in (np.array([-2**62, 2**62 + 12345, -1, 0, 7]), rng.integers(-2**40, 2**40, 100)):
        assert (sum(p.astype(np.int64) << np.int64(25 * i) for i, p in enumerate(C.limbs(x, 25))) == x).all()
        assert all(np.abs(p).max() <= 2**25 for p in C.limbs(x, 25))
