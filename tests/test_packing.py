"""Parts by bytes: none over the budget but single pages, and together the same text."""

import random

import pytest

from pagequarry.operators import rollup, skew


@pytest.mark.parametrize("budget", [1, 40, 200, 5000])
def test_parts_by_bytes(spark, budget):
    rng = random.Random(budget)
    rows = [(d, p, f"{d}_p{p}", "\u00e9" * rng.choice([0, 3, 30, 90]) + "x" * rng.randrange(20)) for d in ("a", "b", "c") for p in range(1, {"a": 2, "b": 60, "c": 2500}[d])]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id string, page int, chunk_id string, md string")
    got = rollup.consolidate_bytes(frame, budget).collect()
    whole = {d: "\n\n\n".join(f"# {c}.md\n\n{m}" for _, p, c, m in sorted(r for r in rows if r[0] == d)) for d in ("a", "b", "c")}
    for d in whole:
        parts = sorted((r.part, r.pages, r.md) for r in got if r.doc_id == d)
        assert [p for p, *_ in parts] == list(range(len(parts))) and "".join(m for *_, m in parts) == whole[d]
        assert all(len(m.encode()) <= budget or n == 1 for _, n, m in parts)
        assert all(n > 0 for _, n, _ in parts) and (budget > 40 or len(parts) == sum(r[0] == d for r in rows))


def test_running_sums_cross_runs(spark):
    frame = spark.createDataFrame([(i % 3, i, i * 2) for i in range(500)], "k int, n int, v int")
    got = skew.running_within(frame, "k", "n", {"before": "v"}, bucket=16).collect()
    assert all(r.before == sum(2 * j for j in range(r.n) if j % 3 == r.k) for r in got) and len(got) == 500
