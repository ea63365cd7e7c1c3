"""Membership by filter cascades against plain sets."""

import pytest
from pyspark.sql import functions as F

from pagequarry.operators import membership as M


def rows(spark, n=4000):
    data = [(i if i % 17 else None, f"t{i % 900}", "x" * 50, 1, True) for i in range(n)] + [(5, "t5", "again", 2, None)]
    return spark.createDataFrame(data, "doc_id long, text string, body string, _k0_f0 int, hit boolean").repartition(3)


@pytest.mark.parametrize("wanted, listed", [(0, 10), (3, 10), (700, 10), (700, 0), (3900, 10)])
def test_marks_are_exact(spark, wanted, listed):
    table = rows(spark)
    keys = spark.createDataFrame([(i if i % 17 else None, f"t{i % 900}") for i in range(wanted)] * 2 + [(999_999, "t1"), (3, "t4")], "a long, b string")
    known = {tuple(r) for r in keys.collect()}
    got = M.mark_members(table, [F.col("doc_id"), F.col("text")], keys, "there", listed=listed)
    assert got.columns == [*table.columns, "there"]
    found = got.collect()
    assert len(found) == 4001 and all(r.there == ((r.doc_id, r.text) in known) for r in found)


def test_beyond_the_bound_rows_are_joined(spark):
    table, keys = rows(spark), spark.range(0, 2000, 2)
    for most in (0, 1 << 20):
        found = M.mark_members(table, [F.col("doc_id")], keys, "there", most_bytes=most, listed=5).collect()
        assert all(r.there == (r.doc_id is not None and r.doc_id < 2000 and r.doc_id % 2 == 0) for r in found) and len(found) == 4001


def test_rows_are_not_moved(spark):
    """Between the scan and the result of a cascade there is no exchange but those of broadcasts."""
    table, keys = rows(spark), spark.range(0, 3000, 2)
    kept = M.without_members(table, [F.col("doc_id")], keys)
    assert kept.columns == table.columns and kept.count() == 4001 - sum(1 for i in range(4000) if i % 17 and i < 3000 and i % 2 == 0)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    there, others = M.split_members(table, [F.col("doc_id")], keys)
    assert there.count() + others.count() == 4001 and there.filter("doc_id % 2 = 1").count() == 0


def test_filters_keep_their_keys_and_few_others(spark):
    keys = spark.range(20_000).toDF("k")
    blocks = -(-20_000 * M.BITS_PER_KEY // M.BLOCK_BITS)
    bloom = M.bloom_filter(keys, blocks).cache()
    assert bloom.count() <= blocks and all(len(r.bits) * 8 == M.BLOCK_BITS for r in bloom.collect())
    assert M._passes(keys, [F.col("k")], bloom, blocks, "hit").filter("hit").count() == 20_000
    assert M._passes(spark.range(10**6, 10**6 + 20_000).toDF("k"), [F.col("k")], bloom, blocks, "hit").filter("hit").count() < 400
    assert M.mark_members(keys.limit(0), [F.col("k")], keys, "x").count() == 0
