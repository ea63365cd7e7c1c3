"""The keyed log against a dictionary, and what it writes and reads."""

import random

import pytest

from pagequarry.sources.keyed_log import FAN, KeyedLog


def rows_of(log):
    return sorted((r.k, r.v, r.batch_id) for r in log.latest().collect())


def test_latest_rows_after_many_upserts(spark, tmp_path):
    rng = random.Random(5)
    log = KeyedLog(spark, str(tmp_path / "t"), "k string, v long", "k")
    assert log.latest().count() == 0 and log.lookup(["a"]).count() == 0
    truth = {}
    for seq in range(1, 14):
        batch = [(f"k{rng.randrange(60):02d}", rng.randrange(1000)) for _ in range(rng.choice([1, 5, 30, 90]))]
        for k in {k for k, _ in batch}:
            truth[k] = sorted((v, seq) for kk, v in batch if kk == k)  # a key has all rows of its last upsert
        log.upsert(spark.createDataFrame(batch, "k string, v long"), seq)
        assert len(log.segments()) <= 3 * FAN
    want = sorted((k, v, s) for k, vs in truth.items() for v, s in vs)
    assert rows_of(log) == want
    some = ["k03", "k31", "none"]
    assert sorted((r.k, r.v, r.batch_id) for r in log.lookup(some).collect()) == [w for w in want if w[0] in some]
    assert rows_of(KeyedLog(spark, str(tmp_path / "t"), "k string, v long", "k")) == want


def test_an_upsert_writes_about_what_it_brings(spark, tmp_path):
    log = KeyedLog(spark, str(tmp_path / "t"), "k long, v long", "k")
    log.upsert(spark.range(10_000).selectExpr("id as k", "0L as v"), 1)
    written = [log.upsert(spark.range(100).selectExpr(f"id * 97 + {n} as k", f"{n}L as v"), n) for n in range(2, 12)]
    assert written[0] == 100 and sum(written) <= 3 * 100 * len(written)
    assert log.rows_read() <= 10_000 + 100 * len(written)
    truth = {k: 0 for k in range(10_000)}
    for n in range(2, 12):
        truth.update({i * 97 + n: n for i in range(100)})
    assert {(r.k, r.v) for r in log.latest().collect()} == set(truth.items())


def test_reads_don_t_grow_with_upserts_of_the_same_keys(spark, tmp_path):
    log = KeyedLog(spark, str(tmp_path / "t"), "k long, v long", "k")
    log.upsert(spark.range(1000).selectExpr("id as k", "0L as v"), 1)
    most = 0
    for n in range(2, 18):
        log.upsert(spark.range(50).selectExpr("id as k", f"{n}L as v"), n)
        most = max(most, log.rows_read())
    assert most <= 1000 + (FAN + 1) * 50 and log.latest().filter("v = 17").count() == 50 and log.latest().count() == 1000


def test_replays_write_nothing_and_empty_upserts_are_kept_out(spark, tmp_path):
    log = KeyedLog(spark, str(tmp_path / "t"), "k string, v long", "k")
    one = spark.createDataFrame([("a", 1), (None, 2)], "k string, v long")
    assert log.upsert(one, 5) == 2 and log.upsert(one, 5) == 0 and log.latest().count() == 2
    assert log.upsert(one.limit(0), 6) == 0 and len(log.segments()) == 1
    assert log.upsert(spark.createDataFrame([(None, 3)], "k string, v long"), 7) == 1
    assert sorted((r.k, r.v) for r in log.latest().collect() if r.k is None) == [(None, 3)] and log.latest().count() == 2
    with pytest.raises(ValueError):
        log.upsert(one, 4)


def test_a_lookup_opens_only_segments_in_range(spark, tmp_path):
    log = KeyedLog(spark, str(tmp_path / "t"), "k string, v long", "k")
    for n, (lo, hi) in enumerate([(0, 400), (500, 520), (600, 620)], 1):
        log.upsert(spark.range(lo, hi).selectExpr("lpad(id, 4, '0') as k", "id as v"), n)
    files = log.lookup(["0510"]).inputFiles()
    names = {s.segment for s in log.segments()}
    assert len(names) == 3 and len({f.split("/segments/")[1].split("/")[0] for f in files}) == 1 and log.lookup(["0510"]).count() == 1
