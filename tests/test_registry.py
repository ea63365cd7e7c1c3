from pyspark.sql import functions as F

from pagequarry.config import JobConfig
from pagequarry.operators import incremental, registry
from pagequarry.operators.skew import join_salted, number_within
from pagequarry.sources import files as sources

FILE = "path string, doc_id string, hash string"
INDEX = "doc_id string, hash string, status string"


def keys(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_scan_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name, body in {"a.pdf": b"one", "sub/b.csv": b"x\n1\n", "sub/c.xlsx": b"z", "d.PDF": b"upper", "e.txt": b"no"}.items():
        (tmp_path / name).write_bytes(body)
    scan = sources.scan_files(spark, str(tmp_path))
    names = {r["path"].rsplit("/", 1)[1]: r["length"] for r in scan.select("path", "length").collect()}
    assert names == {"a.pdf": 3, "b.csv": 4, "c.xlsx": 1}
    assert sources.scan_files(spark, str(tmp_path), any_case=True).count() == 4
    assert sources.scan_files(spark, str(tmp_path / "missing")).count() == 0
    import hashlib
    hashed = sources.fingerprint(scan.select("path", "content")).collect()
    assert {r["hash"] for r in hashed} == {hashlib.sha256(b).hexdigest() for b in (b"one", b"x\n1\n", b"z")}


def test_route_by_type(spark):
    df = sources.route_by_type(spark.createDataFrame([("a.PDF",), ("b.txt",)], "filename string"))
    assert keys(df, "filename", "type", "status", "error") == [
        ("a.PDF", "pdf", "processing", None), ("b.txt", None, "failed", "Unsupported file type")]


def test_duplicate_rule(spark):
    index = spark.createDataFrame([("same", "h1", "completed"), ("changed", "h2", "completed"), ("broken", "h4", "failed"), ("unreadable", None, "failed")], INDEX)
    files = spark.createDataFrame([
        ("/same", "same", "h1"), ("/changed", "changed", "h3"), ("/renamed", "renamed", "h1"),
        ("/broken", "broken", "h4"), ("/unreadable", "unreadable", None)], FILE)
    new = incremental.incremental_new(files, index)
    assert keys(new, "path") == [("/changed",), ("/renamed",), ("/unreadable",)]
    assert keys(incremental.incremental_skipped(files, index), "path") == [("/broken",), ("/same",)]
    retry = incremental.incremental_new(files, index, JobConfig(retry_failed=True))
    assert ("/broken",) in keys(retry, "path")
    by_hash = incremental.incremental_new(files, index, JobConfig(duplicate_rule="hash"))
    assert keys(by_hash, "path") == [("/changed",), ("/unreadable",)]
    assert keys(incremental.duplicate_lookup(files, index), "path", "status") == [("/broken", "failed"), ("/same", "completed")]


def test_copies_inside_a_run_are_processed_once(spark):
    files = spark.createDataFrame([("/1/x", "x", "h"), ("/2/x", "x", "h"), ("/3/x", "x", "h2")], FILE)
    empty = spark.createDataFrame([], INDEX)
    assert keys(incremental.incremental_new(files, empty), "path") == [("/2/x",), ("/3/x",)]
    assert keys(incremental.incremental_skipped(files, empty), "path") == [("/1/x",)]


def test_second_run_finds_nothing_new(spark):
    files = spark.createDataFrame([(f"/{i}", f"d{i % 5}", f"h{i % 5}") for i in range(20)], FILE)
    empty = spark.createDataFrame([], INDEX)
    first = registry.last_record_wins(files, "path").withColumn("status", F.lit("completed"))
    index = incremental.index_upsert(empty, first.select("doc_id", "hash", "status"))
    assert index.count() == 5
    assert incremental.incremental_new(files, index).count() == 0
    assert incremental.incremental_skipped(files, index).count() == 20


def test_upsert_replaces_by_id(spark):
    old = spark.createDataFrame([("a", "1", "completed"), ("b", "2", "failed")], INDEX)
    new = spark.createDataFrame([("b", "3", "completed"), ("c", "4", "completed")], INDEX)
    assert keys(incremental.index_upsert(old, new), "doc_id", "hash") == [("a", "1"), ("b", "3"), ("c", "4")]


def test_collisions_and_dupes(spark):
    rec = spark.createDataFrame([(1, "ab1", "a b(1).pdf", "h"), (2, "ab1", "ab1.pdf", "h"), (3, "c", "c.pdf", None), (4, "d", "d.pdf", None)],
                                "seq int, doc_id string, filename string, hash string")
    assert keys(registry.docid_collisions(rec), "doc_id", "files", "kept_filename") == [("ab1", 2, "ab1.pdf")]
    assert keys(registry.last_record_wins(rec), "doc_id", "filename")[0] == ("ab1", "ab1.pdf")
    assert keys(registry.content_dupes(rec), "hash", "copies", "first_doc_id") == [("h", 2, "ab1")]


def test_hot_key_is_numbered_and_joined_in_pieces(spark):
    rows = [("hot", i * 3) for i in range(5000)] + [(f"k{i}", i) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, o int").repartition(4)
    got = {(r["k"], r["o"]): r["n"] for r in number_within(df, "k", "o", "n", bucket=64).collect()}
    assert all(got[("hot", i * 3)] == i + 1 for i in range(5000))
    assert all(got[(f"k{i}", i)] == 1 for i in range(200))
    small = spark.createDataFrame([("hot", 1), ("k3", 2)], "k string, v int")
    assert join_salted(df, small, "k", F.col("o")).count() == 5001
    assert join_salted(df, small, "k", F.col("o"), how="left").filter("v is null").count() == 199
