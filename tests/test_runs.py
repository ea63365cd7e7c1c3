import pytest
from pyspark.sql import functions as F

from pagequarry.operators import report
from pagequarry.schemas import DOCUMENT_INDEX
from pagequarry.session import materialize, work_folder
from pagequarry.sources import stores
from pagequarry.streaming import incremental as stream

RESULT = ("path string, filename string, doc_id string, type string, status string, pages int, output_md array<string>, "
          "output_csv array<string>, embeddings struct<status string>")


def results(spark, rows):
    return spark.createDataFrame(rows, RESULT)


def test_summary_of_mixed_run(spark):
    got = report.run_summary(results(spark, [
        ("/a", "a.pdf", "a", "pdf", "completed", 3, ["1", "2", "3"], ["t"], ("completed",)),
        ("/b", "b.pdf", "b", "pdf", "failed", 2, [], [], None),
        ("/c", "c.csv", "c", "csv", "completed", None, None, None, ("failed",)),
        ("/d", "d.csv", "d", "csv", "skipped", 9, ["x"], ["y"], ("completed",))]), 2.5).first().asDict()
    assert got == dict(total_files=4, processed=3, successful=2, failed=1, skipped=1, total_pages=5, total_md_files=3,
                       total_csv_files=1, embedded_docs=1, embedding_failures=1, processing_time=2.5, exit_code=0)


def test_summary_of_nothing_and_of_skips(spark):
    none = report.run_summary(results(spark, [])).first().asDict()
    assert none.pop("exit_code") == 1 and not any(none.values()) and len(none) == 11
    skips = report.run_summary(results(spark, [("/d", "d.csv", "d", "csv", "skipped", 9, ["x"], ["y"], None)])).first()
    assert (skips["processed"], skips["skipped"], skips["total_pages"], skips["exit_code"]) == (0, 1, 0, 0)


def test_status_report(spark):
    done = results(spark, [("/b", "b.pdf", "b", "pdf", "failed", 0, [], [], None), ("/a", "x" * 40, "a", "pdf", "completed", 1, [], [], None),
                           ("/c", None, "c", "pdf", "other", 1, [], [], None)])
    skipped = results(spark, [("/0", "s.csv", "s", "csv", "completed", 1, [], [], None)])
    got = report.status_report(done, skipped)
    assert [(r["file"], r["label"]) for r in got.collect()] == [
        ("x" * 28 + "..", "OK"), ("b.pdf", "Failed"), ("Unknown", "Unknown"), ("s.csv", "Skipped")]
    assert got.select(report.status_symbol(F.col("label")).alias("s")).first()["s"] == "✅ OK"


def test_category_breakdown_has_a_total(spark):
    df = spark.createDataFrame([("legal", ["a"], []), ("legal", ["b", "c"], ["d"]), ("other", [], ["e"])],
                               "category string, output_md array<string>, output_csv array<string>")
    assert sorted(map(tuple, report.category_breakdown(df).collect())) == [("legal", 2, 3, 1), ("other", 1, 0, 1), ("total", 3, 3, 2)]


def test_events_and_elapsed(spark, tmp_path):
    ev = report.doc_events(results(spark, [("/a", "a.pdf", "a", "pdf", "completed", 1, ["m"], [], None), ("/b", "b.pdf", "b", "pdf", "failed", 0, [], [], None)]), "2024-01-01T10:00:00")
    stores.append_events(ev, str(tmp_path / "log"))
    back = spark.read.parquet(str(tmp_path / "log"))
    assert back.filter("level = 'ERROR'").select("message").first()[0] == "Could not extract page information"
    assert back.count() == 4 and str(back.first()["run_date"]) == "2024-01-01"
    times = spark.sql("select 'a' k, timestamp_ntz'2024-01-01 00:00:01.5' ts union all select 'a', timestamp_ntz'2024-01-01 00:00:03'")
    assert tuple(report.elapsed(times, "k").first()) == ("a", 1.5, 2)
    # Over a change of the clocks: wall-clock columns count as they are, instants by true time.
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        days = spark.sql("select 'a' k, timestamp_ntz'2024-03-09 12:00:00' n, timestamp_ltz'2024-03-09 12:00:00' t union all "
                         "select 'a', timestamp_ntz'2024-03-10 12:00:00.25', timestamp_ltz'2024-03-10 12:00:00.25'")
        assert report.elapsed(days, "k", "n").first()["seconds"] == 86400.25
        assert report.elapsed(days, "k", "t").first()["seconds"] == 82800.25
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_index_snapshots(spark, tmp_path):
    root = str(tmp_path / "index")
    assert stores.load_index(spark, root + "/none").count() == 0
    empty = spark.createDataFrame([], DOCUMENT_INDEX)
    first = stores.save_index(empty, root)
    one = stores.load_index(spark, first).unionByName(spark.createDataFrame([("d",)], "doc_id string"), allowMissingColumns=True)
    second = stores.save_index(one, root)
    assert first != second and stores.load_index(spark, second).count() == 1 and stores.load_index(spark, first).count() == 0
    stores.export_index_json(one, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 1


def test_markdown_stores(spark, tmp_path):
    df = spark.createDataFrame([("legal", "md/legal/a_p1.md", "one\r\ntwo\n"), ("other", "md/other/b_p1.md", "x")], "category string, md_file string, md string")
    stored = stores.store_markdown(df, str(tmp_path / "t"))
    listed = spark.createDataFrame([("md/legal/a_p1.md",), ("md/legal/gone.md",)], "md_file string")
    got = stores.attach_markdown(listed, stored)
    assert sorted(map(tuple, got.select("md_file", "md").collect())) == [("md/legal/a_p1.md", "one\ntwo\n"), ("md/legal/gone.md", None)]
    stores.export_markdown_files(df, str(tmp_path / "files"))
    assert {r["md"] for r in stores.read_markdown_files(spark, str(tmp_path / "files")).collect()} == {"one\ntwo\n", "x\n"}


def test_stream_registers_new_files_only(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "run")
    schema = "path string, filename string, length bigint, content string"

    def arrive(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))

    def run():
        stream.start_incremental(spark.readStream.schema(schema).parquet(str(source)), root).awaitTermination()
        current = stores.current_index(stores.index_log(spark, root, stream.RECORD))
        return sorted((r["doc_id"], r["path"]) for r in current.collect()), stores.index_log(spark, root, stream.RECORD).count()

    arrive(("/1/a.pdf", "a.pdf", 1, "A"), ("/1/b.csv", "b.csv", 1, "B"), ("/1/c.txt", "c.txt", 1, "C"))
    assert run() == ([("a", "/1/a.pdf"), ("b", "/1/b.csv")], 2)
    assert run()[1] == 2
    arrive(("/2/a.pdf", "a.pdf", 1, "A"), ("/2/b.csv", "b.csv", 2, "BB"), ("/2/b(.csv", "b(.csv", 3, "BBB"))
    assert run() == ([("a", "/1/a.pdf"), ("b", "/2/b.csv")], 3)


def test_stream_of_files_in_a_folder(spark, tmp_path):
    docs, root = tmp_path / "docs", str(tmp_path / "run")
    (docs / "sub").mkdir(parents=True)
    for n in ("a.pdf", "sub/b.csv", "c.txt"):
        (docs / n).write_bytes(b"x")
    for _ in range(2):
        stream.start_incremental(stream.stream_files(spark, str(docs), 1), root).awaitTermination()
    log = stores.index_log(spark, root, stream.RECORD)
    assert sorted(r["filename"] for r in log.collect()) == ["a.pdf", "b.csv"]
    assert {r["hash"] for r in log.collect()} == {__import__("hashlib").sha256(b"x").hexdigest()}


def test_replayed_batch_overwrites_itself(spark, tmp_path):
    root = str(tmp_path / "run")
    batch = spark.createDataFrame([("/1/a.pdf", "a.pdf", 1, "A")], "path string, filename string, length bigint, content string")
    register = stream.register_batch(root, stream.JobConfig())
    register(batch, 0)
    register(batch, 0)
    assert stores.index_log(spark, root, stream.RECORD).count() == 1


def test_work_folder_reads_the_session(spark, tmp_path):
    assert work_folder(spark, "x") != work_folder(spark, "x")
    kept = materialize(spark.range(5).toDF("n"), "numbers")
    assert kept.count() == 5

    class Conf(dict):
        pass

    class Cluster:
        conf = Conf({"spark.checkpoint.dir": "hdfs://shared/cp/"})

    assert work_folder(Cluster, "x").startswith("hdfs://shared/cp/x-")
    Cluster.conf = Conf({"spark.master": "yarn"})
    with pytest.raises(RuntimeError):
        work_folder(Cluster, "x")
