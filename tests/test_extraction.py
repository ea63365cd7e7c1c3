from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from pagequarry.config import JobConfig
from pagequarry.operators import report
from pagequarry.plans import extraction
from pagequarry.sources import folder


@pytest.fixture()
def config(tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "Exhibit A(1).pdf").write_bytes(b"first page about apples\fsecond page about pears")
    (docs / "web report.pdf").write_bytes(b"<html><body><p>plums &amp; cherries</p></body></html>")
    (docs / "broken.pdf").write_bytes(b"\xff\xfe\xff")
    (docs / "bank.csv").write_bytes(b"day,amount\n1,2.5\n2,3\n")
    (docs / "sheet.xlsx").write_bytes(b"PK")
    (docs / "notes.txt").write_bytes(b"ignored")
    return JobConfig(input_dir=str(docs), output_dir=str(tmp_path / "build"), embed=True)


def docs_dir(tmp_path, name, body):
    (tmp_path / "docs" / name).write_bytes(body)
    return name


def by_name(run):
    return {r["filename"]: r for r in run.results.collect()}


def test_runs_over_a_folder(spark, config, tmp_path):
    assert extraction.search_run(spark, config, "apples") is None
    first = extraction.run_extraction(spark, config)
    got = by_name(first)
    assert {n: (r["status"], r["pages"], r["md_files"], r["csv_files"]) for n, r in got.items()} == {
        "Exhibit A(1).pdf": ("completed", 2, 2, 0), "web report.pdf": ("completed", 1, 1, 0), "broken.pdf": ("failed", 0, 0, 0),
        "bank.csv": ("completed", 1, 1, 1), "sheet.xlsx": ("failed", 0, 0, 0)}
    s = first.summary.first()
    assert (s["total_files"], s["processed"], s["successful"], s["failed"], s["skipped"], s["total_pages"], s["embedded_docs"], s["exit_code"]) == (5, 5, 3, 2, 0, 4, 3, 0)
    assert got["Exhibit A(1).pdf"]["embeddings"]["chunk_count"] == 2
    md = {r["md_file"]: r["md"] for r in first.markdown.collect()}
    assert set(md) == {"md/legal/ExhibitA1_p1.md", "md/legal/ExhibitA1_p2.md", "md/legal/webreport_p1.md", "md/financial/bank.md"}
    assert "## Content\nplums & cherries\n" in md["md/legal/webreport_p1.md"]
    assert "amount    float64" in md["md/financial/bank.md"]
    assert {r["doc_id"]: r["output_md"] for r in first.outputs.collect()}["ExhibitA1"] == ["md/legal/ExhibitA1_p1.md", "md/legal/ExhibitA1_p2.md"]
    assert {r["label"] for r in first.report.collect()} == {"OK", "Failed"}

    log = spark.read.parquet(f"{config.output_dir}/logs")
    assert log.count() == 10 and log.select("batch_id").distinct().count() == 1
    spent = report.elapsed(log, "doc_id").collect()
    assert len(spent) == 5 and all(r["seconds"] > 0 and r["events"] == 2 for r in spent)

    hit = extraction.search_run(spark, config, "pears", 1).first()
    assert hit["metadata"]["source_file"] == "md/legal/ExhibitA1_p2.md" and hit["metadata"]["page"] == 2
    assert hit["rank"] == 1 and "pears" in hit["content"] and hit["preview"].endswith("...")

    # A second run passes over all but the unread PDF and the workbook that nothing reads, which were not indexed.
    second = by_name(extraction.run_extraction(spark, config))
    assert {n: r["status"] for n, r in second.items()} == {
        "Exhibit A(1).pdf": "skipped", "web report.pdf": "skipped", "broken.pdf": "failed", "bank.csv": "skipped", "sheet.xlsx": "failed"}
    assert got["sheet.xlsx"]["error"] == "Unsupported file type" and got["broken.pdf"]["error"] is None

    odd = docs_dir(tmp_path, "odd [1]{2}*.pdf", b"more")
    assert by_name(extraction.run_extraction(spark, config))[odd]["status"] == "completed"

    # A changed file is processed again and replaces its vectors; a colliding name supersedes it.
    docs = tmp_path / "docs"
    (docs / "Exhibit A(1).pdf").write_bytes(b"now about quinces")
    (docs / "ExhibitA1.pdf").write_bytes(b"and about figs")
    third = by_name(extraction.run_extraction(spark, config))
    assert (third["Exhibit A(1).pdf"]["status"], third["ExhibitA1.pdf"]["status"]) == ("superseded", "completed")
    # Searches among some chunks only, and the index as JSON lines.
    few = extraction.search_run(spark, config, "quinces", 5, F.col("category") == "financial")
    assert {r["metadata"]["source_file"] for r in few.collect()} == {"md/financial/bank.md"}
    extraction.export_index(spark, config, str(tmp_path / "index.json"))
    assert {r["doc_id"]: r["status"] for r in spark.read.json(str(tmp_path / "index.json")).collect()}.items() >= {("ExhibitA1", "completed"), ("bank", "completed")}
    sources = {r["chunk"] for r in extraction.stored_vectors(spark, config).filter("source_doc_id = 'ExhibitA1'").collect()}
    assert len(sources) == 1 and "figs" in sources.pop()


def test_every_name_gives_a_row_and_files_are_read_in_packs(spark, config, monkeypatch, tmp_path):
    docs = tmp_path / "docs"
    (docs / "_dir").mkdir()
    for name in ("_x.pdf", ".x.pdf", "_dir/y.pdf"):
        (docs / name).write_bytes(name.encode())
    monkeypatch.setattr(folder, "PACK_FILES", 2)
    run = extraction.run_extraction(spark, config)
    s = run.summary.first()
    assert (s["total_files"], s["successful"], s["failed"]) == (8, 6, 2)
    assert {n for n, r in by_name(run).items() if r["status"] == "completed"} >= {"_x.pdf", ".x.pdf", "y.pdf"}
    name = docs_dir(tmp_path, "more.pdf", b"more")
    again = by_name(extraction.run_extraction(spark, config))
    assert again[name]["status"] == "completed" and again["_x.pdf"]["status"] == "skipped"
    assert extraction.search_run(spark, config, "apples", 1).first()["metadata"]["page"] == 1


def test_sheets_tables_and_csv_files_of_a_run(spark, config, tmp_path):
    docs_dir(tmp_path, "sheet.xlsx", b'{"Data (1)": [["a", "b"], [1, null], [2, "x,y"]], "Empty": [], "Only head": [["h"]]}')
    docs_dir(tmp_path, "bad book.xlsx", b"not a workbook")
    docs_dir(tmp_path, "Exhibit A(1).pdf", "intro\n| k | v |\n| --- | --- |\n| é | 1 |\n\f| only |\nend".encode())
    run = extraction.run_extraction(spark, replace(config, embed=False, sheet_source="json", table_methods=("pipes",)))
    got = by_name(run)
    assert {n: (r["status"], r["pages"], r["md_files"], r["csv_files"]) for n, r in got.items()} == {
        "Exhibit A(1).pdf": ("completed", 2, 2, 2), "web report.pdf": ("completed", 1, 1, 0), "broken.pdf": ("failed", 0, 0, 0),
        "bank.csv": ("completed", 1, 1, 1), "sheet.xlsx": ("completed", 2, 2, 2), "bad book.xlsx": ("failed", 0, 0, 0)}
    out = {r["doc_id"]: r["output_csv"] for r in run.outputs.collect()}
    assert out["sheet"] == ["csv/other/sheet_Data1.csv", "csv/other/sheet_Onlyhead.csv"] and out["bank"] == ["csv/financial/bank.csv"]
    body = {name: (tmp_path / "build" / name).read_text() for names in out.values() for name in names}
    assert body == {"csv/other/sheet_Data1.csv": 'a,b\n1,\n2,"x,y"\n', "csv/other/sheet_Onlyhead.csv": "h\n", "csv/financial/bank.csv": "day,amount\n1,2.5\n2,3\n",
                    "csv/legal/ExhibitA1_table1.csv": "k,v\né,1\n", "csv/legal/ExhibitA1_table2.csv": "only\n"}
    md = {r["md_file"]: r["md"] for r in run.markdown.collect()}
    assert "# sheet.xlsx - Sheet: Data (1)\n" in md["md/other/sheet_Data1.md"] and "No data" in md["md/other/sheet_Onlyhead.md"]
    again = by_name(extraction.run_extraction(spark, replace(config, embed=False, sheet_source="json", table_methods=("pipes",))))
    assert again["sheet.xlsx"]["status"] == "skipped"


def test_empty_folder(spark, tmp_path):
    run = extraction.run_extraction(spark, JobConfig(input_dir=str(tmp_path / "none"), output_dir=str(tmp_path / "out")))
    s = run.summary.first()
    assert (s["total_files"], s["total_pages"], s["exit_code"]) == (0, 0, 1) and run.report.count() == 0


def test_embedding_with_nothing_to_embed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    config = JobConfig(input_dir=str(tmp_path / "in"), output_dir=str(tmp_path / "out"), embed=True)
    run = extraction.run_extraction(spark, config)
    assert run.results.count() == 0 and run.summary.count() == 1


def test_unclosed_tags_take_linear_time(spark):
    import time

    from pagequarry.functions.text import html_to_text

    page = spark.createDataFrame([("a <script " * 100_000 + "b <" * 10_000,)], "t string")
    started = time.time()
    assert page.select(html_to_text(page.t)).first()[0]
    assert time.time() - started < 20
