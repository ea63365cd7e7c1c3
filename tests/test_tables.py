import io

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pagequarry.operators import tables
from pagequarry.sources import tabular

CSVS = {
    "plain": "id,name,x,flag\n1,a,1.5,True\n2,b,2,False\n",
    "missing": "id,name,x,flag\n1,,NA,True\n,b,2,\n",
    "text": "a,b\n1,x\n2x,y\n",
    "exp": "a,b\n1e3,-5\n.5,+7\n",
    "empty": "a,b\n",
    "all_missing": "a,b\n,1\n,2\n",
    "inf": "a,b\ninf,1\n1.5,2\n",
}


@pytest.mark.parametrize("name", CSVS)
def test_dtypes_are_those_pandas_infers(spark, tmp_path, name):
    path = tmp_path / "t.csv"
    path.write_text(CSVS[name])
    expected = pd.read_csv(io.StringIO(CSVS[name]))
    got = tables.table_profile("t", tabular.read_csv(spark, str(path), infer=False)).orderBy("col_idx").collect()
    assert [r["dtype"] for r in got] == ["object" if t == "str" else str(t) for t in expected.dtypes]
    assert {r["rows"] for r in got} == {len(expected)} and {r["columns"] for r in got} == {len(expected.columns)}
    assert [r["missing"] for r in got] == [int(n) for n in expected.isna().sum()]


def test_cell_profile_of_many_tables(spark):
    kinds = {"i": ["1", "2"], "f": ["1", None], "b": ["true", "False"], "o": ["x", "1"], "none": []}
    cells = [(t, n, 1, "c", v) for t, vs in kinds.items() for n, v in enumerate([None, *vs])]
    got = tables.cell_profile(spark.createDataFrame(cells, "table_id string, row_no int, col_idx int, column string, value string"))
    assert {r["table_id"]: (r["dtype"], r["rows"]) for r in got.collect()} == {
        "i": ("int64", 2), "f": ("float64", 2), "b": ("bool", 2), "o": ("object", 2), "none": ("object", 0)}


def test_many_csv_files_at_once(spark):
    files = [("/a.csv", "a.csv", "h", b"id,id,\n1,x,true\n2,,false\n\n3,z,true\n"), ("/b.csv", "b.csv", "h", b"only,header\n"),
             ("/bad.csv", "bad.csv", "h", b"a\n1\n1,2\n"), ("/lab.csv", "lab.csv", "h", b"a,b\nx,1,2\ny,3,4\n"), ("/enc.csv", "enc.csv", "h", b"\xff\xff"), ("/empty.csv", "empty.csv", "h", b"")]
    df = spark.createDataFrame(files, "path string, filename string, hash string, content binary")
    out = tables.render_cell_tables(tabular.csv_cells(df), df, "now").orderBy("path").collect()
    assert [(r["path"], r["rows"], r["columns"], r["md_file"]) for r in out] == [
        ("/a.csv", 3, 3, "md/other/a.md"), ("/b.csv", 0, 2, "md/other/b.md"), ("/lab.csv", 2, 2, "md/other/lab.md")]
    assert "|   a |   b |\n|----:|----:|\n|   1 |   2 |\n|   3 |   4 |\n" in out[2]["md"]
    assert ("## Column Information\nid             int64\nid.1          object\nUnnamed: 2      bool\n\n## Sample Data (First 5 rows)\n"
            "|   id | id.1   | Unnamed: 2   |\n|-----:|:-------|:-------------|\n|    1 | x      | True         |\n"
            "|    2 | nan    | False        |\n|    3 | z      | True         |\n") in out[0]["md"]
    assert "\nNo data\n" in out[1]["md"]


def test_blank_header_is_named_in_the_profile(spark):
    df = spark.createDataFrame([(1, "x")], ["a", " "])
    assert [r["column"] for r in tables.table_profile("t", df).orderBy("col_idx").collect()] == ["a", "Unnamed: 1"]


def test_typed_columns_with_missing_cells(spark):
    df = spark.createDataFrame([(1, True, 1.0), (None, None, None)], "a int, b boolean, c double")
    assert [r["dtype"] for r in tables.table_profile("t", df).orderBy("col_idx").collect()] == ["float64", "object", "float64"]


def test_profile_markdown(spark):
    df = spark.createDataFrame([(2, "bob", 2.25), (1, "al", 17.0)], "id bigint, name string, score double")
    md = tables.profile_render("bank list.csv", df, ["id"], F.lit("ff"), "2024-01-01T00:00:00").first()["md"]
    assert md == (
        "<!--\nchunk_id: banklist_p1\nsource: bank list.csv\npage: 1\ncategory: financial\nhash: ff\n-->\n\n# bank list.csv\n\n"
        "## Summary\n- Document ID: banklist\n- Rows: 2\n- Columns: 3\n- CSV File: banklist.csv\n\n## Column Information\n"
        "id         int64\nname      object\nscore    float64\n\n## Sample Data (First 5 rows)\n"
        "|   id | name   |   score |\n|-----:|:-------|--------:|\n|    1 | al     |   17    |\n|    2 | bob    |    2.25 |\n\n"
        "## Processing Information\n- Extracted using: pandas\n- Processing timestamp: 2024-01-01T00:00:00\n")
    lines = pd.Series(["int64", "object", "float64"], index=["id", "name", "score"]).to_string()
    assert lines in md


def test_profile_markdown_without_rows(spark):
    df = spark.createDataFrame([], "id bigint, name string")
    md = tables.profile_render("x.csv", df, ["id"], F.lit(None).cast("string"), "now").first()["md"]
    assert "- Rows: 0\n- Columns: 2" in md and "\nNo data\n" in md and "hash: \n" in md


def test_sample_and_summaries(spark):
    rows = spark.createDataFrame([("t1", i, f"v{i}") for i in range(8)] + [("t2", 0, None)], "table_id string, n int, v string")
    assert tables.table_sample(rows, "table_id", ["n"]).groupBy("table_id").count().orderBy("table_id").collect() == [("t1", 5), ("t2", 1)]
    listed = spark.createDataFrame([("d", "t1", 1), ("d", "t2", 2)], "doc_id string, table_id string, table_idx int")
    named = tables.table_numbering(listed.drop("table_idx").withColumn("o", F.substring("table_id", 2, 1).cast("int")), "o")
    out = tables.table_summaries(rows, named, ["n"], ["n", "v"])
    text = out.first()["summary"]
    assert text.startswith("# Table Summaries for d\n\n## d_table1.csv\n- Rows: 8\n- Columns: 2\n### Columns Preview: n, v\n\n"
                           "|   n | v   |\n|----:|:----|\n|   0 | v0  |\n")
    assert text.endswith("---\n## d_table2.csv\n- Rows: 1\n- Columns: 2\n### Columns Preview: n, v\n\n"
                         "|   n |   v |\n|----:|----:|\n|   0 | nan |\n\n---")
    split = tables.table_summaries(rows, named, ["n"], ["n", "v"], per_part=1).orderBy("part").collect()
    assert [r["tables"] for r in split] == [1, 1] and "".join(r["summary"] for r in split) == text


def test_workbook(spark):
    sheets = {"Sheet 1": spark.range(3).toDF("a"), "Sheet1": spark.range(2).toDF("b")}
    got = tabular.workbook_sheets("doc", "other", sheets).orderBy("sheet_idx").collect()
    assert [(r["sheet_idx"], r["safe_sheet"], r["rows"], r["pages"]) for r in got] == [(1, "Sheet1", 3, 2), (2, "Sheet1", 2, 2)]
    assert tabular.workbook_rows(sheets).count() == 5


def test_csv_round_trip_keeps_quotes_and_newlines(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", now', "a"), (2, "two\nlines", "b")], "id int, t string, category string")
    tabular.write_csv(df, str(tmp_path / "out"))
    back = tabular.read_csv(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, back.select("id", "t", "category").collect())) == [(1, 'say "hi", now', "a"), (2, "two\nlines", "b")]
