import re
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagequarry.functions import markdown, naming, text
from pagequarry.functions.pipe_table import render_table


def apply(spark, values, fn):
    """fn over a column of strings, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["out"] for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


NAMES = ["a b(1).pdf", "ab1.pdf", "é٣².csv", "x" * 120 + ".pdf", ".csv", "a.b.pdf", "no_suffix",
         "two  spaces.PDF", "dot.", "..csv", "ünï-code_9.xlsx", "日本語.pdf", "tab\tname.csv"]


def test_doc_id(spark):
    expected = ["".join(c for c in Path(n).stem if c.isalnum() or c in "._-")[:100] for n in NAMES]
    assert apply(spark, NAMES, naming.doc_id) == expected
    assert expected[0] == expected[1] == "ab1"


def test_category_first_match_wins(spark):
    names = ["Transcript of bank.pdf", "embankment.csv", "exhibit statement.pdf", "REPORT.xlsx", "Affidavit.pdf", "x.pdf"]
    assert apply(spark, names, naming.category) == ["transcript", "financial", "financial", "legal", "legal", "other"]


def test_file_type(spark):
    assert apply(spark, ["a.pdf", "a.PDF", "a.xlsx", "a.csv", "a.txt", "pdf", ".pdf"], naming.file_type) == [
        "pdf", "pdf", "excel", "csv", None, None, None]


def test_page_from_name(spark):
    stems = ["a_p3", "a_p3_x", "a_part", "a_p", "a_p1_p12", "a", "a_p07", "a_p-2", "a_p3.7", "a_p1e2"]
    assert apply(spark, stems, naming.page_from_name) == [3, 3, None, None, 12, None, 7, -2, None, None]


def test_output_names(spark):
    row = spark.range(1).select(
        naming.md_path(F.lit("legal"), naming.page_name(F.lit("d"), F.lit(3))).alias("md"),
        naming.csv_path(F.lit("other"), naming.table_name(F.lit("d"), F.lit(2))).alias("csv"),
        naming.sheet_output_name(F.lit("d"), F.lit("Q1 (a)")).alias("sheet"), naming.log_path(F.lit("d")).alias("log")).first()
    assert tuple(row) == ("md/legal/d_p3.md", "csv/other/d_table2.csv", "d_Q1a", "logs/d.log")


def test_whitespace_is_what_python_strips():
    import sys
    assert set(text.WHITESPACE) == {chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()}


def test_strip(spark):
    values = ["", "  ", " ", "\t", "\n", " a b　", "\x1c x \x85", "plain"]
    assert apply(spark, values, text.strip) == [v.strip() for v in values]
    assert apply(spark, values, text.is_blank) == [not v.strip() for v in values]


def kept_lines(md, strict=True):
    """Line by line: what the comment rules keep."""
    kept, opened = [], False
    for line in md.split("\n"):
        s = line.strip()
        if s.startswith("<!--"):
            opened = strict or not s.endswith("-->")
        elif s.endswith("-->"):
            opened = False
        elif not opened:
            kept.append(line)
    return "\n".join(kept)


COMMENTS = ["<!--\na: b\n-->\nbody", "<!-- x -->\nlost\n-->\nkept", "stray -->\nkept", "  <!--\n x\n\t--> \nkept",
            "a\n<!-- open\nb\nc", "", "\n\n", "a", "<!--", "-->", "a\n-->\nb\n<!--\nc\n<!--\nd -->\ne",
            "text <!-- inline --> more\nnext", "<!--\n<!-- y -->\nstill in\n-->\nout", "a\r\n<!--\r\nb\r\n-->\r\nc",
            "x --> y\nz", "<!-- a\n" + "line\n" * 50000 + "--> \nend"]


def test_strip_comments(spark):
    assert apply(spark, COMMENTS, text.strip_comments) == [kept_lines(c) for c in COMMENTS]
    lenient = apply(spark, COMMENTS, lambda c: text.strip_comments(c, strict=False))
    assert lenient == [kept_lines(c, strict=False) for c in COMMENTS]
    assert lenient[1] == "lost\nkept"


@settings(max_examples=20, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<!--", "-->", "a", " ", "\t", " "]), max_size=4).map("".join), max_size=9))
def test_strip_comments_any_lines(spark, lines):
    # One Spark call per example is slow, so each example carries all rotations of its lines.
    mds = ["\n".join(lines[i:] + lines[:i]) for i in range(len(lines) + 1)]
    assert apply(spark, mds, text.strip_comments) == [kept_lines(m) for m in mds]


def test_unix_newlines(spark):
    assert apply(spark, ["a\r\nb\rc\n"], text.unix_newlines) == ["a\nb\nc\n"]


def test_html_to_text(spark):
    html = "<html><head><style>p{}</style><script>var t='</p>';</script></head><body><p>One &amp; two</p><!-- gone --><br/>Three&nbsp;<b>four</b></body></html>"
    assert apply(spark, [html], text.html_to_text) == ["One & two\nThree four"]


def test_display_name_and_preview(spark):
    assert apply(spark, ["x" * 30, "y" * 31], text.display_name) == ["x" * 30, "y" * 28 + ".."]
    assert apply(spark, ["short", "z" * 300], text.preview) == ["short...", "z" * 200 + "..."]


def test_page_markdown_and_header(spark):
    cols = dict(doc="sample", filename="sample.pdf", cat="other", file_hash="0" * 64, text="hello", method="Converter", run_time="2024-01-01T00:00:00")
    md = spark.range(1).select(markdown.page_markdown(page=F.lit(1), **{k: F.lit(v) for k, v in cols.items()}).alias("md"))
    expected = (f"<!--\nchunk_id: sample_p1\nsource: sample.pdf\npage: 1\ncategory: other\nhash: {'0' * 64}\n-->\n\n"
                "# sample.pdf - Page 1\n\n## Content\nhello\n\n## Processing Information\n- Document ID: sample\n"
                "- Extracted using: Converter\n- Text length: 5 characters\n- Processing timestamp: 2024-01-01T00:00:00\n")
    assert md.first()["md"] == expected
    fields = md.select(*[markdown.header_field(F.col("md"), f).alias(f) for f in markdown.HEADER_FIELDS]).first()
    assert tuple(fields) == ("sample_p1", "sample.pdf", "1", "other", "0" * 64)
    assert apply(spark, ["no header"], lambda c: markdown.header_field(c, "page")) == [None]


def test_pipe_table_layout():
    # The layout pandas documents for to_markdown().
    assert render_table(["animal"], ["object"], [["elk"], ["quetzal"]]) == "| animal   |\n|:---------|\n| elk      |\n| quetzal  |"
    assert render_table(["n", "x"], ["int64", "float64"], [["1", "1.5"], ["20", "17.0"]]) == (
        "|   n |    x |\n|----:|-----:|\n|   1 |  1.5 |\n|  20 | 17   |")


@pytest.mark.parametrize("pattern", [p for p, _ in text.HTML_RULES])
def test_html_patterns_are_plain_regexes(pattern):
    re.compile(pattern)
