from itertools import product

from pyspark.sql import functions as F

from pagequarry.operators import pages, rollup

PAGE = "doc_id string, page int, text string, text_length int"


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_page_rows_from_arrays(spark):
    docs = spark.createDataFrame([("d", ["one", None, "é😀"])], "doc_id string, pages array<string>")
    assert rows(pages.pages_from_array(docs), "page", "text", "text_length") == [(1, "one", 3), (2, "", 0), (3, "é😀", 2)]


def test_nonblank(spark):
    df = spark.createDataFrame([("d", i, t, len(t)) for i, t in enumerate(["", "  ", " ", "\t", "\n", " x "])], PAGE)
    assert rows(pages.nonblank_pages(df), "page", "text", "text_length") == [(5, "x", 1)]


def test_page_estimate_against_line_arithmetic(spark):
    texts, page_rows, expected = [], [], []
    for total, n in product([1, 2, 5, 7, 12], [1, 2, 3, 5, 9]):
        doc, lines = f"{total}-{n}", [f"line {i}" for i in range(total)]
        texts.append((doc, "\n".join(lines)))
        per = max(1, total // n)
        for p in range(1, n + 1):
            own = "own" if p % 3 == 0 else ""
            page_rows.append((doc, p, own, len(own)))
            expected.append((doc, p, own or "\n".join(lines[(p - 1) * per:min(p * per, total)])))
    got = pages.page_estimate(spark.createDataFrame(page_rows, PAGE), spark.createDataFrame(texts, "doc_id string, text string"))
    assert rows(got, "doc_id", "page", "text") == sorted(expected)


def test_page_estimate_inside_a_row(spark):
    given, expected = [], []
    for total, n in product([1, 2, 5, 7, 12], [1, 2, 3, 5, 9]):
        lines, per = [f"line {i}" for i in range(total)], max(1, total // n)
        own = ["own" if p % 3 == 0 else "" for p in range(1, n + 1)]
        given.append((len(given), own, "\n".join(lines)))
        expected.append([t or "\n".join(lines[p * per:min((p + 1) * per, total)]) for p, t in enumerate(own)])
    df = spark.createDataFrame(given, "i int, own array<string>, full string")
    got = df.select("i", pages.estimate_blank_pages(F.col("own"), F.col("full")).alias("p")).orderBy("i").collect()
    assert [r["p"] for r in got] == expected


def test_estimate_without_full_text_stays_empty(spark):
    got = pages.page_estimate(spark.createDataFrame([("d", 1, "", 0)], PAGE), spark.createDataFrame([], "doc_id string, text string"))
    assert rows(got, "text", "text_length") == [("", 0)]


def test_choice_is_per_document(spark):
    tries = [("a", 2, "layout", 1, "A", 1), ("a", 3, "basic", 1, "x", 1), ("a", 3, "basic", 2, "y", 1), ("b", 3, "basic", 1, "B", 1)]
    df = spark.createDataFrame(tries, "doc_id string, priority int, method string, page int, text string, text_length int")
    assert rows(pages.choose_extractor(df), "doc_id", "page", "method") == [("a", 1, "layout"), ("b", 1, "basic")]


def test_fallback_takes_the_first_method_that_reads(spark):
    docs = spark.createDataFrame([("h", b"<html><p>hi</p></html>"), ("t", b"p1\fp2"), ("x", b"\xff\xfe"), ("n", None)], "doc_id string, content binary")
    got = pages.extract_pages(docs, ["html", "text"])
    assert rows(got, "doc_id", "page", "text", "method") == [("h", 1, "hi", "html"), ("t", 1, "p1", "text"), ("t", 2, "p2", "text")]


def test_python_extractor(spark):
    @F.pandas_udf("array<string>")
    def shout(c):
        return c.map(lambda b: [b.decode().upper()] if b.startswith(b"!") else None)

    pages.register_extractor("shout", shout)
    docs = spark.createDataFrame([("a", b"!go"), ("b", b"calm")], "doc_id string, content binary")
    assert rows(pages.extract_pages(docs, ["shout", "text"]), "doc_id", "text", "method") == [("a", "!GO", "shout"), ("b", "calm", "text")]


def rendered(spark, n):
    df = spark.createDataFrame([("doc", i, f"doc_p{i}", f"text {i}") for i in range(1, n + 1)], "doc_id string, page int, chunk_id string, md string")
    return df.repartition(3)


def test_consolidated_parts_join_to_the_whole(spark):
    whole = "\n\n\n".join(f"# doc_p{i}.md\n\ntext {i}" for i in range(1, 24))
    one = rollup.consolidate(rendered(spark, 23)).collect()
    assert [(r["part"], r["pages"], r["md"]) for r in one] == [(0, 23, whole)]
    parts = rollup.consolidate(rendered(spark, 23), per_part=5).orderBy("part").collect()
    assert len(parts) == 5 and "".join(r["md"] for r in parts) == whole


def test_rollup_orders_pages_and_attaches_tables(spark):
    p = spark.createDataFrame([("a", 10, "a10"), ("a", 2, "a2"), ("b", 1, "b1")], "doc_id string, page int, md_file string")
    t = spark.createDataFrame([("a", "stream", 1, "t1"), ("a", "layout", 2, "t2"), ("a", "layout", 1, "t1"), ("c", "stream", 1, "c1")],
                              "doc_id string, method string, table_idx int, csv_file string")
    got = {r["doc_id"]: (r["pages"], r["output_md"], r["output_csv"]) for r in rollup.doc_rollup(p, t).collect()}
    assert got == {"a": (2, ["a2", "a10"], ["t1", "t2", "t1"]), "b": (1, ["b1"], []), "c": (0, [], ["c1"])}


def test_render_and_parse(spark):
    df = spark.createDataFrame([("d", 3, "body", 4, "my d.pdf", "legal", None)], PAGE + ", filename string, category string, hash string")
    out = pages.render_pages(df, F.lit("X"), "now")
    assert rows(out, "chunk_id", "md_file") == [("d_p3", "md/legal/d_p3.md")]
    assert rows(pages.parse_metadata(out), "chunk_id", "source", "page", "category", "hash") == [("d_p3", "my d.pdf", 3, "legal", "")]


def test_blank_pages_of_a_run_get_their_share_of_the_text(spark):
    docs = spark.createDataFrame([("a", b"one\ntwo\f\f\nthree"), ("b", b"full\fpages"), ("c", b"\f"), ("d", b"")], "doc_id string, content binary")
    got = {(r.doc_id, r.page): r.text for r in pages.extract_pages(docs, ["html", "text"], estimate=True).collect()}
    assert got == {("a", 1): "one\ntwo", ("a", 2): "two", ("a", 3): "\nthree", ("b", 1): "full", ("b", 2): "pages", ("c", 1): "", ("c", 2): "", ("d", 1): ""}
    assert {(r.doc_id, r.page): r.text for r in pages.extract_pages(docs, ["text"]).collect()}["a", 2] == ""
