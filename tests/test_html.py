"""The HTML scanner: plain pages against the patterns, odd pages, and time on pages that leave everything open."""

import random
import time

import pytest

from pagequarry.functions import text
from pagequarry.functions.html import html_text
from pagequarry.operators import pages


def test_plain_pages_agree_with_the_patterns(spark):
    rng = random.Random(9)

    def block(depth=0):
        kind = rng.choice(["p", "div", "ul", "b", "a", "span", "h2", "text", "text", "comment", "script", "style", "br"])
        if kind == "text" or depth > 4:
            return rng.choice(["some  words", "a &amp; b", "x &lt; y &gt; z", "caf\u00e9\t&quot;q&quot;", "it&#39;s&nbsp;so", "\n  line\n\n"])
        if kind == "comment":
            return "<!-- <b>no</b> - -->"
        if kind in ("script", "style"):
            return f"<{kind} type='x'>if (a && b) {{ '<p>' }}</{kind}>"
        if kind == "br":
            return rng.choice(["<br>", "<br/>", "<BR />"])
        inside = "".join(block(depth + 1) for _ in range(rng.randrange(4)))
        return f"<{kind} class='k{depth}' id=i>{inside}</{kind}>"

    made = ["<!DOCTYPE html><html><head><title>T</title></head><body>" + "".join(block() for _ in range(12)) + "</body></html>" for _ in range(150)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(made)], "i int, t string")
    want = {r.i: r.w for r in frame.select("i", text.html_to_text(frame.t).alias("w")).collect()}
    assert {i: html_text(t) for i, t in enumerate(made)} == want


@pytest.mark.parametrize("page, want", [
    ("", ""), ("no tags", "no tags"), ("<p title='a > b' data-x=\"</p>\">in</p>", "in"), ("a < b and 3 <4", "a < b and 3 <4"), ("<p>open <b", "open <b"),
    ("&#233;&#xe9;&eacute;&copy;&unknown;&#0;", "\u00e9\u00e9\u00e9\u00a9&unknown;\ufffd"), ("&amp;lt;", "&lt;"), ("<script>left open <p>text", "left open\ntext"), ("<!-- left open <p>text", "<!-- left open\ntext"),
    ("<SCRIPT>x</ScRiPt>y", "y"), ("<style>a</style><script>b</script>c", "c"), ("<script src='x'/>kept", "kept"), ("x<!---->y", "x y"), ("<?xml version='1'?><p>t", "t"), ("\u0130<p>\u0130</p>", "\u0130\n\u0130"),
    ("<p x='1>one</p>", "one"), ("</p>a</nothing>b", "ab"), ("<td>1</td><td>2</td><tr><td>3", "12\n3"),
])
def test_odd_pages(page, want):
    assert html_text(page) == want


@pytest.mark.parametrize("piece", ["<script>", "<!--", "<a x=\"<a\" ", "<a b='", "<", "<a ", "<style>x</style", "<a x=\"\" ", "<a x='<b y=\"'>", "<a x=\"<a\" <", "</script", "&#", "<!", "\"<a x="])
def test_a_megabyte_of_anything_takes_under_two_seconds(piece):
    page = piece * (1_000_000 // len(piece))
    started = time.time()
    html_text(page)
    html_text(page + ">")
    assert time.time() - started < 4


def test_the_extractor_of_a_run(spark):
    docs = spark.createDataFrame([("h", b"<html><p title='>'>hi &eacute;</p></html>"), ("t", b"p1\fp2"), ("x", b"<html>\xff</html>"), ("n", None)], "doc_id string, content binary")
    got = {(r.doc_id, r.page): (r.text, r.method) for r in pages.extract_pages(docs, ["html", "text"]).collect()}
    assert got == {("h", 1): ("hi \u00e9", "html"), ("t", 1): ("p1", "text"), ("t", 2): ("p2", "text"), ("x", 1): ("\ufffd", "html")}
