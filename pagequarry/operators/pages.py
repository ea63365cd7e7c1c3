"""Page rows: scan, metadata, text estimates, extractor choice, rendering."""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagequarry.functions import markdown, naming, text
from pagequarry.functions.html import html_text
from pagequarry.operators.skew import join_salted

# A page extractor turns document content into an array of page texts; null when it cannot.
Extractor = Callable[[Column], Column]


def page_rows(source: DataFrame, doc: Column, page: Column, content: Column) -> DataFrame:
    """doc_id, page, text and text_length from any table that has a row per page."""
    body = F.coalesce(content, F.lit(""))
    return source.select(doc.cast("string").alias("doc_id"), page.cast("int").alias("page"),
                         body.alias("text"), F.length(body).alias("text_length"))


def pages_from_array(docs: DataFrame, pages: str = "pages") -> DataFrame:
    """Page rows from documents that hold an array of page texts; numbering needs no shuffle."""
    rows = docs.select("doc_id", F.posexplode(pages).alias("pos", "raw"))
    return page_rows(rows, F.col("doc_id"), F.col("pos") + 1, F.col("raw"))


def nonblank_pages(pages: DataFrame) -> DataFrame:
    stripped = pages.withColumn("text", text.strip(F.col("text")))
    return stripped.filter("text != ''").withColumn("text_length", F.length("text"))


def page_enriched(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """Attach document columns to page rows; a document of many pages is split over tasks."""
    return join_salted(pages, docs, "doc_id", F.col("page"))


def page_estimate(pages: DataFrame, full_texts: DataFrame) -> DataFrame:
    """Give pages without text their share of the lines of the whole document text.

    Each document text is cut once into as many slices as it has pages, so no text is repeated per
    page; pages that have text take no part in the join. Pages beyond the lines stay empty.
    """
    counts = pages.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("text_length") == 0).alias("blank"))
    lines = F.split(F.col("text"), "\n", -1)
    per_page = F.greatest(F.lit(1), F.floor(F.size("lines") / F.col("n")).cast("int"))
    slices = (
        full_texts.join(counts.filter("blank > 0"), "doc_id")
        .select("doc_id", "n", lines.alias("lines"))
        .withColumn("step", per_page)
        .select("doc_id", F.posexplode(F.transform(
            F.sequence(F.lit(1), F.col("n").cast("int")),
            lambda p: F.array_join(F.slice("lines", (p - 1) * F.col("step") + 1, F.col("step")), "\n"),
        )).alias("pos", "estimate"))
        .select("doc_id", (F.col("pos") + 1).alias("page"), "estimate")
    )
    with_text = pages.filter("text_length > 0").withColumn("estimated", F.lit(False))
    filled = (
        pages.filter("text_length = 0").select("doc_id", "page")
        .join(slices, ["doc_id", "page"], "left")
        .select("doc_id", "page", F.coalesce("estimate", F.lit("")).alias("text"))
        .withColumn("text_length", F.length("text")).withColumn("estimated", F.lit(True))
    )
    return with_text.select("doc_id", "page", "text", "text_length", "estimated").unionByName(filled)


def estimate_blank_pages(page_texts: Column, full_text: Column) -> Column:
    """The same rule inside one row: an array of page texts with its blanks filled from the whole text."""
    n = F.size(page_texts)
    found = F.transform(F.array(F.split(full_text, "\n", -1)), lambda ls: F.struct(
        ls.alias("lines"), F.greatest(F.lit(1), F.floor(F.size(ls) / n).cast("int")).alias("step")))
    return F.flatten(F.transform(found, lambda f: F.transform(page_texts, lambda t, i: F.when(
        F.length(t) > 0, t).otherwise(F.array_join(F.slice(f["lines"], i * f["step"] + 1, f["step"]), "\n")))))


def choose_extractor(pages: DataFrame) -> DataFrame:
    """Of page rows by several methods keep, per document, all rows of the first method.

    ``priority`` orders the methods, 1 first; a method counts as successful for a document when it
    has rows for it. The choice is per document, never per page.
    """
    best = pages.groupBy("doc_id").agg(F.min("priority").alias("priority"))
    winners = join_salted(pages.select("doc_id", "priority", "method", "page", "text", "text_length"),
                          best, ["doc_id", "priority"], F.col("page"))
    return winners


_HTML = re.compile(r"\s*<(?:!doctype html|html)\b", re.IGNORECASE)


_TEXTS = pa.list_(pa.string())


@F.arrow_udf(T.ArrayType(T.StringType()))
def scanned_html_pages(content: pa.Array) -> pa.Array:
    """One page of text from HTML, read in one pass whatever is left open in it; null for anything else. A content at a time leaves Arrow's memory."""
    texts = (c.as_py() for c in content)
    texts = (None if c is None else bytes(c).decode("utf-8", "replace") for c in texts)
    return pa.chunked_array([pa.array([[html_text(t)] if t is not None and _HTML.match(t) else None], _TEXTS) for t in texts], _TEXTS).combine_chunks()


def html_pages(content: Column) -> Column:
    """The same by built-in patterns, for pages that close what they open: takes quadratic time where they don't."""
    c = content.cast("string")
    return F.when(c.rlike(r"(?i)^\s*<(?:!doctype html|html)\b"), F.array(text.html_to_text(c)))


def text_pages(content: Column) -> Column:
    """Pages of plain UTF-8 text; a form feed starts a new page."""
    return F.when(F.is_valid_utf8(content), F.split(content.cast("string"), "\f", -1))


EXTRACTORS: dict[str, Extractor] = {"html": scanned_html_pages, "html_patterns": html_pages, "text": text_pages}


def register_extractor(name: str, extract: Extractor) -> None:
    """Make a page extractor available by name; a Python one is a pandas UDF giving array<string>."""
    EXTRACTORS[name] = extract


def extract_pages(docs: DataFrame, methods: list[str], estimate: bool = False) -> DataFrame:
    """Page rows of documents: ``content`` becomes method, page, text and text_length.

    With ``estimate`` a page without text gets its share of the lines of the whole content, if that is text and has some.

    Per document the first method that yields pages gives all of them; a document no method can
    read gives no rows. A method is tried where those before it gave nothing, as a condition inside
    the row, so falling back moves no content. (A Python method still sees every row.)
    """
    keep = [c for c in docs.columns if c != "content"]
    texts, method = F.lit(None).cast("array<string>"), F.lit(None).cast("string")
    tried = docs
    for i, name in enumerate(methods):
        # A column of its own each time: Spark then evaluates the extractor once per row.
        tried = tried.withColumn(f"_raw{i}", F.when(texts.isNull(), EXTRACTORS[name](F.col("content"))))
        got = F.size(f"_raw{i}") > 0
        tried = tried.withColumn(f"_texts{i}", F.when(got, F.col(f"_raw{i}")))
        texts = F.coalesce(texts, F.col(f"_texts{i}"))
        method = F.coalesce(method, F.when(F.col(f"_texts{i}").isNotNull(), name))
    if estimate:
        whole = F.when(F.is_valid_utf8("content"), F.translate(F.col("content").cast("string"), "\f", "\n"))
        blank = F.exists(texts, lambda t: F.coalesce(F.length(t), F.lit(0)) == 0) & (F.size(texts) > 1)
        filled = estimate_blank_pages(F.transform(texts, lambda t: F.coalesce(t, F.lit(""))), whole)
        texts = F.when(whole.isNotNull() & blank & (method == "text"), filled).otherwise(texts)
    # The outer form, since the plain one is planned with a filter that evaluates the extractors again.
    rows = tried.select(*keep, method.alias("method"), F.posexplode_outer(texts).alias("pos", "raw")).filter("pos is not null")
    body = F.coalesce("raw", F.lit(""))
    return rows.select(*keep, "method", (F.col("pos") + 1).alias("page"), body.alias("text"), F.length(body).alias("text_length"))


def render_pages(pages: DataFrame, method: Column, run_time: str, *keep: str) -> DataFrame:
    """Page Markdown for enriched pages (doc_id, page, text, filename, category, hash)."""
    name = naming.page_name(F.col("doc_id"), F.col("page"))
    return pages.select(
        *keep, "doc_id", "page", "category", "hash", name.alias("chunk_id"),
        naming.md_path(F.col("category"), name).alias("md_file"), "text_length",
        markdown.page_markdown(F.col("doc_id"), F.col("filename"), F.col("page"), F.col("category"),
                               F.col("hash"), F.col("text"), method, F.lit(run_time)).alias("md"))


def parse_metadata(rendered: DataFrame) -> DataFrame:
    fields = [markdown.header_field(F.col("md"), f).alias(f) for f in markdown.HEADER_FIELDS]
    return (rendered.select(*fields).withColumn("page", F.col("page").try_cast("int"))
            .filter(F.col("chunk_id").isNotNull()))
