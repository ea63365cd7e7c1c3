"""Page Markdown: the metadata header, whole pages, and reading the header back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagequarry.functions.naming import page_name

# The five header fields in file order.
HEADER_FIELDS = ("chunk_id", "source", "page", "category", "hash")


def metadata_header(doc: Column, filename: Column, page: Column, cat: Column, file_hash: Column) -> Column:
    values = (page_name(doc, page), filename, page.cast("string"), cat, F.coalesce(file_hash, F.lit("")))
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in zip(HEADER_FIELDS, values)]
    return F.concat_ws("\n", F.lit("<!--"), *lines, F.lit("-->"))


def page_markdown(doc: Column, filename: Column, page: Column, cat: Column, file_hash: Column,
                  text: Column, method: Column, run_time: Column) -> Column:
    # Fixed layout of a page file.
    return F.concat(
        metadata_header(doc, filename, page, cat, file_hash),
        F.lit("\n\n# "), filename, F.lit(" - Page "), page.cast("string"),
        F.lit("\n\n## Content\n"), text,
        F.lit("\n\n## Processing Information\n- Document ID: "), doc,
        F.lit("\n- Extracted using: "), method,
        F.lit("\n- Text length: "), F.length(text).cast("string"), F.lit(" characters"),
        F.lit("\n- Processing timestamp: "), run_time, F.lit("\n"),
    )


def header_field(md: Column, name: str) -> Column:
    """One header field; null when the text does not start with a header."""
    value = F.regexp_extract(md, rf"^<!--\n(?:[a-z_]+: [^\n]*\n){{0,4}}?{name}: ([^\n]*)\n", 1)
    return F.when(md.startswith("<!--\n"), value)


def pipe_row(cells: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(cells, " | ", ""), F.lit(" |"))
