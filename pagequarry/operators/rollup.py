"""Per-document results, in parts of bounded size.

A document has no size limit, a row has one. Lists and texts of a document are therefore built per
``part`` of consecutive pages (or tables); nearly every document has the single part 0, and the
parts of a larger one put together in order give the whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagequarry.operators.skew import running_within

PAGES_PER_TEXT = 256
BYTES_PER_TEXT = 64 << 20
_BETWEEN = "\n\n\n"
FILES_PER_LIST = 4096


def part_of(ordinal: Column, per_part: int) -> Column:
    """0-based part of a 1-based page or table number."""
    return F.floor((ordinal - 1) / per_part).cast("int")


def ordered(order: str, value: Column) -> Column:
    """Aggregate: values as an array in ``order``."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), value.alias("v"))))
    return F.transform(pairs, lambda x: x.v)


def doc_rollup(page_results: DataFrame, table_results: DataFrame, per_part: int = FILES_PER_LIST) -> DataFrame:
    """Page count and ordered output lists per document; tables attach whatever method made them.

    ``table_results`` may come from several methods. Equal file names of two methods are both
    listed, as both are written; ``method`` tells them apart at the source.
    """
    pages = (
        page_results.withColumn("part", part_of(F.col("page"), per_part)).groupBy("doc_id", "part")
        .agg(F.count(F.lit(1)).alias("pages"), ordered("page", F.col("md_file")).alias("output_md"))
    )
    tables = (
        table_results.withColumn("part", part_of(F.col("table_idx"), per_part)).groupBy("doc_id", "part")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("method", "table_idx", "csv_file"))),
                         lambda x: x.csv_file).alias("output_csv"))
    )
    empty = F.array().cast("array<string>")
    return pages.join(tables, ["doc_id", "part"], "full").select(
        "doc_id", "part", F.coalesce("pages", F.lit(0)).alias("pages"),
        F.coalesce("output_md", empty).alias("output_md"),
        F.coalesce("output_csv", empty).alias("output_csv"))


def consolidate(rendered: DataFrame, per_part: int = PAGES_PER_TEXT) -> DataFrame:
    """Document Markdown: pages in numeric order, each under its file name, two blank lines between.

    Parts after the first start with the separator, so that joining them with nothing between
    gives the document.
    """
    block = F.concat(F.lit("# "), F.col("chunk_id"), F.lit(".md\n\n"), F.col("md"))
    joined = F.array_join(ordered("page", block), "\n\n\n")
    return (
        rendered.withColumn("part", part_of(F.col("page"), per_part)).groupBy("doc_id", "part")
        .agg(F.count(F.lit(1)).alias("pages"), joined.alias("body"))
        .select("doc_id", "part", "pages",
                F.when(F.col("part") > 0, F.concat(F.lit("\n\n\n"), "body")).otherwise(F.col("body")).alias("md"))
    )


def consolidate_bytes(rendered: DataFrame, budget: int = BYTES_PER_TEXT) -> DataFrame:
    """As :func:`consolidate`, in parts of at most ``budget`` bytes, separators included, unless a single page has more.

    Pages of over half the budget are parts of their own. The others are cut by running totals of bytes at every half budget: such a part ends less than half a
    budget behind its last cut. Pages' texts are shuffled once, to their part; the totals work on lengths alone.
    """
    half = max(1, budget // 2)
    block = F.concat(F.lit("# "), F.col("chunk_id"), F.lit(".md\n\n"), F.col("md"))
    size = F.octet_length(block) + F.lit(len(_BETWEEN))
    sized = rendered.select("doc_id", "page", size.cast("long").alias("bytes")).withColumn("large", (F.col("bytes") > half).cast("long"))
    placed = running_within(sized, "doc_id", "page", {"start": "bytes", "before": "large"})
    cut = placed.select("doc_id", "page", F.struct("before", "large", F.floor(F.col("start") / half).cast("long").alias("slot"),
                                                   F.when(F.col("large") == 1, F.col("page")).alias("own")).alias("cut"))
    order = Window.partitionBy("doc_id").orderBy("first_page")
    parts = cut.groupBy("doc_id", "cut").agg(F.min("page").alias("first_page")).withColumn("part", (F.row_number().over(order) - 1).cast("int"))
    # a cut holds at most a budget of bytes, so no key of this join is hot
    numbered = cut.join(parts, ["doc_id", "cut"]).select("doc_id", "page", "part")
    texts = rendered.select("doc_id", "page", block.alias("block")).join(numbered, ["doc_id", "page"])
    joined = F.array_join(ordered("page", F.col("block")), _BETWEEN)
    return (texts.groupBy("doc_id", "part").agg(F.count(F.lit(1)).alias("pages"), joined.alias("body"))
            .select("doc_id", "part", "pages", F.concat(F.when(F.col("part") > 0, _BETWEEN).otherwise(""), F.col("body")).alias("md")))
