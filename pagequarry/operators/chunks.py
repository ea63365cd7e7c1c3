"""Chunking and chunk metadata."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.config import JobConfig
from pagequarry.functions import naming, text
from pagequarry.functions.splitter import split_text

_CHUNKS = pa.list_(pa.string())


def recursive_chunks(c: Column, size: int, overlap: int) -> Column:
    """Array of chunks of a text; only the text column travels to Python, row by row into Arrow's own memory."""

    @F.arrow_udf("array<string>")
    def split(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            # a text's chunks are handed to Arrow before the next one is read: no list of a batch's strings is held
            yield pa.chunked_array([pa.array([split_text(t.as_py(), size, overlap)], _CHUNKS) for t in texts] or [pa.array([], _CHUNKS)]).combine_chunks()

    return split(c)


def fixed_chunks(c: Column, size: int, overlap: int) -> Column:
    """Array of windows of ``size`` characters, each repeating the last ``overlap`` of the one before.

    A character offset costs a walk from the start of the string, so windows are cut from runs of
    64 and a long text is not walked once per window.
    """
    stride, run = max(1, size - overlap), 64
    n = F.length(c)
    last = F.when(n <= size, F.lit(0)).otherwise(F.ceil((n - size) / stride).cast("int"))

    bodies = F.transform(
        F.sequence(F.lit(0), F.floor(last / run).cast("int")),
        lambda r: F.struct(r.alias("r"), F.substr(c, r * (run * stride) + 1, F.lit((run - 1) * stride + size)).alias("body")))
    windows = F.transform(bodies, lambda b: F.transform(
        F.sequence(F.lit(0), F.least(F.lit(run - 1), last - b["r"] * run)),
        lambda i: F.substr(b["body"], i * stride + 1, F.lit(size))))
    return F.when(n > 0, F.flatten(windows)).otherwise(F.array().cast("array<string>"))


def explode_chunks(docs: DataFrame, chunks: Column, *keep: str) -> DataFrame:
    """A row per chunk with its 0-based index, length and id ``{doc_id}_chunk_{i}``."""
    rows = docs.select("doc_id", *keep, F.posexplode(chunks).alias("chunk_index", "chunk"))
    return rows.select(
        "doc_id", *keep,
        F.concat("doc_id", F.lit("_chunk_"), F.col("chunk_index").cast("string")).alias("chunk_id"),
        "chunk_index", F.length("chunk").alias("chunk_size"), "chunk")


def chunk_recursive(docs: DataFrame, content: str = "text", config: JobConfig = JobConfig()) -> DataFrame:
    return explode_chunks(docs, recursive_chunks(F.col(content), config.chunk_size, config.chunk_overlap))


def chunk_fixed(docs: DataFrame, content: str = "text", config: JobConfig = JobConfig()) -> DataFrame:
    return explode_chunks(docs, fixed_chunks(F.col(content), config.chunk_size, config.chunk_overlap))


# Chunkers by name: a text column, the size and the overlap give an array of chunks.
CHUNKERS: dict[str, Callable[[Column, int, int], Column]] = {"recursive": recursive_chunks, "fixed": fixed_chunks}


def register_chunker(name: str, chunker: Callable[[Column, int, int], Column]) -> None:
    CHUNKERS[name] = chunker


def chunk_stats(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("chunk_count"), F.sum("chunk_size").alias("chunk_chars"))


def chunk_markdown(files: DataFrame, config: JobConfig = JobConfig()) -> DataFrame:
    """Chunks of stored Markdown files (doc_id, category, hash, md_file, md), comments removed.

    The chunk's own id repeats the document id in front of the file stem; ``source_doc_id`` keeps
    the plain one. One narrow pass: no row leaves its partition.
    """
    stem = naming.stem(naming.base_name(F.col("md_file")))
    clean = text.strip(text.strip_comments(text.unix_newlines(F.col("md")), config.strict_comments))
    ready = files.select(
        F.concat("doc_id", F.lit("_"), stem).alias("doc_id"),
        F.col("doc_id").alias("source_doc_id"), F.col("md_file").alias("source_file"), "category",
        F.col("hash").alias("file_hash"), F.lit("markdown").alias("file_type"),
        naming.page_from_name(stem).alias("page"), clean.alias("clean"))
    pieces = CHUNKERS[config.chunker](F.col("clean"), config.chunk_size, config.chunk_overlap)
    return explode_chunks(ready, pieces, "source_doc_id", "source_file", "category", "file_hash",
                          "file_type", "page")


def merge_metadata(base: Column, override: Column) -> Column:
    """Merge two string maps; on equal keys the second wins."""
    kept = F.map_filter(base, lambda k, _: ~F.array_contains(F.map_keys(override), k))
    return F.map_concat(kept, override)
