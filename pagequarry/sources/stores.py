"""Stored tables of a run: index snapshots, Markdown, event log, vectors."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pagequarry.functions import text
from pagequarry.operators.registry import last_record_wins
from pagequarry.schemas import DOCUMENT_INDEX


def load_index(spark: SparkSession, path: str, schema: StructType = DOCUMENT_INDEX) -> DataFrame:
    """The stored index, or an empty one when nothing has been stored yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def save_index(index: DataFrame, root: str) -> str:
    """Write one new snapshot and return its path; the snapshot being read is never overwritten."""
    path = f"{root.rstrip('/')}/snapshot-{uuid.uuid4().hex}"
    index.write.mode("errorifexists").parquet(path)
    return path


def index_log(spark: SparkSession, root: str, record: str) -> DataFrame:
    """Every record ever written below ``root``, with the batch that wrote it.

    A run adds its own folder and rewrites nothing, unlike an index kept in one file.
    """
    return load_index(spark, f"{root}/index", spark.createDataFrame([], record + ", batch_id bigint").schema)


def current_index(log: DataFrame) -> DataFrame:
    """The latest record of each doc_id."""
    return last_record_wins(log, "batch_id").drop("batch_id")


def export_index_json(index: DataFrame, path: str) -> None:
    index.write.mode("overwrite").json(path)


def store(df: DataFrame, path: str, *partition_by: str, mode: str = "overwrite") -> DataFrame:
    """Write a table and return it as read back; one without rows reads back empty."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_markdown(pages: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Rendered pages, a row each, partitioned by category, with the line ends a text-mode read
    gives. Needs category, md_file and md."""
    return store(pages, path, "category", mode=mode).withColumn("md", text.unix_newlines(F.col("md")))


def export_markdown_files(pages: DataFrame, path: str) -> None:
    """One text file per page in category folders, for small corpora that people browse.

    Each page is one row, so ``partitionBy`` on the file name gives each its own folder; a corpus
    of many pages belongs in :func:`store_markdown`. The writer ends each file with a line feed,
    as every rendered page does, so that one is taken off first.
    """
    body = F.when(F.col("md").endswith("\n"), F.expr("left(md, length(md) - 1)")).otherwise(F.col("md"))
    (pages.select("category", "md_file", body.alias("value"))
     .write.mode("overwrite").partitionBy("category", "md_file").text(path))


def read_markdown_files(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files below ``path`` as ``source_file`` and ``md``."""
    return (spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
            .select(F.input_file_name().alias("source_file"),
                    text.unix_newlines(F.col("value")).alias("md")))


def attach_markdown(listed: DataFrame, stored: DataFrame) -> DataFrame:
    """Listed files with their text; ``md`` is null for those missing from the store."""
    return listed.join(stored.select("md_file", "md"), "md_file", "left")


def append_events(events: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Add log events; a rerun of the same day replaces nothing. With a ``batch_id`` they get a folder
    of their own, which a retry of that batch writes anew."""
    folder, mode = (path, "append") if batch_id is None else (f"{path}/batch_id={batch_id}", "overwrite")
    (events.withColumn("run_date", F.to_date("ts"))
     .write.mode(mode).partitionBy("run_date").parquet(folder))


def append_vectors(vectors: DataFrame, path: str) -> None:
    vectors.write.mode("append").parquet(path)
