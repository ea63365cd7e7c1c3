"""Registry columns, collisions and content duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.functions import naming


def register(files: DataFrame) -> DataFrame:
    """Add doc_id, type, category and log path to files that have path and filename."""
    name = F.col("filename")
    return (files.withColumn("doc_id", naming.doc_id(name))
            .withColumn("type", naming.file_type(name))
            .withColumn("category", naming.category(name))
            .withColumn("log", naming.log_path(F.col("doc_id"))))


def last_record_wins(records: DataFrame, seq: str = "seq") -> DataFrame:
    """Of records that share a doc_id keep the last by ``seq``.

    ``max_by`` reduces each doc_id before the shuffle, so a hot id costs a row per input
    partition. Keep page texts out of the records.
    """
    fields = [c for c in records.columns if c != "doc_id"]
    return (records.groupBy("doc_id")
            .agg(F.max_by(F.struct(*fields), F.col(seq)).alias("r"))
            .select("doc_id", *[F.col(f"r.{c}").alias(c) for c in fields]))


def docid_collisions(records: DataFrame, seq: str = "seq") -> DataFrame:
    """Ids that several files share, with the count and the file that ends up in the index."""
    return (records.groupBy("doc_id")
            .agg(F.count(F.lit(1)).alias("files"),
                 F.max_by("filename", seq).alias("kept_filename"),
                 F.max(seq).alias("kept_seq"))
            .filter("files > 1"))


def content_dupes(files: DataFrame) -> DataFrame:
    """Groups of files with the same bytes; unreadable files form no group."""
    return (files.filter(F.col("hash").isNotNull()).groupBy("hash")
            .agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_doc_id"))
            .filter("copies > 1"))
