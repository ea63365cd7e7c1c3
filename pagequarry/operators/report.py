"""Run summary, status report and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagequarry.config import STATUS_LABELS, STATUS_SYMBOLS
from pagequarry.functions import text


def with_file_counts(records: DataFrame) -> DataFrame:
    """Add md_files and csv_files, the lengths of the output lists, unless they are there."""
    for name, lists in (("md_files", "output_md"), ("csv_files", "output_csv")):
        if name not in records.columns and lists in records.columns:
            count = F.when(F.col(lists).isNotNull(), F.size(lists)).otherwise(0)
            records = records.withColumn(name, count)
    return records


def run_summary(results: DataFrame, processing_time: float | Column = 0.0) -> DataFrame:
    """One row of totals over all discovered files; ``status`` is 'skipped' for duplicates.

    Failed documents count as processed and their pages are included. ``exit_code`` is 0 when
    anything succeeded or was skipped. No files at all give one row of zeros.
    """
    taken = F.col("status") != "skipped"

    def total(name: str) -> Column:
        return F.coalesce(F.sum(F.when(taken, F.col(name))), F.lit(0))

    elapsed = processing_time if isinstance(processing_time, Column) else F.lit(float(processing_time))
    return with_file_counts(results).agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(taken).alias("processed"),
        F.count_if(F.col("status") == "completed").alias("successful"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        total("pages").alias("total_pages"),
        total("md_files").alias("total_md_files"),
        total("csv_files").alias("total_csv_files"),
        F.count_if(taken & (F.col("embeddings.status") == "completed")).alias("embedded_docs"),
        F.count_if(taken & (F.col("embeddings.status") == "failed")).alias("embedding_failures"),
    ).withColumn("processing_time", elapsed).withColumn(
        "exit_code", F.when((F.col("successful") > 0) | (F.col("skipped") > 0), 0).otherwise(1))


def embed_summary(records: DataFrame) -> DataFrame:
    return records.agg(
        F.count_if(F.col("embeddings.status") == "completed").alias("embedded_docs"),
        F.count_if(F.col("embeddings.status") == "failed").alias("embedding_failures"))


def status_label(status: Column) -> Column:
    label = F.when(F.lit(False), None)
    for key, value in STATUS_LABELS.items():
        label = label.when(status == key, value)
    return label.otherwise("Unknown")


def status_symbol(label: Column) -> Column:
    symbol = F.when(F.lit(False), None)
    for key, value in STATUS_SYMBOLS.items():
        symbol = symbol.when(label == key, value)
    return symbol


def status_report(processed: DataFrame, skipped: DataFrame) -> DataFrame:
    """Display name and status of every file: processed ones first, then skipped, each by path."""
    rows = (processed.select(F.lit(0).alias("section"), "path", "filename", "status")
            .unionByName(skipped.select(F.lit(1).alias("section"), "path", "filename",
                                        F.lit("skipped").alias("status"))))
    name = F.coalesce("filename", F.lit("Unknown"))
    return rows.select("section", "path", text.display_name(name).alias("file"),
                       status_label(F.col("status")).alias("label")).orderBy("section", "path")


def type_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("type").agg(F.count(F.lit(1)).alias("documents"))


def category_breakdown(records: DataFrame) -> DataFrame:
    """Markdown and CSV files per category, with a total line."""
    sizes = with_file_counts(records).select("category", "md_files", "csv_files")
    return (sizes.rollup("category")
            .agg(F.count(F.lit(1)).alias("documents"), F.sum("md_files").alias("md_files"), F.sum("csv_files").alias("csv_files"))
            .withColumn("category", F.coalesce("category", F.lit("total"))))


def doc_events(results: DataFrame, run_time: str, end_time: str | None = None) -> DataFrame:
    """Log rows of a run: start at ``run_time``, then skip or completion at ``end_time``, per document."""
    # Fixed texts of the log.
    start = F.concat(F.lit("Starting "), F.col("type"), F.lit(" processing: "), F.col("filename"))
    done = (F.when(F.col("status") == "skipped", "File skipped - duplicate detected (same SHA-256 hash)")
            .when((F.col("status") == "failed") & (F.col("pages") == 0), "Could not extract page information")
            .otherwise(F.concat(F.lit("Processing complete - Status: "), F.col("status"),
                                F.lit(", Pages: "), F.col("pages").cast("string"),
                                F.lit(", MD files: "), F.col("md_files").cast("string"),
                                F.lit(", CSV files: "), F.col("csv_files").cast("string"))))
    level = F.when(F.col("status") == "failed", "ERROR").otherwise("INFO")
    at = lambda t: F.lit(t).cast("timestamp_ntz").alias("ts")
    events = F.array(
        F.struct(at(run_time), F.lit(1).alias("event_no"), F.lit("INFO").alias("level"), start.alias("message")),
        F.struct(at(end_time or run_time), F.lit(2).alias("event_no"), level.alias("level"), done.alias("message")))
    return with_file_counts(results).select("doc_id", F.inline(events))


def elapsed(events: DataFrame, key: str, ts: str = "ts") -> DataFrame:
    """Seconds between the first and the last event of each key, whatever the session's time zone."""
    first, last = F.min(ts), F.max(ts)
    if isinstance(events.schema[ts].dataType, T.TimestampNTZType):
        gap = last - first
        part = lambda unit: F.extract(F.lit(unit), gap)
        seconds = (part("DAY") * 86400 + part("HOUR") * 3600 + part("MINUTE") * 60 + part("SECOND")).cast("double")
    else:
        seconds = (F.unix_micros(last) - F.unix_micros(first)) / 1e6
    return events.groupBy(key).agg(seconds.alias("seconds"), F.count(F.lit(1)).alias("events"))
