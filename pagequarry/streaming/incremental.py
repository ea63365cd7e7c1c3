"""Incremental registration of a stream of files.

Batch ``n`` writes the folder ``batch_id=n`` of the index log and reads only the batches before it. A
batch that is replayed after a failure therefore computes the same records and overwrites its
own folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagequarry.config import JobConfig
from pagequarry.functions.naming import base_name
from pagequarry.operators.incremental import incremental_new
from pagequarry.operators.registry import last_record_wins, register
from pagequarry.sources.files import FILES, fingerprint, select_supported
from pagequarry.sources.stores import current_index, index_log

RECORD = "doc_id string, path string, filename string, type string, category string, log string, length bigint, hash string"
_FIELDS = [f.split()[0] for f in RECORD.split(", ")]


def register_batch(root: str, config: JobConfig) -> Callable[[DataFrame, int], None]:
    def run(batch: DataFrame, batch_id: int) -> None:
        files = register(fingerprint(select_supported(batch))).select(*_FIELDS)
        winners = last_record_wins(files, "path")
        earlier = index_log(batch.sparkSession, root, RECORD).filter(F.col("batch_id") < batch_id)
        # Only the records of ids in this batch matter; the log itself is not shuffled when they are few.
        known = current_index(earlier.join(winners.select("doc_id"), "doc_id", "left_semi"))
        new = incremental_new(winners, known, config)
        new.select(*_FIELDS).write.mode("overwrite").parquet(f"{root}/index/batch_id={batch_id}")

    return run


def stream_files(spark: SparkSession, root: str, files_per_batch: int = 100_000) -> DataFrame:
    """Supported files as they arrive below a folder."""
    raw = (spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", "true")
           .option("pathGlobFilter", "*.{pdf,xlsx,csv}").option("maxFilesPerTrigger", str(files_per_batch)).load(root))
    return raw.select("path", base_name(F.col("path")).alias("filename"), "length", "content")


def start_incremental(files: DataFrame, root: str, config: JobConfig = JobConfig()) -> StreamingQuery:
    """Register every file of a stream (path, filename, length, content) that is not yet indexed,
    then stop; run it again when more files have arrived."""
    return (files.writeStream.foreachBatch(register_batch(root, config))
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True).start())
