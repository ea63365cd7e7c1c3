"""Listed files: filter, routing by type, fingerprint."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.config import UNSUPPORTED_ERROR
from pagequarry.functions import naming

FILES = "path string, modificationTime timestamp, length bigint, content binary"


def scan_files(spark: SparkSession, root: str, any_case: bool = False) -> DataFrame:
    """Supported files below ``root`` by Spark's own reader, which leaves out names that begin with a dot or an underscore and holds
    each file whole; :func:`~pagequarry.sources.folder.scan_folder` has every name. A missing folder gives no rows.

    The extension filter runs while files are listed; ``content`` is read only if selected.
    """
    glob = "*.{[pP][dD][fF],[xX][lL][sS][xX],[cC][sS][vV]}" if any_case else "*.{pdf,xlsx,csv}"
    reader = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
              .option("pathGlobFilter", glob))
    try:
        return reader.load(root)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], FILES)


def select_supported(files: DataFrame) -> DataFrame:
    """The same filter over a listing that is already a table."""
    return files.filter(naming.has_supported_suffix(F.col("path")))


def route_by_type(files: DataFrame) -> DataFrame:
    """Add ``type``; unsupported files become failed rows that name the reason."""
    typed = files.withColumn("type", naming.file_type(F.col("filename")))
    unsupported = F.col("type").isNull()
    return (typed.withColumn("status", F.when(unsupported, "failed").otherwise("processing"))
            .withColumn("error", F.when(unsupported, UNSUPPORTED_ERROR)))


def fingerprint(files: DataFrame, content: str = "content") -> DataFrame:
    """Replace the content by its SHA-256, so that no later step moves it; unreadable content gives null."""
    return files.withColumn("hash", F.sha2(F.col(content).cast("binary"), 256)).drop(content)
