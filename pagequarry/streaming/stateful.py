"""Incremental registration with the index in the state store.

Each document id keeps the hash and path of its last record, and how many it had, in keyed state. A batch looks up only the ids that it brings, so its work follows the
batch and not the log of all earlier records; state and results recover together from the checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from pagequarry.operators.registry import register
from pagequarry.sources.files import fingerprint, select_supported
from pagequarry.streaming.incremental import RECORD

_FIELDS = [f.split()[0] for f in RECORD.split(", ")]
_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LOGGED = RECORD + ", version bigint"


class LastRecord(StatefulProcessor):
    """Of a batch's files of one id the last by path counts; it gives a record unless the last record has its hash. Files without a hash always do."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getValueState("last", "hash string, path string, version bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = None
        for part in rows:
            top = part.loc[[part["path"].idxmax()]]
            if best is None or top["path"].iloc[0] > best["path"].iloc[0]:
                best = top
        last = self._last.get()
        file_hash = best["hash"].iloc[0]
        if last is None or file_hash is None or file_hash != last[0]:
            version = 1 if last is None else last[2] + 1
            self._last.update((file_hash, best["path"].iloc[0], version))
            yield best[_FIELDS].assign(version=version)

    def close(self) -> None:
        pass


def start_stateful(files: DataFrame, root: str) -> StreamingQuery:
    """Register every file of a stream (path, filename, length, content) that is not known yet, then stop; run it again
    when more files have arrived. Sets the session's state store to RocksDB, which keyed state needs."""
    files.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _STORE)
    slim = register(fingerprint(select_supported(files))).select(*_FIELDS)  # contents stay where they are read
    records = slim.groupBy("doc_id").transformWithStateInPandas(LastRecord(), LOGGED, "Append", "None")
    return (records.writeStream.format("parquet").outputMode("append").option("path", f"{root}/records")
            .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())


def records(spark: SparkSession, root: str) -> DataFrame:
    """Every record ever given."""
    return spark.read.schema(LOGGED).parquet(f"{root}/records")


def current_records(spark: SparkSession, root: str) -> DataFrame:
    """The last record of each document id."""
    fields = [f for f in _FIELDS if f != "doc_id"]
    return (records(spark, root).groupBy("doc_id").agg(F.max_by(F.struct(*fields), "version").alias("r"))
            .select("doc_id", *(F.col(f"r.{f}").alias(f) for f in fields)))


