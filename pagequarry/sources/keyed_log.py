"""A keyed table as a log of sorted segments that are merged by size.

An upsert writes its own rows as one segment, sorted by key, and a small manifest; nothing else is touched. When ``FAN`` segments are of one size class, they
are merged into one and rows that newer ones replaced are left out, so each row is written again a logarithmic number of times and a read never sees more than a few segments.
Segments carry Parquet's own key statistics and Bloom filters, so a lookup of few keys opens few row groups. A key may have many rows: those of its latest upsert count.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pagequarry.operators.membership import without_members

FAN = 4  # segments of one size class that are merged
SEQ = "batch_id"
_MANIFEST = "segment string, first_seq bigint, last_seq bigint, rows bigint, low string, high string"


@dataclass(frozen=True)
class Segment:
    segment: str
    first_seq: int
    last_seq: int
    rows: int
    low: str | None
    high: str | None

    @property
    def size_class(self) -> int:
        return int(math.log(max(self.rows, 1), FAN) + 1e-9)


class KeyedLog:
    """The table below ``root``: rows of ``schema`` keyed by ``key``, with the number of the upsert that wrote them."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType | str, key: str):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        base = schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema
        self.schema = StructType([f for f in base.fields if f.name != SEQ]).add(SEQ, "long")

    def segments(self) -> list[Segment]:
        """Those of the latest manifest, the oldest first."""
        try:
            manifests = self.spark.read.schema(_MANIFEST + ", version bigint").parquet(f"{self.root}/manifest")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return []
        version = manifests.agg(F.max("version")).first()[0]
        rows = manifests.filter(F.col("version") == version).drop("version").collect()  # a few segments
        return sorted((Segment(*r) for r in rows if r["segment"] is not None), key=lambda s: s.last_seq)

    def _commit(self, segments: list[Segment]) -> None:
        try:
            last = self.spark.read.schema("version bigint").parquet(f"{self.root}/manifest").agg(F.max("version")).first()[0]
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            last = None
        rows = [(s.segment, s.first_seq, s.last_seq, s.rows, s.low, s.high) for s in segments]
        (self.spark.createDataFrame(rows or [(None,) * 6], _MANIFEST).coalesce(1)
         .write.mode("errorifexists").parquet(f"{self.root}/manifest/version={(last or 0) + 1:09d}"))

    def _write(self, rows: DataFrame, first_seq: int, last_seq: int) -> Segment:
        name = f"{last_seq}-{uuid.uuid4().hex[:8]}"
        path = f"{self.root}/segments/{name}"
        (rows.select(*self.schema.names).repartitionByRange(F.col(self.key)).sortWithinPartitions(self.key)
         .write.option(f"parquet.bloom.filter.enabled#{self.key}", "true").parquet(path))
        k = F.col(self.key).cast("string")
        n, low, high = self._read([name]).agg(F.count(F.lit(1)), F.min(k), F.max(k)).first()  # one row
        return Segment(name, first_seq, last_seq, n, low, high)

    def _read(self, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.root}/segments/{n}" for n in names))

    def _newest(self, rows: DataFrame) -> DataFrame:
        """Rows of the latest upsert of their key; the number is combined by key before it is joined back."""
        last = rows.groupBy(self.key).agg(F.max(SEQ).alias("_last")).withColumnRenamed(self.key, "_of")
        return rows.join(last, rows[self.key].eqNullSafe(F.col("_of")) & (F.col(SEQ) == F.col("_last"))).drop("_of", "_last")

    def upsert(self, rows: DataFrame, seq: int) -> int:
        """Write the rows as upsert number ``seq``; returns the number of rows written, merges included. An upsert whose number is
        there already is a replay and writes nothing."""
        held = self.segments()
        if any(s.first_seq <= seq <= s.last_seq for s in held):
            return 0
        if held and seq < held[-1].last_seq:
            raise ValueError("upserts are numbered upwards")
        new = self._write(rows.withColumn(SEQ, F.lit(seq).cast("long")), seq, seq)
        held, written = held + ([new] if new.rows else []), new.rows
        while True:
            # the newest segments up to the last one of the fullest small class: merged segments stay next to each other in time
            tail = next((held[i:] for i in range(len(held)) if len(held) - i >= FAN
                         and all(s.size_class <= held[i].size_class for s in held[i:])
                         and sum(s.size_class == held[i].size_class for s in held[i:]) >= FAN), None)
            if tail is None:
                break
            merged = self._write(self._newest(self._read([s.segment for s in tail])), tail[0].first_seq, tail[-1].last_seq)
            held, written = held[:len(held) - len(tail)] + [merged], written + merged.rows
        self._commit(held)
        return written

    def latest(self) -> DataFrame:
        """The rows that count now. The largest segment is read as it lies; only newer ones are shuffled, and their keys taken out of it."""
        held = self.segments()
        if not held:
            return self._read([])
        top = max(range(len(held)), key=lambda i: held[i].rows)
        older, newer = [s.segment for s in held[:top + 1]], [s.segment for s in held[top + 1:]]
        base = self._read(older) if len(older) == 1 else self._newest(self._read(older))
        if not newer:
            return base
        fresh = self._newest(self._read(newer))
        return without_members(base, [F.col(self.key)], fresh.select(self.key)).unionByName(fresh)

    def lookup(self, keys: list) -> DataFrame:
        """The rows that count now of a few keys, from the segments whose range holds any of them."""
        texts = [str(k) for k in keys]
        near = [s.segment for s in self.segments() if s.low is not None and any(s.low <= t <= s.high for t in texts)]
        return self._newest(self._read(near).filter(F.col(self.key).isin(keys)))

    def rows_read(self) -> int:
        """Rows in all segments that a read may open."""
        return reduce(lambda a, s: a + s.rows, self.segments(), 0)
