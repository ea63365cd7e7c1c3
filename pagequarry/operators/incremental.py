"""Skipping what the index already holds, and updating the index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.config import JobConfig
from pagequarry.operators.skew import join_salted


def _keys(config: JobConfig) -> list[str]:
    return ["hash"] if config.duplicate_rule == "hash" else ["doc_id", "hash"]


def _known(index: DataFrame, config: JobConfig) -> DataFrame:
    known = index.filter(F.col("hash").isNotNull())
    return known.filter("status = 'completed'") if config.retry_failed else known


def incremental_new(files: DataFrame, index: DataFrame, config: JobConfig = JobConfig()) -> DataFrame:
    """Files to process: not in the index with this id and hash, one per set of equal copies.

    Copies are reduced to the last by path before the shuffle, so a file that fills a third of the
    corpus reaches the join as one row. Unreadable files (null hash) are never duplicates and skip
    the join, where equal nulls would all meet in one task. Pass files without their content.
    """
    keys = _keys(config)
    fields = [c for c in files.columns if c not in keys]
    last_copies = (
        files.filter(F.col("hash").isNotNull()).groupBy(*keys)
        .agg(F.max_by(F.struct(*fields), F.col("path")).alias("f"))
        .select(*keys, *[F.col(f"f.{c}").alias(c) for c in fields])
    )
    new = last_copies.join(_known(index, config).select(*keys), keys, "left_anti")
    return new.unionByName(files.filter(F.col("hash").isNull()))


def incremental_split(files: DataFrame, index: DataFrame, config: JobConfig = JobConfig()) -> DataFrame:
    """All files with ``is_new``: whether the run processes the file or passes over it."""
    new = incremental_new(files.select("path", "doc_id", "hash"), index, config)
    flagged = files.join(new.select("path", F.lit(True).alias("is_new")), "path", "left")
    return flagged.withColumn("is_new", F.coalesce("is_new", F.lit(False)))


def incremental_skipped(files: DataFrame, index: DataFrame, config: JobConfig = JobConfig()) -> DataFrame:
    """Files the run passes over: those known to the index and further copies inside the run."""
    return incremental_split(files, index, config).filter(~F.col("is_new")).drop("is_new")


def duplicate_lookup(files: DataFrame, index: DataFrame) -> DataFrame:
    """The stored record of each file that is a duplicate."""
    hashed = files.filter(F.col("hash").isNotNull()).select("path", "doc_id", "hash")
    return join_salted(hashed, index.filter(F.col("hash").isNotNull()), ["doc_id", "hash"], F.col("path"))


def index_upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """New records replace old ones of the same doc_id. Each side has one record per doc_id."""
    kept = old.join(new.select("doc_id"), "doc_id", "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)
