"""A training-data pipeline over ``documents``: each stage works on all that the one before kept.

All stages but the last return the columns of their input, whatever their names, and take an empty table to an empty one. Null and empty texts go in
the first stage; stages that get them anyway leave them alone. Rows with a null doc_id are judged by their own text; rows that repeat a doc_id stay or
go by their own texts, but as near copies together. Texts count whole, however long.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.llm.decontaminate import drop_contaminated
from pagequarry.llm.language_id import keep_known_language
from pagequarry.llm.minhash_dedup import drop_near_copies
from pagequarry.llm.mixing import mix_sources
from pagequarry.llm.secrets import mask_live
from pagequarry.session import work_folder


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model can tell stay; those without a letter, and those of which it knows no word and no n-gram, go."""
    return keep_known_language(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) the smallest doc_id stays."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go; ties and repeated rows alike."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; values that look live, whose owners are few, are masked."""
    return mask_live(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes; documents of which it takes none go. Ties in the order go by id, then size."""
    return mix_sources(docs).where(F.col("taken") > 0)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language), ("near_copies", near_copies), ("decontamination", decontamination), ("secrets", secrets),
    ("mixing", mixing),
]

#: Language models and signatures cannot be stated in SQL; tests compare the stages with the rows that are expected of made-up documents, and
#: their operators with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = work_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
