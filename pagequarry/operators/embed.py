"""Text embedding with a local model, and the choice of documents to embed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.config import EMBED_ERROR
from pagequarry.operators.report import with_file_counts
from pagequarry.operators.skew import join_salted

DIMENSIONS = 256
WORD_BREAK = r"[^\p{L}\p{N}]+"


def embed_eligible(records: DataFrame) -> DataFrame:
    """Documents that completed and have Markdown."""
    return with_file_counts(records).filter((F.col("status") == "completed") & (F.col("md_files") > 0))


@dataclass(frozen=True)
class TfidfEmbedder:
    """Hashed term frequencies weighted by document frequency, unit length.

    The fit is one aggregation of ``dimensions`` counters; embedding a row needs no shuffle.
    """

    model: PipelineModel

    @classmethod
    def fit(cls, texts: DataFrame, column: str = "chunk", dimensions: int = DIMENSIONS) -> TfidfEmbedder:
        stages = Pipeline(stages=[
            RegexTokenizer(inputCol=column, outputCol="_tokens", pattern=WORD_BREAK),
            HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=dimensions),
            IDF(inputCol="_tf", outputCol="_tfidf"),
            Normalizer(inputCol="_tfidf", outputCol="_unit"),
        ])
        return cls(stages.fit(texts.select(column)))

    def embed(self, texts: DataFrame, dtype: str = "float32") -> DataFrame:
        vector = vector_to_array("_unit", dtype).alias("embedding")
        return self.model.transform(texts).select(*texts.columns, vector)

    def save(self, path: str) -> None:
        self.model.write().save(path)

    @classmethod
    def load(cls, path: str) -> TfidfEmbedder:
        return cls(PipelineModel.load(path))

    def embed_query(self, spark, query: str) -> list[float]:
        column = self.model.stages[0].getInputCol()
        return list(self.embed(spark.createDataFrame([(query,)], [column])).first()["embedding"])


# Embedders by name: classes with fit, embed, embed_query, save and load.
EMBEDDERS: dict[str, type] = {"tfidf": TfidfEmbedder}


def register_embedder(name: str, embedder: type) -> None:
    EMBEDDERS[name] = embedder


def attach_embeddings(chunks: DataFrame, given: DataFrame, key: str, spread_by: Column) -> DataFrame:
    """Every chunk, with the vector computed elsewhere for its ``key`` (one per key), or null where there is none."""
    return join_salted(chunks, given, key, spread_by, how="left")


def embedding_outcome(records: DataFrame, chunk_counts: DataFrame, vector_db: str, key: str = "doc_id") -> DataFrame:
    """Fill the embeddings struct of eligible records from their chunk counts; a document
    without chunks failed to embed. Each side has one row per ``key``."""
    eligible = (F.col("status") == "completed") & (F.col("md_files") > 0)
    done = F.coalesce("chunk_count", F.lit(0)) > 0
    struct = F.struct(
        F.when(done, "completed").otherwise("failed").alias("status"),
        F.when(done, vector_db).alias("vector_db"),
        F.when(done, F.col("chunk_count").cast("int")).alias("chunk_count"),
        F.when(~done, EMBED_ERROR).alias("error"))
    return (with_file_counts(records).drop("embeddings").join(chunk_counts.select(key, "chunk_count"), key, "left")
            .withColumn("embeddings", F.when(eligible, struct)).drop("chunk_count"))
