"""Top-k similarity search over stored vectors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import BucketedRandomProjectionLSH, BucketedRandomProjectionLSHModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagequarry.functions import vectors as V
from pagequarry.functions.text import preview
from pagequarry.operators.embed import TfidfEmbedder
from pagequarry.session import materialize

_HITS = "query_id string, chunk_id string, l2_distance double"
QUERY_BLOCK = 1024
ROW_BLOCK = 4096
PAIRS = 32  # of a block of vectors and a block of queries, that a group compares on average, until there are GROUPS
GROUPS = 64  # of blocks of vectors, at most: each query goes to all of them


def as_literal(query: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in query])


def search_topk(vectors: DataFrame, query: Sequence[float], k: int = 5) -> DataFrame:
    """The k vectors nearest to one query, smallest squared L2 distance first, ties by chunk_id.

    Every task keeps its own k nearest; only those are merged.
    """
    q = as_literal(query)
    return (vectors.withColumn("l2_distance", V.squared_l2(F.col("embedding"), q))
            .orderBy("l2_distance", "chunk_id").limit(k)
            .withColumn("cosine", V.cosine(F.col("embedding"), q)))


def search_filtered(vectors: DataFrame, condition: Column, query: Sequence[float], k: int = 5) -> DataFrame:
    """Search among the vectors whose metadata meets ``condition``; the filter reaches the scan."""
    return search_topk(vectors.filter(condition), query, k)


def search_documents(vectors: DataFrame, embedder: TfidfEmbedder, query: str, k: int = 5) -> DataFrame:
    """Search by text: embed the query with the model that embedded the chunks."""
    return search_topk(vectors, embedder.embed_query(vectors.sparkSession, query), k)


def format_hits(hits: DataFrame, content: str = "chunk") -> DataFrame:
    """Search results as rank, content, preview, metadata and score; smaller scores are nearer.

    Takes the k rows of one search, so the window over all of them is a window over k rows.
    """
    rank = F.row_number().over(Window.orderBy("l2_distance", "chunk_id"))
    metadata = [c for c in hits.columns if c not in (content, "embedding", "l2_distance", "cosine")]
    return hits.select(rank.alias("rank"), F.col(content).alias("content"), preview(F.col(content)).alias("preview"),
                       F.struct(*metadata).alias("metadata"), F.col("l2_distance").alias("similarity_score"), "cosine")


class _Nearest:
    """The k rows nearest to each query among those added.

    One matrix product per block of rows finds the rows that can matter; their distances are then
    computed exactly, so equal vectors tie exactly.
    """

    def __init__(self, ids: list[str], matrix: np.ndarray, k: int):
        self.ids, self.matrix, self.k = ids, matrix, k
        self.norms = (matrix ** 2).sum(axis=1)
        self.best: list[list] = [[] for _ in ids]

    def add(self, names: np.ndarray, rows: np.ndarray) -> None:
        k = self.k
        rough = self.matrix @ rows.T
        rough *= -2.0
        rough += (rows ** 2).sum(axis=1)[None, :]
        rough += self.norms[:, None]
        slack = 1e-9 * (1.0 + max(rough.max(), -rough.min())) if rough.size else 0.0
        reach = np.array([b[-1][0] if len(b) == k else np.inf for b in self.best])
        unknown = np.flatnonzero(np.isinf(reach))  # the k nearest of these rows are enough for a query that has not k yet
        if len(rows) > k and len(unknown):
            reach[unknown] = np.partition(rough[unknown], k - 1, axis=1)[:, k - 1]
        at, near = np.nonzero(rough <= (reach + slack)[:, None])
        exact = np.empty(len(at))
        for i in range(0, len(at), ROW_BLOCK):
            exact[i:i + ROW_BLOCK] = ((rows[near[i:i + ROW_BLOCK]] - self.matrix[at[i:i + ROW_BLOCK]]) ** 2).sum(axis=1)
        begin = np.searchsorted(at, np.arange(len(self.ids) + 1))
        for q in np.flatnonzero(np.diff(begin)):
            own = slice(begin[q], begin[q + 1])
            self.best[q] = sorted(self.best[q] + list(zip(exact[own].tolist(), names[near[own]].tolist())))[:k]

    def hits(self) -> Iterator[pa.RecordBatch]:
        out = [(self.ids[q], chunk, dist) for q, best in enumerate(self.best) for dist, chunk in best]
        if out:
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0]), pa.array(columns[1]), pa.array(columns[2], pa.float64())],
                names=["query_id", "chunk_id", "l2_distance"])


def _blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            yield (np.asarray(part.column(0).to_pylist(), dtype=object),
                   np.asarray(part.column(1).flatten(), dtype=np.float64).reshape(part.num_rows, -1))


def _nearest_in_task(ids: list[str], matrix: np.ndarray, k: int):
    """Arrow function: per task, the k rows nearest to each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = _Nearest(ids, matrix, k)
        for names, rows in _blocks(batches, ROW_BLOCK):
            nearest.add(names, rows)
        yield from nearest.hits()

    return run


def _packed(rows: int):
    """Arrow function: blocks of at most ``rows`` rows (id, embedding), a row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, matrix in _blocks(batches, rows):
            yield pa.RecordBatch.from_arrays([pa.array([names.tolist()], pa.list_(pa.string())), pa.array([matrix.tobytes()], pa.binary())], ["ids", "data"])

    return run


def _nearest_in_pairs(k: int):
    """Arrow function over pairs of a block of rows and a block of queries: what a block of queries meets one after another is merged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = None
        for batch in batches:
            for i in range(batch.num_rows):
                ids, data, q_ids, q_data = (batch.column(c)[i].as_py() for c in range(4))
                if nearest is None or nearest.ids != q_ids:
                    if nearest:
                        yield from nearest.hits()
                    nearest = _Nearest(q_ids, np.frombuffer(q_data, np.float64).reshape(len(q_ids), -1), k)
                nearest.add(np.asarray(ids, dtype=object), np.frombuffer(data, np.float64).reshape(len(ids), -1))
        if nearest:
            yield from nearest.hits()

    return run


def search_batch(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """For each query (query_id, embedding) the k nearest vectors (chunk_id, embedding).

    Up to ``QUERY_BLOCK`` queries go along with one scan of the vectors. More of them are packed into blocks, as are the
    vectors; blocks meet on the executors, in at most ``GROUPS`` groups, and a window merges what each group gives,
    so that what is shuffled grows as the tables do. No query-vector pair leaves a task except the k nearest of each query, and no more than a block of queries comes to the driver.
    """
    spark = vectors.sparkSession
    narrow = vectors.select("chunk_id", "embedding").filter(F.col("embedding").isNotNull())
    asked = queries.select(F.col("query_id").cast("string").alias("query_id"), "embedding").filter(F.col("embedding").isNotNull())
    rows = asked.limit(QUERY_BLOCK + 1).collect()
    if not rows:
        found = spark.createDataFrame([], _HITS)
    elif len(rows) <= QUERY_BLOCK:
        matrix = np.asarray([r["embedding"] for r in rows], dtype=np.float64)
        found = narrow.mapInArrow(_nearest_in_task([r["query_id"] for r in rows], matrix, k), _HITS)
    else:
        layout = "ids array<string>, data binary"
        shards = materialize(narrow.mapInArrow(_packed(ROW_BLOCK), layout), "shards")
        blocks = materialize(asked.mapInArrow(_packed(QUERY_BLOCK), layout), "queries")
        n_shards, n_blocks = shards.count(), blocks.count()
        groups = max(1, min(n_shards, GROUPS, -(-n_shards * n_blocks // PAIRS)))
        dealt = shards.withColumn("group", F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int"))
        spread = blocks.select(F.col("ids").alias("q_ids"), F.col("data").alias("q_data"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
        found = spread.join(dealt.hint("merge"), "group").select("ids", "data", "q_ids", "q_data").mapInArrow(_nearest_in_pairs(k), _HITS)
    w = Window.partitionBy("query_id").orderBy("l2_distance", "chunk_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def fit_lsh(vectors: DataFrame, bucket_length: float = 1.0, tables: int = 8,
            seed: int = 7) -> tuple[BucketedRandomProjectionLSHModel, DataFrame]:
    """Hash the vectors once; returns the model and the hashed vectors to store and search."""
    dense = vectors.withColumn("features", array_to_vector("embedding"))
    lsh = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=bucket_length,
                                      numHashTables=tables, seed=seed)
    model = lsh.fit(dense)
    return model, model.transform(dense)


def search_lsh(model: BucketedRandomProjectionLSHModel, hashed: DataFrame, query: Sequence[float], k: int = 5) -> DataFrame:
    """Approximate search: only vectors that share a bucket with the query are compared."""
    hits = model.approxNearestNeighbors(hashed, Vectors.dense(query), k, distCol="l2")
    return hits.select("chunk_id", (F.col("l2") * F.col("l2")).alias("l2_distance"))


def vector_append(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """The incoming vectors whose chunk_id is not stored yet: what an append writes.

    Only ids of the stored side are read and shuffled.
    """
    return incoming.join(stored.select("chunk_id"), "chunk_id", "left_anti")


def vector_upsert(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Stored vectors with the incoming ones put in, replacing equal chunk_ids."""
    return stored.join(incoming.select("chunk_id"), "chunk_id", "left_anti").unionByName(incoming)


def merge_stores(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union of two stores; a chunk_id in both keeps the first store's vector."""
    return first.unionByName(vector_append(first, second))
