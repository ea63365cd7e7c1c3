"""Exact top-k inner products by MaxScore over shards of vectors.

Terms are dimensions. In a shard each term has a bound: the most that it can add for a query. A query's terms are taken
by falling bound. The essential ones are those up to which the bounds of the rest cannot reach the k-th best score
known, from the task's earlier shards or from k vectors of this one; their postings are traversed for the whole shard. Vectors that the rest cannot lift to that score fall out, the
others are probed term by term while they are competitive. Every vector has every term, so a posting list is a column.
Results of shards are merged.
"""

from __future__ import annotations

from collections import Counter, OrderedDict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagequarry.session import materialize

SCALE = 256
EVERY = 50
K = 5
SHARD, BLOCK = 4096, 256  # vectors of a shard, queries of a block: a task holds one of each
PAIRS = 64  # of a block and a shard, that a task takes on average: sets the number of groups of shards
LEAST_GROUPS = 64  # unless there are fewer shards: small inputs use many tasks
HELD_BLOCKS = 4096  # blocks of queries whose scores a task keeps: some 10 KB each
PROBE = 8  # terms probed between two looks at who is competitive


def quantized(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and q (array of bigint) of the vectors whose components are all finite; the least q of a repeated vec_id."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    fine = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~F.exists(
        "embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    return (vectors.where(F.col("vec_id").isNotNull() & fine)
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * scale).cast("long")).alias("q"))
            .groupBy("vec_id").agg(F.min("q").alias("q")))


def _pack(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Rows packed by ``rows``: number within the partition, ids and components, shorter vectors filled with zeros."""
    n, ids, parts = 0, [], []

    def packed() -> pa.RecordBatch:
        width = max(map(len, parts))
        matrix = np.zeros((len(parts), width), np.int64)
        for i, p in enumerate(parts):
            matrix[i, :len(p)] = p
        return pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                                           pa.array([matrix.tobytes()], pa.binary())], ["n", "ids", "data"])

    for batch in batches:
        for i, q in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids.append(i)
            parts.append(q.values.to_numpy())
            if len(ids) == rows:
                yield packed()
                n, ids, parts = n + 1, [], []
    if ids:
        yield packed()


def seeded(columns: np.ndarray, order: np.ndarray, query: np.ndarray, alive: np.ndarray, k: int) -> int | None:
    """A score that k of the shard's vectors reach: the least full score of the k that gain most from the term with the highest bound."""
    if len(alive) < k:
        return None
    first = query[order[0]] * columns[order[0]][alive]
    chosen = alive[np.argpartition(first, len(first) - k)[-k:]]
    return int((query @ columns[:, chosen]).min())


def top_of_shard(ids: np.ndarray, columns: np.ndarray, query_id: int, query: np.ndarray, k: int, known: int | None,
                 work: Counter | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(vec_id, score) of the shard's vectors that can be among the k best; ``known``: a score that k others reach. ``work`` counts
    the terms, the essential ones, and the postings that were traversed or probed."""
    width = min(len(columns), len(query))
    columns, query = columns[:width], query[:width]
    low, high = query * columns.min(axis=1), query * columns.max(axis=1)
    bound, least_of = np.maximum(low, high), np.minimum(low, high)
    order = np.argsort(-bound, kind="stable")
    rest = np.r_[np.cumsum(bound[order][::-1])[::-1], 0]  # the most that the terms from here on can add
    least = np.r_[np.cumsum(least_of[order][::-1])[::-1], 0]
    alive = np.flatnonzero(ids != query_id)
    if known is None and width:
        known = seeded(columns, order, query, alive, k)
    # essential terms: until what remains cannot reach the known score alone
    essential = int(np.argmax(rest < known)) if known is not None and (rest < known).any() else width
    score = np.zeros(columns.shape[1], np.int64)
    for t in order[:essential]:
        score += query[t] * columns[t]
    partial_score = score[alive]
    done, postings = essential, essential * columns.shape[1]
    while done < width and len(alive):
        floor = known
        if len(alive) > k:
            # the k-th best full score so far is at least the k-th best of what has been added plus the least of the rest
            seen = int(np.partition(partial_score, -k)[-k] + least[done])
            floor = seen if floor is None else max(floor, seen)
        if floor is not None:
            stay = partial_score + rest[done] >= floor
            alive, partial_score = alive[stay], partial_score[stay]
        terms = order[done:done + PROBE]
        partial_score = partial_score + query[terms] @ columns[np.ix_(terms, alive)]
        done, postings = done + len(terms), postings + len(terms) * len(alive)
    if work is not None:
        work.update(terms=width, essential=essential, postings=postings, product=width * columns.shape[1])
    best = np.lexsort((ids[alive], -partial_score))[:k]
    return ids[alive][best], partial_score[best]


def _search(batches: Iterator[pa.RecordBatch], k: int, work: Counter | None = None) -> Iterator[pa.RecordBatch]:
    """Pairs of a block of queries and a shard. The scores that a query's k best reach go on to the next shard of the task; blocks not met for long start anew."""
    scores: OrderedDict[bytes, list[list[int]]] = OrderedDict()
    for batch in batches:
        for row in batch.to_pylist():
            ids, queries = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["q_ids"], np.int64)
            columns = np.ascontiguousarray(np.frombuffer(row["data"], np.int64).reshape(len(ids), -1).T)
            matrix = np.frombuffer(row["q_data"], np.int64).reshape(len(queries), -1)
            known = scores.setdefault(row["q_ids"], [[] for _ in queries])
            scores.move_to_end(row["q_ids"])
            if len(scores) > HELD_BLOCKS:
                scores.popitem(last=False)
            out = []
            for i, (q, vector) in enumerate(zip(queries.tolist(), matrix)):
                found, score = top_of_shard(ids, columns, q, vector, k, known[i][-1] if len(known[i]) == k else None, work)
                known[i] = sorted([*known[i], *score.tolist()], reverse=True)[:k]
                out.append((np.full(len(found), q), found, score))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id and score: for each vec_id divisible by ``every`` the k vectors of another vec_id with the
    greatest integer inner product of floor(256 * x), ties to the smaller vec_id; all, if there are fewer.

    Null vectors, and those holding null or non-finite components, or none, take no part, nor do null ids. Of rows that
    repeat a vec_id the least vector counts. Vectors of unlike lengths are filled with zeros. Products are exact while they fit
    64 bits. Other columns are ignored. An empty table gives no rows.
    """
    points = materialize(quantized(vectors), "points")
    asked = F.col("vec_id") % every == 0
    n, q = points.agg(F.count(F.lit(1)), F.count_if(asked)).first()  # one row
    n_shards, n_blocks = -(-n // SHARD), -(-q // BLOCK)
    spread = max(1, min(n_shards, -(-n_shards * n_blocks // PAIRS)), min(n_shards, LEAST_GROUPS))
    groups = F.pmod(F.xxhash64("ids"), F.lit(spread)).cast("int")
    layout = "n int, ids binary, data binary"
    shards = points.mapInArrow(partial(_pack, rows=SHARD), layout).withColumn("group", groups)
    queries = (points.where(asked).mapInArrow(partial(_pack, rows=BLOCK), layout)
               .select(F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))
               .withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))))
    met = shards.join(queries, "group").select("ids", "data", "q_ids", "q_data").mapInArrow(
        partial(_search, k=k), "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
