"""Approximate search by an inverted file: coarse cells, product-quantised residuals, exact re-ranking.

Vectors are dealt to their nearest centroids, ``COPIES`` of them, so that a neighbour beyond a border is found from either side. A folder per cell holds
them with their residual to the centroid as one byte for each of ``PARTS`` parts. A query reads only the folders of its nearest cells: codes first, compared by a table of distances per part, then
the vectors of the best candidates, compared exactly. Models are fitted on bounded samples; every vector is indexed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import groupby, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagequarry.functions import vectors as V
from pagequarry.session import materialize

PARTS, CODES = 16, 256
COPIES = 2  # cells that a vector is stored in
CELLS_PER_ROOT, MOST_CELLS = 6, 65_536  # centroids: a multiple of the root of the number of vectors, as many as a task can hold
SAMPLE_PER_CELL = 64  # vectors that a centroid is fitted on
FIT_ROWS = 65_536  # residuals that the codebooks are fitted on
ROUNDS = 12
PROBED_SHARE = 0.19  # of the cells that a query reads by default
REFINE = 20  # candidates compared exactly, times k
SHARD, BLOCK = 8192, 256  # codes and queries that a task compares at once
HELD = 1 << 20  # distances that a task holds at once
GROUPS, SIDES = 8, 8  # cells are dealt to so many groups, queries to so many sides; a task has a group and a side


@dataclass(frozen=True)
class IvfModel:
    """``centroids`` (cells, width), ``books`` (parts, codes, width / parts) and the number of rows in each cell; a vector has ``copies`` rows."""

    path: str
    copies: int
    centroids: np.ndarray
    books: np.ndarray
    sizes: np.ndarray


def _nearest(rows: np.ndarray, points: np.ndarray, copies: int = 1) -> np.ndarray:
    """(rows, copies): the nearest points of each row, the first of those that tie; at most about ``HELD`` distances at a time."""
    norms = (points ** 2).sum(axis=1)
    out = np.zeros((len(rows), copies), np.int64)
    step = max(1, HELD // len(points))
    for start in range(0, len(rows), step):
        far = norms[None, :] - 2.0 * (rows[start:start + step] @ points.T)
        for c in range(copies):
            out[start:start + step, c] = at = far.argmin(axis=1)
            far[np.arange(len(at)), at] = np.inf
    return out


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(rows, -1)


def _lists(rows: np.ndarray) -> pa.ListArray:
    """A list for each row of a matrix."""
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)), pa.array(rows.ravel()))


def _padded(rows: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Rows as (rows, parts, part width), filled with zeros."""
    parts, _, width = books.shape
    return np.pad(rows, ((0, 0), (0, parts * width - rows.shape[1]))).reshape(len(rows), parts, width)


def _residuals(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, parts: int, width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            rows = _matrix(batch.column(0), batch.num_rows)
            rest = np.pad(rows - centroids[_nearest(rows, centroids)[:, 0]], ((0, 0), (0, parts * width - rows.shape[1])))
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(parts, dtype=np.int32), len(rows))), _lists(rest.reshape(-1, width))], ["part", "x"])


def _book(group: pd.DataFrame, codes: int) -> pd.DataFrame:
    """Lloyd's rounds over a part's residuals, from rows drawn with a fixed seed."""
    rows = np.stack(group["x"].to_numpy())
    rows = rows[np.lexsort(rows.T)]
    points = rows[np.random.default_rng(7).permutation(len(rows))[:codes]]
    for _ in range(ROUNDS):
        chosen = _nearest(rows, points)[:, 0]
        count = np.bincount(chosen, minlength=len(points))
        total = np.stack([np.bincount(chosen, weights=x, minlength=len(points)) for x in rows.T], axis=1)
        points = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], points)
    return pd.DataFrame({"part": group["part"].iloc[0], "code": range(len(points)), "x": list(points)})


def _encode(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, books: np.ndarray, copies: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = _matrix(batch.column("embedding"), batch.num_rows)
        for cell in _nearest(rows, centroids, copies).T:
            rest = _padded(rows - centroids[cell], books)
            code = np.concatenate([_nearest(rest[:, p], books[p]) for p in range(len(books))], axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([c.tobytes() for c in code], pa.binary()), pa.array(cell, pa.int32())],
                                             [*batch.schema.names, "code", "cell"])


def build_ivf(vectors: DataFrame, path: str, cells: int | None = None, copies: int = COPIES, parts: int = PARTS, seed: int = 7) -> IvfModel:
    """Index all vectors (chunk_id, embedding, ...) below ``path``; null embeddings stay out. All embeddings have one length.

    Centroids begin as different vectors of the sample, drawn at random: what k-means|| does instead ends in rounds on the driver alone, which grow
    with the square of the cells. Equal vectors of the sample are one with a weight, so that a frequent one takes no more than one centroid.
    """
    spark = vectors.sparkSession
    found = vectors.filter(F.col("embedding").isNotNull()).withColumn("embedding", F.col("embedding").cast("array<double>"))
    n, dims = found.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()  # one row
    if not n:
        raise ValueError("no vectors to index")
    cells = max(2, min(n, cells or min(MOST_CELLS, round(CELLS_PER_ROOT * n ** 0.5))))
    drawn = found.select("embedding").sample(min(1.0, 1.2 * SAMPLE_PER_CELL * cells / n), seed).limit(SAMPLE_PER_CELL * cells)
    sample = materialize(drawn.groupBy("embedding").agg(F.count(F.lit(1)).cast("double").alias("weight")), "ivf-sample")
    dealt = sample.repartition(spark.sparkContext.defaultParallelism, "embedding").sortWithinPartitions("embedding").select(array_to_vector("embedding").alias("features"), "weight")
    centroids = np.array(KMeans(k=cells, seed=seed, maxIter=ROUNDS, initMode="random", solver="block", weightCol="weight").fit(dealt).clusterCenters())
    width = -(-dims // parts)
    books = np.zeros((parts, CODES, width))
    rest = found.select("embedding").sample(min(1.0, FIT_ROWS / n), seed).mapInArrow(
        partial(_residuals, centroids=centroids, parts=parts, width=width), "part int, x array<double>")

    def book(group: pd.DataFrame) -> pd.DataFrame:
        return _book(group, CODES)

    fitted = rest.groupBy("part").applyInPandas(book, "part int, code int, x array<double>").collect()  # parts x codes rows
    for r in fitted:
        books[r["part"], r["code"]] = r["x"]
    for p in range(parts):  # with fewer rows than codes the others repeat the first
        books[p, sum(r["part"] == p for r in fitted):] = books[p, 0]
    coded = found.mapInArrow(partial(_encode, centroids=centroids, books=books, copies=min(copies, len(centroids))), found.select("*", F.lit(b"").alias("code"), F.lit(0).alias("cell")).schema)
    # rebalancing by cell splits a cell that a third of all vectors share over several files
    coded.hint("rebalance", "cell").sortWithinPartitions("cell").write.partitionBy("cell").parquet(f"{path}/cells")
    model = [("copies", min(copies, len(centroids)), 0, [0.0])] + [("centroid", i, 0, row.tolist()) for i, row in enumerate(centroids)] + [
        ("book", c, p, books[p, c].tolist()) for p in range(parts) for c in range(CODES)]
    spark.createDataFrame(model, "kind string, no int, part int, x array<double>").coalesce(1).write.parquet(f"{path}/model")
    return load_ivf(spark, path)


def load_ivf(spark: SparkSession, path: str) -> IvfModel:
    rows = spark.read.parquet(f"{path}/model").collect()  # centroids and codebooks
    centroids = np.array([r["x"] for r in sorted((r for r in rows if r["kind"] == "centroid"), key=lambda r: r["no"])])
    parts = 1 + max(r["part"] for r in rows)
    books = np.zeros((parts, CODES, len(next(r["x"] for r in rows if r["kind"] == "book"))))
    for r in rows:
        if r["kind"] == "book":
            books[r["part"], r["no"]] = r["x"]
    sizes = np.zeros(len(centroids), np.int64)
    for r in postings(spark, path).groupBy("cell").count().collect():  # a row a cell
        sizes[r["cell"]] = r["count"]
    return IvfModel(path, next(r["no"] for r in rows if r["kind"] == "copies"), centroids, books, sizes)


def postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "false").parquet(f"{path}/cells")


def _reads(rows: np.ndarray, centroids: np.ndarray, sizes: np.ndarray, probes: int, least: int) -> list[np.ndarray]:
    """The nearest cells of each row: ``probes`` of them, or as many as hold ``least`` vectors. Cells without vectors are none."""
    held = np.flatnonzero(sizes)
    points, norms = centroids[held], (centroids[held] ** 2).sum(axis=1)
    out, step = [], max(1, HELD // max(len(held), 1))
    for start in range(0, len(rows) if len(held) else 0, step):
        order = np.argsort(norms[None, :] - 2.0 * (rows[start:start + step] @ points.T), axis=1, kind="stable")
        enough = (np.cumsum(sizes[held][order], axis=1) < least).sum(axis=1) + 1
        out += [held[o[:t]] for o, t in zip(order, np.minimum(np.maximum(enough, probes), len(held)))]
    return out


def _probe(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, sizes: np.ndarray, probes: int, least: int) -> Iterator[pa.RecordBatch]:
    """Each query with its nearest cells, a row a query."""
    for batch in batches:
        if batch.num_rows and sizes.any():
            cells = _reads(_matrix(batch.column(1), batch.num_rows), centroids, sizes, probes, least)
            ends = np.cumsum([0, *map(len, cells)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(cells).astype(np.int32)))], ["query_id", "q", "cells"])


def _packed(batches: Iterator[pa.RecordBatch], rows: int, keep: int | None = None) -> Iterator[pa.RecordBatch]:
    """Rows (chunk_id, code, cell) packed by group of cells: a row per group and at most ``rows`` of its rows.

    Rows of one cell with one code are equally far from whatever asks: of more than ``keep`` of them in a pack only the first by chunk_id can be found.
    """
    held: dict[int, list[tuple]] = {}

    def pack(group: int) -> pa.RecordBatch:
        own = sorted(held.pop(group), key=lambda r: (r[2], r[1], r[0] is not None, r[0] or ""))
        if keep is not None:
            own = [row for _, equal in groupby(own, key=lambda r: r[1:]) for row in islice((next(same) for _, same in groupby(equal)), keep)]
        ids, codes, cells = zip(*own)
        return pa.RecordBatch.from_arrays([pa.array([group], pa.int32()), pa.array([list(ids)], pa.list_(pa.string())), pa.array([b"".join(codes)], pa.binary()),
                                           pa.array([list(cells)], pa.list_(pa.int32()))], ["group", "ids", "data", "cells"])

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            held.setdefault(row[2] % GROUPS, []).append(row)
            if len(held[row[2] % GROUPS]) == rows:
                yield pack(row[2] % GROUPS)
    for group in list(held):
        yield pack(group)


def _asked(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, sizes: np.ndarray, probes: int, least: int) -> Iterator[pa.RecordBatch]:
    """Blocks of queries (query_id, embedding): a row per block and group, with each query's cells of the group, in their order."""
    for batch in batches:
        for start in range(0, batch.num_rows if sizes.any() else 0, BLOCK):
            block = batch.slice(start, BLOCK)
            ids, rows = block.column(0).to_pylist(), _matrix(block.column(1), block.num_rows)
            cells = _reads(rows, centroids, sizes, probes, least)
            of, cell = np.repeat(np.arange(len(ids), dtype=np.int32), [len(c) for c in cells]), np.concatenate(cells).astype(np.int32)
            for group in np.unique(cell % GROUPS):
                mine = np.flatnonzero(cell % GROUPS == group)
                mine = mine[np.argsort(cell[mine], kind="stable")]
                yield pa.RecordBatch.from_arrays([pa.array([group], pa.int32()), pa.array([ids], pa.list_(pa.string())), pa.array([rows.tobytes()], pa.binary()),
                                                  pa.array([of[mine].tobytes()], pa.binary()), pa.array([cell[mine].tobytes()], pa.binary())],
                                                 ["group", "q_ids", "q_data", "q_of", "q_cells"])


class _Best:
    """The ``keep`` nearest codes of each query of a block, a vector counting once, by its least distance."""

    def __init__(self, ids: list[str], keep: int):
        self.ids, self.keep = ids, keep
        self.reach = np.full(len(ids), np.inf)  # what is farther can't matter any more
        self.held: list[tuple[np.ndarray, ...]] = []  # queries, distances, names, cells
        self.n = 0

    def add(self, of: np.ndarray, rough: np.ndarray, names: np.ndarray, cell: int) -> None:
        self.held.append((of, rough, names, np.full(len(of), cell, np.int32)))
        self.n += len(of)
        if self.n > 8 * self.keep * len(self.ids):
            self.cut()

    def cut(self) -> None:
        """Equal distances go by the name, then by the cell."""
        of, rough, names, cells = (np.concatenate(c) for c in zip(*self.held))
        number, different = pd.factorize(names, use_na_sentinel=False)
        place = np.empty(len(different), np.int64)
        place[sorted(range(len(different)), key=lambda i: (isinstance(different[i], str), different[i] if isinstance(different[i], str) else ""))] = np.arange(len(different))
        name = place[number]
        order = np.lexsort((cells, name, rough, of))
        _, first = np.unique(of[order] * np.int64(len(different)) + name[order], return_index=True)
        order = order[np.sort(first)]
        begin = np.searchsorted(of[order], np.arange(len(self.ids) + 1))
        order = order[np.arange(len(order)) - begin[of[order]] < self.keep]
        begin = np.searchsorted(of[order], np.arange(len(self.ids) + 1))
        full = np.flatnonzero(np.diff(begin) == self.keep)
        self.reach[full] = rough[order][begin[full + 1] - 1]
        self.held, self.n = [(of[order], rough[order], names[order], cells[order])], len(order)

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            self.cut()
            of, rough, names, cells = self.held[0]
            yield pa.RecordBatch.from_arrays([pa.array(self.ids, pa.string()).take(pa.array(of)), pa.array(names, pa.string()), pa.array(cells), pa.array(rough)],
                                             ["query_id", "chunk_id", "cell", "rough"])


def _compare(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, books: np.ndarray, keep: int) -> Iterator[pa.RecordBatch]:
    """The ``keep`` nearest codes to each query among the shards that its block meets one after another; only these leave the task.

    A matrix product for each cell finds the codes that can matter; their distances are then sums over the parts, so that equal codes tie.
    """
    parts, best, block = np.arange(len(books)), None, None
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
            if (row["q_ids"], row["q_of"]) != block:
                if best:
                    yield from best.rows()
                best, block = _Best(row["q_ids"], keep), (row["q_ids"], row["q_of"])
                queries = np.frombuffer(row["q_data"], np.float64).reshape(len(row["q_ids"]), -1)
                of, probed = np.frombuffer(row["q_of"], np.int32), np.frombuffer(row["q_cells"], np.int32)
            names, cells = np.empty(len(row["ids"]), dtype=object), np.asarray(row["cells"])
            names[:] = row["ids"]
            code = np.frombuffer(row["data"], np.uint8).reshape(len(names), -1)
            rest = books[parts[None, :], code]  # what the codes stand for
            flat = rest.reshape(len(names), -1)
            norms = (flat ** 2).sum(axis=1)
            for cell in np.intersect1d(cells, probed):
                here = slice(*np.searchsorted(cells, [cell, cell + 1]))
                asking = of[slice(*np.searchsorted(probed, [cell, cell + 1]))]
                q = _padded(queries[asking] - centroids[cell], books)
                plain = q.reshape(len(q), -1)
                far = norms[here] + (plain ** 2).sum(axis=1)[:, None] - 2.0 * (plain @ flat[here].T)
                reach = best.reach[asking]
                if far.shape[1] > keep:
                    reach = np.minimum(reach, np.partition(far, keep - 1, axis=1)[:, keep - 1])
                near = np.nonzero(far <= (reach + 1e-9 * (1.0 + np.abs(far).max()))[:, None])
                for start in range(0, len(near[0]), SHARD):
                    a, b = (x[start:start + SHARD] for x in near)
                    rough = ((rest[here][b] - q[a]) ** 2).sum(axis=2).sum(axis=1)
                    best.add(asking[a], rough, names[here][b], int(cell))
    if best:
        yield from best.rows()


def probed_cells(model: IvfModel, queries: DataFrame, k: int = 5, probes: int | None = None) -> DataFrame:
    """query_id, q and cell of the cells that each query (query_id, embedding) reads; together they hold at least k vectors, if there are as many."""
    probes = probes or max(1, int(PROBED_SHARE * len(model.centroids)))
    asked = queries.select(F.col("query_id").cast("string").alias("query_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    read = asked.mapInArrow(partial(_probe, centroids=model.centroids, sizes=model.sizes, probes=probes, least=k * model.copies), "query_id string, q array<double>, cells array<int>")
    return read.select("query_id", "q", F.explode("cells").alias("cell"))


def search_ivf(spark: SparkSession, model: IvfModel, queries: DataFrame, k: int = 5, probes: int | None = None, refine: int = REFINE) -> DataFrame:
    """query_id, rank, chunk_id and l2_distance: about the k nearest vectors of each query, by exact distances among the best candidates of its cells."""
    probes = probes or max(1, int(PROBED_SHARE * len(model.centroids)))
    plain = queries.select(F.col("query_id").cast("string").alias("query_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    blocks = plain.mapInArrow(partial(_asked, centroids=model.centroids, sizes=model.sizes, probes=probes, least=k * model.copies),
                              "group int, q_ids array<string>, q_data binary, q_of binary, q_cells binary")
    stored = postings(spark, model.path)
    shards = stored.select("chunk_id", "code", "cell").mapInArrow(partial(_packed, rows=SHARD, keep=k * refine), "group int, ids array<string>, data binary, cells array<int>")
    # a block goes to one side of each group, a shard to all sides of its group: both and what leaves the tasks grow as the tables do
    blocks = blocks.withColumn("side", F.pmod(F.xxhash64("q_ids"), F.lit(SIDES)).cast("int"))
    shards = shards.withColumn("side", F.explode(F.sequence(F.lit(0), F.lit(SIDES - 1))))
    rough = (blocks.join(shards.hint("merge"), ["group", "side"]).select("ids", "data", "cells", "q_ids", "q_data", "q_of", "q_cells")
             .mapInArrow(partial(_compare, centroids=model.centroids, books=model.books, keep=k * refine),
                         "query_id string, chunk_id string, cell int, rough double"))
    by_rough = Window.partitionBy("query_id").orderBy("rough", "chunk_id")
    rough = rough.repartition("query_id").groupBy("query_id", "chunk_id").agg(F.min(F.struct("rough", "cell")).alias("r")).select("query_id", "chunk_id", "r.rough", "r.cell")
    best = rough.withColumn("n", F.row_number().over(by_rough)).filter(F.col("n") <= k * refine).drop("n", "rough")
    asked = queries.select(F.col("query_id").cast("string").alias("query_id"), F.col("embedding").cast("array<double>").alias("q"))
    exact = (stored.select("chunk_id", "cell", "embedding").join(best, ["cell", "chunk_id"]).join(asked, "query_id")
             .select("query_id", "chunk_id", V.squared_l2(F.col("embedding"), F.col("q")).alias("l2_distance")))
    order = Window.partitionBy("query_id").orderBy("l2_distance", "chunk_id")
    return exact.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
