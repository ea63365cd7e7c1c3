"""Vector code compression: codebooks of integer vector parts, trained and applied by exact products of limbs.

Components become integers, vectors are cut into 16 parts, and each part is named by the nearest of 64 entries of its position's codebook.
A squared distance is ``|x|^2 - 2 x.c + |c|^2``. The products x.c come from float64 BLAS: integers are split into limbs so small that a
product of two limb matrices stays within 2^53 and is exact; the limbs' products are shifted and added up in int64; the first least
distance wins. Tasks add up the parts of each entry and Spark adds up the tasks; a codebook has 64 entries of a vector's width, whatever the
number of vectors, and only codebooks pass through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.llm.hot import attach
from pagequarry.session import materialize

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
_ROWS = 2048  # vectors whose distances are held at once


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label and q (array of bigint) of the vectors without null or non-finite components."""
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    return vectors.where(x.isNotNull() & ~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"), "label",
        F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("q"))


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """float64 matrices with ``x = sum(limb[i] * 2**(bits * i))``; all but the last are below ``2**bits`` and none is negative but the last."""
    out, low = [], np.int64((1 << bits) - 1)
    while x.size and (x.max() > low or x.min() < -low - 1):
        out.append((x & low).astype(np.float64))
        x = x >> np.int64(bits)
    return [*out, x.astype(np.float64)]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact stacked matrix product of int64 matrices, as long as its values fit 64 bits."""
    bits = (53 - int(np.ceil(np.log2(max(a.shape[-1], 1))))) // 2
    total = np.zeros((*a.shape[:-1], b.shape[-1]), np.int64)
    right = limbs(b, bits)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(right):
            if bits * (i + j) < 64:  # beyond, nothing of a 64-bit value is left
                total += (x @ y).astype(np.int64) << np.int64(bits * (i + j))
    return total


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry, the first of equals, and its squared distance: (parts, rows) of ``x`` (parts, rows, width) and
    ``book`` (parts, entries, width)."""
    distance = (x * x).sum(axis=2)[:, :, None] - 2 * products(x, book.transpose(0, 2, 1)) + (book * book).sum(axis=2)[:, None, :]
    code = distance.argmin(axis=2)
    return code, np.take_along_axis(distance, code[:, :, None], 2)[:, :, 0]


def _parts(batch: pa.RecordBatch, column: str, parts: int, width: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Slices of the batch as (from, to, parts x rows x width); shorter vectors are filled with zeros."""
    for at in range(0, batch.num_rows, _ROWS):
        lists = batch.column(column).slice(at, _ROWS)
        flat, size = lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())
        if (size == parts * width).all():
            rows = flat.reshape(len(size), -1)
        else:
            rows = np.zeros((len(size), parts * width), np.int64)
            rows[np.arange(parts * width) < size[:, None]] = flat
        yield at, at + len(size), np.ascontiguousarray(rows.reshape(len(size), parts, width).transpose(1, 0, 2))


def _totals(batches: Iterator[pa.RecordBatch], book: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per codebook entry and position that this task's vectors chose: how often, and the sum."""
    parts, entries, width = book.shape
    count, total = np.zeros((parts, entries), np.int64), np.zeros(book.shape, np.int64)
    for batch in batches:
        for _, _, x in _parts(batch, "q", parts, width):
            code, _ = nearest(x, book)
            chosen = (code[:, None, :] == np.arange(entries)[None, :, None]).astype(np.int64)  # parts x entries x rows
            count += chosen.sum(axis=2)
            total += products(chosen, x)
    part, entry, place = (a.ravel() for a in np.broadcast_arrays(*np.ogrid[:parts, :entries, :width]))
    used = count[part, entry] > 0
    yield pa.RecordBatch.from_arrays(
        [pa.array(part[used], pa.int32()), pa.array(entry[used], pa.int32()), pa.array(place[used], pa.int32()),
         pa.array(count[part, entry][used]), pa.array(total.ravel()[used])], ["part", "entry", "place", "n", "total"])


def _encode(batches: Iterator[pa.RecordBatch], book: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes, errors = [], []
        for _, _, x in _parts(batch, "q", book.shape[0], book.shape[2]):
            code, distance = nearest(x, book)
            codes += [row.tobytes().hex() for row in code.T.astype(np.uint8)]
            errors.append(distance.sum(axis=0))
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()),
                                          pa.array(np.concatenate(errors) if errors else [], pa.int64())], ["vec_id", "label", "code", "error"])


def train(points: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts, entries, width) of ``points`` (vec_id, q). They start as the parts of the smallest vec_ids."""
    ids = points.select("vec_id").distinct().orderBy(F.asc_nulls_last("vec_id")).limit(entries).withColumnRenamed("vec_id", "first_id")
    first = (points.join(F.broadcast(ids), points["vec_id"].eqNullSafe(F.col("first_id")), "left_semi").groupBy("vec_id")
             .agg(F.min("q").alias("q")).orderBy(F.asc_nulls_last("vec_id")).collect())  # as many rows as entries
    book = np.zeros((len(first), parts * width), np.int64)
    for row, vector in zip(book, first):
        row[:len(vector["q"])] = vector["q"]
    book = np.ascontiguousarray(book.reshape(len(first), parts, width).transpose(1, 0, 2))
    for _ in range(rounds if book.size else 0):
        sums = (points.select("q").mapInArrow(partial(_totals, book=book), "part int, entry int, place int, n bigint, total bigint")
                .groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")))
        for r in sums.collect():  # a row per component of a codebook
            book[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return book


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """One row per vector that is not null and holds no null or non-finite component: vec_id, code (two hex digits a part), error
    (squared distances, all parts), label_error (errors of all rows of that label, nulls together) and codebooks_sha256.

    Components become ``floor(scale * x)``. Ties go to the lower entry. With fewer vec_ids than ``entries`` there are as many entries as ids; a
    vec_id that is repeated starts one entry, with its least vector, and each of its rows is encoded; null ids are encoded
    and come after all others at the start. Vectors of unlike lengths, and lengths that ``parts`` doesn't divide, are filled with zeros up to the next
    length that it does; an empty vector is all zeros. Distances are exact while they fit 64 bits. Other columns are
    ignored, whatever their names. An empty table, or one without such vectors, gives no rows.
    """
    if entries > 256:
        raise ValueError("two hex digits name at most 256 entries")
    label = vectors.schema["label"].dataType.simpleString()
    points = materialize(integers(vectors, scale), "points")
    longest = points.agg(F.max(F.size("q"))).first()[0]  # one number
    if longest is None:
        return points.select("vec_id", *(F.lit(None).cast(t).alias(n) for n, t in
                                         (("code", "string"), ("error", "long"), ("label_error", "long"), ("codebooks_sha256", "string"))))
    book = train(points, max(1, -(-longest // parts)), parts, entries, rounds)
    digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    coded = materialize(points.mapInArrow(partial(_encode, book=book), f"vec_id bigint, label {label}, code string, error bigint"), "codes")
    labels = materialize(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("rows")), "labels")
    return attach(coded, labels, ["label"], "rows").select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
