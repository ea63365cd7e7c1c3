"""SimHash near-dedup by a grid over segment popcounts.

1. Rows with one fingerprint become a class, so that copies, and near copies whose edits move no bit, are one row from here on.
2. A fingerprint is embedded as the bit counts of its 32 segments of two bits. The Manhattan distance of two embeddings is a
   lower bound of the Hamming distance: a differing bit changes one count by one, or by nothing.
3. Within 4 of 64 bits, one half of the segments is within Manhattan distance 2. Two points of a grid within 2 have a point
   between them that is within 1 of both. So each fingerprint enters, for each half, the cell of its counts and the
   neighbouring cells (25 on average), and every pair within the distance shares a cell.
4. Tasks walk over the sorted cells and verify whole fingerprints. A cell gives a spanning forest of its links, or at most
   ``NEAR_ROWS`` links a row. A cell of more than ``HELD`` classes is set aside and compared block by block, every block
   with every other; the work inside such a cell is the square of its different fingerprints.
5. Components of the links name the smallest document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.llm.components import components
from pagequarry.llm.hot import attach
from pagequarry.llm.tokens import lower_ascii, mix, words
from pagequarry.session import materialize

SHINGLE, SEED = 4, 42
DISTANCE = 4
HELD = 16_384  # classes of a cell that one task compares: bounds its memory; beyond, blocks of as many are compared in pairs
NEAR_ROWS = 32  # cells up to this size are compared row by row at once
_BLOCK = 65_536  # shingles whose bits are counted at once
_FIELDS = np.uint32(0x55555555)
_KEY_SEEDS = (np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9E3779B97F4A7C15))


def fingerprint(text: str | None) -> int:
    """64 bits; one is set if over half of the shingles' hashes have it set. 0 without words."""
    items = words(lower_ascii(text))
    if not items:
        return 0
    joined = b" ".join(items)
    ends = np.cumsum(np.fromiter(map(len, items), np.int64, len(items)) + 1) - 1
    size = min(SHINGLE, len(items))
    begins = np.r_[0, ends[:len(items) - size] + 1].tolist()
    ends = ends[size - 1:].tolist()
    ones, hash_of = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(ends), _BLOCK):
        h = np.array([hash_of(joined[b:e], SEED) for b, e in zip(begins[at:at + _BLOCK], ends[at:at + _BLOCK])], dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(ends)).tobytes(), "big")


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], ["doc_id", "print"])


def cells(prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(cell, fingerprint) for each cell that a fingerprint enters."""
    for half, seed in enumerate(_KEY_SEEDS):
        part = (prints >> np.uint64(32 * half)).astype(np.uint32)
        counts = (part & _FIELDS) + (part >> np.uint32(1) & _FIELDS)  # the counts of 16 segments, two bits each
        yield mix(counts * seed + seed), prints
        for segment in range(16):
            one = np.uint32(1 << 2 * segment)
            value = counts >> np.uint32(2 * segment) & np.uint32(3)
            for moves, moved in ((value < 2, counts + one), (value > 0, counts - one)):
                yield mix(moved[moves] * seed + seed), prints[moves]


def _enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for cell, prints in cells(batch.column(0).to_numpy().view(np.uint64)):
            yield pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), pa.array(prints.view(np.int64))], ["cell", "print"])


def near(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= distance


def forest(prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected within the distance: each fingerprint is reached once."""
    a, b, left = [], [], prints
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            hit = near(left, at, distance)
            if hit.any():
                found, left = left[hit], left[~hit]
                front.extend(found)
                a.append(np.full(len(found), at, np.uint64))
                b.append(found)
    return (np.concatenate(a), np.concatenate(b)) if a else (prints[:0], prints[:0])


def _links(cell: np.ndarray, prints: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of whole cells, from rows sorted by cell."""
    begin = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    size = np.diff(np.r_[begin, len(cell)])
    small = np.repeat((size > 1) & (size <= NEAR_ROWS), size)
    c, p = cell[small], prints[small]
    for step in range(1, NEAR_ROWS):
        same = np.flatnonzero(c[step:] == c[:-step]) if len(c) > step else c[:0]
        if not len(same):
            break
        hit = same[near(p[same], p[same + step], distance)]
        yield p[hit], p[hit + step]
    for i in np.flatnonzero(size > NEAR_ROWS):
        yield forest(prints[begin[i]:begin[i] + size[i]], distance)


def _meet(batches: Iterator[pa.RecordBatch], distance: int, held: int) -> Iterator[pa.RecordBatch]:
    """Links of the cells, from rows sorted by cell; for a cell of more than ``held`` rows its name instead."""
    kept, over = [], None  # the rows so far of the last cell, or its name if they are too many

    def made(links) -> Iterator[pa.RecordBatch]:
        for a, b in links:
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.nulls(len(a), pa.int64())],
                                                 ["a", "b", "full"])

    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append((batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)))
        cell, prints = (np.concatenate(x) for x in zip(*kept))
        if over is not None:
            cell, prints = cell[cell != over], prints[cell != over]
        last = int(np.searchsorted(cell, cell[-1])) if len(cell) else 0
        if last:
            yield from made(_links(cell[:last], prints[:last], distance))
        kept = [(cell[last:], prints[last:])]
        if len(cell) - last > held:
            over, kept = cell[-1], []
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([int(over)], pa.int64())], ["a", "b", "full"])
    if kept:
        yield from made(_links(*kept[0], distance))


def _full_cells(entered: DataFrame, full: DataFrame, distance: int, held: int) -> DataFrame:
    """Links of the cells in ``full``: blocks of about ``held`` classes, each compared with each, a spanning forest a pair."""
    rows = materialize(entered.join(full.select(F.col("full").alias("cell")).distinct(), "cell"), "full-cells")
    sizes = rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / held).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("print"), F.col("blocks").cast("long")).cast("int")
    paired = (rows.join(sizes, "cell").withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
              .select("cell", "print", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))

    def compare(table: pa.Table) -> pa.Table:
        a, b = forest(np.unique(table.column("print").to_numpy()).view(np.uint64), distance)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return paired.groupBy("cell", "i", "j").applyInArrow(compare, "a bigint, b bigint")


def simhash_dedup(docs: DataFrame, distance: int = DISTANCE, held: int = HELD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): fingerprint and component_id, the smallest doc_id that links reach, itself
    included. Fingerprints that differ in at most ``distance`` (0 to 5) bits are linked.

    Null and empty texts, and texts without words, have the fingerprint zero and are linked like any other. A text of fewer than four
    words is one shingle; the bits of very long texts are counted in blocks. Rows that repeat a doc_id are documents of their own, each with
    its text's fingerprint and component. A row with a null doc_id links others; its component has the smallest id that is not null, or
    null if there is none. Other columns are ignored, whatever their names. An empty table gives no rows.
    """
    if not 0 <= distance <= 5:
        raise ValueError("neighbouring cells of halves hold all pairs only up to a distance of 5")
    spark = docs.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sketch = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                         .mapInArrow(_sketch, "doc_id bigint, print bigint"), "prints")
    classes = materialize(sketch.groupBy("print").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("rows")), "classes")
    entered = classes.select("print").mapInArrow(_enter, "cell bigint, print bigint")
    met = materialize(entered.repartition(width, "cell").sortWithinPartitions("cell", "print")
                      .mapInArrow(partial(_meet, distance=distance, held=held), "a bigint, b bigint, full bigint"), "met")
    links, full = met.where("full is null").select("a", "b"), met.where("full is not null")
    if not full.isEmpty():
        links = links.union(_full_cells(entered, full, distance, held))
    roots = components(links)
    rooted = materialize(classes.join(roots, classes["print"] == roots["id"], "left")
                         .select("print", "first", "rows", F.coalesce("root", "print").alias("root")), "rooted")
    groups = materialize(rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("classes")), "groups")
    named = materialize(attach(rooted.select("print", "rows", "root"), groups, ["root"], "classes").drop("root"), "named")
    return attach(sketch, named, ["print"], "rows").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
