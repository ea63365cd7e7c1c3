"""Exact membership of wide rows in a set of keys, without moving the rows.

A semi or anti join of documents with a list of ids shuffles the documents' texts. Here only keys are shuffled: a blocked Bloom filter of the wanted keys
is aggregated, the rows' keys that pass it wrongly are found by a join of keys alone and make a second filter, the wanted keys that pass that one
wrongly a third, and so on. Each is a few hundredths of the one before it; the last set is small and is listed. The cascade then decides
every row's membership exactly while it is scanned. Filters are broadcast up to ``MOST_BYTES``; beyond that rows are joined by a shuffle.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.session import materialize

BITS_PER_KEY, HASHES = 16, 4
BLOCK_BITS = 32_768  # of a block of the filter: 4 KB
MOST_BYTES = 64 << 20
LISTED = 4_096  # keys that are listed rather than filtered


def _prefix(columns: list[str]) -> str:
    """A beginning that no column has."""
    taken = {c.lower() for c in columns}
    return next(p for n in range(len(taken) + 1) for p in [f"_k{n}_"] if not any(c.startswith(p) for c in taken))


def _bits(key: list[Column]) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), *key), F.lit(BLOCK_BITS)).cast("long") for i in range(1, HASHES + 1)]


def _block(key: list[Column], blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), *key), F.lit(blocks)).cast("long")


def bloom_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, bits) of the rows of ``keys``, combined before the shuffle; at most ``blocks`` rows of 4 KB."""
    key = [F.col(c) for c in keys.columns]
    return (keys.select(_block(key, blocks).alias("block"), F.explode(F.array(*_bits(key))).alias("bit"))
            .groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")))


def _passes(rows: DataFrame, key: list[Column], bloom: DataFrame, blocks: int, name: str) -> DataFrame:
    """``rows`` with a boolean column: whether the filter has the key."""
    held = F.broadcast(bloom.select(F.col("block").alias(f"{name}block"), F.col("bits").alias(f"{name}bits")))

    def has(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring(F.col(f"{name}bits"), (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, (bit % 8).cast("int")) == 1

    found = reduce(and_, (has(b) for b in _bits(key)))
    joined = rows.join(held, _block(key, blocks) == F.col(f"{name}block"), "left")
    return joined.withColumn(name, F.coalesce(found, F.lit(False))).drop(f"{name}block", f"{name}bits")


def _same(left: list[Column], right: list[Column]) -> Column:
    return reduce(and_, (a.eqNullSafe(b) for a, b in zip(left, right)))


def mark_members(rows: DataFrame, key: list[Column], keys: DataFrame, name: str, most_bytes: int = MOST_BYTES, listed: int = LISTED) -> DataFrame:
    """``rows`` with the boolean column ``name``: whether the values of ``key`` are a row of ``keys``, which has as many columns, nulls being equal.

    Scans the rows' keys once beforehand. Rows that repeat a key are all marked; repeated ``keys`` count once.
    """
    names = [f"k{i}" for i in range(len(key))]
    k = [F.col(n) for n in names]
    wanted = materialize(keys.toDF(*names).distinct(), "wanted")
    n = wanted.count()
    prefix = _prefix(rows.columns)

    def with_list(table: DataFrame, few: DataFrame, to: str) -> DataFrame:
        there = F.broadcast(few.select(*(F.col(c).alias(prefix + c) for c in names), F.lit(True).alias(to)))
        return table.join(there, _same(key, [F.col(prefix + c) for c in names]), "left").drop(*(prefix + c for c in names)).withColumn(to, F.coalesce(to, F.lit(False)))

    if n <= listed:
        return with_list(rows, wanted, name)
    if n * BITS_PER_KEY // 8 > most_bytes:
        there = wanted.select(*(F.col(c).alias(prefix + c) for c in names), F.lit(True).alias(name))
        return rows.join(there, _same(key, [F.col(prefix + c) for c in names]), "left").drop(*(prefix + c for c in names)).withColumn(name, F.coalesce(name, F.lit(False)))
    there = rows.select(*(c.alias(n) for c, n in zip(key, names))).distinct()
    inside, outside = wanted, materialize(there.join(wanted, _same([there[c] for c in names], [wanted[c] for c in names]), "left_anti"), "others")
    filters, size = [], n
    while True:
        blocks = max(1, -(-size * BITS_PER_KEY // BLOCK_BITS))
        bloom = materialize(bloom_filter(inside, blocks), "bloom")
        filters.append((bloom, blocks))
        wrong = materialize(_passes(outside, k, bloom, blocks, "hit").filter("hit").drop("hit"), "wrong")
        size = wrong.count()
        if size <= listed:
            break
        inside, outside = wrong, inside
    marked = rows
    for i, (bloom, blocks) in enumerate(filters):
        marked = _passes(marked, key, bloom, blocks, f"{prefix}f{i}")
    marked = with_list(marked, wrong, f"{prefix}x")
    # the first filter that a key does not pass decides; one that passes all is of the last filter's kind unless it is listed
    answer = F.lit(len(filters) % 2 == 1) != F.col(f"{prefix}x")
    for i in reversed(range(len(filters))):
        answer = F.when(F.col(f"{prefix}f{i}"), answer).otherwise(F.lit(i % 2 == 1))
    return marked.select(*(F.col(f"`{c}`") for c in rows.columns), answer.alias(name))


def without_members(rows: DataFrame, key: list[Column], keys: DataFrame) -> DataFrame:
    """``rows`` whose key is not in ``keys``; columns kept, rows not moved."""
    flag = _prefix(rows.columns) + "in"
    return mark_members(rows, key, keys, flag).filter(~F.col(flag)).drop(flag)


def split_members(rows: DataFrame, key: list[Column], keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is in ``keys``, the others)."""
    flag = _prefix(rows.columns) + "in"
    marked = mark_members(rows, key, keys, flag)
    return marked.filter(F.col(flag)).drop(flag), marked.filter(~F.col(flag)).drop(flag)
