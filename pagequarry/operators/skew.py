"""Joins and ordinals that do not send a hot document to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 8
ORDINAL_BUCKET = 1024


def join_salted(big: DataFrame, small: DataFrame, on: str | list[str], spread_by: Column,
                how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Join many rows per key to one narrow row per key.

    ``spread_by`` is a value of the big side that varies inside a key; its hash splits each key
    over ``salts`` tasks, and the small side is repeated that often. The salt is a function of the
    row, so a recomputed task yields the same rows.
    """
    keys = [on] if isinstance(on, str) else list(on)
    left = big.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, keys + ["_salt"], how).drop("_salt")


def number_within(df: DataFrame, key: str, order: str, name: str, bucket: int = ORDINAL_BUCKET) -> DataFrame:
    """1-based position of each row inside its key by a distinct integer ``order``.

    Rows are numbered inside runs of ``bucket`` order values; the running total over the runs of a
    key works on one row per run. No task sorts a whole key.
    """
    runs = df.withColumn("_run", F.expr(f"`{order}` div {bucket}"))
    counts = runs.groupBy(key, "_run").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(key, "_run", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(key, "_run").orderBy(order)
    return (runs.withColumn("_rn", F.row_number().over(inside))
            .join(starts, [key, "_run"])
            .withColumn(name, (F.col("_rn") + F.col("_before")).cast("int"))
            .drop("_run", "_rn", "_before"))


def running_within(df: DataFrame, key: str, order: str, sums: dict[str, str], bucket: int = ORDINAL_BUCKET) -> DataFrame:
    """For each (name, column) the sum of the column over the earlier rows of the key, by a distinct integer ``order``.

    As in :func:`number_within`: sums inside runs of ``bucket`` order values, and a running total over one row per run.
    """
    runs = df.withColumn("_run", F.expr(f"`{order}` div {bucket}"))
    totals = runs.groupBy(key, "_run").agg(*(F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()))
    before = Window.partitionBy(key).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(key, "_run", *(F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_start_{n}") for n in sums))
    inside = Window.partitionBy(key, "_run").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (runs.withColumns({f"_in_{n}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in sums.items()}).join(starts, [key, "_run"])
            .withColumns({n: F.col(f"_in_{n}") + F.col(f"_start_{n}") for n in sums})
            .drop("_run", *(f"_in_{n}" for n in sums), *(f"_start_{n}" for n in sums)))
