"""Joins of many rows to one row a key, where a key may hold a third of all rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARES = 1024  # a key with at least this part of all rows is hot: there are 1,024 such keys at most, whatever the data


def attach(rows: DataFrame, facts: DataFrame, keys: list[str], counted: str) -> DataFrame:
    """``rows`` with the other columns of ``facts``, a row a key, whose ``counted`` is the number of rows that have the key.

    Nulls are equal. Every row must find its key. Rows of hot keys meet a broadcast of ``SHARES`` rows at most and don't move; the others are
    shuffled, a key of them holding less than 1 / ``SHARES`` of all. Give stored tables: both are read twice.
    """
    total = facts.agg(F.sum(counted)).first()[0] or 0
    names = {k: f"_hot_{i}" for i, k in enumerate(keys)}
    named = facts.withColumnsRenamed(names)
    hot = F.broadcast(named.where(F.col(counted) * SHARES >= total))
    same = reduce(and_, (rows[k].eqNullSafe(F.col(n)) for k, n in names.items()))
    others = [c for c in facts.columns if c not in keys and c != counted]
    columns = [*(rows[c] for c in rows.columns), *others]
    return (rows.join(hot, same).select(*columns)
            .union(rows.join(hot, same, "left_anti").join(named.where(F.col(counted) * SHARES < total), same).select(*columns)))
