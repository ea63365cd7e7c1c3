"""Mixing sources to target weights: hash-random order, distributed prefix sums, a cut at each source's budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagequarry.session import materialize

SPACES = "[\\x20\\x09-\\x0D]+"
WEIGHTS = (1, 2, 3)  # by rank of the source's name, repeating
EPOCHS = 3
DIGITS = 3  # hex digits of the key that name a bucket: 4096 buckets a source


def n_words(text: Column) -> Column:
    """Number of runs of anything but U+0020 and U+0009 to U+000D; 0 for null."""
    parts = F.split(text, SPACES)
    edges = (F.element_at(parts, 1) == "").cast("long") + ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("long")
    return F.coalesce(F.size(parts).cast("long") - edges, F.lit(0).cast("long"))


def running_totals(rows: DataFrame, order: list[Column], totals: dict[str, str]) -> DataFrame:
    """Adds, for each (name, column), the sum of the column over all rows up to this one in a total order.

    Rows are range-sorted and written with their partition's number; only one row a partition is summed in one place.
    """
    placed = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("_part", F.spark_partition_id()), "ranged")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("_part").agg(*(F.sum(c).alias(n) for n, c in totals.items()))
    starts = parts.select("_part", *(F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_before_{n}") for n in totals))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = placed.select("*", *(F.sum(c).over(inside).alias(f"_in_{n}") for n, c in totals.items()))
    return (summed.join(starts, "_part")
            .select(*rows.columns, *((F.col(f"_in_{n}") + F.col(f"_before_{n}")).alias(n) for n in totals)))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """source, source_size, target from (source, source_size), a row for each source.

    Targets are ``least(epochs * size, level * weight)``; the level, at which they add up to all sizes, is where
    sharing the excess of the stopped sources again and again ends.
    """
    named = sizes.withColumn("_one", F.lit(1).cast("long"))
    ranked = running_totals(named, [F.col("source").isNull(), F.col("source")], {"_rank": "_one"})
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = ranked.select("source", "source_size", F.lit(epochs) * F.col("source_size"), weight.cast("long")) \
        .toDF("source", "source_size", "_cap", "_weight")
    by_cap = running_totals(weighed.withColumn("_stop", F.col("_cap") / F.col("_weight")),
                            [F.col("_stop"), F.col("source").isNull(), F.col("source")],
                            {"_caps": "_cap", "_weights": "_weight"})
    everything = weighed.agg(F.sum("source_size"), F.sum("_weight")).first()  # one row
    # the level for the rest if all sources before this one stop; the first source that it does not stop sets the level
    level = (F.lit(everything[0]) - F.col("_caps") + F.col("_cap")) / (F.lit(everything[1]) - F.col("_weights") + F.col("_weight"))
    found = by_cap.where(F.col("_stop") >= level).agg(F.min(F.struct("_stop", level.alias("level")))).first()[0]
    shared = F.lit(found["level"] if found else 0.0) * F.col("_weight")
    return weighed.select("source", "source_size", F.least(F.col("_cap").cast("double"), shared).alias("target"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """doc_id, size, source_size, target and taken (words the mix takes, repeats counted) for each row of ``docs``
    (doc_id, text, source); then the source.

    Sizes are word counts. Sources by code point, null last, weigh ``weights``, repeating, and share all sizes; no
    target exceeds ``epochs`` times its source's size. A source's whole passes over its documents are taken first; the
    rest of its budget, rounded down, is cut from its documents in the order of their hashed ids, the last one in part.

    Null and empty texts have size 0 and taken 0. A null doc_id has a place in the order like any other, and rows that
    repeat a doc_id follow each other by size. A source without words has target 0. Other columns are ignored. An empty
    table gives no rows. Reruns agree, as order comes from hashes alone.
    """
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sized = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", n_words(F.col("text")).alias("size"),
                                    key.alias("_key"), F.substring(key, 1, DIGITS).alias("_bucket")), "sizes")
    buckets = sized.groupBy("source", "_bucket").agg(F.sum("size").alias("_size"))
    up_to = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.select("source", "_bucket", F.coalesce(F.sum("_size").over(up_to), F.lit(0)).alias("_start"))
    shares = targets(buckets.groupBy("source").agg(F.sum("_size").alias("source_size")), weights, epochs)
    plan = starts.alias("s").join(shares.alias("t"), F.expr("s.source <=> t.source")) \
        .select("s.source", "_bucket", "_start", "source_size", "target")
    inside = Window.partitionBy("source", "_bucket").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    budget = F.floor("target").cast("long")
    size = F.greatest(F.col("source_size"), F.lit(1))
    return (placed.alias("d").join(plan.alias("p"), F.expr("d.source <=> p.source and d._bucket = p._bucket"))
            .select("doc_id", "size", "source_size", "target",
                    (F.expr("size") * F.floor(budget / size)
                     + F.greatest(F.lit(0), F.least(F.col("size"), budget - F.floor(budget / size) * F.col("source_size")
                                                    - F.col("_start") - F.col("_inside")))).cast("long").alias("taken"),
                    "d.source"))
