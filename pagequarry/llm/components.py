"""Connected components of a graph of links, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id in ``links`` (a, b): the smallest id it can reach.

    Each round takes the smallest root among the neighbours, then the root of that root, so the rounds follow the
    logarithm of the longest path. A hub's links are combined before they move. Tables between rounds are written.
    """
    both = materialize(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    roots = materialize(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("near"))
                        .select("id", F.least("id", "near").alias("root")), "roots")
    while True:
        near = (both.join(roots.withColumnsRenamed({"id": "b"}), "b").groupBy(F.col("a").alias("id"))
                .agg(F.min("root").alias("near")))
        step = roots.join(near, "id").select("id", "root", F.least("root", "near").alias("next"))
        up = roots.select(F.col("id").alias("next"), F.col("root").alias("top"))
        moved = materialize(step.join(up, "next").select("id", F.least("next", "top").alias("root"),
                                                         (F.least("next", "top") < F.col("root")).alias("moved")), "roots")
        roots = moved.select("id", "root")
        if moved.where("moved").isEmpty():
            return roots
