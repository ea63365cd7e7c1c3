"""Comment removal over lines that are rows, for texts that are longer than a row may be.

What a range of lines does to "inside a comment" is one of three maps: it opens, it closes, or it keeps what was. Composed they are one of the three again, so ranges
are reduced to their last opening or closing line, a running scan over one row a range gives each its state, and only then are the lines of a range looked at again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagequarry.functions.text import strip

LINES = 4096  # of a range


def _event(line: Column, strict: bool) -> Column:
    """1 for a line that opens a comment, 0 for one that closes it, null for others; both kinds are dropped."""
    bare = strip(line)
    opens, closes = bare.startswith("<!--"), bare.endswith("-->")
    return F.when(opens & (F.lit(strict) | ~closes), 1).when(opens | closes, 0)


def strip_comment_lines(lines: DataFrame, key: list[str], order: str = "line_no", text: str = "line", block: int = LINES, strict: bool = True) -> DataFrame:
    """The rows of ``lines`` outside comments. ``order`` numbers a text's lines with integers from 0; no line is moved further than to its range."""
    marked = lines.withColumns({"_event": _event(F.col(text), strict), "_range": F.expr(f"`{order}` div {block}")})
    last = marked.groupBy(*key, "_range").agg(F.max_by("_event", F.when(F.col("_event").isNotNull(), F.col(order))).alias("_last"))
    earlier = Window.partitionBy(*key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    states = last.withColumn("_state", F.coalesce(F.last("_last", ignorenulls=True).over(earlier), F.lit(0))).drop("_last")
    inside = Window.partitionBy(*key, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = marked.withColumn("_seen", F.last("_event", ignorenulls=True).over(inside))
    kept = seen.join(states, [*key, "_range"]).filter(F.col("_event").isNull() & (F.coalesce("_seen", "_state") == 0))
    return kept.select(*lines.columns)
