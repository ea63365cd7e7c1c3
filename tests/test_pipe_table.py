"""The pipe table of built-in functions against the row-wise one."""

import datetime
import random

from pyspark.sql import functions as F

from pagequarry.functions.pipe_table import render_table
from pagequarry.operators import tables

SCHEMA = "t int, sample_row int, i bigint, f double, s string, b boolean, d date, m decimal(10,2), x string"


def test_equals_the_row_wise_table(spark):
    rng = random.Random(4)
    rows = []
    for t in range(300):
        texts = rng.choice([["a", "bb", ""], ["1", "20", "-3"], ["1.5", "1e7", "nan"], ["1", "x"], [None, "7"], ["1234567.25", "0.00001"], [" 5", "6"]])
        for n in range(rng.randint(1, 5)):
            rows.append((t, n + 1, None if rng.random() < 0.2 else rng.choice([1, -25, 12345678, 0]), rng.choice([None, 1.0, 12345.65, 1e-7, 123456789.5, -0.25, float("inf"), 2.675]),
                         rng.choice(texts), rng.choice([True, False, None]), rng.choice([None, datetime.date(2024, 1, n + 1)]), rng.choice([None, 12, 3]), rng.choice(["lo ng\u00e9", "z"])))
    frame = spark.createDataFrame(rows, "t int, sample_row int, i bigint, f double, s string, b boolean, d date, m int, x string").withColumn("m", F.col("m").cast("decimal(10,2)"))
    columns = ["i", "f", "s", "b", "d", "m", "x"]
    made = tables.pipe_tables(frame, "t", "sample_row", columns)
    texts = frame.groupBy("t").agg(tables.ordered("sample_row", F.array(*[F.col(c).cast("string") for c in columns])).alias("rows"))
    for r in made.join(texts, "t").select("t", "table", "rows").collect():
        want = render_table(columns, ["int64", "float64", "object", "bool", "object", "object", "object"], [list(x) for x in r["rows"]])
        assert r["table"] == want, (r["t"], "\n" + r["table"] + "\n" + want)
