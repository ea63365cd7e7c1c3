"""Comment removal line by line against the form that works on whole texts."""

import random

import pytest
from pyspark.sql import functions as F

from pagequarry.functions import text
from pagequarry.operators import segments


@pytest.mark.parametrize("block", [1, 7, 1000])
@pytest.mark.parametrize("strict", [True, False])
def test_equals_the_row_form(spark, block, strict):
    rng = random.Random(block)
    kinds = ["text", "<!-- a", "b -->", "<!-- one -->", "  <!-- in", "end -->  ", "", "a <!-- b", "x --> y", "\u00a0<!--"]
    docs = [(f"d{i}", "\n".join(rng.choices(kinds, [6, 1, 1, 1, 1, 1, 2, 1, 1, 1], k=rng.randrange(1, 60)))) for i in range(60)]
    docs += [("long", "\n".join(["<!-- open"] + ["inside"] * 2500 + ["close -->", "after"])), ("open", "<!--\n" + "x\n" * 50)]
    frame = spark.createDataFrame(docs, "doc_id string, t string")
    want = {r.doc_id: r.w for r in frame.select("doc_id", text.strip_comments(frame.t, strict).alias("w")).collect()}
    lines = frame.select("doc_id", F.posexplode(F.split("t", "\n", -1)).alias("line_no", "line"))
    got = {}
    for r in segments.strip_comment_lines(lines, ["doc_id"], block=block, strict=strict).collect():
        got.setdefault(r.doc_id, []).append((r.line_no, r.line))
    assert {d: "\n".join(t for _, t in sorted(got.get(d, []))) for d in want} == want
