import hashlib
import random

import pytest

from pagequarry.llm.substring_dedup import substring_dedup
from pagequarry.llm.tokens import words


def brute(rows, window=20):
    """First place of every window, then the words that later ones cover."""
    first = {}
    texts = [(2**63 - 1 if d is None else d, words(t)) for d, t in rows]
    for d, w in texts:
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, (d, i)), (d, i))
    late = {(d, i) for d, w in texts for i in range(len(w) - window + 1) if first[tuple(w[i:i + window])] < (d, i)}
    out = []
    for (d, _), (place, w) in zip(rows, texts):
        gone = {i + j for p, i in late if p == place for j in range(window) if i + window <= len(w)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone & set(range(len(w)))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=repr)


def corpus():
    rng = random.Random(3)
    word = lambda: rng.choice(["a", "b", "ça", "d e", "Word,", "x" * 30])
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for d in range(60):
        w = [f"{word()}{rng.randrange(50)}" for _ in range(rng.choice([0, 5, 19, 20, 21, 90]))]
        if d % 3 == 0:
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage[rng.randrange(10):rng.randrange(25, 60)]
        if d % 7 == 0:
            w += w
        rows.append((d, rng.choice([" ", "\n", "\t  "]).join(w)))
    rows += [(100, rows[3][1]), (101, rows[3][1]), (200, "y " * 300), (201, "y " * 25), (None, rows[3][1]), (300, None), (301, "")]
    return rows


@pytest.mark.parametrize("slice_words", [1, 200, 1_000_000])
def test_against_brute_force(spark, slice_words):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(substring_dedup(docs, slice_words=slice_words)) == brute(rows)


def test_repeated_rows_and_other_columns(spark):
    text = " ".join(map(str, range(30)))
    rows = [(1, text), (1, text), (2, text)]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, place string, starts int")
    assert result(substring_dedup(docs)) == brute(rows)
    assert [r[2] for r in result(substring_dedup(docs))] == [0, 0, 30]


def test_intervals_and_kept_text(spark):
    a = [f"a{i}" for i in range(40)]
    docs = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(["x", *a[5:30], "y", *a[:20], "z"]))], "doc_id long, text string")
    row = substring_dedup(docs).where("doc_id = 2").first()
    assert row.removed == [[1, 26], [27, 47]] and row.kept_text == "x y z" and row.n_removed == 45


def test_empty_table(spark):
    assert substring_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
