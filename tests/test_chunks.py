import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagequarry.config import SEPARATORS, JobConfig
from pagequarry.functions.splitter import split_text
from pagequarry.operators import chunks


def merge(pieces, size, overlap):
    out, window, total = [], [], 0
    for piece in pieces:
        if window and total + len(piece) > size:
            joined = "".join(window).strip()
            out += [joined] if joined else []
            while window and (total > overlap or total + len(piece) > size):
                total -= len(window.pop(0))
        window.append(piece)
        total += len(piece)
    joined = "".join(window).strip()
    return out + ([joined] if joined else [])


def plain_split(text, size, overlap, seps=SEPARATORS):
    """The splitting rules on strings, piece by piece."""
    i = next(k for k, s in enumerate(seps) if s == "" or s in text)
    sep, rest = seps[i], seps[i + 1:]
    if sep:
        head, *tail = text.split(sep)
        pieces = [p for p in [head, *[sep + t for t in tail]] if p]
    else:
        pieces = list(text)
    out, short = [], []
    for piece in pieces:
        if len(piece) < size:
            short.append(piece)
            continue
        out += merge(short, size, overlap) if short else []
        short = []
        out += plain_split(piece, size, overlap, rest) if rest else [piece]
    return out + (merge(short, size, overlap) if short else [])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "bb", "cccccc", " ", "\n", "\n\n", ". ", ".", "é"]), max_size=80).map("".join),
       st.integers(2, 20), st.integers(0, 20))
def test_splitter_follows_the_rules(text, size, overlap):
    overlap = min(overlap, size)
    assert split_text(text, size, overlap) == (plain_split(text, size, overlap) if text.strip() else [])


@pytest.mark.parametrize("n", [0, 1, 999, 1000, 1001, 1800, 1801, 5000])
def test_separator_free_text_gives_fixed_windows(spark, n):
    text = "x" * n
    fixed = spark.createDataFrame([(text,)], "t string").select(chunks.fixed_chunks(F.col("t"), 1000, 200)).first()[0]
    expected = 0 if n == 0 else 1 if n <= 1000 else -(-(n - 200) // 800)
    assert len(fixed) == expected
    assert split_text(text) == fixed


def test_fixed_windows_across_runs(spark):
    text = "".join(chr(0x61 + i % 26) if i % 7 else "😀" for i in range(150_000))
    fixed = spark.createDataFrame([(text,)], "t string").select(chunks.fixed_chunks(F.col("t"), 1000, 200)).first()[0]
    assert fixed == [text[i * 800:i * 800 + 1000] for i in range(len(fixed))]
    assert fixed[-1].endswith(text[-10:]) and len(fixed) == -(-(150_000 - 200) // 800)


def test_long_word_and_single_separators():
    assert split_text("w" * 1200 + " tail") == ["w" * 1000, "w" * 400, "tail"]
    assert split_text("   \n\n ") == []
    assert split_text(None) == []


def test_chunks_keep_source_order():
    text = ". ".join(f"sentence number {i} of the text" for i in range(400))
    at = -1
    for chunk in split_text(text):
        assert len(chunk) <= 1000
        found = text.find(chunk)
        assert found > at
        at = found


def test_chunk_markdown_ids_and_metadata(spark):
    rows = [("doc", "legal", "h1", "md/legal/doc_p2.md", "<!--\nchunk_id: doc_p2\n-->\n\n# t\r\nbody"),
            ("doc", "legal", "h1", "md/legal/doc.md", "plain"), ("doc", "legal", "h1", "md/legal/doc_p3.md", "<!--\nall\n-->\n \n")]
    got = chunks.chunk_markdown(spark.createDataFrame(rows, "doc_id string, category string, hash string, md_file string, md string"))
    found = {r["source_file"]: r for r in got.collect()}
    assert set(found) == {"md/legal/doc_p2.md", "md/legal/doc.md"}
    first = found["md/legal/doc_p2.md"]
    assert (first["doc_id"], first["source_doc_id"], first["page"], first["chunk_id"]) == ("doc_doc_p2", "doc", 2, "doc_doc_p2_chunk_0")
    assert (first["chunk"], first["chunk_size"], first["file_type"]) == ("# t\nbody", 8, "markdown")
    assert found["md/legal/doc.md"]["page"] is None


def test_metadata_merge_is_right_biased(spark):
    df = spark.sql("select map('doc_id','a','page','1') as base, map('doc_id','b','x','y') as over")
    assert df.select(chunks.merge_metadata(F.col("base"), F.col("over"))).first()[0] == {"doc_id": "b", "page": "1", "x": "y"}


def test_config_is_validated():
    with pytest.raises(ValueError):
        JobConfig(chunk_size=10, chunk_overlap=11)
    with pytest.raises(ValueError):
        JobConfig(duplicate_rule="name")


def test_recursive_chunks_of_empty_texts(spark):
    """The splitter gets Arrow arrays, so no batch of texts is copied; null and empty texts have no chunk."""
    rows = spark.createDataFrame([("a", "one two three four"), ("b", None), ("c", ""), ("d", " \n")], "doc_id string, text string")
    got = rows.select("doc_id", chunks.recursive_chunks(F.col("text"), 10, 2).alias("c")).collect()
    assert {r.doc_id: list(r.c) for r in got} == {"a": chunks.split_text("one two three four", 10, 2), "b": [], "c": [], "d": []}
