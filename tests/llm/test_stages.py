"""Stages of the pipeline: odd rows, clashing columns and plain versions; caps that are none."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from pagequarry.llm import decontaminate, language_id, licenses, maxscore, minhash_dedup, secrets
from pagequarry.operators import membership

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, _gone long, _id long, _key string, _text string, _live string, "
          "_hot_0 int, row string, id string, key string, of string, _k0_in boolean")
SECRET = "password=Zx9Qw8Er7Ty6Ui5Op4"


def prose(seed, n=60):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(["the", "and", "ing", "with", "th"], rng.integers(1, 5))) for _ in range(n))


def table(spark, rows):
    return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None, 1, 2, "k", "t", "l", 3, "r", "i", "y", "o", True) for r in rows], SCHEMA)


def odd_rows():
    item = prose(500, 40)
    return [(None, prose(1), "en", "a"), (None, prose(2), "en", None), (None, None, None, None), (5, "", "en", "a"), (6, " \t", "en", "a"), (7, prose(3), "en", "a"),
            (7, prose(3), "en", "a"), (7, prose(4), "en", "b"), (8, prose(3) + " more", "en", "c"), (9, prose(9, 30_000), "en", "a"), (10, f"{prose(5)} {SECRET} {prose(6)}", "en", "a"),
            (10, f"{prose(5)} {SECRET} {prose(6)}", "en", "a"), (None, f"x {SECRET} y", "en", "a"), (11, prose(7) + " " + item + " " + prose(8), "en", "a"),
            (None, item, "en", "a"), (11, "clean " + prose(10), "en", "a")], item


@pytest.mark.parametrize("listed", [4096, 0])
def test_stages_keep_all_columns_of_odd_rows(spark, tmp_path, monkeypatch, listed):
    monkeypatch.setattr(membership.mark_members, "__defaults__", (membership.MOST_BYTES, listed))
    rows, item = odd_rows()
    spark.createDataFrame([(1, item), (2, None), (None, item), (3, "two words")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = table(spark, rows)
    key = lambda rs: sorted((tuple(r) for r in rs), key=repr)
    all_rows = docs.collect()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        got = out.collect()
        if name == "near_copies":
            # 8 is a near copy of 7, which stays with both its rows
            want = [r for r in all_rows if r.doc_id != 8]
        elif name == "decontamination":
            want = [r for r in all_rows if not (r.text and item in r.text)]
        elif name == "language":
            want = [r for r in all_rows if r.text and r.text.strip()]
        else:
            masked = lambda r: r.text.replace(SECRET, secrets.MASK)
            want = [r if not r.text or SECRET not in r.text else type(r)(*(masked(r) if c == "text" else len(masked(r)) if c == "n_chars" else r[c] for c in docs.columns)) for r in all_rows]
        assert key(got) == key(want), name
        assert stage(spark, docs.where("false"), str(tmp_path)).count() == 0


def test_the_language_model_rejects_what_it_knows_nothing_of(spark):
    rows = [(i, prose(i), "en", "a") for i in range(30)] + [(100 + i, " ".join(["le", "eau", "que", "été"] * 9 + [f"mot{'abcdef'[i % 6]}"]), "fr", "a") for i in range(30)]
    rows += [(200, "漢字 仮名 交じり", None, "a"), (201, "漢字 with the", None, "a"), (202, "12 34", "en", "a")]
    kept = {r.doc_id for r in language_id.keep_known_language(table(spark, rows)).collect()}
    assert kept == {r[0] for r in rows} - {200, 202}


def test_long_words_are_known(spark):
    long_word = "donaudampfschifffahrtsgesellschaft"
    rows = [(i, f"{long_word} und", "de", "a") for i in range(1, 20)] + [(50 + i, prose(i), "en", "a") for i in range(20)]
    model = language_id.train(table(spark, rows))
    assert long_word in model.words.at and model.predict(long_word)[0] == "de"


def test_short_items_are_a_parameter(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    docs = table(spark, [(1, "so alpha beta gamma it is", "en", "a"), (2, "alpha beta", "en", "a")])
    assert decontaminate.contamination(docs, bench).count() == 0
    assert [r.doc_id for r in decontaminate.contamination(docs, bench, shortest_item=1).collect()] == [1]


def test_affero_texts_are_told_by_title_or_section():
    matcher = licenses.Matcher({}, 10)
    gpl = dict(licenses.TEXTS)["GPL-3.0"]
    affero = gpl.replace("GNU GENERAL PUBLIC LICENSE", "GNU AFFERO GENERAL PUBLIC LICENSE")
    section = gpl + "\nyour modified version must offer all users interacting with it remotely through a computer network an opportunity"
    above = "Copyright 2031 Someone Else, Some Street 5, Some Town; all their contributors and friends too.\n"
    assert matcher.text(gpl)[0] == matcher.text(above + gpl)[0] == "GPL-3.0"
    assert matcher.text(affero)[0] == matcher.text(above + affero)[0] == matcher.text(section)[0] == "AGPL-3.0"


def test_maxscore_splits_terms_by_bounds_and_carries_scores():
    rng = np.random.default_rng(8)
    weight = 0.85 ** np.arange(64)
    vectors = (rng.normal(size=(360, 64)) * weight * 256).astype(np.int64)
    queries = (rng.normal(size=(90, 64)) * weight * 256).astype(np.int64)
    packed = lambda m, ids: (np.array(ids, np.int64).tobytes(), m.tobytes())
    pairs = [(*packed(vectors[s:s + 120], range(s, s + 120)), *packed(queries[b:b + 30], range(1000 + b, 1030 + b))) for s in (0, 120, 240) for b in (0, 30, 60)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*pairs)], ["ids", "data", "q_ids", "q_data"])
    work, alone = Counter(), Counter()
    best = {}
    for out in maxscore._search(iter([batch]), 5, work):
        for q, v, score in zip(*(c.to_pylist() for c in out.columns)):
            best.setdefault(q, []).append((-score, v))
    for i in range(0, len(pairs)):  # every pair in a task of its own
        list(maxscore._search(iter([batch.slice(i, 1)]), 5, alone))
    for i, q in enumerate(queries):
        assert sorted(best[1000 + i])[:5] == sorted(zip((-(vectors @ q)).tolist(), range(360)))[:5]
    assert work["essential"] < 0.75 * work["terms"] and work["postings"] < 0.75 * work["product"]
    assert work["postings"] < alone["postings"]


def test_maxscore_blocks_that_are_dropped_start_anew(spark, monkeypatch):
    monkeypatch.setattr(maxscore, "HELD_BLOCKS", 1)
    monkeypatch.setattr(maxscore, "SHARD", 16)
    monkeypatch.setattr(maxscore, "BLOCK", 2)
    rng = np.random.default_rng(4)
    m = rng.normal(size=(120, 8)).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<float>")
    ints = np.floor(256 * m.astype(np.float64)).astype(np.int64)
    got = {}
    for r in maxscore.top_k(rows, every=10).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q in range(0, 120, 10):
        want = sorted((-int(ints[q] @ ints[v]), v) for v in range(120) if v != q)[:5]
        assert [(v, -s) for _, v, s in sorted(got[q])] == [(v, s) for s, v in want]
