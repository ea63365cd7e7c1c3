import numpy as np
import pytest
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

from pagequarry.operators import embed, search


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    m = rng.normal(size=(600, 16)).astype("float32")
    m[100:300] = m[7]  # a third of the store is one vector
    ids = [f"c{i:03d}" for i in range(600)]
    df = spark.createDataFrame([(i, v.tolist(), int(n % 4)) for n, (i, v) in enumerate(zip(ids, m))],
                               "chunk_id string, embedding array<float>, label int").repartition(5).cache()
    return ids, m.astype("float64"), df


def nearest(ids, m, q, k):
    return [i for _, i in sorted(zip(((m - q) ** 2).sum(axis=1).tolist(), ids))[:k]]


@pytest.mark.parametrize("k", [1, 3, 5, 250, 1000])
def test_topk_and_batch_equal_brute_force(spark, data, k):
    ids, m, df = data
    queries = {"q0": m[7], "q1": m[3] * 0.5, "q2": np.zeros(16)}
    for q in queries.values():
        assert [r["chunk_id"] for r in search.search_topk(df, q.tolist(), k).orderBy("l2_distance", "chunk_id").collect()] == nearest(ids, m, q, k)
    frame = spark.createDataFrame([(n, q.tolist()) for n, q in queries.items()], "query_id string, embedding array<double>")
    got = search.search_batch(df, frame, k).orderBy("query_id", "rank").collect()
    for n, q in queries.items():
        assert [r["chunk_id"] for r in got if r["query_id"] == n] == nearest(ids, m, q, k)


def test_queries_go_in_blocks(spark, data, monkeypatch):
    ids, m, df = data
    monkeypatch.setattr(search, "QUERY_BLOCK", 2)
    monkeypatch.setattr(search, "ROW_BLOCK", 17)
    frame = spark.createDataFrame([(str(n), m[n].tolist()) for n in range(5)], "query_id string, embedding array<double>")
    got = search.search_batch(df, frame, 3).orderBy("query_id", "rank").collect()
    assert [r["chunk_id"] for r in got] == [i for n in range(5) for i in nearest(ids, m, m[n], 3)]
    assert search.search_batch(df, frame.limit(0), 3).count() == 0


def test_thousands_of_queries_meet_packed_vectors(spark, data, monkeypatch):
    ids, m, df = data
    monkeypatch.setattr(search, "ROW_BLOCK", 50)
    monkeypatch.setattr(search, "PAIRS", 4)
    rng = np.random.default_rng(2)
    asked = np.concatenate([m[:40], rng.normal(size=(2960, 16))])
    frame = spark.createDataFrame([(f"q{n}", v.tolist()) for n, v in enumerate(asked)] + [("none", None)], "query_id string, embedding array<double>")
    got = {}
    for r in search.search_batch(df, frame, 4).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["chunk_id"]))
    assert len(got) == 3000 and all(len(v) == 4 for v in got.values())
    for n in (*range(40), *range(40, 3000, 97)):
        assert [c for _, c in sorted(got[f"q{n}"])] == nearest(ids, m, asked[n], 4)


def test_filtered(data):
    ids, m, df = data
    hits = search.search_filtered(df, F.col("label") == 2, m[0].tolist(), 4).orderBy("l2_distance", "chunk_id").collect()
    assert [r["chunk_id"] for r in hits] == nearest(ids[2::4], m[2::4], m[0], 4)


def test_lsh_recall(data):
    ids, m, df = data
    model, hashed = search.fit_lsh(df, bucket_length=4.0)
    found = 0
    for n in range(0, 40, 4):
        hits = {r["chunk_id"] for r in search.search_lsh(model, hashed, m[n].tolist(), 5).collect()}
        found += len(hits & set(nearest(ids, m, m[n], 5)))
    assert found >= 35  # of 50


def test_upsert_append_merge(spark):
    schema = "chunk_id string, embedding array<double>"
    old = spark.createDataFrame([("a", [1.0]), ("b", [2.0])], schema)
    new = spark.createDataFrame([("b", [3.0]), ("c", [4.0])], schema)
    rows = lambda d: sorted((r[0], r[1][0]) for r in d.collect())
    assert rows(search.vector_upsert(old, new)) == [("a", 1.0), ("b", 3.0), ("c", 4.0)]
    assert rows(search.vector_append(old, new)) == [("c", 4.0)]
    assert rows(search.merge_stores(old, new)) == [("a", 1.0), ("b", 2.0), ("c", 4.0)]


def test_tfidf_against_the_formula(spark):
    texts = ["red fish blue fish", "One fish two FISH", "nothing here at all", "!!!"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "chunk_id string, chunk string")
    embedder = embed.TfidfEmbedder.fit(df, dimensions=64)
    got = {r["chunk_id"]: np.array(r["embedding"]) for r in embedder.embed(df).collect()}
    hashing = HashingTF(numFeatures=64)
    counts = np.zeros((4, 64))
    for i, t in enumerate(texts):
        for w in t.lower().replace("!", "").split():
            counts[i, hashing.indexOf(w)] += 1
    idf = np.log((4 + 1) / ((counts > 0).sum(axis=0) + 1))
    for i in range(4):
        v = counts[i] * idf
        v = v / np.linalg.norm(v) if v.any() else v
        assert np.allclose(got[str(i)], v, atol=1e-6)
    hits = search.search_documents(embedder.embed(df), embedder, "blue fish", 2).collect()
    assert hits[0]["chunk_id"] == "0"


def test_embedding_outcome(spark):
    rec = spark.createDataFrame([("a", "completed", ["x"]), ("b", "completed", ["x"]), ("c", "failed", []), ("d", "completed", [])],
                                "doc_id string, status string, output_md array<string>")
    counts = spark.createDataFrame([("a", 3)], "doc_id string, chunk_count int")
    got = {r["doc_id"]: r["embeddings"] for r in embed.embedding_outcome(rec, counts, "parquet").collect()}
    assert tuple(got["a"]) == ("completed", "parquet", 3, None)
    assert tuple(got["b"]) == ("failed", None, None, "Failed to create embeddings")
    assert got["c"] is None and got["d"] is None


def test_pairs_of_one_block_of_queries_are_merged():
    """What leaves a task is the k nearest of each query among all blocks of vectors that its block meets."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    shards = [([f"v{s}_{i}" for i in range(20)], rng.normal(size=(20, 4))) for s in range(5)]
    asked = rng.normal(size=(3, 4))
    rows = pa.RecordBatch.from_pylist([{"ids": ids, "data": m.tobytes(), "q_ids": ["a", "b", "c"], "q_data": asked.tobytes()} for ids, m in shards])
    out = pa.Table.from_batches(search._nearest_in_pairs(4)(iter([rows]))).to_pylist()
    assert len(out) == 12
    names, m = sum((ids for ids, _ in shards), []), np.concatenate([m for _, m in shards])
    for q, v in zip("abc", asked):
        assert [r["chunk_id"] for r in out if r["query_id"] == q] == [names[i] for i in np.argsort(((m - v) ** 2).sum(axis=1))[:4]]


def test_a_block_is_cut_by_what_is_known(monkeypatch):
    """Once a query has its k rows their distance decides which others matter; no further block is partitioned. Ties go by the name."""
    import numpy as np

    rng = np.random.default_rng(4)
    asked, rows = rng.normal(size=(6, 8)), rng.normal(size=(400, 8))
    rows[100:130] = rows[7]
    names = np.array([f"v{i:03d}" for i in rng.permutation(400)], dtype=object)
    cuts = []
    partition = np.partition
    monkeypatch.setattr(search.np, "partition", lambda *a, **b: cuts.append(a) or partition(*a, **b))
    nearest = search._Nearest(list("abcdef"), np.r_[asked[:5], rows[7:8]], 4)
    for at in range(0, 400, 50):
        nearest.add(names[at:at + 50], rows[at:at + 50])
    assert len(cuts) == 1
    for q, best in zip(np.r_[asked[:5], rows[7:8]], nearest.best):
        assert best == sorted(zip(((rows - q) ** 2).sum(axis=1).tolist(), names.tolist()))[:4]
