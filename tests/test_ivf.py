"""Inverted-file search: recall against exact search, pruned reads, always k rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagequarry.operators import ivf


def clustered(n, width, seed, centers=12):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centers, width))
    return middle[rng.integers(centers, size=n)] + 0.4 * rng.normal(size=(n, width))


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    m = clustered(3000, 20, 1)
    m[100:1100] = m[5]  # a third of the store is one vector
    rows = spark.createDataFrame([(f"c{i:04d}", v.tolist(), i % 3) for i, v in enumerate(m)] + [("null", None, 0)], "chunk_id string, embedding array<double>, label int")
    return m, ivf.build_ivf(rows.repartition(5), str(tmp_path_factory.mktemp("ivf") / "store"), cells=40)


def test_recall_with_few_cells_read(spark, built):
    m, model = built
    asked = [*range(0, 100, 2), *range(1200, 1300, 2)]
    queries = spark.createDataFrame([(str(i), (m[i] + 0.01).tolist()) for i in asked], "query_id string, embedding array<double>")
    got = {}
    for r in ivf.search_ivf(spark, model, queries, 5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.chunk_id, r.l2_distance))
    hits = 0
    for i in asked:
        exact = ((m - (m[i] + 0.01)) ** 2).sum(axis=1)
        found = sorted(got[str(i)])
        assert [r for r, *_ in found] == [1, 2, 3, 4, 5]
        assert all(abs(exact[int(c[1:])] - d) < 1e-9 for _, c, d in found)
        hits += sum(d <= np.sort(exact)[4] + 1e-9 for *_, d in found)
    assert hits >= 0.9 * 5 * len(asked)
    per_query = ivf.probed_cells(model, queries).groupBy("query_id").count().agg(F.max("count")).first()[0]
    assert per_query < 0.2 * len(model.centroids)


def test_every_vector_is_in_its_nearest_cells(spark, built):
    m, model = built
    stored = ivf.postings(spark, model.path)
    assert stored.count() == 3000 * model.copies == model.sizes.sum() and stored.select("chunk_id", "cell").distinct().count() == 6000 and stored.select("chunk_id").distinct().count() == 3000
    assert set(stored.columns) == {"chunk_id", "embedding", "label", "code", "cell"}
    again = ivf.load_ivf(spark, model.path)
    assert (again.centroids == model.centroids).all() and (again.books == model.books).all()


def test_always_k_rows(spark, built):
    m, model = built
    queries = spark.createDataFrame([("q", m[5].tolist()), ("far", (m[5] + 50).tolist())], "query_id string, embedding array<double>")
    for k in (1, 700, 4000):
        counts = {r.query_id: r["count"] for r in ivf.search_ivf(spark, model, queries, k, probes=1).groupBy("query_id").count().collect()}
        assert counts == {"q": min(k, 3000), "far": min(k, 3000)}
    assert ivf.search_ivf(spark, model, queries.limit(0), 3).count() == 0


def test_only_probed_folders_are_read(spark, built):
    m, model = built
    plan = ivf.postings(spark, model.path).filter(F.col("cell").isin([1, 2])).inputFiles()
    queries = spark.createDataFrame([("q", m[7].tolist())], "query_id string, embedding array<double>")
    cells = [r.cell for r in ivf.probed_cells(model, queries, probes=3).collect()]
    read = ivf.postings(spark, model.path).filter(F.col("cell").isin(cells))._jdf.queryExecution().executedPlan().toString()
    assert len(cells) == 3 and "PartitionFilters: [cell" in read and plan


def test_a_store_of_few_vectors(spark, tmp_path):
    rows = spark.createDataFrame([("a", [1.0, 2.0, 3.0]), ("b", [1.0, 2.0, 4.0])], "chunk_id string, embedding array<double>")
    model = ivf.build_ivf(rows, str(tmp_path / "few"))
    got = ivf.search_ivf(spark, model, spark.createDataFrame([("q", [1.0, 2.0, 3.4])], "query_id string, embedding array<double>"), 5)
    assert [(r.chunk_id, r["rank"]) for r in got.orderBy("rank").collect()] == [("a", 1), ("b", 2)]


def test_what_leaves_a_task_follows_the_queries(spark, built):
    """A block of queries that meets many shards gives no more than ``keep`` rows a query, a vector of two cells counted once."""
    import pyarrow as pa

    m, model = built
    rows = ivf.postings(spark, model.path).select("chunk_id", "code", "cell").toArrow().to_batches()
    shards = [b.to_pylist()[0] for b in ivf._packed(iter(rows), 100)]
    queries = pa.RecordBatch.from_arrays([pa.array(["a", "b"]), pa.array([m[0].tolist(), m[2000].tolist()])], ["query_id", "embedding"])
    blocks = [b.to_pylist()[0] for b in ivf._asked(iter([queries]), model.centroids, model.sizes, 40, 1)]
    for block in blocks:
        met = [{**s, **block} for s in shards if s["group"] == block["group"]]
        assert len(met) > 1
        out = pa.Table.from_batches(ivf._compare(iter([pa.RecordBatch.from_pylist([r]) for r in met]), model.centroids, model.books, 7)).to_pylist()
        assert len(out) == 14 and len({(r["query_id"], r["chunk_id"]) for r in out}) == 14


def test_a_block_of_queries_is_compared_at_once(spark, built):
    """The nearest codes of all queries, as from a table of distances per part; of equal codes a pack holds no more than can be found; and a
    query's cells are one row."""
    import pyarrow as pa

    m, model = built
    rows = ivf.postings(spark, model.path).select("chunk_id", "code", "cell").toArrow()
    packs = [b.to_pylist()[0] for b in ivf._packed(iter(rows.to_batches()), 100_000, 7)]
    stored = rows.to_pylist()
    assert sum(len(p["ids"]) for p in packs) < len(stored) - 900 and all(p["cells"] == sorted(p["cells"]) for p in packs)
    asked = [0, 5, 2000]
    queries = pa.RecordBatch.from_arrays([pa.array(["a", "b", "c"]), pa.array([m[i].tolist() for i in asked])], ["query_id", "embedding"])
    probed = [b.to_pylist() for b in ivf._probe(iter([queries]), model.centroids, model.sizes, 9, 1)]
    assert [(r["query_id"], len(r["cells"])) for r in probed[0]] == [("a", 9), ("b", 9), ("c", 9)]
    blocks = [b.to_pylist()[0] for b in ivf._asked(iter([queries]), model.centroids, model.sizes, 9, 1)]
    got = []
    for block in blocks:
        met = [{**p, **block} for p in packs if p["group"] == block["group"]]
        got += pa.Table.from_batches(ivf._compare(iter([pa.RecordBatch.from_pylist([r]) for r in met]), model.centroids, model.books, 7)).to_pylist()
    for name, i, read in zip("abc", asked, (r["cells"] for r in probed[0])):
        want = {}
        for r in stored:
            if r["cell"] in read:
                rest = ivf._padded((m[i] - model.centroids[r["cell"]])[None, :], model.books)[0]
                far = ((model.books[range(16), list(r["code"])] - rest) ** 2).sum(axis=1).sum()
                want[r["cell"] % ivf.GROUPS, r["chunk_id"]] = min(want.get((r["cell"] % ivf.GROUPS, r["chunk_id"]), (np.inf,)), (far, r["cell"]))
        for group in {g for g, _ in want}:
            best = sorted((far, chunk, cell) for (g, chunk), (far, cell) in want.items() if g == group)[:7]
            assert sorted((r["rough"], r["chunk_id"], r["cell"]) for r in got if r["query_id"] == name and r["cell"] % ivf.GROUPS == group) == best
