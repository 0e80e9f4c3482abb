import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseweave.operators import search, vector_index


@pytest.fixture
def clustered(spark):
    """A catalog in clusters and queries near some of them."""
    rng = np.random.default_rng(1)
    middles = rng.normal(0, 1, (24, 16))
    row = lambda m, s: (m + rng.normal(0, s, 16)).tolist()
    base = [(f"p{i:04}", None, row(middles[i % 24], 0.08)) for i in range(1200)]
    base += [("p9998", "x", None), ("p9999", "x", [0.0] * 16), ("p9997", "x", [float("nan")] * 16)]
    queries = [(i, row(middles[i % 5], 0.08)) for i in range(60)] + [(90, None), (91, [0.0] * 16)]
    return (
        spark.createDataFrame(base, "base_id string, base_label string, base_on array<double>").repartition(3),
        spark.createDataFrame(queries, "row bigint, vector array<double>").repartition(2),
    )


def everything(base, queries, k):
    """Distances of all pairs."""
    b = [(r["base_id"], np.array(r["base_on"])) for r in base.collect() if r["base_on"] and np.isfinite(r["base_on"]).all() and any(r["base_on"])]
    out = []
    for q in queries.collect():
        if q["vector"] and any(q["vector"]):
            v = np.array(q["vector"])
            near = sorted((round(1 - v @ x / np.linalg.norm(v) / np.linalg.norm(x), 9), i) for i, x in b)[:k]
            out += [(q["row"], i, pytest.approx(d, abs=2e-9)) for d, i in near]
    return sorted(out, key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize(("cells", "block_bytes"), [(1, 1 << 20), (24, 1 << 20), (24, 2000), (400, 1 << 20)])
def test_same_rows_as_all_pairs(clustered, rows, cells, block_bytes):
    base, queries = clustered
    index = vector_index.build(base, cells)
    assert index.sizes.sum() == 1200
    found = rows(vector_index.search(index, queries, 7, block_bytes=block_bytes), "row", "base_id", "distance")
    assert sorted(found, key=lambda r: (r[0], r[1])) == everything(base, queries, 7)


def test_cells_are_skipped(clustered, monkeypatch):
    base, queries = clustered
    index = vector_index.build(base, 24)
    looked = []
    real = vector_index._look
    monkeypatch.setattr(vector_index, "_look", lambda i, asked, *a: looked.append(asked.select(F.sum(F.size("cells"))).first()[0] or 0) or real(i, asked, *a))
    vector_index.search(index, queries, 7).count()
    assert len(looked) == 2 and sum(looked) < 60 * (index.sizes > 0).sum() / 3


def test_probes_limit_and_recall(clustered):
    base, queries = clustered
    index = vector_index.build(base, 24)
    exact = vector_index.search(index, queries, 7).cache()
    some = vector_index.search(index, queries, 7, probes=3)
    assert 0.9 <= vector_index.recall(some, exact) <= 1 and vector_index.recall(exact, exact) == 1


def test_every_vector_counts_when_the_sample_misses(spark, rows):
    base = spark.createDataFrame([(str(i), None, [1.0, float(i)]) for i in range(50)], "base_id string, base_label string, base_on array<double>")
    queries = spark.createDataFrame([(1, [1.0, 3.0])], "row bigint, vector array<double>")
    index = vector_index.build(base, 2, sample_per_cell=1)
    assert rows(vector_index.search(index, queries, 2), "base_id") == [("2",), ("3",)] or rows(
        vector_index.search(index, queries, 1), "base_id"
    ) == [("3",)]


def test_nothing_to_find(spark, clustered):
    base, queries = clustered
    assert vector_index.search(vector_index.build(base.limit(0)), queries, 3).count() == 0
    blank = base.where("base_label = 'x'")
    assert vector_index.search(vector_index.build(blank), queries, 3).count() == 0
    assert vector_index.search(vector_index.build(base), queries.limit(0), 3).count() == 0


def test_search_uses_it_above_the_bound(spark, rows):
    docs = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    id_, vector = docs.columns[:2]
    left = docs.select(F.col(id_).cast("string").alias("service_request_id"), F.col(vector).alias("embedding"))
    right = left.withColumnRenamed("service_request_id", "policy_id")
    here, there = (search.nearest(left, right, 4, max_broadcast_bytes=n) for n in (1 << 30, 4096))
    read = lambda df: rows(df.select("service_request_id", F.col("candidates.base_id").cast("string")))
    assert read(here) == read(there)


def test_centroids_take_bounded_memory(monkeypatch):
    monkeypatch.setattr(vector_index, "ROUNDS", 1)
    unit = np.random.default_rng(2).normal(0, 1, (20_000, 4))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    tracemalloc.start()
    learned = vector_index.learn_centroids(unit, 2_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert learned.shape == (2_000, 4) and peak < 64 << 20  # all distances at once are 320 MB


def test_a_query_is_sent_to_a_block_once(spark, rows, monkeypatch):
    """Without clusters no cell can be skipped, and cells are far more than blocks."""
    rng = np.random.default_rng(3)
    vectors = rng.normal(0, 1, (400, 16)).tolist()
    base = spark.createDataFrame([(f"p{i:03}", None, v) for i, v in enumerate(vectors)], "base_id string, base_label string, base_on array<double>")
    queries = spark.createDataFrame(list(enumerate(vectors[:40])), "row bigint, vector array<double>")
    index = vector_index.build(base, 100)
    looked = []
    real = vector_index._look
    monkeypatch.setattr(vector_index, "_look", lambda i, asked, *a: looked.append(asked.select(F.sum(F.size("cells"))).first()[0] or 0) or real(i, asked, *a))
    found = rows(vector_index.search(index, queries, 5, block_bytes=400 * 128 // 3), "row", "base_id", "distance")
    assert sorted(found, key=lambda r: (r[0], r[1])) == everything(base, queries, 5)
    assert sum(looked) <= 40 * 8
