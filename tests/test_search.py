import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.vectors import cosine, cosine_to
from corpusloom.operators import embed, search


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(7)
    data = rng.normal(size=(400, 8)).astype(np.float32)
    # A third of the corpus is one and the same vector.
    data[100:233] = data[100]
    return data


@pytest.fixture(scope="module")
def corpus(spark, vectors):
    rows = [(f"c{i:04d}", v.tolist(), ("MIT", "ODbL-1.0")[i % 2]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "chunk_id string, embedding array<float>, license string").repartition(7).cache()


def brute(vectors, query, k, allowed=lambda i: True):
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    goal = np.asarray(query, float) / np.linalg.norm(query)
    scores = [(-round(float(unit[i] @ goal), 10), f"c{i:04d}") for i in range(len(vectors)) if allowed(i)]
    return [name for _, name in sorted(scores)[:k]]


def test_search(corpus, vectors):
    query = vectors[100] + 0.1
    hits = search.search(corpus, query.tolist(), 12).collect()
    assert [h.chunk_id for h in hits] == brute(vectors, query, 12)
    only = search.search(corpus, query.tolist(), 12, licenses=["ODbL-1.0"], keep=("license",)).collect()
    assert [h.chunk_id for h in only] == brute(vectors, query, 12, lambda i: i % 2 == 1)
    assert {h.license for h in only} == {"ODbL-1.0"}
    assert search.search(corpus, query.tolist(), 5, licenses=[]).collect() == []


@pytest.mark.parametrize("block", [16_384, 9])
def test_search_many_in_one_and_in_several_blocks(spark, corpus, vectors, block, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_CHUNKS", block)
    monkeypatch.setattr(search, "BLOCK_QUERIES", block)
    queries = [(i, vectors[i].tolist()) for i in range(0, 400, 16)]
    frame = spark.createDataFrame(queries, "query_id long, query_vector array<float>")
    found = {}
    for row in search.search_many(corpus, frame, 7).orderBy("query_id", "rank").collect():
        found.setdefault(row.query_id, []).append(row.chunk_id)
    assert found == {i: brute(vectors, v, 7) for i, v in queries}


def test_no_queries(spark, corpus):
    none = spark.createDataFrame([], "query_id long, query_vector array<float>")
    assert search.search_many(corpus, none, 7).count() == 0


def test_exclude_self(spark, corpus, vectors):
    queries = corpus.select(F.col("chunk_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    rows = search.search_many(corpus, queries, 3, exclude_self=True).where("query_id = 'c0150'").orderBy("rank").collect()
    assert [r.chunk_id for r in rows] == brute(vectors, vectors[150], 3, lambda i: i != 150)


def test_cells(spark, corpus, vectors):
    centroids = search.train_centroids(corpus, 8)
    assert centroids.shape == (8, 8)
    cells = search.assign_cells(corpus, centroids)
    queries = spark.createDataFrame(
        [(i, vectors[i].tolist()) for i in range(0, 400, 5)], "query_id long, query_vector array<float>"
    )
    exact = {(r.query_id, r.chunk_id) for r in search.search_many(corpus, queries, 5).collect()}

    def found(probes):
        rows = search.search_cells(cells, queries, centroids, 5, probes).collect()
        return {(r.query_id, r.chunk_id) for r in rows}

    assert found(len(centroids)) == exact
    some = found(6)
    assert len(some & exact) / len(exact) >= 0.9


def test_stored_cells_are_pruned(spark, corpus, vectors, tmp_path):
    centroids = search.train_centroids(corpus, 4)
    search.write_cells(corpus, centroids, str(tmp_path / "cells"))
    stored = spark.read.parquet(str(tmp_path / "cells"))
    queries = spark.createDataFrame([(0, vectors[0].tolist())], "query_id long, query_vector array<float>")
    near = search.search_cells(stored, queries, centroids, 3, probes=4)
    assert [r.chunk_id for r in near.orderBy("rank").collect()] == brute(vectors, vectors[0], 3)
    pruned = search.search_cells(stored, queries, centroids, 3, probes=1)
    assert "PartitionFilters: [cell" in pruned._jdf.queryExecution().executedPlan().toString().replace("isnotnull(cell", "cell")


@pytest.mark.parametrize("block", [16_384, 2])
def test_odd_vectors_rank_last_everywhere(spark, block, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_CHUNKS", block)
    rows = [("a", [1.0, 0.0]), ("b", None), ("c", [0.0, 0.0]), ("d", [1.0]), ("e", [0.6, 0.8]), ("f", [-1.0, 0.0])]
    corpus = spark.createDataFrame(rows, "chunk_id string, embedding array<float>")
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [3.0])], "query_id long, query_vector array<double>")
    last = [("b", None), ("c", None), ("d", None)]
    wanted = {1: [("a", 1.0), ("e", 0.6), ("f", -1.0), *last]} | {q: [(c, None) for c in "abcdef"] for q in (2, 3, 4)}

    def lists(frame):
        found = {}
        for r in frame.orderBy("query_id", "rank").collect():
            found.setdefault(r.query_id, []).append((r.chunk_id, r.similarity if r.similarity is None else round(r.similarity, 6)))
        return found

    assert lists(search.search_many(corpus, queries, 6)) == wanted
    centroids = search.train_centroids(corpus, 2)
    assert lists(search.search_cells(search.assign_cells(corpus, centroids), queries, centroids, 6, probes=2)) == wanted
    one = search.search(corpus, [1.0, 0.0], 6).collect()
    assert [r.chunk_id for r in one] == ["a", "e", "f", "b", "c", "d"]


def test_hydrate_and_response(corpus, vectors):
    hits = search.search(corpus, vectors[0].tolist(), 4)
    rows = search.search_response(search.hydrate(hits, corpus, 4), corpus, "d", "v1").collect()
    assert len(rows) == 4 and {r.meta.total_chunks for r in rows} == {400} and "embedding" not in rows[0]
    assert "embedding" in search.hydrate(hits, corpus, 4, include_embeddings=True).columns


def test_similarity_of_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0]), (5, [-2.0, 0.0])]
    frame = spark.createDataFrame(rows, "id int, v array<float>").coalesce(1)
    got = {r.id: r.s for r in frame.select("id", cosine_to("v", [3.0, 0.0]).alias("s")).collect()}
    assert got == {1: 1.0, 2: None, 3: None, 4: None, 5: -1.0}
    got = {r.id: r.s for r in frame.select("id", cosine("v", "v").alias("s")).collect()}
    assert got == {1: 1.0, 2: None, 3: None, 4: 1.0, 5: 1.0}
    assert search.similarity_from_distance(0.25) == 0.75


def test_encoder_batches(spark):
    class Recorder:
        def encode(self, texts):
            assert 0 < len(texts) <= 3
            return np.array([[len(t), len(texts)] for t in texts], dtype=float)

    rows = [(i, None if i % 5 == 0 else "x" * i) for i in range(20)]
    frame = spark.createDataFrame(rows, "id int, chunk_content string").coalesce(1)
    got = {r.id: r.embedding for r in embed.embed_chunks(frame, Recorder, batch_size=3).collect()}
    for i, text in rows:
        assert got[i] is None if text is None else got[i][0] == i


def test_embeddings_table(spark):
    rows = spark.createDataFrame([(1, 2, "t", 0, [1.0])], "chunk_id long, doc_id long, chunk_content string, chunk_index long, embedding array<double>")
    table = embed.embeddings_table(rows)
    row = table.first()
    assert (row.chunk_id, row.source_url, row.license, row.metadata) == ("1", "", "", "{}")
    assert table.schema["embedding"].dataType.simpleString() == "array<float>"
    assert table.schema["chunk_index"].dataType.simpleString() == "int"


def test_mean_vectors(spark, corpus, vectors):
    extra = spark.createDataFrame([("x", None, "MIT")], corpus.schema)
    means = {r.license: r["mean"] for r in search.mean_vectors(corpus.unionByName(extra), "license").collect()}
    for i, name in enumerate(("MIT", "ODbL-1.0")):
        assert np.allclose(means[name], vectors[i::2].astype(float).mean(axis=0))


def test_equal_scores_are_kept_up_to_k_a_query():
    ids = pa.array(np.random.default_rng(2).permutation(5000))
    rows, goals = np.ones((5000, 4)) / 2, np.ones((300, 4)) / 2
    rows[ids.to_numpy() % 2 == 1] = np.nan
    rows[ids.to_numpy() == 4444, 0] = 0.9
    for wanted, some in (([4444, 0, 2], goals), ([0, 1, 2], goals * np.nan)):
        keep = search._Keeper(3)
        keep.offer(ids, rows, np.arange(5000), some, np.arange(300))
        # Held: k rows a query, not all that are equal.
        assert keep.size == 3 * 300
        query, chunk, _ = keep.result()
        assert query.tolist() == np.repeat(np.arange(300), 3).tolist()
        assert chunk.to_pylist() == wanted * 300


def test_few_texts_are_strings_at_once():
    seen = []

    class Encoder:
        def encode(self, texts):
            seen.append(len(texts))
            return np.ones((len(texts), 2))

    texts = pa.array([None if i % 7 == 0 else f"{i} " * 2000 for i in range(1000)])
    peaks = []
    for part in (texts[:100], texts):
        tracemalloc.start()
        (found,) = list(embed._encoded(iter([part]), Encoder(), 10))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert found.to_pylist() == [None if t is None else [1.0, 1.0] for t in part.to_pylist()]
    assert max(seen) == 10 and peaks[1] < 2 * peaks[0]
