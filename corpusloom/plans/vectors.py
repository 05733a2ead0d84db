"""Embedding and nearest-neighbour search."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from corpusloom.functions.vectors import cosine, to_matrix
from corpusloom.operators import embed, graph_index, search, similar
from corpusloom.plans import inputs
from corpusloom.plans.catalog import query, table, wide_table

# A query vector, as a client would send it: 64 numbers from a rule.
QUERY = [((i * 37) % 64 - 31.5) / 64.0 for i in range(64)]
QUERY_SQL = "list_transform(range(64), lambda i: (((i * 37) % 64) - 31.5)::DOUBLE / 64.0)::DOUBLE[]"
QUERY_TEXT = "who may use this work and under which license"

LICENSE = inputs.LICENSE_OF_LABEL_SQL


def _similarity(a: str, b: str) -> str:
    return f"round(list_cosine_similarity({a}::DOUBLE[], {b}::DOUBLE[]), 12)"


def _six(hits):
    return hits.withColumn("similarity", F.round("similarity", 6))


@query("cosine_pairs", """
  SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity
  FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
""")
def cosine_pairs(spark, folder):
    vectors = table(spark, folder, "embeddings")
    following = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("following"))
    pairs = vectors.select("vec_id", "embedding").join(following, "vec_id")
    return pairs.select("vec_id", F.round(cosine("embedding", "following"), 6).alias("similarity"))


@query("knn_exact", f"""
  SELECT vec_id AS chunk_id, round(sim, 6) AS similarity
  FROM (SELECT vec_id, {_similarity('embedding', QUERY_SQL)} AS sim FROM embeddings) ORDER BY sim DESC, vec_id LIMIT 10
""")
def knn_exact(spark, folder):
    return _six(search.search(inputs.vectors(spark, folder), QUERY))


@query("search_license_filter", f"""
  SELECT vec_id AS chunk_id, round(sim, 6) AS similarity
  FROM (SELECT vec_id, {_similarity('embedding', QUERY_SQL)} AS sim FROM embeddings
        WHERE {LICENSE} IN ('MIT', 'CC-BY-4.0'))
  ORDER BY sim DESC, vec_id LIMIT 25
""")
def search_license_filter(spark, folder):
    return _six(search.search(inputs.vectors(spark, folder), QUERY, 25, licenses=["MIT", "CC-BY-4.0"]))


@query("hits_hydrate", f"""
  WITH h AS (SELECT vec_id, {_similarity('embedding', QUERY_SQL)} AS sim, {LICENSE} AS license FROM embeddings
             ORDER BY sim DESC, vec_id LIMIT 10)
  SELECT vec_id AS chunk_id, round(sim, 6) AS similarity, license, text AS content, source || '/' || doc_id AS source_url,
         'manuals' AS dataset, 'v2025.3.2' AS version, (SELECT count(*) FROM embeddings) AS total_chunks
  FROM h JOIN documents ON doc_id = vec_id
""")
def hits_hydrate(spark, folder):
    """The search response: hits with content, address, license and the size of the corpus."""
    corpus = inputs.vectors(spark, folder)
    content = table(spark, folder, "documents").select(
        F.col("doc_id").alias("chunk_id"), F.col("text").alias("content"),
        F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("source_url"),
    )
    hits = _six(search.search(corpus, QUERY, 10, keep=("license",)))
    answer = search.search_response(search.hydrate(hits, content, 10), corpus, "manuals", "v2025.3.2")
    return answer.select("chunk_id", "similarity", "license", "content", "source_url", "meta.*")


MEANS_SQL = """
  SELECT label, list(v ORDER BY p) AS mean
  FROM (SELECT label, p, avg(embedding[p]::DOUBLE) AS v
        FROM (SELECT label, embedding, unnest(range(1, len(embedding) + 1)) AS p FROM embeddings) GROUP BY 1, 2)
  GROUP BY 1
"""


@query("knn_batch", f"""
  WITH q AS ({MEANS_SQL}),
  r AS (SELECT q.label AS query_id, vec_id AS chunk_id, {_similarity('embedding', 'mean')} AS sim FROM q, embeddings),
  k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, chunk_id) AS rank FROM r)
  SELECT query_id, chunk_id, round(sim, 6) AS similarity, rank::INTEGER AS rank FROM k WHERE rank <= 10
""")
def knn_batch(spark, folder):
    """The ten vectors closest to the mean vector of every label."""
    corpus = inputs.vectors(spark, folder)
    means = search.mean_vectors(corpus, "label").select(
        F.col("label").alias("query_id"), F.col("mean").alias("query_vector")
    )
    return _six(search.search_many(corpus, means, 10))


@query("knn_neighbours", f"""
  WITH r AS (SELECT q.vec_id AS query_id, e.vec_id AS chunk_id, {_similarity('e.embedding', 'q.embedding')} AS sim
             FROM embeddings q, embeddings e WHERE q.vec_id <> e.vec_id),
  k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, chunk_id) AS rank FROM r)
  SELECT query_id, chunk_id, round(sim, 6) AS similarity, rank::INTEGER AS rank FROM k WHERE rank <= 5
""")
def knn_neighbours(spark, folder):
    """The five nearest other vectors of every vector."""
    corpus = inputs.vectors(spark, folder)
    queries = corpus.select(F.col("chunk_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    return _six(search.search_many(corpus, queries, 5, exclude_self=True))


@query("knn_ivf", f"""
  WITH c AS ({MEANS_SQL}),
  d AS (SELECT vec_id, embedding, label, {_similarity('embedding', 'mean')} AS sim
        FROM (SELECT vec_id, embedding FROM embeddings), c),
  p AS (SELECT vec_id, embedding, label AS cell, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, label) AS n FROM d),
  r AS (SELECT q.vec_id AS query_id, e.vec_id AS chunk_id, {_similarity('e.embedding', 'q.embedding')} AS sim
        FROM p q JOIN p e ON e.cell = q.cell AND q.n <= 3 AND e.n = 1),
  k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, chunk_id) AS rank FROM r)
  SELECT query_id, chunk_id, round(sim, 6) AS similarity, rank::INTEGER AS rank FROM k WHERE rank <= 10
""")
def knn_ivf(spark, folder):
    """Inverted-file search: cells around the label means, three cells probed per query, every vector a query."""
    corpus = inputs.vectors(spark, folder)
    means = search.mean_vectors(corpus, "label").orderBy("label").toArrow()
    centroids = to_matrix(means.column("mean").combine_chunks(), len(QUERY))
    cells = search.assign_cells(corpus, centroids)
    queries = corpus.select(F.col("chunk_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    return _six(search.search_cells(cells, queries, centroids, k=10, probes=3))


ODD_SQL = """
  SELECT vec_id, CASE WHEN vec_id % 97 = 1 THEN NULL WHEN vec_id % 97 = 2 THEN list_transform(embedding, lambda x: 0.0::FLOAT)
                      WHEN vec_id % 97 = 3 THEN embedding[1:8] ELSE embedding END AS v,
         vec_id % 97 BETWEEN 1 AND 3 AS odd
  FROM embeddings
"""


@query("knn_trained", f"""
  WITH o AS ({ODD_SQL}),
  r AS (SELECT q.vec_id AS query_id, e.vec_id AS chunk_id,
               CASE WHEN NOT q.odd AND NOT e.odd THEN {_similarity('e.v', 'q.v')} END AS sim
        FROM o q JOIN o e ON q.vec_id % 10 = 1),
  k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC NULLS LAST, chunk_id) AS rank FROM r)
  SELECT query_id, chunk_id, round(sim, 6) AS similarity, rank::INTEGER AS rank FROM k WHERE rank <= 10
""")
def knn_trained(spark, folder):
    """A stored inverted file with trained cells, all of them probed; some vectors are null, zero or short on both sides."""
    from corpusloom.session import scratch_path

    path, case = scratch_path(spark, "cells"), F.col("vec_id") % 97
    odd = F.when(case == 1, F.lit(None)).when(case == 2, F.transform("embedding", lambda x: F.lit(0.0).cast("float"))) \
        .when(case == 3, F.slice("embedding", 1, 8)).otherwise(F.col("embedding"))
    corpus = table(spark, folder, "embeddings").select(F.col("vec_id").alias("chunk_id"), odd.alias("embedding"))
    centroids = search.train_centroids(corpus, 8)
    search.write_cells(corpus, centroids, path)
    cells = spark.read.parquet(path)
    queries = corpus.where(F.col("chunk_id") % 10 == 1).select(F.col("chunk_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    return _six(search.search_cells(cells, queries, centroids, k=10, probes=len(centroids)))


@query("embed_hash", """
  WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS token FROM documents),
  b AS (SELECT doc_id, (('0x' || substr(md5(token), 1, 8))::BIGINT % 64)::INTEGER AS bucket, count(*) AS c FROM t GROUP BY 1, 2)
  SELECT doc_id, bucket, round((c / sqrt(sum(c * c) OVER (PARTITION BY doc_id)))::FLOAT::DOUBLE, 6) AS weight FROM b
""")
def embed_hash(spark, folder):
    docs = wide_table(spark, folder, "documents", "doc_id", "text")
    vectors = embed.embed_chunks(docs, text="text")
    # The outer form: for the inner one Spark adds a filter on the array, which would run the encoder twice.
    cells = vectors.select("doc_id", F.posexplode_outer("embedding").alias("bucket", "weight"))
    cells = cells.where(F.col("weight") != 0)
    return cells.select("doc_id", "bucket", F.round(F.col("weight").cast("double"), 6).alias("weight"))


@query("search_text", f"""
  WITH docs AS (SELECT doc_id, text FROM ({inputs.DOCUMENTS_SQL}) JOIN documents ON doc_id = id::BIGINT
                WHERE license IN ('MIT', 'Apache-2.0')),
  everything AS (SELECT doc_id, text FROM docs UNION ALL SELECT -1, '{QUERY_TEXT}'),
  t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS token FROM everything),
  b AS (SELECT doc_id, ('0x' || substr(md5(token), 1, 8))::BIGINT % 64 AS bucket, count(*) AS c FROM t GROUP BY 1, 2),
  v AS (SELECT doc_id, bucket, (c / sqrt(sum(c * c) OVER (PARTITION BY doc_id)))::FLOAT::DOUBLE AS w FROM b),
  n AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM v GROUP BY 1),
  s AS (SELECT a.doc_id, round(sum(a.w * q.w) / (any_value(na.norm) * any_value(nq.norm)), 12) AS sim
        FROM v a JOIN v q ON q.doc_id = -1 AND q.bucket = a.bucket JOIN n na ON na.doc_id = a.doc_id
        JOIN n nq ON nq.doc_id = -1 WHERE a.doc_id <> -1 GROUP BY 1)
  SELECT doc_id AS chunk_id, round(sim, 6) AS similarity FROM s ORDER BY sim DESC, doc_id LIMIT 10
""")
def search_text(spark, folder):
    """Text in, hits out: the query text is embedded by the encoder that embedded the corpus."""
    docs = inputs.documents(spark, folder).select(F.col("id").cast("long").alias("chunk_id"), "content", "license")
    corpus = embed.embed_chunks(docs, text="content")
    goal = np.asarray(embed.HashingEncoder().encode([QUERY_TEXT])[0], dtype=float)
    return _six(search.search(corpus, goal.tolist(), 10, licenses=["MIT", "Apache-2.0"]))


@query("attach_embeddings", f"""
  WITH d AS ({inputs.DOCUMENTS_SQL})
  SELECT id AS chunk_id, id AS doc_id, source_url, content AS chunk_content, license, 0 AS chunk_index,
         '{{"lang":"' || lang || '"}}' AS metadata, len(embedding)::INTEGER AS dimensions,
         round(list_sum(embedding::DOUBLE[]), 5) AS total
  FROM d LEFT JOIN embeddings ON vec_id = id::BIGINT
""")
def attach_embeddings(spark, folder):
    docs = inputs.documents(spark, folder)
    chunks = docs.select(
        F.col("id").alias("chunk_id"), F.col("id").alias("doc_id"), "source_url", F.col("content").alias("chunk_content"),
        "license", F.lit(0).alias("chunk_index"), F.struct("lang").alias("metadata"),
    )
    vectors = table(spark, folder, "embeddings").select(F.col("vec_id").cast("string").alias("chunk_id"), "embedding")
    rows = embed.embeddings_table(embed.attach_embeddings(chunks, vectors))
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return rows.select(
        "chunk_id", "doc_id", "source_url", "chunk_content", "license", "chunk_index", "metadata",
        F.size("embedding").alias("dimensions"), F.round(total, 5).alias("total"),
    )


@query("poi_build", """
  SELECT s_suppkey::VARCHAR AS id, name, coalesce(category, 'unknown') AS category, s_acctbal / 100 AS lat, s_acctbal / 50 AS lon,
         name || ' - ' || coalesce(category, '') || ' in ' || coalesce(city, 'unknown') AS description, s_suppkey * 7 AS osm_id
  FROM (SELECT *, CASE WHEN s_acctbal >= 0 THEN s_name ELSE '' END AS name,
               CASE WHEN s_acctbal > 5000 THEN 'shop' END AS category,
               CASE WHEN n_regionkey <> 3 THEN n_name END AS city
        FROM supplier JOIN nation ON s_nationkey = n_nationkey) WHERE name IS NOT NULL AND name <> ''
""")
def poi_build(spark, folder):
    places = table(spark, folder, "supplier").join(
        table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    features = places.select(
        F.col("s_suppkey").alias("id"), F.when(F.col("s_acctbal") >= 0, F.col("s_name")).otherwise("").alias("name"),
        F.when(F.col("s_acctbal") > 5000, "shop").alias("category"), (F.col("s_acctbal") / 100).alias("lat"),
        (F.col("s_acctbal") / 50).alias("lon"), F.when(F.col("n_regionkey") != 3, F.col("n_name")).alias("city"),
        (F.col("s_suppkey") * 7).alias("osm_id"),
    )
    return embed.poi_rows(features)


@query("knn_graph", """
  SELECT count(*) AS queries, CAST(10 * count(*) AS BIGINT) AS found, TRUE AS recall_reached
  FROM embeddings WHERE vec_id % 20 = 0
""")
def knn_graph(spark, folder):
    """Recall of a walk over the neighbour graph, held against the exact search: the neighbours of every twentieth vector."""
    corpus = inputs.vectors(spark, folder).select("chunk_id", "embedding")
    asked = corpus.where(F.col("chunk_id") % 20 == 0).select(F.col("chunk_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    index = graph_index.build_graph(corpus)
    found = graph_index.search_graph(index, asked, 10, exclude_self=True)
    exact = search.search_many(corpus, asked, 10, exclude_self=True)
    judged = graph_index.recall(found, exact)
    right = F.sum("right") >= 0.9 * F.sum("wanted")
    return judged.agg(F.count(F.lit(1)).alias("queries"), F.sum("found").alias("found"), right.alias("recall_reached"))


@query("knn_licensed", """
  SELECT count(*) AS queries, count(*) * (SELECT least(10, count(*)) FROM embeddings WHERE vec_id % 50 = 7) AS found, TRUE AS recall_reached
  FROM embeddings WHERE vec_id % 20 = 0
""")
def knn_licensed(spark, folder):
    """Search in trained cells for chunks of a license that few have, held against the exact search."""
    rare = F.when(F.col("chunk_id") % 50 == 7, "ODbL-1.0").otherwise(F.col("license"))
    corpus = inputs.vectors(spark, folder).withColumn("license", rare)
    asked = corpus.where(F.col("chunk_id") % 20 == 0).select(F.col("chunk_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    centroids = search.train_centroids(corpus, 16)
    found = search.search_cells(search.assign_cells(corpus, centroids), asked, centroids, 10, 2, licenses=["ODbL-1.0"])
    exact = search.search_many(corpus.where(F.col("license") == "ODbL-1.0"), asked, 10)
    judged = graph_index.recall(found, exact)
    right = F.sum("right") >= 0.9 * F.sum("wanted")
    return judged.agg(F.count(F.lit(1)).alias("queries"), F.sum("found").alias("found"), right.alias("recall_reached"))


@query("similar_documents", """
  WITH RECURSIVE t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS token FROM documents),
  b AS (SELECT doc_id, (('0x' || substr(md5(token), 1, 8))::BIGINT % 64)::INTEGER AS bucket, count(*) AS c FROM t GROUP BY 1, 2),
  w AS (SELECT doc_id, bucket, (c / sqrt(sum(c * c) OVER (PARTITION BY doc_id)))::FLOAT AS weight FROM b),
  v AS (SELECT d.doc_id, list(coalesce(w.weight, 0)::DOUBLE ORDER BY place) AS vector
        FROM (SELECT DISTINCT doc_id FROM w) d CROSS JOIN range(64) r(place) LEFT JOIN w ON w.doc_id = d.doc_id AND w.bucket = place
        GROUP BY 1),
  n AS (SELECT vector, min(doc_id) AS node, count(*) AS copies FROM v GROUP BY 1),
  l AS MATERIALIZED (SELECT x.node AS a, y.node AS b FROM n x JOIN n y
                     ON x.node <> y.node AND round(list_cosine_similarity(x.vector, y.vector), 12) >= 0.98),
  reached AS (SELECT node AS a, node AS b FROM n UNION SELECT reached.a, l.b FROM reached JOIN l ON l.a = reached.b),
  g AS (SELECT a, min(b) AS group_id FROM reached GROUP BY 1),
  k AS (SELECT a, count(*) AS links FROM l GROUP BY 1),
  m AS (SELECT doc_id, group_id, coalesce(links, 0) AS links, copies FROM v JOIN n USING (vector) JOIN g ON g.a = node LEFT JOIN k ON k.a = node)
  SELECT doc_id, coalesce(group_id, doc_id) AS group_id, coalesce(links, 0) AS links, coalesce(copies, 1) AS copies
  FROM (SELECT doc_id FROM documents) LEFT JOIN m USING (doc_id)
""")
def similar_documents(spark, folder):
    """Groups of documents whose vectors are alike, with the links of each; documents without a vector are alone."""
    docs = wide_table(spark, folder, "documents", "doc_id", "text")
    vectors = embed.embed_chunks(docs, text="text").select("doc_id", "embedding")
    return similar.similar_groups(vectors, 0.98, chunk_id="doc_id")
