"""A navigable neighbour graph over vectors: built by rounds of joins, walked by rounds of joins.

The graph has one node per different vector, so copies of a vector, however many, are one node with members. Every node keeps its
``degree`` nearest known nodes. First edges come from random projections: vectors that lie next to each other along a random direction
are compared in small blocks. Then neighbours of a node are compared with one another, round by round (NN-descent). The lists that are
compared are bounded on both sides: a node is in at most ``2 * degree`` of them and none has more than ``2 * degree`` members, so no task
ever holds the pairs of a cell, a hub or a group of copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import arrow_udf

from corpusloom.functions.vectors import RANK_DIGITS, to_matrix, unit_rows
from corpusloom.operators.search import _top
from corpusloom.operators.skew import join_on_hot_key
from corpusloom.session import cut_lineage

# Vectors that are compared where they lie next to each other along a direction, and the number of directions.
BLOCK, DIRECTIONS = 96, 4
# Better neighbours that a node learns from one list at most.
LEARNT = 5
# Nodes where a walk may start.
ENTRIES = 256

_EDGE = "node long, neighbour long, similarity double"
_ENTERED = pa.list_(pa.struct([("node", pa.int64()), ("similarity", pa.float64())]))


@dataclass
class GraphIndex:
    """``nodes`` (node, vector of length one), ``edges`` (node, neighbour, similarity), ``members`` (node, chunk id): stored tables."""

    nodes: DataFrame
    edges: DataFrame
    members: DataFrame
    width: int

    def write(self, path: str) -> None:
        """Store the index below ``path``."""
        for name in ("nodes", "edges", "members"):
            getattr(self, name).write.mode("errorifexists").parquet(f"{path}/{name}")

    @staticmethod
    def read(spark, path: str) -> GraphIndex:
        nodes, edges, members = (spark.read.parquet(f"{path}/{name}") for name in ("nodes", "edges", "members"))
        first = nodes.select(F.size("vector")).first()
        return GraphIndex(nodes, edges, members, first[0] if first else 1)


def build_graph(
    corpus: DataFrame, degree: int = 16, rounds: int = 4, chunk_id: str = "chunk_id", vector: str = "embedding", seed: int = 42
) -> GraphIndex:
    """The neighbour graph of all vectors (actions). Vectors without direction, or of another width than most, are left out."""
    width = corpus.where(F.size(vector) > 0).agg(F.mode(F.size(vector))).first()[0] or 1
    kind = "array<float>"

    @arrow_udf(kind)
    def unit(vectors: pa.Array) -> pa.Array:
        rows = unit_rows(to_matrix(vectors, width)).astype(np.float32)
        rows[~np.isfinite(rows).all(axis=1)] = np.nan
        offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * np.int32(width))
        return pa.ListArray.from_arrays(offsets, pa.array(rows.ravel()), mask=pa.array(np.isnan(rows).any(axis=1)))

    # Two chained hashes stand for a vector: 128 bits.
    same = F.concat_ws(":", F.xxhash64("vector"), F.xxhash64(F.lit(seed), "vector"))
    rows = corpus.select(F.col(chunk_id).alias("chunk_id"), unit(vector).alias("vector")).where(F.col("vector").isNotNull())
    rows = cut_lineage(rows.withColumn("key", same))
    firsts = rows.groupBy("key").agg(F.any_value("vector").alias("vector"))
    nodes = cut_lineage(firsts.select(F.xxhash64("key").alias("node"), "key", "vector"))
    members = cut_lineage(join_on_hot_key(rows.select("key", "chunk_id"), nodes.select("key", "node"), "key").select("node", "chunk_id"))
    nodes = nodes.select("node", "vector")
    edges = cut_lineage(_nearest(_first_edges(nodes, degree, width, seed), degree))
    for number in range(rounds):
        edges = cut_lineage(_nearest(edges.unionByName(_descend(nodes, edges, degree, width, seed + number)), degree))
    return GraphIndex(nodes, edges, members, width)


def _first_edges(nodes: DataFrame, degree: int, width: int, seed: int) -> DataFrame:
    """Edges between vectors that lie close along random directions: ranges of each direction, compared block by block."""
    shares = np.random.default_rng(seed).standard_normal((DIRECTIONS, width))

    def along(direction: np.ndarray) -> Column:
        @arrow_udf("double")
        def place(vectors: pa.Array) -> pa.Array:
            return pa.array(to_matrix(vectors, width) @ direction)

        return place("vector")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held = np.zeros(0, np.int64), np.zeros((0, width))
        for batch in batches:
            ids = np.r_[ids, batch.column(0).to_numpy()]
            held = np.vstack([held, to_matrix(batch.column(1), width)])
            while len(ids) >= 2 * BLOCK:
                yield _best_of(ids[:BLOCK], held[:BLOCK], degree)
                # Half a block stays, so that neighbours across a border meet as well.
                ids, held = ids[BLOCK // 2 :], held[BLOCK // 2 :]
        if len(ids) > 1:
            yield _best_of(ids, held, degree)

    found = None
    for direction in shares:
        lined = nodes.withColumn("place", along(direction)).repartitionByRange(F.col("place"), F.col("node"))
        lined = lined.sortWithinPartitions("place", "node").select("node", "vector").mapInArrow(compare, _EDGE)
        found = lined if found is None else found.unionByName(lined)
    return found


def _best_of(ids: np.ndarray, vectors: np.ndarray, kept: int) -> pa.RecordBatch:
    """Edges from each of some nodes to its nearest others among them."""
    scores = vectors @ vectors.T
    np.fill_diagonal(scores, -np.inf)
    kept = min(kept, len(ids) - 1)
    best = np.argpartition(-scores, kept - 1, axis=1)[:, :kept]
    found = np.round(np.take_along_axis(scores, best, axis=1), RANK_DIGITS)
    arrays = [np.repeat(ids, kept), ids[best].ravel(), found.ravel()]
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["node", "neighbour", "similarity"])


def _nearest(edges: DataFrame, degree: int) -> DataFrame:
    """The ``degree`` nearest neighbours of every node, each once. A node has a bounded number of edges here."""
    once = edges.groupBy("node", "neighbour").agg(F.max("similarity").alias("similarity"))
    order = Window.partitionBy("node").orderBy(F.desc("similarity"), "neighbour")
    return once.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= degree).drop("_rank")


def _some(pairs: DataFrame, key: str, other: str, most: int, seed: int) -> DataFrame:
    """At most ``most`` pairs of every key, drawn by a hash. In two steps, so that a hub is not sorted in one task."""
    drawn = pairs.withColumn("_draw", F.xxhash64(key, other, F.lit(seed)))
    salted = Window.partitionBy(key, F.pmod(F.col("_draw"), F.lit(64))).orderBy("_draw")
    drawn = drawn.withColumn("_rank", F.row_number().over(salted)).where(F.col("_rank") <= most)
    whole = Window.partitionBy(key).orderBy("_draw")
    return drawn.withColumn("_rank", F.row_number().over(whole)).where(F.col("_rank") <= most).select(key, other)


def _descend(nodes: DataFrame, edges: DataFrame, degree: int, width: int, seed: int) -> DataFrame:
    """Edges learnt in one round: the neighbours of a node, and some nodes it is a neighbour of, are compared among themselves."""
    forward = edges.select(F.col("node").alias("of"), F.col("neighbour").alias("near"))
    backward = _some(edges.select(F.col("neighbour").alias("of"), F.col("node").alias("near")), "of", "near", degree, seed)
    around = forward.unionByName(backward).distinct()  # at most 2 * degree rows of every ``of``
    listed = _some(around.select(F.col("near").alias("centre"), F.col("of").alias("node")), "centre", "node", 2 * degree, seed + 1)
    lists = listed.join(nodes, "node").groupBy("centre").agg(F.collect_list("node").alias("ids"), F.flatten(F.collect_list("vector")).alias("vectors"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, values = batch.column(0), batch.column(1)
            bounds, every = ids.offsets.to_numpy(), ids.flatten().to_numpy()
            matrix = values.flatten().to_numpy().astype(np.float64).reshape(-1, width)
            starts = bounds - bounds[0]
            parts = [_best_of(every[a:b], matrix[a:b], LEARNT) for a, b in zip(starts, starts[1:]) if b - a > 1]
            if parts:
                yield pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    return lists.select("ids", "vectors").mapInArrow(compare, _EDGE)


def search_graph(
    index: GraphIndex,
    queries: DataFrame,
    k: int = 10,
    breadth: int = 64,
    most_rounds: int = 12,
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    exclude_self: bool = False,
) -> DataFrame:
    """Approximate top ``k`` per query: (query_id, chunk_id, similarity, rank), by walking the graph.

    A walk holds the ``breadth`` best nodes it has seen. Every round follows the edges of those not yet followed, scores the nodes met for
    the first time, and ends when nothing better turns up (or after ``most_rounds``). It starts from the best of a few entry nodes, drawn
    by a hash. All queries walk together, as joins over (query, node) rows of a bounded number per query; each round is stored (an
    action). A query without direction gets no rows; a larger ``breadth`` finds more.
    """
    width = index.width
    entries = index.nodes.orderBy(F.xxhash64("node")).limit(ENTRIES).collect()
    starts = np.array([r.node for r in entries], np.int64)
    matrix = np.array([r.vector for r in entries], np.float64).reshape(-1, width)

    @arrow_udf("array<struct<node:long,similarity:double>>")
    def entered(vectors: pa.Array) -> pa.Array:
        scores = np.round(unit_rows(to_matrix(vectors, width)) @ matrix.T, RANK_DIGITS)
        best = np.argsort(-scores, axis=1, kind="stable")[:, : max(1, breadth // 4)]
        rows = [[{"node": starts[n], "similarity": s[n]} for n in b] if np.isfinite(s).all() else [] for s, b in zip(scores, best)]
        return pa.array(rows, _ENTERED)

    @arrow_udf("double")
    def dot(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array(np.round(np.einsum("ij,ij->i", unit_rows(to_matrix(a, width)), to_matrix(b, width)), RANK_DIGITS))

    goals = cut_lineage(queries.select(F.col(query_id).alias("query_id"), F.col(query_vector).cast("array<double>").alias("goal")))
    seen = goals.select("query_id", F.explode(entered("goal")).alias("e")).select("query_id", "e.*", F.lit(0).alias("round"))
    order = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "node")
    seen = cut_lineage(seen)
    for number in range(1, most_rounds + 1):
        best = seen.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= breadth)
        fresh = best.where(F.col("round") == number - 1).select("query_id", "node")
        met = fresh.join(index.edges.select("node", "neighbour"), "node").select("query_id", F.col("neighbour").alias("node")).distinct()
        met = met.join(seen.select("query_id", "node"), ["query_id", "node"], "left_anti").join(index.nodes, "node").join(goals, "query_id")
        scored = cut_lineage(met.select("query_id", "node", dot("goal", "vector").alias("similarity"), F.lit(number).alias("round")))
        if scored.isEmpty():
            break
        seen = cut_lineage(seen.unionByName(scored))
    # Nodes of equal similarity are ordered by their members, so one more than k nodes never decides a tie too early.
    hits = seen.withColumn("_rank", F.rank().over(Window.partitionBy("query_id").orderBy(F.desc("similarity")))).where(F.col("_rank") <= k + exclude_self)
    found = hits.select("query_id", "node", "similarity").join(index.members, "node").select("query_id", "chunk_id", "similarity")
    return _top(found, k, "query_id", "chunk_id", exclude_self).withColumnRenamed("query_id", query_id)



def recall(found: DataFrame, exact: DataFrame, query_id: str = "query_id") -> DataFrame:
    """Per query of ``exact``: how many rows it has there, how many were found, and how many of these are right. A row is right if it is as
    similar as the last of the exact ones, so ties count whichever of them was found."""
    least = exact.groupBy(query_id).agg(F.min("similarity").alias("_least"), F.count(F.lit(1)).alias("wanted"))
    counted = least.join(found.select(query_id, F.col("similarity").alias("_found")), query_id, "left").groupBy(query_id, "wanted")
    right = F.col("_found") >= F.col("_least") - 1e-6
    return counted.agg(F.count("_found").alias("found"), F.count(F.when(right, 1)).alias("right"))
