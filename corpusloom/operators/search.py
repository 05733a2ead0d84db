"""Exact and approximate nearest-neighbour search over an embeddings table.

One query vector travels to the corpus inside the plan. Many queries meet the corpus on the executors, in blocks of bounded
size: a task scores one block of chunks for one block of queries and keeps the best k per query, and only those rows go on.
No pair of rows is ever materialised, and neither side passes through the driver.

A chunk or query without direction (null, zero or of another width) has null similarity to everything. Such chunks rank
last, by id; such a query gets the chunks with the smallest ids.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from corpusloom.functions.vectors import RANK_DIGITS, cosine_to, nearest_row, to_matrix, unit_rows
from corpusloom.operators.skew import BROADCAST_ROWS
from corpusloom.session import cut_lineage

# Chunks and queries of one cell that meet in one task.
BLOCK_CHUNKS, BLOCK_QUERIES = 16_384, 4096
# Ids of hits that are put into a scan, at most.
PUSHED_IDS = 1000
# The cell of chunks without direction.
NO_CELL = -1

# Query rows scored at a time, at most, and scores held at a time, about.
_SLAB, _SCORES = 256, 1 << 20


def search(
    corpus: DataFrame,
    query: Sequence[float],
    k: int = 10,
    licenses: list[str] | None = None,
    chunk_id: str = "chunk_id",
    vector: str = "embedding",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """The ``k`` chunks most similar to one query vector: (chunk_id, <keep>, similarity), best first.

    ``licenses`` is pushed to the scan; None means all. Only the id, the vector and the ``keep`` columns are read: keep
    short columns, and use :func:`hydrate` for the content of the hits.
    """
    if licenses is not None:
        corpus = corpus.where(F.col("license").isin(licenses))
    scored = corpus.select(F.col(chunk_id), *keep, cosine_to(vector, query).alias("similarity"))
    order = F.round("similarity", RANK_DIGITS).desc_nulls_last()
    return scored.orderBy(order, F.col(chunk_id)).limit(k)


def hydrate(
    hits: DataFrame, content: DataFrame, max_hits: int, key: str = "chunk_id", include_embeddings: bool = False
) -> DataFrame:
    """Add the content columns to search hits.

    ``max_hits`` is what the search guarantees (``k``, or ``k`` times the number of queries). Up to ``PUSHED_IDS`` the hits are found now (an
    action) and their ids go into the scan of the content, which skips what cannot hold them; up to ``BROADCAST_ROWS`` the hits are
    broadcast and the content is filtered in place; more hits join by shuffle.
    """
    if max_hits <= PUSHED_IDS:
        hits = cut_lineage(hits)
        found = hits.select(key).distinct().limit(PUSHED_IDS + 1).collect()
        if len(found) <= PUSHED_IDS:
            content = content.where(F.col(key).isin([row[0] for row in found]))
    if not include_embeddings and "embedding" in content.columns:
        content = content.drop("embedding")
    return content.join(F.broadcast(hits) if max_hits <= BROADCAST_ROWS else hits, key)


def search_response(hits: DataFrame, corpus: DataFrame | int, dataset: str, version: str) -> DataFrame:
    """Hits with a ``meta`` struct: dataset, version and the number of chunks searched, counted unless it is given."""
    total = F.lit(corpus).cast("long") if isinstance(corpus, int) else corpus.agg(F.count(F.lit(1))).scalar()
    meta = F.struct(F.lit(dataset).alias("dataset"), F.lit(version).alias("version"), total.alias("total_chunks"))
    return hits.withColumn("meta", meta)


def similarity_from_distance(distance):
    """Cosine distance, as an index reports it, to similarity."""
    return 1 - distance


def search_many(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 10,
    chunk_id: str = "chunk_id",
    vector: str = "embedding",
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    exclude_self: bool = False,
) -> DataFrame:
    """Exact top ``k`` per query row: (query_id, chunk_id, similarity, rank).

    Every block of chunks meets every block of queries: the work of an exact search. For very many queries
    :func:`search_cells` visits a part of the corpus only. Both sides are counted first (an action).
    """
    one = F.lit(0).alias("cell")
    chunks = corpus.select(one, F.col(chunk_id), F.col(vector))
    goals = queries.select(one, F.col(query_id), F.col(query_vector).cast("array<double>").alias(query_vector))
    return _meet(chunks, goals, k, exclude_self)


def assign_cells(corpus: DataFrame, centroids: np.ndarray, vector: str = "embedding") -> DataFrame:
    """Add ``cell``, the index of the nearest centroid; ``NO_CELL`` for a vector without direction."""
    return corpus.withColumn("cell", F.coalesce(nearest_row(vector, centroids), F.lit(NO_CELL)))


def train_centroids(corpus: DataFrame, cells: int, vector: str = "embedding", seed: int = 42) -> np.ndarray:
    """Centroids of the unit vectors by k-means on the cluster (an action). The points are stored first, as k-means scans
    them many times; vectors without direction, and of another width than most, are left out."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    square = F.aggregate(vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    directed = corpus.select(vector).where((square > 0) & (square < float("inf")))
    directed = cut_lineage(directed)
    width = directed.agg(F.mode(F.size(vector))).scalar()
    points = directed.where(F.size(vector) == width).select(array_to_vector(vector).alias("features"))
    model = KMeans(k=cells, seed=seed, distanceMeasure="cosine").fit(points)
    return np.array(model.clusterCenters())


def mean_vectors(corpus: DataFrame, group: str, vector: str = "embedding") -> DataFrame:
    """Element-wise mean vector per group: (group, mean), without gathering a group's vectors in one place.

    Every Arrow batch is reduced to one sum per group; these meet as (group, position) partial aggregates. Null vectors
    do not count.
    """
    shape = T.StructType([
        corpus.schema[group], T.StructField("n", T.LongType()), T.StructField("sums", T.ArrayType(T.DoubleType())),
    ])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(1).is_valid())
            if batch.num_rows:
                names = batch.column(0).dictionary_encode(null_encoding="encode")
                rows = to_matrix(batch.column(1), pa.compute.max(batch.column(1).value_lengths()).as_py())
                sums = np.zeros((len(names.dictionary), rows.shape[1]))
                np.add.at(sums, names.indices.to_numpy(), rows)
                counts = np.bincount(names.indices.to_numpy(), minlength=len(sums))
                offsets = pa.array(np.arange(len(sums) + 1, dtype=np.int32) * np.int32(rows.shape[1]))
                parts = [names.dictionary, pa.array(counts), pa.ListArray.from_arrays(offsets, pa.array(sums.ravel()))]
                yield pa.RecordBatch.from_arrays(parts, names=shape.names)

    sums = corpus.select(group, vector).mapInArrow(add_up, schema=shape)
    parts = sums.select(group, "n", F.posexplode("sums").alias("position", "value"))
    means = parts.groupBy(group, "position").agg((F.sum("value") / F.sum("n")).alias("value"))
    ordered = F.array_sort(F.collect_list(F.struct("position", "value")))
    return means.groupBy(group).agg(F.transform(ordered, lambda p: p["value"]).alias("mean"))


def write_cells(corpus: DataFrame, centroids: np.ndarray, path: str, vector: str = "embedding") -> None:
    """Store the corpus by cell. The rebalance splits a crowded cell over several files and tasks."""
    cells = assign_cells(corpus, centroids, vector)
    cells.hint("rebalance", "cell").write.mode("errorifexists").partitionBy("cell").parquet(path)


def search_cells(
    cells: DataFrame,
    queries: DataFrame,
    centroids: np.ndarray,
    k: int = 10,
    probes: int = 4,
    chunk_id: str = "chunk_id",
    vector: str = "embedding",
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    exclude_self: bool = False,
    licenses: list[str] | None = None,
    enough: int = 4,
) -> DataFrame:
    """Approximate top ``k`` per query from the ``probes`` cells nearest to it, ranked exactly.

    ``cells`` carries the ``cell`` column of :func:`assign_cells`; stored with :func:`write_cells` it is a partition
    column, so cells that no query probes are not read. Every query also visits the chunks without direction, which rank
    last; a query without direction probes the first cells. Both sides are counted by cell first (an action).

    With ``licenses`` only chunks of these (column ``license``) are looked at. The cells are chosen by how many of them they hold, which
    is counted (an action; one row per cell): cells without any are passed over, and a query goes on, nearest cells first, until its
    cells hold ``enough * k`` of them. So a rare license still gives ``k`` rows where there are as many.
    """
    goals = unit_rows(np.asarray(centroids, dtype=np.float64))
    if licenses is not None:
        cells = cells.where(F.col("license").isin(licenses))
        held = np.zeros(len(goals), np.int64)
        for row in cells.where(F.col("cell") != NO_CELL).groupBy("cell").count().collect():
            held[row["cell"]] = row["count"]

    @arrow_udf("array<int>")
    def probed(vectors: pa.Array) -> pa.Array:
        scores = np.round(unit_rows(to_matrix(vectors, goals.shape[1])) @ goals.T, RANK_DIGITS)
        order = np.argsort(-np.nan_to_num(scores, nan=-2.0), axis=1, kind="stable").astype(np.int32)
        if licenses is None:
            order = order[:, :probes]
        else:
            found = held[order]
            ahead = np.cumsum(found, axis=1) - found, np.cumsum(found > 0, axis=1) - (found > 0)
            wanted = (found > 0) & ((ahead[0] < enough * k + exclude_self) | (ahead[1] < probes))
            return pa.array([[*row[some].tolist(), NO_CELL] for row, some in zip(order, wanted)], pa.list_(pa.int32()))
        return pa.array([[*row, NO_CELL] for row in order.tolist()], pa.list_(pa.int32()))

    wanted = queries.select(F.col(query_id), F.col(query_vector).cast("array<double>").alias(query_vector))
    visits = cut_lineage(wanted.select(F.explode(probed(query_vector)).alias("cell"), query_id, query_vector))
    return _meet(cells.select("cell", F.col(chunk_id), F.col(vector)), visits, k, exclude_self)


def _meet(chunks: DataFrame, queries: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    """Top ``k`` of queries over the cells that they visit; columns of both sides: cell, id, vector.

    A cell with many rows on either side is cut by a hash of the ids, so a block of each is what a task holds. One row per
    cell comes to the driver.
    """
    spark = chunks.sparkSession
    chunk_id, vector, query_id, query_vector = *chunks.columns[1:], *queries.columns[1:]
    asked = {r[0]: r[1] for r in queries.groupBy("cell").count().collect()}
    width = queries.agg(F.max(F.size(query_vector))).scalar()
    chunks = chunks.where(F.col("cell").isin(sorted(asked)))
    held = {r[0]: r[1] for r in chunks.groupBy("cell").count().collect()}
    cuts = [(cell, -(-held[cell] // BLOCK_CHUNKS), -(-asked[cell] // BLOCK_QUERIES)) for cell in sorted(held)]
    queries = queries.withColumn("_width", width)
    if len(cuts) > 1:
        plan = F.broadcast(spark.createDataFrame(cuts, "cell int, _parts int, _blocks int"))
        chunks, queries = chunks.join(plan, "cell"), queries.join(plan, "cell")
    else:  # a single cell, which an exact search has: its counts are literals, a join on it would have no key
        cell, parts, blocks = cuts[0] if cuts else (0, 1, 1)
        counts = {"_parts": F.lit(parts), "_blocks": F.lit(blocks)}
        chunks, queries = chunks.withColumns(counts), queries.where(F.col("cell") == cell).withColumns(counts)

    def part(key: str, count: str):
        return F.pmod(F.xxhash64(key), F.col(count)).cast("int")

    def every(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    left = chunks.select("cell", part(chunk_id, "_parts").alias("part"), every("_blocks").alias("block"), chunk_id, vector)
    right = queries.select(
        "cell", every("_parts").alias("part"), part(query_id, "_blocks").alias("block"), query_id, query_vector, "_width"
    )
    shape = T.StructType([
        T.StructField(query_id, queries.schema[query_id].dataType),
        T.StructField(chunk_id, chunks.schema[chunk_id].dataType),
        T.StructField("similarity", T.DoubleType()),
    ])
    kept = k + exclude_self

    def score(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        mine, theirs = mine.combine_chunks(), theirs.combine_chunks()
        ids, goals = theirs.column(query_id).combine_chunks(), theirs.column(query_vector).combine_chunks()
        keep = _Keeper(kept)
        if mine.num_rows and theirs.num_rows:
            wide = theirs.column("_width")[0].as_py() or 0
            rows = unit_rows(to_matrix(mine.column(vector).combine_chunks(), wide))
            everything = np.arange(len(rows)), np.arange(len(ids))
            keep.offer(mine.column(chunk_id).combine_chunks(), rows, everything[0], unit_rows(to_matrix(goals, wide)), everything[1])
        if not keep.size:
            empty = [ids[:0], mine.column(chunk_id).combine_chunks()[:0], pa.array([], pa.float64())]
            return pa.table(empty, names=shape.names)
        query, chunk, scores = keep.result()
        missing = ~np.isfinite(scores)
        return pa.table([ids.take(pa.array(query)), chunk, pa.array(scores, mask=missing)], names=shape.names)

    keys = ("cell", "part", "block")
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(score, shape)
    return _top(best, k, query_id, chunk_id, exclude_self)


class _Keeper:
    """Candidates of one task, cut back to the best ``k`` per query whenever they have doubled."""

    def __init__(self, k: int):
        self.k = k
        self.parts: list[tuple[np.ndarray, pa.Array, np.ndarray]] = []
        self.size = 0
        self.limit = 1 << 16

    def offer(self, ids: pa.Array, rows: np.ndarray, row_index: np.ndarray, matrix: np.ndarray,
              query_index: np.ndarray) -> None:
        # By rising id, so that of equal scores, however many, the first ones are those to keep.
        row_index = row_index[pa.compute.array_sort_indices(ids.take(pa.array(row_index)), null_placement="at_start").to_numpy()]
        goals = rows[row_index].T
        slab_rows = max(1, min(_SLAB, _SCORES // max(1, len(row_index))))
        for start in range(0, len(query_index), slab_rows):
            slab = query_index[start : start + slab_rows]
            scores = np.round(matrix[slab] @ goals, RANK_DIGITS)
            scores[np.isnan(scores)] = -np.inf
            wanted = np.ones(scores.shape, bool)
            if scores.shape[1] > self.k:
                # What is above the k-th best score of its query, and as many of those equal to it as there is room for.
                floor = np.partition(scores, -self.k, axis=1)[:, -self.k][:, None]
                above, ties = scores > floor, scores == floor
                room = self.k - above.sum(axis=1, keepdims=True)
                wanted = above | (ties & (np.cumsum(ties, axis=1, dtype=np.int32) <= room))
            query, column = np.nonzero(wanted)
            self._add(slab[query], ids.take(pa.array(row_index[column])), scores[query, column])

    def _add(self, query: np.ndarray, chunk: pa.Array, score: np.ndarray) -> None:
        if len(query):
            self.parts.append((query, chunk, score))
            self.size += len(query)
            if self.size > self.limit:
                self.parts = [self.result()]
                self.size = len(self.parts[0][0])
                self.limit = max(1 << 16, 2 * self.size)

    def result(self) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        query = np.concatenate([p[0] for p in self.parts])
        chunk = pa.concat_arrays([p[1] for p in self.parts])
        score = np.concatenate([p[2] for p in self.parts])
        ranked = chunk.dictionary_encode()
        place = np.empty(len(ranked.dictionary), dtype=np.int64)
        place[pa.compute.array_sort_indices(ranked.dictionary).to_numpy()] = np.arange(len(place))
        order = np.lexsort((place[ranked.indices.to_numpy()], -score, query))
        query, score = query[order], score[order]
        first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
        rank = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)]))
        kept = rank < self.k
        return query[kept], chunk.take(pa.array(order[kept])), score[kept]


def _top(candidates: DataFrame, k: int, query_id: str, chunk_id: str, exclude_self: bool) -> DataFrame:
    """Merge the candidates of all tasks. Two rounds, so one query never gathers the rows of every task at once."""
    if exclude_self:
        candidates = candidates.where(F.col(query_id) != F.col(chunk_id))
    order = [F.col("similarity").desc_nulls_last(), F.col(chunk_id)]
    salted = candidates.withColumn("_salt", F.pmod(F.xxhash64(chunk_id), F.lit(32)))
    first = Window.partitionBy(query_id, "_salt").orderBy(*order)
    salted = salted.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).drop("_salt")
    last = Window.partitionBy(query_id).orderBy(*order)
    return salted.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
