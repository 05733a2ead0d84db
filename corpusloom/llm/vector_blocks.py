"""Meeting of queries and candidates in bounded blocks, list by list, and the best per query over all blocks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import arrow_udf

# Rows of one list that meet in one task: candidates and queries.
BLOCK_CANDIDATES, BLOCK_QUERIES = 8192, 4096

Scorer = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[list, list, list]]


def matrix(vectors: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Vectors without nulls as rows of doubles; shorter ones are filled with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == width).all():
        return values.reshape(-1, width)
    rows = np.zeros((len(vectors), width))
    rows[np.arange(width) < lengths[:, None]] = values
    return rows


def usable(vector: Column, nonzero: bool) -> Column:
    """True for vectors without null and non-finite components (and, if asked, with one that is not zero)."""

    @arrow_udf("boolean")
    def check(vectors: pa.Array) -> pa.Array:
        values, lengths = vectors.flatten(), vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        numbers = values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null becomes NaN
        bad, ends = np.r_[0, np.cumsum(~np.isfinite(numbers))], np.cumsum(lengths)
        fine = (bad[ends] == bad[ends - lengths]) & vectors.is_valid().to_numpy(zero_copy_only=False)
        if nonzero:
            some = np.r_[0, np.cumsum(numbers != 0)]
            fine &= some[ends] > some[ends - lengths]
        return pa.array(fine, pa.bool_())

    return check(vector)


def meet(candidates: DataFrame, queries: DataFrame, width: int, k: int, score_type: str, best_first: bool, scorer: Scorer) -> DataFrame:
    """The best ``k`` candidates of each query over the lists that it visits.

    ``candidates`` has ``list``, ``vec_id``, ``vector`` (and ``norm``), ``queries`` ``list``, ``query_id``, ``vector`` and
    ``bound``. A list of more than BLOCK_CANDIDATES rows, or visited by more than BLOCK_QUERIES queries, is cut by a
    hash of the ids, and every block of candidates meets every block of queries of its list in a task of its own. A task
    sends at most ``k`` rows for each query. Counts both sides by list (one row per list comes to the driver, where
    there is a fixed number of lists). A query does not meet its own id.
    """
    sizes = {r[0]: r[1] for r in candidates.groupBy("list").count().collect()}
    asked = {r[0]: r[1] for r in queries.groupBy("list").count().collect()}
    cuts = [(n, -(-sizes[n] // BLOCK_CANDIDATES), -(-asked[n] // BLOCK_QUERIES)) for n in sorted(sizes) if n in asked]
    schema = f"query_id long, vec_id long, score {score_type}"
    spark = candidates.sparkSession
    plan = F.broadcast(spark.createDataFrame(cuts, "list int, _salts int, _blocks int"))
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    part = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    held = candidates.join(plan, "list").select("list", part("vec_id", "_salts").alias("salt"), upto("_blocks").alias("block"), "vec_id", "vector")
    goals = queries.join(plan, "list").select("list", upto("_salts").alias("salt"), part("query_id", "_blocks").alias("block"), "query_id", "vector", "bound")
    kind = pa.int64() if score_type == "long" else pa.float64()

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        found: tuple[list, list, list] = ([], [], [])
        if left.num_rows and right.num_rows:
            found = scorer(
                left.column("vec_id").to_numpy(), matrix(left.column("vector"), width),
                right.column("query_id").to_numpy(), matrix(right.column("vector"), width), right.column("bound").to_numpy(),
            )
        join = lambda parts, t: pa.array(np.concatenate(parts) if parts else [], t)
        return pa.table([join(found[0], pa.int64()), join(found[1], pa.int64()), join(found[2], kind)], ["query_id", "vec_id", "score"])

    keys = ("list", "salt", "block")
    near = held.groupBy(*keys).cogroup(goals.groupBy(*keys)).applyInArrow(score, schema)
    # An id may occur more than once: its best vector counts.
    best = F.max("score") if best_first else F.min("score")
    near = near.groupBy("query_id", "vec_id").agg(best.alias("score"))
    order = F.col("score").desc() if best_first else F.col("score").asc()
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(order, "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


class Best:
    """The best ``k`` different ids found so far for one query; greater scores are better, ties go to the smaller id."""

    def __init__(self, k: int) -> None:
        self.k, self.ids, self.scores = k, np.zeros(0, np.int64), None

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        if self.scores is not None:
            ids, scores = np.r_[self.ids, ids], np.r_[self.scores, scores]
        order = np.lexsort((ids, -scores))
        ids, scores = ids[order], scores[order]
        if len(ids) > 1:
            _, firsts = np.unique(ids, return_index=True)
            if len(firsts) < len(ids):
                firsts.sort()
                ids, scores = ids[firsts], scores[firsts]
        self.ids, self.scores = ids[: self.k], scores[: self.k]

    def least(self) -> float:
        """The score that a further candidate has to reach."""
        return float(self.scores[-1]) if len(self.ids) == self.k else -np.inf
