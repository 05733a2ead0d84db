"""Exact top-k by integer inner product: norm-bucketed retrieval with coordinate and length pruning."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from corpusloom.llm.common import stored
from corpusloom.llm.vector_blocks import Best, matrix, meet, usable

# Buckets by length; candidates that give each query its first threshold; candidates scored together; coordinates looked at.
BUCKETS, SEEDS, STRIP, FOCUS = 32, 1024, 512, 8
# Local cosine thresholds from which coordinates prune better than lengths alone.
COORDINATE_FROM = 0.35


def quantise(rows: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(rows * scale)


def products(rows: np.ndarray, goal: np.ndarray) -> np.ndarray:
    """Integer inner products: doubles where every partial sum is below 2**53, else Python integers held to 64 bits."""
    if not len(rows) or np.abs(rows).max(initial=0.0) * np.abs(goal).max(initial=0.0) * max(1, rows.shape[1]) < 2.0**53:
        return (rows @ goal).astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(row, goal)) for row in rows]
    return np.array([max(-(2**63), min(2**63 - 1, v)) for v in exact], np.int64)


def prune_and_verify(k: int, scale: int):
    """Scores a block of candidates for a block of queries.

    Candidates go by falling length in strips. A query's threshold over its length and the strip's greatest length is the
    least cosine that can still help. Above 1 all later strips are done with; where it is high, the query's largest
    coordinates bound each cosine from above; else the candidate's own length does. What is left is multiplied out.
    """

    def run(ids, rows, query_ids, goals, bounds):
        rows, goals = quantise(rows, scale), quantise(goals, scale)
        length = np.linalg.norm(rows, axis=1)
        order = np.argsort(-length, kind="stable")
        ids, rows, length = ids[order], rows[order], length[order]
        with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
            unit = np.nan_to_num(rows / length[:, None])
        found: tuple[list, list, list] = ([], [], [])
        slack = 1e-9
        for query, goal, bound in zip(query_ids, goals, bounds):
            best, size = Best(k), float(np.linalg.norm(goal))
            with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
                direction = np.nan_to_num(goal / size)
            focus = np.argsort(-np.abs(direction), kind="stable")[:FOCUS]
            rest = np.sqrt(max(0.0, 1 - float((direction[focus] ** 2).sum())))
            for at in range(0, len(ids), STRIP):
                least = max(best.least(), bound)
                reach = size * length[at]
                if least > reach * (1 + slack) + slack:
                    break  # shorter ones cannot reach it either
                here = slice(at, at + STRIP)
                cosine = least / reach if reach > 0 else -np.inf
                if cosine >= COORDINATE_FROM:
                    part = unit[here][:, focus]
                    top = part @ direction[focus] + rest * np.sqrt(np.maximum(0.0, 1 - (part * part).sum(axis=1)))
                    alive = at + np.flatnonzero(top * size * length[here] >= least - slack * (1 + abs(least)))
                else:
                    alive = at + np.flatnonzero(length[here] * size >= least - slack * (1 + abs(least)))
                alive = alive[ids[alive] != query]
                scores = products(rows[alive], goal)
                enough = scores >= least
                if enough.any():
                    best.add(ids[alive[enough]], scores[enough])
            if len(best.ids):
                found[0].append(np.full(len(best.ids), query, np.int64))
                found[1].append(best.ids)
                found[2].append(best.scores)
        return found

    return run


def top_products(
    vectors: DataFrame, k: int = 10, scale: int = 1024, query_every: int = 100, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """The ``k`` candidates with the greatest integer inner product for every row whose id ``query_every`` divides.

    Components become ``floor(scale * x)``. All other rows are candidates; vectors that are null or hold null or
    non-finite components, and rows without id, take no part. Shorter vectors count as filled with zeros. A repeated id
    counts once, with its best vector, and never meets itself. Products beyond 64 bits are held to the nearest 64-bit value.
    Stores the usable vectors with their bucket; brings the bucket limits, 1024 long candidates (first
    thresholds only) and one row per bucket to the driver. Columns: ``query_id``, ``rank``, ``vec_id``, ``score``.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector"), nonzero=False))

    @arrow_udf("double")
    def length(column: pa.Array) -> pa.Array:
        width = int(np.max(column.value_lengths().to_numpy(zero_copy_only=False), initial=0))
        return pa.array(np.linalg.norm(quantise(matrix(column, width), scale), axis=1), pa.float64())

    rows = stored(rows.select("vec_id", "vector", length("vector").alias("norm")))
    shares = [n / BUCKETS for n in range(1, BUCKETS)]
    limits, width = rows.agg(F.percentile_approx("norm", shares, 1000), F.max(F.size("vector"))).collect()[0]
    limits = sorted(set(limits or []))
    bucket = F.lit(0)
    for limit in limits:
        bucket = bucket + (F.col("norm") > limit).cast("int")
    held = rows.withColumn("list", bucket)
    longest = {r[0]: r[1] for r in held.groupBy("list").agg(F.max("norm")).collect()}
    seeds = rows.orderBy(F.col("norm").desc(), "vec_id").limit(SEEDS).select("vec_id", "vector").toArrow()
    seed_ids, width = seeds.column("vec_id").to_numpy(), width or 0
    seed_rows = quantise(matrix(seeds.column("vector"), width), scale) if len(seed_ids) else np.zeros((0, width))

    @arrow_udf("double")
    def first_bound(query_ids: pa.Array, column: pa.Array) -> pa.Array:
        bounds = []
        for query, goal in zip(query_ids.to_numpy(zero_copy_only=False), quantise(matrix(column, width), scale)):
            best, other = Best(k), seed_ids != query
            best.add(seed_ids[other], products(seed_rows[other], goal))
            bounds.append(best.least())
        return pa.array(bounds, pa.float64())

    queries = rows.where(F.col("vec_id") % query_every == 0).select(
        F.col("vec_id").alias("query_id"), "vector", "norm", first_bound("vec_id", "vector").alias("bound")
    )
    # A query visits the buckets whose longest vector can reach its threshold.
    visits = [F.struct(F.lit(n).alias("list"), F.lit(float(longest[n])).alias("longest")) for n in sorted(longest)]
    visits = F.array(*visits) if visits else F.from_json(F.lit("[]"), "array<struct<list:int,longest:double>>")
    reachable = F.filter(visits, lambda v: v["longest"] * F.col("norm") * (1 + 1e-9) + 1e-9 >= F.col("bound"))
    queries = queries.select(F.explode(F.transform(reachable, lambda v: v["list"])).alias("list"), "query_id", "vector", "bound")
    return meet(held, stored(queries), width, k, "long", True, prune_and_verify(k, scale))
