"""Approximate nearest neighbours: inverted lists scanned with adaptive dimensions.

Vectors are rotated at random, so that the first columns of a difference foretell its length. Within every probed list
distances grow by blocks of columns, and a candidate is given up as soon as a test says that it will not come near enough.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from corpusloom.llm.common import share_of, stored
from corpusloom.llm.vector_blocks import Best, matrix, meet, usable

# Lists are trained on about SAMPLE vectors; ROWS_PER_LIST vectors to a list on average, MAX_LISTS lists at most.
SAMPLE, ROWS_PER_LIST, MAX_LISTS = 16_384, 512, 1024
# Columns in a block, the test's width in standard errors, candidates scanned together.
COLUMNS, ERRORS, STRIP = 16, 2.1, 1024


def rotation(width: int, seed: int = 5) -> np.ndarray:
    """A random orthogonal matrix, the same on every run."""
    if not width:
        return np.zeros((0, 0))
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def train_lists(sample: np.ndarray, lists: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Centres of ``lists`` cells by Lloyd's algorithm; an empty cell takes the point farthest from its centre."""
    distinct = np.unique(sample, axis=0)
    lists = min(lists, len(distinct))
    centres = distinct[np.random.default_rng(seed).choice(len(distinct), lists, replace=False)]
    for _ in range(rounds):
        gaps = (centres**2).sum(1) - 2 * sample @ centres.T
        cell = gaps.argmin(1)
        counts = np.bincount(cell, minlength=lists)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, sample)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
        far = (gaps.min(1) + (sample**2).sum(1)).argsort()[::-1]
        for n, empty in enumerate(np.flatnonzero(counts == 0)[: len(far)]):
            centres[empty] = sample[far[n]]
    return centres


def probes_needed(sample: np.ndarray, centres: np.ndarray, k: int, recall: float, trials: int = 256) -> int:
    """The fewest lists to probe for that share of the ``k`` nearest sample vectors of up to ``trials`` sample vectors.

    Neighbours are found by brute force within the sample. In a larger table they are nearer, so fewer lists would do.
    """
    if len(sample) < 2:
        return len(centres)
    ranks = []
    squares, middle = (sample**2).sum(1), (centres**2).sum(1)
    cell = np.concatenate([(middle - 2 * part @ centres.T).argmin(1) for part in np.array_split(sample, -(-len(sample) // 4096))])
    for n in range(0, len(sample), -(-len(sample) // trials)):
        gaps = squares - 2 * sample @ sample[n]
        gaps[n] = np.inf
        near = np.argsort(gaps)[: min(k, len(sample) - 1)]
        place = np.empty(len(centres), np.int64)
        place[np.argsort(middle - 2 * centres @ sample[n], kind="stable")] = np.arange(len(centres))
        ranks.append(place[cell[near]])
    ranks = np.sort(np.concatenate(ranks))
    return int(ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))) - 1)]) + 1


def scan(k: int, turn: np.ndarray):
    """Scores a block of one list for a block of queries; greater is nearer inside, distances come out."""
    width = len(turn)
    steps = list(range(0, width, COLUMNS))

    def run(ids, rows, query_ids, goals, bounds):
        turned, wanted = rows @ turn, goals @ turn
        order = np.argsort(ids, kind="stable")
        ids, rows, turned = ids[order], rows[order], turned[order]
        found: tuple[list, list, list] = ([], [], [])
        for query, goal, near in zip(query_ids, goals, wanted):
            best = Best(k)
            for at in range(0, len(ids), STRIP):
                alive = at + np.flatnonzero(ids[at : at + STRIP] != query)
                partial = np.zeros(len(alive))
                for begin in steps:
                    end = min(begin + COLUMNS, width)
                    partial += ((turned[alive, begin:end] - near[begin:end]) ** 2).sum(axis=1)
                    least = -best.least()  # infinite until k are known
                    if np.isfinite(least) and end < width:
                        # From end columns the whole is put at width / end times as much, give or take the error.
                        keep = partial * (width / end) <= (least * (1 + ERRORS / np.sqrt(end))) ** 2
                        alive, partial = alive[keep], partial[keep]
                    if not len(alive):
                        break
                if len(alive):
                    exact = np.sqrt(((rows[alive] - goal) ** 2).sum(axis=1))
                    enough = exact <= -best.least()
                    if enough.any():
                        best.add(ids[alive[enough]], -exact[enough])
            if len(best.ids):
                found[0].append(np.full(len(best.ids), query, np.int64))
                found[1].append(best.ids)
                found[2].append(-best.scores)
        return found

    return run


def nearest(
    vectors: DataFrame, k: int = 10, query_every: int = 100, recall: float = 0.95,
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest candidates found, by Euclidean distance, for every row whose id ``query_every`` divides.

    Every usable row is in one inverted list; a query probes as many lists, nearest centres first, as it takes to find the
    share ``recall`` of the neighbours within the sample (see :func:`probes_needed`), and further ones until they hold ``k`` ids
    besides its own: only where there are fewer candidates are there fewer rows. Vectors that are null, zero or hold null or non-finite components, and rows without id, take no part.
    Shorter vectors count as filled with zeros; a repeated id counts once, with its nearest vector. Centres are fitted on about
    SAMPLE vectors (twice as many at most) chosen by a hash of id and vector, which come to the driver with the centres (at most MAX_LISTS); every row is
    indexed. Stores the usable vectors, the assigned vectors and the queries. Columns: ``query_id``, ``rank``, ``vec_id``, ``score``.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("vector"))
    rows = stored(rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector"), nonzero=True)))
    draw = F.xxhash64("vec_id", "vector", F.lit(11))
    total, different, width = rows.agg(F.count(F.lit(1)), F.approx_count_distinct(draw), F.max(F.size("vector"))).collect()[0]
    width = width or 0
    # Rows that repeat id and vector are drawn together and count once; the limit is there for a count that is far off.
    chosen = rows.where(share_of(draw) < min(1.0, SAMPLE / max(different, 1))).dropDuplicates(["vec_id", "vector"]).limit(2 * SAMPLE)
    sample = matrix(chosen.select("vector").toArrow().column("vector"), width) if total else np.zeros((0, width))
    if total and not len(sample):
        sample = matrix(rows.limit(1).select("vector").toArrow().column("vector"), width)
    centres = train_lists(sample, min(MAX_LISTS, -(-total // ROWS_PER_LIST))) if total else np.zeros((1, width))
    probes = probes_needed(sample, centres, k, recall)

    def closest(column: pa.Array) -> np.ndarray:
        gaps = (centres**2).sum(1) - 2 * matrix(column, width) @ centres.T
        return np.argsort(gaps, axis=1, kind="stable").astype(np.int32)

    @arrow_udf("int")
    def own_list(column: pa.Array) -> pa.Array:
        return pa.array(closest(column)[:, 0])

    held = stored(rows.select(own_list("vector").alias("list"), "vec_id", "vector"))
    # A repeated id counts in one of its lists.
    sizes = np.zeros(len(centres), np.int64)
    for r in held.groupBy("vec_id").agg(F.min("list").alias("list")).groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]

    @arrow_udf("array<int>")
    def probed(column: pa.Array) -> pa.Array:
        order = closest(column)
        enough = (np.cumsum(sizes[order], axis=1) < k + 1).sum(axis=1) + 1
        return pa.array([row[: max(probes, n)] for row, n in zip(order, enough)], pa.list_(pa.int32()))

    queries = rows.where(F.col("vec_id") % query_every == 0).select(F.col("vec_id").alias("query_id"), "vector", probed("vector").alias("lists"))
    queries = stored(queries.select(F.explode("lists").alias("list"), "query_id", "vector", F.lit(0.0).alias("bound")))
    return meet(held, queries, width, k, "double", False, scan(k, rotation(width)))
