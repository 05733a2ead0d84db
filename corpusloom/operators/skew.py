"""Joins and groupings that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.session import cut_lineage

# Rows a side may have, and bytes of its files, before it is no longer broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcasting when it has at most ``max_rows`` rows and BROADCAST_BYTES bytes (an action).

    It is stored first, so it is computed once; counting it then reads file footers. A larger side is returned
    unmarked, so the join is a shuffle join with the same rows. ``df`` should be narrow.
    """
    stored = cut_lineage(df)
    size = int(str(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(stored) if size <= BROADCAST_BYTES and stored.count() <= max_rows else stored


def latest_per_key(
    df: DataFrame,
    keys: list[str],
    order: list[str | Column],
    keep_first: tuple[str, ...] = (),
    columns: list[str] | None = None,
) -> DataFrame:
    """One row per key: the row with the greatest ``order`` values (nulls lowest).

    ``max_by`` combines on the map side, so every task sends at most one row per key through the shuffle and a key
    that holds a third of the table costs no more than any other. Columns in ``keep_first`` take the value of the
    earliest row instead of the latest. ``columns`` limits what is carried along (default: everything).
    """
    wanted = df.columns if columns is None else [*keys, *columns]
    rank = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    newest = [c for c in wanted if c not in keys and c not in keep_first]
    aggregates = [F.max_by(F.struct(*newest), rank).alias("_newest")]
    if keep_first:
        aggregates.append(F.min_by(F.struct(*keep_first), rank).alias("_oldest"))
    merged = df.groupBy(*keys).agg(*aggregates)
    sources = {c: f"_newest.{c}" for c in newest} | {c: f"_oldest.{c}" for c in keep_first}
    return merged.select(*[F.col(sources.get(c, c)).alias(c) for c in wanted])


def hot_keys(df: DataFrame, key: str, max_hot_keys: int = 1000) -> DataFrame:
    """Keys that hold more than ``1 / max_hot_keys`` of the rows of ``df``, hence fewer than ``max_hot_keys`` of them.

    Runs one narrow aggregation and stores its small result.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return cut_lineage(counts.where(F.col("_n") * max_hot_keys > total).select(F.col(key).alias("_hot")))


def join_on_hot_key(
    left: DataFrame, right: DataFrame, key: str, how: str = "inner", max_hot_keys: int = 1000
) -> DataFrame:
    """Equi-join where ``right`` is unique on ``key`` and ``left`` may hold very many rows of one key.

    There are fewer than ``max_hot_keys`` hot keys (see :func:`hot_keys`) and ``right`` has one row for each at most, so
    those rows are safe to broadcast: hot rows of ``left`` join in place and are never shuffled. The rest joins
    through an ordinary shuffle, now without any dominant key.
    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``.
    """
    hot = hot_keys(left, key, max_hot_keys)
    if hot.isEmpty():
        return left.join(right, key, how)
    is_hot = F.col(key) == F.col("_hot")
    hot = F.broadcast(hot)
    hot_left = left.join(hot, is_hot, "left_semi")
    cold_left = left.join(hot, is_hot, "left_anti")
    hot_right = F.broadcast(right.join(hot, is_hot, "left_semi"))
    return hot_left.join(hot_right, key, how).unionByName(cold_left.join(right, key, how))


def join_unique(left: DataFrame, right: DataFrame, key: str, how: str = "inner", max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Equi-join with a ``right`` that is unique on ``key``: broadcast while it is small, else split by hot keys.

    Stores and counts ``right`` (an action).
    """
    right = cut_lineage(right)
    if right.count() <= max_rows:
        return left.join(F.broadcast(right), key, how)
    return join_on_hot_key(left, right, key, how)


def without_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of an aggregated ``df`` whose ``key`` is not among ``keys`` (unique).

    Catalyst moves an anti-join below the aggregation, back to where a popular key still has all its rows. An outer
    join stays where it is written.
    """
    marked = keys.select(key, F.lit(True).alias("_found"))
    return df.join(marked, key, "left").where(F.col("_found").isNull()).drop("_found")
