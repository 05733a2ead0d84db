"""Small helpers that the operators share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from corpusloom.plans.catalog import table
from corpusloom.session import cut_lineage

__all__ = ["documents", "fresh", "positions", "row_parts", "share_below", "share_of", "stored", "table"]


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The wanted columns of the ``documents`` table."""
    return table(spark, folder, "documents").select(*columns)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: computed once, and safe from lost executors."""
    return cut_lineage(df)


def fresh(df: DataFrame, name: str) -> str:
    """A column name made from ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


# Bytes of compressed files whose rows go to one task together, about.
PART_BYTES = 16 << 20


def row_parts(table: DataFrame) -> int:
    """Parts to deal the whole rows of a stored table into: the shuffle partitions, more where these would grow too large."""
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))


def share_below(share: Column, seed: int, *keys: str) -> Column:
    """True for about that share of all keys; the same keys on every run."""
    return share_of(F.xxhash64(*keys, F.lit(seed))) < share


def share_of(draw: Column | str) -> Column:
    """A 64-bit hash as a number from 0 up to 1."""
    return F.shiftrightunsigned(draw, 11) / F.lit(float(1 << 53))


# Rows of one sorted block, about, while the blocks are no more than the shuffle partitions; at most beyond.
BLOCK_ROWS, MOST_BLOCK_ROWS = 1 << 14, 1 << 20


def positions(
    df: DataFrame, order: list[Column], group: list[str] | None = None, at: str = "_at", size: str = "_size", number: str | None = None
) -> DataFrame:
    """Add the place of every row in its group, counted from 0 in ``order``, and the number of rows of the group; with ``number``
    also the place of the group among all groups, ascending, nulls first.

    No group is gathered anywhere: rows are dealt by ranges of group and order, so a group with a third of all rows spans many
    tasks, and are counted where they lie; a window over these counts, one row per block and group, gives every block its
    first place. ``df`` is stored, sorted and stored again (two actions); give it the columns that are needed only. ``order`` should
    tell all rows apart that differ. Null groups are groups.
    """
    group = list(group or [])
    rows = cut_lineage(df)
    total = rows.count()
    blocks = max(min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BLOCK_ROWS)), -(-total // MOST_BLOCK_ROWS), 1)
    row, block = fresh(df, "_row"), fresh(df, "_block")
    keys = [F.col(c) for c in group] + order
    dealt = rows.repartitionByRange(blocks, *keys).sortWithinPartitions(*keys)
    dealt = cut_lineage(dealt.withColumn(row, F.monotonically_increasing_id())).withColumn(block, F.shiftright(row, 33))
    here = dealt.groupBy(*group, block).agg(F.count(F.lit(1)).alias("_here"), F.min(row).alias("_first"))
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    before = F.sum("_here").over(whole.orderBy(block).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_here")
    starts = here.select(*[F.col(c).alias(f"_of_{n}") for n, c in enumerate(group)], F.col(block).alias("_of"),
                         (before - F.col("_first")).alias("_shift"), F.sum("_here").over(whole).alias(size))
    if number:
        names = [F.col(f"_of_{n}").alias(f"_is_{n}") for n in range(len(group))]
        numbered = positions(starts.select(*names).distinct(), [F.col(f"_is_{n}") for n in range(len(group))], None, number, "_groups")
        starts = starts.join(numbered, _same([(f"_of_{n}", f"_is_{n}") for n in range(len(group))]))
    placed = dealt.join(starts, _same([(c, f"_of_{n}") for n, c in enumerate(group)]) & (F.col(block) == F.col("_of")))
    placed = placed.withColumn(at, F.col(row) + F.col("_shift"))
    return placed.select(*df.columns, at, size, *([number] if number else []))


def _same(pairs: list[tuple[str, str]]) -> Column:
    """Whether all pairs of columns are equal, null to null."""
    return reduce(lambda all_of, pair: all_of & F.col(pair[0]).eqNullSafe(F.col(pair[1])), pairs, F.lit(True))
