"""Mixing sources to target weights with Efraimidis-Spirakis sampling, in DataFrame functions only.

Every document draws an exponential key that its quality weight scales; a source takes whole epochs first and then its
documents in key order up to the rest of its budget. Order and running sums are found in two steps (blocks of the key,
then rows within a block), so that no source has to fit one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
# Documents in a block of keys, about.
BLOCK_ROWS = 4096
# Weight of a document by its quality label.
WEIGHTS = {"_good": 2.0, "_bad": 0.5, "_other": 1.0}


def word_count(text: Column) -> Column:
    """Words of a text: runs of anything but ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, source: str, size: str, most: int = 3, cycle: int = 3) -> DataFrame:
    """Total, rows, weight and target of each source.

    Sources by code point, null last, weigh 1 to ``cycle``, repeating. They share the sum of all sizes by weight; no target
    exceeds ``most`` times its source's size, and the excess goes to the others by weight. With the sources by rising
    limit per weight the capped ones are a prefix, so the end of the resharing is found without iterating. One row per
    source meets in one task: as many rows as there are sources.
    """
    totals = sized.groupBy(F.col(source).alias("_source")).agg(F.sum(size).alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    everything = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())) - 1
    cap = (F.col("source_size") * most).cast("double")
    totals = totals.select("*", (place % cycle + 1).cast("double").alias("_weight"), cap.alias("_cap"))
    by_limit = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("_source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        "*",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))).alias("_left"),
        (F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))).alias("_weights"),
    )
    open_ = F.col("_left") * F.col("_weight") / F.col("_weights") <= F.col("_cap")
    share = F.struct("_left", "_weights")
    firsts = F.min(F.when(open_, F.struct((F.col("_cap") / F.col("_weight")).alias("limit"), share.alias("share")))).over(everything)
    totals = totals.select("*", firsts.alias("_first"))
    limit, rest = F.col("_first.limit"), F.col("_first.share")
    even = rest["_left"] * F.col("_weight") / rest["_weights"]
    capped = F.coalesce(F.col("_cap") / F.col("_weight") < limit, F.lit(True))
    return totals.select(
        "_source", "source_size", "_rows", F.when(capped, F.col("_cap")).otherwise(F.least(even, F.col("_cap"))).alias("target")
    )


def exponential_key(weight: Column, seed: int, *keys: Column) -> Column:
    """Exponential key of a row of that weight, from a uniform draw in (0, 1) that its keys fix."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys]))
    draw = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))
    return -F.ln(draw) / weight


def mix(
    docs: DataFrame,
    labels: DataFrame | None,
    seed: int = 17,
    most: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """How often each document is taken, so that every source comes near its target.

    Quality weights come from ``labels`` (``doc_id``, ``quality``): 2 for good, 0.5 for bad, 1 without label; the lowest
    label counts where there are several. Stores the sized rows once. Null text has size 0 and null is a source like any
    other; repeated rows each take part; rows of one source that share key, id and size are alike in the result. No
    document is taken more than ``most`` times. A document at the edge of a budget is taken if that brings its source nearer.
    Columns: the id, ``size``, ``source_size``, ``target``, ``copies``, ``taken`` and ``extra``.
    """
    sized = docs.select(F.col(id_column).alias("_id"), F.col(source_column).alias("_from"), word_count(F.col(text_column)).alias("size"), *extra)
    if labels is not None:
        marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_labelled")).agg(F.min("quality").alias("_quality"))
        sized = sized.join(marks, F.col("_id") == F.col("_labelled"), "left").drop("_labelled")
    else:
        sized = sized.withColumn("_quality", F.lit(None).cast("int"))
    good, bad, other = (F.lit(w) for w in WEIGHTS.values())
    weight = F.when(F.col("_quality") > 0, good).when(F.col("_quality") <= 0, bad).otherwise(other)
    key = exponential_key(weight, seed, F.col("_id"))
    sized = stored(sized.select("_id", "_from", "size", *extra, weight.alias("_weight"), key.alias("_key")))
    targets = source_targets(sized, "_from", "size", most)
    # Keys of a source are a mixture of exponentials, one for each weight, by the weights' shares of its rows.
    shares = sized.groupBy(F.col("_from").alias("_whose")).agg(*[F.avg((F.col("_weight") == w).cast("double")).alias(n) for n, w in WEIGHTS.items()])
    targets = stored(targets.join(shares, F.col("_source").eqNullSafe(F.col("_whose"))).drop("_whose"))
    # Blocks are even in that distribution, about BLOCK_ROWS rows each, whatever the weights.
    blocks = F.ceil(F.col("_rows") / BLOCK_ROWS)
    below = 1 - sum(F.col(n) * F.exp(-w * F.col("_key")) for n, w in WEIGHTS.items())
    block = F.greatest(F.least(F.floor(below * blocks), blocks - 1), F.lit(0)).cast("long")
    # A source's limits are found by the join, so that a hot source is split and not sorted as one.
    joined = sized.join(targets, F.col("_from").eqNullSafe(F.col("_source"))).select(
        *sized.columns, "source_size", "target", "_rows", block.alias("_block")
    )
    sums = joined.groupBy("_from", "_block").agg(F.sum("size").alias("_sum"))
    until = Window.partitionBy("_from").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("_from").alias("_source"), F.col("_block").alias("_of"), F.coalesce(F.sum("_sum").over(until), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_from", "_block").orderBy("_key", "_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    running = joined.withColumn("_running", F.sum("size").over(within))
    same = F.col("_from").eqNullSafe(F.col("_source")) & (F.col("_block") == F.col("_of"))
    placed = running.join(sums, same).withColumn("_end", F.col("_before") + F.col("_running"))
    size, end = F.col("size"), F.col("_end")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - epochs * F.col("source_size")
    nearer = (end <= rest) | ((end - rest < rest - (end - size)) & (end - size < rest))
    copies = F.least(epochs + F.when(nearer & (rest > 0), 1).otherwise(0), F.lit(most)).cast("int")
    return placed.select(
        F.col("_id").alias(id_column), "size", F.col("source_size").cast("long"), "target", copies.alias("copies"), (copies * size).cast("long").alias("taken"), *extra
    )
