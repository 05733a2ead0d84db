"""Upserts into a table kept in hash buckets of its key: a batch rewrites the buckets it touches and no other file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from corpusloom.operators.skew import latest_per_key
from corpusloom.session import cut_lineage
from corpusloom.sources.layout import _folder


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def read_buckets(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The table, one row per key, with its ``bucket``; a filter on ``bucket`` prunes folders. Empty before the first batch."""
    whole = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    files, where = _folder(spark, target)
    return spark.read.schema(whole).parquet(target) if files.exists(where) else spark.createDataFrame([], whole)


def upsert_buckets(
    batch: DataFrame, target: str, key: str, order: list[str], buckets: int = 256, keep_first: tuple[str, ...] = ()
) -> list[int]:
    """Apply a batch: per key the row with the greatest ``order`` stays, the batch winning ties. Returns the touched buckets (actions).

    The batch is reduced to one row per key first, so a hot key is one row. Only the files of touched buckets are read, merged with
    it and replaced; the merged rows are stored before the first file goes. A batch that is applied again, after a failure half-way
    or by a replay, changes nothing more. ``buckets`` must stay what it was with the first batch; choose it so that a bucket
    holds some 100 MB. Columns in ``keep_first`` keep the value that the table holds; a new key takes that of the earliest row of
    its batch. ``order`` names columns.
    """
    spark = batch.sparkSession
    newest = cut_lineage(latest_per_key(batch, [key], list(order), keep_first).withColumn("bucket", bucket_of(key, buckets)))
    touched = sorted(r.bucket for r in newest.select("bucket").distinct().collect())
    if not touched:
        return []
    before = read_buckets(spark, target, batch.schema).where(F.col("bucket").isin(touched))
    both = before.withColumn("_late", F.lit(0)).unionByName(newest.withColumn("_late", F.lit(1)))
    # Two rows of a key at most.
    replaced = [c for c in batch.columns if c != key and c not in keep_first]
    picks = [F.max_by(F.struct(*replaced), F.struct(*order, "_late")).alias("_newest")]
    if keep_first:
        picks.append(F.min_by(F.struct(*keep_first), "_late").alias("_held"))
    merged = both.groupBy("bucket", key).agg(*picks).select("bucket", key, "_newest.*", *(["_held.*"] if keep_first else []))
    # Stored apart: a table cannot be overwritten while it is read.
    merged = cut_lineage(merged.select(*batch.columns, "bucket"))
    writer = merged.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("bucket").parquet(target)
    return touched


def upsert_stream(stream: DataFrame, target: str, checkpoint: str, key: str, order: list[str], buckets: int = 256, keep_first: tuple[str, ...] = ()) -> None:
    """Apply everything not yet ingested, batch by batch, and stop. A replayed batch changes nothing."""

    def store(batch: DataFrame, number: int) -> None:
        upsert_buckets(batch, target, key, order, buckets, keep_first)

    query = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()
