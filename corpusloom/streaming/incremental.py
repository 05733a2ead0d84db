"""Incremental ingestion with Structured Streaming: each run reads only files it has not seen."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from corpusloom.operators.skew import latest_per_key


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, source: str = "parquet", glob: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """New files below ``path`` as a stream; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(schema).format(source)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def ingest_new(stream: DataFrame, target: str, checkpoint: str, partition_by: tuple[str, ...] = ()) -> None:
    """Append everything not yet ingested to ``target`` and stop. Exactly once: progress lives in ``checkpoint``."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.start(target).awaitTermination()


def upsert_new(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    key: str,
    order: list[str],
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Add everything not yet ingested to an upsert log and stop.

    Each micro-batch is reduced to its newest row per key and stored under its batch number. A replayed batch
    replaces itself, and the table is never rewritten; :func:`current_rows` resolves keys when reading and
    :func:`compact` folds the log when it has grown.
    """

    def store(batch: DataFrame, number: int) -> None:
        rows = prepare(batch) if prepare else batch
        latest_per_key(rows, [key], order).write.mode("overwrite").parquet(f"{target}/batch={number}")

    query = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()


def current_rows(
    spark: SparkSession, target: str, key: str, order: list[str], keep_first: tuple[str, ...] = ()
) -> DataFrame:
    """The upsert log as a table: one row per key, the later batch winning equal ``order``.

    ``keep_first`` names columns that an update does not replace, such as the time of the first crawl.
    """
    log = spark.read.parquet(target)
    return latest_per_key(log, [key], [*order, F.col("batch")], keep_first).drop("batch")


def compact(
    spark: SparkSession, target: str, compacted: str, key: str, order: list[str], keep_first: tuple[str, ...] = ()
) -> None:
    """Write the current rows as batch -1 of a new log at ``compacted``; later batches can be added to it."""
    current_rows(spark, target, key, order, keep_first).write.mode("errorifexists").parquet(f"{compacted}/batch=-1")
