"""Which files of a table can hold a key: smallest and largest key and a Bloom filter of every file, stored beside the table.

A lookup reads the index first, one narrow row per file and a few words of its filter, and opens only the files that can hold one
of the keys. It never misses a row; a file opened for nothing costs a footer and a pruned scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Places of a key in a filter; bits of a filter per row, and at most (1 MB a file).
PLACES, BITS_PER_ROW, MOST_BITS = 4, 10, 1 << 23


def _places(key: Column, bits: Column) -> Column:
    return F.array(*[F.pmod(F.xxhash64(F.lit(n), key), bits) for n in range(PLACES)])


def build_index(spark: SparkSession, table_path: str, key: str, index_path: str, schema: T.StructType | None = None) -> None:
    """Index the files of a Parquet table by ``key`` (actions). Null keys are not indexed: a lookup never asks for them.

    Only the key column is read. A filter is made of words of 64 bits that tasks combine before they are shuffled.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    rows = reader.parquet(table_path).select(F.col(key).alias("key"), F.col("_metadata.file_path").alias("file")).where(F.col("key").isNotNull())
    files = rows.groupBy("file").agg(F.min("key").alias("least"), F.max("key").alias("most"), F.count(F.lit(1)).alias("row_count"))
    size = F.least(F.lit(MOST_BITS), F.greatest(F.lit(64), F.lit(BITS_PER_ROW) * F.col("row_count"))).cast("long")
    files.withColumn("bits", size).write.mode("overwrite").parquet(f"{index_path}/files")
    sizes = spark.read.parquet(f"{index_path}/files").select("file", "bits")
    placed = rows.join(sizes, "file").select("file", F.explode(_places(F.col("key"), F.col("bits"))).alias("place"))
    words = placed.groupBy("file", F.expr("place div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("set"))
    words.repartitionByRange("word").sortWithinPartitions("word").write.mode("overwrite").parquet(f"{index_path}/words")


def candidate_files(spark: SparkSession, index_path: str, keys: Sequence) -> list[str]:
    """The files that can hold one of ``keys`` (an action). ``keys`` come from a caller: a handful, not a column."""
    wanted = [k for k in dict.fromkeys(keys) if k is not None]
    if not wanted:
        return []
    files, words = (spark.read.parquet(f"{index_path}/{name}") for name in ("files", "words"))
    # A file is first asked for its range, in its own row; then its filter for the places that are left.
    possible = F.filter(F.lit(wanted).cast(T.ArrayType(files.schema["least"].dataType)), lambda k: (k >= F.col("least")) & (k <= F.col("most")))
    asked = files.select("file", "bits", F.explode(possible).alias("key"))
    asked = asked.select("file", "key", F.explode(_places(F.col("key"), F.col("bits"))).alias("place"))
    asked = asked.select("file", "key", "place", F.expr("place div 64").alias("word"))
    met = asked.join(words, ["file", "word"]).where("getbit(set, cast(place % 64 as int)) = 1")
    found = met.groupBy("file", "key").agg(F.count_distinct("place").alias("n"))
    all_of = asked.groupBy("file", "key").agg(F.count_distinct("place").alias("n"))
    return sorted(r.file for r in found.join(all_of, ["file", "key", "n"]).select("file").distinct().collect())


def lookup(spark: SparkSession, schema: T.StructType, index_path: str, key: str, keys: Sequence) -> DataFrame:
    """The rows of an indexed table whose ``key`` is among ``keys``; opens only files that can hold one (an action)."""
    files = candidate_files(spark, index_path, keys)
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*files).where(F.col(key).isin(list(keys)))
