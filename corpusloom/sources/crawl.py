"""JSON and JSON-lines files between the stages, always read with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from corpusloom.schemas import RAW_CRAWL


def read_json(
    spark: SparkSession, path: str | list[str], schema: T.StructType = RAW_CRAWL, multiline: bool = False
) -> DataFrame:
    """JSON files by path or glob. JSON lines split across tasks; ``multiline`` files (one document or one array
    each) are read whole, one task per file."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def write_jsonl(df: DataFrame, path: str, compression: str = "none") -> None:
    df.write.mode("errorifexists").option("compression", compression).json(path)
