"""The corpus pipeline: language, boilerplate lines, near-duplicates, source mixture, sequences.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before has kept, read back from Parquet. All but the last
return the columns of ``docs``; the last returns the pieces with their sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.llm.common import fresh, row_parts, stored, table
from corpusloom.llm.language_id import UNKNOWN, predict, train
from corpusloom.llm.line_dedup import drop_recurring
from corpusloom.llm.mixing import mix
from corpusloom.llm.near_dedup import near_duplicates
from corpusloom.llm.packing import pack_documents
from corpusloom.llm.queries import CAPACITY, tokenizer_path

# A document goes if no language is found, or the best one is less likely than this.
LEAST_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told, learnt from the labels of the documents themselves."""
    judged = fresh(docs, "_judged")
    model = train(docs)
    marked = docs.withColumn(judged, predict(docs, model))
    sure = (F.col(judged)["lang_pred"] != UNKNOWN) & (F.col(judged)["score"] >= LEAST_SCORE)
    return marked.where(sure).drop(judged)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without boilerplate lines."""
    return drop_recurring(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8); rows without id stay."""
    found = near_duplicates(docs)
    lost = fresh(docs, "_lost")
    lost_ids = found.where(~F.col("kept")).select(F.col("doc_id").alias(lost)).distinct()
    return docs.join(lost_ids, F.col("doc_id") == F.col(lost), "left_anti")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them.

    Rows are numbered and stored. Only their numbers, ids and sizes go through the mixture; the whole rows then meet their number of
    copies in one shuffle, in parts that grow in number with the table, and are neither sorted nor gathered by source.
    """
    row, of = fresh(docs, "_number"), fresh(docs, "_of")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()))
    taken = mix(numbered.select("doc_id", "text", "source", row), table(spark, sf_dir, "labels"), extra=(row,))
    wanted = taken.where("copies > 0").select(F.col(row).alias(of), F.sequence(F.lit(1), F.col("copies")).alias(f"{of}_copies"))
    met = numbered.repartition(row_parts(numbered), row).join(wanted.hint("shuffle_hash"), F.col(row) == F.col(of))
    return met.select(*docs.columns, F.explode(f"{of}_copies").alias(of)).select(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed into sequences."""
    return pack_documents(docs, tokenizer_path(), CAPACITY)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("line_dedup", lines),
    ("minhash_near_dedup", near),
    ("source_mixing", mixture),
    ("best_fit_packing", sequences),
]

# Trained models, MinHash and tokenizers are beyond SQL; the tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is stored and read back for the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
