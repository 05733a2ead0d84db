"""Corpus statistics, manifests and cost estimates. Each is one scan with partial aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.digest import fold, row_hash, word_sums
from corpusloom.functions.text import rounded_int
from corpusloom.operators.chunk import grid_spans


def corpus_stats(rows: DataFrame, thread: str, author: str, text: str, date: str) -> DataFrame:
    """Messages, distinct threads and authors, mean length (rounded half to even), first and last date."""
    narrow = rows.select(
        F.col(thread).alias("t"), F.col(author).alias("a"), F.length(text).alias("n"), F.col(date).alias("d")
    )
    return narrow.agg(
        F.count(F.lit(1)).alias("total"),
        F.countDistinct("t").alias("threads"),
        F.countDistinct("a").alias("unique_authors"),
        rounded_int(F.avg("n")).alias("avg_content_length"),
        F.min("d").alias("earliest"),
        F.max("d").alias("latest"),
    )


def metadata_sidecar(docs: DataFrame, dataset: str, version: str, source: str, license_label: str) -> DataFrame:
    return docs.agg(F.count(F.lit(1)).alias("record_count")).select(
        F.lit(dataset).alias("dataset_name"), F.lit(version).alias("version"), "record_count",
        F.current_timestamp().alias("created_at"), F.lit(source).alias("source"), F.lit(license_label).alias("license"),
    )


def content_checksum(df: DataFrame, text: str, algorithm: str = "md5") -> DataFrame:
    """One row ``(row_count, content_checksum)``, independent of row order and partitioning."""
    digests = df.select(row_hash(text, algorithm).alias("_h"))
    sums = digests.agg(F.count("_h").alias("row_count"), *word_sums("_h", algorithm))
    return sums.select("row_count", fold("row_count", algorithm).alias("content_checksum"))


def grid_manifest(
    docs: DataFrame, dataset: str, version: str, size: int = 1000, overlap: int = 200, min_chars: int = 50,
    text: str = "content",
) -> DataFrame:
    """Manifest of grid-chunking ``docs``: document count, chunk count, parameters and content checksum.

    Documents are counted by their first window, so both counts and the checksum come from one pass.
    """
    spans = grid_spans(docs.select(text), text, size, overlap, outer=True)
    piece = F.col("_chunk.chunk_content")
    rows = spans.select(
        (F.coalesce(F.col("_chunk.chunk_index"), F.lit(0)) == 0).alias("_first"),
        F.when(F.length(piece) > min_chars, row_hash(piece)).alias("_h"),
    )
    sums = rows.agg(
        F.count_if("_first").alias("document_count"), F.count("_h").alias("chunk_count"), *word_sums("_h")
    )
    return sums.select(
        F.lit(dataset).alias("dataset"), F.lit(version).alias("version"), "document_count", "chunk_count",
        F.lit(size).alias("chunk_size"), F.lit(overlap).alias("chunk_overlap"),
        F.current_timestamp().alias("created_at"), fold("chunk_count").alias("content_checksum"),
    )


def build_summary(manifest: DataFrame) -> DataFrame:
    """Closing report of a dataset build."""
    return manifest.select(
        F.lit("complete").alias("status"), F.col("document_count").alias("documents"),
        F.col("chunk_count").alias("chunks"), "dataset", "version",
    )


def storage_estimate(embeddings: DataFrame, dataset: str = "dataset", doc_id: str = "doc_id") -> DataFrame:
    """Documents, chunks and embedding bytes (four per dimension) per dataset, of rows that carry their dataset."""
    sized = embeddings.select(dataset, doc_id, vector_bytes("embedding").alias("bytes"))
    # Per document first: a dataset with a third of all rows is spread over its documents.
    per_doc = sized.groupBy(dataset, doc_id).agg(F.count(F.lit(1)).alias("chunks"), F.sum("bytes").alias("bytes"))
    return _storage_totals(per_doc, dataset)


def vector_bytes(vector: str) -> Column:
    """Bytes of a vector at four per component; 0 for null."""
    return F.coalesce(F.size(vector).cast("long") * 4, F.lit(0))


def storage_of_documents(docs: DataFrame, embeddings: DataFrame, dataset: str = "dataset", doc_id: str = "doc_id") -> DataFrame:
    """The same for embeddings that only know their document. Documents without vectors count, with no chunks.

    Vectors are measured before the join and added up per document, so none is shuffled.
    """
    sized = embeddings.select(doc_id, vector_bytes("embedding").alias("bytes"))
    per_doc = sized.groupBy(doc_id).agg(F.count(F.lit(1)).alias("chunks"), F.sum("bytes").alias("bytes"))
    return _storage_totals(docs.select(dataset, doc_id).join(per_doc, doc_id, "left"), dataset)


def _storage_totals(per_doc: DataFrame, dataset: str) -> DataFrame:
    return per_doc.groupBy(dataset).agg(
        F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("chunks"), F.lit(0)).alias("chunks"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("embedding_bytes"),
    )


# US dollars per stored GB, egress GB, 1000 embedded tokens and search call.
PRICES = {
    "storage_gb": 0.023,
    "egress_gb": 0.09,
    "embedding_ktokens": 0.0001,
    "search_calls": 0.000002,
}


def monthly_cost(usage: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Monthly cost per group from usage rows with the columns of ``PRICES``."""
    cost: Column = sum((F.col(name) * price for name, price in PRICES.items()), F.lit(0.0))
    by = by or []
    return usage.groupBy(*by).agg(F.sum(cost).alias("monthly_cost"))


def license_mix(docs: DataFrame, by: list[str] | None = None) -> DataFrame:
    return docs.groupBy(*(by or []), "license").agg(F.count(F.lit(1)).alias("documents"))


def chunks_by_version(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("version").agg(
        F.count(F.lit(1)).alias("chunk_count"), F.avg("chunk_length").alias("avg_chunk_size")
    )


def stories_by_domain(items: DataFrame, domain: Column, limit: int = 10) -> DataFrame:
    named = items.where(F.col("url").isNotNull()).groupBy(domain.alias("domain")).agg(F.count(F.lit(1)).alias("count"))
    return named.orderBy(F.col("count").desc(), "domain").limit(limit)
