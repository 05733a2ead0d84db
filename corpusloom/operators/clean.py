"""Raw crawl rows to clean, deduplicated documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.text import json_text, strip_tags
from corpusloom.operators.skew import latest_per_key


def clean_documents(
    raw: DataFrame,
    min_len: int = 50,
    default_license: str = "MIT",
    default_author: str = "Unknown",
    processed_at: Column | None = None,
) -> DataFrame:
    """Documents from crawl rows ``(url, title, content, metadata, crawled_at)``.

    Rows without content, or with at most ``min_len`` characters before tags are stripped, are left out.
    The id is the MD5 of the URL, hence the same in every run. ``crawled_at`` is kept for deduplication.
    """
    kept = raw.where(F.col("content").isNotNull() & (F.length("content") > min_len))
    return kept.select(
        F.md5("url").alias("id"),
        F.col("url").alias("source_url"),
        "title",
        strip_tags("content").alias("content"),
        "metadata",
        F.coalesce(json_text("metadata", "license"), F.lit(default_license)).alias("license"),
        F.coalesce(json_text("metadata", "author"), F.lit(default_author)).alias("author"),
        "crawled_at",
        (F.current_timestamp() if processed_at is None else processed_at).alias("processed_at"),
    )


def dedup_latest(df: DataFrame, key: str = "url", order: str = "crawled_at", tie: str | None = None) -> DataFrame:
    """Keep the most recent row per key (null times lose; equal times are decided by ``tie``)."""
    ties = [tie] if tie else sorted(c for c in df.columns if c not in (key, order))
    return latest_per_key(df, [key], [order, *ties])


def dedup_exact(df: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """Keep the row with the lowest id of every group of rows with identical text, with the number of copies.

    Ids are unique. Grouping sees ids and 16-byte digests only and combines in the map tasks, so a text copied into a third
    of the table leaves each task as one row. The rows to keep are then picked by id: the narrow side is hashed, so text
    is shuffled once and never sorted.
    """
    groups = df.groupBy(F.unhex(F.md5(text)).alias("_h")).agg(F.min(row_id).alias("_first"), F.count(F.lit(1)).alias("copies"))
    firsts = groups.select("_first", "copies").hint("shuffle_hash")
    return df.join(firsts, F.col(row_id) == F.col("_first")).drop("_first")


def crawl_rows_from_pages(pages: DataFrame, crawled_at: Column, metadata: Column) -> DataFrame:
    """Shape stored pages ``(url, html)`` like crawl output; the title comes from the title tag."""
    return pages.select(
        "url",
        page_title("html").alias("title"),
        F.col("html").alias("content"),
        metadata.alias("metadata"),
        crawled_at.alias("crawled_at"),
    )


def page_title(html: str) -> Column:
    """Text of the title tag, empty when there is none. Stays in the JVM; entities are left as they are."""
    return F.regexp_extract(html, "(?is)<title>(.*?)</title>", 1)
