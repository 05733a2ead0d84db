"""Builds from stored pages, messages and items, with what moderation takes out, read back from disk."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import upsert
from corpusloom.plans import build, governance, inputs
from corpusloom.plans.catalog import query, table, wide_table
from corpusloom.plans.text import PAGE_EXTRACT_SQL, message_pages
from corpusloom.session import scratch_path
from corpusloom.sources import layout

VERSION = "v2025.5.4"


def _grid(docs: str) -> str:
    """Grid chunks of a table with columns id and content."""
    return f"""
      SELECT id || '_' || i AS chunk_id, * EXCLUDE (content, i), substr(content, i * 800 + 1, 1000) AS chunk_content
      FROM {docs}, unnest(range(0, greatest(1, ceil(length(content) / 800.0))::BIGINT)) AS t(i)
    """


def _read(spark, root: str, name: str):
    return layout.read_version(spark, root, name, "site").drop("dataset", "version")


@query("build_from_pages", f"""
  WITH e AS ({PAGE_EXTRACT_SQL}),
  d AS (SELECT md5(url) AS id, url AS source_url, title, content AS text, content,
               '{{"status_code":200,"content_type":"text/html"}}' AS metadata
        FROM e WHERE page_id % 7 <> 3 AND length(content) > 50),
  l AS (SELECT * EXCLUDE (text), coalesce({inputs.LICENSE_SQL}, 'unknown') AS license FROM d)
  SELECT chunk_id, id AS doc_id, source_url, title, metadata, license, chunk_content FROM ({_grid('l')}) WHERE length(chunk_content) > 50
""")
def build_from_pages(spark, folder):
    """Stored pages with their responses to chunks on disk; every seventh page was not found, every fifth is there in an old state too."""
    pages = wide_table(spark, folder, "pages", "page_id", "url", "html")
    answer = F.when(F.col("page_id") % 7 == 3, 404).otherwise(200).alias("status_code")
    day = F.lit("2025-05-02 10:00:00").cast("timestamp_ntz").alias("crawled_at")
    now = pages.select("url", "html", answer, F.lit("text/html").alias("content_type"), day)
    old = now.where(F.crc32(F.col("url").cast("binary")) % 5 == 0).withColumns({
        "html": F.lit("<body>as it was</body>"), "crawled_at": F.lit("2025-04-02 10:00:00").cast("timestamp_ntz"),
    })
    root = scratch_path(spark, "built")
    build.build_from_pages(now.unionByName(old), root, "site", VERSION, encoder=None)
    return _read(spark, root, "chunks").select("chunk_id", "doc_id", "source_url", "title", "metadata", "license", "chunk_content")


@query("build_messages", """
  WITH m AS (SELECT 'https://archive.example.org/message-id/' || conv_id || '-' || turn AS source_url,
                    '<' || conv_id || '.' || turn || '@list>' AS message_id, md5('topic ' || conv_id) AS thread_id,
                    'Re: topic ' || conv_id AS title, role || ' & co' AS author, text AS content FROM conversations)
  SELECT md5(source_url) AS id, source_url, title, content, author, 'PostgreSQL' AS license, message_id, thread_id,
         '2024-12-15T18:30:45' AS date, 'pgsql-hackers' AS list_name
  FROM m WHERE length(content) > 50
""")
def build_messages(spark, folder):
    """Conversation turns rendered as archive pages, built into a version; its documents with their metadata."""
    root = scratch_path(spark, "built")
    pages = message_pages(spark, folder).withColumn("crawled_at", F.lit("2025-05-02 10:00:00").cast("timestamp_ntz"))
    build.build_messages(pages, root, "site", VERSION, "PostgreSQL", encoder=None)
    about = F.from_json("metadata", "message_id string, date string, thread_id string, list_name string")
    return _read(spark, root, "documents").select("id", "source_url", "title", "content", "author", "license", about.alias("m")).select(
        "id", "source_url", "title", "content", "author", "license", "m.*"
    )


@query("build_items", f"""
  WITH i AS ({inputs.ITEMS_SQL})
  SELECT id || '_0' AS record_id, coalesce(url, 'https://news.example.org/item?id=' || id) AS source_url, "by" AS author,
         'CC0-1.0' AS license, title || CASE WHEN score > 50 THEN chr(10) || 'Scored ' || score ELSE '' END AS content,
         (SELECT count(*) FROM i) AS record_count, 'api' AS source
  FROM i
""")
def build_items(spark, folder):
    """Items with and without text, some of them crawled twice, to attributions, chunks and a sidecar."""
    told = F.when(F.col("score") > 50, F.concat(F.lit("<p>Scored <i>"), F.col("score").cast("string"), F.lit("</i></p>"))).otherwise("")
    found = inputs.items(spark, folder).withColumns({
        "text": told, "descendants": F.lit(None).cast("int"), "parent": F.lit(None).cast("long"), "kids": F.lit(None).cast("array<long>"),
    })
    day = F.lit("2025-05-02 10:00:00").cast("timestamp_ntz")
    now = upsert.item_rows(found, F.lit("top"), day)
    old = upsert.item_rows(found.where(F.col("id") % 3 == 0).withColumn("text", F.lit("old")), F.lit("new"), day - F.expr("INTERVAL 1 DAY"))
    root = scratch_path(spark, "built")
    build.build_items(now.unionByName(old), root, "site", VERSION, "CC0-1.0", address="https://news.example.org/item?id=", encoder=None)
    content = _read(spark, root, "chunks").select(F.col("chunk_id").alias("record_id"), F.col("chunk_content").alias("content"))
    rows = _read(spark, root, "attributions").select("record_id", "source_url", "author", "license").join(content, "record_id")
    described = layout.read_sidecar(spark, root, "site").first()
    return rows.withColumns({"record_count": F.lit(described.record_count).cast("long"), "source": F.lit(described.source)})


@query("build_moderated", f"""
  WITH s AS ({governance.SCRUB_SQL})
  SELECT s.doc_id::VARCHAR AS id, source || '/' || s.doc_id AS source_url, s.text AS content
  FROM s JOIN documents d ON d.doc_id = s.doc_id
  WHERE length(d.text) > 50 AND s.doc_id % 11 <> 5
    AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = s.doc_id AND (toxic = 1 OR quality = 0))
""")
def build_moderated(spark, folder):
    """A build without documents that labels call toxic or bad, without addresses that were claimed, and without personal data."""
    root, text = scratch_path(spark, "built"), F.length("content") > 50
    docs = inputs.documents(spark, folder).where(text).select(
        "id", "source_url", F.lit(None).cast("string").alias("title"), "content", F.lit("{}").alias("metadata"), "license",
        F.lit("Unknown").alias("author"), F.current_timestamp().alias("processed_at"),
    )
    bad = table(spark, folder, "labels").where("toxic = 1 OR quality = 0").select(F.col("doc_id").cast("string").alias("id"))
    claimed = docs.where(F.col("id").cast("long") % 11 == 5).select("source_url")
    build.build_documents(docs, root, "site", VERSION, encoder=None, moderation=build.Moderation(bad, claimed, scrub=True))
    return _read(spark, root, "documents").select("id", "source_url", "content")
