"""Queries that write with the library and read back. Everything goes to fresh folders below the shared root."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpusloom.operators import chunk
from corpusloom.plans import build, inputs
from corpusloom.plans.catalog import query, table
from corpusloom.plans.text import GRID_SQL
from corpusloom.plans.vectors import QUERY_TEXT
from corpusloom.schemas import RAW_CRAWL
from corpusloom.session import scratch_path
from corpusloom.sources import crawl, file_index, layout, tables
from corpusloom.streaming import buckets, incremental

D, RAW = inputs.DOCUMENTS_SQL, inputs.RAW_CRAWL_SQL


@query("json_scan", f"WITH raw AS ({RAW}) SELECT url, title, metadata, crawled_at, length(content)::INTEGER AS n FROM raw")
def json_scan(spark, folder):
    """Crawl output as JSON lines, scanned through a glob with the declared schema."""
    path = scratch_path(spark, "json_scan")
    crawl.write_jsonl(inputs.raw_crawl(spark, folder), path)
    rows = crawl.read_json(spark, f"{path}/*.json", RAW_CRAWL)
    return rows.select("url", "title", "metadata", "crawled_at", F.length("content").alias("n"))


@query("jsonl_roundtrip", f"""
  WITH RECURSIVE {GRID_SQL}
  SELECT id || '_' || i AS chunk_id, i::INTEGER AS chunk_index, substr(content, i * 800 + 1, 1000) AS chunk_content
  FROM c WHERE length(substr(content, i * 800 + 1, 1000)) > 50
""")
def jsonl_roundtrip(spark, folder):
    """Documents to JSON lines, chunked from there, chunks to compressed JSON lines."""
    docs_path, chunks_path = scratch_path(spark, "docs"), scratch_path(spark, "chunks")
    docs = inputs.documents(spark, folder).select("id", "content")
    crawl.write_jsonl(docs, docs_path)
    chunks = chunk.chunk_documents(crawl.read_json(spark, docs_path, docs.schema), "grid")
    chunks = chunks.select("chunk_id", "chunk_index", "chunk_content")
    crawl.write_jsonl(chunks, chunks_path, "gzip")
    return crawl.read_json(spark, chunks_path, chunks.schema)


@query("versioned_write", f"""
  WITH d AS ({D})
  SELECT lang AS dataset, {inputs.VERSION_OF_SOURCE_SQL} AS version, count(*) AS documents,
         sum(length(content))::BIGINT AS characters
  FROM d GROUP BY 1, 2
""")
def versioned_write(spark, folder):
    """Many versions of many datasets written at once, then read as one table with partition columns."""
    root = scratch_path(spark, "versions")
    docs = inputs.documents(spark, folder).select(
        F.col("lang").alias("dataset"), inputs.version_of_source().alias("version"), "id", "source_url", "content", "license"
    )
    layout.write_versions(docs, root, "documents")
    stored = layout.read_all_versions(spark, root, "documents")
    return stored.groupBy("dataset", "version").agg(
        F.count(F.lit(1)).alias("documents"), F.sum(F.length("content")).alias("characters")
    )


@query("version_manifests", f"""
  WITH d AS ({D})
  SELECT lang AS dataset, {inputs.VERSION_OF_SOURCE_SQL} AS version, 'documents' AS "table", count(*) AS row_count,
         'id,license' AS columns, 'snappy' AS compression
  FROM d GROUP BY 1, 2
""")
def version_manifests(spark, folder):
    root = scratch_path(spark, "versions")
    docs = inputs.documents(spark, folder).select(
        F.col("lang").alias("dataset"), inputs.version_of_source().alias("version"), "id", "license"
    )
    layout.write_versions(docs, root, "documents", compression="snappy")
    found = layout.read_manifests(spark, root)
    return found.select(
        "dataset", "version", "table", "row_count", F.array_join("columns", ",").alias("columns"), "compression"
    )


@query("publish_version", f"""
  WITH RECURSIVE {GRID_SQL},
  k AS (SELECT substr(content, i * 800 + 1, 1000) AS piece FROM c WHERE length(substr(content, i * 800 + 1, 1000)) > 50)
  SELECT 'manuals' AS dataset, 'v2025.3.2' AS version, count(*) AS row_count, 1000 AS chunk_size, 200 AS chunk_overlap,
         md5(concat_ws(':', count(*), {", ".join(
             f"sum(('0x' || substr(md5(piece), {4 * i + 1}, 4))::BIGINT)::VARCHAR" for i in range(8))})) AS content_checksum,
         count(*) AS stored_rows
  FROM k
""")
def publish_version(spark, folder):
    """Two versions of the chunks; the later one is published with checksum and found again as ``latest``."""
    root = scratch_path(spark, "published")
    chunks = chunk.chunk_documents(inputs.documents(spark, folder), "grid", keep=("source_url", "license"))
    layout.write_version(chunks.where(F.col("chunk_index") == 0), root, "chunks", "manuals", "v2025.1.9", "gzip")
    layout.write_version(
        chunks, root, "chunks", "manuals", "v2025.3.2", checksum_of="chunk_content", chunk_size=1000, chunk_overlap=200
    )
    newest = layout.read_version(spark, root, "chunks", "manuals", "latest")
    manifest = layout.read_manifest(spark, root, "manuals", "v2025.3.2", "chunks")
    stored = newest.groupBy("dataset", "version").agg(F.count(F.lit(1)).alias("stored_rows"))
    return manifest.join(stored, ["dataset", "version"]).select(
        "dataset", "version", "row_count", "chunk_size", "chunk_overlap", "content_checksum", "stored_rows"
    )


@query("version_files", f"""
  WITH d AS ({D})
  SELECT lang AS dataset, {inputs.VERSION_OF_SOURCE_SQL} AS version, {inputs.VERSION_OF_SOURCE_SQL} AS path_version,
         true AS has_size, count(*) AS row_count
  FROM d GROUP BY 1, 2
""")
def version_files(spark, folder):
    """Files per version, with the version read back from the path."""
    root = scratch_path(spark, "files")
    docs = inputs.documents(spark, folder).select(
        F.col("lang").alias("dataset"), inputs.version_of_source().alias("version"), "id"
    )
    layout.write_versions(docs, root, "documents")
    files = layout.version_files(layout.read_all_versions(spark, root, "documents", with_files=True))
    return files.groupBy("dataset", "version", layout.version_of_path(F.col("file_path")).alias("path_version")).agg(
        F.every(F.col("file_size") > 0).alias("has_size"), F.sum("row_count").alias("row_count")
    )


def _namespace(spark) -> str:
    name = f"ns_{uuid.uuid4().hex}"
    tables.ensure_namespace(spark, name, scratch_path(spark, "tables"))
    return name


@query("table_writer", """
  SELECT event_type, count(*) AS n, round(sum(value), 4) AS total
  FROM (SELECT event_type, value FROM events UNION ALL SELECT event_type, -value FROM events WHERE value > 50)
  GROUP BY 1
""")
def table_writer(spark, folder):
    """Create, overwrite twice, append, read."""
    name = f"{_namespace(spark)}.items"
    events = table(spark, folder, "events").select("event_id", "value", "event_type")
    assert tables.ensure_table(spark, name, events.schema, ("event_type",))
    assert not tables.ensure_table(spark, name, events.schema, ("event_type",))
    tables.overwrite_rows(events.where(F.col("value") > 50), name, ("event_type",))
    tables.overwrite_rows(events, name, ("event_type",))
    negated = events.where(F.col("value") > 50).withColumn("value", -F.col("value"))
    tables.append_rows(negated, name, ("event_type",))
    return spark.table(name).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")
    )


@query("delete_version", f"""
  WITH d AS ({D})
  SELECT lang AS dataset, {inputs.VERSION_OF_SOURCE_SQL} AS version, count(*) AS documents
  FROM d WHERE NOT (lang = 'en' AND source = 'src3') GROUP BY 1, 2
""")
def delete_version(spark, folder):
    """One version of one dataset dropped from a partitioned table."""
    name = f"{_namespace(spark)}.documents"
    docs = inputs.documents(spark, folder).select(
        "id", "content", F.col("lang").alias("dataset"), inputs.version_of_source().alias("version")
    )
    tables.ensure_table(spark, name, docs.schema, ("dataset", "version"))
    tables.append_rows(docs, name, ("dataset", "version"))
    tables.delete_version(spark, name, "en", "v2024.3.1")
    left = tables.list_partitions(spark, name)
    counts = spark.table(name).groupBy("dataset", "version").agg(F.count(F.lit(1)).alias("documents"))
    return left.join(counts, ["dataset", "version"])


# --- incremental --------------------------------------------------------------------------------------------------

@query("incremental_ingest", "SELECT event_type, count(*) AS n, max(event_id) AS last FROM events GROUP BY 1")
def incremental_ingest(spark, folder):
    """The events file ingested as a stream; the second run finds nothing new."""
    target, checkpoint = scratch_path(spark, "ingested"), scratch_path(spark, "progress")
    schema = table(spark, folder, "events").schema
    for _ in range(2):
        stream = incremental.file_stream(spark, folder, schema, glob="events.parquet")
        incremental.ingest_new(stream, target, checkpoint)
    ingested = spark.read.schema(schema).parquet(target)
    return ingested.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last"))


@query("incremental_upsert", """
  SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value, max(ts) AS ts
  FROM events GROUP BY 1
""")
def incremental_upsert(spark, folder):
    """The latest event per user kept by a streaming upsert."""
    target, checkpoint = scratch_path(spark, "log"), scratch_path(spark, "progress")
    schema = table(spark, folder, "events").schema
    order = ["ts", "event_id"]
    stream = incremental.file_stream(spark, folder, schema, glob="events.parquet").select("user_id", "event_id", "value", "ts")
    incremental.upsert_new(stream, target, checkpoint, "user_id", order)
    return incremental.current_rows(spark, target, "user_id", order)


# --- whole journeys -----------------------------------------------------------------------------------------------

CLEANED_SQL = f"""
  cleaned AS ({inputs.CLEANED_SQL}),
  k AS (SELECT id || '_' || i AS chunk_id, url, license, author, metadata, substr(content, i * 800 + 1, 1000) AS piece
        FROM cleaned, unnest(range(0, greatest(1, ceil(length(content) / 800.0))::BIGINT)) AS t(i)
        WHERE length(substr(content, i * 800 + 1, 1000)) > 50)
"""


@query("build_version", f"""
  WITH RECURSIVE {CLEANED_SQL}
  SELECT 'complete' AS status, (SELECT count(*) FROM cleaned) AS documents, (SELECT count(*) FROM k) AS chunks,
         'web' AS dataset, 'v2025.3.2' AS version
""")
def build_version(spark, folder):
    """Stored pages all the way to documents, chunks, attributions and embeddings on disk."""
    return build.build_version(inputs.raw_crawl(spark, folder), scratch_path(spark, "built"), "web", "v2025.3.2")


class _Failing:
    def encode(self, texts):
        raise RuntimeError("no model")


@query("build_again", """
  SELECT 'web' AS dataset, 'v2025.2.1' AS latest_after_failure, 'v2025.3.2' AS latest_after_rerun, count(DISTINCT url) AS documents
  FROM pages WHERE length(html) > 50
""")
def build_again(spark, folder):
    """A build that fails half-way leaves the earlier version in place, and the next run takes its place."""
    root, raw = scratch_path(spark, "built"), inputs.raw_crawl(spark, folder)
    build.build_version(raw, root, "web", "v2025.2.1", encoder=None)
    try:
        build.build_version(raw, root, "web", "v2025.3.2", encoder=_Failing)
    except Exception as failure:
        if "no model" not in str(failure):
            raise
    before = layout.resolve_version(spark, root, "web")
    report = build.build_version(raw, root, "web", "v2025.3.2", encoder=None)
    after = layout.resolve_version(spark, root, "web")
    return report.select("dataset", F.lit(before).alias("latest_after_failure"), F.lit(after).alias("latest_after_rerun"), "documents")


@query("delete_stored_version", f"""
  WITH d AS ({D})
  SELECT lang AS dataset, {inputs.VERSION_OF_SOURCE_SQL} AS version, count(*) AS documents
  FROM d WHERE NOT (lang = 'en' AND source = 'src3') GROUP BY 1, 2
""")
def delete_stored_version(spark, folder):
    """One version deleted from the file layout, its files and its release."""
    root = scratch_path(spark, "versions")
    docs = inputs.documents(spark, folder).select(F.col("lang").alias("dataset"), inputs.version_of_source().alias("version"), "id")
    layout.write_versions(docs, root, "documents")
    layout.delete_version(spark, root, "en", "v2024.3.1")
    seen = layout.read_manifests(spark, root).select("dataset", "version")
    counts = layout.read_all_versions(spark, root, "documents").groupBy("dataset", "version").agg(F.count(F.lit(1)).alias("documents"))
    return counts.join(seen, ["dataset", "version"])


@query("build_attributions", f"""
  WITH RECURSIVE {CLEANED_SQL}
  SELECT chunk_id AS record_id, url AS source_url, author, license,
         author || ', ' || url || ' (' || license || ')' AS attribution_text
  FROM k
""")
def build_attributions(spark, folder):
    root = scratch_path(spark, "built")
    build.build_version(inputs.raw_crawl(spark, folder), root, "web", "v2025.3.2", encoder=None)
    return layout.read_version(spark, root, "attributions", "web").drop("dataset", "version")


@query("search_version", f"""
  WITH RECURSIVE {CLEANED_SQL},
  everything AS (SELECT chunk_id, piece FROM k WHERE license = 'MIT' UNION ALL SELECT '?', '{QUERY_TEXT}'),
  t AS (SELECT chunk_id, unnest(regexp_extract_all(lower(piece), '[a-z0-9]+')) AS token FROM everything),
  b AS (SELECT chunk_id, ('0x' || substr(md5(token), 1, 8))::BIGINT % 64 AS bucket, count(*) AS n FROM t GROUP BY 1, 2),
  v AS (SELECT chunk_id, bucket, (n / sqrt(sum(n * n) OVER (PARTITION BY chunk_id)))::FLOAT::DOUBLE AS w FROM b),
  m AS (SELECT chunk_id, sqrt(sum(w * w)) AS norm FROM v GROUP BY 1),
  s AS (SELECT a.chunk_id, round(sum(a.w * q.w) / (any_value(ma.norm) * any_value(mq.norm)), 12) AS sim
        FROM v a JOIN v q ON q.chunk_id = '?' AND q.bucket = a.bucket JOIN m ma ON ma.chunk_id = a.chunk_id
        JOIN m mq ON mq.chunk_id = '?' WHERE a.chunk_id <> '?' GROUP BY 1 ORDER BY sim DESC, a.chunk_id LIMIT 10)
  SELECT chunk_id, piece AS content, url AS source_url, license, metadata, round(sim, 6) AS similarity,
         'web' AS dataset, 'v2025.3.2' AS version, (SELECT count(*) FROM k) AS total_chunks
  FROM s JOIN k USING (chunk_id)
""")
def search_version(spark, folder):
    """A text searched in the latest version built from stored pages, with a license filter."""
    root = scratch_path(spark, "built")
    build.build_version(inputs.raw_crawl(spark, folder), root, "web", "v2025.3.2")
    hits = build.search_version(spark, root, "web", QUERY_TEXT, licenses=["MIT"])
    return hits.select(
        "chunk_id", "content", "source_url", "license", "metadata", F.round("similarity", 6).alias("similarity"), "meta.*"
    )


@query("update_version", f"""
  WITH RECURSIVE {CLEANED_SQL},
  old AS (SELECT page_id % 10 AS part FROM pages WHERE length(html) > 50)
  SELECT 'complete' AS status, 'web' AS dataset, 'v2025.4.1' AS version, (SELECT count(*) FROM cleaned) AS documents,
         (SELECT count(*) FROM k) AS chunks, count(*) FILTER (part NOT IN (3, 4)) AS unchanged, count(*) FILTER (part = 4) AS changed,
         count(*) FILTER (part = 3) AS new, count(*) FILTER (part = 5) AS deleted, TRUE AS as_rebuilt, TRUE AS some_carried
  FROM old
""")
def update_version(spark, folder):
    """A version brought up to date after a crawl: some pages are new, some changed, some gone. Compared with a full build."""
    root, raw = scratch_path(spark, "built"), inputs.raw_crawl(spark, folder)
    part = F.col("crawl_part")
    marked = raw.join(table(spark, folder, "pages").select("url", (F.col("page_id") % 10).alias("crawl_part")), "url")
    text = F.when(part == 4, F.concat("content", F.lit(" <p>as it was</p>"))).otherwise(F.col("content"))
    earlier = marked.where(part != 3).withColumn("content", text)
    gone = marked.where(part == 5).withColumn("url", F.concat("url", F.lit("/gone")))
    build.build_version(earlier.unionByName(gone).select(raw.columns), root, "web", "v2025.3.2")
    report = build.update_version(raw, root, "web", "v2025.4.1")
    build.build_version(raw, root, "rebuilt", "v2025.4.1")
    whole = [
        layout.read_version(spark, root, "embeddings", name, "v2025.4.1").drop("dataset", "version", "created_at") for name in ("web", "rebuilt")
    ]
    same = whole[0].exceptAll(whole[1]).isEmpty() and whole[1].exceptAll(whole[0]).isEmpty()
    some = (F.col("carried") > F.col("encoded")) & (F.col("encoded") > 0)
    return report.withColumns({"as_rebuilt": F.lit(same), "some_carried": some}).drop("carried", "encoded")


@query("bucketed_upsert", """
  SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value, max(ts) AS ts,
         coalesce(min(ts) FILTER (event_id % 3 = 0), min(ts) FILTER (event_id % 3 = 1), min(ts)) AS first_ts, TRUE AS others_untouched
  FROM events GROUP BY 1
""")
def bucketed_upsert(spark, folder):
    """The latest event per user after three batches and a replay of the second; a last batch of one user touches one bucket only."""
    target = scratch_path(spark, "buckets")
    events = table(spark, folder, "events").select("user_id", "event_id", "value", "ts", F.col("ts").alias("first_ts"))
    order = ["ts", "event_id"]
    for part in (0, 1, 2, 1):
        buckets.upsert_buckets(events.where(F.col("event_id") % 3 == part), target, "user_id", order, 16, ("first_ts",))

    def files():
        rows = buckets.read_buckets(spark, target, events.schema).select("bucket", F.col("_metadata.file_name").alias("file"))
        return {(r.bucket, r.file) for r in rows.distinct().collect()}

    before = files()
    user = events.agg(F.max("user_id")).first()[0]
    touched = buckets.upsert_buckets(events.where(F.col("user_id") == user), target, "user_id", order, 16, ("first_ts",))
    kept = {f for f in before if f[0] not in touched} <= files() and len(touched) == 1
    return buckets.read_buckets(spark, target, events.schema).drop("bucket").withColumn("others_untouched", F.lit(kept))


@query("indexed_lookup", """
  SELECT doc_id, source, n_chars, TRUE AS few_files_opened FROM documents WHERE doc_id IN (5, 77, 123)
""")
def indexed_lookup(spark, folder):
    """Three documents of a table in no order, found through the index of its files: no more files are opened than hold them."""
    path, index = scratch_path(spark, "table"), scratch_path(spark, "index")
    docs = table(spark, folder, "documents").select("doc_id", "source", "n_chars", "text")
    docs.repartition(32, "doc_id").write.parquet(path)
    file_index.build_index(spark, path, "doc_id", index, docs.schema)
    found = file_index.lookup(spark, docs.schema, index, "doc_id", [5, 77, 123, 1 << 40])
    return found.select("doc_id", "source", "n_chars").withColumn("few_files_opened", F.lit(len(found.inputFiles()) <= 4))
