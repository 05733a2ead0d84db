"""The whole journeys: build a dataset version from crawl rows, pages, messages or items, update it, and search it.

Each stage reads what the stage before has stored, so every table is computed once and a lost executor repeats a part of
one stage. Readers see a version when all of its tables are stored; a build that failed is simply run again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusloom.functions.text import strip_tags
from corpusloom.operators import chunk, clean, embed, govern, html, search, stats
from corpusloom.operators.skew import join_on_hot_key
from corpusloom.operators.upsert import CHANGED, DELETED, NEW, UNCHANGED, document_states
from corpusloom.session import cut_lineage
from corpusloom.sources import layout


def build_version(
    raw: DataFrame,
    root: str,
    dataset: str,
    version: str,
    strategy: str = "grid",
    size: int = 1000,
    overlap: int = 200,
    min_chars: int = 50,
    encoder: Callable[[], embed.Encoder] | None = embed.HashingEncoder,
    compression: str = "zstd",
) -> DataFrame:
    """Clean, deduplicate, chunk, attribute and (unless ``encoder`` is None) embed crawl rows into one version.

    Stores documents, chunks, attributions and embeddings with their manifests, checks keys and required columns, releases
    the version and returns the closing report ``(status, documents, chunks, dataset, version)``.
    """
    return build_documents(_newest_documents(raw, min_chars), root, dataset, version, strategy, size, overlap, min_chars, encoder, compression)


@dataclass
class Moderation:
    """What must not get into a version.

    ``unwanted`` lists document ids (column ``id``), ``takedowns`` addresses (column ``source_url``), with ``scrub`` e-mail addresses, IPv4
    addresses and phone numbers are replaced in title and content. Nulls and repeated rows in the lists do not matter.
    """

    unwanted: DataFrame | None = None
    takedowns: DataFrame | None = None
    scrub: bool = False

    def apply(self, docs: DataFrame) -> DataFrame:
        """The documents that stay, scrubbed last, so that no text is scrubbed in vain. Counts the lists (an action each)."""
        columns = docs.columns
        if self.unwanted is not None:
            docs = govern.without_takedowns(docs, self.unwanted, "id")
        if self.takedowns is not None:
            docs = govern.without_takedowns(docs, self.takedowns, "source_url")
        if self.scrub:
            for text in ("title", "content"):
                docs = govern.scrub_personal_data(docs, text).select(*columns)
        return docs.select(*columns)


def build_documents(
    docs: DataFrame,
    root: str,
    dataset: str,
    version: str,
    strategy: str = "grid",
    size: int = 1000,
    overlap: int = 200,
    min_chars: int = 50,
    encoder: Callable[[], embed.Encoder] | None = embed.HashingEncoder,
    compression: str = "zstd",
    moderation: Moderation | None = None,
    source: str = "crawl",
) -> DataFrame:
    """The build from documents on (columns of ``DOCUMENTS``, unique ids): the stages and the report of :func:`build_version`.

    ``moderation`` is applied before the first table is stored. A sidecar ``(dataset_name, version, record_count, created_at, source,
    license)`` is stored beside the tables; its license lists those of the documents (:func:`layout.read_sidecar`).
    """
    draft = _Draft(docs.sparkSession, root, dataset, version, compression)
    draft.store(docs if moderation is None else moderation.apply(docs), "documents")
    chunks = chunk.chunk_documents(draft.stored("documents"), strategy, size, overlap, min_chars, keep=_FROM_DOCUMENT)
    draft.store(chunks, "chunks", checksum_of="chunk_content", chunk_size=size, chunk_overlap=overlap)
    draft.store(govern.attributions(draft.stored("chunks"), "chunk_id"), "attributions", sort_by="record_id")
    if encoder is not None:
        # Stored before they are sorted: the sort reads its input twice, and no text is to be encoded twice.
        vectors = cut_lineage(embed.embed_chunks(draft.stored("chunks"), encoder))
        draft.store(embed.embeddings_table(vectors), "embeddings", sort_by="chunk_id")
    return draft.release(source)


def build_from_pages(
    pages: DataFrame, root: str, dataset: str, version: str, default_license: str = "unknown", min_chars: int = 50, **options
) -> DataFrame:
    """A version from stored pages ``(url, html, status_code, content_type, crawled_at)``; ``options`` as in :func:`build_documents`.

    Title and text are extracted from the page's structure, the license is looked for in the text, and the response goes into the
    metadata. Pages that were not answered with 200 (null counts as 200) and texts of at most ``min_chars`` characters are left out; of pages
    with one address the last crawled counts, of these the one with the greatest HTML. Pages without address or HTML are left out.
    """
    answered = pages.where(F.col("url").isNotNull() & F.col("html").isNotNull() & (F.coalesce("status_code", F.lit(200)) == 200))
    newest = clean.dedup_latest(answered.select("url", "html", "status_code", "content_type", "crawled_at"), tie="html")
    found = html.extract_pages(newest, status_code=F.col("status_code"), content_type=F.col("content_type"))
    docs = found.where(F.length("content") > min_chars).select(
        F.md5("url").alias("id"), F.col("url").alias("source_url"), "title", "content", F.to_json("metadata").alias("metadata"),
        F.coalesce(govern.detect_license("content"), F.lit(default_license)).alias("license"), F.lit("Unknown").alias("author"),
        F.current_timestamp().alias("processed_at"),
    )
    return build_documents(docs, root, dataset, version, min_chars=min_chars, **options)


def build_messages(
    pages: DataFrame, root: str, dataset: str, version: str, license_label: str = "unknown", list_name: str = "pgsql-hackers",
    min_chars: int = 50, **options
) -> DataFrame:
    """A version from stored message pages ``(url, html, crawled_at)``; ``options`` as in :func:`build_documents`.

    The subject is the title; message id, date, thread and list go into the metadata. Pages without address or HTML, and messages of at
    most ``min_chars`` characters, are left out; of pages with one address the last crawled counts, as in :func:`build_from_pages`.
    """
    newest = clean.dedup_latest(pages.where("url IS NOT NULL AND html IS NOT NULL").select("url", "html", "crawled_at"), tie="html")
    rows = html.message_rows(html.extract_messages(newest, list_name=list_name))
    about = F.struct("message_id", F.date_format("date_parsed", "yyyy-MM-dd'T'HH:mm:ss").alias("date"), "thread_id", "list_name")
    docs = rows.where(F.length("content") > min_chars).select(
        F.md5("url").alias("id"), F.col("url").alias("source_url"), F.col("subject").alias("title"), "content",
        F.to_json(about).alias("metadata"), F.lit(license_label).alias("license"), F.coalesce("author", F.lit("Unknown")).alias("author"),
        F.current_timestamp().alias("processed_at"),
    )
    return build_documents(docs, root, dataset, version, min_chars=min_chars, source="archive", **options)


def build_items(
    items: DataFrame, root: str, dataset: str, version: str, license_label: str = "unknown", min_chars: int = 0,
    address: str = "item:", **options
) -> DataFrame:
    """A version from stored items (columns of ``ITEMS``); ``options`` as in :func:`build_documents`.

    The content is the title and the text without tags, on lines of their own. The address is the item's, else ``address`` and the id. Type,
    score, time, list and parent go into the metadata. Items without id, and of at most ``min_chars`` characters, are left out; of rows with
    one id the last crawled counts.
    """
    newest = clean.dedup_latest(items.where("id IS NOT NULL"), "id").withColumn("text", strip_tags("text"))
    content = F.concat_ws("\n", F.nullif("title", F.lit("")), F.nullif("text", F.lit("")))
    own = F.concat(F.lit(address), F.col("id").cast("string"))
    about = F.struct("type", "score", F.date_format("time_parsed", "yyyy-MM-dd'T'HH:mm:ss").alias("time"), "story_type", "parent")
    docs = newest.select(
        F.col("id").cast("string").alias("id"), F.coalesce("url", own).alias("source_url"), "title", content.alias("content"),
        F.to_json(about).alias("metadata"), F.lit(license_label).alias("license"), F.coalesce("by", F.lit("Unknown")).alias("author"),
        F.current_timestamp().alias("processed_at"),
    )
    docs = docs.where(F.length("content") > min_chars)
    return build_documents(docs, root, dataset, version, min_chars=min_chars, source="api", **options)


def update_version(
    raw: DataFrame,
    root: str,
    dataset: str,
    version: str,
    base: str = "latest",
    strategy: str = "grid",
    size: int = 1000,
    overlap: int = 200,
    min_chars: int = 50,
    encoder: Callable[[], embed.Encoder] = embed.HashingEncoder,
    compression: str = "zstd",
) -> DataFrame:
    """A new version from a new crawl that reuses what the ``base`` version has: the same rows as :func:`build_version`.

    Documents are compared by id and content hash. Chunks of unchanged documents are carried over, with the address, title, license and
    metadata that the document has now; new and changed documents are chunked. A chunk whose text stood under the same id
    before keeps its vector; only the others are encoded. What the crawl no longer has is left out. ``strategy`` and the sizes must be
    those of the base; sizes are checked.

    Only ids and hashes are shuffled to find the difference, chunks meet their documents through a join that leaves chunks of a huge
    document in place, and vectors meet chunks by chunk id. Returns the report of the build with ``unchanged``, ``changed``, ``new``,
    ``deleted`` documents and ``carried``, ``encoded`` vectors.
    """
    spark = raw.sparkSession
    base = layout.resolve_version(spark, root, dataset, base, "embeddings")

    def before(table: str) -> DataFrame:
        return layout.read_version(spark, root, table, dataset, base).drop("dataset", "version")

    made = layout.read_manifest(spark, root, dataset, base, "chunks").select("chunk_size", "chunk_overlap").first()
    if (made.chunk_size, made.chunk_overlap) != (size, overlap):
        raise ValueError(f"{dataset} {base} has chunks of {made.chunk_size} with {made.chunk_overlap} overlap")
    draft = _Draft(spark, root, dataset, version, compression)
    draft.store(_newest_documents(raw, min_chars), "documents")
    docs = draft.stored("documents")
    states = cut_lineage(document_states(docs, before("documents")))
    same = states.where(F.col("state") == UNCHANGED).select("id")
    about = docs.select(F.col("id").alias("doc_id"), *_FROM_DOCUMENT).join(same.withColumnRenamed("id", "doc_id"), "doc_id")
    carried = join_on_hot_key(before("chunks").drop(*_FROM_DOCUMENT), about, "doc_id")
    others = docs.join(states.where(F.col("state").isin(CHANGED, NEW)).select("id"), "id", "left_semi")
    fresh = chunk.chunk_documents(others, strategy, size, overlap, min_chars, keep=_FROM_DOCUMENT)
    chunks = fresh.unionByName(carried.select(fresh.columns))
    draft.store(chunks, "chunks", checksum_of="chunk_content", chunk_size=size, chunk_overlap=overlap)
    draft.store(govern.attributions(draft.stored("chunks"), "chunk_id"), "attributions", sort_by="record_id")
    known = before("embeddings").select("chunk_id", F.md5("chunk_content").alias("_md5"), "embedding").where("embedding IS NOT NULL")
    met = cut_lineage(draft.stored("chunks").withColumn("_md5", F.md5("chunk_content")).join(known, ["chunk_id", "_md5"], "left").drop("_md5"))
    kept, missing = met.where("embedding IS NOT NULL"), met.where("embedding IS NULL").drop("embedding")
    # Stored before they are sorted, as in a whole build.
    vectors = kept.unionByName(cut_lineage(embed.embed_chunks(missing, encoder).select(kept.columns)))
    draft.store(embed.embeddings_table(vectors), "embeddings", sort_by="chunk_id")
    documents = [F.count(F.when(F.col("state") == s, 1)).alias(s) for s in (UNCHANGED, CHANGED, NEW, DELETED)]
    vectors = met.agg(F.count("embedding").alias("carried"), F.count_if(F.col("embedding").isNull()).alias("encoded"))
    numbers = states.agg(*documents).first().asDict() | vectors.first().asDict()
    return draft.release().withColumns({name: F.lit(number).cast("long") for name, number in numbers.items()})


# What chunks repeat of their document.
_FROM_DOCUMENT = ("source_url", "title", "license", "author", "metadata")


def _newest_documents(raw: DataFrame, min_chars: int) -> DataFrame:
    return clean.dedup_latest(clean.clean_documents(raw, min_chars), key="source_url", tie="id").drop("crawled_at")


class _Draft:
    """The tables of one version while it is built: stored one after the other, checked and released together."""

    def __init__(self, spark: SparkSession, root: str, dataset: str, version: str, compression: str) -> None:
        self.spark, self.root, self.dataset, self.version, self.compression = spark, root, dataset, version, compression
        self.tables: list[str] = []

    def store(self, df: DataFrame, table: str, **options) -> None:
        layout.write_version(df, self.root, table, self.dataset, self.version, self.compression, released=False, **options)
        self.tables.append(table)

    def stored(self, table: str) -> DataFrame:
        return layout.read_version(self.spark, self.root, table, self.dataset, self.version).drop("dataset", "version")

    def release(self, source: str = "crawl") -> DataFrame:
        """Check keys and required columns, store the sidecar, show the version to readers, and report on it."""

        def rows(table: str) -> Column:
            return F.max(F.when(F.col("table") == table, F.col("row_count")))

        for table, key, required in (("documents", "id", ["source_url", "content", "license"]), ("chunks", "chunk_id", ["doc_id", "chunk_content"])):
            broken = govern.constraint_report(self.stored(table), key, [key, *required]).where("violations > 0").collect()
            if broken:
                raise ValueError(f"{table} of {self.dataset} {self.version} is not released: {broken}")
        licenses = F.coalesce(F.array_join(F.sort_array(F.collect_set("license")), "/"), F.lit(""))
        label = self.stored("documents").agg(licenses).first()[0]
        sidecar = stats.metadata_sidecar(self.stored("documents"), self.dataset, self.version, source, label)
        layout.write_sidecar(sidecar, self.root, self.dataset, self.version)
        layout.release(self.spark, self.root, self.dataset, self.version, self.tables)
        written = layout.read_manifests(self.spark, self.root)
        written = written.where((F.col("dataset") == self.dataset) & (F.col("version") == self.version))
        counts = written.groupBy("dataset", "version").agg(rows("documents").alias("document_count"), rows("chunks").alias("chunk_count"))
        return stats.build_summary(counts)


def search_version(
    spark: SparkSession,
    root: str,
    dataset: str,
    query: str | Sequence[float],
    version: str = "latest",
    k: int = 10,
    licenses: list[str] | None = None,
    include_embeddings: bool = False,
    encoder: Callable[[], embed.Encoder] = embed.HashingEncoder,
) -> DataFrame:
    """The ``k`` best chunks for a text or a vector, best first, with content, address, license, metadata and ``meta``.

    A text is embedded by the same encoder as the dataset. Finds the hits while it is built (an action).
    """
    if isinstance(query, str):
        query = np.asarray(encoder().encode([query])[0], dtype=float).tolist()
    version = layout.resolve_version(spark, root, dataset, version, "embeddings")
    corpus = layout.read_version(spark, root, "embeddings", dataset, version).drop("dataset", "version")
    hits = search.search(corpus, query, k, licenses)
    # k rows: their ids go into the scan, which reads the few row groups of a table sorted by id.
    found = hits.collect()
    hits = spark.createDataFrame(found, hits.schema)
    columns = ["chunk_id", "chunk_content", "source_url", "license", "metadata"]
    content = corpus.select(*columns, *(["embedding"] if include_embeddings else []))
    content = content.where(F.col("chunk_id").isin([row.chunk_id for row in found]))
    full = search.hydrate(hits, content, k, include_embeddings=include_embeddings)
    full = full.withColumnRenamed("chunk_content", "content").orderBy(F.col("similarity").desc_nulls_last(), "chunk_id")
    total = layout.read_manifest(spark, root, dataset, version, "embeddings").select("row_count").first()[0]
    return search.search_response(full, total, dataset, version)
