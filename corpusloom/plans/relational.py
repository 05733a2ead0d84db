"""Scans, projections, filters, aggregates, orders and upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions.dates import epoch_time
from corpusloom.functions.text import json_text
from corpusloom.functions.urls import domain
from corpusloom.operators import clean, graph, stats, upsert
from corpusloom.plans import inputs
from corpusloom.plans.catalog import query, table

D, ITEMS = inputs.DOCUMENTS_SQL, inputs.ITEMS_SQL


@query("parquet_scan_filter", "SELECT doc_id, lang, source, n_chars FROM documents WHERE lang = 'en' AND n_chars > 50")
def parquet_scan_filter(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.where((F.col("lang") == "en") & (F.col("n_chars") > 50)).select("doc_id", "lang", "source", "n_chars")


@query("scan_like", "SELECT doc_id, source, n_chars FROM documents WHERE source LIKE 'src1%' OR text LIKE '%License%'")
def scan_like(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.where(F.col("source").like("src1%") | F.col("text").like("%License%")).select("doc_id", "source", "n_chars")


@query("clean_documents", f"SELECT id, url AS source_url, title, content, license, author FROM ({inputs.CLEANED_SQL})")
def clean_documents(spark, folder):
    docs = clean.clean_documents(inputs.raw_crawl(spark, folder), min_len=50)
    newest = clean.dedup_latest(docs, key="source_url", tie="id")
    return newest.select("id", "source_url", "title", "content", "license", "author")


@query("attribution_lookup", f"""
  WITH d AS ({D})
  SELECT id AS record_id, source_url, license, 'Unknown, ' || source_url || ' (' || license || ')' AS attribution_text
  FROM d WHERE id = '123'
""")
def attribution_lookup(spark, folder):
    from corpusloom.operators.govern import attributions

    docs = inputs.documents(spark, folder).withColumn("author", F.lit(None).cast("string"))
    rows = attributions(docs, "id").where(F.col("record_id") == "123")
    return rows.select("record_id", "source_url", "license", "attribution_text")


@query("stories_by_domain", f"""
  WITH i AS ({ITEMS})
  SELECT regexp_extract(url, 'https?://([^/]+)', 1) AS domain, count(*) AS count
  FROM i WHERE url IS NOT NULL GROUP BY 1 ORDER BY count DESC, domain LIMIT 10
""")
def stories_by_domain(spark, folder):
    return stats.stories_by_domain(inputs.items(spark, folder), domain("url"))


@query("page_domains", """
  SELECT regexp_extract(url, 'https?://([^/]+)', 1) AS domain, count(*) AS count
  FROM pages WHERE url IS NOT NULL GROUP BY 1 ORDER BY count DESC, domain LIMIT 10
""")
def page_domains(spark, folder):
    return stats.stories_by_domain(table(spark, folder, "pages"), domain("url"))


@query("top_scored", f"""
  WITH i AS ({ITEMS})
  SELECT id, title, score, "by", url FROM i WHERE type = 'story' ORDER BY score DESC, id LIMIT 10
""")
def top_scored(spark, folder):
    stories = inputs.items(spark, folder).where(F.col("type") == "story")
    return stories.orderBy(F.col("score").desc(), "id").limit(10).select("id", "title", "score", "by", "url")


@query("longest_docs", f"""
  WITH d AS ({D})
  SELECT id, source_url, length(content) AS content_length, license
  FROM d WHERE license = 'MIT' ORDER BY content_length DESC, id LIMIT 10
""")
def longest_docs(spark, folder):
    docs = inputs.documents(spark, folder, spread_rows=False).where(F.col("license") == "MIT")
    sized = docs.select(
        "id", "source_url", F.length("content").cast("long").alias("content_length"), F.lit("MIT").alias("license")
    )
    return sized.orderBy(F.col("content_length").desc(), "id").limit(10)


@query("recent_rows", f"""
  WITH i AS ({ITEMS})
  SELECT id, type, title, score, "by", ts FROM i WHERE title IS NOT NULL ORDER BY ts DESC, id LIMIT 5
""")
def recent_rows(spark, folder):
    rows = inputs.items(spark, folder).where(F.col("title").isNotNull())
    return rows.orderBy(F.col("ts").desc(), "id").limit(5).select("id", "type", "title", "score", "by", "ts")


@query("item_time", f"""
  WITH i AS ({ITEMS})
  SELECT id, time, CASE WHEN time <> 0 THEN make_timestamp(time * 1000000) END AS time_parsed, score FROM i
""")
def item_time(spark, folder):
    """Items written as API JSON and parsed again with the declared schema."""
    from corpusloom.schemas import RAW_ITEM

    made = inputs.items(spark, folder).select("id", "type", "by", "time", "title", "url", "score")
    parsed = made.select(F.from_json(F.to_json(F.struct("*")), RAW_ITEM).alias("i")).select("i.*")
    rows = upsert.item_rows(parsed, F.lit("top"), F.lit(None).cast("timestamp_ntz"))
    return rows.select("id", "time", "time_parsed", "score")


@query("story_type_map", """
  SELECT event_type, CASE event_type WHEN 'top' THEN 'topstories' WHEN 'new' THEN 'newstories' WHEN 'best' THEN 'beststories'
         WHEN 'ask' THEN 'askstories' WHEN 'show' THEN 'showstories' WHEN 'job' THEN 'jobstories'
         ELSE 'topstories' END AS endpoint, count(*) AS n
  FROM (SELECT CASE event_type WHEN 'view' THEN 'new' WHEN 'click' THEN 'ask' WHEN 'purchase' THEN 'job'
               ELSE event_type END AS event_type FROM events)
  GROUP BY 1, 2
""")
def story_type_map(spark, folder):
    names = F.when(F.col("event_type") == "view", "new").when(F.col("event_type") == "click", "ask") \
        .when(F.col("event_type") == "purchase", "job").otherwise(F.col("event_type"))
    events = table(spark, folder, "events").select(names.alias("event_type"))
    counted = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("event_type", upsert.story_endpoint(F.col("event_type")).alias("endpoint"), "n")


@query("json_metadata", """
  SELECT (props->>'k')::INTEGER AS k, count(*) AS n, max(event_id) AS last_event
  FROM events WHERE props->>'k' IS NOT NULL GROUP BY 1
""")
def json_metadata(spark, folder):
    events = table(spark, folder, "events").select("event_id", json_text("props", "k").cast("int").alias("k"))
    return events.where(F.col("k").isNotNull()).groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_event")
    )


# --- aggregates ---------------------------------------------------------------------------------------------------

@query("corpus_stats", """
  SELECT count(*) AS total, count(DISTINCT conv_id) AS threads, count(DISTINCT role) AS unique_authors,
         avg(length(text))::INTEGER AS avg_content_length, min(turn) AS earliest, max(turn) AS latest
  FROM conversations
""")
def corpus_stats(spark, folder):
    return stats.corpus_stats(table(spark, folder, "conversations"), "conv_id", "role", "text", "turn")


@query("metadata_sidecar", f"""
  WITH d AS ({D})
  SELECT 'manuals' AS dataset_name, 'v2025.3.2' AS version, count(*) AS record_count, 'crawl' AS source,
         'mixed' AS license
  FROM d WHERE content IS NOT NULL AND length(content) > 100
""")
def metadata_sidecar(spark, folder):
    docs = inputs.documents(spark, folder).where(F.col("content").isNotNull() & (F.length("content") > 100))
    return stats.metadata_sidecar(docs, "manuals", "v2025.3.2", "crawl", "mixed").drop("created_at")


@query("storage_estimate", """
  SELECT lang AS dataset, count(DISTINCT d.doc_id) AS documents, count(vec_id) AS chunks,
         coalesce(sum(len(embedding) * 4), 0)::BIGINT AS embedding_bytes
  FROM documents d LEFT JOIN embeddings e ON d.doc_id = e.vec_id GROUP BY 1
""")
def storage_estimate(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", F.col("lang").alias("dataset"))
    vectors = table(spark, folder, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    return stats.storage_of_documents(docs, vectors)


@query("cost_model", """
  SELECT lang AS dataset,
         round(sum(octet_length(encode(text)) / 1e9 * 0.023 + n_chars / 1e9 * 0.09 + n_chars / 4e3 * 0.0001
                   + 10 * 0.000002), 9) AS monthly_cost
  FROM documents GROUP BY 1
""")
def cost_model(spark, folder):
    """Stored bytes, characters sent and embedded, and ten searches per document, priced per language."""
    usage = table(spark, folder, "documents").select(
        F.col("lang").alias("dataset"), (F.octet_length("text") / 1e9).alias("storage_gb"),
        (F.col("n_chars") / 1e9).alias("egress_gb"), (F.col("n_chars") / 4e3).alias("embedding_ktokens"),
        F.lit(10).alias("search_calls"),
    )
    cost = stats.monthly_cost(usage, ["dataset"])
    return cost.select("dataset", F.round("monthly_cost", 9).alias("monthly_cost"))


@query("license_mix", f"""
  WITH d AS ({D}) SELECT source, license, count(*) AS documents FROM d GROUP BY 1, 2
""")
def license_mix(spark, folder):
    return stats.license_mix(inputs.documents(spark, folder), ["source"])


# --- deduplication and upsert -------------------------------------------------------------------------------------

@query("dedup_latest", """
  SELECT DISTINCT ON (user_id) event_id, ts, user_id, event_type, value, props
  FROM events ORDER BY user_id, ts DESC, event_id DESC
""")
def dedup_latest(spark, folder):
    return clean.dedup_latest(table(spark, folder, "events"), key="user_id", order="ts", tie="event_id")


@query("dedup_exact", """
  SELECT min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang, arg_min(source, doc_id) AS source, text,
         arg_min(n_chars, doc_id) AS n_chars, count(*) AS copies
  FROM documents GROUP BY text
""")
def dedup_exact(spark, folder):
    return clean.dedup_exact(table(spark, folder, "documents"))


@query("upsert_items", """
  WITH target AS (SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS price, o_orderdate AS crawled_at
                  FROM orders),
       newest AS (SELECT DISTINCT ON (l_orderkey + l_linenumber - 1) l_orderkey + l_linenumber - 1 AS id,
                         l_linestatus AS status, l_extendedprice AS price
                  FROM lineitem ORDER BY l_orderkey + l_linenumber - 1, l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
                                         l_linenumber DESC)
  SELECT coalesce(t.id, n.id) AS id, CASE WHEN n.id IS NOT NULL THEN n.status ELSE t.status END AS status,
         CASE WHEN n.id IS NOT NULL THEN n.price ELSE t.price END AS price,
         CASE WHEN t.id IS NOT NULL THEN t.crawled_at ELSE TIMESTAMP '2024-12-31 00:00:00' END AS crawled_at
  FROM target t FULL OUTER JOIN newest n ON t.id = n.id
""")
def upsert_items(spark, folder):
    """Lines as updates of orders: several updates per key, new keys, and a column that updates do not list."""
    target = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"),
        F.col("o_orderdate").alias("crawled_at"),
    )
    updates = table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") + F.col("l_linenumber") - 1).alias("id"), F.col("l_linestatus").alias("status"),
        F.col("l_extendedprice").alias("price"), "l_shipdate", "l_partkey", "l_suppkey", "l_linenumber",
    )
    default = {"crawled_at": F.lit("2024-12-31 00:00:00").cast("timestamp_ntz")}
    return upsert.upsert(target, updates, "id", ["l_shipdate", "l_partkey", "l_suppkey", "l_linenumber"], default)


@query("insert_defaults", """
  SELECT conv_id || '-' || turn AS id, text AS content, coalesce(nullif(role, 'user'), 'general') AS list_name,
         TIMESTAMP '2024-12-31 00:00:00' AS crawled_at
  FROM conversations
""")
def insert_defaults(spark, folder):
    rows = table(spark, folder, "conversations").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        F.col("text").alias("content"), F.nullif("role", F.lit("user")).alias("list_name"),
    )
    crawled = F.lit("2024-12-31 00:00:00").cast("timestamp_ntz")
    return upsert.with_defaults(rows, {"list_name": F.lit("general"), "crawled_at": crawled})


@query("changed_docs", """
  SELECT d.doc_id, d.text, md5(d.text) AS content_md5
  FROM documents d
  WHERE NOT EXISTS (SELECT 1 FROM documents s WHERE s.doc_id = d.doc_id
                    AND md5(CASE WHEN s.lang = 'en' THEN s.text ELSE s.text || '.' END) = md5(d.text))
""")
def changed_docs(spark, folder):
    """Against an earlier build in which every document that is not English read differently."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    earlier = F.when(F.col("lang") == "en", F.col("text")).otherwise(F.concat("text", F.lit(".")))
    seen = docs.select("doc_id", F.md5(earlier).alias("content_md5"))
    return upsert.changed_documents(docs.drop("lang"), seen, "doc_id", "text").select("doc_id", "text", "content_md5")


# --- item trees ---------------------------------------------------------------------------------------------------

@query("item_children", """
  SELECT p.o_orderkey AS parent_id, l.l_linenumber - 1 AS position, p.o_orderkey * 10 + l.l_linenumber AS child_id,
         l.l_quantity AS score, l.l_returnflag AS type
  FROM orders p JOIN lineitem l ON p.o_orderkey = l.l_orderkey
  WHERE l.l_linenumber BETWEEN 1 AND 7
""")
def item_children(spark, folder):
    """Orders as parents that list their lines by id; every parent lists seven ids, of which some may not exist."""
    kids = F.transform(F.sequence(F.lit(1), F.lit(7)), lambda n: F.col("id") * 10 + n)
    parents = table(spark, folder, "orders").select(
        (F.col("o_orderkey")).alias("id"), F.lit(None).cast("double").alias("score"),
        F.lit(None).cast("string").alias("type"),
    ).withColumn("kids", kids)
    children = table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_quantity").alias("score"),
        F.col("l_returnflag").alias("type"), F.lit(None).cast("array<bigint>").alias("kids"),
    )
    everything = parents.withColumn("is_child", F.lit(False)).unionByName(children.withColumn("is_child", F.lit(True)))
    found = graph.item_children(everything).where("is_child")
    return found.select("parent_id", "position", "child_id", "score", "type")


@query("item_parents", """
  SELECT c.event_id AS id, c.parent, p.ts AS parent_ts, p.value AS parent_value
  FROM (SELECT event_id, value, ts, min(event_id) OVER (PARTITION BY event_type) AS parent FROM events) c
  JOIN events p ON p.event_id = c.parent WHERE c.event_id <> c.parent
""")
def item_parents(spark, folder):
    """Every event replies to the first event of its type, so a handful of parents own all rows."""
    events = table(spark, folder, "events").select("event_id", "event_type", "ts", "value")
    roots = events.groupBy("event_type").agg(F.min("event_id").alias("parent"))
    items = events.join(roots, "event_type").select(
        F.col("event_id").alias("id"), F.nullif("parent", "event_id").alias("parent"), "ts", "value"
    )
    return graph.with_parent(items, ["ts", "value"]).select("id", "parent", "parent_ts", "parent_value")


@query("thread_depths", """
  SELECT conv_id * 100000 + turn AS id, conv_id * 100000 + min(turn) OVER (PARTITION BY conv_id) AS root,
         (turn - min(turn) OVER (PARTITION BY conv_id))::INTEGER AS depth
  FROM conversations
""")
def thread_depths(spark, folder):
    """Each turn of a conversation replies to the one before; every round doubles the distance looked upwards."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn")
    items = turns.select(
        (F.col("conv_id") * 100000 + F.col("turn")).alias("id"),
        F.when(F.col("turn") > 0, F.col("conv_id") * 100000 + F.col("turn") - 1).alias("parent"),
    )
    return graph.item_depths(items)


# Every message answers the turn before it; some are not stored, and some name their parent only in In-Reply-To.
_MAIL_MISSING = "(conv_id * 7 + turn) % 5 = 2"


@query("message_threads", f"""
  WITH RECURSIVE m AS (
    SELECT conv_id AS c, turn AS t, min(turn) OVER (PARTITION BY conv_id) AS t0, {_MAIL_MISSING} AS missing
    FROM (SELECT DISTINCT conv_id, turn FROM conversations)),
  stored AS (SELECT * FROM m WHERE NOT missing),
  named AS (
    SELECT DISTINCT m.c, m.t, m.t > m.t0 AND EXISTS (SELECT 1 FROM stored s WHERE s.c = m.c AND s.t > m.t AND s.t % 3 <> 0) AS chained
    FROM m JOIN stored s ON s.c = m.c AND (s.t = m.t + 1 OR (s.t > m.t AND s.t % 3 <> 0)) WHERE m.missing),
  nodes AS (
    SELECT c, t, CASE WHEN t > t0 THEN t - 1 END AS p, TRUE AS here FROM stored
    UNION ALL SELECT c, t, CASE WHEN chained THEN t - 1 END, FALSE FROM named),
  up AS (
    SELECT c, t AS root, t, 0 AS depth FROM nodes WHERE p IS NULL
    UNION ALL SELECT n.c, u.root, n.t, u.depth + 1 FROM nodes n JOIN up u ON n.c = u.c AND n.p = u.t)
  SELECT 'c' || n.c || '.' || n.t || '@list' AS message_id, 'c' || n.c || '.' || n.p || '@list' AS parent_id, q.here AS parent_stored,
         'c' || n.c || '.' || u.root || '@list' AS root_id, u.depth
  FROM nodes n JOIN up u ON n.c = u.c AND n.t = u.t LEFT JOIN nodes q ON q.c = n.c AND q.t = n.p WHERE n.here
""")
def message_threads(spark, folder):
    """Threads from reply headers, with messages missing in between."""
    from corpusloom.operators.threads import message_threads as threads

    turns = table(spark, folder, "conversations").select("conv_id", "turn").distinct()
    first = turns.groupBy("conv_id").agg(F.min("turn").alias("t0"))
    turns = turns.join(first, "conv_id").where(f"NOT ({_MAIL_MISSING})")
    address = lambda t: F.concat(F.lit("<c"), F.col("conv_id").cast("string"), F.lit("."), t.cast("string"), F.lit("@list>"))
    later = F.col("turn") > F.col("t0")
    earlier = F.transform(F.sequence("t0", F.col("turn") - 1), address)
    return threads(turns.select(
        F.regexp_extract(address(F.col("turn")), "<(.*)>", 1).alias("message_id"),
        F.when(later, address(F.col("turn") - 1)).alias("in_reply_to"),
        F.when(later & (F.col("turn") % 3 != 0), F.array_join(earlier, "\n ")).alias("references"),
    ))
