"""Chunking, page and message extraction, links, dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions.dates import message_time
from corpusloom.functions.text import commit_refs as find_commit_refs, is_patch
from corpusloom.functions.urls import canonical_url
from corpusloom.operators import chunk, clean, graph, html, stats
from corpusloom.plans import inputs
from corpusloom.plans.catalog import query, table, wide_table

D = inputs.DOCUMENTS_SQL

# --- chunkers -----------------------------------------------------------------------------------------------------

GRID_SQL = f"""
  c AS (SELECT d.*, length(content) AS n, 0 AS i FROM ({D}) d
        UNION ALL SELECT c.* EXCLUDE (i), i + 1 FROM c WHERE (i + 1) * 800 < n)
"""


@query("chunk_grid", f"""
  WITH RECURSIVE {GRID_SQL}
  SELECT id || '_' || i AS chunk_id, id AS doc_id, source_url, license, i::INTEGER AS chunk_index,
         substr(content, i * 800 + 1, 1000) AS chunk_content,
         length(substr(content, i * 800 + 1, 1000))::INTEGER AS chunk_length
  FROM c WHERE length(substr(content, i * 800 + 1, 1000)) > 50
""")
def chunk_grid(spark, folder):
    return chunk.chunk_documents(
        inputs.documents(spark, folder), "grid", 1000, 200, 50, keep=("source_url", "license")
    ).drop("start_char", "end_char")


@query("chunk_udtf_rule", """
  WITH RECURSIVE c AS (
    SELECT doc_id, text, length(text) AS n, 0 AS i FROM documents WHERE length(text) > 0
    UNION ALL SELECT doc_id, text, n, i + 1 FROM c WHERE i * 240 + 300 < n)
  SELECT doc_id::VARCHAR AS doc_id, i::INTEGER AS chunk_index, substr(text, i * 240 + 1, 300) AS chunk_content FROM c
""")
def chunk_udtf_rule(spark, folder):
    chunks = chunk.chunk_documents(
        wide_table(spark, folder, "documents", "doc_id", "text"), "window", 300, 60, doc_id="doc_id", text="text"
    )
    return chunks.select("doc_id", "chunk_index", "chunk_content")


@query("chunk_udtf_lateral", """
  WITH RECURSIVE c AS (
    SELECT doc_id, text, length(text) AS n, 0 AS i FROM documents WHERE length(text) > 0
    UNION ALL SELECT doc_id, text, n, i + 1 FROM c WHERE i * 800 + 1000 < n)
  SELECT doc_id, i::INTEGER AS chunk_index, substr(text, i * 800 + 1, 1000) AS chunk_content FROM c
""")
def chunk_udtf_lateral(spark, folder):
    chunk.register_chunk_text(spark)
    docs = wide_table(spark, folder, "documents", "doc_id", "text")
    return spark.sql(
        "SELECT d.doc_id, c.chunk_index, c.chunk_content FROM {docs} d, LATERAL chunk_text(d.text, 1000, 200) c",
        docs=docs,
    )


_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160)"


def fixed_sql(size: int, overlap: int, least: int) -> str:
    def end(s: str) -> str:
        gap = f"length(regexp_extract(substr(t, {s} + 1, {size}), '(?s)^(.*) ', 1))"
        return f"{s} + CASE WHEN {s} + {size} < n AND {gap} > {size // 2} THEN {gap} ELSE least({size}, n - {s}) END"

    return f"""
      WITH RECURSIVE body AS (SELECT doc_id, trim(text, {_SPACE}) AS t FROM documents),
      w AS (SELECT doc_id, t, length(t) AS n, 0::BIGINT AS s FROM body WHERE length(t) >= {least}),
      r AS (SELECT doc_id, t, n, s, {end('s')} AS e FROM w
            UNION ALL
            SELECT doc_id, t, n, s, {end('s')} AS e
            FROM (SELECT doc_id, t, n, greatest(e - {overlap}, s + 1) AS s FROM r WHERE e < n) x
            WHERE s < n - {least}),
      p AS (SELECT doc_id, s, e, trim(substr(t, s + 1, e - s), {_SPACE}) AS piece FROM r),
      k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS i FROM p WHERE length(piece) >= {least})
      SELECT doc_id || '_' || i AS chunk_id, doc_id::VARCHAR AS doc_id, i::INTEGER AS chunk_index,
             piece AS chunk_content, length(piece)::INTEGER AS chunk_length, s::INTEGER AS start_char,
             e::INTEGER AS end_char
      FROM k
    """


def sentence_sql(size: int, overlap: int, least: int) -> str:
    def joined(first: str, last: str) -> str:
        return f"(list_sum(w[{first}:{last}]) + ({last}) - ({first}))"

    return f"""
      WITH RECURSIVE q AS (
        SELECT doc_id, string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) AS q FROM documents),
      l AS (SELECT doc_id, q, len(q) AS n, list_transform(q, lambda x: length(x)) AS w FROM q),
      r AS (
        SELECT doc_id, 1::BIGINT AS k, 1::BIGINT AS a, (w[1] + 1)::BIGINT AS run, 0::BIGINT AS st,
               0::BIGINT AS fa, 0::BIGINT AS fb, 0::BIGINT AS fs FROM l
        UNION ALL
        SELECT doc_id, k + 1, CASE WHEN flush THEN k + 1 - m ELSE a END,
               CASE WHEN NOT flush THEN run WHEN m = 0 THEN 0 ELSE {joined('k-m+1', 'k')} END + w[k + 1] + 1,
               CASE WHEN flush THEN st + {joined('a', 'k')} - CASE WHEN m = 0 THEN 0 ELSE {joined('k-m+1', 'k')} END
                    ELSE st END,
               CASE WHEN flush THEN a ELSE 0 END, CASE WHEN flush THEN k ELSE 0 END, st
        FROM (SELECT r.*, w, run + w[k + 1] > {size} AS flush,
                     coalesce(list_max(list_filter(range(1, k - a + 2), lambda j:
                       list_sum(w[k-j+1:k]) + j - 1 - CASE WHEN j > 1 THEN 1 ELSE 0 END < {overlap})), 0) AS m
              FROM r JOIN l USING (doc_id) WHERE k < n)),
      e AS (
        SELECT doc_id, fa AS a, fb AS b, fs AS st FROM r WHERE fa > 0
        UNION ALL
        SELECT doc_id, a, k, st FROM r JOIN l USING (doc_id) WHERE k = n AND {joined('a', 'k')} >= {least}),
      t AS (SELECT doc_id, b, st, array_to_string(q[a:b], ' ') AS piece FROM e JOIN l USING (doc_id)),
      k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY b) - 1 AS i FROM t)
      SELECT doc_id || '_' || i AS chunk_id, doc_id::VARCHAR AS doc_id, i::INTEGER AS chunk_index,
             piece AS chunk_content, length(piece)::INTEGER AS chunk_length, st::INTEGER AS start_char,
             (st + length(piece))::INTEGER AS end_char
      FROM k
    """


def _chunks(spark, folder, strategy, size, overlap):
    docs = wide_table(spark, folder, "documents", "doc_id", "text")
    return chunk.chunk_documents(docs, strategy, size, overlap, 50, doc_id="doc_id", text="text")


@query("chunk_word", fixed_sql(1000, 200, 50))
def chunk_word(spark, folder):
    return _chunks(spark, folder, "fixed", 1000, 200)


@query("chunk_word_short_overlap", fixed_sql(1000, 50, 50))
def chunk_word_short_overlap(spark, folder):
    return _chunks(spark, folder, "fixed", 1000, 50)


@query("chunk_word_small", fixed_sql(300, 60, 50))
def chunk_word_small(spark, folder):
    return _chunks(spark, folder, "fixed", 300, 60)


@query("chunk_sentence", sentence_sql(1000, 200, 50))
def chunk_sentence(spark, folder):
    return _chunks(spark, folder, "sentence", 1000, 200)


@query("chunk_sentence_small", sentence_sql(300, 80, 50))
def chunk_sentence_small(spark, folder):
    return _chunks(spark, folder, "sentence", 300, 80)


def digest_sql(text: str, source: str, count: str) -> str:
    words = ", ".join(
        f"sum(('0x' || substr(md5({text}), {4 * i + 1}, 4))::BIGINT)::VARCHAR" for i in range(8)
    )
    return f"SELECT md5(concat_ws(':', {count}, {words})) FROM {source}"


@query("content_checksum", f"SELECT count(text) AS row_count, ({digest_sql('text', 'documents', 'count(text)')}) "
                           "AS content_checksum FROM documents")
def content_checksum(spark, folder):
    return stats.content_checksum(table(spark, folder, "documents"), "text")


_KEPT = "(SELECT substr(content, i * 800 + 1, 1000) AS piece FROM c WHERE length(substr(content, i * 800 + 1, 1000)) > 50)"


@query("manifest", f"""
  WITH RECURSIVE {GRID_SQL}
  SELECT 'manuals' AS dataset, 'v2025.3.2' AS version, (SELECT count(*) FROM documents) AS document_count,
         (SELECT count(*) FROM {_KEPT}) AS chunk_count, 1000 AS chunk_size, 200 AS chunk_overlap,
         ({digest_sql('piece', _KEPT, 'count(*)')}) AS content_checksum
""")
def manifest(spark, folder):
    docs = inputs.documents(spark, folder)
    return stats.grid_manifest(docs, "manuals", "v2025.3.2").drop("created_at")


@query("build_summary", f"""
  WITH RECURSIVE cleaned AS ({inputs.CLEANED_SQL}),
  c AS (SELECT content, length(content) AS n, 0 AS i FROM cleaned
        UNION ALL SELECT content, n, i + 1 FROM c WHERE (i + 1) * 800 < n)
  SELECT 'complete' AS status, (SELECT count(*) FROM cleaned) AS documents,
         (SELECT count(*) FROM {_KEPT}) AS chunks, 'manuals' AS dataset, 'v2025.3.2' AS version
""")
def build_summary(spark, folder):
    """Crawl, clean, deduplicate, chunk and summarise stored pages."""
    docs = clean.clean_documents(inputs.raw_crawl(spark, folder), min_len=50)
    docs = clean.dedup_latest(docs, key="source_url", tie="id")
    return stats.build_summary(stats.grid_manifest(docs, "manuals", "v2025.3.2"))


@query("chunks_by_version", f"""
  WITH RECURSIVE {GRID_SQL}
  SELECT {inputs.VERSION_OF_SOURCE_SQL} AS version, count(*) AS chunk_count, round(avg(length(piece)), 6) AS avg_chunk_size
  FROM (SELECT source, substr(content, i * 800 + 1, 1000) AS piece FROM c) WHERE length(piece) > 50
  GROUP BY 1
""")
def chunks_by_version(spark, folder):
    docs = inputs.documents(spark, folder).withColumn("version", inputs.version_of_source())
    chunks = chunk.chunk_documents(docs, "grid", keep=("version",))
    return stats.chunks_by_version(chunks).withColumn("avg_chunk_size", F.round("avg_chunk_size", 6))


# --- pages --------------------------------------------------------------------------------------------------------

def _decoded(expression: str) -> str:
    for entity, char in (("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"'), ("&amp;", "&")):
        expression = f"replace({expression}, '{entity}', '{char}')"
    return expression


PAGE_EXTRACT_SQL = f"""
  SELECT page_id, url, trim({_decoded("regexp_extract(html, '(?is)<title>(.*?)</title>', 1)")}, {_SPACE}) AS title,
         array_to_string(list_filter(list_transform(
           string_split(regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '(?s)<[^>]*>', chr(1), 'g'),
                        chr(1)), lambda x: trim({_decoded('x')}, {_SPACE})), lambda x: x <> ''), chr(10)) AS content
  FROM pages
"""


@query("page_extract", PAGE_EXTRACT_SQL)
def page_extract(spark, folder):
    return html.extract_pages(wide_table(spark, folder, "pages", "page_id", "url", "html")).select("page_id", "url", "title", "content")


@query("page_titles", "SELECT page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title FROM pages")
def page_titles(spark, folder):
    return table(spark, folder, "pages").select("page_id", clean.page_title("html").alias("title"))


# Start tags of the anchors in these pages, whose attribute values are all quoted, and the text up to their end tags.
_ANCHOR = """<[aA]\\s+(?:[^>]*\\s)?[hH][rR][eE][fF]="([^"]*)"[^>]*>((?:[^<]|<[^/]|</[^aA])*)"""
_SITE = "regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*')"
LINKS_SQL = f"""
  SELECT url AS page_url, (j - 1)::INTEGER AS position, {_decoded('hrefs[j]')} AS href, {_SITE} || {_decoded('hrefs[j]')} AS link
  FROM (SELECT url, hrefs, unnest(range(1, len(hrefs) + 1)) AS j
        FROM (SELECT url, regexp_extract_all(html, '{_ANCHOR}', 1) AS hrefs FROM pages))
  WHERE hrefs[j] LIKE '/%' AND hrefs[j] NOT LIKE '//%'
"""


@query("page_links", LINKS_SQL)
def page_links(spark, folder):
    return html.page_links(wide_table(spark, folder, "pages", "page_id", "url", "html"), strip_regions=False)


@query("link_filter", f"SELECT * FROM ({LINKS_SQL}) WHERE regexp_matches(link, '/th[a-z]+$')")
def link_filter(spark, folder):
    return html.page_links(
        wide_table(spark, folder, "pages", "page_id", "url", "html"), strip_regions=False, where=F.col("link").rlike("/th[a-z]+$")
    )


@query("list_page_links", f"""
  SELECT page_url, position, link, label FROM (
    SELECT l.*, trim({_decoded("labels[position + 1]")}, {_SPACE}) AS label
    FROM ({LINKS_SQL}) l
    JOIN (SELECT url, regexp_extract_all(html, '{_ANCHOR}', 2) AS labels FROM pages) p ON l.page_url = p.url)
  WHERE contains(href, '/an')
""")
def list_page_links(spark, folder):
    return html.list_page_links(wide_table(spark, folder, "pages", "page_id", "url", "html"), needle="/an")


def _canonical(url: str) -> str:
    host = f"lower(regexp_extract({url}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1))"
    rest = f"regexp_replace(regexp_replace({url}, '(?s)#.*$', ''), '^([A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*', '')"
    return f"{host} || {rest}"


@query("url_canonical", f"SELECT page_id, url, {_canonical('url')} AS canonical FROM pages")
def url_canonical(spark, folder):
    return table(spark, folder, "pages").select("page_id", "url", canonical_url("url").alias("canonical"))


@query("frontier_step", f"""
  SELECT canonical, min(link) AS link, count(*) AS links
  FROM (SELECT {_canonical('link')} AS canonical, link FROM ({LINKS_SQL}))
  WHERE canonical NOT IN (SELECT {_canonical('url')} FROM pages) GROUP BY 1
""")
def frontier_step(spark, folder):
    pages = table(spark, folder, "pages")
    return graph.frontier_step(pages, pages.select(canonical_url("url").alias("canonical")), strip_regions=False)


# A site whose pages link to one another: a page is called like the first page it links to.
_SITE_SQL = f"""
  found AS (SELECT page_id, position, {_decoded('href')} AS href
            FROM (SELECT page_id, hrefs[j] AS href, j - 1 AS position
                  FROM (SELECT page_id, hrefs, unnest(range(1, len(hrefs) + 1)) AS j
                        FROM (SELECT page_id, regexp_extract_all(html, '{_ANCHOR}', 1) AS hrefs FROM pages)))
            WHERE href LIKE '/%' AND href NOT LIKE '//%'),
  named AS (SELECT page_id, 'https://site.example' || href AS page_url FROM found WHERE position = 0),
  links AS (SELECT {_canonical('page_url')} AS source, page_url, position, 'https://site.example' || href AS link
            FROM found JOIN named USING (page_id)),
  chosen AS (SELECT source, min(page_url) AS page_url FROM links GROUP BY 1),
  edges AS (SELECT source, {_canonical('link')} AS canonical, position, link FROM links JOIN chosen USING (source, page_url)),
  seed AS (SELECT page_url AS url, row_number() OVER (ORDER BY page_url) - 1 AS n FROM (SELECT DISTINCT page_url FROM named)
           QUALIFY n < 10)
"""


@query("link_bfs", f"""
  WITH RECURSIVE {_SITE_SQL},
  walk(canonical, depth, path, url) USING KEY (canonical) AS (
    SELECT {_canonical('url')}, 0, [(n::BIGINT, {_canonical('url')})], url FROM seed
    UNION
    SELECT e.canonical, w.depth + 1, min(list_append(w.path, (e.position::BIGINT, e.canonical))),
           arg_min(e.link, (w.path, e.position::BIGINT, e.link))
    FROM walk w JOIN edges e ON e.source = w.canonical
    WHERE w.depth < 4 AND e.canonical NOT IN (SELECT r.canonical FROM recurring.walk r) GROUP BY 1, 2),
  placed AS (SELECT canonical, url, depth::INTEGER AS depth, row_number() OVER (ORDER BY depth, path) - 1 AS place FROM walk)
  SELECT * FROM placed WHERE place < 150
""")
def link_bfs(spark, folder):
    """A walk over stored pages from ten of them, at most four links deep and 150 pages long."""
    pages = wide_table(spark, folder, "pages", "page_id", "html")
    first = html.page_links(
        pages.select(F.col("page_id").cast("string").alias("url"), "html"), strip_regions=False, same_site=False,
        where=F.col("href").startswith("/") & ~F.col("href").startswith("//"),
    ).where(F.col("position") == 0)
    names = first.select(F.col("page_url").cast("long").alias("page_id"), F.concat(F.lit("https://site.example"), "href").alias("url"))
    site = pages.join(names, "page_id").select("url", "html")
    start = [row.url for row in names.select("url").distinct().orderBy("url").limit(10).collect()]
    return graph.crawl_order(site, start, 150, 4, strip_regions=False)


# --- messages -----------------------------------------------------------------------------------------------------

def _escaped(column):
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        column = F.replace(column, F.lit(char), F.lit(entity))
    return column


@query("message_extract", """
  SELECT conv_id || '-' || turn AS id, '<' || conv_id || '.' || turn || '@list>' AS message_id,
         'Re: topic ' || conv_id AS subject, role || ' & co' AS author, '2024-12-15 18:30:45' AS date, text AS content,
         'https://archive.example.org/message-id/' || conv_id || '-' || turn AS url, 'pgsql-hackers' AS list_name
  FROM conversations
""")
def message_extract(spark, folder):
    """Conversation turns rendered as archive pages, then parsed back."""
    return html.extract_messages(message_pages(spark, folder))


def message_pages(spark, folder):
    """Conversation turns as pages of a message archive: (url, html)."""
    conv, turn = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    rows = [
        ("From:", F.concat("role", F.lit(" & co"))), ("Date:", F.lit("2024-12-15 18:30:45")),
        ("Message-ID:", F.concat(F.lit("<"), conv, F.lit("."), turn, F.lit("@list>"))),
    ]
    header = F.concat(*[
        F.concat(F.lit(f"<tr><th>{name}</th> <td> "), _escaped(value), F.lit("</td></tr>")) for name, value in rows
    ])
    page = F.concat(
        F.lit("<html><head><title>Archive</title></head><body><h1> Re: topic "), conv, F.lit("</h1><table>"), header,
        F.lit("</table><p>quoted<pre>"), _escaped(F.col("text")), F.lit("</pre></body></html>"),
    )
    return wide_table(spark, folder, "conversations", "conv_id", "turn", "role", "text").select(
        F.concat(F.lit("https://archive.example.org/message-id/"), conv, F.lit("-"), turn).alias("url"),
        page.alias("html"),
    )


@query("thread_key", "SELECT conv_id, turn, md5('topic ' || conv_id) AS thread_id FROM conversations")
def thread_key(spark, folder):
    subject = F.concat(
        F.when(F.col("turn") == 0, "").when(F.col("role") == "user", "Re: RE: ").otherwise("Fwd: re: "),
        F.lit("Topic "), F.col("conv_id").cast("string"),
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", subject.alias("subject"))
    return turns.select("conv_id", "turn", html.thread_key("subject").alias("thread_id"))


@query("parse_dates", """
  SELECT o_orderkey, CASE o_orderstatus
           WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
           WHEN 'O' THEN strftime(o_orderdate, '%a, %d %b %Y %H:%M:%S') || ' +0230'
           ELSE strftime(o_orderdate, '%d %b %Y %H:%M:%S') END AS date,
         date_trunc('second', o_orderdate)
           - CASE WHEN o_orderstatus = 'O' THEN INTERVAL 150 MINUTE ELSE INTERVAL 0 MINUTE END AS date_parsed
  FROM orders
""")
def parse_dates(spark, folder):
    day = F.col("o_orderdate")
    text = (
        F.when(F.col("o_orderstatus") == "F", F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("o_orderstatus") == "O", F.concat(F.date_format(day, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0230")))
        .otherwise(F.date_format(day, "dd MMM yyyy HH:mm:ss"))
    )
    dated = table(spark, folder, "orders").select("o_orderkey", text.alias("date"))
    return dated.withColumn("date_parsed", message_time("date"))


@query("commit_refs", """
  SELECT doc_id, unnest(list_filter(regexp_extract_all(text, '[0-9A-Za-z_]+'),
                                    lambda w: regexp_matches(w, '^[0-9a-f]{7,40}$'))) AS commit_ref
  FROM documents
""")
def commit_refs(spark, folder):
    docs = wide_table(spark, folder, "documents", "doc_id", "text")
    return docs.select("doc_id", F.explode(find_commit_refs("text")).alias("commit_ref"))


@query("patch_subjects", """
  SELECT regexp_matches(p_name, '^\\s*(\\[PATCH|PATCH)') OR p_size > 25 AS is_patch, count(*) AS n
  FROM part GROUP BY 1
""")
def patch_subjects(spark, folder):
    """Part names as subjects, announced as patches above size 25."""
    subject = F.when(F.col("p_size") > 25, F.concat(F.lit("[PATCH] "), F.col("p_name"))).otherwise(F.col("p_name"))
    flagged = table(spark, folder, "part").select(is_patch(subject).alias("is_patch"))
    return flagged.groupBy("is_patch").agg(F.count(F.lit(1)).alias("n"))
