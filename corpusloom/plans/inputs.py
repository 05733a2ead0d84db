"""The test tables shaped like the tables of the data model, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.operators.clean import crawl_rows_from_pages
from corpusloom.operators.govern import detect_license
from corpusloom.plans.catalog import table, wide_table
from corpusloom.session import spread


def raw_crawl(spark: SparkSession, folder: str) -> DataFrame:
    """Stored pages as crawl output."""
    metadata = (
        F.when(F.col("url").contains("/en/"), F.lit('{"license":"Apache-2.0","author":"Feed"}'))
        .when(F.col("url").contains("/fr/"), F.lit('{"license":null}'))
        .otherwise(F.lit("{}"))
    )
    start = F.lit("2024-12-01 00:00:00").cast("timestamp_ntz")
    crawled = start + F.make_dt_interval(secs=F.col("page_id").cast("decimal(18,6)"))
    return crawl_rows_from_pages(wide_table(spark, folder, "pages", "page_id", "url", "html"), crawled, metadata)


RAW_CRAWL_SQL = """
  SELECT url, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title, html AS content,
         CASE WHEN contains(url, '/en/') THEN '{"license":"Apache-2.0","author":"Feed"}'
              WHEN contains(url, '/fr/') THEN '{"license":null}' ELSE '{}' END AS metadata,
         TIMESTAMP '2024-12-01 00:00:00' + to_seconds(page_id) AS crawled_at
  FROM pages
"""

# The newest crawl row per address with at least some text, without tags; what the metadata does not say has a default.
CLEANED_SQL = f"""
  SELECT md5(url) AS id, url, r.title AS title, regexp_replace(r.content, '<[^>]+>', '', 'g') AS content, r.metadata AS metadata,
         ifnull(json_extract_string(r.metadata, '$.license'), 'MIT') AS license,
         ifnull(json_extract_string(r.metadata, '$.author'), 'Unknown') AS author
  FROM (SELECT url, arg_max(struct_pack(title, content, metadata), crawled_at) AS r FROM ({RAW_CRAWL_SQL})
        WHERE length(content) > 50 GROUP BY url)
"""


def documents(spark: SparkSession, folder: str, spread_rows: bool = True) -> DataFrame:
    """The document table: string id, address, content, license found in the text (unknown when none), language."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    if spread_rows:
        docs = spread(docs, "doc_id")
    return docs.select(
        F.col("doc_id").cast("string").alias("id"),
        F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("source_url"),
        F.col("text").alias("content"),
        F.coalesce(detect_license("text"), F.lit("unknown")).alias("license"),
        "lang", "source",
    )


# Licenses as SQL sees them, by plain search in the lower-cased text.
_L = "lower(text)"
LICENSE_SQL = f"""
  CASE WHEN contains(replace({_L}, '-', ' '), 'cc by nc') THEN 'CC-BY-NC-4.0'
       WHEN contains(replace({_L}, '-', ' '), 'cc by sa') THEN 'CC-BY-SA-4.0'
       WHEN contains(replace({_L}, '-', ' '), 'cc by') THEN 'CC-BY-4.0'
       WHEN contains({_L}, 'cc0') OR contains({_L}, 'creative commons zero') THEN 'CC0-1.0'
       WHEN contains({_L}, 'gnu affero general public license') OR contains({_L}, 'agpl') THEN 'AGPL-3.0'
       WHEN contains({_L}, 'gnu lesser general public license') OR contains({_L}, 'lgpl') THEN 'LGPL-3.0'
       WHEN contains({_L}, 'gnu general public license') OR contains({_L}, 'gpl') THEN 'GPL-3.0'
       WHEN contains({_L}, 'mozilla public license') OR contains(replace({_L}, '-', ' '), 'mpl 2.0') THEN 'MPL-2.0'
       WHEN contains({_L}, 'bsd license') OR contains(replace({_L}, '-', ' '), 'bsd 2 clause')
         OR contains(replace({_L}, '-', ' '), 'bsd 3 clause') THEN 'BSD-3-Clause'
       WHEN contains({_L}, 'apache license') OR contains(replace({_L}, '-', ' '), 'apache 2.0') THEN 'Apache-2.0'
       WHEN contains({_L}, 'mit license') THEN 'MIT'
       WHEN contains({_L}, 'open database license') OR contains({_L}, 'odbl') THEN 'ODbL-1.0'
       WHEN contains({_L}, 'all rights reserved') THEN 'LicenseRef-Reserved' END
"""

DOCUMENTS_SQL = f"""
  SELECT doc_id::VARCHAR AS id, source || '/' || doc_id AS source_url, text AS content,
         coalesce({LICENSE_SQL}, 'unknown') AS license, lang, source
  FROM documents
"""


def version_of_source(column: str = "source"):
    """Version label of a source: ``src7`` was published in ``v2024.7.1``."""
    return F.concat(F.lit("v2024."), F.regexp_extract(column, "([0-9]+)", 1), F.lit(".1"))


VERSION_OF_SOURCE_SQL = "'v2024.' || regexp_extract(source, '([0-9]+)', 1) || '.1'"


def manifests(spark: SparkSession, folder: str) -> DataFrame:
    """One manifest row per event type and day: daily builds of a dataset."""
    day = F.concat_ws(".", F.lit("v2024"), F.month("ts").cast("string"), F.dayofmonth("ts").cast("string"))
    events = table(spark, folder, "events").select(F.col("event_type").alias("dataset"), day.alias("version"), "ts")
    return events.groupBy("dataset", "version").agg(
        F.count(F.lit(1)).alias("row_count"), F.max("ts").alias("created_at")
    )


MANIFESTS_SQL = """
  SELECT event_type AS dataset, 'v2024.' || month(ts) || '.' || day(ts) AS version,
         count(*) AS row_count, max(ts) AS created_at
  FROM events GROUP BY 1, 2
"""

# Numeric order of a version in SQL.
VERSION_KEY_SQL = "list_transform(regexp_extract_all(version, '\\d+'), lambda x: x::BIGINT)"


def items(spark: SparkSession, folder: str) -> DataFrame:
    """Events as item records: stories and comments with score, time, address and parent.

    Every event of a user but the first is a reply to that user's first event.
    """
    events = table(spark, folder, "events")
    kind = F.when(F.col("event_type") == "view", "story").otherwise(F.lit("comment"))
    return events.select(
        F.col("event_id").alias("id"), kind.alias("type"), F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("by"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("time"),
        F.concat_ws(" ", "event_type", F.col("event_id").cast("string")).alias("title"),
        F.when(F.col("event_type") != "error", F.concat(F.lit("https://"), F.col("event_type"), F.lit(".example.org/"),
               F.col("event_id").cast("string"))).alias("url"),
        F.floor("value").cast("int").alias("score"), "user_id", "ts",
    )


ITEMS_SQL = """
  SELECT event_id AS id, CASE WHEN event_type = 'view' THEN 'story' ELSE 'comment' END AS type,
         'user' || user_id AS "by", floor(epoch(ts))::BIGINT AS time, event_type || ' ' || event_id AS title,
         CASE WHEN event_type <> 'error' THEN 'https://' || event_type || '.example.org/' || event_id END AS url,
         floor(value)::INTEGER AS score, user_id, ts
  FROM events
"""


def license_of_label():
    return F.when(F.col("label") < 4, "MIT").when(F.col("label") < 7, "Apache-2.0").otherwise("CC-BY-4.0")


LICENSE_OF_LABEL_SQL = "CASE WHEN label < 4 THEN 'MIT' WHEN label < 7 THEN 'Apache-2.0' ELSE 'CC-BY-4.0' END"


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The embeddings table with a license per chunk."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("chunk_id"), "embedding", "label", license_of_label().alias("license")
    )
