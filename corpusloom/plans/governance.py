"""Registry, licenses, attribution, personal data, takedowns, constraint checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import govern, registry
from corpusloom.plans import inputs
from corpusloom.plans.catalog import query, table, wide_table

D, M, KEY = inputs.DOCUMENTS_SQL, inputs.MANIFESTS_SQL, inputs.VERSION_KEY_SQL

# Fixed values of the license policy, as SQL.
_POLICY = """
  ('MIT', true, 'Required'), ('Apache-2.0', true, 'Required'), ('CC0-1.0', true, 'No'), ('CC-BY-4.0', true, 'Required'),
  ('CC-BY-NC-4.0', false, 'Required'), ('ODbL-1.0', true, 'Required (share-alike)')
"""


@query("list_datasets", f"WITH m AS ({M}) SELECT DISTINCT dataset FROM m")
def list_datasets(spark, folder):
    return registry.list_datasets(inputs.manifests(spark, folder))


@query("list_versions", f"WITH m AS ({M}) SELECT dataset, version FROM m ORDER BY dataset, {KEY} DESC")
def list_versions(spark, folder):
    return registry.list_versions(inputs.manifests(spark, folder))


@query("resolve_latest", f"""
  WITH m AS ({M})
  SELECT dataset AS name, arg_max(version, k) AS current_version, arg_max(row_count, k) AS record_count,
         arg_max(created_at, k) AS updated_at, count(DISTINCT version) AS versions
  FROM (SELECT *, {KEY} AS k FROM m) GROUP BY 1
""")
def resolve_latest(spark, folder):
    return registry.build_registry(inputs.manifests(spark, folder))


@query("registry_list", f"""
  WITH m AS ({M})
  SELECT '1.0.0' AS registry_version, dataset AS name, upper(dataset) AS display_name, arg_max(version, k) AS current_version,
         arg_max(row_count, k) AS record_count, 'MIT' AS license, 'feed' AS sponsor
  FROM (SELECT *, {KEY} AS k FROM m) GROUP BY dataset
""")
def registry_list(spark, folder):
    """The registry written as JSON documents and listed again."""
    rows = registry.build_registry(inputs.manifests(spark, folder))
    entry = F.struct(
        "name", F.upper("name").alias("display_name"), "current_version", "record_count", F.lit("MIT").alias("license"),
        F.lit("feed").alias("sponsor"),
    )
    documents = rows.select(F.to_json(F.struct(F.lit("1.0.0").alias("version"), F.array(entry).alias("datasets"))).alias("value"))
    return registry.registry_datasets(documents)


@query("registry_versions", f"""
  WITH m AS ({M}), l AS (SELECT dataset, arg_max(version, {KEY}) AS current FROM m GROUP BY 1)
  SELECT dataset AS name, current, version, row_count AS record_count, row_count * 4 AS chunk_count,
         'Build ' || version AS changelog, version = current AS is_current
  FROM m JOIN l USING (dataset)
""")
def registry_versions(spark, folder):
    """Metadata documents (one per version, as published) and the version history read from them."""
    manifests = inputs.manifests(spark, folder)
    current = registry.latest_versions(manifests).withColumnRenamed("version", "current")
    version = F.struct(
        "version", F.col("row_count").alias("record_count"), (F.col("row_count") * 4).alias("chunk_count"),
        F.concat(F.lit("Build "), F.col("version")).alias("changelog"),
    )
    document = F.struct(
        F.col("dataset").alias("name"), F.struct("current", F.array(version).alias("versions")).alias("versioning")
    )
    documents = manifests.join(current, "dataset").select(F.to_json(document).alias("value"))
    history = registry.version_history(registry.dataset_metadata(documents))
    return history.select("name", "current", "version", "record_count", "chunk_count", "changelog", "is_current")


@query("dataset_health", f"""
  WITH m AS ({M}), r AS (
    SELECT dataset, CASE WHEN dataset = 'error' THEN 'v2099.1.1' ELSE arg_max(version, {KEY}) END AS version FROM m GROUP BY 1),
  j AS (SELECT r.dataset, r.version, m.created_at AS last_modified,
               floor((epoch(TIMESTAMP '2024-02-06 01:00:00') - floor(epoch(m.created_at))) / 86400)::BIGINT AS age_days
        FROM r LEFT JOIN m ON r.dataset = m.dataset AND r.version = m.version)
  SELECT *, CASE WHEN age_days IS NULL THEN 'missing' WHEN age_days < 7 THEN 'healthy' ELSE 'stale' END AS status FROM j
""")
def dataset_health(spark, folder):
    """Freshness of every dataset; one of them names a version that was never built."""
    manifests = inputs.manifests(spark, folder)
    known = registry.build_registry(manifests).withColumn(
        "current_version", F.when(F.col("name") == "error", "v2099.1.1").otherwise(F.col("current_version"))
    )
    return registry.dataset_health(known, manifests, F.lit("2024-02-06 01:00:00").cast("timestamp_ntz"))


@query("license_detect", f"SELECT doc_id, {inputs.LICENSE_SQL} AS license FROM documents")
def license_detect(spark, folder):
    docs = wide_table(spark, folder, "documents", "doc_id", "text")
    return docs.select("doc_id", govern.detect_license("text").alias("license"))


@query("license_policy", f"""
  WITH p(spdx, commercial_use, attribution) AS (VALUES {_POLICY}),
  d AS (SELECT doc_id, CASE WHEN lang = 'fr' THEN 'Proprietary' ELSE coalesce({inputs.LICENSE_SQL}, 'unknown') END AS license FROM documents)
  SELECT doc_id, license, commercial_use, attribution, spdx IS NOT NULL AS known_license
  FROM d LEFT JOIN p ON license = spdx
""")
def license_policy(spark, folder):
    docs = wide_table(spark, folder, "documents", "doc_id", "text", "lang")
    named = F.when(F.col("lang") == "fr", "Proprietary").otherwise(F.coalesce(govern.detect_license("text"), F.lit("unknown")))
    return govern.license_policy(docs.select("doc_id", named.alias("license")))


@query("attribution_build", f"""
  WITH d AS (SELECT *, CASE WHEN lang <> 'en' THEN 'Writer ' || lang END AS author FROM ({D}))
  SELECT id AS record_id, source_url, coalesce(author, 'Unknown') AS author, license,
         coalesce(author, 'Unknown') || ', ' || source_url || ' (' || license || ')' AS attribution_text
  FROM d
""")
def attribution_build(spark, folder):
    author = F.when(F.col("lang") != "en", F.concat(F.lit("Writer "), F.col("lang")))
    return govern.attributions(inputs.documents(spark, folder).withColumn("author", author), "id")


# Personal data as SQL sees it.
_MAIL = r"[\w.%+-]+@[[:alnum:]][[:alnum:].-]*\.[[:alnum:]-]+"
_ADDRESS = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"
_PHONE = r"\+?\d{1,3}[. -]\(?\d{2,4}\)?[. -]\d{3,4}(?:[. -]\d{2,4})?"
SCRUB_SQL = f"""
  WITH a AS (SELECT doc_id, text, regexp_replace(text, '{_MAIL}', '[EMAIL]', 'g') AS t1 FROM documents),
  b AS (SELECT *, regexp_replace(t1, '{_ADDRESS}', '[IP]', 'g') AS t2 FROM a),
  c AS (SELECT *, regexp_replace(t2, '{_PHONE}', '[PHONE]', 'g') AS t3 FROM b)
  SELECT doc_id, len(regexp_extract_all(text, '{_MAIL}'))::INTEGER AS email_hits,
         len(regexp_extract_all(t1, '{_ADDRESS}'))::INTEGER AS ip_hits,
         len(regexp_extract_all(t2, '{_PHONE}'))::INTEGER AS phone_hits, t3 AS text
  FROM c
"""


@query("pii_scrub", SCRUB_SQL)
def pii_scrub(spark, folder):
    rows = govern.scrub_personal_data(wide_table(spark, folder, "documents", "doc_id", "text"), "text")
    return rows.select("doc_id", "email_hits", "ip_hits", "phone_hits", "text")


@query("content_filter", """
  SELECT doc_id, text FROM documents d
  WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND (toxic = 1 OR quality = 0))
""")
def content_filter(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return govern.content_filter(docs, table(spark, folder, "labels"))


@query("takedown_filter", """
  SELECT doc_id, source FROM documents
  WHERE source NOT IN (SELECT source FROM documents JOIN labels USING (doc_id)
                       WHERE toxic = 1 AND quality = 1 GROUP BY 1 HAVING count(*) >= 3)
""")
def takedown_filter(spark, folder):
    """Everything from a source with three or more complaints is taken down."""
    docs = table(spark, folder, "documents").select("doc_id", "source")
    complaints = table(spark, folder, "labels").where((F.col("toxic") == 1) & (F.col("quality") == 1))
    listed = docs.join(complaints.select("doc_id"), "doc_id").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return govern.without_takedowns(docs, listed.where(F.col("n") >= 3), "source")


@query("dq_constraints", """
  WITH l AS (SELECT l_orderkey * 10 + l_linenumber AS id, CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS flag,
                    l_shipdate AS shipped FROM lineitem)
  SELECT 'unique' AS rule, 'id' AS "column",
         (SELECT count(*) FROM (SELECT id FROM l WHERE id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) AS violations
  UNION ALL SELECT 'not_null', 'flag', (SELECT count(*) FROM l WHERE flag IS NULL)
  UNION ALL SELECT 'not_null', 'shipped', (SELECT count(*) FROM l WHERE shipped IS NULL)
""")
def dq_constraints(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.nullif("l_returnflag", F.lit("R")).alias("flag"), F.col("l_shipdate").alias("shipped"),
    )
    return govern.constraint_report(rows, "id", ["flag", "shipped"])
