"""Licenses, attribution, personal data, takedowns and constraint checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusloom.operators.skew import BROADCAST_ROWS, broadcast_if_small, join_unique

# License name, SPDX id, commercial use, attribution.
LICENSES = (
    ("MIT", "MIT", True, "Required"),
    ("Apache 2.0", "Apache-2.0", True, "Required"),
    ("Creative Commons Zero", "CC0-1.0", True, "No"),
    ("CC BY", "CC-BY-4.0", True, "Required"),
    ("CC BY-NC", "CC-BY-NC-4.0", False, "Required"),
    ("ODbL", "ODbL-1.0", True, "Required (share-alike)"),
)

RESERVED = "LicenseRef-Reserved"

# Phrase that identifies a license in running text (any case), tried in this order.
LICENSE_PHRASES = (
    ("CC[ -]BY[ -]NC", "CC-BY-NC-4.0"),
    ("CC[ -]BY[ -]SA", "CC-BY-SA-4.0"),
    ("CC[ -]BY", "CC-BY-4.0"),
    ("CC0|Creative Commons Zero", "CC0-1.0"),
    ("GNU Affero General Public License|AGPL", "AGPL-3.0"),
    ("GNU Lesser General Public License|LGPL", "LGPL-3.0"),
    ("GNU General Public License|GPL", "GPL-3.0"),
    ("Mozilla Public License|MPL[ -]2[.]0", "MPL-2.0"),
    ("BSD License|BSD[ -][23][ -]Clause", "BSD-3-Clause"),
    ("Apache License|Apache[ -]2[.]0", "Apache-2.0"),
    ("MIT License", "MIT"),
    ("Open Database License|ODbL", "ODbL-1.0"),
    ("All rights reserved", RESERVED),
)

# Fixed patterns of personal data, replaced in this order.
PERSONAL = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9][A-Za-z0-9.-]*[.][A-Za-z0-9-]+", "[EMAIL]"),
    ("ip", r"[0-9]{1,3}([.][0-9]{1,3}){3}", "[IP]"),
    ("phone", r"[+]?[0-9]{1,3}[-. ][(]?[0-9]{2,4}[)]?[-. ][0-9]{3,4}([-. ][0-9]{2,4})?", "[PHONE]"),
)


def license_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(LICENSES), "license_name string, spdx_id string, commercial_use boolean, attribution string"
    )


def detect_license(text: str) -> Column:
    """License id of the first phrase of ``LICENSE_PHRASES`` found in the text, else null: not known.

    A text is searched for any of the phrases first; only the few that have one are searched for each.
    """
    found = F.lit(None).cast("string")
    for pattern, spdx in reversed(LICENSE_PHRASES):
        found = F.when(F.col(text).rlike(f"(?i){pattern}"), spdx).otherwise(found)
    some = "|".join(pattern for pattern, _ in LICENSE_PHRASES)
    return F.when(F.col(text).rlike(f"(?i){some}"), found)


def license_policy(rows: DataFrame, license_column: str = "license") -> DataFrame:
    """Add commercial_use, attribution and known_license; the six license rows are broadcast."""
    policy = license_table(rows.sparkSession).drop("license_name").withColumnRenamed("spdx_id", "_spdx")
    joined = rows.join(F.broadcast(policy), F.col(license_column) == F.col("_spdx"), "left")
    return joined.withColumn("known_license", F.col("_spdx").isNotNull()).drop("_spdx")


def attributions(rows: DataFrame, record_id: str, default_author: str = "Unknown") -> DataFrame:
    """Attribution rows of documents or chunks with source_url, author and license."""
    author = F.coalesce("author", F.lit(default_author))
    return rows.select(
        F.col(record_id).cast("string").alias("record_id"), "source_url", author.alias("author"), "license",
        F.concat(author, F.lit(", "), F.col("source_url"), F.lit(" ("), F.col("license"), F.lit(")"))
        .alias("attribution_text"),
    )


def scrub_personal_data(rows: DataFrame, text: str) -> DataFrame:
    """Replace e-mail addresses, IPv4 addresses and phone numbers; add the number of hits of each kind."""
    for kind, pattern, mark in PERSONAL:
        before, after = F.col(text), F.col("_after")
        replaced = F.regexp_replace(before, pattern, mark)
        if kind == "email":
            # The address pattern is slow on long words; text without the sign cannot match.
            replaced = F.when(before.contains("@"), replaced).otherwise(before)
        rows = rows.withColumn("_after", replaced)
        # Counting is a second pass over the text, needed only where something was replaced.
        hits = F.when(before == after, 0).otherwise(F.regexp_count(before, F.lit(pattern)))
        rows = rows.withColumns({f"{kind}_hits": hits, text: after}).drop("_after")
    return rows


def content_filter(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents that no label row calls toxic or of low quality; unlabelled documents pass. Stores the ids to drop (an action)."""
    bad = labels.where((F.col("toxic") == 1) | (F.col("quality") == 0)).select(key).distinct()
    return docs.join(broadcast_if_small(bad), key, "left_anti")


def without_takedowns(
    rows: DataFrame, takedowns: DataFrame, key: str = "source_url", max_broadcast: int = BROADCAST_ROWS
) -> DataFrame:
    """Rows whose key is not on the takedown list. A short list (counted) is broadcast; a long one is joined so that
    a source with very many rows stays spread out."""
    return join_unique(rows, takedowns.select(key).distinct(), key, "left_anti", max_broadcast)


def constraint_report(rows: DataFrame, key: str, required: list[str]) -> DataFrame:
    """Violations per rule: (rule, column, violations) for null required columns and duplicate keys.

    Duplicates are the keys that occur more than once; the count per key combines on the map side.
    """
    per_key = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(required)]
    )
    totals = per_key.agg(
        F.count_if((F.col("_n") > 1) & F.col(key).isNotNull()).alias("_dup"),
        *[F.coalesce(F.sum(f"_{i}"), F.lit(0)).alias(f"_{i}") for i in range(len(required))],
    )
    lines = [F.struct(F.lit("unique").alias("rule"), F.lit(key).alias("column"), F.col("_dup").alias("violations"))]
    lines += [
        F.struct(F.lit("not_null").alias("rule"), F.lit(c).alias("column"), F.col(f"_{i}").alias("violations"))
        for i, c in enumerate(required)
    ]
    return totals.select(F.inline(F.array(*lines)))
