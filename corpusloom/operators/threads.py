"""Threads of messages from their reply headers: parents, missing messages as placeholders, roots by pointer jumping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.operators.graph import item_depths
from corpusloom.operators.skew import join_on_hot_key
from corpusloom.session import cut_lineage


def header_ids(header: Column | str) -> Column:
    """The message ids of a References or In-Reply-To header, in order; none for null. Comments and white space do not matter."""
    column = F.col(header) if isinstance(header, str) else header
    return F.coalesce(F.regexp_extract_all(column, F.lit(r"<\s*([^<>\s]+)\s*>"), 1), F.array().cast("array<string>"))


def message_threads(
    messages: DataFrame, message_id: str = "message_id", in_reply_to: str = "in_reply_to", references: str = "references"
) -> DataFrame:
    """Parent, root and depth of every message: (message_id, parent_id, parent_stored, root_id, depth). Actions.

    The parent is the last id of References, else the first of In-Reply-To. Ids that are named but not stored become placeholders;
    what any References header says about the order of two neighbouring ids gives a placeholder its own parent (the smallest, if headers
    disagree), so that a thread holds together across messages that are missing. A message that names itself is no reply. In a
    cycle, and below one, a message is its own root with depth 0. Rows without an id are left out; of rows that repeat an id the one with the
    smallest headers counts. Every round of the pointer jumping doubles the distance looked upwards.
    """
    listed = messages.where(F.col(message_id).isNotNull()).select(
        F.col(message_id).alias("id"), header_ids(references).alias("before"), header_ids(in_reply_to).alias("reply")
    )
    one = cut_lineage(listed.groupBy("id").agg(F.min(F.struct("before", "reply")).alias("h")).select("id", "h.*"))
    last = F.coalesce(F.try_element_at("before", F.lit(-1)), F.try_element_at("reply", F.lit(1)))
    stored = one.select("id", F.when(last != F.col("id"), last).alias("parent"), "before")
    # Neighbouring ids of References: (later, earlier). The first of a list has no earlier one.
    pairs = F.transform("before", lambda x, n: F.struct(x.alias("id"), F.when(n > 0, F.get("before", n - 1)).alias("parent")))
    named = stored.select(F.explode(pairs).alias("p")).select("p.*").unionByName(
        stored.where(F.col("parent").isNotNull()).select(F.col("parent").alias("id"), F.lit(None).cast("string").alias("parent"))
    )
    chained = named.where(F.col("parent").isNull() | (F.col("parent") != F.col("id"))).groupBy("id").agg(F.min("parent").alias("parent"))
    missing = chained.join(stored.select("id"), "id", "left_anti")
    nodes = cut_lineage(stored.select("id", "parent", F.lit(True).alias("is_stored")).unionByName(missing.withColumn("is_stored", F.lit(False))))
    roots = item_depths(nodes.select("id", "parent"))
    mine = nodes.where("is_stored").join(roots, "id", "left")
    parents = nodes.select(F.col("id").alias("parent"), F.col("is_stored").alias("parent_stored"))
    found = join_on_hot_key(mine.drop("is_stored"), parents, "parent", "left")
    return found.select(
        F.col("id").alias("message_id"), F.col("parent").alias("parent_id"), "parent_stored",
        F.coalesce("root", "id").alias("root_id"), F.coalesce("depth", F.lit(0)).alias("depth"),
    )
