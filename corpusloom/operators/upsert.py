"""Insert-or-replace by key, defaults on insert, and change detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.dates import epoch_time
from corpusloom.operators.skew import broadcast_if_small, latest_per_key


def upsert(
    target: DataFrame, updates: DataFrame, key: str, order: list[str], defaults: dict[str, Column] | None = None
) -> DataFrame:
    """``target`` with ``updates`` applied by ``key``; among updates of one key the last by ``order`` wins.

    Columns that ``updates`` lists replace the old value even with null. Columns it does not list keep the old value;
    for new keys they take their default, else null. Both sides are unique on the key at the join, so no key is hot.
    """
    defaults = defaults or {}
    listed = [c for c in updates.columns if c != key and c in target.columns]
    newest = latest_per_key(updates, [key], order, columns=listed)
    packed = newest.select(F.col(key).alias("_key"), F.struct(*listed).alias("_new"))
    joined = target.withColumn("_old", F.lit(True)).join(packed, F.col(key) == F.col("_key"), "full_outer")

    def value(name: str) -> Column:
        if name == key:
            return F.coalesce(key, "_key")
        if name in listed:
            return F.when(F.col("_key").isNotNull(), F.col(f"_new.{name}")).otherwise(F.col(name))
        return F.when(F.col("_old"), F.col(name)).otherwise(defaults.get(name, F.lit(None)))

    return joined.select(*[value(c).alias(c) for c in target.columns])


def with_defaults(rows: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Fill columns that are missing or null with their default, as an insert into a table with defaults does."""
    for name, default in defaults.items():
        value = F.coalesce(F.col(name), default) if name in rows.columns else default
        rows = rows.withColumn(name, value)
    return rows


def item_rows(items: DataFrame, story_type: Column, crawled_at: Column) -> DataFrame:
    """API items (RAW_ITEM) to table rows: time parsed to UTC, story list and crawl time added."""
    return items.select(
        "id", "type", "by", "time", epoch_time("time").alias("time_parsed"), "title", "url", "text", "score",
        "descendants", "parent", "kids", story_type.alias("story_type"), crawled_at.alias("crawled_at"),
    )


# Story list names and their API endpoints; any other name means the first.
STORY_LISTS = {
    "top": "topstories",
    "new": "newstories",
    "best": "beststories",
    "ask": "askstories",
    "show": "showstories",
    "job": "jobstories",
}


def story_endpoint(name: Column) -> Column:
    pairs = [F.lit(part) for pair in STORY_LISTS.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), name), F.lit(STORY_LISTS["top"]))


UNCHANGED, CHANGED, NEW, DELETED = "unchanged", "changed", "new", "deleted"


def document_states(current: DataFrame, before: DataFrame, doc_id: str = "id", text: str = "content") -> DataFrame:
    """What became of every document of two versions: (id, state). Ids and 16-byte hashes are all that is shuffled.

    Both sides have one row per id. Null texts are equal to each other.
    """
    new, old = (df.select(F.col(doc_id).alias("id"), F.unhex(F.md5(text)).alias(h)) for df, h in ((current, "_new"), (before, "_old")))
    joined = new.withColumn("_here", F.lit(True)).join(old.withColumn("_there", F.lit(True)), "id", "full_outer")
    state = F.when(F.col("_there").isNull(), NEW).when(F.col("_here").isNull(), DELETED)
    return joined.select("id", state.when(F.col("_new").eqNullSafe(F.col("_old")), UNCHANGED).otherwise(CHANGED).alias("state"))


def changed_documents(current: DataFrame, seen: DataFrame, doc_id: str = "id", text: str = "content") -> DataFrame:
    """Documents that are new or whose text differs from what ``seen`` (id, content hash) recorded.

    Only these need chunking and embedding again. Both sides have one row per id. The comparison shuffles ids and
    hashes only; texts are picked afterwards by the ids that changed, in place unless there are very many of them. Finding
    these ids is an action.
    """
    hashes = current.select(doc_id, F.md5(text).alias("content_md5"))
    changed = hashes.join(seen.select(doc_id, "content_md5"), [doc_id, "content_md5"], "left_anti")
    return current.join(broadcast_if_small(changed), doc_id)
