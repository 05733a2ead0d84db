"""The two graphs in the data: links between pages, and parent/child items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.urls import canonical_url
from corpusloom.operators.html import page_links
from corpusloom.operators.skew import join_on_hot_key, join_unique, without_keys
from corpusloom.session import cut_lineage, scratch_path


def frontier_step(
    pages: DataFrame, visited: DataFrame, same_site: bool = True, strip_regions: bool = True,
    url_filter: Column | None = None,
) -> DataFrame:
    """Canonical link targets of ``pages`` that are not in ``visited`` (column ``canonical``): (canonical, link, links).

    ``link`` is the smallest absolute form, ``links`` the number of anchors that point there. Targets are grouped
    before the anti-join, so a page that everybody links to is one row when it meets the visited set.
    """
    links = page_links(pages, strip_regions=strip_regions, same_site=same_site, where=url_filter)
    targets = links.groupBy(canonical_url("link").alias("canonical")).agg(
        F.min("link").alias("link"), F.count(F.lit(1)).alias("links")
    )
    return without_keys(targets, visited.select("canonical").distinct(), "canonical")


def crawl_order(
    pages: DataFrame,
    start_urls: list[str],
    max_pages: int = 100,
    max_depth: int | None = None,
    url_filter: Column | None = None,
    strip_regions: bool = True,
) -> DataFrame:
    """Breadth-first walk over stored pages: (canonical, url, depth, place), at most ``max_pages`` visited.

    ``place`` sorts pages in visiting order. Within a level, targets are visited in the order of the page that first
    links to them, then by position on that page. URLs that are not among ``pages`` count as visited but lead nowhere, like
    pages that could not be fetched. Null and repeated start URLs do not matter; without any the result is empty.

    Each level is sorted, numbered and added to one stored table, the visited set: its plan is one scan however deep the walk
    goes, and a lost executor repeats a part of one level.
    """
    spark = pages.sparkSession
    # Of several URLs with the same canonical form the smallest stands for the page.
    chosen = pages.groupBy(canonical_url("url").alias("source")).agg(F.min("url").alias("page_url"))
    # Links are extracted once; the walk itself only sees this narrow table.
    links = page_links(pages, strip_regions=strip_regions, where=url_filter).join(chosen, "page_url")
    links = cut_lineage(links.select("source", "position", "link", canonical_url("link").alias("canonical")))

    seeds = spark.createDataFrame([(u, i) for i, u in enumerate(start_urls) if u is not None], "link string, position long")
    targets = seeds.groupBy(canonical_url("link").alias("canonical")).agg(
        F.min(F.struct(F.lit(0).cast("long").alias("parent"), "position")).alias("rank"),
        F.min_by("link", "position").alias("link"),
    )
    path, count, depth = scratch_path(spark, "visited"), 0, 0
    while True:
        level, found = _next_places(targets, count, max_pages, depth)
        level.write.mode("append").parquet(path)
        visited = spark.read.schema(level.schema).parquet(path)
        count += found
        if not found or count >= max_pages or (max_depth is not None and depth >= max_depth):
            return visited
        here = visited.where(F.col("depth") == depth).select(F.col("canonical").alias("source"), F.col("place").alias("parent"))
        depth += 1
        rank = F.struct("parent", "position")
        onward = join_unique(links, here, "source")
        targets = onward.groupBy("canonical").agg(F.min(rank).alias("rank"), F.min_by("link", F.struct(rank, "link")).alias("link"))
        targets = without_keys(targets, visited, "canonical")


def _next_places(targets: DataFrame, count: int, max_pages: int, depth: int) -> tuple[DataFrame, int]:
    """Number the targets of one level in visiting order after the ``count`` earlier ones, within the page budget.

    Only the row count of each sorted partition reaches the driver; the numbering itself is distributed.
    """
    ordered = targets.orderBy("rank.parent", "rank.position", "canonical")
    ordered = cut_lineage(ordered.withColumn("_id", F.monotonically_increasing_id()))
    # The upper bits of the generated id are the partition, the lower 33 bits count within it.
    ordered = ordered.withColumn("_part", F.shiftright("_id", 33))
    sizes = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()
    total, offsets = count, []
    for row in sizes:
        offsets.append((row["_part"], total))
        total += row["n"]
    starts = ordered.sparkSession.createDataFrame(offsets, "_part long, _start long")
    numbered = ordered.join(F.broadcast(starts), "_part").select(
        "canonical", F.col("link").alias("url"), F.lit(depth).alias("depth"),
        (F.col("_start") + F.col("_id") - F.shiftleft("_part", 33)).alias("place"),
    )
    return numbered.where(F.col("place") < max_pages), min(total, max_pages) - count


def item_children(items: DataFrame, kids: str = "kids") -> DataFrame:
    """Children of every item that lists some: (parent_id, position, child_id, ...child columns).

    Every child id occurs once, so the join has no hot key however many children one parent has.
    """
    listed = items.select(F.col("id").alias("parent_id"), F.posexplode(kids).alias("position", "child_id"))
    children = items.drop(kids).withColumnRenamed("id", "child_id")
    return listed.join(children, "child_id")


def with_parent(items: DataFrame, columns: list[str]) -> DataFrame:
    """Items that have a parent, with ``columns`` of it prefixed ``parent_``; null where the parent is not stored.

    A parent of a third of all items is no bottleneck. Looks for such parents while it is built (an action).
    """
    parents = items.select(F.col("id").alias("parent"), *[F.col(c).alias(f"parent_{c}") for c in columns])
    return join_on_hot_key(items.where(F.col("parent").isNotNull()), parents, "parent", "left")


def item_depths(items: DataFrame) -> DataFrame:
    """Root and depth of every item that descends from a root: (id, root, depth).

    Every round doubles the distance each item has looked upwards, so a thread ``n`` levels deep takes ``log2(n)``
    rounds, and only unfinished items take part. Items below a missing parent or in a cycle have no root and are
    left out; the rounds end when nothing but these is left. Every round is an action that stores its result.
    """
    is_root = F.col("parent").isNull()
    steps = cut_lineage(items.select(
        "id", F.coalesce("parent", "id").alias("up"), F.when(is_root, 0).otherwise(1).cast("long").alias("depth"),
        is_root.alias("done"),
    ))
    open_items = None
    while True:
        still_open = steps.where(~F.col("done")).count()
        if not still_open or still_open == open_items:
            break
        open_items = still_open
        above = steps.select(
            F.col("id").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_depth"), F.col("done").alias("_done")
        )
        moved = join_on_hot_key(steps.where(~F.col("done")).drop("done"), above, "up").select(
            "id", F.col("_up").alias("up"), (F.col("depth") + F.col("_depth")).alias("depth"), F.col("_done").alias("done")
        )
        steps = cut_lineage(steps.where("done").unionByName(moved))
    return steps.where("done").select("id", F.col("up").alias("root"), F.col("depth").cast("int").alias("depth"))


def components(edges: DataFrame) -> DataFrame:
    """Smallest node that every node of ``edges`` (``a``, ``b``: long) is connected with: (node, component), without these smallest ones.

    Rounds of stars: every neighbour that is larger than a node goes to the node's smallest neighbour, then every smaller one does too.
    No component gains an edge by that, and the rounds end when each is one star, after about the logarithm of its size. A node that
    many others hang on is met in place. Every round stores its edges (actions).
    """
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    stars, before = cut_lineage(edges.where("a <> b").select(larger, smaller).distinct()), None
    while True:
        marks = [F.bit_xor(F.xxhash64("a", "b", F.lit(n))) for n in range(2)]
        state = stars.agg(F.count(F.lit(1)), *marks).first()
        if state == before:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = state
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = cut_lineage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")))
        moved = join_on_hot_key(both, lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        stars = cut_lineage(moved.distinct())
        lowest = cut_lineage(stars.groupBy("a").agg(F.min("b").alias("low")))
        moved = join_on_hot_key(stars, lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        stars = cut_lineage(moved.unionByName(lowest.select("a", F.col("low").alias("b"))).where("a <> b").distinct())
