"""A Merkle manifest of a table: one tree per group, one tree over the groups, and a proof for every row.

Trees grow by pivots: the children of a node stand side by side in ``fanout`` slot columns, made by conditional aggregates; joined
they are hashed to the node, and joined without a child's own slot they are its siblings. Levels are stored one after the other,
each a third of the one below (at a fanout of three); going down, every level meets the level above by its parent's place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.llm.common import positions, stored

# Two texts beside a node, to be joined before and after it.
_PATH = "array<struct<left:string,right:string>>"


def sealed(value: Column) -> Column:
    """A value as it enters a leaf: its bytes counted, a colon, the value; ``-`` for null."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_hash(columns: list[Column]) -> Column:
    """Lowercase hex SHA-256 of all values, each sealed, one after the other."""
    return F.sha2(F.concat(*[sealed(c) for c in columns]), 256)


def _slots(fanout: int) -> list[str]:
    return [f"_slot_{n}" for n in range(fanout)]


def _joined(slots: list[Column]) -> Column:
    return F.concat(F.lit(""), *[F.coalesce(s, F.lit("")) for s in slots])


class Forest:
    """Hash trees over nodes (``tree`` long, ``at`` from 0, ``size`` of the tree, ``hash``), stored level by level.

    ``levels[n]`` holds the nodes of height ``n + 1``: their place, how many stand beside them, the hash, and the slots of
    their children. ``tops`` holds one row per tree: (tree, height, hash).
    """

    def __init__(self, nodes: DataFrame, fanout: int) -> None:
        self.fanout, self.levels, names = fanout, [], _slots(fanout)
        tops, level = [nodes.where(F.col("size") == 1).select("tree", F.lit(0).alias("height"), "hash")], nodes
        widest = nodes.agg(F.max("size")).scalar()
        widest = nodes.sparkSession.range(1).select(widest.alias("n")).first()["n"] or 0
        while widest > 1:
            # Every slot is a conditional aggregate; the count of the level above follows from the count of this one.
            pivot = [F.max(F.when(F.col("at") % fanout == n, F.col("hash"))).alias(name) for n, name in enumerate(names)]
            parent = F.expr(f"at div {fanout}").alias("at")
            above = F.expr(f"(size + {fanout - 1}) div {fanout}").alias("size")
            grouped = level.where(F.col("size") > 1).groupBy("tree", parent, above).agg(*pivot)
            level = stored(grouped.withColumn("hash", F.sha2(_joined([F.col(n) for n in names]), 256)))
            self.levels.append(level)
            tops.append(level.where(F.col("size") == 1).select("tree", F.lit(len(self.levels)).alias("height"), "hash"))
            widest = -(-widest // fanout)
        self.tops = stored(reduce(DataFrame.unionByName, tops))

    def paths(self, nodes: DataFrame, above: DataFrame, carried: list[str]) -> DataFrame:
        """Nodes with ``path``: what stands left and right of them, level by level from the node to the top of its tree, then
        the path of the tree in ``above`` (tree, path and the columns ``carried`` down). ``nodes`` has ``tree``, ``at``, ``size``."""
        above = above.join(self.tops.select("tree", "height"), "tree")
        upper: DataFrame | None = None
        for height in range(len(self.levels), -1, -1):
            level = self.levels[height - 1] if height else nodes
            root = level.where(F.col("size") == 1).join(above.where(F.col("height") == height).select("tree", "path", *carried), "tree")
            if upper is not None:
                root = root.unionByName(self._below(level.where(F.col("size") > 1), upper, carried))
            upper = root
        return upper

    def _below(self, children: DataFrame, parents: DataFrame, carried: list[str]) -> DataFrame:
        names = _slots(self.fanout)
        own = [F.col(f"_up{n}") for n in names]
        up = parents.select(F.col("tree").alias("_tree"), F.col("at").alias("_parent"), F.col("path").alias("_path"),
                            *carried, *[F.col(n).alias(f"_up{n}") for n in names])
        met = children.join(up, (F.col("tree") == F.col("_tree")) & (F.expr(f"at div {self.fanout}") == F.col("_parent")))
        slot = F.col("at") % self.fanout
        left = _joined([F.when(slot > n, s) for n, s in enumerate(own)])
        right = _joined([F.when(slot < n, s) for n, s in enumerate(own)])
        path = F.concat(F.array(F.struct(left.alias("left"), right.alias("right"))), F.col("_path"))
        return met.select(*children.columns, path.alias("path"), *carried)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and what stands beside it lead to. A level without a sibling still hashes the lone node."""
    return F.aggregate(path, leaf, lambda node, beside: F.sha2(F.concat(beside["left"], node, beside["right"]), 256))


def proof_hash(path: Column) -> Column:
    """SHA-256 of all siblings, level by level from the leaf, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda beside: F.concat(beside["left"], beside["right"])), ""), 256)


def merkle_manifest(
    docs: DataFrame,
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    order: str = "doc_id",
    group: str = "source",
    fanout: int = 3,
    presented: dict[str, Column] | None = None,
) -> DataFrame:
    """Leaf, subroot, root and proof of every row, and whether the row as ``presented`` leads to the root.

    A leaf hashes ``columns``. Per ``group`` the leaves stand by ``order`` (nulls first; rows that repeat it by their leaf hash, so
    the manifest does not depend on the order of the input) and every ``fanout`` of them become a node, until one is left: the
    subroot. The subroots stand by group (null first, then by bytes) and become the root alike. ``presented`` replaces columns by
    what somebody shows as the row: its leaf is folded with the original siblings to ``folded_root``; ``verified`` is true where
    that is the root.

    Nulls in any column have a leaf of their own kind; a null group is a group; rows equal in all columns are leaves each. An
    empty table gives no rows. Columns that are not named are not read, so their names cannot clash. Texts are hashed where they
    are read; from there on only hashes travel. Columns: ``order``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``,
    ``folded_root``, ``verified``, ``path`` (siblings left and right, from the leaf to the root: what a client needs to check a row).
    """
    original = leaf_hash([F.col(c) for c in columns])
    shown = leaf_hash([(presented or {}).get(c, F.col(c)) for c in columns])
    leaves = docs.select(F.col(group).alias("_group"), F.col(order).alias("_order"), original.alias("hash"), shown.alias("_shown"))
    nodes = stored(positions(leaves, [F.col("_order"), F.col("hash"), F.col("_shown")], ["_group"], "at", "size", "tree"))
    forest = Forest(nodes.select("tree", "at", "size", "hash"), fanout)
    # The tree over the groups is one more forest, of a single tree.
    one, groups = F.lit(0).cast("long"), F.lit(forest.tops.count())
    top_nodes = stored(forest.tops.select(one.alias("tree"), F.col("tree").alias("at"), groups.alias("size"), "hash"))
    top = Forest(top_nodes, fanout)
    above = top.paths(top_nodes, top.tops.select("tree", F.array().cast(_PATH).alias("path"), F.col("hash").alias("root")), ["root"])
    above = stored(above.select(F.col("at").alias("tree"), "path", "root", F.col("hash").alias("subroot")))
    rows = forest.paths(nodes, above, ["subroot", "root"]).select(
        F.col("_order").alias(order), F.col("hash").alias("leaf"), "subroot", "root",
        proof_hash(F.col("path")).alias("proof_sha256"), folded(F.col("_shown"), F.col("path")).alias("folded_root"), "path",
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
