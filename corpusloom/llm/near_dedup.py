"""MinHash near-duplicates with tensored banding.

Two small collections of band hashes are computed per document; every pair of a band of the first and a band of the second
is a table key. With m bands in each, 2m bands do the work of m * m tables. Candidates are confirmed on full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from corpusloom.llm.common import stored
from corpusloom.llm.graph import components
from corpusloom.llm.word_hashes import SECOND, WordHasher, mixed

# Bands in each collection and MinHash values in a band: two sets of similarity 0.8 share a table but for 9 in 100,000.
BANDS, DEPTH = 14, 3
# Documents of one crowd that are compared in a task, times two.
CROWD = 1024
# Entries of the inverted index that a task reads at once, about.
INDEX_READS = 1 << 22


class Shingler:
    """Distinct shingles of ``size`` words as sorted 64-bit hashes."""

    def __init__(self, size: int) -> None:
        self.size, self.hasher = size, WordHasher()

    def shingles(self, text: str | None) -> np.ndarray:
        """A-Z lower-cased, words between ASCII white space; fewer words than ``size`` are one shingle."""
        hashes = self.hasher.hashes((text or "").encode("utf-8", "surrogatepass").lower())
        if not len(hashes):
            return np.zeros(0, np.uint64)
        count, length = max(1, len(hashes) - self.size + 1), min(len(hashes), self.size)
        codes = np.full(count, length, np.uint64)
        for n in range(length):
            codes = mixed(codes * SECOND + hashes[n : n + count])
        return np.unique(codes)


class Bands:
    """Hashes of bands of MinHash values, the two collections one after the other."""

    def __init__(self, bands: int, depth: int, seed: int = 41) -> None:
        draw = np.random.default_rng(seed)
        count = 2 * bands * depth
        self.factors = (draw.integers(0, 1 << 31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
        self.masks = draw.integers(0, 1 << 32, count, dtype=np.uint32)[:, None]
        self.shape = (2 * bands, depth)
        self.places = mixed(np.arange(1, 2 * bands + 1, dtype=np.uint64))

    def of(self, shingles: np.ndarray) -> np.ndarray:
        """Least values of the permutations ``(x ^ mask) * factor`` of 32-bit numbers, band by band."""
        numbers = (shingles >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.factors), np.iinfo(np.uint32).max, np.uint32)
        for at in range(0, len(numbers), 1024):
            values = numbers[at : at + 1024] ^ self.masks
            values *= self.factors
            np.minimum(least, values.min(axis=1), out=least)
        codes = self.places.copy()
        for column in least.reshape(self.shape).T:
            codes = mixed(codes * SECOND + column)
        return codes.view(np.int64)


def signatures(docs: DataFrame, shingle: int, bands: int, depth: int, id_column: str, text_column: str) -> DataFrame:
    """Id, set size, digest of the set and band hashes of every whole text. No shuffle."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, family = Shingler(shingle), Bands(bands, depth)
        for batch in batches:
            sizes, digests, codes = [], [], []
            for text in batch.column(1).to_pylist():
                own = shingler.shingles(text)
                sizes.append(len(own))
                digests.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                codes.append(family.of(own) if len(own) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(codes, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "digest", "codes"],
            )

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(sign, "doc_id long, n_shingles long, digest binary, codes array<long>")


def alike(threshold: int) -> Column:
    """True where the shingle sets ``_left`` and ``_right`` have 100 * intersection >= threshold * union."""

    @arrow_udf("boolean")
    def compare(left: pa.Array, right: pa.Array) -> pa.Array:
        found = []
        for n in range(len(left)):
            a, b = (side[n].values.to_numpy(zero_copy_only=False) for side in (left, right))
            if 100 * min(len(a), len(b)) < threshold * max(len(a), len(b)):
                found.append(False)
                continue
            both = len(np.intersect1d(a, b, assume_unique=True))
            found.append(100 * both >= threshold * (len(a) + len(b) - both))
        return pa.array(found, pa.bool_())

    return compare("_left", "_right")


def near_duplicates(
    docs: DataFrame, shingle: int = 5, threshold: int = 80, bands: int = BANDS, depth: int = DEPTH,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Components of documents whose shingle sets are similar, and the one document of each that is kept.

    Equal sets are one class with its smallest id as representative; only representatives are compared. A band hash that
    no other representative has cannot lead to anything and is dropped, which loses no pair; of the rest every document
    forms its table keys. Links are looked for in two steps. First every document meets the smallest id of all its tables.
    Then, where a table still holds several components, all documents that share a band of the first collection with its
    members come together with their full sets, in blocks of bounded size that meet pairwise; a task tests everything that
    is not yet of one component and returns only the links that join components. So no candidate pair of different components
    stays untested, and a group of thousands of like documents makes no rows for its pairs.

    Null ids take no part and are kept, with null ``component_id``; null and empty texts are linked with nothing. Rows that
    repeat an id are judged each by its text (an id that stands for two classes links them). Stores narrow tables for each step, and the shingle sets of documents
    that have candidates. Columns: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.
    """
    signed = stored(signatures(docs, shingle, bands, depth, id_column, text_column))
    listed = signed.where(F.col("doc_id").isNotNull() & F.col("digest").isNotNull())
    classes = stored(listed.groupBy("digest").agg(F.min("doc_id").alias("rep")))
    # One row per class: a repeated id may stand for a class in several rows.
    own = listed.join(classes.withColumnRenamed("digest", "_d"), (F.col("doc_id") == F.col("rep")) & (F.col("digest") == F.col("_d")))
    codes = own.select(F.col("digest"), F.col("rep"), F.posexplode("codes").alias("place", "code"))
    codes = codes.select("rep", F.hash("digest").alias("text"), (F.col("place") < bands).alias("first"), "code")
    shared = codes.groupBy("code").agg(F.min("rep").alias("_a"), F.max("rep").alias("_b")).where("_a < _b").select("code")
    shared = stored(shared)  # a scan on both sides lets a crowded code be split in the join
    met = codes.join(shared, "code").groupBy("rep", "text").agg(
        F.collect_set(F.when(F.col("first"), F.col("code"))).alias("left"), F.collect_set(F.when(~F.col("first"), F.col("code"))).alias("right")
    )
    met = stored(met.where((F.size("left") > 0) & (F.size("right") > 0)))
    rows = met.select("rep", "right", F.explode("left").alias("_l"))
    keys = rows.select("rep", "_l", F.explode("right").alias("_r")).select("rep", F.xxhash64("_l", "_r").alias("key"))
    ends = keys.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
    tables = stored(keys.join(stored(ends.drop("high")), "key"))
    sets = stored(_shingle_sets(docs, classes, tables.select("rep").distinct(), shingle, id_column, text_column))

    # 1: the smallest id met.
    sides = tables.where("low < rep").groupBy(F.col("rep").alias("x")).agg(F.min("low").alias("y"))
    sides = sides.join(sets.select(F.col("rep").alias("x"), F.col("shingles").alias("_left")), "x")
    sides = sides.join(sets.select(F.col("rep").alias("y"), F.col("shingles").alias("_right")), "y")
    links = stored(sides.where(alike(threshold)).select("x", "y"))
    found = components(links)
    # 2: tables that hold several components.
    labelled = _labelled(tables.select("key", "rep"), found, "rep", "own")
    apart = labelled.groupBy("key").agg(F.min("own").alias("_a"), F.max("own").alias("_b")).where("_a < _b").select("key")
    open_ = tables.join(stored(apart), "key").select("rep").distinct()
    near = met.join(stored(open_), "rep").select("rep", F.explode("left").alias("code"))
    firsts = near.groupBy("code").agg(F.min("rep").alias("leader"), F.max("rep").alias("_last")).where("leader < _last").drop("_last")
    crowds = stored(_labelled(near.join(stored(firsts), "code").select("leader", "rep").distinct(), found, "rep", "own"))
    links = stored(links.unionByName(_links_between(crowds, sets, threshold)))
    found = components(links)

    groups = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("component"))
    result = signed.select("doc_id", "n_shingles", "digest").join(groups, "digest", "left")
    component = F.coalesce("component", "doc_id")
    component = F.when(F.col("doc_id").isNotNull(), component)
    return result.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _links_between(crowds: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links that join different components (``own``) of the documents (``rep``) of each ``leader``.

    A crowd of more than CROWD documents is cut into blocks by a hash; a task holds two blocks of one crowd.
    """
    sizes = crowds.groupBy("leader").agg(F.count(F.lit(1)).alias("_n"), F.min("own").alias("_a"), F.max("own").alias("_b"))
    sizes = stored(sizes.where("_a < _b").select("leader", F.ceil(F.col("_n") / CROWD).cast("int").alias("_blocks")))
    placed = crowds.join(sizes, "leader").withColumn("_block", F.pmod(F.xxhash64("rep"), F.col("_blocks")).cast("int"))
    placed = placed.withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    placed = placed.select("leader", F.least("_block", "_with").alias("one"), F.greatest("_block", "_with").alias("two"), "rep", "own")

    def link(table: pa.Table) -> pa.Table:
        # A representative has one row for each class it stands for; they are one node.
        table = table.sort_by("rep")
        rep, own = table.column("rep").to_numpy(), table.column("own").to_numpy()
        lists = table.column("shingles").combine_chunks()
        values, sizes = lists.values.to_numpy(), lists.value_lengths().to_numpy().astype(np.int64)
        pairs = links_of_sets(values, sizes, own, threshold)
        return pa.table([pa.array(rep[[p[0] for p in pairs]]), pa.array(rep[[p[1] for p in pairs]])], ["x", "y"]) if pairs else (
            pa.table([pa.array([], pa.int64()), pa.array([], pa.int64())], ["x", "y"]))

    return placed.join(sets, "rep").groupBy("leader", "one", "two").applyInArrow(link, "x long, y long")


def links_of_sets(values: np.ndarray, sizes: np.ndarray, own: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Pairs of sets with 100 * intersection >= threshold * union that connect different components, as few as do.

    Sets lie one after the other in ``values``. An inverted index of the elements gives each set's intersections with
    all earlier ones at once.
    """
    _, codes = np.unique(values, return_inverse=True)
    of = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(codes, kind="stable")  # by element, then by set
    holders, starts = of[order], np.r_[0, np.cumsum(np.bincount(codes))]
    place = np.empty(len(codes), np.int64)
    place[order] = np.arange(len(codes))
    earlier = place - starts[codes]  # how many earlier sets hold the element
    begins = np.r_[0, np.cumsum(sizes)]
    roots = {c: c for c in own.tolist()}

    def root(c: int) -> int:
        while roots[c] != c:
            roots[c] = roots[roots[c]]
            c = roots[c]
        return c

    pairs = []
    for n in range(1, len(sizes)):
        mine = slice(begins[n], begins[n + 1])
        counts, firsts = earlier[mine], starts[codes[mine]]
        both = np.zeros(n, np.int64)
        before = np.cumsum(counts) - counts
        for begin in range(0, int(counts.sum()), INDEX_READS):  # a long set of common elements is read in parts
            some = slice(*np.searchsorted(before, [begin, begin + INDEX_READS]))
            own_counts = counts[some]
            total = int(own_counts.sum())
            if total:
                at = np.arange(total) + np.repeat(firsts[some] - np.cumsum(own_counts) + own_counts, own_counts)
                both += np.bincount(holders[at], minlength=n)
        for other in np.flatnonzero(100 * both >= threshold * (sizes[n] + sizes[:n] - both)).tolist():
            a, b = root(int(own[n])), root(int(own[other]))
            if a != b:
                roots[max(a, b)] = min(a, b)
                pairs.append((n, other))
    return pairs


def _labelled(df: DataFrame, found: DataFrame, node: str, name: str) -> DataFrame:
    """``df`` with the component of ``node`` (itself if it has no link)."""
    labels = found.select(F.col("node").alias(node), F.col("component").alias("_component"))
    return df.join(labels, node, "left").withColumn(name, F.coalesce("_component", node)).drop("_component")


def _shingle_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, shingle: int, id_column: str, text_column: str) -> DataFrame:
    """Full shingle sets of the wanted representatives."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(shingle)
        for batch in batches:
            own = [shingler.shingles(t) for t in batch.column(1).to_pylist()]
            digests = [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in own]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array([x.view(np.int64) for x in own], pa.list_(pa.int64()))],
                ["rep", "digest", "shingles"],
            )

    rows = docs.select(F.col(id_column).cast("long").alias("rep"), F.col(text_column).alias("text"))
    rows = rows.join(wanted, "rep", "left_semi").mapInArrow(build, "rep long, digest binary, shingles array<long>")
    # A repeated id has several texts; the set of its class counts.
    return rows.join(classes, ["rep", "digest"]).groupBy("rep", "digest").agg(F.any_value("shingles").alias("shingles")).drop("digest")
