"""Groups of similar chunks: cells or tables of signed random projections propose pairs, cosine similarity decides.

Chunks with the same vector, however many, are one node. Nodes meet in one of two ways, whichever a sample of nodes foretells less work for:

* Cells around a few centres. A node belongs to the nearest centre, and visits an earlier cell if its distance to the plane between both
  centres lets a linked node lie there. Every link meets in exactly one cell. Good for vectors that lie in clusters or narrow cones.
* Tables: each gives a node the signs of its products with a few random directions; nodes of equal signs are compared. How many signs a
  table has follows from the number of nodes and from how alike the nodes of the sample are, so that nodes without a link meet rarely;
  there are as many tables as keep the chance of missing a link below a bound. Good for scattered vectors.

Nodes that meet in a place with few others are gathered there and compared. A crowd is cut into blocks, each of which is stored as one row;
a task reads two parts of the stored blocks and compares those that meet. So a node is sent and stored once for every place it comes to,
however many blocks it meets there. What leaves a task is one row per node, its links and the smallest node it hangs together with: pairs are
never written, nor held for more than a slab of a block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from corpusloom.functions.vectors import RANK_DIGITS, to_matrix, unit_rows
from corpusloom.operators.graph import components
from corpusloom.operators.skew import broadcast_if_small, join_on_hot_key
from corpusloom.session import cut_lineage

# Nodes of a block at most, about; comparisons that cost as much as sending a node once; nodes of the sample; signs of a table and cells at most.
BLOCK, SENT, SAMPLE, MOST_SIGNS, MOST_CELLS = 8192, 512, 1024, 40, 64
# Tables, and cells that a node visits on average, at most: they bound how often a node is sent, whatever the number of nodes.
MOST_TABLES, MOST_VISITS = 12, 2.0
# Similarities that are held at once; bytes of the vectors of a block, and of the blocks of a part that a task reads, at most, about.
SLAB, BLOCK_BYTES, PART_BYTES = 1 << 20, 4 << 20, 64 << 20


def projections(nodes: int, threshold: float, miss: float, others: np.ndarray) -> tuple[int, int]:
    """Signs of a table and number of tables, such that two vectors at the threshold share no table with a chance of ``miss`` at most.

    Two vectors at an angle ``a`` agree in a sign with the chance ``1 - a / pi``, hence in all signs of a table with a power of that.
    More signs keep vectors apart that are not linked and take more tables. Of all choices that keep to ``miss`` with ``MOST_TABLES`` (or with
    one sign) the one with the least work is taken: a node is sent once a table and compared with those of ``others``, some similarities
    below the threshold, that it meets.
    """

    def agree(similarity: np.ndarray) -> np.ndarray:
        return 1 - np.arccos(np.clip(similarity, -1, 1)) / np.pi

    together, meet = float(agree(np.float64(threshold))), agree(others)
    choices = []
    for signs in range(1, MOST_SIGNS + 1):
        chance = together**signs
        tables = 1 if chance >= 1 else max(1, math.ceil(math.log(miss) / math.log1p(-chance)))
        if signs == 1 or tables <= MOST_TABLES:
            choices.append((tables * (SENT + nodes * float((meet**signs).mean() if len(meet) else 0.0)), signs, tables))
    return min(choices)[1:]


def tables_work(nodes: int, signs: int, tables: int, others: np.ndarray) -> float:
    """Comparisons a node, and its sends counted as such, of tables over that many nodes. A row names its earlier tables, 8 bytes each."""
    met = nodes * float(((1 - np.arccos(np.clip(others, -1, 1)) / np.pi) ** signs).mean() if len(others) else 0.0)
    return tables * (SENT * (1 + tables / 64) + met)


def centres_for(units: np.ndarray, nodes: int, threshold: float) -> tuple[np.ndarray, float]:
    """Centres of cells for that many nodes like the sample ``units``, and the work a node takes, as :func:`tables_work` counts it."""
    choices = []
    for cells in [1 << n for n in range(MOST_CELLS.bit_length())]:
        if cells > max(1, len(units) // 4):
            break
        # The first centres are nodes as far from each other as can be; then a few rounds of spherical k-means.
        chosen, near = [0], units @ units[0]
        while len(chosen) < cells:
            chosen.append(int(near.argmin()))
            near = np.maximum(near, units @ units[chosen[-1]])
        centres = units[chosen]
        for _ in range(8):
            own = (units @ centres.T).argmax(axis=1)
            sums = np.zeros_like(centres)
            np.add.at(sums, own, units)
            lengths = np.linalg.norm(sums, axis=1, keepdims=True)
            centres = np.where(lengths > 0, sums / np.where(lengths > 0, lengths, 1), centres)
        own, visits = cells_of(units, centres, threshold)
        times = nodes / max(1, len(units))
        members, visitors = np.bincount(own, minlength=cells) * times, visits.sum(axis=0) * times
        compared, sent = (members * (members / 2 + visitors)).sum(), (members + visitors).sum()
        if cells == 1 or visits.sum() <= MOST_VISITS * len(units):
            choices.append(((compared + SENT * sent) / max(1, nodes), cells, centres))
    work, _, centres = min(choices, key=lambda choice: choice[:2])
    return centres, work


def cells_of(units: np.ndarray, centres: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The cell of every row and, as a matrix of rows and cells, the earlier cells that it visits.

    Rows of a similarity of at least ``threshold`` are at most ``reach`` apart. A row that is nearer to ``c`` than to ``d`` lies on the side
    of ``c`` of the plane between both, so a row further than ``reach`` on the other side has no link into the cell of ``c``.
    """
    products = units @ centres.T
    own = products.argmax(axis=1)
    reach = np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-5
    apart = np.sqrt(np.maximum(0.0, 2 - 2 * (centres @ centres.T)))
    behind = products[np.arange(len(own)), own][:, None] - products
    return own, (behind <= reach * apart[own] + 1e-9) & (np.arange(len(centres)) < own[:, None])


def similar_groups(
    corpus: DataFrame, threshold: float = 0.95, miss: float = 1e-4, chunk_id: str = "chunk_id", vector: str = "embedding", seed: int = 42
) -> DataFrame:
    """The group of every chunk: (chunk id, ``group_id``, ``links``, ``copies``), one row per row of ``corpus``.

    Chunks of a cosine similarity of at least ``threshold`` are linked; a group is all that links connect, and is known by its smallest
    chunk id. ``links`` is the number of other vectors that a chunk's vector is linked with, ``copies`` the number of chunks with the very
    same vector. A link at the threshold is missed with a chance of ``miss`` at most, a closer one with less. A null vector, one of
    another width than most, without direction or with a component that is not finite is linked with nothing: such chunks are groups of
    their own. Runs several actions and stores what each of them finds.
    """
    # Stored first: a vector may come from a model, which is not to run again for every reader.
    stored = cut_lineage(corpus.select(F.col(chunk_id).alias("chunk_id"), F.col(vector).alias("vector")))
    width = stored.where(F.size("vector") > 0).agg(F.mode(F.size("vector"))).first()[0] or 1

    @arrow_udf("boolean")
    def usable(vectors: pa.Array) -> pa.Array:
        return pa.array(np.isfinite(unit_rows(to_matrix(vectors, width))).all(axis=1))

    # Two chained hashes stand for a vector: 128 bits.
    same = F.when(F.col("usable"), F.concat_ws(":", F.xxhash64("vector"), F.xxhash64(F.lit(seed), "vector")))
    hashed = stored.withColumn("usable", usable("vector")).select("chunk_id", "vector", same.alias("same"))
    found = hashed.where("same is not null").groupBy("same").agg(F.any_value("vector").alias("vector"), F.count(F.lit(1)).alias("copies"))
    rows = cut_lineage(hashed.select("chunk_id", "same"))
    nodes = cut_lineage(found.withColumn("node", F.monotonically_increasing_id()))
    links, edges = _links(nodes.select("node", "vector"), width, threshold, miss, seed)
    known = nodes.select("node", "same", "copies").join(links, "node", "left").join(components(edges), "node", "left")
    known = cut_lineage(known.select("same", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("component")))
    members = cut_lineage(join_on_hot_key(rows.where("same is not null").select("chunk_id", "same"), known, "same"))
    names = members.groupBy("component").agg(F.min("chunk_id").alias("group_id"))
    grouped = join_on_hot_key(members, names, "component").select("chunk_id", "group_id", "links", "copies")
    alone = rows.where("same is null").select("chunk_id", F.col("chunk_id").alias("group_id"), F.lit(0).cast("long").alias("links"), F.lit(1).cast("long").alias("copies"))
    return grouped.unionByName(alone).withColumnRenamed("chunk_id", chunk_id)


def _links(nodes: DataFrame, width: int, threshold: float, miss: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Number of links of every linked node (``node``, ``links``), and edges (``a``, ``b``) that connect what links connect."""
    drawn = nodes.orderBy(F.xxhash64("vector")).select("vector").limit(SAMPLE).toArrow().column("vector").combine_chunks()
    units, count = unit_rows(to_matrix(drawn, width)), nodes.count()
    others = (units @ units.T)[np.triu_indices(len(units), 1)]
    others = others[others < threshold]
    signs, tables = projections(count, threshold, miss, others)
    centres, work = centres_for(units, count, threshold) if len(units) and 0 < threshold else (units, np.inf)
    kind = "<f4" if nodes.schema["vector"].dataType.elementType.typeName() == "float" else "<f8"
    most = max(1, min(BLOCK, BLOCK_BYTES // (np.dtype(kind).itemsize * width)))
    if work <= tables_work(count, signs, tables, others):
        few, crowded, sizes = _by_cells(nodes, width, threshold, centres, most)
    else:
        few, crowded, sizes = _by_tables(nodes, width, signs, tables, seed, most)

    def gathered(table: pa.Table) -> _Block:
        earlier = table.column("earlier").combine_chunks().flatten().to_numpy().reshape(len(table), -1)
        return _Block(table.column("node").to_numpy(), to_matrix(table.column("vector").combine_chunks(), width), earlier)

    def alone(table: pa.Table) -> pa.Table:
        block = gathered(table)
        return _told(*_meet(block, block, threshold))

    told = "node long, links long, least long"
    columns = ("node", "vector", "earlier")
    met = few.select("key", *columns).groupBy("key").applyInArrow(alone, told)
    crowds = sizes.agg(F.sum("blocks"), F.sum("n")).first()
    if crowds[0]:

        def pack(key: tuple, table: pa.Table) -> pa.Table:
            block, (place, number, visits) = gathered(table), key
            kept = block.ids.astype("<i8").tobytes(), block.vectors.astype(kind).tobytes(), block.earlier.astype("<i8").tobytes()
            row = {"key": place.as_py(), "block": number.as_py(), "visits": visits.as_py(), **dict(zip(("nodes", "vectors", "earlier"), kept))}
            return pa.Table.from_pylist([row], packed)

        packed = pa.schema([("key", pa.int64()), ("block", pa.int32()), ("visits", pa.bool_()), *[(n, pa.binary()) for n in ("nodes", "vectors", "earlier")]])
        parts = max(math.ceil(crowds[1] * (np.dtype(kind).itemsize * width + 8) / PART_BYTES), math.ceil(math.sqrt(8 * nodes.sparkSession.sparkContext.defaultParallelism)))
        parts = min(parts, crowds[0])
        by = ("key", "block", "visits")
        form = "key long, block int, visits boolean, nodes binary, vectors binary, earlier binary"
        blocks = cut_lineage(crowded.select(*by, *columns).repartition(parts, *by).groupBy(*by).applyInArrow(pack, form)).coalesce(parts)
        met = met.unionByName(_meetings(blocks, width, kind, threshold, told))
    met = cut_lineage(met.groupBy("node", "least").agg(F.sum("links").alias("links")))
    return met.groupBy("node").agg(F.sum("links").alias("links")), met.select(F.col("node").alias("a"), F.col("least").alias("b"))


def _meetings(blocks: DataFrame, width: int, kind: str, threshold: float, told: str) -> DataFrame:
    """What links the blocks of every crowd, from the meetings of its blocks; visitors do not meet each other.

    Blocks are few, and a task reads one part of them on either side from where they are stored: nothing is shuffled for a meeting.
    """
    one, two = (blocks.select(*[F.col(c).alias(f"{c}_{n}") for c in blocks.columns]) for n in (1, 2))
    wanted = (F.col("key_1") == F.col("key_2")) & (F.col("block_1") <= F.col("block_2")) & ~F.col("visits_1")
    pairs = one.hint("shuffle_replicate_nl").join(two, wanted)

    def opened(batch: pa.RecordBatch, row: int, side: int) -> _Block:
        ids, vectors, earlier = (np.frombuffer(batch.column(f"{c}_{side}")[row].as_buffer(), t) for c, t in (("nodes", "<i8"), ("vectors", kind), ("earlier", "<i8")))
        return _Block(ids, vectors.reshape(-1, width).astype(np.float64), earlier.reshape(len(ids), -1))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            itself = batch.column("block_1").to_numpy() == batch.column("block_2").to_numpy()
            for row in range(batch.num_rows):
                one = opened(batch, row, 1)
                found = _meet(one, one if itself[row] else opened(batch, row, 2), threshold)
                held, rows = held + [found], rows + len(found[0])
                if rows > SLAB:
                    held = [_joined(held)]
                    rows = len(held[0][0])
                    if 2 * rows > SLAB:
                        yield from _told(*held.pop()).to_batches()
                        rows = 0
        if held:
            yield from _told(*_joined(held)).to_batches()

    return pairs.select(*[f"{c}_{n}" for n in (1, 2) for c in ("block", "nodes", "vectors", "earlier")]).mapInArrow(meet, told)


class _Block:
    """Nodes that meet others: ids, vectors, and the places of earlier tables that each has been to."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, earlier: np.ndarray):
        self.ids, self.vectors, self.earlier = ids, vectors, earlier
        self.units = unit_rows(vectors)
        self.short = self.units.astype(np.float32)


def _near(one: _Block, two: _Block, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of linked rows in ``one`` and ``two``, slab by slab; of a block and itself every pair once.

    Products of single precision leave out what is surely not linked; where their error could matter, doubles decide.
    """
    # The error of a product of unit vectors is at most the width and a few times 2^-24; this is twice as much.
    error = (one.units.shape[1] + 8) * 2.0**-23
    goals, start = two.short.T, 0
    while start < len(one.ids):
        first = start if one is two else 0
        stop = start + max(1, SLAB // max(1, len(two.ids) - first))
        scores = one.short[start:stop] @ goals[:, first:]
        hits = np.flatnonzero(scores >= threshold - error)
        left, right = np.divmod(hits, scores.shape[1])
        unsure = np.flatnonzero(scores.ravel()[hits] < threshold + error)
        left, right = left + start, right + first
        kept = right > left if one is two else np.ones(len(left), bool)
        some = max(1, SLAB // (4 * one.units.shape[1]))
        for begin in range(0, len(unsure), some):
            at = unsure[begin : begin + some]
            exact = np.einsum("ij,ij->i", one.units[left[at]], two.units[right[at]])
            kept[at] &= np.round(exact, RANK_DIGITS) >= threshold
        yield left[kept], right[kept]
        start = stop


def _meet(one: _Block, two: _Block, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked nodes of two blocks, or of one: their ids, links, and the smallest id that each hangs together with."""
    ids, after = (one.ids, 0) if one is two else (np.concatenate([one.ids, two.ids]), len(one.ids))
    links, hung = np.zeros(len(ids), np.int64), _Hung(ids)
    for left, right in _near(one, two, threshold):
        hung.link(left, right + after)
        # A pair counts in the first table in which it meets.
        first = np.ones(len(left), bool)
        for a, b in zip(one.earlier.T, two.earlier.T):
            first &= a[left] != b[right]
        links += np.bincount(left[first], minlength=len(ids)) + np.bincount(right[first] + after, minlength=len(ids))
    return ids[hung.told], links[hung.told], hung.least()[hung.told]


def _joined(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What several meetings have found, with one row per node."""
    ids, links, least = (np.concatenate(parts) for parts in zip(*found))
    every, place = np.unique(np.concatenate([ids, least]), return_inverse=True)
    hung, counts = _Hung(every), np.zeros(len(every), np.int64)
    hung.link(place[: len(ids)], place[len(ids) :])
    np.add.at(counts, place[: len(ids)], links)
    return every[hung.told], counts[hung.told], hung.least()[hung.told]


def _told(ids: np.ndarray, links: np.ndarray, least: np.ndarray) -> pa.Table:
    return pa.table([pa.array(a) for a in (ids, links, least)], ["node", "links", "least"])


Dealt = tuple[DataFrame, DataFrame, DataFrame]


def _by_cells(nodes: DataFrame, width: int, threshold: float, centres: np.ndarray, most: int) -> Dealt:
    """Nodes dealt to their cells and those they visit, with blocks of ``most`` nodes.

    Returns nodes of cells of one block without visitors, those of crowds (members meet each other and visitors), and the sizes of crowds.
    """
    centres = np.ascontiguousarray(centres)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
        for batch in batches:
            own, visits = cells_of(unit_rows(to_matrix(batch.column("vector"), width)), centres, threshold)
            wanted = visits.copy()
            wanted[np.arange(len(own)), own] = True
            row, key = np.nonzero(wanted)
            yield batch, row, key.astype(np.int64), visits[row, key]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, row, key, visits in places(batches):
            columns = [pa.array(key), pa.array(visits), *[batch.column(c).take(pa.array(row)) for c in ("node", "vector")]]
            yield pa.RecordBatch.from_arrays(columns, ["key", "visits", "node", "vector"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, key, visits in places(batches):
            numbers = [np.bincount(key[v], minlength=len(centres)) for v in (~visits, visits)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(centres))), *map(pa.array, numbers)], ["key", "members", "visitors"])

    kind = nodes.schema["vector"].dataType.simpleString()
    counts = nodes.select("vector").mapInArrow(count, "key long, members long, visitors long").groupBy("key").agg(F.sum("members").alias("members"), F.sum("visitors").alias("visitors"))
    cut = [F.ceil(F.col(c) / most).cast("int").alias(n) for c, n in (("members", "blocks"), ("visitors", "guests"))]
    # A cell that nobody belongs to has visitors only, and no block that they could meet.
    counts = cut_lineage(counts.where("members > 0").select("key", (F.col("members") + F.col("visitors")).alias("n"), *cut))
    placed = nodes.select("node", "vector").mapInArrow(place, f"key long, visits boolean, node long, vector {kind}")
    placed = placed.join(F.broadcast(counts.drop("n")), "key").withColumn("earlier", F.array().cast("array<long>"))
    draw = F.xxhash64("node", "key")
    block = F.when(F.col("visits"), F.col("blocks") + F.pmod(draw, "guests")).otherwise(F.pmod(draw, "blocks")).cast("int")
    one = "blocks = 1 and guests = 0"
    crowds = counts.where(f"not ({one})").select("key", "n", (F.col("blocks") + F.col("guests")).alias("blocks"))
    return placed.where(one), placed.where(f"not ({one})").withColumn("block", block), crowds


def _by_tables(nodes: DataFrame, width: int, signs: int, tables: int, seed: int, most: int) -> Dealt:
    """Nodes dealt to their buckets, one a table, with the buckets of earlier tables; what it returns is as with cells."""
    directions = np.random.default_rng(seed).standard_normal((width, tables * signs))
    powers = 1 << np.arange(signs, dtype=np.int64)

    @arrow_udf("array<long>")
    def buckets(vectors: pa.Array) -> pa.Array:
        above = (to_matrix(vectors, width) @ directions > 0).reshape(-1, tables, signs)
        # A key names its table as well, so that keys of different tables never meet.
        keys = (above @ powers) + (np.arange(tables, dtype=np.int64) << signs)
        offsets = np.arange(len(keys) + 1, dtype=np.int32) * np.int32(tables)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))

    keyed = cut_lineage(nodes.select("node", "vector", buckets("vector").alias("keys")))
    sizes = cut_lineage(keyed.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    sent = keyed.select("node", "vector", "keys", F.posexplode("keys").alias("table", "key"))
    sent = sent.select("key", "node", "vector", F.slice("keys", 1, F.col("table")).alias("earlier"), F.lit(False).alias("visits"))
    # Nodes that nobody shares a bucket with are not sent anywhere.
    few = sent.join(broadcast_if_small(sizes.where(F.col("n").between(2, most)).select("key")), "key")
    crowds = sizes.where(F.col("n") > most).withColumn("blocks", F.ceil(F.col("n") / most).cast("int"))
    crowded = sent.join(broadcast_if_small(crowds.select("key", "blocks")), "key")
    return few, crowded.withColumn("block", F.pmod(F.xxhash64("node", "key"), "blocks").cast("int")), crowds


class _Hung:
    """The smallest id that links connect each place with; links come in slabs, and are not kept."""

    def __init__(self, ids: np.ndarray):
        self.order = np.argsort(ids, kind="stable")
        self.ids = ids[self.order]
        self.place = np.empty_like(self.order)
        self.place[self.order] = np.arange(len(ids))
        self.label = np.arange(len(ids))
        self.told = np.zeros(len(ids), bool)

    def link(self, left: np.ndarray, right: np.ndarray) -> None:
        self.told[left] = self.told[right] = True
        a, b = self.label[self.place[left]], self.label[self.place[right]]
        open_ = a != b
        if not open_.any():
            return
        # Links between places that hang together already are settled; of the others one a pair of labels is enough.
        a, b = np.divmod(np.unique(np.minimum(a, b)[open_] * len(self.ids) + np.maximum(a, b)[open_]), len(self.ids))
        label = np.arange(len(self.ids))
        while True:
            lower = label.copy()
            np.minimum.at(lower, a, label[b])
            np.minimum.at(lower, b, label[a])
            lower = lower[lower]
            if (lower == label).all():
                break
            label = lower
        self.label = label[self.label]

    def least(self) -> np.ndarray:
        return self.ids[self.label[self.place]]
