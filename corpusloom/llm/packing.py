"""Packing documents into sequences of bounded length: best fit, then swap-based local search.

The pieces of all documents are stored once (a narrow table), dealt to shards of bounded size by a hash, and packed
shard by shard. Sequences that stayed underfull are opened, gathered in fewer shards and packed again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from corpusloom.llm.common import stored
from corpusloom.llm.token_counts import BatchTokenizer, vocabulary_bytes

# Pieces in a shard at most, about; exchanges tried in a shard without any gain before it is left.
SHARD_PIECES, PATIENCE = 16_384, 64


def token_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int, closing_id: int = 0, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Documents as token ids closed by ``closing_id``, cut into pieces of ``capacity`` where they are longer.

    Columns: the id, ``piece``, ``start``, ``length``, ``ids_crc32`` of the little-endian ids. No shuffle.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(vocabulary_bytes(tokenizer_path))
    closing = np.array([closing_id], "<u4")
    kind = docs.schema[id_column].dataType.simpleString()
    names = [id_column, "piece", "start", "length", "ids_crc32"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = BatchTokenizer(vocabulary.value)
        for batch in batches:
            of, piece, start, length, crc = [], [], [], [], []
            for row, ids in enumerate(tokenizer.encode(batch.column(1))):
                ids = np.r_[ids, closing]
                for number, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    of.append(row)
                    piece.append(number)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part))
            columns = [batch.column(0).take(pa.array(of, pa.int64())), pa.array(piece, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(id_column, text_column).mapInArrow(
        cut, f"`{id_column}` {kind}, piece int, start long, length long, ids_crc32 long"
    )


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item numbers: items by falling size, each into the fullest bin that holds it."""
    bins: list[list[int]] = []
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by room left
    rooms = 0  # bit r is set if a bin has r left
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            number = waiting[room].pop()
            if not waiting[room]:
                rooms &= ~(1 << room)
            bins[number].append(item)
        else:
            number, room = len(bins), capacity
            bins.append([item])
        if room > size:
            waiting[room - size].append(number)
            rooms |= 1 << (room - size)
    return bins


class LocalSearch:
    """Exchanges between underfull bins that raise the sum of squared fills, until bins fall empty.

    The emptiest bin gives: it moves an item, swaps one for one, two for one or one for two with another underfull
    bin so that the other gets fuller. Each step takes the exchange that carries most tokens over; a giver that can give
    no more is left until another exchange has changed something, and the next one tried. It ends at the fewest bins
    possible, or after ``patience`` givers in a row that could not be emptied.
    """

    def __init__(self, bins: list[list[int]], sizes: np.ndarray, capacity: int) -> None:
        self.sizes, self.capacity = sizes, capacity
        self.bins = [list(b) for b in bins]
        self.fill = np.array([int(sizes[b].sum()) for b in bins], np.int64)
        self.fewest = -(-int(sizes.sum()) // capacity)

    def run(self, patience: int = PATIENCE) -> list[list[int]]:
        used, failed, stuck = int((self.fill > 0).sum()), 0, np.zeros(len(self.bins), bool)
        while used > self.fewest and failed < patience:
            givers = np.flatnonzero((self.fill > 0) & (self.fill < self.capacity) & ~stuck)
            if not len(givers):
                break
            giver = int(givers[np.argmin(self.fill[givers])])
            changed = False
            while self.bins[giver] and self._step(giver):
                changed = True
            if self.bins[giver]:
                if changed:
                    stuck[:] = False  # there is other room now
                stuck[giver] = True
                failed += 1
            else:
                used, failed = used - 1, 0
        return [b for b in self.bins if b]

    def _step(self, giver: int) -> bool:
        """The best exchange of ``giver`` with any fuller bin with room; False if there is none."""
        others = np.flatnonzero((self.fill < self.capacity) & (self.fill >= self.fill[giver]))
        others = others[others != giver]
        if not len(others):
            return False
        own = np.array(self.bins[giver])
        room = self.capacity - self.fill[others]
        give = [(int(s), (int(i),)) for i, s in zip(own, self.sizes[own])]
        if len(own) <= 48:
            give += [(int(self.sizes[a] + self.sizes[b]), (int(a), int(b))) for n, a in enumerate(own) for b in own[n + 1 :]]
        # What each other bin can give back: nothing, one item, or two items.
        counts = np.array([len(self.bins[b]) for b in others])
        back = np.concatenate([self.bins[b] for b in others])
        of = np.repeat(np.arange(len(others)), counts)
        nothing = np.zeros(len(others), np.int64)
        choices = np.r_[nothing, self.sizes[back]]
        where = np.r_[np.arange(len(others)), of]
        best = (0, None, None)
        order = np.argsort(choices, kind="stable")
        choices, where = choices[order], where[order]
        for size, items in give:
            gain = size - choices
            gain[gain > room[where]] = 0
            if len(items) == 2:
                gain[order < len(others)] = 0  # two items for nothing are two moves
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (int(gain[at]), items, int(order[at]))
        pairs = self._two_back(others, room, give[: len(own)], best[0])
        if pairs:
            gain, item, other, two = pairs
            self._exchange(giver, other, (item,), two)
            return True
        if not best[0]:
            return False
        _, items, at = best
        if at < len(others):
            self._exchange(giver, int(others[at]), items, ())
        else:
            self._exchange(giver, int(others[of[at - len(others)]]), items, (int(back[at - len(others)]),))
        return True

    def _two_back(self, others: np.ndarray, room: np.ndarray, give: list, least: int) -> tuple | None:
        """One item of the giver for two of another bin, if that carries more than ``least``. Looks at the roomiest bins."""
        best = None
        for n in np.argsort(-room, kind="stable")[:64].tolist():
            if room[n] <= least:
                break
            items = np.array(self.bins[others[n]])
            if not 2 <= len(items) <= 48:
                continue
            a, b = np.triu_indices(len(items), 1)
            both = self.sizes[items[a]] + self.sizes[items[b]]
            for size, (item,) in give:
                gain = size - both
                gain[gain > room[n]] = 0
                at = int(np.argmax(gain))
                if gain[at] > least:
                    least = int(gain[at])
                    best = (least, item, int(others[n]), (int(items[a[at]]), int(items[b[at]])))
        return best

    def _exchange(self, giver: int, other: int, there: tuple, back: tuple) -> None:
        for a, b, items in ((giver, other, there), (other, giver, back)):
            for item in items:
                self.bins[a].remove(item)
                self.bins[b].append(item)
                self.fill[a] -= self.sizes[item]
                self.fill[b] += self.sizes[item]


def _pack_shards(pieces: DataFrame, capacity: int, seed: int, columns: list[str]) -> DataFrame:
    """Bin number and offset for pieces shorter than ``capacity``, shard by shard; adds ``_shard``, ``_bin``, ``_at``, ``_fill``."""
    shards = max(1, -(-pieces.count() // SHARD_PIECES))
    # By row, not by id: rows that repeat an id, or have none, are spread like all others.
    dealt = pieces.withColumn("_shard", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(seed)), F.lit(shards)).cast("int"))
    schema = StructType([*dealt.schema.fields, StructField("_bin", IntegerType()), StructField("_at", LongType()), StructField("_fill", LongType())])
    names = schema.names

    def pack(table: pa.Table) -> pa.Table:
        order = [(c, "ascending") for c in ("length", *columns)]
        table = table.sort_by(order)  # the same bins on every run
        sizes = table.column("length").to_numpy().astype(np.int64)
        bins = LocalSearch(best_fit(sizes, capacity), sizes, capacity).run()
        number, at, fill = (np.zeros(len(sizes), np.int64) for _ in range(3))
        for n, items in enumerate(bins):
            ends = np.cumsum(sizes[items])
            number[items], at[items], fill[items] = n, ends - sizes[items], ends[-1]
        added = [pa.array(number.astype(np.int32)), pa.array(at), pa.array(fill)]
        return pa.Table.from_arrays([*table.columns, *added], names=names)

    return dealt.groupBy("_shard").applyInArrow(pack, schema)


def pack(pieces: DataFrame, capacity: int, columns: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """Give every piece a ``sequence_id`` and a gapless ``offset`` in a sequence of at most ``capacity`` tokens.

    ``pieces`` has ``length`` (1 to ``capacity``) and ``columns`` that tell pieces apart. Stores two narrow tables and
    counts them. A piece of full length is a sequence of its own. Repeated rows are packed as often as they occur; an empty
    table gives an empty result.
    """
    keep = pieces.columns
    whole = pieces.where(F.col("length") == capacity)
    alone = whole.select(*keep, (-F.monotonically_increasing_id() - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    first = stored(_pack_shards(pieces.where(F.col("length") < capacity), capacity, 1, list(columns)))
    # Sequences with room for more are opened again; where one shard held all there is nothing to gain.
    again = first.where(F.col("_fill") < capacity * 0.97)
    number = lambda way: (F.col("_shard").cast("long") * (1 << 32) + F.col("_bin")) * 2 + way
    result = lambda df, way: df.select(*keep, number(way).alias("sequence_id"), F.col("_at").alias("offset"))
    if first.where(F.col("_shard") > 0).isEmpty():
        return alone.unionByName(result(first, 0))
    second = _pack_shards(again.select(*keep), capacity, 2, list(columns))
    return alone.unionByName(result(first.where(F.col("_fill") >= capacity * 0.97), 0)).unionByName(result(second, 1))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int) -> DataFrame:
    """Tokenise, cut and pack whole documents; see :func:`token_pieces` and :func:`pack`. Stores the pieces.

    Null and empty texts are one piece, the closing id. Null ids stay. Columns that are not needed are not read.
    """
    return pack(stored(token_pieces(docs, tokenizer_path, capacity)), capacity)
