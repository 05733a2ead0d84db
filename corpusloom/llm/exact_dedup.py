"""Exact duplicates by counting quotient filters: fingerprints that occur once are let go, the others are compared byte by byte.

Every task builds a counting quotient filter of the fingerprints it sees: a fingerprint is cut into a quotient, which names a run, and
a remainder, which stands sorted in its run with a count. Filters of one range of quotients merge without loss, run by run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.common import stored

# Fingerprints a task gathers before it hands on its filter, and those of a range, about: memory only. Ranges at least.
FILTER_ITEMS, RANGE_ITEMS, LEAST_RANGE_BITS = 1 << 20, 1 << 20, 6
# Bits of the map of repeated quotients that every task gets, at most (8 MB).
MAP_BITS = 26


def lowered(raw: bytes) -> bytes:
    """A text as it is compared: A-Z in lower case, all else untouched (UTF-8 keeps these bytes for them alone)."""
    return raw.lower()


class CountingQuotientFilter:
    """Counts of fingerprints of ``bits`` bits. The top bits of a fingerprint, as many as suit the number of items, are its
    quotient and choose a run; the rest is its remainder.

    Held as the length of every run, and the remainders and counts run after run, sorted. No bit is lost, so a merge of two
    filters, also of different quotients, is the filter of both inputs.
    """

    def __init__(self, runs: np.ndarray, remainders: np.ndarray, counts: np.ndarray, bits: int) -> None:
        self.runs, self.remainders, self.counts, self.bits = runs, remainders, counts, bits
        self.remainder_bits = bits - (len(runs).bit_length() - 1)

    @classmethod
    def of(cls, fingerprints: np.ndarray, counts: np.ndarray, bits: int) -> CountingQuotientFilter:
        """The filter of fingerprints, each with a count; repeated ones add up."""
        order = np.argsort(fingerprints, kind="stable")
        fingerprints, counts = fingerprints[order], counts[order]
        if len(fingerprints):
            first = np.flatnonzero(np.r_[True, fingerprints[1:] != fingerprints[:-1]])
            fingerprints, counts = fingerprints[first], np.add.reduceat(counts, first)
        quotient_bits = min(len(fingerprints).bit_length(), bits)
        rest = np.uint64(bits - quotient_bits)
        runs = np.bincount((fingerprints >> rest).astype(np.int64) if quotient_bits else np.zeros(len(fingerprints), np.int64), minlength=1 << quotient_bits)
        return cls(runs, fingerprints & ((np.uint64(1) << rest) - np.uint64(1)) if rest < 64 else fingerprints, counts, bits)

    def fingerprints(self) -> np.ndarray:
        """All fingerprints, ascending."""
        if len(self.runs) == 1:
            return self.remainders
        return np.repeat(np.arange(len(self.runs), dtype=np.uint64), self.runs) << np.uint64(self.remainder_bits) | self.remainders

    def merged(self, others: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        """One filter of all. Every part is sorted by quotient and remainder already, so the stable sort merges runs."""
        every = [self, *others]
        return self.of(np.concatenate([f.fingerprints() for f in every]), np.concatenate([f.counts for f in every]), self.bits)

    def to_bytes(self) -> tuple[bytes, bytes, bytes]:
        """Run lengths in unary (a bit per item, a closing bit per run), remainders in as few bytes as they need, and the counts
        above one with their places."""
        marks = np.zeros(len(self.remainders) + len(self.runs), np.uint8)
        marks[np.cumsum(self.runs) + np.arange(len(self.runs))] = 1
        wide = -(-self.remainder_bits // 8)
        body = np.ascontiguousarray(self.remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide])
        more = np.flatnonzero(self.counts > 1)
        return np.packbits(marks).tobytes(), body.tobytes(), np.stack([more, self.counts[more]]).astype("<i8").tobytes()

    @classmethod
    def from_bytes(cls, items: int, marks: bytes, body: bytes, more: bytes, bits: int) -> CountingQuotientFilter:
        quotient_bits = min(items.bit_length(), bits)
        wide = -(-(bits - quotient_bits) // 8)
        remainders = np.zeros((items, 8), np.uint8)
        remainders[:, :wide] = np.frombuffer(body, np.uint8).reshape(items, wide)
        closing = np.flatnonzero(np.unpackbits(np.frombuffer(marks, np.uint8), count=items + (1 << quotient_bits)))
        counts = np.ones(items, np.int64)
        places, values = np.frombuffer(more, "<i8").reshape(2, -1)
        counts[places] = values
        return cls(np.diff(np.r_[-1, closing]) - 1, remainders.view("<u8").ravel(), counts, bits)


def repeated_fingerprints(prints: DataFrame, rows: int) -> DataFrame:
    """Fingerprints (column ``fingerprint``) that occur more than once, with ``copies``.

    Every task builds filters, one per range of fingerprints; ranges are merged on their own and hold about ``RANGE_ITEMS``
    fingerprints at any size of the table. A fingerprint of a third of all rows is one entry per filter.
    """
    range_bits = max(LEAST_RANGE_BITS, (rows // RANGE_ITEMS).bit_length())
    bits = 64 - range_bits

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def handed_on(held: list[np.ndarray]) -> pa.RecordBatch:
            found = np.sort(np.concatenate(held))
            ranges = (found >> np.uint64(bits)).astype(np.int64)
            starts = np.flatnonzero(np.r_[True, ranges[1:] != ranges[:-1]])
            below, out = found & np.uint64((1 << bits) - 1), []
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(found)]):
                own = CountingQuotientFilter.of(below[start:end], np.ones(end - start, np.int64), bits)
                out.append((int(ranges[start]), len(own.counts), *own.to_bytes()))
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            names = ["range", "items", "marks", "body", "more"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
                size += len(held[-1])
            if size >= FILTER_ITEMS:
                yield handed_on(held)
                held, size = [], 0
        if size:
            yield handed_on(held)

    def merge(key: tuple[pa.Scalar, ...], filters: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = None
        for batch in filters:
            parts = [CountingQuotientFilter.from_bytes(*[r[c] for c in ("items", "marks", "body", "more")], bits) for r in batch.to_pylist()]
            if parts:
                whole = (whole or parts.pop()).merged(parts)
        often = whole.counts > 1
        full = whole.fingerprints()[often] | np.uint64(key[0].as_py() << bits)
        yield pa.RecordBatch.from_arrays([pa.array(full.view(np.int64)), pa.array(whole.counts[often])], ["fingerprint", "copies"])

    filters = prints.select("fingerprint").mapInArrow(build, "range long, items long, marks binary, body binary, more binary")
    return filters.groupBy("range").applyInArrow(merge, "fingerprint long, copies long")


def _repeated_map(repeated: DataFrame, rows: int) -> tuple[np.ndarray, int]:
    """A bit per quotient, set where a repeated fingerprint falls: about 16 quotients a row, 2 ** ``MAP_BITS`` at most.

    Bits of other fingerprints that fall there only cost a needless look at a text. The map has a fixed size at every scale.
    """
    bits = min(MAP_BITS, max(10, (16 * rows).bit_length()))
    slots = repeated.select(F.shiftrightunsigned("fingerprint", 64 - bits).alias("slot"))
    words = slots.groupBy(F.expr("slot div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("set"))
    found, table = words.toArrow(), np.zeros(1 << (bits - 6), np.int64)
    table[found.column("word").to_numpy()] = found.column("set").to_numpy()
    return table.view(np.uint64), bits


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", fingerprint_bits: int = 64) -> DataFrame:
    """Class and survivor of every row: texts are equal when their bytes are, A-Z in lower case; null counts as empty.

    One pass hashes every text (fingerprint and SHA-256; a narrow table is stored). The merged filters name the repeated
    fingerprints; texts whose quotient is among theirs are read again, and those with a repeated fingerprint are grouped by
    fingerprint and whole text, with partial groups first, so that a group of any size leaves a task as one row. Two texts
    with one fingerprint stay apart. ``fingerprint_bits`` below 64 makes such collisions, for tests.

    Of equal texts the row with the largest id stays (nulls smallest), one row where rows repeat that id. Empty tables give empty
    results; other columns are not read. Columns: the id, ``keep_id`` (id of the row that stays), ``group_size``, ``kept``, ``text_sha256``.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    shift = 64 - fingerprint_bits
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(text_column, F.lit("")).cast("binary").alias("text"))

    def fingerprint(raw: bytes) -> int:
        return xxhash.xxh3_64_intdigest(raw) >> shift << shift

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [lowered(t) for t in batch.column(1).to_pylist()]
            prints = np.fromiter(map(fingerprint, texts), np.uint64, len(texts)).view(np.int64)
            digests = pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints), digests], ["doc_id", "fingerprint", "text_sha256"])

    prints = rows.mapInArrow(hashed, f"doc_id {kind}, fingerprint long, text_sha256 string")
    prints = stored(prints.withColumn("row", F.monotonically_increasing_id()))
    total = prints.count()
    repeated = stored(repeated_fingerprints(prints, total))
    bitmap, bits = _repeated_map(repeated, total)
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap)

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = wanted.value
        for batch in batches:
            texts = [lowered(t) for t in batch.column(1).to_pylist()]
            found = np.fromiter(map(fingerprint, texts), np.uint64, len(texts))
            slots = found >> np.uint64(64 - bits)
            at = np.flatnonzero(table[(slots >> np.uint64(6)).astype(np.int64)] >> (slots & np.uint64(63)) & np.uint64(1))
            picked = pa.array([texts[n] for n in at.tolist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(found[at].view(np.int64)), picked], ["doc_id", "fingerprint", "text"])

    routed = rows.mapInArrow(suspects, f"doc_id {kind}, fingerprint long, text binary")
    classes = routed.groupBy("fingerprint", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    classes = classes.where(F.col("group_size") > 1).select("fingerprint", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
    return _decided(prints, stored(classes), repeated, total).select(F.col("doc_id").alias(id_column), "keep_id", "group_size", "kept", "text_sha256")


def _decided(prints: DataFrame, classes: DataFrame, repeated: DataFrame, total: int) -> DataFrame:
    """Every row with its class. Rows of fingerprints that hold over a thousandth of the table stay where they are: fewer than a
    thousand such fingerprints can exist, so their classes are broadcast. Whether classes may be told apart by their digests
    is checked."""
    if not classes.groupBy("fingerprint", "text_sha256").count().where(F.col("count") > 1).isEmpty():
        raise ValueError("two different texts share a SHA-256")
    # Of rows that repeat the largest id one stays, by the stored row number.
    often = repeated.where(F.col("copies") * 1000 > total).select(F.col("fingerprint").alias("_hot"))
    key = ["fingerprint", "text_sha256"]
    newest = prints.groupBy(*key).agg(F.coalesce(F.max_by("row", "doc_id"), F.max("row")).alias("_keep_row"), F.count(F.lit(1)).alias("_n"))
    classes = stored(classes.join(newest.where(F.col("_n") > 1).drop("_n"), key))
    is_hot = F.col("fingerprint") == F.col("_hot")
    hot, cold = (prints.join(F.broadcast(often), is_hot, how) for how in ("left_semi", "left_anti"))
    hot_classes = F.broadcast(classes.join(F.broadcast(often), is_hot, "left_semi"))
    met = hot.join(hot_classes, key, "left").unionByName(cold.join(classes, key, "left"))
    single = F.col("_keep_row").isNull()
    return met.select(
        "doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), (single | (F.col("row") == F.col("_keep_row"))).alias("kept"), "text_sha256",
    )
