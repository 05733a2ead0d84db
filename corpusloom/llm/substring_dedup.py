"""Removing repeated passages by hash: the earliest occurrence stays, offsets of what is left are kept.

Units are sentences (or lines, or paragraphs), normalised to words. The digest of a unit covers the run of units from it on that
reaches ``min_words`` words, so short units count as members of a passage and none is removed for itself. Digests are grouped over all
documents; every run that has occurred before is removed with its units.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.common import stored

# Where a unit ends. A single line break ends no sentence, so a passage may be wrapped in any way.
SENTENCE, LINE, PARAGRAPH = r"[.!?…]+[\"')\]]*[ \t\r\n\f]+|\n[ \t\r\n\f]*\n", "\n", r"\n[ \t\r\f]*\n[ \t\r\n\f]*"
# What makes no difference between two units: anything but letters and digits, and case.
_WORD = re.compile(r"[^\W_]+")


def units(text: str, ends: re.Pattern, longest: int | None) -> tuple[list[int], list[int], list[str]]:
    """Where every unit starts in the text, which of the words it starts with, and all words, in lower case.

    A unit of more than ``longest`` words is cut before each word whose CRC is divisible by eight: by what it says, not by its
    length, so that one passage is cut alike in every surrounding. A unit lasts until the next one; stretches without
    words belong to the unit before.
    """
    starts, firsts, words, at = [], [], [], 0
    for end in [*(m.end() for m in ends.finditer(text)), len(text)]:
        found = _WORD.findall(text, at, end)
        if found:
            starts.append(at)
            firsts.append(len(words))
            lowered = [w.lower() for w in found]
            if longest is not None and len(found) > longest:
                places = [m.start() for m in _WORD.finditer(text, at, end)]
                cuts = [n for n in range(1, len(lowered)) if zlib.crc32(lowered[n].encode("utf-8", "replace")) % 8 == 0]
                starts += [places[n] for n in cuts]
                firsts += [len(words) + n for n in cuts]
            words += lowered
        at = end
    if starts:
        starts[0] = 0
    return starts, firsts, words


def runs(text: str, ends: re.Pattern, longest: int | None, min_words: int) -> Iterator[tuple[int, int, int]]:
    """Start and end in the text, and digest, of the shortest run of units from every unit on that has ``min_words`` words."""
    starts, firsts, words = units(text, ends, longest)
    stops, upto = np.array([*starts[1:], len(text)]), np.array([*firsts[1:], len(words)])
    if not starts:
        return
    last = np.searchsorted(upto, np.array(firsts) + min_words)
    for start, first, stop, end in zip(starts, firsts, *((a[last[last < len(upto)]]).tolist() for a in (stops, upto))):
        yield start, stop, xxhash.xxh3_128_intdigest(" ".join(words[first:end]).encode("utf-8", "replace"))


def repeated_units(
    docs: DataFrame,
    separator: str = SENTENCE,
    min_words: int = 30,
    longest: int | None = 12,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Documents without the passages that an earlier document, or an earlier place, already has.

    A passage is a run of units (stretches that end with a match of ``separator``, see :func:`units`) of at least ``min_words``
    words; runs are equal if their words are, case, punctuation and line breaks aside. Fewer repeated words are left. The rank of an
    occurrence is its document's id, then a hash of its text (only for rows that repeat an id), then its place; a run that overlaps its
    own earlier occurrence stays. Rows equal in id and text count as one and get the same result; null ids rank last. Null text
    stays null, empty text empty. Other columns are not read. What is left is untouched.

    Digests and places are stored once. Repeated digests are counted with numbers only, partial counts first; the few that hold
    over a thousandth of all places are met where the places lie, the others by a shuffle. Columns: the id, ``text`` (what is
    left), ``n_removed`` (stretches), ``removed_chars``, ``spans``: start and end in the original text of every stretch that is left.
    """
    ends = re.compile(separator)
    text = F.col(text_column)
    rows = docs.select(F.col(id_column).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("_text_hash"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "_text_hash", "start", "stop", "high", "low"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, starts, stops, digests = [], [], [], []
            for row, value in enumerate(batch.column(1).to_pylist()):
                for start, stop, code in runs(value, ends, longest, min_words) if value else ():
                    of.append(row)
                    starts.append(start)
                    stops.append(stop)
                    digests.append(code.to_bytes(16, "little"))
            taken, halves = pa.array(of, pa.int64()), np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            places = [pa.array(starts, pa.int32()), pa.array(stops, pa.int32())]
            columns = [batch.column(0).take(taken), batch.column(2).take(taken), *places, pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())]
            yield pa.RecordBatch.from_arrays(columns, names)

    places = stored(rows.mapInArrow(digest, f"doc_id {kind}, _text_hash long, start int, stop int, high long, low long"))
    key = ["high", "low"]
    often = places.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.min("doc_id").alias("_first_id"))
    often = stored(often.where(F.col("_n") > 1))
    total = places.count()
    hot = F.broadcast(often.where(F.col("_n") * 1000 > total))
    rest = often.where(F.col("_n") * 1000 <= total)
    hot_keys = hot.select(*[F.col(c).alias(f"_{c}") for c in key])
    is_hot = (F.col("high") == F.col("_high")) & (F.col("low") == F.col("_low"))
    cold = places.join(F.broadcast(hot_keys), is_hot, "left_anti")
    again = stored(places.join(hot, key).unionByName(cold.join(rest, key)).drop("_n"))
    # The earliest place lies in the document of the smallest id; only its places are looked at.
    earliest = F.struct(F.col("_text_hash").alias("_first_hash"), F.col("start").alias("_first_start"), F.col("stop").alias("_first_stop"))
    firsts = again.where(F.col("doc_id").eqNullSafe(F.col("_first_id"))).groupBy(*key).agg(F.min(earliest).alias("_first"), F.max("_first_id").alias("_of"))
    hot_firsts = F.broadcast(firsts.join(F.broadcast(hot_keys), is_hot, "left_semi"))
    cold_again = again.join(F.broadcast(hot_keys), is_hot, "left_anti")
    met = again.join(hot_firsts, key).unionByName(cold_again.join(firsts, key)).select(*names, "_first.*", "_of")
    same_text = F.col("doc_id").eqNullSafe(F.col("_of")) & (F.col("_text_hash") == F.col("_first_hash"))
    losers = met.where(~same_text | (F.col("start") >= F.col("_first_stop")))
    losers = losers.groupBy("doc_id", "_text_hash").agg(F.collect_set(F.struct("start", "stop")).alias("_gone"))
    losers = losers.select(F.col("doc_id").alias("_loser"), F.col("_text_hash").alias("_loser_hash"), "_gone")
    same = F.col("doc_id").eqNullSafe(F.col("_loser")) & (F.col("_text_hash") == F.col("_loser_hash"))
    joined = rows.join(losers, same, "left").select("doc_id", "text", "_gone")
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed, chars, spans = [], [], [], []
            for value, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                left, stretches, at = [], 0, 0
                for start, stop in sorted((g["start"], g["stop"]) for g in gone or ()):
                    if start > at:
                        left.append((at, start))
                    stretches += start > at or stretches == 0
                    at = max(at, stop)
                if value is not None and at < len(value):
                    left.append((at, len(value)))
                texts.append(value if not gone else "".join([value[a:b] for a, b in left]))
                removed.append(stretches)
                chars.append(len(value or "") - sum(b - a for a, b in left))
                spans.append([{"start": a, "end": b} for a, b in left])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(removed, pa.int64()), pa.array(chars, pa.int64()), pa.array(spans, span)],
                [id_column, "text", "n_removed", "removed_chars", "spans"],
            )

    return joined.mapInArrow(cut, f"`{id_column}` {kind}, text string, n_removed long, removed_chars long, spans array<struct<start: long, end: long>>")
