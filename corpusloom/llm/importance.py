"""Drawing the documents that look most like a target: hashed word runs, importance weights, Gumbel draws.

Words and their places come from the tokenizers library: an untrained split by a pattern over lower-cased text. Windows of neighbouring
places are features, hashed to buckets; what the target has more of than the corpus gains, what it has less of loses.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.llm.common import positions, stored

# What is a word, and what is none.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BETWEEN = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
# Characters that are split at a time, about, and runs whose bucket a task remembers. Memory only.
STRETCH, REMEMBERED = 1 << 20, 1 << 20


class RunBuckets:
    """Buckets of all runs of 1 to ``longest`` words of a text."""

    def __init__(self, longest: int, buckets: int) -> None:
        from tokenizers import Regex
        from tokenizers.pre_tokenizers import Split

        self.split = Split(Regex(WORD), behavior="removed", invert=True)
        self.longest, self.buckets = longest, buckets
        self.known: dict[str, int] = {}

    def words(self, raw: bytes) -> tuple[str, list[tuple[int, int]]]:
        """The text, A-Z in lower case, and start and end of every word in it. Long texts are cut between words."""
        text, spans, start = raw.lower().decode("utf-8", "replace"), [], 0
        while start < len(text):
            cut = _BETWEEN.search(text, start + STRETCH)
            end = cut.end() if cut else len(text)
            spans += [(a + start, b + start) for _, (a, b) in self.split.pre_tokenize_str(text[start:end])]
            start = end
        return text, spans

    def of(self, raw: bytes) -> tuple[int, np.ndarray]:
        """The number of words, and the bucket of every run, repeats included: windows over the places of the words."""
        text, spans = self.words(raw)
        single = [text[a:b] for a, b in spans]
        runs = single
        for n in range(2, self.longest + 1):
            runs = runs + [" ".join(single[at : at + n]) for at in range(len(single) - n + 1)]
        found = list(map(self.known.get, runs))
        if None in found:
            if len(self.known) > REMEMBERED:
                self.known = {}
            learnt = {run: zlib.crc32(run.encode()) % self.buckets for run in {r for r, b in zip(runs, found) if b is None}}
            self.known.update(learnt)
            found = [learnt[r] if b is None else b for r, b in zip(runs, found)]
        return len(single), np.array(found, "<u4")


def run_buckets(texts: DataFrame, longest: int, buckets: int, id_column: str, text_column: str) -> DataFrame:
    """Words, features and the buckets of all features of every whole text (32-bit numbers as binary), without a shuffle."""
    kind = texts.schema[id_column].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = RunBuckets(longest, buckets)
        for batch in batches:
            words, sizes, held = [], [], []
            for raw in batch.column(1).to_pylist():
                n, found = runs.of(raw or b"")
                words.append(n)
                sizes.append(len(found))
                held.append(found.tobytes())
            columns = [batch.column(0), pa.array(words, pa.int64()), pa.array(sizes, pa.int64()), pa.array(held, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_features", "features"])

    rows = texts.select(F.col(id_column), F.col(text_column).cast("binary"))
    return rows.mapInArrow(hashed, f"id {kind}, n_words long, n_features long, features binary")


def histogram(features: DataFrame, buckets: int) -> np.ndarray:
    """How many features fall into each bucket: a histogram per task, added up; one row per bucket comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(raw, "<u4"), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    rows = features.select("features").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    whole = np.zeros(buckets, np.int64)
    whole[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return whole


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares of every bucket, target over source, rounded down."""
    width = len(source)
    over = (target + 1) * float(source.sum() + width)
    return np.floor(1000 * np.log(over / ((source + 1) * float(target.sum() + width)))).astype(np.int64)


def uniform_32(key: Column, seed: int) -> Column:
    """The first 32 bits of SHA-256 of seed and key, as a number; a null key counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    longest: int = 1,
    buckets: int = 10_000,
    seed: int = 2024,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Draw the given share of the documents of at least ``least_words`` words, by importance weight plus Gumbel noise.

    Features are the runs of 1 to ``longest`` words; all documents make the source histogram, all texts of ``target`` (column
    ``text``) the target's. A document's weight is the floored mean of its features' gains, its noise depends on its id and the seed
    alone, so reruns agree. The highest scores are drawn, ties to the smaller id (null first).

    Null and empty texts have no feature, weight 0 and are not drawn. Repeated rows are drawn each on its own; equal scores and
    ids go by features. An empty target gains nothing in any bucket that the source has not; empty tables give no rows. Other columns
    are not read. The texts are split once; a narrow table of buckets is stored. Columns: the id, ``n_features``, ``weight``,
    ``score``, ``rank`` (null: not drawn), ``n_words``.
    """
    features = stored(run_buckets(docs, longest, buckets, id_column, text_column))
    goal = run_buckets(target.select(F.lit(0).alias("id"), "text"), longest, buckets, "id", "text")
    gain = docs.sparkSession.sparkContext.broadcast(gains(histogram(features, buckets), histogram(goal, buckets)))
    kind = docs.schema[id_column].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = []
            for raw in batch.column(3).to_pylist():
                found = np.frombuffer(raw, "<u4")
                weights.append(int(gain.value[found].sum()) // len(found) if len(found) else 0)
            columns = [batch.column(0), batch.column(1), batch.column(2), pa.array(weights, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_features", "weight"])

    weighed = features.mapInArrow(weigh, f"id {kind}, n_words long, n_features long, weight long")
    noise = F.floor(-1000 * F.ln(-F.ln((uniform_32(F.col("id"), seed) + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")
    scored = stored(weighed.withColumn("score", F.col("weight") + noise))
    enough = F.col("n_words") >= least_words
    order = [F.col("score").desc(), F.col("id"), F.col("n_features"), F.col("n_words")]
    ranked = positions(scored.where(enough), order, None, "_at", "_all")
    drawn = F.col("_at") < F.expr(f"_all * {int(percent)} div 100")
    ranked = ranked.withColumn("rank", F.when(drawn, F.col("_at") + 1))
    rest = scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    columns = [F.col("id").alias(id_column), "n_features", "weight", "score", "rank", "n_words"]
    return ranked.select(*columns).unionByName(rest.select(*columns))
