"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

The weights are learnt with follow-the-regularised-leader (per-coordinate rates, L1 and L2 penalties) on a bounded sample
of labelled documents, and a temperature calibrates the probabilities. Document frequencies come from all labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.llm.common import share_of

# Hashed features, longest n-gram.
FEATURES, LONGEST = 1 << 14, 3
# Sample documents of a language and of all languages at most: with more than 256 languages, each has fewer.
SAMPLE_PER_LANGUAGE, SAMPLE = 1000, 256_000
UNKNOWN = "und"


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character 1- to 3-grams of a whole lower-cased text, and how often each occurs."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    grams, code = [], np.zeros(len(points), np.uint64)
    for n in range(1, LONGEST + 1):
        if len(points) < n:
            break
        code = code[: len(points) - n + 1] * np.uint64(0x100000001B3) + points[n - 1 :]
        grams.append(((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(50)).astype(np.int64))
    counts = np.bincount(np.concatenate(grams) if grams else np.zeros(0, np.int64), minlength=FEATURES)
    ids = np.flatnonzero(counts)
    return ids, counts[ids]


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray  # per feature
    weights: np.ndarray  # feature by language
    bias: np.ndarray
    temperature: float = 1.0

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Features and TF-IDF values of length one."""
        ids, counts = ngram_counts(text)
        values = np.log1p(counts) * self.idf[ids]
        length = np.linalg.norm(values)
        return ids, values / length if length else values

    def logits(self, ids: np.ndarray, values: np.ndarray) -> np.ndarray:
        return values @ self.weights[ids] + self.bias

    def predict(self, text: str) -> tuple[str, float]:
        chances = softmax(self.logits(*self.vector(text)) / self.temperature)
        best = int(chances.argmax())
        return self.languages[best], float(chances[best])


def softmax(logits: np.ndarray) -> np.ndarray:
    powers = np.exp(logits - logits.max())
    return powers / powers.sum()


def fit(
    languages: list[str], idf: np.ndarray, texts: list[str], labels: list[str],
    epochs: int = 3, rate: float = 2.0, beta: float = 1.0, l1: float = 0.002, l2: float = 0.01, seed: int = 7,
) -> LanguageModel:
    """FTRL-proximal over the sample; every fifth text is set aside and fits the temperature."""
    model = LanguageModel(languages, idf, np.zeros((len(idf), len(languages))), np.zeros(len(languages)))
    number = {name: n for n, name in enumerate(languages)}
    rows = [(*model.vector(t), number[y]) for t, y in zip(texts, labels)]
    order = np.random.default_rng(seed).permutation(len(rows)).tolist()
    aside, learn = order[::5] if len(order) >= 10 else [], [n for k, n in enumerate(order) if k % 5 or len(order) < 10]
    z, squares = np.zeros((len(idf) + 1, len(languages))), np.zeros((len(idf) + 1, len(languages)))

    def solve(at) -> np.ndarray:
        own = z[at]
        shrunk = np.sign(own) * np.maximum(np.abs(own) - l1, 0.0)
        return -shrunk / ((beta + np.sqrt(squares[at])) / rate + l2)

    for _ in range(epochs):
        for n in learn:
            ids, values, label = rows[n]
            at, x = np.r_[ids, len(idf)], np.r_[values, 1.0]
            weights = solve(at)
            error = softmax(x @ weights)
            error[label] -= 1
            gradient = x[:, None] * error
            grown = squares[at] + gradient**2
            z[at] += gradient - (np.sqrt(grown) - np.sqrt(squares[at])) / rate * weights
            squares[at] = grown
    solved = solve(np.arange(len(idf) + 1))
    model.weights, model.bias = solved[:-1], solved[-1]
    model.temperature = calibrate([model.logits(*rows[n][:2]) for n in aside], [rows[n][2] for n in aside])
    return model


def calibrate(logits: list[np.ndarray], labels: list[int]) -> float:
    """The temperature with the least log loss on documents set aside, by golden section on its logarithm.

    The right answers are smoothed by one wrong document in all, or else documents without an error would ask for certainty.
    """
    if not labels:
        return 1.0
    scores, right = np.array(logits), np.array(labels)
    smooth = 1 / (len(right) + 1)

    def loss(log_temperature: float) -> float:
        scaled = scores / np.exp(log_temperature)
        top = scaled.max(1)
        aim = (1 - smooth) * scaled[np.arange(len(right)), right] + smooth * scaled.mean(1)
        return float((top + np.log(np.exp(scaled - top[:, None]).sum(1)) - aim).mean())

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def train(labelled: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang") -> LanguageModel | None:
    """Fit a model on rows that have a label and a letter in their text; None if there are none.

    Languages and document frequencies are counted over all such rows (frequencies: one row per feature and task is
    shuffled, FEATURES rows come to the driver). For the fit, at most SAMPLE_PER_LANGUAGE documents of each language and SAMPLE
    in all come to the driver, whole texts, chosen by a hash of id and text. Every language is learnt. Rows that repeat id and
    text count as one in the sample; null or repeated ids with other texts are rows like any other.
    """
    rows = labelled.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(label_column).alias("label"))
    rows = rows.where(F.col("label").isNotNull() & has_letter(F.col("text")))
    rows = rows.withColumn("draw", F.xxhash64("id", "text", F.lit(23)))
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("count"), F.approx_count_distinct("draw").alias("different")).collect()
    if not counts:
        return None

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(FEATURES, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found[ngram_counts(text)[0]] += 1
        ids = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), pa.array(found[ids])], ["feature", "n"])

    table = rows.select("text").mapInArrow(frequencies, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    frequency = np.zeros(FEATURES)
    frequency[table.column("feature").to_numpy()] = table.column("n").to_numpy()
    total = sum(r["count"] for r in counts)
    idf = np.log((1 + total) / (1 + frequency)) + 1
    sample = draw_sample(rows, {r["label"]: r["different"] for r in counts}).toArrow()
    sample = sample.sort_by([("id", "ascending"), ("label", "ascending"), ("text", "ascending")])
    labels = sample.column("label").to_pylist()
    return fit(sorted(set(labels)), idf, sample.column("text").to_pylist(), labels) if labels else None


def draw_sample(rows: DataFrame, different: dict[str, int]) -> DataFrame:
    """The rows (id, text, label, draw) of least ``draw`` of every label, each once, within the bounds of the sample.

    ``different`` has about the number of different draws of every label; twice as many as are wanted are looked at, so that only these
    few are sorted, and copies of one row leave each task once.
    """
    most = max(1, min(SAMPLE_PER_LANGUAGE, SAMPLE // len(different)))
    shares = F.create_map(*[F.lit(x) for label, n in different.items() for x in (label, min(1.0, 2 * most / max(n, 1)))])
    near = rows.where(share_of("draw") < F.element_at(shares, F.col("label")))
    once = Window.partitionBy("label", "draw").orderBy("label")
    first = Window.partitionBy("label").orderBy("draw")
    near = near.withColumn("_n", F.row_number().over(once)).where(F.col("_n") == 1)
    return near.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= most).select("id", "text", "label")


def predict(docs: DataFrame, model: LanguageModel | None, text_column: str = "text") -> Column:
    """Struct of ``lang_pred`` and ``score`` for a text column; ``und`` and 0 for null, for text without a letter, and without a model."""
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("struct<lang_pred: string, score: double>")
    def judge(texts: pa.Array, letters: pa.Array) -> pa.Array:
        results = [
            model.predict(t) if model is not None and some else (UNKNOWN, 0.0)
            for t, some in zip(texts.to_pylist(), letters.to_pylist())
        ]
        names, scores = [r[0] for r in results], [r[1] for r in results]
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    text = docs[text_column]
    return judge(text, has_letter(text))


def identify(docs: DataFrame, learn_from: Column, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang") -> DataFrame:
    """Predicted language of every whole text, learnt from the rows for which ``learn_from`` holds.

    Trains while it is built (see :func:`train`). Columns: the id, ``lang_pred``, ``score``. Repeated rows are judged alike, null ids
    stay, an empty table gives an empty result.
    """
    model = train(docs.where(learn_from), id_column, text_column, label_column)
    judged = docs.select(F.col(id_column), predict(docs, model, text_column).alias("_judged"))
    return judged.select(id_column, "_judged.lang_pred", "_judged.score")
