"""Batched embedding through a pluggable encoder, and the embeddings table."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf


class Encoder(Protocol):
    """Anything with ``encode(texts) -> array of shape (len(texts), dimensions)``."""

    def encode(self, texts: list[str]) -> np.ndarray: ...


_TOKEN = re.compile("[a-z0-9]+")


class HashingEncoder:
    """Offline default encoder: token counts hashed into ``dimensions`` buckets, scaled to unit length."""

    def __init__(self, dimensions: int = 64, cached_tokens: int = 1 << 18):
        self.dimensions = dimensions
        self.cached_tokens = cached_tokens
        self._buckets: dict[str, int] = {}

    def _bucket(self, token: str) -> int:
        found = self._buckets.get(token)
        if found is None:
            found = int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % self.dimensions
            if len(self._buckets) < self.cached_tokens:
                self._buckets[token] = found
        return found

    def encode(self, texts: list[str]) -> np.ndarray:
        vectors = np.zeros((len(texts), self.dimensions))
        for row, text in zip(vectors, texts):
            counts = Counter(_TOKEN.findall(text.lower()))
            if counts:
                buckets = [self._bucket(token) for token in counts]
                row += np.bincount(buckets, weights=list(counts.values()), minlength=self.dimensions)
        norms = np.linalg.norm(vectors, axis=1, keepdims=True)
        return np.divide(vectors, norms, out=vectors, where=norms > 0).astype(np.float32)


def embed(
    text: Column, encoder: Callable[[], Encoder], batch_size: int = 100
) -> Column:
    """Embedding of a text column as ``array<float>``.

    ``encoder`` builds the model; it runs once per Python worker task, and the model sees at most ``batch_size``
    texts per call. Null text gives a null vector.
    """

    @arrow_udf("array<float>")
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _encoded(batches, encoder(), batch_size)

    return vectors(text)


def _encoded(batches: Iterator[pa.Array], model: Encoder, batch_size: int) -> Iterator[pa.Array]:
    for batch in batches:
        parts, missing = [], batch.is_null()
        # Texts become Python strings as many at a time as the model sees.
        present = batch.drop_null()
        for start in range(0, len(present), batch_size):
            texts = present.slice(start, batch_size).to_pylist()
            parts.append(np.asarray(model.encode(texts), dtype=np.float32))
        width = parts[0].shape[1] if parts else 0
        values = np.concatenate(parts).ravel() if parts else np.empty(0, np.float32)
        sizes = np.where(missing.to_numpy(zero_copy_only=False), 0, width)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=missing)


def embed_chunks(
    chunks: DataFrame,
    encoder: Callable[[], Encoder] = HashingEncoder,
    text: str = "chunk_content",
    batch_size: int = 100,
) -> DataFrame:
    return chunks.withColumn("embedding", embed(F.col(text), encoder, batch_size))


def embeddings_table(rows: DataFrame, created_at: Column | None = None) -> DataFrame:
    """The embeddings table layout. Absent source_url and license become ``''``, metadata becomes a JSON string."""
    have = {f.name: f.dataType.typeName() for f in rows.schema}

    def or_empty(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) if name in have else F.lit("")

    if "metadata" not in have:
        metadata = F.lit("{}")
    elif have["metadata"] == "string":
        metadata = F.coalesce("metadata", F.lit("{}"))
    else:
        metadata = F.coalesce(F.to_json("metadata"), F.lit("{}"))
    return rows.select(
        F.col("chunk_id").cast("string").alias("chunk_id"),
        F.col("doc_id").cast("string").alias("doc_id"),
        or_empty("source_url").alias("source_url"),
        "chunk_content",
        or_empty("license").alias("license"),
        F.col("chunk_index").cast("int").alias("chunk_index"),
        F.col("embedding").cast("array<float>").alias("embedding"),
        metadata.alias("metadata"),
        (F.current_timestamp() if created_at is None else created_at).alias("created_at"),
    )


def attach_embeddings(chunks: DataFrame, vectors: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Join chunks to vectors made elsewhere by key; positions are never relied on.

    A chunk without a vector keeps its row with a null embedding, as searches expect it.
    """
    return chunks.join(vectors.select(key, "embedding"), key, "left")


def poi_rows(features: DataFrame) -> DataFrame:
    """Named map features to POI rows with the description that gets embedded."""
    named = features.where(F.col("name").isNotNull() & (F.col("name") != ""))
    description = F.concat(
        F.col("name"), F.lit(" - "), F.coalesce("category", F.lit("")), F.lit(" in "),
        F.coalesce("city", F.lit("unknown")),
    )
    return named.select(
        F.col("id").cast("string").alias("id"), "name", F.coalesce("category", F.lit("unknown")).alias("category"),
        "lat", "lon", description.alias("description"), "osm_id",
    )
