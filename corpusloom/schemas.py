"""Declared schemas. Inference is never used on the read or write path."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


_S, _I, _L, _D, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampNTZType()
_VEC = T.ArrayType(T.FloatType(), containsNull=False)

RAW_CRAWL = _struct(("url", _S), ("title", _S), ("content", _S), ("metadata", _S), ("crawled_at", _TS))

PAGES = _struct(
    ("url", _S, False), ("title", _S), ("content", _S, False), ("html", _S), ("links", T.ArrayType(_S)),
    ("metadata", _struct(("status_code", _I), ("content_type", _S))),
)

DOCUMENTS = _struct(
    ("id", _S, False), ("source_url", _S, False), ("title", _S), ("content", _S, False), ("metadata", _S),
    ("license", _S, False), ("author", _S), ("processed_at", T.TimestampType(), False),
)

CHUNKS = _struct(
    ("chunk_id", _S, False), ("doc_id", _S, False), ("source_url", _S, False), ("title", _S),
    ("license", _S, False), ("chunk_index", _I, False), ("chunk_content", _S, False),
    ("chunk_length", _I, False), ("start_char", _I), ("end_char", _I),
)

EMBEDDINGS = _struct(
    ("chunk_id", _S, False), ("doc_id", _S, False), ("source_url", _S, False), ("chunk_content", _S, False),
    ("license", _S, False), ("chunk_index", _I, False), ("embedding", _VEC, False), ("metadata", _S),
    ("created_at", T.TimestampType()),
)

ATTRIBUTIONS = _struct(
    ("record_id", _S), ("source_url", _S), ("author", _S), ("license", _S), ("attribution_text", _S),
)

MESSAGES = _struct(
    ("id", _S, False), ("message_id", _S), ("subject", _S), ("author", _S), ("date", _S), ("date_parsed", _TS),
    ("content", _S), ("url", _S), ("thread_id", _S), ("list_name", _S), ("crawled_at", _TS),
)

ITEMS = _struct(
    ("id", _L, False), ("type", _S), ("by", _S), ("time", _L), ("time_parsed", _TS), ("title", _S), ("url", _S),
    ("text", _S), ("score", _I), ("descendants", _I), ("parent", _L), ("kids", T.ArrayType(_L)),
    ("story_type", _S), ("crawled_at", _TS),
)

# What the item API returns: ITEMS without the columns that ingestion adds.
RAW_ITEM = T.StructType([f for f in ITEMS if f.name not in ("time_parsed", "story_type", "crawled_at")])

POIS = _struct(
    ("id", _S), ("name", _S), ("category", _S), ("lat", _D), ("lon", _D), ("description", _S), ("osm_id", _L),
)

MANIFEST = _struct(
    ("dataset", _S, False), ("version", _S, False), ("table", _S, False), ("row_count", _L, False),
    ("columns", T.ArrayType(_S)), ("compression", _S), ("chunk_size", _I), ("chunk_overlap", _I),
    ("content_checksum", _S), ("schema", _S), ("created_at", T.TimestampType()),
)

# The record of what readers see: the last line of a dataset, version and table counts.
RELEASE = _struct(
    ("dataset", _S, False), ("version", _S, False), ("table", _S, False), ("state", _S, False), ("at", T.TimestampType()),
)

REGISTRY = _struct(
    ("version", _S), ("updated_at", _S),
    ("datasets", T.ArrayType(_struct(
        ("name", _S), ("display_name", _S), ("current_version", _S), ("record_count", _L), ("license", _S),
        ("sponsor", _S),
    ))),
)

DATASET_META = _struct(
    ("name", _S), ("display_name", _S), ("description", _S),
    ("versioning", _struct(
        ("current", _S),
        ("versions", T.ArrayType(_struct(
            ("version", _S), ("created_at", _S), ("record_count", _L), ("chunk_count", _L),
            ("checksum_sha256", _S), ("changelog", _S),
        ))),
    )),
    ("technical", _struct(
        ("embedding_model", _S), ("embedding_dimensions", _I), ("chunk_strategy", _S), ("chunk_size", _I),
        ("chunk_overlap", _I),
    )),
    ("licensing", _struct(("spdx_license", _S), ("license_url", _S), ("attribution_required", T.BooleanType()))),
    ("sponsorship", _struct(("sponsor_name", _S), ("sponsor_url", _S), ("sponsor_logo_url", _S))),
    ("storage", _struct(("analytics_bucket", _S), ("vector_bucket", _S))),
)
