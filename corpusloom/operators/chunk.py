"""Chunkers: fixed grid, sliding window, word boundary and sentence.

All four are row-local, so chunking never shuffles. Grid and sliding window are plain column expressions. The other
two depend on where words and sentences end; they run on Arrow batches of the text column alone, while the columns
copied to every chunk stay in the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from corpusloom.functions.text import as_column, code_blocks

STRATEGIES = ("grid", "window", "fixed", "sentence")

_SPANS = "array<struct<chunk_index:int,chunk_content:string,start_char:int,end_char:int>>"


def chunk_documents(
    docs: DataFrame,
    strategy: str = "fixed",
    size: int = 1000,
    overlap: int = 200,
    min_chars: int = 50,
    doc_id: str = "id",
    text: str = "content",
    keep: Iterable[str] = (),
) -> DataFrame:
    """One row per chunk: chunk_id, doc_id, the ``keep`` columns, chunk_index, chunk_content, chunk_length,
    start_char, end_char.

    ``grid``      windows every ``size - overlap`` characters while they start inside the text; only chunks longer
                  than ``min_chars`` are kept, with their grid position as index.
    ``window``    the same windows, ending with the first that reaches the end of the text; no length filter.
    ``fixed``     windows that end at a space where one lies in their second half; ``min_chars`` or more.
    ``sentence``  whole sentences up to ``size`` characters; only the last chunk has a minimum length.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}, expected one of {STRATEGIES}")
    if size <= 0 or not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")
    if strategy == "grid":
        spans = grid_spans(docs, text, size, overlap).where(F.length("_chunk.chunk_content") > min_chars)
    elif strategy == "window":
        spans = window_spans(docs, text, size, overlap)
    else:
        cutter = _fixed_cutter(size, overlap, min_chars) if strategy == "fixed" else \
            _sentence_cutter(size, overlap, min_chars)
        spans = docs.withColumn("_chunk", F.explode(cutter(F.col(text))))
    source = F.col(doc_id).cast("string")
    return spans.select(
        F.concat_ws("_", source, F.col("_chunk.chunk_index").cast("string")).alias("chunk_id"),
        source.alias("doc_id"),
        *keep,
        F.col("_chunk.chunk_index").alias("chunk_index"),
        F.col("_chunk.chunk_content").alias("chunk_content"),
        F.length("_chunk.chunk_content").alias("chunk_length"),
        F.col("_chunk.start_char").alias("start_char"),
        F.col("_chunk.end_char").alias("end_char"),
    )


def grid_spans(docs: DataFrame, text: str, size: int, overlap: int, outer: bool = False) -> DataFrame:
    """``docs`` with one row and a ``_chunk`` struct per grid window; ``outer`` keeps rows whose text is null.

    Blocks of ``size - overlap`` characters are cut in one pass; a window is its block plus the start of the
    following ones. This replaces the level-by-level recursive query with a single linear expression.
    """
    step = size - overlap
    following = -(-overlap // step)
    blocks = F.col("_blocks")

    def span(block: Column, i: Column) -> Column:
        if following == 0:
            content = block
        elif following == 1:
            content = F.substring(F.concat(block, F.coalesce(F.get(blocks, i + 1), F.lit(""))), 1, size)
        else:
            content = F.substring(F.array_join(F.slice(blocks, i + 1, F.lit(following + 1)), ""), 1, size)
        return F.struct(
            i.alias("chunk_index"),
            content.alias("chunk_content"),
            (i * step).alias("start_char"),
            (i * step + F.length(content)).alias("end_char"),
        )

    # An empty text still has its first, empty window.
    cut = F.when(F.col(text) == "", F.array(F.lit(""))).otherwise(code_blocks(text, step))
    explode = F.explode_outer if outer else F.explode
    return docs.withColumn("_blocks", cut).withColumn("_chunk", explode(F.transform(blocks, span))).drop("_blocks")


def window_spans(docs: DataFrame, text: str, size: int, overlap: int) -> DataFrame:
    """Grid windows up to and including the first one that reaches the end of the text."""
    sized = docs.withColumn("_length", F.length(as_column(text)))
    spans = grid_spans(sized, text, size, overlap)
    previous_end = F.col("_chunk.start_char") - (size - overlap) + size
    inside = (F.col("_chunk.chunk_index") == 0) | (previous_end < F.col("_length"))
    return spans.where((F.col("_length") > 0) & inside).drop("_length")


# --- text-dependent cuts ------------------------------------------------------------------------------------------

Span = tuple[int, int, str]


def fixed_spans(text: str, size: int, overlap: int, min_chars: int) -> list[Span]:
    """(start, end, piece) windows of the stripped text that prefer to end at a space."""
    body = text.strip()
    total = len(body)
    spans: list[Span] = []
    at = 0 if total >= min_chars else None
    while at is not None:
        stop = at + size
        if stop < total:
            # A space counts only beyond the middle of the window.
            gap = body.rfind(" ", at + size // 2 + 1, stop)
            stop = stop if gap < 0 else gap
        else:
            stop = total
        piece = body[at:stop].strip()
        if len(piece) >= min_chars:
            spans.append((at, stop, piece))
        following = max(stop - overlap, at + 1)
        at = following if stop < total and following < total - min_chars else None
    return spans


# Fixed pattern: white space after a sentence mark.
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+")


def sentence_spans(text: str, size: int, overlap: int, min_chars: int) -> list[Span]:
    """(start, end, piece) runs of whole sentences; neighbouring runs share trailing sentences.

    Positions follow the joined text, so they are approximate where sentences are separated by more than a space.
    """
    sentences = _SENTENCE_END.split(text)
    reach = [0, *accumulate(len(s) for s in sentences)]

    def joined(first: int, last: int) -> int:
        """Length of sentences [first, last) joined by single spaces."""
        return reach[last] - reach[first] + max(last - first - 1, 0)

    spans: list[Span] = []
    first, running, start = 0, 0, 0
    for k, sentence in enumerate(sentences):
        if k > first and running + len(sentence) > size:
            spans.append((start, start + joined(first, k), " ".join(sentences[first:k])))
            # Longest run of trailing sentences that stays below the overlap; the newest sentence of the run is
            # compared without its joining space.
            back = k
            while back > first and joined(back, k) + len(sentences[back - 1]) < overlap:
                back -= 1
            start += joined(first, k) - joined(back, k)
            first, running = back, joined(back, k)
        running += len(sentence) + 1
    tail = " ".join(sentences[first:])
    if len(tail) >= min_chars:
        spans.append((start, start + len(tail), tail))
    return spans


def _span_column(cut: Callable[[str], list[Span]]) -> Callable[[Column], Column]:
    @arrow_udf(_SPANS)
    def spans(texts: pa.Array) -> pa.Array:
        offsets, index, starts, ends, pieces = [0], [], [], [], []
        for text in texts.to_pylist():
            found = cut(text) if text is not None else []
            index.extend(range(len(found)))
            for start, end, piece in found:
                starts.append(start)
                ends.append(end)
                pieces.append(piece)
            offsets.append(len(index))
        rows = pa.StructArray.from_arrays(
            [pa.array(index, pa.int32()), pa.array(pieces, pa.string()), pa.array(starts, pa.int32()),
             pa.array(ends, pa.int32())],
            names=["chunk_index", "chunk_content", "start_char", "end_char"],
        )
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)

    return spans


def _fixed_cutter(size: int, overlap: int, min_chars: int) -> Callable[[Column], Column]:
    return _span_column(lambda text: fixed_spans(text, size, overlap, min_chars))


def _sentence_cutter(size: int, overlap: int, min_chars: int) -> Callable[[Column], Column]:
    return _span_column(lambda text: sentence_spans(text, size, overlap, min_chars))


def register_chunk_text(spark, name: str = "chunk_text") -> None:
    """Register ``chunk_text(content, size, overlap)`` for ``SELECT ... FROM docs, LATERAL chunk_text(...)``.

    A SQL function over the closed form: windows start ``size - overlap`` apart, and the last is the first that reaches the
    end. It runs in the JVM; null and empty texts have no window.
    """
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(content STRING, size INT, overlap INT)
        RETURNS TABLE (chunk_index INT, chunk_content STRING)
        RETURN SELECT i, substr(content, i * (size - overlap) + 1, size)
        FROM explode(CASE WHEN NOT (overlap >= 0 AND overlap < size) THEN raise_error('need 0 <= overlap < size')
                          WHEN length(content) > 0
                          THEN sequence(0, greatest(0, CAST(ceil((length(content) - size) / (size - overlap)) AS INT)))
                          END) AS window(i)
    """)
