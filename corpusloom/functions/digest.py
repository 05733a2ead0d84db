"""Order-independent content checksums.

A checksum over concatenated text needs every row in one place and in one order. Here each row is hashed,
its hash is cut into 16-bit words, and each word is summed over all rows. Sums are partial aggregates over
plain longs (no overflow below 10^14 rows), so any number of rows, in any order and with any number of copies,
reduces to eight numbers per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from corpusloom.functions.text import as_column

_WIDTH = {"md5": 8, "sha256": 16}


def row_hash(text: Column | str, algorithm: str = "md5") -> Column:
    text = as_column(text)
    return F.md5(text) if algorithm == "md5" else F.sha2(text, 256)


def word_sums(digest: str, algorithm: str = "md5") -> list[Column]:
    """Aggregate columns ``w0, w1, ...``: the word sums over the column of :func:`row_hash` values named ``digest``.

    Hash in a column of its own before aggregating, or the text is hashed once per word. Null digests do not count.
    """
    return [
        F.coalesce(F.sum(F.conv(F.substring(digest, 4 * i + 1, 4), 16, 10).cast("long")), F.lit(0)).alias(f"w{i}")
        for i in range(_WIDTH[algorithm])
    ]


def fold(count: Column | str, algorithm: str = "md5") -> Column:
    """Final checksum from a row count and the columns made by :func:`word_sums`."""
    parts = [as_column(count), *[F.col(f"w{i}") for i in range(_WIDTH[algorithm])]]
    return row_hash(F.concat_ws(":", *[p.cast("string") for p in parts]), algorithm)
