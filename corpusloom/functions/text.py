"""Column expressions over text. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed pattern: anything that looks like a markup tag.
TAG = "<[^>]+>"

# White space as str.strip() sees it: the Unicode property plus the four separator controls.
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip_space(text: Column | str) -> Column:
    """Trim Unicode white space (``trim`` removes plain spaces only)."""
    return F.regexp_replace(as_column(text), _EDGE_SPACE, "")


def strip_tags(text: Column | str) -> Column:
    return F.regexp_replace(as_column(text), TAG, "")


def json_text(document: Column | str, key: str) -> Column:
    """Text value of a top-level key of a JSON string; JSON null and missing keys give null."""
    return F.get_json_object(as_column(document), f"$.{key}")


def rounded_int(value: Column) -> Column:
    """Round half to even, then cast: the integer cast of the SQL the statistics come from."""
    return F.bround(value, 0).cast("int")


def code_blocks(text: Column | str, width: int) -> Column:
    """Cut text into consecutive blocks of ``width`` code points in one linear pass.

    ``substring(text, k * width, ...)`` per block would rescan UTF-8 text from its start each time, which is
    quadratic in the document length.
    """
    return F.regexp_extract_all(as_column(text), F.lit(f"(?s).{{1,{width}}}"), F.lit(0))


def commit_refs(text: Column | str) -> Column:
    """Words that look like abbreviated or full commit hashes."""
    words = F.regexp_extract_all(as_column(text), F.lit("[0-9A-Za-z_]+"), F.lit(0))
    return F.filter(words, lambda w: w.rlike("^[0-9a-f]{7,40}$"))


def is_patch(subject: Column | str) -> Column:
    """Whether a message subject announces a patch."""
    return as_column(subject).rlike(r"^\s*(\[PATCH|PATCH)")
