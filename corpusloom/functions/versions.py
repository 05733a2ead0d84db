"""Version strings such as ``v2024.12.1``, compared by their numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from corpusloom.functions.text import as_column


def version_key(version: Column | str) -> Column:
    """Sortable array of the numeric components: ``v2024.9.1`` comes before ``v2024.12.1``."""
    return F.transform(F.regexp_extract_all(as_column(version), F.lit(r"\d+"), F.lit(0)), lambda x: x.cast("long"))
