"""Timestamps as they appear in message headers and item records."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from corpusloom.functions.text import as_column


def _utc(moment: Column) -> Column:
    """Wall-clock time in UTC, whatever the session zone is."""
    return F.convert_timezone(None, F.lit("UTC"), moment.cast("timestamp_ntz"))


def message_time(text: Column | str) -> Column:
    """UTC time of a header date in one of three formats, null when none fits.

    Formats (fixed values): ``2024-12-15 18:30:45``; ``Sun, 15 Dec 2024 18:30:45 +0100`` (the offset is applied);
    ``15 Dec 2024 18:30:45``.
    """
    text = F.trim(as_column(text))
    without_day = F.regexp_replace(text, r"^[A-Za-z]{3},\s*", "")
    zoned = F.regexp_like(text, F.lit(r"^[A-Za-z]{3},.*[+\-]\d{4}$"))
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz"),
        F.when(zoned, _utc(F.try_to_timestamp(without_day, F.lit("d MMM yyyy HH:mm:ss xx")))),
        F.try_to_timestamp(text, F.lit("d MMM yyyy HH:mm:ss")).cast("timestamp_ntz"),
    )


def epoch_time(seconds: Column | str) -> Column:
    """Time of an epoch second; null for null and for zero."""
    seconds = as_column(seconds)
    return F.when(seconds != 0, _utc(F.timestamp_seconds(seconds)))


def age_in_days(then: Column | str, now: Column | str) -> Column:
    """Whole days from ``then`` to ``now``, rounded down."""
    gap = F.unix_timestamp(as_column(now).cast("timestamp")) - F.unix_timestamp(as_column(then).cast("timestamp"))
    return F.floor(gap / 86400).cast("long")
