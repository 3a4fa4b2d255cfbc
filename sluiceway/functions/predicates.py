"""Row filters. Each stays a plain predicate, so scans can push it down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.schemas import FLAG, PENDING, STATUS


def eligible(df: DataFrame) -> DataFrame:
    """Flagged and pending; a null flag is not flagged."""
    return df.filter(F.col(FLAG) & (F.col(STATUS) == PENDING))


def eligible_one(df: DataFrame, record_id: str) -> DataFrame:
    return eligible(df).filter(F.col("id") == record_id)


def pending(df: DataFrame) -> DataFrame:
    """Pending whatever the flag says."""
    return df.filter(F.col(STATUS) == PENDING)


def not_deleted(df: DataFrame, column: str = "is_deleted") -> DataFrame:
    """Known not to be deleted; null does not count as known."""
    return df.filter(~F.col(column))


def contains_ignore_case(text: Column, part: Column) -> Column:
    """``part`` as a case-insensitive LIKE pattern inside ``text``.

    ``_`` and ``%`` in ``part`` are wildcards. A backslash before any other
    character stands for that character, which Spark would reject, so it is
    taken off first.
    """
    pattern = F.concat(F.lit("%"), F.lower(part), F.lit("%"))
    pattern = F.regexp_replace(pattern, r"(?s)(\\[_%\\])|\\(.)", "$1$2")
    return F.like(F.lower(text), pattern)


def equals_ignore_case(text: Column, literal: str) -> Column:
    return F.lower(text) == literal.lower()
