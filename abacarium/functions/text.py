"""Text helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def contains_any_ci(column: Column | str, words: list[str]) -> Column:
    """True where the text holds one of ``words``, ignoring case."""
    column = _col(column)
    return reduce(lambda a, b: a | b, [column.ilike(f"%{word}%") for word in words])


def text_or(column: Column | str, fallback: str) -> Column:
    """The value as text, or a readable placeholder for NULL."""
    return F.coalesce(_col(column).cast("string"), F.lit(fallback))


def trimmed_or(column: Column | str, fallback: str) -> Column:
    """The trimmed text, or ``fallback`` where nothing is left of it."""
    return F.coalesce(F.nullif(F.trim(_col(column)), F.lit("")), F.lit(fallback))
