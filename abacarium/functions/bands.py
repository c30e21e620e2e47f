"""Banding of numbers by inclusive lower bounds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Grade bands by inclusive lower bound; below the last one the grade is F.
GRADE_BANDS = [(90, "A+"), (80, "A"), (70, "B"), (60, "C"), (50, "D"), (40, "E")]


def band(value: Column | str, bands: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """The label of the highest lower bound that ``value`` reaches; NULL stays NULL."""
    value = F.col(value) if isinstance(value, str) else value
    label = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, name in sorted(bands, key=lambda pair: -pair[0]):
        label = label.when(value >= F.lit(bound), F.lit(name))
    return label.otherwise(F.lit(otherwise))


def grade_band(value: Column | str, bands: Sequence[tuple[float, str]] = tuple(GRADE_BANDS)) -> Column:
    return band(value, bands, "F")
