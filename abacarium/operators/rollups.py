"""Subtotals and grand totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Parts into which rows without a value are dealt.
_NULL_PARTS = 1024


def _mark_first(df: DataFrame, column: str, levels: Sequence[str], marks: Sequence[str]) -> DataFrame:
    """``df`` with 1 in ``marks[n]`` where a value of ``column`` comes first within the first ``n`` levels, else 0.

    Sums of the marks count distinct values at every depth. The rows of a value are
    sorted by level and compared with the one before, so a task holds no table of values.
    NULL is no value; its rows have no mark and are spread.
    """
    none = F.col(column).isNull()
    df = df.withColumn("_part", F.when(none, F.monotonically_increasing_id() % _NULL_PARTS))
    window = Window.partitionBy(column, "_part").orderBy(*levels)
    new, flags = F.row_number().over(window) == 1, []
    for depth in range(len(levels) + 1):
        if depth:
            level = levels[depth - 1]
            new = new | ~F.col(level).eqNullSafe(F.lag(level).over(window))
        flags.append((new & ~none).cast("int"))
    return df.withColumns(dict(zip(marks, flags, strict=True))).drop("_part")


def rollup_report(
    df: DataFrame,
    levels: Sequence[str],
    sums: Mapping[str, str | Column],
    labels: Mapping[str, str],
    distinct: Mapping[str, str] | None = None,
    blank_in_grand_total: Sequence[str] = (),
) -> DataFrame:
    """ROLLUP over ``levels`` with labelled totals, plus ``_g_<level>`` flags to sort by.

    ``sums`` maps result names to columns or to aggregates that add up, ``distinct`` result names to columns
    that are counted distinct. ``labels`` names the total of each level; levels
    in ``blank_in_grand_total`` stay NULL in the grand total row. The rows are
    added up at the finest level first, so only groups are expanded. Distinct
    values are counted by marks on the rows that bring one first, see ``_mark_first``.
    """
    distinct = distinct or {}
    marks = {(name, depth): f"_first_{i}_{depth}" for i, name in enumerate(distinct) for depth in range(len(levels) + 1)}
    for name, column in distinct.items():
        df = _mark_first(df, column, levels, [marks[name, depth] for depth in range(len(levels) + 1)])
    base = df.groupBy(*levels).agg(
        *[(F.sum(value) if isinstance(value, str) else value).alias(name) for name, value in sums.items()],
        *[F.sum(mark).alias(mark) for mark in marks.values()],
    )
    kept = len(levels) - sum(F.grouping(level).cast("int") for level in levels)

    def counted(name: str) -> Column:
        # Each total adds up the marks of its own depth.
        return F.element_at(F.array(*[F.sum(marks[name, depth]) for depth in range(len(levels) + 1)]), kept + 1)

    rolled = base.rollup(*levels).agg(
        *[F.sum(name).alias(name) for name in sums],
        *[F.coalesce(counted(name), F.lit(0)).alias(name) for name in distinct],
        *[F.grouping(level).alias(f"_g_{level}") for level in levels],
    )
    is_grand_total = F.col(f"_g_{levels[0]}") == 1
    shown: list[Column] = []
    for level in levels:
        label = F.lit(labels[level])
        if level in blank_in_grand_total:
            label = F.when(~is_grand_total, label)
        value = F.col(level).cast("string")
        shown.append(F.when(F.col(f"_g_{level}") == 1, label).otherwise(value).alias(level))
    return rolled.select(*shown, *sums, *distinct, *[f"_g_{level}" for level in levels])


def in_report_order(report: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Details before their totals, level by level; drops the flags."""
    order = [key for level in levels for key in (F.col(f"_g_{level}"), F.col(level))]
    return report.orderBy(*order).drop(*[f"_g_{level}" for level in levels])
