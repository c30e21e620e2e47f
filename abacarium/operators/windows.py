"""Rankings inside groups and reports over periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from abacarium.functions import mean, percentage
from abacarium.functions.labels import BEST, TREND_DOWN, TREND_FLAT, TREND_UNKNOWN, TREND_UP, WORST


def top_k_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], k: int, ties: bool = False,
    name: str | None = "rn",
) -> DataFrame:
    """The first ``k`` rows of each group; with ``ties`` all rows of equal rank.

    The rank filter is the only window, so Spark limits each group before the
    shuffle and a hot group reaches one task as ``k`` rows per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    position = (F.rank() if ties else F.row_number()).over(window)
    ranked = df.withColumn("_position", position.cast("long")).where(F.col("_position") <= k)
    return ranked.drop("_position") if name is None else ranked.withColumnRenamed("_position", name)


def dedupe_latest(df: DataFrame, keys: Sequence[str], latest: Sequence[str] = ()) -> DataFrame:
    """One row per key: the latest by ``latest``, all other columns breaking ties.

    Total, hence the same on every run. With no ``latest`` the smallest row wins.
    """
    rest = [c for c in df.columns if c not in keys and c not in latest]
    order = [F.col(c).desc_nulls_last() for c in latest] + [F.col(c).asc() for c in rest]
    return top_k_per_group(df, keys, order or [F.lit(1)], 1, name=None)


def top_share(
    df: DataFrame, group: str, measure: str, tie_break: Sequence[str], k: int, share: str = "pct_of_group"
) -> DataFrame:
    """The first ``k`` rows per group with their share of the group's total.

    The totals come from an aggregate of their own: a second window would stop
    Spark from limiting the groups before the shuffle.
    """
    totals = df.groupBy(group).agg(F.sum(measure).alias("_total"))
    best = top_k_per_group(df, [group], [F.desc(measure), *tie_break], k, name="rn")
    return best.join(totals, group).withColumn(share, percentage(measure, "_total")).drop("_total")


def share_of_total(df: DataFrame, measure: str, name: str = "pct_of_total") -> DataFrame:
    """Each row's share of the grand total in percent."""
    with_total = df.withColumn("_total", df.agg(F.sum(measure)).scalar())
    return with_total.withColumn(name, percentage(measure, "_total")).drop("_total")


def month_spine(months: DataFrame, period: str, partition: Sequence[str] = ()) -> DataFrame:
    """Every month (``yyyy-MM``) between the first and the last one, per partition if given."""
    as_date = F.to_date(F.concat(F.col(period), F.lit("-01")))
    bounds = months.groupBy(*partition).agg(F.min(as_date).alias("_lo"), F.max(as_date).alias("_hi"))
    days = bounds.select(*partition, F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 month"))).alias("_day"))
    return days.select(*partition, F.date_format("_day", "yyyy-MM").alias(period))


def period_over_period(
    df: DataFrame, period: str, measure: str, offset: int = 1, partition: Sequence[str] = (),
    calendar: bool = False, previous: str = "prev", change: str = "change", growth: str = "growth_pct",
) -> DataFrame:
    """The value ``offset`` periods back, the change and the growth in percent.

    ``df`` has one row per period (and partition), so a window is bounded by the
    calendar. The offset counts rows; with ``calendar`` it counts months, and a
    month without a row has no value.
    """
    if calendar:
        spine = month_spine(df, period, partition)
        keep = df.select(*partition, period, F.lit(True).alias("_real"), *[
            c for c in df.columns if c != period and c not in partition])
        df_columns = df.columns
        df = spine.join(keep, [*partition, period], "left")
    else:
        df_columns = df.columns
    window = Window.partitionBy(*partition).orderBy(period)
    before = F.lag(measure, offset).over(window)
    out = df.withColumn(previous, before)
    if calendar:
        out = out.where(F.col("_real"))
    return out.select(
        *df_columns, previous,
        (F.col(measure) - F.col(previous)).alias(change),
        percentage(F.col(measure) - F.col(previous), previous).alias(growth),
    )


def trend(now: Column | str, before: Column | str) -> Column:
    """UP, DOWN or FLAT against the value before; n/a without one."""
    now = F.col(now) if isinstance(now, str) else now
    before = F.col(before) if isinstance(before, str) else before
    return (
        F.when(before.isNull(), F.lit(TREND_UNKNOWN))
        .when(now > before, F.lit(TREND_UP))
        .when(now < before, F.lit(TREND_DOWN))
        .otherwise(F.lit(TREND_FLAT))
    )


def running_and_moving(
    df: DataFrame, period: str, measure: str, width: int = 3,
    running: str = "running_total", moving: str = "moving_avg", partition: Sequence[str] = (),
) -> DataFrame:
    """Running total and moving average over the rows of a calendar."""
    window = Window.partitionBy(*partition).orderBy(period)
    last = window.rowsBetween(-(width - 1), Window.currentRow)
    return df.withColumns({
        running: F.sum(measure).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        moving: mean(F.sum(measure).over(last), F.count(measure).over(last)),
    })


def cumulative(df: DataFrame, order: str, measure: str, name: str = "running_total") -> DataFrame:
    """Cumulative sum with the default frame: rows of equal order share a value."""
    window = Window.partitionBy().orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(measure).over(window))


def neighbours(
    df: DataFrame, period: str, measure: str, previous: str = "prev", following: str = "next",
    partition: Sequence[str] = (),
) -> DataFrame:
    """The measure of the row before and of the row after, over one window."""
    window = Window.partitionBy(*partition).orderBy(period)
    return df.withColumns({
        previous: F.lag(measure).over(window),
        following: F.lead(measure).over(window),
    })


def best_and_worst(
    df: DataFrame, measure: str, k: int, columns: Sequence[str], labels: tuple[str, str] = (BEST, WORST)
) -> DataFrame:
    """The ``k`` best and the ``k`` worst ranks of a calendar, ties kept, under a label."""
    known = df.where(F.col(measure).isNotNull())
    parts = []
    for label, order in zip(labels, (F.desc(measure), F.asc(measure)), strict=True):
        ranked = known.withColumn("_rank", F.rank().over(Window.partitionBy().orderBy(order)))
        parts.append(ranked.where(F.col("_rank") <= k).select(F.lit(label).alias("label"), *columns))
    return parts[0].unionByName(parts[1])
