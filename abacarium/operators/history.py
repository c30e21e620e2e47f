"""Versioned dimensions, cohorts and stock."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from abacarium.functions import month_label, month_start, percentage
from abacarium.operators.windows import dedupe_latest


def merge_versions(
    history: DataFrame, feed: DataFrame, key: str, tracked: Sequence[str], as_of: dt.datetime | Column,
    latest: Sequence[str] = (),
) -> DataFrame:
    """Type-2 history after a feed: a change closes the current version and opens a new one.

    ``history`` has ``key``, the ``tracked`` columns, ``valid_from``, ``valid_to``
    (NULL while open) and ``is_current``. Only current versions are joined.
    """
    stamp = as_of if isinstance(as_of, Column) else F.lit(as_of)
    columns = [key, *tracked, "valid_from", "valid_to", "is_current"]
    fresh = dedupe_latest(
        feed.where(F.col(key).isNotNull()).select(key, *dict.fromkeys([*tracked, *latest])), [key], latest
    ).select(F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in tracked])
    joined = history.where("is_current").join(fresh, F.col(key) == F.col("_key"), "full_outer")

    same = F.struct(*tracked).eqNullSafe(F.struct(*[F.col(f"_new_{c}") for c in tracked]))
    is_new, changed = F.col(key).isNull(), F.col(key).isNotNull() & F.col("_key").isNotNull() & ~same
    open_end = F.lit(None).cast(history.schema["valid_to"].dataType)
    old = F.struct(
        F.col(key).alias(key), *[F.col(c).alias(c) for c in tracked], F.col("valid_from").alias("valid_from"),
        F.when(changed, stamp).otherwise(F.col("valid_to")).alias("valid_to"), (~changed).alias("is_current"))
    new = F.struct(
        F.col("_key").alias(key), *[F.col(f"_new_{c}").alias(c) for c in tracked], stamp.alias("valid_from"),
        open_end.alias("valid_to"), F.lit(True).alias("is_current"))
    versions = joined.select(F.inline(F.array_compact(F.array(
        F.when(~is_new, old), F.when(is_new | changed, new)))))
    return history.where("NOT is_current").select(*columns).unionByName(versions.select(*columns))


def cohort_retention(orders: DataFrame, customer: str, day: str) -> DataFrame:
    """Customers of each first-order month that order again 0, 1, 2, ... months later, and their share in percent."""
    active = orders.select(customer, month_start(day).alias("_month")).distinct()
    first = active.groupBy(customer).agg(F.min("_month").alias("_cohort"))
    age = F.months_between("_month", "_cohort").cast("int")
    counts = (
        active.join(first, customer).groupBy("_cohort", age.alias("months_later")).agg(F.count(F.lit(1)).alias("customers"))
    )
    sizes = first.groupBy("_cohort").agg(F.count(F.lit(1)).alias("cohort_size"))
    return counts.join(sizes, "_cohort").select(
        month_label("_cohort").alias("cohort"), "months_later", "customers", "cohort_size",
        percentage("customers", "cohort_size").alias("retention_pct"))


def decrement_stock(products: DataFrame, key: str, stock: str, lines: DataFrame, line_key: str, quantity: str) -> DataFrame:
    """Stock after the orders in ``lines``; ``oversold`` marks products that would go below zero."""
    sold = lines.groupBy(F.col(line_key).alias("_key")).agg(F.sum(quantity).alias("_sold"))
    left = F.col(stock) - F.coalesce("_sold", F.lit(0))
    return (
        products.join(sold, F.col(key) == F.col("_key"), "left")
        .withColumns({stock: left, "oversold": left < 0})
        .drop("_key", "_sold")
    )


def with_holidays(dates: DataFrame, holidays: DataFrame) -> DataFrame:
    """Flag the days of the calendar that are listed in ``holidays (full_date)``."""
    listed = holidays.select("full_date").distinct().withColumn("_holiday", F.lit(True))
    return dates.join(listed, "full_date", "left").withColumn(
        "is_holiday", F.coalesce("_holiday", F.lit(False))).drop("_holiday")
