"""Idempotent loads into a fact table partitioned by month."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from abacarium.operators.windows import dedupe_latest
from abacarium.session import read_if_there

DEFAULT_PARTITION = "default"


@dataclass(frozen=True)
class MonthRange:
    """The declared months ``first`` .. ``last`` (``yyyy-MM``, both included)."""

    first: str
    last: str

    def months(self) -> list[str]:
        year, month = (int(p) for p in self.first.split("-"))
        names = []
        while f"{year:04d}-{month:02d}" <= self.last:
            names.append(f"{year:04d}-{month:02d}")
            year, month = (year, month + 1) if month < 12 else (year + 1, 1)
        return names


def partition_of(day: Column | str, declared: MonthRange) -> Column:
    """The partition of a date: its month if declared, else ``default`` (also for NULL)."""
    day = F.col(day) if isinstance(day, str) else day
    month = F.date_format(day, "yyyy-MM")
    return F.when(month.between(declared.first, declared.last), month).otherwise(F.lit(DEFAULT_PARTITION))


def route(df: DataFrame, day: str, declared: MonthRange, partition: str = "order_month") -> DataFrame:
    return df.withColumn(partition, partition_of(day, declared))


def fact_scan(
    fact: DataFrame, day: str, start: str, end: str, declared: MonthRange, partition: str = "order_month"
) -> DataFrame:
    """Rows with ``start <= day < end``, reading only partitions that can hold them.

    Spark cannot infer the derived partition from a predicate on the date. The
    default partition is read as well, unless the range lies inside the declared
    months.
    """
    last_day = str(dt.date.fromisoformat(end) - dt.timedelta(days=1))
    wanted = [m for m in declared.months() if start[:7] <= m <= last_day[:7]]
    inside = declared.first <= start[:7] and last_day[:7] <= declared.last
    if not inside:
        wanted.append(DEFAULT_PARTITION)
    kind = fact.schema[day].dataType
    low, high = F.lit(start).cast(kind), F.lit(end).cast(kind)
    return fact.where(F.col(partition).isin(*wanted) & (F.col(day) >= low) & (F.col(day) < high))


def surrogate_lookup(
    staging: DataFrame, dimension: DataFrame, business_key: str, surrogate: str
) -> tuple[DataFrame, DataFrame]:
    """Staging rows with their surrogate key, and the rows of unknown business keys."""
    keys = dimension.select(business_key, surrogate)
    return staging.join(keys, business_key), staging.join(keys, business_key, "left_anti")


def new_facts(
    batch: DataFrame, existing: DataFrame | None, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """The rows of ``batch`` to insert: one per key, and none whose key exists.

    Without an ``order`` the smallest row of a key wins, which is an aggregate that
    combines before its shuffle. Keys of ``existing`` that repeat do no harm.
    """
    rest = [c for c in batch.columns if c not in keys]
    if order or not rest:
        first = dedupe_latest(batch, keys, order)
    else:
        first = batch.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")).select(
            *[F.col(c) if c in keys else F.col(f"_row.{c}") for c in batch.columns])
    if existing is None:
        return first
    return first.join(existing.select(*keys), list(keys), "left_anti")


def insert_if_absent(
    spark: SparkSession, batch: DataFrame, path: str, keys: Sequence[str], partition: str = "order_month"
) -> DataFrame:
    """Append the new keys of ``batch`` to the table at ``path`` and return the table.

    Only the partitions that the batch touches are searched for existing keys.
    The partitions of the batch are collected; there are no more of them than
    declared months. ``keys`` must determine the partition.
    """
    existing = read_if_there(spark, path)
    if existing is not None:
        touched = [row[0] for row in batch.select(partition).distinct().collect()]
        existing = existing.where(F.col(partition).isin(*touched))
    rows = new_facts(batch, existing, keys)
    # Few files per month, yet a hot month is split between tasks.
    rows.hint("rebalance", partition).write.mode("append").partitionBy(partition).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def partition_audit(fact: DataFrame, measure: str, partition: str = "order_month") -> DataFrame:
    """Rows and revenue per physical partition."""
    return fact.groupBy(partition).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(measure).alias("revenue")
    )


def refresh_statistics(spark: SparkSession, table: str) -> None:
    """Column statistics of a catalogue table for the cost-based optimizer."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
