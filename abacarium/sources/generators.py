"""Generated tables: the date dimension and a deterministic fact table."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from abacarium.functions import date_key


def date_dimension(bounds: DataFrame, fiscal_start_month: int | None = None) -> DataFrame:
    """One row per day between ``first_day`` and ``last_day`` of the one-row ``bounds``.

    With ``fiscal_start_month`` the fiscal year and quarter are added; a fiscal
    year is named after the calendar year in which it ends.
    """
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("full_date"))
    day = F.col("full_date")
    out = days.select(
        date_key(day).alias("date_key"),
        day,
        F.dayofmonth(day).alias("day_of_month"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        F.month(day).alias("month_num"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter_num"),
        F.year(day).alias("year_num"),
        F.date_format(day, "yyyy-MM").alias("yr_month"),
    )
    if fiscal_start_month is None:
        return out
    shifted = F.add_months(day, (13 - fiscal_start_month) % 12)
    return out.withColumns({"fiscal_year": F.year(shifted), "fiscal_quarter": F.quarter(shifted)})


def calendar(spark: SparkSession, first: dt.date, last: dt.date, fiscal_start_month: int | None = None) -> DataFrame:
    bounds = spark.range(1).select(F.lit(first).alias("first_day"), F.lit(last).alias("last_day"))
    return date_dimension(bounds, fiscal_start_month)


@dataclass(frozen=True)
class Steps:
    """How far the row number moves each column; a store also moves on after every ``store_run`` rows."""

    day: int = 101
    customer: int = 29
    product: int = 17
    store_run: int = 9
    quantity: int = 5
    most: int = 8
    discounts: int = 6
    discount: int = 3


def sales_facts(
    numbers: DataFrame, products: DataFrame, dates: DataFrame, first_day: dt.date, days: int, customers: Column | int,
    product_count: Column | int, stores: Column | int, steps: Steps = Steps(),
) -> DataFrame:
    """Deterministic facts for the row numbers ``i`` of ``numbers``.

    ``products`` has ``product_key, unit_price``, ``dates`` ``full_date, date_key``;
    a day outside the calendar drops its row, as the join does. The sizes may be
    scalar subqueries.
    """
    i = F.col("i")

    def spread(step: int, size: Column | int) -> Column:
        return F.pmod(i * step, F.lit(size) if isinstance(size, int) else size) + 1

    size = F.lit(stores) if isinstance(stores, int) else stores
    base = numbers.select(
        i,
        F.date_add(F.lit(first_day), (spread(steps.day, days) - 1).cast("int")).alias("full_date"),
        spread(steps.customer, customers).alias("customer_key"),
        spread(steps.product, product_count).alias("product_key"),
        (F.pmod(i + F.expr(f"i div {steps.store_run}"), size) + 1).alias("store_key"),
        spread(steps.quantity, steps.most).cast("int").alias("quantity"),
        ((spread(1, steps.discounts) - 1) * steps.discount).cast("decimal(5,2)").alias("discount_pct"),
    )
    gross = F.col("quantity") * F.col("unit_price")
    return (
        base.join(dates.select("full_date", "date_key"), "full_date")
        .join(products.select("product_key", "unit_price"), "product_key")
        .select(
            i.alias("sales_key"), "date_key", "customer_key", "product_key", "store_key",
            # lpad would cut numbers of more than six digits.
            F.concat(F.lit("ORD-"), F.when(i < 1_000_000, F.lpad(i.cast("string"), 6, "0"))
                     .otherwise(i.cast("string"))).alias("order_id"),
            "quantity", "unit_price", "discount_pct",
            gross.cast("decimal(12,2)").alias("gross_amount"),
            F.round(gross * F.col("discount_pct") / 100, 2).cast("decimal(12,2)").alias("discount_amount"),
            F.round(gross * (100 - F.col("discount_pct")) / 100, 2).cast("decimal(12,2)").alias("net_amount"),
        )
    )


def numbers(spark: SparkSession, count: int) -> DataFrame:
    """The row numbers ``i = 1 .. count``."""
    return spark.range(1, count + 1).withColumnRenamed("id", "i")
