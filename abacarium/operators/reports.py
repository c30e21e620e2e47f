"""Order, revenue and customer reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from abacarium.functions import mean, month_label, month_start, percentage
from abacarium.functions.labels import LOWEST_SEGMENT, NO_PURCHASES, STOCK_LOW, STOCK_OUT


def order_summary(
    orders: DataFrame,
    lines: DataFrame,
    order_key: str,
    line_key: str,
    gross: Column,
    discount_pct: Column | None = None,
    net: Column | None = None,
) -> DataFrame:
    """One row per order that has lines, with ``gross_amount`` and ``net_amount``.

    ``gross`` and ``net`` are aggregates over the lines of an order. The net amount is
    rounded per order, before any further sum. It comes from a discount of the whole
    order (``discount_pct``, in percent) or from the net amounts of its lines (``net``).
    Lines are added up before the join: the map-side combine takes the weight of a huge
    order off the shuffle.
    """
    sums = [gross.alias("gross_amount")]
    if net is not None:
        sums.append(net.alias("_net"))
    per_order = lines.groupBy(F.col(line_key).alias("_order")).agg(*sums)
    joined = orders.join(per_order, F.col(order_key) == F.col("_order"))
    if net is None:
        share = F.lit(1) - (discount_pct if discount_pct is not None else F.lit(0)) / F.lit(100)
        net_amount = F.col("gross_amount") * share.cast("decimal(9,6)")
    else:
        net_amount = F.col("_net")
    return joined.select(
        *orders.columns, "gross_amount", F.round(net_amount, 2).cast("decimal(24,2)").alias("net_amount")
    )


def revenue_card(summary: DataFrame, measure: str = "net_amount") -> DataFrame:
    """Total, number and average of the orders in ``summary``."""
    total = F.sum(measure)
    return summary.agg(
        total.alias("total_revenue"),
        F.count(F.lit(1)).alias("orders_counted"),
        mean(total, F.count(measure)).alias("avg_order_value"),
    )


def lost_rate(orders: DataFrame, status: str, lost: Sequence[str]) -> DataFrame:
    """How many orders were lost, and their share in percent."""
    is_lost = F.col(status).isin(*lost)
    return orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(is_lost).alias("lost_orders"),
        percentage(F.count_if(is_lost), F.count(F.lit(1))).alias("lost_pct"),
    )


def spend_per_customer(
    customers: DataFrame, summary: DataFrame, customer_key: str, order_customer: str, measure: str = "net_amount"
) -> DataFrame:
    """Orders and spend of every customer; those without orders have 0 and NULL.

    Orders are added up per customer before the outer join, so both join sides
    have one row per customer however many orders one of them placed.
    """
    per_customer = summary.groupBy(F.col(order_customer).alias("_who")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(measure).alias("spend")
    )
    return (
        customers.join(per_customer, F.col(customer_key) == F.col("_who"), "left")
        .drop("_who")
        .withColumn("orders", F.coalesce("orders", F.lit(0).cast("long")))
    )


def spend_segment(
    spend: Column | str, bands: Sequence[tuple[float, str]], otherwise: str = LOWEST_SEGMENT, none: str = NO_PURCHASES
) -> Column:
    """Segment label by total spend; NULL means that nothing was bought."""
    spend = F.col(spend) if isinstance(spend, str) else spend
    label = F.when(spend.isNull(), F.lit(none))
    for bound, name in sorted(bands, key=lambda pair: -pair[0]):
        label = label.when(spend >= F.lit(bound), F.lit(name))
    return label.otherwise(F.lit(otherwise))


def lifetime_value(summary: DataFrame, customer: str, day: str, measure: str = "net_amount") -> DataFrame:
    """Orders, spend, average, first and last order and days between, per customer."""
    return summary.groupBy(customer).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(measure).alias("total_spent"),
        mean(F.sum(measure), F.count(measure)).alias("avg_order_value"),
        F.min(day).alias("first_order"),
        F.max(day).alias("last_order"),
        F.datediff(F.max(day), F.min(day)).cast("long").alias("days_active"),
    )


def margin(price: Column | str, cost: Column | str) -> Column:
    """Margin as a share of the price in percent, NULL for a zero price."""
    price = F.col(price) if isinstance(price, str) else price
    cost = F.col(cost) if isinstance(cost, str) else cost
    return percentage(price - cost, price)


def stock_action(stock: Column | str, low: int) -> Column:
    """The label of a stock alert; NULL where the stock is not low."""
    stock = F.col(stock) if isinstance(stock, str) else stock
    return (
        F.when(stock == 0, F.lit(STOCK_OUT))
        .when(stock < low, F.lit(STOCK_LOW))
    )


def per_month(df: DataFrame, day: str, name: str, *aggregates: Column, by: Sequence[str] = ()) -> DataFrame:
    """Aggregates per month (``yyyy-MM`` in ``name``) of ``day``, and per further columns if given."""
    grouped = df.groupBy(month_start(day).alias("_month"), *by).agg(*aggregates)
    return grouped.select(month_label("_month").alias(name), *[c for c in grouped.columns if c != "_month"])
