"""Aggregations and top-k reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from abacarium.functions import amount, labels, mean, month_range, month_start, to_double
from abacarium.operators.reports import (
    lifetime_value, lost_rate, per_month, revenue_card, spend_per_customer, spend_segment,
)
from abacarium.plans.catalog import query
from abacarium.plans.checks import LINES, SUMMARY, VALID_LINES, dbl, mean as sql_mean, pct
from abacarium.plans.tables import LOST_STATUS, Tables, gross_total, revenue_total, valid_sale

SEGMENTS = [(300_000, "Gold"), (100_000, "Silver")]


@query("order_summary", f"""
WITH {SUMMARY}
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date, o_orderstatus,
       {dbl("gross_amount")} AS gross_amount, {dbl("net_amount")} AS net_amount FROM os""")
def summary(t: Tables) -> DataFrame:
    return t.summary.select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date"), "o_orderstatus",
        to_double("gross_amount").alias("gross_amount"), to_double("net_amount").alias("net_amount"))


@query("q14_total_revenue", f"""
WITH {SUMMARY}
SELECT {dbl("SUM(net_amount)")} AS total_revenue, COUNT(*) AS orders_counted,
       {sql_mean("SUM(net_amount)", "COUNT(*)")} AS avg_order_value FROM sales""")
def q14(t: Tables) -> DataFrame:
    card = revenue_card(t.sales)
    return card.withColumns({c: F.col(c).cast("double") for c in ("total_revenue", "avg_order_value")})


@query("q15_monthly", f"""
WITH {SUMMARY}
SELECT strftime(o_orderdate, '%Y-%m') AS order_month, COUNT(*) AS orders, {dbl("SUM(net_amount)")} AS revenue
FROM sales GROUP BY 1""")
def q15(t: Tables) -> DataFrame:
    return (
        per_month(t.sales, "o_orderdate", "order_month", F.count(F.lit(1)).alias("orders"),
                  to_double(F.sum("net_amount")).alias("revenue"))
        .orderBy("order_month")
    )


@query("q16_status", "SELECT o_orderstatus, COUNT(*) AS order_count FROM orders GROUP BY o_orderstatus")
def q16(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("order_count")).orderBy(F.desc("order_count"))


def _by_nation(t: Tables) -> DataFrame:
    """Buying customers, orders and revenue per nation; orders are added up per customer first."""
    per_customer = t.sales.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("net_amount").alias("revenue"))
    return (
        per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey")
        .agg(F.count(F.lit(1)).alias("buying_customers"), F.sum("orders").alias("orders"),
             F.sum("revenue").alias("revenue"))
        .join(t.geography, F.col("c_nationkey") == F.col("n_nationkey"))
    )


@query("q17_city_aov", f"""
WITH {SUMMARY}
SELECT n_name AS city, COUNT(*) AS orders, {sql_mean("SUM(net_amount)", "COUNT(*)")} AS avg_order_value
FROM sales JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name""")
def q17(t: Tables) -> DataFrame:
    return (
        _by_nation(t)
        .select(F.col("n_name").alias("city"), "orders",
                mean("revenue", "orders").cast("double").alias("avg_order_value"))
        .orderBy(F.desc("avg_order_value"))
    )


@query("q46_state", f"""
WITH {SUMMARY}
SELECT n_name AS state, COUNT(DISTINCT c_custkey) AS buying_customers, COUNT(o_orderkey) AS orders,
       {dbl("SUM(net_amount)")} AS revenue
FROM sales JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name""")
def q46(t: Tables) -> DataFrame:
    return (
        _by_nation(t)
        .select(F.col("n_name").alias("state"), "buying_customers", "orders", to_double("revenue").alias("revenue"))
        .orderBy(F.desc("revenue"))
    )


def _category_sales(t: Tables) -> DataFrame:
    per_part = t.valid_lines.groupBy("l_partkey").agg(
        F.sum("units").alias("units"), gross_total().alias("revenue"))
    return per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey"))


@query("q18_category_rev", f"""
WITH {VALID_LINES}
SELECT p_type AS category, SUM(units) AS units_sold, {dbl("SUM(gross)")} AS gross_revenue
FROM vl JOIN part ON p_partkey = l_partkey GROUP BY p_type""")
def q18(t: Tables) -> DataFrame:
    return (
        _category_sales(t).groupBy(F.col("p_type").alias("category"))
        .agg(F.sum("units").alias("units_sold"), to_double(F.sum("revenue")).alias("gross_revenue"))
        .orderBy(F.desc("gross_revenue"))
    )


@query("q20_having", f"""
WITH {VALID_LINES}
SELECT p_brand, {dbl("SUM(gross)")} AS gross_revenue FROM vl JOIN part ON p_partkey = l_partkey
GROUP BY p_brand HAVING SUM(gross) * 25 > (SELECT SUM(gross) FROM vl)""")
def q20(t: Tables) -> DataFrame:
    # A 25th of all revenue takes the place of the fixed threshold and works at every scale.
    per_brand = _category_sales(t).groupBy("p_brand").agg(F.sum("revenue").alias("revenue"))
    total = per_brand.agg(F.sum("revenue")).scalar()
    return per_brand.where(F.col("revenue") * 25 > total).select(
        "p_brand", to_double("revenue").alias("gross_revenue"))


def payments(t: Tables) -> DataFrame:
    """One payment per order with lines; the method rotates by order key, lost orders are refunded."""
    methods = F.array(*[F.lit(m) for m in ("UPI", "Credit Card", "Debit Card", "Net Banking")])
    return t.summary.select(
        "o_orderkey",
        F.element_at(methods, (F.col("o_orderkey") % 4 + 1).cast("int")).alias("payment_method"),
        F.col("net_amount").alias("amount"),
        F.when(valid_sale(), F.to_date("o_orderdate")).alias("payment_date"),
        F.when(valid_sale(), F.lit("Completed")).otherwise(F.lit("Refunded")).alias("payment_status"),
    )


PAYMENTS = SUMMARY + """, pay AS (
  SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'UPI' WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Debit Card'
                     ELSE 'Net Banking' END AS payment_method, net_amount AS amount,
         CASE WHEN o_orderstatus IN ('F', 'O') THEN CAST(o_orderdate AS DATE) END AS payment_date,
         CASE WHEN o_orderstatus IN ('F', 'O') THEN 'Completed' ELSE 'Refunded' END AS payment_status FROM os)"""


@query("derive_payments", f"""
WITH {PAYMENTS}
SELECT o_orderkey, payment_method, {dbl("amount")} AS amount, payment_date, payment_status FROM pay""")
def derivepayments(t: Tables) -> DataFrame:
    return payments(t).withColumn("amount", to_double("amount"))


@query("q19_method", f"""
WITH {PAYMENTS}
SELECT payment_method, COUNT(*) AS payments, {dbl("SUM(amount)")} AS total_amount,
       {sql_mean("SUM(amount)", "COUNT(*)")} AS avg_amount
FROM pay WHERE payment_status = 'Completed' GROUP BY payment_method""")
def q19(t: Tables) -> DataFrame:
    total, count = F.sum("amount"), F.count(F.lit(1))
    return (
        payments(t).where("payment_status = 'Completed'").groupBy("payment_method")
        .agg(count.alias("payments"), to_double(total).alias("total_amount"),
             mean(total, count).cast("double").alias("avg_amount"))
        .orderBy(F.desc("total_amount"))
    )


@query("q21_loss_rate", f"""
SELECT COUNT(*) AS total_orders, COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS lost_orders,
       {pct("COUNT(*) FILTER (WHERE o_orderstatus = 'P')", "COUNT(*)")} AS lost_pct FROM orders""")
def q21(t: Tables) -> DataFrame:
    return lost_rate(t.orders, "o_orderstatus", LOST_STATUS).withColumn("lost_pct", F.col("lost_pct").cast("double"))


@query("q31_top5_revenue", f"""
WITH {VALID_LINES}
SELECT p_partkey, p_name, SUM(units) AS units_sold, {dbl("SUM(gross)")} AS revenue
FROM vl JOIN part ON p_partkey = l_partkey GROUP BY p_partkey, p_name ORDER BY SUM(gross) DESC, p_partkey LIMIT 5""")
def q31(t: Tables) -> DataFrame:
    return (
        _category_sales(t).orderBy(F.desc("revenue"), "p_partkey").limit(5)
        .select("p_partkey", "p_name", F.col("units").alias("units_sold"), to_double("revenue").alias("revenue"))
    )


@query("q32_top5_units", f"""
WITH {VALID_LINES}
SELECT p_partkey, p_name, SUM(units) AS units_sold FROM vl JOIN part ON p_partkey = l_partkey
GROUP BY p_partkey, p_name ORDER BY units_sold DESC, p_name, p_partkey LIMIT 5""")
def q32(t: Tables) -> DataFrame:
    return (
        _category_sales(t).orderBy(F.desc("units"), "p_name", "p_partkey").limit(5)
        .select("p_partkey", "p_name", F.col("units").alias("units_sold"))
    )


@query("q34_profit", f"""
WITH {VALID_LINES}
SELECT p_partkey, p_name, SUM(units) AS units_sold,
       {dbl("SUM(gross - CAST(p_retailprice AS DECIMAL(10,2)) * units)")} AS total_profit
FROM vl JOIN part ON p_partkey = l_partkey GROUP BY p_partkey, p_name""")
def q34(t: Tables) -> DataFrame:
    # The cost is the same for all lines of a part, so it can be taken off the sums.
    profit = F.col("revenue") - amount("p_retailprice") * F.col("units")
    return (
        _category_sales(t)
        .select("p_partkey", "p_name", F.col("units").alias("units_sold"), to_double(profit).alias("total_profit"))
        .orderBy(F.desc("total_profit"), "p_partkey")
    )


@query("q35_ratings", f"""
WITH r AS (SELECT l_partkey, CAST(l_quantity AS BIGINT) AS rating FROM lineitem WHERE l_returnflag = 'R')
SELECT p_partkey, p_name, COUNT(rating) AS review_count,
       COALESCE(CAST(CAST({sql_mean("SUM(rating)", "COUNT(rating)")} AS DECIMAL(10,2)) AS VARCHAR), 'No reviews')
         AS avg_rating
FROM part LEFT JOIN r ON l_partkey = p_partkey GROUP BY p_partkey, p_name""")
def q35(t: Tables) -> DataFrame:
    ratings = (
        t.lines.where("l_returnflag = 'R'").groupBy("l_partkey")
        .agg(F.sum("units").alias("total"), F.count(F.lit(1)).alias("reviews"))
    )
    shown = mean("total", "reviews").cast("decimal(10,2)").cast("string")
    return (
        t.part.join(ratings, F.col("p_partkey") == F.col("l_partkey"), "left")
        .withColumn("review_count", F.coalesce("reviews", F.lit(0).cast("long")))
        .orderBy(mean("total", "reviews").desc_nulls_last(), F.desc("review_count"), "p_partkey")
        .select("p_partkey", "p_name", "review_count", F.coalesce(shown, F.lit(labels.NO_REVIEWS)).alias("avg_rating"))
    )


@query("q37_top3_customers", f"""
WITH {SUMMARY}
SELECT c_custkey, c_name AS customer, COUNT(*) AS orders, {dbl("SUM(net_amount)")} AS total_spent
FROM sales JOIN customer ON c_custkey = o_custkey GROUP BY c_custkey, c_name
ORDER BY SUM(net_amount) DESC, c_custkey LIMIT 3""")
def q37(t: Tables) -> DataFrame:
    # Only the customers that remain are joined to their names.
    best = (
        t.sales.groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("net_amount").alias("spend"))
        .orderBy(F.desc("spend"), "o_custkey").limit(3)
    )
    return (
        best.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .orderBy(F.desc("spend"), "c_custkey")
        .select("c_custkey", F.col("c_name").alias("customer"), "orders", to_double("spend").alias("total_spent"))
    )


def _spend(t: Tables) -> DataFrame:
    """Every customer with their valid orders and spend."""
    return spend_per_customer(t.customer, t.sales, "c_custkey", "o_custkey")


_SPEND = SUMMARY + """, ms AS (
  SELECT c_custkey, c_name AS customer, COUNT(o_orderkey) AS orders, SUM(net_amount) AS spend
  FROM customer LEFT JOIN sales ON o_custkey = c_custkey GROUP BY c_custkey, c_name)"""


@query("q38_all_customers", f"""
WITH {_SPEND}
SELECT c_custkey, customer, orders, {dbl("COALESCE(spend, 0)")} AS total_spent FROM ms""")
def q38(t: Tables) -> DataFrame:
    return (
        _spend(t)
        .select("c_custkey", F.col("c_name").alias("customer"), "orders",
                to_double(F.coalesce("spend", F.lit(0))).alias("total_spent"))
        .orderBy(F.desc("total_spent"), "c_custkey")
    )


@query("q41_segments", f"""
WITH {_SPEND}
SELECT c_custkey, customer, {dbl("COALESCE(spend, 0)")} AS total_spent,
       CASE WHEN spend IS NULL THEN 'No purchases' WHEN spend >= 300000 THEN 'Gold'
            WHEN spend >= 100000 THEN 'Silver' ELSE 'Bronze' END AS segment FROM ms""")
def q41(t: Tables) -> DataFrame:
    return (
        _spend(t)
        .select("c_custkey", F.col("c_name").alias("customer"),
                to_double(F.coalesce("spend", F.lit(0))).alias("total_spent"),
                spend_segment("spend", SEGMENTS).alias("segment"))
        .orderBy(F.desc("total_spent"), "c_custkey")
    )


@query("q40_repeat", """
SELECT c_custkey, c_name AS customer, COUNT(*) AS orders FROM orders JOIN customer ON c_custkey = o_custkey
WHERE o_orderstatus IN ('F', 'O') GROUP BY c_custkey, c_name HAVING COUNT(*) >= 10""")
def q40(t: Tables) -> DataFrame:
    often = (
        t.orders.where(valid_sale()).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders")).where("orders >= 10")
    )
    return (
        often.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .select("c_custkey", F.col("c_name").alias("customer"), "orders").orderBy(
            F.desc("orders"), "c_custkey")
    )


@query("q43_clv", f"""
WITH {SUMMARY}
SELECT c_custkey, c_name AS customer, COUNT(*) AS orders, {dbl("SUM(net_amount)")} AS total_spent,
       {sql_mean("SUM(net_amount)", "COUNT(*)")} AS avg_order_value,
       CAST(MIN(o_orderdate) AS DATE) AS first_order, CAST(MAX(o_orderdate) AS DATE) AS last_order,
       date_diff('day', CAST(MIN(o_orderdate) AS DATE), CAST(MAX(o_orderdate) AS DATE)) AS days_active
FROM sales JOIN customer ON c_custkey = o_custkey GROUP BY c_custkey, c_name""")
def q43(t: Tables) -> DataFrame:
    cards = lifetime_value(t.sales.withColumn("day", F.to_date("o_orderdate")), "o_custkey", "day")
    return (
        cards.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .select("c_custkey", F.col("c_name").alias("customer"), "orders",
                to_double("total_spent").alias("total_spent"), F.col("avg_order_value").cast("double"),
                "first_order", "last_order", "days_active")
        .orderBy(F.desc("total_spent"), "c_custkey")
    )


@query("product_range_agg", f"""
WITH {LINES}
SELECT l_partkey, {dbl("SUM(net_amount)")} AS revenue, SUM(units) AS units FROM li
WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1996-04-01' GROUP BY l_partkey""")
def product_range_agg(t: Tables) -> DataFrame:
    return t.lines.where(month_range("l_shipdate", "1996-01", 3)).groupBy("l_partkey").agg(
        to_double(revenue_total()).alias("revenue"), F.sum("units").alias("units"))


@query("region_rev", f"""
WITH {LINES}
SELECT r_name AS region, {dbl("SUM(net_amount)")} AS revenue
FROM li JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY r_name""")
def region_rev(t: Tables) -> DataFrame:
    per_order = t.lines.groupBy("l_orderkey").agg(revenue_total().alias("revenue"))
    return (
        per_order.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey").agg(F.sum("revenue").alias("revenue"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.geography, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("r_name").alias("region")).agg(to_double(F.sum("revenue")).alias("revenue"))
    )


@query("agg_monthly_category", f"""
WITH {LINES}
SELECT ym AS yr_month, p_type AS category, {dbl("SUM(net_amount)")} AS revenue, SUM(units) AS units,
       COUNT(DISTINCT l_orderkey) AS orders
FROM li JOIN part ON p_partkey = l_partkey GROUP BY ym, p_type""")
def agg_monthly_category(t: Tables) -> DataFrame:
    # Distinct orders first, with the sums along the way: one exchange carries both.
    per_order = (
        t.lines.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(month_start("l_shipdate").alias("month"), F.col("p_type").alias("category"), "l_orderkey")
        .agg(revenue_total().alias("revenue"), F.sum("units").alias("units"))
    )
    return per_month(
        per_order, "month", "yr_month", to_double(F.sum("revenue")).alias("revenue"), F.sum("units").alias("units"),
        F.count(F.lit(1)).alias("orders"), by=["category"])
