"""Filters, projections, NULL handling and small top-k queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from abacarium.functions import (
    cents, contains_any_ci, labels, month_range, text_or, to_double, trimmed_or, whole_ratio,
)
from abacarium.operators.reports import stock_action
from abacarium.plans.catalog import query
from abacarium.plans.checks import LINES, dbl, pct
from abacarium.plans.tables import Tables, revenue_total


def _priority():
    # The driver tables hold no NULLs; the lowest priority stands for "not given".
    return F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))


@query("q01_active_products", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'")
def q01(t: Tables) -> DataFrame:
    return t.orders.where("o_orderstatus = 'O'").select("o_orderkey", "o_totalprice").orderBy(
        F.desc("o_totalprice"), "o_orderkey")


@query("q02_in_between", """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS order_date FROM orders
WHERE o_orderstatus IN ('F', 'O') AND o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-03-31'""")
def q02(t: Tables) -> DataFrame:
    first, last = (F.lit(d).cast("timestamp_ntz") for d in ("1996-01-01", "1996-03-31"))
    return t.orders.where(F.col("o_orderstatus").isin("F", "O") & F.col("o_orderdate").between(first, last)).select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("order_date"))


@query("q03_like", """
SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_name ILIKE '%RING%' OR p_name ILIKE '%Plate%'""")
def q03(t: Tables) -> DataFrame:
    return t.part.where(contains_any_ci("p_name", ["RING", "Plate"])).select("p_partkey", "p_name", "p_retailprice")


@query("q04_top5_price", "SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 5")
def q04(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", "p_name", "p_retailprice").orderBy(F.desc("p_retailprice"), "p_partkey").limit(5)


@query("q05_distinct", """
SELECT DISTINCT r_name, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey""")
def q05(t: Tables) -> DataFrame:
    home = t.customer.select("c_nationkey").distinct()
    return (
        home.join(t.geography, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("r_name", "n_name").distinct().orderBy("r_name", "n_name")
    )


@query("q06_is_null", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE NULLIF(o_orderpriority, '5-LOW') IS NULL")
def q06(t: Tables) -> DataFrame:
    return t.orders.where(_priority().isNull()).select("o_orderkey", "o_custkey", "o_totalprice")


@query("q07_coalesce", """
SELECT o_orderkey, COALESCE(NULLIF(o_orderpriority, '5-LOW'), 'Not provided') AS priority_display FROM orders""")
def q07(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", text_or(_priority(), labels.NOT_PROVIDED).alias("priority_display"))


@query("q08_ifnull_sort", """
SELECT o_orderkey, o_custkey, o_orderstatus, IFNULL(NULLIF(o_orderpriority, '5-LOW'), 'PRIORITY MISSING') AS priority
FROM orders""")
def q08(t: Tables) -> DataFrame:
    return (
        t.orders.orderBy(_priority().isNull().desc(), "o_orderkey")
        .select("o_orderkey", "o_custkey", "o_orderstatus", F.ifnull(_priority(), F.lit("PRIORITY MISSING")).alias("priority"))
    )


@query("q10_counts", """
SELECT COUNT(*) AS total_orders, COUNT(NULLIF(o_orderpriority, '5-LOW')) AS with_priority,
       COUNT(*) - COUNT(NULLIF(o_orderpriority, '5-LOW')) AS without_priority FROM orders""")
def q10(t: Tables) -> DataFrame:
    rows, given = F.count(F.lit(1)), F.count(_priority())
    return t.orders.agg(
        rows.alias("total_orders"), given.alias("with_priority"), (rows - given).alias("without_priority"))


@query("q11_margin", f"""
SELECT l_orderkey, l_linenumber, l_discount, l_tax,
       {pct("CAST(l_discount AS DECIMAL(4,2)) - CAST(l_tax AS DECIMAL(4,2))", "CAST(l_discount AS DECIMAL(4,2))")}
         AS margin_pct FROM lineitem""")
def q11(t: Tables) -> DataFrame:
    # The discount stands for the price, because it is zero on some lines, and the tax for the cost.
    price, cost = cents("l_discount"), cents("l_tax")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_discount", "l_tax",
        whole_ratio(price - cost, price, 100).cast("double").alias("margin_pct"),
    ).orderBy(F.desc("margin_pct"), "l_orderkey", "l_linenumber")


@query("q13_case_null", """
SELECT o_orderkey, o_orderstatus,
       CASE WHEN NULLIF(o_orderpriority, '5-LOW') IS NULL THEN 'Awaiting priority'
            ELSE 'Ordered on ' || strftime(o_orderdate, '%Y-%m-%d') END AS note FROM orders""")
def q13(t: Tables) -> DataFrame:
    note = F.when(_priority().isNull(), "Awaiting priority").otherwise(
        F.concat(F.lit("Ordered on "), F.to_date("o_orderdate")))
    return t.orders.select("o_orderkey", "o_orderstatus", note.alias("note"))


@query("strip_or_default", """
SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'Not provided' ELSE trim(p_name) END AS name FROM part""")
def strip_or_default(t: Tables) -> DataFrame:
    # Padded names; those of every fifth size are blank.
    padded = F.when(F.col("p_size") % 5 == 0, F.lit("   ")).otherwise(F.concat(F.lit("  "), "p_name", F.lit(" ")))
    return t.part.select("p_partkey", trimmed_or(padded, labels.NOT_PROVIDED).alias("name"))


@query("q49_low_stock", """
SELECT p_partkey, p_name, p_size - 1 AS stock,
       CASE WHEN p_size - 1 = 0 THEN 'OUT OF STOCK - reorder now' ELSE 'Low stock - reorder soon' END AS action
FROM part WHERE p_size - 1 < 10""")
def q49(t: Tables) -> DataFrame:
    # The bound is on the stored column, so that the scan can use it.
    low = t.part.where(F.col("p_size") < 11).withColumn("stock", F.col("p_size") - 1)
    return low.select("p_partkey", "p_name", "stock", stock_action("stock", 10).alias("action")).orderBy("stock", "p_partkey")


@query("q_range_vs_func", f"""
WITH {LINES}
SELECT p_type, {dbl("SUM(net_amount)")} AS revenue FROM li JOIN part ON p_partkey = l_partkey
WHERE year(l_shipdate) = 1996 AND month(l_shipdate) BETWEEN 1 AND 3 GROUP BY p_type""")
def range_predicate(t: Tables) -> DataFrame:
    per_part = (
        t.lines.where(month_range("l_shipdate", "1996-01", 3))
        .groupBy("l_partkey").agg(revenue_total().alias("revenue"))
    )
    return (
        per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_type").agg(to_double(F.sum("revenue")).alias("revenue"))
    )


@query("point_lookup", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey = 2500")
def point_lookup(t: Tables) -> DataFrame:
    return t.orders.where("o_orderkey = 2500").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("cust_history", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice FROM orders
WHERE o_custkey = 3 AND o_orderdate >= TIMESTAMP '1996-08-01'""")
def cust_history(t: Tables) -> DataFrame:
    since = F.col("o_orderdate") >= F.lit("1996-08-01").cast("timestamp_ntz")
    return (
        t.orders.where((F.col("o_custkey") == 3) & since)
        .orderBy(F.desc("o_orderdate"), "o_orderkey")
        .select("o_orderkey", F.to_date("o_orderdate").alias("order_date"), "o_totalprice")
    )


@query("returned_since", """
SELECT l_orderkey, l_linenumber, l_extendedprice AS amount FROM lineitem
WHERE l_returnflag = 'R' AND l_shipdate >= TIMESTAMP '2001-06-01'""")
def returned_since(t: Tables) -> DataFrame:
    return t.lineitem.where(
        (F.col("l_returnflag") == "R") & (F.col("l_shipdate") >= F.lit("2001-06-01").cast("timestamp_ntz"))
    ).select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("amount"))


@query("filter_agg", """
SELECT l_linestatus, COUNT(*) AS rows, COUNT(*) FILTER (WHERE l_returnflag = 'R') AS returned_rows
FROM lineitem GROUP BY l_linestatus""")
def filter_agg(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_linestatus").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("l_returnflag") == "R").alias("returned_rows"))
