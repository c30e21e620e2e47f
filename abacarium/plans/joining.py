"""Join queries: inner, outer, semi, anti, self, theta, division."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from abacarium.functions import labels, mean, text_or, to_double
from abacarium.operators.joins import (
    above_average, bought_all, full_outer_rows, not_in, pair_counts, with_match, without_match,
)
from abacarium.plans.catalog import query
from abacarium.plans.checks import LINES, SUMMARY, VALID_LINES, dbl, mean as sql_mean
from abacarium.plans.tables import Tables, gross_total, revenue_total, valid_sale



@query("q22_order_detail", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, c_name AS customer, p_partkey, p_name, l_quantity,
       l_extendedprice AS line_total
FROM orders JOIN customer ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
JOIN part ON p_partkey = l_partkey""")
def q22(t: Tables) -> DataFrame:
    return (
        t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
        .join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            "o_orderkey", F.to_date("o_orderdate").alias("order_date"), F.col("c_name").alias("customer"),
            "p_partkey", "p_name", "l_quantity", F.col("l_extendedprice").alias("line_total"),
        )
        .orderBy("o_orderkey", "p_name", "p_partkey")
    )


def _supplied_parts(t: Tables) -> DataFrame:
    # A modulus above the number of suppliers leaves some parts without one.
    modulus = F.floor(t.supplier.agg(F.count(F.lit(1))).scalar() * 1.5)
    return t.part.withColumn("supplier_id", F.col("p_partkey") % modulus)


_SUPPLIED = "p_partkey % (SELECT CAST(floor(COUNT(*) * 1.5) AS BIGINT) FROM supplier)"


@query("q09_left_label", f"""
SELECT p_partkey, p_name, COALESCE(s_name, 'No supplier assigned') AS supplier
FROM part LEFT JOIN supplier ON s_suppkey = {_SUPPLIED}""")
def q09(t: Tables) -> DataFrame:
    return (
        _supplied_parts(t)
        .join(t.supplier, F.col("supplier_id") == F.col("s_suppkey"), "left")
        .orderBy(F.col("s_suppkey").isNull().desc(), "p_partkey")
        .select("p_partkey", "p_name", text_or("s_name", labels.NO_SUPPLIER).alias("supplier"))
    )


@query("q26_catalogue", f"""
SELECT p_partkey, p_name, p_type, products, COALESCE(s_name, '-') AS supplier, p_retailprice
FROM part JOIN (SELECT p_type AS category, COUNT(*) AS products FROM part GROUP BY p_type) ON category = p_type
LEFT JOIN supplier ON s_suppkey = {_SUPPLIED}""")
def q26(t: Tables) -> DataFrame:
    categories = t.part.groupBy(F.col("p_type").alias("category")).agg(F.count(F.lit(1)).alias("products"))
    return (
        _supplied_parts(t)
        .join(categories, F.col("p_type") == F.col("category"))
        .join(t.supplier, F.col("supplier_id") == F.col("s_suppkey"), "left")
        .select("p_partkey", "p_name", "p_type", "products", text_or("s_name", labels.NO_SUPPLIER_SHORT).alias("supplier"), "p_retailprice")
        .orderBy("p_type", "p_name", "p_partkey")
    )


@query("q23_anti_customers", """
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def q23(t: Tables) -> DataFrame:
    empty = without_match(t.orders, t.lineitem, {"o_orderkey": "l_orderkey"})
    return empty.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date"))


@query("q24_anti_products", """
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus IN ('F', 'O'))""")
def q24(t: Tables) -> DataFrame:
    return without_match(t.customer, t.orders.where(valid_sale()), {"c_custkey": "o_custkey"}).select(
        "c_custkey", "c_name", "c_mktsegment")


@query("q25_anti_categories", """
SELECT DISTINCT p_type, CAST(l_shipdate AS DATE) AS ship_date FROM lineitem JOIN part ON p_partkey = l_partkey
EXCEPT
SELECT p_type, CAST(l_shipdate AS DATE) FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'R'""")
def q25(t: Tables) -> DataFrame:
    cells = (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_type", F.to_date("l_shipdate").alias("ship_date"))
        .agg(F.bool_or(F.col("l_returnflag") == "R").alias("has_return"))
    )
    # The cells with a return come from the same rows, so one pass answers the anti join.
    return cells.where(~F.col("has_return")).select("p_type", "ship_date")


@query("q27_self_join", """
SELECT c.c_custkey, c.c_name AS customer, COALESCE(r.c_name, 'Organic signup') AS referred_by
FROM customer c LEFT JOIN customer r
  ON r.c_custkey = CASE WHEN c.c_custkey % 3 = 0 THEN c.c_custkey // 2 END""")
def q27(t: Tables) -> DataFrame:
    referred = t.customer.withColumn("referrer", F.when(F.col("c_custkey") % 3 == 0, F.expr("c_custkey div 2")))
    known = F.col("referrer").isNotNull()
    # Most customers have no referrer; they do not take part in the join, where they would be one hot key.
    named = referred.where(known).join(
        t.customer.select(F.col("c_custkey").alias("referrer"), F.col("c_name").alias("referrer_name")), "referrer", "left")
    alone = referred.where(~known).withColumn("referrer_name", F.lit(None).cast("string"))
    return (
        named.unionByName(alone)
        .select("c_custkey", F.col("c_name").alias("customer"), text_or("referrer_name", labels.ORGANIC).alias("referred_by"))
        .orderBy("c_custkey")
    )


@query("q28_customer_category", f"""
WITH {VALID_LINES}
SELECT c_custkey, c_name AS customer, p_type, SUM(units) AS units, {dbl("SUM(gross)")} AS spend
FROM vl JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey
GROUP BY c_custkey, c_name, p_type""")
def q28(t: Tables) -> DataFrame:
    per_cell = (
        t.valid_lines.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("o_custkey", "p_type")
        .agg(F.sum("units").alias("units"), gross_total().alias("spend"))
    )
    return (
        per_cell.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .select("c_custkey", F.col("c_name").alias("customer"), "p_type", "units", to_double("spend").alias("spend"))
        .orderBy("customer", F.desc("spend"), "c_custkey", "p_type")
    )


@query("q29_basket_pairs", """
WITH items AS (SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT a.p_brand AS brand_a, b.p_brand AS brand_b, COUNT(*) AS times
FROM items a JOIN items b ON a.l_orderkey = b.l_orderkey AND a.p_brand < b.p_brand
GROUP BY a.p_brand, b.p_brand""")
def q29(t: Tables) -> DataFrame:
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return pair_counts(lines, "l_orderkey", "p_brand", ("brand_a", "brand_b", "times")).orderBy(
        F.desc("times"), "brand_a", "brand_b")


@query("q30_full_outer", """
WITH o AS (SELECT o_orderkey, o_custkey + 100 AS o_custkey, CAST(o_orderdate AS DATE) AS order_date FROM orders)
SELECT c_custkey, c_name, o_orderkey, order_date FROM customer LEFT JOIN o ON o_custkey = c_custkey
UNION
SELECT c_custkey, c_name, o_orderkey, order_date FROM o LEFT JOIN customer ON o_custkey = c_custkey""")
def q30(t: Tables) -> DataFrame:
    # Shifted keys give both sides rows without a partner.
    shifted = t.orders.select(
        "o_orderkey", (F.col("o_custkey") + 100).alias("o_custkey"), F.to_date("o_orderdate").alias("order_date"))
    both = full_outer_rows(t.customer.select("c_custkey", "c_name"), shifted, {"c_custkey": "o_custkey"})
    return both.select("c_custkey", "c_name", "o_orderkey", "order_date")


def _lost_buyers(t: Tables, nulls: bool) -> DataFrame:
    """Customers of lost orders, with a NULL for each order of the lowest priority if asked for."""
    known = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")) if nulls else F.col("o_custkey")
    return t.orders.where(F.col("o_orderstatus") == "P").select(known.alias("buyer"))


_LOST = "FROM orders WHERE o_orderstatus = 'P'"
_WITH_NULLS = f"SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS buyer {_LOST}"


@query("q12a_not_in", f"SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN ({_WITH_NULLS})")
def q12a(t: Tables) -> DataFrame:
    return not_in(t.customer.select("c_custkey", "c_name"), "c_custkey", _lost_buyers(t, True), "buyer")


@query("q12a_not_in_without_nulls", f"SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey {_LOST})")
def q12a_plain(t: Tables) -> DataFrame:
    return not_in(t.customer.select("c_custkey", "c_name"), "c_custkey", _lost_buyers(t, False), "buyer")


@query("q12b_not_exists", f"""
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM ({_WITH_NULLS}) WHERE buyer = c_custkey)""")
def q12b(t: Tables) -> DataFrame:
    return without_match(t.customer.select("c_custkey", "c_name"), _lost_buyers(t, True), {"c_custkey": "buyer"})


@query("q47_semi", """
SELECT p_partkey, p_name FROM part WHERE p_partkey IN (
  SELECT l_partkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey WHERE n_name = 'NATION_7')""")
def q47(t: Tables) -> DataFrame:
    city = t.nation.where("n_name = 'NATION_7'")
    buyers = with_match(t.customer, city, {"c_nationkey": "n_nationkey"})
    orders = with_match(t.orders, buyers, {"o_custkey": "c_custkey"})
    bought = with_match(t.lineitem, orders, {"l_orderkey": "o_orderkey"})
    return with_match(t.part, bought, {"p_partkey": "l_partkey"}).select("p_partkey", "p_name")


@query("q48_unpaid", """
SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS order_date, 'No payment row' AS payment_state
FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'F')""")
def q48(t: Tables) -> DataFrame:
    # Only orders without a partner survive, so the state can only be the fallback.
    unpaid = without_match(t.orders, t.lineitem.where("l_linestatus = 'F'"), {"o_orderkey": "l_orderkey"})
    return unpaid.select("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("order_date"),
                         F.lit(labels.NO_PAYMENT).alias("payment_state"))


@query("q50_division", """
SELECT c_custkey, c_name AS customer FROM customer JOIN (
  SELECT o_custkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
  WHERE o_orderstatus IN ('F', 'O') AND p_type IN ('PROMO', 'ECONOMY')
  GROUP BY o_custkey HAVING COUNT(DISTINCT p_type) = 2) ON o_custkey = c_custkey""")
def q50(t: Tables) -> DataFrame:
    orders = t.orders.where(valid_sale())
    lines = (
        t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    )
    both = bought_all(lines, "o_custkey", "p_type", ["PROMO", "ECONOMY"])
    return t.customer.join(both, F.col("c_custkey") == F.col("o_custkey")).select(
        "c_custkey", F.col("c_name").alias("customer"))


@query("q36_above_avg", f"""
WITH returned AS (SELECT l_partkey, CAST(l_quantity AS BIGINT) AS rating FROM lineitem WHERE l_returnflag = 'R')
SELECT p_partkey, p_name, {sql_mean("SUM(rating)", "COUNT(*)")} AS avg_rating
FROM part JOIN returned ON l_partkey = p_partkey GROUP BY p_partkey, p_name
HAVING SUM(rating) * (SELECT COUNT(*) FROM returned) > (SELECT SUM(rating) FROM returned) * COUNT(*)""")
def q36(t: Tables) -> DataFrame:
    per_part = (
        t.lines.where("l_returnflag = 'R'").groupBy("l_partkey")
        .agg(F.sum("units").alias("total"), F.count(F.lit(1)).alias("reviews"))
    )
    better = above_average(per_part, "total", "reviews")
    return (
        better.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select("p_partkey", "p_name", mean("total", "reviews").cast("double").alias("avg_rating"))
        .orderBy(F.desc("avg_rating"), "p_partkey")
    )


@query("q39_above_avg_spend", f"""
WITH {SUMMARY}, spend AS (SELECT o_custkey, SUM(net_amount) AS total FROM sales GROUP BY o_custkey)
SELECT c_custkey, c_name AS customer, {dbl("total")} AS total_spent FROM spend JOIN customer ON c_custkey = o_custkey
WHERE total * (SELECT COUNT(*) FROM spend) > (SELECT SUM(total) FROM spend)""")
def q39(t: Tables) -> DataFrame:
    spend = t.sales.groupBy("o_custkey").agg(F.sum("net_amount").alias("total"))
    return (
        above_average(spend, "total")
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .select("c_custkey", F.col("c_name").alias("customer"), to_double("total").alias("total_spent"))
    )


@query("star_join", f"""
WITH {LINES}
SELECT n_name AS store_nation, c_mktsegment, p_type, SUM(units) AS units, {dbl("SUM(net_amount)")} AS revenue
FROM li JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
JOIN nation ON n_nationkey = s_nationkey JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
GROUP BY n_name, c_mktsegment, p_type""")
def star_join(t: Tables) -> DataFrame:
    return (
        t.lines.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("s_nationkey", "c_mktsegment", "p_type")
        .agg(F.sum("units").alias("units"), revenue_total().alias("revenue"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("store_nation"), "c_mktsegment", "p_type")
        .agg(F.sum("units").alias("units"), to_double(F.sum("revenue")).alias("revenue"))
    )


@query("city_category_top10", f"""
WITH {LINES}
SELECT n_name AS city, p_type AS category, {dbl("SUM(gross)")} AS revenue, COUNT(*) AS orders
FROM li JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey JOIN part ON p_partkey = l_partkey
WHERE l_returnflag <> 'R' GROUP BY n_name, p_type ORDER BY SUM(gross) DESC, n_name, p_type LIMIT 10""")
def city_category_top10(t: Tables) -> DataFrame:
    fact = t.lines.where("l_returnflag <> 'R'").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"), "gross_cents")
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    return (
        fact.join(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey")
        .join(customers, "o_custkey")
        .join(t.part.select("p_partkey", "p_type"), "p_partkey")
        .groupBy("n_nationkey", "p_type")
        .agg(gross_total().alias("gross"), F.count(F.lit(1)).alias("orders"))
        .join(t.nation, "n_nationkey")
        .groupBy(F.col("n_name").alias("city"), F.col("p_type").alias("category"))
        .agg(F.sum("gross").alias("gross"), F.sum("orders").alias("orders"))
        .orderBy(F.desc("gross"), "city", "category").limit(10)
        .select("city", "category", to_double("gross").alias("revenue"), "orders")
    )
