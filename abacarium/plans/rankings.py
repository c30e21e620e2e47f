"""Rankings, period reports and rollups on the star of facts and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from abacarium.functions import labels, month_label, month_start, percent, quarter_label, to_double
from abacarium.operators.ordering import global_ranks, ntile
from abacarium.operators.reports import per_month
from abacarium.operators.rollups import in_report_order, rollup_report
from abacarium.operators.windows import (
    best_and_worst, cumulative, neighbours, period_over_period, running_and_moving, share_of_total, top_k_per_group,
    top_share, trend,
)
from abacarium.plans.catalog import query
from abacarium.plans.checks import LINES, MONTHS, SUMMARY, VALID_LINES, dbl, mean as sql_mean, pct
from abacarium.plans.tables import Tables, gross_total, revenue_total


def _part_revenue(t: Tables) -> DataFrame:
    """Revenue per product with its category; facts are added up before the join."""
    per_part = t.lines.groupBy("l_partkey").agg(revenue_total().alias("revenue"))
    return per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "p_partkey", "p_name", "p_type", "p_brand", "revenue")


def _customer_revenue(t: Tables) -> DataFrame:
    """Revenue per customer with nation and region."""
    per_order = t.lines.groupBy("l_orderkey").agg(revenue_total().alias("revenue"))
    per_customer = (
        per_order.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey").agg(F.sum("revenue").alias("revenue"))
    )
    return (
        per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.geography, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_name", "n_name", "r_name", "revenue")
    )


_PART_REVENUE = LINES + """, pr AS (
  SELECT p_partkey, p_name, p_type, p_brand, SUM(net_amount) AS revenue FROM li JOIN part ON p_partkey = l_partkey
  GROUP BY p_partkey, p_name, p_type, p_brand)"""

_CUSTOMER_REVENUE = LINES + """, cr AS (
  SELECT c_custkey, c_name, n_name, r_name, SUM(net_amount) AS revenue
  FROM li JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
  GROUP BY c_custkey, c_name, n_name, r_name)"""


@query("w1_three_ranks", f"""
WITH {_PART_REVENUE}
SELECT p_partkey, p_name, p_type, {dbl("revenue")} AS revenue, RANK() OVER (ORDER BY revenue DESC) AS rnk,
       DENSE_RANK() OVER (ORDER BY revenue DESC) AS dense_rnk,
       ROW_NUMBER() OVER (ORDER BY revenue DESC, p_partkey) AS row_num FROM pr""")
def w1(t: Tables) -> DataFrame:
    ranked = global_ranks(
        _part_revenue(t).drop("p_brand"), [F.desc("revenue")], ["revenue"], ["p_partkey"])
    return ranked.withColumn("revenue", to_double("revenue")).orderBy("row_num")


@query("w2_top2_category", f"""
WITH {_PART_REVENUE}, r AS (
  SELECT *, RANK() OVER (PARTITION BY p_type ORDER BY revenue DESC) AS rank_in_category FROM pr)
SELECT p_type AS category, p_partkey, p_name, {dbl("revenue")} AS revenue, rank_in_category
FROM r WHERE rank_in_category <= 2""")
def w2(t: Tables) -> DataFrame:
    best = top_k_per_group(_part_revenue(t), ["p_type"], [F.desc("revenue")], 2, ties=True, name="rank_in_category")
    return best.select(
        F.col("p_type").alias("category"), "p_partkey", "p_name", to_double("revenue").alias("revenue"),
        "rank_in_category").orderBy("category", "rank_in_category")


@query("w3_top3_share", f"""
WITH {_CUSTOMER_REVENUE}, t AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY r_name ORDER BY revenue DESC, c_custkey) AS rn,
         SUM(revenue) OVER (PARTITION BY r_name) AS region_total FROM cr)
SELECT r_name AS region, c_custkey, c_name AS customer, {dbl("revenue")} AS revenue, rn,
       {pct("revenue", "region_total")} AS pct_of_region FROM t WHERE rn <= 3""")
def w3(t: Tables) -> DataFrame:
    best = top_share(_customer_revenue(t), "r_name", "revenue", ["c_custkey"], 3, "pct_of_region")
    return best.select(
        F.col("r_name").alias("region"), "c_custkey", F.col("c_name").alias("customer"),
        to_double("revenue").alias("revenue"), "rn", F.col("pct_of_region").cast("double").alias("pct_of_region"),
    ).orderBy("region", "rn")


@query("w4_quartiles", f"""
WITH {_CUSTOMER_REVENUE}
SELECT c_custkey, c_name AS customer, {dbl("revenue")} AS revenue,
       NTILE(4) OVER (ORDER BY revenue DESC, c_custkey) AS spend_quartile FROM cr""")
def w4(t: Tables) -> DataFrame:
    tiled = ntile(_customer_revenue(t), [F.desc("revenue"), "c_custkey"], 4, "spend_quartile")
    return tiled.select(
        "c_custkey", F.col("c_name").alias("customer"), to_double("revenue").alias("revenue"), "spend_quartile",
    ).orderBy(F.desc("revenue"), "c_custkey")


@query("w5_running_moving", f"""
WITH {MONTHS}, w AS (
  SELECT ym, revenue, SUM(revenue) OVER (ORDER BY ym ROWS UNBOUNDED PRECEDING) AS running,
         SUM(revenue) OVER (ORDER BY ym ROWS 2 PRECEDING) AS three, COUNT(*) OVER (ORDER BY ym ROWS 2 PRECEDING) AS n
  FROM months)
SELECT ym AS yr_month, {dbl("revenue")} AS monthly_rev, {dbl("running")} AS running_total,
       {sql_mean("three", "n")} AS moving_avg_3m FROM w""")
def w5(t: Tables) -> DataFrame:
    report = running_and_moving(t.months, "ym", "revenue", 3, "running_total", "moving_avg_3m")
    return report.select(
        F.col("ym").alias("yr_month"), to_double("revenue").alias("monthly_rev"),
        to_double("running_total").alias("running_total"), F.col("moving_avg_3m").cast("double").alias("moving_avg_3m"),
    ).orderBy("yr_month")


@query("w6_lag_lead", f"""
WITH {MONTHS}
SELECT ym AS yr_month, {dbl("revenue")} AS revenue, {dbl("LAG(revenue) OVER w")} AS prev_month,
       {dbl("LEAD(revenue) OVER w")} AS next_month FROM months WINDOW w AS (ORDER BY ym)""")
def w6(t: Tables) -> DataFrame:
    report = neighbours(t.months, "ym", "revenue", "prev_month", "next_month")
    return report.select(
        F.col("ym").alias("yr_month"), *[to_double(c).alias(c) for c in ("revenue", "prev_month", "next_month")],
    ).orderBy("yr_month")


@query("w7_best_of_month", f"""
WITH {LINES}, mp AS (SELECT ym, l_partkey, SUM(net_amount) AS revenue FROM li GROUP BY ym, l_partkey),
r AS (SELECT *, RANK() OVER (PARTITION BY ym ORDER BY revenue DESC) AS rnk FROM mp)
SELECT ym AS yr_month, p_partkey, p_name, {dbl("revenue")} AS revenue FROM r JOIN part ON p_partkey = l_partkey
WHERE rnk = 1""")
def w7(t: Tables) -> DataFrame:
    monthly = t.lines.groupBy(month_start("l_shipdate").alias("month"), "l_partkey").agg(
        revenue_total().alias("revenue"))
    best = top_k_per_group(monthly, ["month"], [F.desc("revenue")], 1, ties=True, name=None)
    # Only the best are joined to their names.
    return best.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        month_label("month").alias("yr_month"), "p_partkey", "p_name", to_double("revenue").alias("revenue"),
    ).orderBy("yr_month")


@query("q33_best_in_category", f"""
WITH {VALID_LINES}, s AS (
  SELECT p_type AS category, p_partkey, p_name, SUM(units) AS units_sold,
         RANK() OVER (PARTITION BY p_type ORDER BY SUM(units) DESC) AS rnk
  FROM vl JOIN part ON p_partkey = l_partkey GROUP BY p_type, p_partkey, p_name)
SELECT category, p_partkey, p_name, units_sold FROM s WHERE rnk = 1""")
def q33(t: Tables) -> DataFrame:
    per_part = t.valid_lines.groupBy("l_partkey").agg(F.sum("units").alias("units_sold"))
    named = per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_type").alias("category"), "p_partkey", "p_name", "units_sold")
    return top_k_per_group(named, ["category"], [F.desc("units_sold")], 1, ties=True, name=None)


@query("q42_state_rank", f"""
WITH {SUMMARY}, s AS (
  SELECT n_name AS state, c_custkey, c_name AS customer, SUM(net_amount) AS spend
  FROM sales JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  GROUP BY n_name, c_custkey, c_name)
SELECT state, c_custkey, customer, {dbl("spend")} AS total_spent,
       DENSE_RANK() OVER (PARTITION BY state ORDER BY spend DESC) AS state_rank FROM s""")
def q42(t: Tables) -> DataFrame:
    spend = (
        t.sales.groupBy("o_custkey").agg(F.sum("net_amount").alias("spend"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.geography, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("n_name").alias("state"), "c_custkey", F.col("c_name").alias("customer"), "spend")
    )
    # A state may hold a third of all customers, so its ranks are not left to one task.
    ranked = global_ranks(
        spend, [F.desc("spend")], ["spend"], ["c_custkey"], within=["state"], row_number=None, rank=None,
        dense_rank="state_rank")
    return ranked.select("state", "c_custkey", "customer", to_double("spend").alias("total_spent"), "state_rank").orderBy(
        "state", "state_rank", "c_custkey")


def _sales_months(t: Tables) -> DataFrame:
    return per_month(t.sales, "o_orderdate", "ym", F.sum("net_amount").alias("revenue"))


_SALES_MONTHS = SUMMARY + """, monthly AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS ym, SUM(net_amount) AS revenue FROM sales GROUP BY 1)"""


@query("q44_cumulative", f"""
WITH {_SALES_MONTHS}
SELECT ym, {dbl("revenue")} AS revenue, {dbl("SUM(revenue) OVER (ORDER BY ym)")} AS running_total FROM monthly""")
def q44(t: Tables) -> DataFrame:
    return cumulative(_sales_months(t), "ym", "revenue").select(
        "ym", to_double("revenue").alias("revenue"), to_double("running_total").alias("running_total"))


@query("q45_mom", f"""
WITH {_SALES_MONTHS}, p AS (SELECT ym, revenue, LAG(revenue) OVER (ORDER BY ym) AS prev FROM monthly)
SELECT ym, {dbl("revenue")} AS revenue, {dbl("prev")} AS prev_month, {pct("revenue - prev", "prev")} AS growth_pct
FROM p""")
def q45(t: Tables) -> DataFrame:
    report = period_over_period(_sales_months(t), "ym", "revenue", previous="prev_month")
    return report.select(
        "ym", *[to_double(c).alias(c) for c in ("revenue", "prev_month")], F.col("growth_pct").cast("double"))


@query("m1_mom_report", f"""
WITH {LINES}, m AS (
  SELECT ym, SUM(net_amount) AS revenue, COUNT(DISTINCT l_orderkey) AS orders, SUM(units) AS units FROM li GROUP BY ym),
p AS (SELECT *, LAG(revenue) OVER (ORDER BY ym) AS prev FROM m)
SELECT ym AS yr_month, {dbl("revenue")} AS revenue, orders, units, {dbl("revenue - prev")} AS mom_change,
       {pct("revenue - prev", "prev")} AS mom_pct,
       CASE WHEN prev IS NULL THEN 'n/a' WHEN revenue > prev THEN 'UP' WHEN revenue < prev THEN 'DOWN'
            ELSE 'FLAT' END AS trend FROM p""")
def m1(t: Tables) -> DataFrame:
    per_order = t.lines.groupBy(month_start("l_shipdate").alias("month"), "l_orderkey").agg(
        revenue_total().alias("revenue"), F.sum("units").alias("units"))
    monthly = per_month(
        per_order, "month", "yr_month", F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("orders"),
        F.sum("units").alias("units"))
    report = period_over_period(monthly, "yr_month", "revenue", change="mom_change", growth="mom_pct")
    return report.select(
        "yr_month", to_double("revenue").alias("revenue"), "orders", "units",
        to_double("mom_change").alias("mom_change"), F.col("mom_pct").cast("double"),
        trend("revenue", "prev").alias("trend")).orderBy("yr_month")


@query("m2_mom_category", f"""
WITH {LINES}, m AS (
  SELECT ym, p_type AS category, SUM(net_amount) AS revenue FROM li JOIN part ON p_partkey = l_partkey
  GROUP BY ym, p_type),
p AS (SELECT *, LAG(revenue) OVER (PARTITION BY category ORDER BY ym) AS prev FROM m)
SELECT ym AS yr_month, category, {dbl("revenue")} AS revenue, {pct("revenue - prev", "prev")} AS mom_pct FROM p""")
def m2(t: Tables) -> DataFrame:
    facts = t.lines.join(t.part, F.col("l_partkey") == F.col("p_partkey")).withColumnRenamed("p_type", "category")
    monthly = per_month(facts, "l_shipdate", "yr_month", revenue_total().alias("revenue"), by=["category"])
    report = period_over_period(monthly, "yr_month", "revenue", partition=["category"], growth="mom_pct")
    return report.select(
        "yr_month", "category", to_double("revenue").alias("revenue"), F.col("mom_pct").cast("double"),
    ).orderBy("category", "yr_month")


def _yoy(t: Tables, calendar: bool) -> DataFrame:
    report = period_over_period(
        t.months, "ym", "revenue", 12, calendar=calendar, previous="same_month_last_year", growth="yoy_pct")
    return report.select(
        F.col("ym").alias("yr_month"), *[to_double(c).alias(c) for c in ("revenue", "same_month_last_year")],
        F.col("yoy_pct").cast("double")).orderBy("yr_month")


_YOY = f"""
SELECT ym AS yr_month, {dbl("revenue")} AS revenue, {dbl("prev")} AS same_month_last_year,
       {pct("revenue - prev", "prev")} AS yoy_pct FROM p"""


@query("m3_yoy", f"WITH {MONTHS}, p AS (SELECT *, LAG(revenue, 12) OVER (ORDER BY ym) AS prev FROM months) {_YOY}")
def m3(t: Tables) -> DataFrame:
    return _yoy(t, calendar=False)


@query("m3_yoy_calendar", f"""
WITH {MONTHS}, p AS (
  SELECT a.*, b.revenue AS prev FROM months a LEFT JOIN months b
  ON b.ym = strftime(CAST(a.ym || '-01' AS DATE) - INTERVAL 12 MONTH, '%Y-%m')) {_YOY}""")
def m3_calendar(t: Tables) -> DataFrame:
    return _yoy(t, calendar=True)


@query("m4_best_worst", f"""
WITH {MONTHS}, p AS (SELECT *, LAG(revenue) OVER (ORDER BY ym) AS prev FROM months),
g AS (SELECT ym, {pct("revenue - prev", "prev")} AS mom_pct,
             100.0 * CAST(revenue - prev AS DOUBLE) / CAST(prev AS DOUBLE) AS exact FROM p WHERE prev IS NOT NULL),
r AS (SELECT *, RANK() OVER (ORDER BY exact DESC) AS best, RANK() OVER (ORDER BY exact) AS worst FROM g)
SELECT 'Best' AS label, ym AS yr_month, mom_pct FROM r WHERE best <= 3
UNION ALL SELECT 'Worst', ym, mom_pct FROM r WHERE worst <= 3""")
def m4(t: Tables) -> DataFrame:
    growth = period_over_period(t.months.withColumnRenamed("ym", "yr_month"), "yr_month", "revenue", growth="mom_pct")
    # Ranked before rounding.
    growth = growth.withColumn("exact", percent("change", "prev"))
    return best_and_worst(growth, "exact", 3, ["yr_month", F.col("mom_pct").cast("double")])


_R1_LEVELS = ["yr", "qtr", "category"]


@query("r1_time_rollup", f"""
WITH {LINES}, r AS (
  SELECT year(l_shipdate) AS y, quarter(l_shipdate) AS q, p_type AS c, SUM(net_amount) AS revenue,
         GROUPING(year(l_shipdate)) AS gy, GROUPING(quarter(l_shipdate)) AS gq, GROUPING(p_type) AS gc
  FROM li JOIN part ON p_partkey = l_partkey GROUP BY ROLLUP (year(l_shipdate), quarter(l_shipdate), p_type))
SELECT CASE WHEN gy = 1 THEN 'ALL YEARS' ELSE CAST(y AS VARCHAR) END AS yr,
       CASE WHEN gq = 1 THEN 'All Quarters' ELSE 'Q' || q END AS qtr,
       CASE WHEN gc = 1 THEN 'All Categories' ELSE c END AS category, {dbl("revenue")} AS revenue FROM r""")
def r1(t: Tables) -> DataFrame:
    facts = t.lines.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.year("l_shipdate").alias("yr"), quarter_label(F.quarter("l_shipdate")).alias("qtr"),
        F.col("p_type").alias("category"), "net_cents")
    report = rollup_report(
        facts, _R1_LEVELS, {"revenue": revenue_total()},
        {"yr": labels.ALL_YEARS, "qtr": labels.ALL_QUARTERS, "category": labels.ALL_CATEGORIES})
    return in_report_order(report, _R1_LEVELS).withColumn("revenue", to_double("revenue"))


@query("r2_geo_rollup", f"""
WITH {LINES}, r AS (
  SELECT r_name AS r, n_name AS n, COUNT(DISTINCT l_orderkey) AS orders, SUM(net_amount) AS revenue,
         GROUPING(r_name) AS gr, GROUPING(n_name) AS gn
  FROM li JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY ROLLUP (r_name, n_name))
SELECT CASE WHEN gr = 1 THEN 'GRAND TOTAL' ELSE r END AS region,
       CASE WHEN gn = 1 AND gr = 0 THEN 'Region subtotal' ELSE n END AS state, orders, {dbl("revenue")} AS revenue
FROM r""")
def r2(t: Tables) -> DataFrame:
    # An order has one customer, hence one state: its lines are added up first, and orders can be counted by sums.
    per_order = t.lines.groupBy("l_orderkey").agg(revenue_total().alias("revenue"))
    facts = (
        per_order.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.geography, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("r_name").alias("region"), F.col("n_name").alias("state"), "revenue", F.lit(1).alias("one"))
    )
    report = rollup_report(
        facts, ["region", "state"], {"orders": "one", "revenue": "revenue"},
        {"region": labels.GRAND_TOTAL, "state": labels.REGION_SUBTOTAL}, blank_in_grand_total=["state"])
    return in_report_order(report, ["region", "state"]).withColumn("revenue", to_double("revenue"))


@query("r2_geo_rollup_distinct", f"""
WITH {LINES}, r AS (
  SELECT r_name AS r, n_name AS n, COUNT(DISTINCT l_orderkey) AS orders, SUM(net_amount) AS revenue,
         GROUPING(r_name) AS gr, GROUPING(n_name) AS gn
  FROM li JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY ROLLUP (r_name, n_name))
SELECT CASE WHEN gr = 1 THEN 'GRAND TOTAL' ELSE r END AS region,
       CASE WHEN gn = 1 AND gr = 0 THEN 'Region subtotal' ELSE n END AS state, orders, {dbl("revenue")} AS revenue
FROM r""")
def r2_distinct(t: Tables) -> DataFrame:
    # By supplier geography one order counts in several states, so the distinct count is needed.
    facts = (
        t.lines.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.geography, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("r_name").alias("region"), F.col("n_name").alias("state"), "l_orderkey", "net_cents")
    )
    report = rollup_report(
        facts, ["region", "state"], {"revenue": revenue_total()},
        {"region": labels.GRAND_TOTAL, "state": labels.REGION_SUBTOTAL}, distinct={"orders": "l_orderkey"},
        blank_in_grand_total=["state"])
    return in_report_order(report, ["region", "state"]).withColumn("revenue", to_double("revenue"))


@query("r3_channel_rollup", f"""
WITH {LINES}, r AS (
  SELECT n_name AS c, s_name AS s, SUM(net_amount) AS revenue, SUM(gross - net_amount) AS discounts,
         GROUPING(n_name) AS gc, GROUPING(s_name) AS gs
  FROM li JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
  GROUP BY ROLLUP (n_name, s_name))
SELECT CASE WHEN gc = 1 THEN 'ALL CHANNELS' ELSE c END AS channel,
       CASE WHEN gs = 1 THEN 'Channel subtotal' ELSE s END AS store,
       {dbl("revenue")} AS revenue, {dbl("discounts")} AS discounts FROM r""")
def r3(t: Tables) -> DataFrame:
    per_store = t.lines.groupBy("l_suppkey").agg(
        revenue_total().alias("revenue"), (gross_total() - revenue_total()).alias("discounts"))
    facts = (
        per_store.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("n_name").alias("channel"), F.col("s_name").alias("store"), "revenue", "discounts")
    )
    report = rollup_report(
        facts, ["channel", "store"], {"revenue": "revenue", "discounts": "discounts"},
        {"channel": labels.ALL_CHANNELS, "store": labels.CHANNEL_SUBTOTAL})
    return in_report_order(report, ["channel", "store"]).withColumns(
        {c: to_double(c) for c in ("revenue", "discounts")})


@query("r4_pct_total", f"""
WITH {LINES}, c AS (
  SELECT p_type AS category, SUM(net_amount) AS revenue FROM li JOIN part ON p_partkey = l_partkey GROUP BY p_type)
SELECT category, {dbl("revenue")} AS revenue, {pct("revenue", "(SELECT SUM(revenue) FROM c)")} AS pct_of_total
FROM c""")
def r4(t: Tables) -> DataFrame:
    per_category = _part_revenue(t).groupBy(F.col("p_type").alias("category")).agg(F.sum("revenue").alias("revenue"))
    return share_of_total(per_category, "revenue").select(
        "category", to_double("revenue").alias("revenue"), F.col("pct_of_total").cast("double")).orderBy(
        F.desc("revenue"))
