"""Versioned dimensions, cohorts, stock, the fiscal calendar and the summary table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from abacarium.operators.history import cohort_retention, decrement_stock, merge_versions, with_holidays
from abacarium.operators.merge import merge_dimension
from abacarium.operators.quality import Unique
from abacarium.plans.catalog import query
from abacarium.plans.checks import LINES, dbl, pct
from abacarium.plans.loads import TRACKED, day, feed, latest_sql, order_days
from abacarium.plans.tables import Tables
from abacarium.plans.totals import agg_monthly_category
from abacarium.session import stored
from abacarium.sources.generators import date_dimension


def _two_feeds(turn: str) -> str:
    before, after = f"o_orderdate < TIMESTAMP '{turn}'", f"o_orderdate >= TIMESTAMP '{turn}'"
    return f"{latest_sql('f1', before)}, {latest_sql('f2', after)}"


@query("merge_versions", f"""
WITH {_two_feeds("1996-01-01")}, j AS (
  SELECT f1.k AS k1, f1.p AS p1, f1.s AS s1, f2.k AS k2, f2.p AS p2, f2.s AS s2,
         f1.k IS NOT NULL AND f2.k IS NOT NULL AND NOT (f1.p = f2.p AND f1.s = f2.s) AS changed
  FROM f1 FULL JOIN f2 ON f1.k = f2.k)
SELECT k1 AS o_custkey, p1 AS o_orderpriority, s1 AS o_orderstatus, TIMESTAMP '1996-01-01' AS valid_from,
       CASE WHEN changed THEN TIMESTAMP '2002-01-01' END AS valid_to, NOT changed AS is_current
FROM j WHERE k1 IS NOT NULL
UNION ALL
SELECT k2, p2, s2, TIMESTAMP '2002-01-01', NULL, TRUE FROM j WHERE k1 IS NULL OR changed""")
def versions(t: Tables) -> DataFrame:
    history = t.spark.createDataFrame(
        [], "o_custkey bigint, o_orderpriority string, o_orderstatus string, valid_from timestamp_ntz, "
            "valid_to timestamp_ntz, is_current boolean")
    latest = ["o_orderdate", "o_orderkey"]
    day1 = merge_versions(history, feed(t, None, "1996-01-01"), "o_custkey", TRACKED, day("1996-01-01"), latest)
    return merge_versions(day1, feed(t, "1996-01-01", None), "o_custkey", TRACKED, day("2002-01-01"), latest)


@query("merge_soft_delete", f"""
WITH {_two_feeds("2001-01-01")}
SELECT COALESCE(f1.k, f2.k) AS o_custkey, f2.k IS NOT NULL AS is_active,
       CASE WHEN f1.k IS NULL THEN 'INSERT' WHEN f2.k IS NULL THEN 'DEACTIVATE'
            WHEN f1.p = f2.p AND f1.s = f2.s THEN 'KEEP' ELSE 'UPDATE' END AS action
FROM f1 FULL JOIN f2 ON f1.k = f2.k""")
def soft_delete(t: Tables) -> DataFrame:
    target = t.spark.createDataFrame(
        [], "o_custkey bigint, o_orderpriority string, o_orderstatus string, is_active boolean, "
            "created_at timestamp_ntz, updated_at timestamp_ntz")
    for start, end, as_of in ((None, "2001-01-01", "2001-01-01"), ("2001-01-01", None, "2002-01-01")):
        merged = merge_dimension(
            target, feed(t, start, end), "o_custkey", TRACKED, day(as_of), latest=["o_orderdate", "o_orderkey"],
            soft_delete=True)
        target = merged.drop("action")
    return merged.select("o_custkey", "is_active", "action")


@query("cohort_retention", f"""
WITH a AS (SELECT DISTINCT o_custkey, date_trunc('month', o_orderdate) AS m FROM orders),
f AS (SELECT o_custkey, MIN(m) AS c FROM a GROUP BY o_custkey), z AS (SELECT c, COUNT(*) AS n FROM f GROUP BY c)
SELECT strftime(f.c, '%Y-%m') AS cohort, date_diff('month', f.c, a.m) AS months_later, COUNT(*) AS customers,
       MAX(z.n) AS cohort_size, {pct("COUNT(*)", "MAX(z.n)")} AS retention_pct
FROM a JOIN f USING (o_custkey) JOIN z ON z.c = f.c GROUP BY f.c, date_diff('month', f.c, a.m)""")
def cohorts(t: Tables) -> DataFrame:
    report = cohort_retention(t.orders, "o_custkey", "o_orderdate")
    return report.withColumn("retention_pct", F.col("retention_pct").cast("double"))


@query("decrement_stock", """
WITH s AS (SELECT l_partkey, SUM(CAST(l_quantity AS BIGINT)) AS sold FROM lineitem GROUP BY l_partkey)
SELECT p_partkey, p_size * 30 - COALESCE(sold, 0) AS stock, p_size * 30 - COALESCE(sold, 0) < 0 AS oversold
FROM part LEFT JOIN s ON l_partkey = p_partkey""")
def stock(t: Tables) -> DataFrame:
    products = t.part.select("p_partkey", (F.col("p_size") * 30).cast("long").alias("stock"))
    return decrement_stock(products, "p_partkey", "stock", t.lines, "l_partkey", "units")


@query("dim_date_fiscal", """
SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, year(d + INTERVAL 9 MONTH) AS fiscal_year,
       quarter(d + INTERVAL 9 MONTH) AS fiscal_quarter,
       CAST(d AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders) AS is_holiday
FROM (SELECT unnest(generate_series(MIN(o_orderdate), MAX(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)""")
def fiscal(t: Tables) -> DataFrame:
    dates = date_dimension(order_days(t), fiscal_start_month=4)
    # Days without any order stand for holidays.
    busy = t.orders.select(F.to_date("o_orderdate").alias("full_date")).distinct()
    quiet = dates.select("full_date").join(busy, "full_date", "left_anti")
    return with_holidays(dates, quiet).select("date_key", "fiscal_year", "fiscal_quarter", "is_holiday")


@query("summary_table", f"""
WITH {LINES}
SELECT p_type AS category, {dbl("SUM(net_amount)")} AS revenue, SUM(units) AS units,
       COUNT(DISTINCT l_orderkey) AS orders, 0 AS duplicate_keys
FROM li JOIN part ON p_partkey = l_partkey WHERE ym = '1996-03' GROUP BY p_type""")
def summary_table(t: Tables) -> DataFrame:
    # Written once; dashboards read single months of it, and its key is checked.
    table = stored(agg_monthly_category(t), "summary")
    key = Unique("month and category", "summary", ("yr_month", "category"))
    duplicates = key.violations({"summary": table}).agg(F.count(F.lit(1))).scalar()
    return table.where("yr_month = '1996-03'").drop("yr_month").withColumn("duplicate_keys", duplicates)
