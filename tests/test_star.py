"""Rankings, period reports, rollups and generators on the small star."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Window, functions as F

from abacarium.functions import quarter_label
from abacarium.operators.ordering import global_ranks, ntile
from abacarium.operators.rollups import in_report_order, rollup_report
from abacarium.operators.windows import (
    best_and_worst, period_over_period, running_and_moving, share_of_total, top_share, trend,
)
from abacarium.sources.files import table_counts
from abacarium.sources.generators import calendar


@pytest.fixture(scope="module")
def facts(star):
    return (
        star["fact_sales"].join(star["dim_date"], "date_key")
        .join(star["dim_product"].drop("unit_price"), "product_key").cache()
    )


@pytest.fixture(scope="module")
def months(facts):
    return facts.groupBy("yr_month").agg(F.sum("net_amount").alias("revenue"))


def test_row_counts(star):
    assert {r["tbl"]: r["rows"] for r in table_counts(star).collect()} == {
        "dim_date": 638, "dim_customer": 20, "dim_product": 12, "dim_store": 5, "fact_sales": 5000}


def test_date_dimension(star):
    row = star["dim_date"].where("date_key = 20260214").first()
    assert (row["day_name"], row["month_name"], row["is_weekend"], row["quarter_num"], row["yr_month"]) == (
        "Saturday", "February", True, 1, "2026-02")


def test_fiscal_calendar(spark):
    rows = calendar(spark, dt.date(2025, 3, 31), dt.date(2025, 4, 1), fiscal_start_month=4).orderBy("full_date").collect()
    assert [(r["fiscal_year"], r["fiscal_quarter"]) for r in rows] == [(2025, 4), (2026, 1)]


def test_fact_amounts(star):
    row = star["fact_sales"].where("sales_key = 7").first()
    assert (row["order_id"], row["quantity"], row["store_key"], row["product_key"]) == ("ORD-000007", 2, 4, 6)
    assert [str(row[c]) for c in ("gross_amount", "discount_amount", "net_amount")] == ["37998.00", "5699.70", "32298.30"]
    wrong = star["fact_sales"].where("abs(gross_amount - discount_amount - net_amount) > 0.01")
    assert wrong.count() == 0


def test_a_day_outside_the_calendar_drops_its_row(spark, star):
    from abacarium.sources.generators import numbers, sales_facts
    from star import STEPS

    short = star["dim_date"].where("full_date < '2026-01-01'")
    facts = sales_facts(numbers(spark, 5000), star["dim_product"], short, dt.date(2025, 1, 1), 638, 20, 12, 5, STEPS)
    assert 0 < facts.count() < 5000


def test_top_products(facts):
    revenue = facts.groupBy("product_name", "product_key").agg(F.sum("net_amount").alias("revenue"))
    ranked = global_ranks(revenue, [F.desc("revenue")], ["revenue"], ["product_key"]).orderBy("row_num").collect()
    assert [r["product_name"] for r in ranked[:2]] == ["Standing Desk", "Ergonomic Office Chair"]
    assert [r["rnk"] for r in ranked] == list(range(1, 13))


def test_quartiles_match_spark(facts):
    revenue = facts.groupBy("customer_key").agg(F.sum("net_amount").alias("revenue"))
    ordered = [F.desc("revenue"), F.col("customer_key")]
    for tiles in (3, 4, 7, 30):
        expected = revenue.select("customer_key", F.ntile(tiles).over(Window.orderBy(*ordered)).alias("tile"))
        found = ntile(revenue, ordered, tiles)
        assert sorted(found.select("customer_key", "tile").collect()) == sorted(expected.collect())


def test_rollup_total_is_plain_sum(facts):
    rows = facts.select(F.col("year_num").alias("yr"), quarter_label("quarter_num").alias("qtr"), "category", "net_amount")
    levels = ["yr", "qtr", "category"]
    report = rollup_report(rows, levels, {"revenue": "net_amount"},
                           {"yr": "ALL YEARS", "qtr": "All Quarters", "category": "All Categories"})
    listed = in_report_order(report, levels).collect()
    assert listed[-1]["yr"] == "ALL YEARS" and listed[-1]["qtr"] == "All Quarters"
    assert listed[-1]["revenue"] == facts.agg(F.sum("net_amount")).first()[0]
    assert listed[4].asDict()["category"] == "All Categories" and listed[4]["qtr"] == "Q1"
    assert len(listed) == 7 * 4 + 7 + 2 + 1


def test_rollup_labels_and_distinct(star):
    rows = star["fact_sales"].join(star["dim_customer"], "customer_key")
    report = rollup_report(rows, ["region", "state"], {"revenue": "net_amount"},
                           {"region": "GRAND TOTAL", "state": "Region subtotal"}, distinct={"orders": "order_id"},
                           blank_in_grand_total=["state"])
    total = report.where("region = 'GRAND TOTAL'").first()
    assert (total["state"], total["orders"]) == (None, 5000)
    assert report.where("state = 'Region subtotal'").count() == 4


def test_rollup_distinct_without_a_table_of_values(spark):
    rows = [("a", "x", 1, 1), ("a", "x", 1, 2), ("a", "y", 1, 4), ("b", "x", 1, 8), (None, "x", 1, 16), (None, None, 2, 32),
            ("b", "z", None, 64), ("c", "x", None, 128), ("a", None, 2, 256), ("a", "x", 3, 512)]
    df = spark.createDataFrame(rows, "r string, s string, item int, amount int")
    report = rollup_report(df, ["r", "s"], {"amount": "amount"}, {"r": "ALL", "s": "all"}, distinct={"items": "item"})
    plain = df.rollup("r", "s").agg(F.sum("amount").alias("amount"), F.countDistinct("item").alias("items"),
                                    F.grouping("r").alias("_g_r"), F.grouping("s").alias("_g_s"))
    columns = ["items", "amount", "_g_r", "_g_s"]
    assert sorted(map(str, report.select(*columns).collect())) == sorted(map(str, plain.select(*columns).collect()))
    assert report.where("_g_r = 1").first()["items"] == 3 and report.where("r = 'c'").first()["items"] == 0
    # A task sorts values, which can go to disk in pieces; it aggregates and expands groups of levels only.
    text = report._jdf.queryExecution().executedPlan().toString()
    assert not any("Aggregate(" in line and "item#" in line for line in text.splitlines()), text
    assert report.schema["items"].dataType == plain.schema["items"].dataType and not report.schema["items"].nullable


def test_month_over_month(months):
    rows = period_over_period(months, "yr_month", "revenue").withColumn("trend", trend("revenue", "prev")).orderBy(
        "yr_month").collect()
    assert len(rows) == 21 and rows[0]["growth_pct"] is None and rows[0]["trend"] == "n/a"
    assert all((r["change"] > 0) == (r["trend"] == "UP") for r in rows[1:])


def test_year_over_year_by_row_and_by_calendar(months):
    by_row = period_over_period(months, "yr_month", "revenue", 12)
    by_month = period_over_period(months, "yr_month", "revenue", 12, calendar=True)
    assert sorted(map(str, by_row.collect())) == sorted(map(str, by_month.select(*by_row.columns).collect()))
    gap = months.where("yr_month <> '2025-05'")
    row = period_over_period(gap, "yr_month", "revenue", 12, calendar=True)
    found = {r["yr_month"]: r["prev"] for r in row.collect()}
    assert found["2026-05"] is None and "2025-05" not in found
    assert found["2026-06"] == months.where("yr_month = '2025-06'").first()["revenue"]


def test_running_and_moving(months):
    rows = running_and_moving(months, "yr_month", "revenue").orderBy("yr_month").collect()
    values = [r["revenue"] for r in rows]
    assert rows[-1]["running_total"] == sum(values)
    assert rows[0]["moving_avg"] == values[0]
    assert abs(float(rows[5]["moving_avg"]) - float(sum(values[3:6])) / 3) < 0.006


def test_best_and_worst(months):
    growth = period_over_period(months, "yr_month", "revenue")
    rows = best_and_worst(growth, "growth_pct", 3, ["yr_month", "growth_pct"]).collect()
    assert [r["label"] for r in rows].count("Best") == 3 and [r["label"] for r in rows].count("Worst") == 3
    best = min(r["growth_pct"] for r in rows if r["label"] == "Best")
    assert best >= max(r["growth_pct"] for r in rows if r["label"] == "Worst")


def test_shares(star):
    revenue = star["fact_sales"].join(star["dim_customer"], "customer_key").groupBy("region", "customer_key").agg(
        F.sum("net_amount").alias("revenue"))
    best = top_share(revenue, "region", "revenue", ["customer_key"], 3).collect()
    assert len(best) == 12 and all(0 < r["pct_of_group"] < 100 for r in best)
    per_region = revenue.groupBy("region").agg(F.sum("revenue").alias("revenue"))
    assert abs(float(share_of_total(per_region, "revenue").agg(F.sum("pct_of_total")).first()[0]) - 100) < 0.05
