"""Reports on the small shop against known results."""

from __future__ import annotations

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from abacarium.functions import contains_any_ci, in_range, mean, month_of, text_or
from abacarium.operators.joins import (
    above_average, bought_all, full_outer_rows, not_in, pair_counts, with_match, without_match,
)
from abacarium.operators.reports import (
    lifetime_value, lost_rate, margin, revenue_card, spend_per_customer, spend_segment, stock_action,
)
from abacarium.operators.windows import cumulative, period_over_period, top_k_per_group
from declared import LOST_ORDER, VALID_SALE


@pytest.fixture(scope="module")
def sales(shop):
    return shop["summary"].where(F.col("status").isin(*VALID_SALE))


@pytest.fixture(scope="module")
def lines(shop):
    """Lines of valid sales with product and category."""
    orders = shop["orders"].where(F.col("status").isin(*VALID_SALE)).select("order_id", "customer_id")
    return (
        shop["order_items"].join(orders, "order_id").join(shop["products"], "product_id")
        .join(shop["categories"], "category_id")
    )


def ids(df, column):
    return sorted(row[0] for row in df.select(column).collect())


def test_row_counts(shop):
    counts = {name: df.count() for name, df in shop.items()}
    assert counts == {"customers": 10, "categories": 6, "suppliers": 5, "products": 15, "orders": 20,
                      "order_items": 36, "payments": 20, "reviews": 15, "summary": 20}


def test_total_revenue_is_rounded_per_order(sales):
    assert revenue_card(sales).first().asDict() == {
        "total_revenue": D("144218.90"), "orders_counted": 17, "avg_order_value": D("8483.46")}


def test_monthly_revenue_growth_and_running_total(sales):
    monthly = sales.groupBy(month_of("order_date").alias("ym")).agg(F.sum("net_amount").alias("revenue"))
    rows = {r["ym"]: r for r in period_over_period(monthly, "ym", "revenue").collect()}
    assert {ym: r["revenue"] for ym, r in rows.items()} == {
        "2025-06": D("26128.30"), "2025-07": D("66394.10"), "2025-08": D("24766.30"), "2025-09": D("16941.20"),
        "2025-10": D("9989.00")}
    assert rows["2025-06"]["growth_pct"] is None
    assert rows["2025-07"]["growth_pct"] == D("154.11")
    totals = {r["ym"]: r["running_total"] for r in cumulative(monthly, "ym", "revenue").collect()}
    assert totals["2025-10"] == D("144218.90")


def test_null_handling(shop):
    counts = shop["customers"].agg(F.count("*"), F.count("phone")).first()
    assert tuple(counts) == (10, 7)
    shown = shop["customers"].select(text_or("phone", "Not provided").alias("p")).where("p = 'Not provided'")
    assert shown.count() == 3


def test_name_patterns_ignore_case(shop):
    assert ids(shop["products"].where(contains_any_ci("product_name", ["Book", "Shoes"])), "product_id") == [5, 6, 9]


def test_signup_range(shop):
    early = shop["customers"].where(
        F.col("state").isin("Karnataka", "Maharashtra") & in_range("signup_date", "2025-01-01", "2025-04-01", "date"))
    assert ids(early, "customer_id") == [1, 2]


def test_anti_joins(shop):
    assert ids(without_match(shop["customers"], shop["orders"], {"customer_id": "customer_id"}), "customer_id") == [9, 10]
    assert ids(without_match(shop["products"], shop["order_items"], {"product_id": "product_id"}), "product_id") == [14]
    assert ids(without_match(shop["categories"], shop["products"], {"category_id": "category_id"}), "category_id") == [6]
    completed = shop["payments"].where("payment_status = 'Completed'")
    assert ids(without_match(shop["orders"], completed, {"order_id": "order_id"}), "order_id") == [5, 9, 12, 19]


def test_not_in_and_not_exists_differ_on_null(shop):
    suppliers, products = shop["suppliers"], shop["products"]
    assert not_in(suppliers, "supplier_id", products, "supplier_id").count() == 0
    assert ids(without_match(suppliers, products, {"supplier_id": "supplier_id"}), "supplier_id") == [5]
    known = products.where("supplier_id IS NOT NULL")
    assert ids(not_in(suppliers, "supplier_id", known, "supplier_id"), "supplier_id") == [5]
    assert not_in(suppliers, "supplier_id", products.limit(0), "supplier_id").count() == 5


def test_not_in_matches_sql(spark, shop):
    left = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    for values in ([], [1], [1, None], [None], [3]):
        right = spark.createDataFrame([(v,) for v in values], "b int")
        left.createOrReplaceTempView("l")
        right.createOrReplaceTempView("r")
        expected = spark.sql("SELECT a FROM l WHERE a NOT IN (SELECT b FROM r)").collect()
        assert sorted(map(str, not_in(left, "a", right, "b").collect())) == sorted(map(str, expected)), values


def test_full_outer(shop):
    orders = shop["orders"].select("order_id", F.col("customer_id").alias("o_customer"), "order_date")
    both = full_outer_rows(shop["customers"].select("customer_id", "first_name"), orders, {"customer_id": "o_customer"})
    assert both.count() == 22


def test_full_outer_equals_spark(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "n")], "k int, v string")
    many = spark.createDataFrame([(1, 10), (1, 11), (1, 11), (3, 30), (None, 0)], "j int, w int")
    expected = one.join(many, one.k == many.j, "full_outer").distinct()
    found = full_outer_rows(one, many, {"k": "j"})
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.select(*found.columns).collect()))


def test_basket_pairs(shop):
    pairs = {(r[0], r[1]): r[2] for r in pair_counts(shop["order_items"], "order_id", "product_id").collect()}
    assert pairs[(5, 6)] == 2
    assert len(pairs) == 15 and sum(pairs.values()) == 16


def test_top_products(lines):
    value = F.col("quantity") * F.col("unit_price")
    best = (
        lines.groupBy("product_id").agg(F.sum(value).alias("revenue"), F.sum("quantity").alias("units"))
        .orderBy(F.desc("revenue"), "product_id").limit(2).collect()
    )
    assert [(r["product_id"], r["revenue"]) for r in best] == [(3, D("54999.00")), (2, D("37998.00"))]


def test_best_in_category_keeps_ties(lines):
    units = lines.groupBy("category_name", "product_id").agg(F.sum("quantity").alias("units"))
    best = top_k_per_group(units, ["category_name"], [F.desc("units")], 1, ties=True)
    found = {}
    for row in best.collect():
        found.setdefault(row["category_name"], set()).add((row["product_id"], row["units"]))
    assert found["Home & Kitchen"] == {(10, 2), (11, 2)}
    assert found["Electronics"] == {(15, 10)}


def test_loss_rate(shop):
    assert tuple(lost_rate(shop["orders"], "status", LOST_ORDER).first()) == (20, 2, D("10.00"))


def test_repeat_customers(sales):
    assert ids(sales.groupBy("customer_id").count().where("count >= 2"), "customer_id") == [1, 2, 3, 5, 6, 7]


def test_spend_and_segments(shop, sales):
    spend = spend_per_customer(
        shop["customers"], sales.withColumnRenamed("customer_id", "o_customer"), "customer_id", "o_customer")
    rows = {r["customer_id"]: r for r in spend.withColumn(
        "segment", spend_segment("spend", [(50_000, "Gold"), (15_000, "Silver")])).collect()}
    assert [(i, rows[i]["spend"], rows[i]["segment"]) for i in (7, 1, 2)] == [
        (7, D("62647.20"), "Gold"), (1, D("30027.30"), "Silver"), (2, D("23067.30"), "Silver")]
    assert (rows[9]["orders"], rows[9]["spend"], rows[9]["segment"]) == (0, None, "No purchases")
    assert rows[8]["segment"] == "Bronze"


def test_above_average(shop, sales):
    spend = sales.groupBy("customer_id").agg(F.sum("net_amount").alias("total"))
    assert ids(above_average(spend, "total"), "customer_id") == [1, 2, 7]
    rated = shop["reviews"].groupBy("product_id").agg(F.sum("rating").alias("s"), F.count("*").alias("n"))
    assert ids(above_average(rated, "s", "n"), "product_id") == [1, 2, 3, 5, 7, 9, 11, 13, 15]


def test_ratings_as_text(shop):
    rated = shop["reviews"].groupBy("product_id").agg(F.sum("rating").alias("s"), F.count("*").alias("n"))
    shown = {r[0]: r[1] for r in shop["products"].join(rated, "product_id", "left").select(
        "product_id", F.coalesce(mean("s", "n").cast("decimal(10,2)").cast("string"), F.lit("No reviews"))).collect()}
    assert (shown[1], shown[2], shown[4]) == ("4.50", "5.00", "No reviews")


def test_lifetime_value(sales):
    card = lifetime_value(sales, "customer_id", "order_date").where("customer_id = 1").first()
    assert (card["orders"], card["total_spent"], card["days_active"]) == (4, D("30027.30"), 123)
    assert card["avg_order_value"] == D("7506.83")  # 7506.825 rounded away from zero


def test_semi_join_and_division(shop, lines):
    here = with_match(shop["orders"], shop["customers"].where("city = 'Bengaluru'"), {"customer_id": "customer_id"})
    bought = with_match(shop["order_items"], here, {"order_id": "order_id"})
    assert ids(with_match(shop["products"], bought, {"product_id": "product_id"}), "product_id") == [1, 2, 3, 4, 5, 6, 11, 15]
    assert ids(bought_all(lines, "customer_id", "category_name", ["Electronics", "Books"]), "customer_id") == [1, 2, 3]


def test_margin_and_stock(shop, spark):
    margins = {r[0]: r[1] for r in shop["products"].select("product_id", margin("price", "cost")).collect()}
    assert (margins[15], margins[1]) == (D("69.90"), D("43.98"))
    zero = spark.range(1).select(margin(F.lit(0), F.lit(1)).alias("m")).first()
    assert zero["m"] is None
    actions = {r[0]: r[1] for r in shop["products"].where("stock_qty < 50").select(
        "product_id", stock_action("stock_qty", 50)).collect()}
    assert set(actions) == {2, 3, 4, 11, 14} and actions[4].startswith("OUT OF STOCK")
