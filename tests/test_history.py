from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from abacarium.operators.history import cohort_retention, decrement_stock, merge_versions
from abacarium.schemas import table

T1, T2, T3 = (dt.datetime(2026, 7, d) for d in (1, 2, 3))
HISTORY = table("id int?, city string?, valid_from time?, valid_to time?, is_current bool?")


def test_versions(spark):
    def feed(*rows):
        return spark.createDataFrame(rows, "id int, city string")

    day1 = merge_versions(spark.createDataFrame([], HISTORY), feed((1, "A"), (2, None)), "id", ["city"], T1)
    day2 = merge_versions(day1, feed((1, "B"), (2, None), (3, "C")), "id", ["city"], T2)
    day3 = merge_versions(day2, feed((2, "D")), "id", ["city"], T3)
    rows = sorted((tuple(r) for r in day3.collect()), key=str)
    assert rows == sorted([
        (1, "A", T1, T2, False), (1, "B", T2, None, True), (2, None, T1, T3, False), (2, "D", T3, None, True),
        (3, "C", T2, None, True)], key=str)


def test_cohorts(spark):
    rows = [(1, "2026-01-05"), (1, "2026-01-09"), (1, "2026-03-01"), (2, "2026-01-31"), (3, "2026-02-01")]
    orders = spark.createDataFrame(rows, "who int, day string").withColumn("day", F.to_date("day"))
    found = {(r["cohort"], r["months_later"]): (r["customers"], str(r["retention_pct"]))
             for r in cohort_retention(orders, "who", "day").collect()}
    assert found == {("2026-01", 0): (2, "100.00"), ("2026-01", 2): (1, "50.00"), ("2026-02", 0): (1, "100.00")}


def test_stock(spark, shop):
    left = {r["product_id"]: (r["stock_qty"], r["oversold"]) for r in decrement_stock(
        shop["products"], "product_id", "stock_qty",
        shop["order_items"].withColumnRenamed("product_id", "p"), "p", "quantity").collect()}
    assert left[4] == (-1, True) and left[15] == (490, False) and left[14] == (30, False)
