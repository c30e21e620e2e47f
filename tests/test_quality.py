"""Every rule of the shop is broken once and must be reported, and only that."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from abacarium.operators.quality import Check, Unique, apply_rules, blocked_deletes, rule_catalog, split_rows
from declared import SHOP, SHOP_KEYS, SHOP_RULES

DAY = dt.date(2025, 11, 1)


def _loose(schema):
    """The schema without NOT NULL, as rows arrive before they are checked."""
    from pyspark.sql.types import StructField, StructType

    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields])


def _customer(i, last="Last", email=None, phone=None):
    return (i, "First", last, email or f"new{i}@example.com", phone, "Goa", "Goa", DAY, None)


def _product(i, price, cost):
    return (i, "Bad product", 1, 1, Decimal(price), Decimal(cost), 0, True, dt.datetime(2025, 1, 1))


# What is added, and the rules that must report it with the key.
CASES = [
    ("customers", _customer(100, email="C1@example.com"), {("one customer per email", "c1@example.com")}),
    ("customers", _customer(100, last=None), {("customers.last_name present", "100")}),
    ("products", _product(100, -50, 10), {("price positive", "100"), ("cost within price", "100")}),
    ("products", _product(100, 100, 250), {("cost within price", "100")}),
    ("reviews", (100, 4, 1, 6, None, DAY), {("rating 1..5", "100")}),
    ("customers", _customer(100, phone="12345"), {("phone form", "100")}),
    ("orders", (100, 1, DAY, "Pending", None, Decimal(75)), {("discount 0..50", "100")}),
    ("orders", (100, 999, DAY, "Pending", None, Decimal(0)), {("order customer", "999")}),
    ("order_items", (100, 1, 1, 1, Decimal(2499)), {("one line per product", "1-1")}),
    ("order_items", (100, 1, 7, 0, Decimal(499)), {("quantity positive", "100")}),
    ("orders", (100, 1, DAY, "Lost", None, Decimal(0)), {("order status", "100")}),
]


@pytest.fixture(scope="module")
def tables(shop):
    return {name: shop[name] for name in SHOP}


def test_clean_shop_has_no_violations(tables):
    assert apply_rules(tables, SHOP_RULES, SHOP_KEYS).count() == 0


@pytest.mark.parametrize("number", range(len(CASES)))
def test_each_violation_is_found(spark, tables, number):
    table, row, expected = CASES[number]
    extra = spark.createDataFrame([row], _loose(SHOP[table]))
    rules = [rule for rule in SHOP_RULES if rule.table == table]
    found = apply_rules({**tables, table: tables[table].unionByName(extra)}, rules, SHOP_KEYS)
    assert {(r["rule"], r["key"]) for r in found.collect()} == expected


def test_delete_of_a_customer_with_orders_is_blocked(shop):
    doomed = shop["customers"].where("customer_id IN (1, 9)")
    assert [r[0] for r in blocked_deletes(doomed, shop["orders"], {"customer_id": "customer_id"}).collect()] == [1]


def test_partial_unique_and_nulls(spark):
    df = spark.createDataFrame([("a", True), ("a", False), ("b", True), ("B", True), (None, True), (None, True)],
                               "email string, is_active boolean")
    rule = Unique("active email", "d", ("email",), where="is_active")
    assert rule.violations({"d": df}).count() == 0
    folded = Unique("active email", "d", ("email",), where="is_active", ignore_case=True)
    assert [(r["key"], r["detail"]) for r in folded.violations({"d": df}).collect()] == [("b", "2 rows")]


def test_unknown_passes_a_check_and_rows_split(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id int, x int")
    good, bad = split_rows(df, [Check("positive", "d", "x > 0")])
    assert sorted(r[0] for r in good.collect()) == [1, 2]
    assert [(r["id"], r["broken_rules"]) for r in bad.collect()] == [(3, ["positive"])]


def test_length_rule_on_stored_rows(tables):
    long_enough = Check("name length", "products", "char_length(product_name) >= 9")
    found = apply_rules(tables, [long_enough], SHOP_KEYS).collect()
    assert sorted(r["key"] for r in found) == ["12"]


def test_catalogue_lists_every_rule(spark):
    catalogue = rule_catalog(spark, SHOP_RULES)
    assert catalogue.count() == len(SHOP_RULES) == catalogue.select("rule").distinct().count()
    assert catalogue.where(F.col("kind") == "foreign key").count() == 9
