"""Staging, merge, keyed facts, partitions, mutations and snapshots."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from abacarium.operators.facts import (
    MonthRange, fact_scan, insert_if_absent, partition_audit, refresh_statistics, route, surrogate_lookup,
)
from abacarium.operators.merge import dimension_stats, dropped_duplicates, merge_dimension, merge_stats, rows_without_key
from abacarium.operators.mutations import (
    apply_defaults, conditional_update, delete_where, evolve_schema, next_key, propagate_delete, reset_table,
)
from abacarium.schemas import LOAD
from declared import SHOP, SHOP_LINKS
from abacarium.session import scratch_path
from abacarium.sources.files import bulk_load, sink_csv
from abacarium.sources.snapshots import SnapshotTable

T1, T2 = dt.datetime(2026, 7, 1), dt.datetime(2026, 7, 2)
TRACKED = ["full_name", "email", "city", "segment"]
DECLARED = MonthRange("2026-07", "2026-11")


def _feed(spark, day):
    """Day 2: five customers moved, three have a new address, five are new."""
    rows = []
    for i in range(1, 21 if day == 1 else 26):
        city = "Bengaluru" if day == 2 and i <= 5 else f"City {i % 4}"
        mail = "work" if day == 2 and 6 <= i <= 8 else "mail"
        rows.append((i, f"Name {i}", f"n{i}@{mail}.com", city, "Retail"))
    return spark.createDataFrame(rows, LOAD["stg_customers"])


def _merge(target, feed, as_of, **more):
    return merge_dimension(target, feed, "customer_id", TRACKED, as_of, surrogate="customer_key", **more)


def _actions(snapshot):
    return {r["action"]: r["rows"] for r in merge_stats(snapshot).collect()}


@pytest.fixture(scope="module")
def day1(spark):
    empty = spark.createDataFrame([], LOAD["dim_customer"])
    return _merge(empty, _feed(spark, 1), T1)


@pytest.fixture(scope="module")
def sales(spark):
    """400 sales: 95, 102, 95 and 103 in July to October, 5 in January."""
    months = [("2026-07", 95), ("2026-08", 102), ("2026-09", 95), ("2026-10", 103), ("2027-01", 5)]
    days = [dt.date.fromisoformat(f"{month}-{1 + n % 28:02d}") for month, count in months for n in range(count)]
    rows = [(i, day, 1 + i % 20, 1 + i % 8, 1, i, "RETURNED" if i % 13 == 0 else "COMPLETED")
            for i, day in enumerate(days, 1)]
    df = spark.createDataFrame(rows, "order_id int, order_date date, customer_id int, product_id int, quantity int, "
                                     "amount int, status string")
    return df.withColumn("amount", F.col("amount").cast("decimal(12,2)"))


def test_bulk_load_replaces_staging(spark):
    landed, staging = scratch_path(spark, "landed"), scratch_path(spark, "staging")
    sink_csv(_feed(spark, 2), landed)
    bulk_load(spark, landed, LOAD["stg_customers"], staging)
    again = bulk_load(spark, landed, LOAD["stg_customers"], staging)
    assert sorted(again.collect()) == sorted(_feed(spark, 2).collect())


def test_merge_two_days(spark, day1):
    assert _actions(day1) == {"INSERT": 20}
    assert sorted(r[0] for r in day1.select("customer_key").collect()) == list(range(1, 21))
    day2 = _merge(day1.drop("action"), _feed(spark, 2), T2)
    assert _actions(day2) == {"INSERT": 5, "UPDATE": 8, "KEEP": 12}
    assert tuple(dimension_stats(day2).first()) == (25, 8)
    rows = {r["customer_id"]: r for r in day2.collect()}
    assert {i: rows[i]["customer_key"] for i in (1, 20, 21, 25)} == {1: 1, 20: 20, 21: 21, 25: 25}
    assert rows[1]["city"] == "Bengaluru" and rows[1]["created_at"] == T1 and rows[1]["updated_at"] == T2
    assert rows[9]["updated_at"] == T1
    again = _merge(day2.drop("action"), _feed(spark, 2), dt.datetime(2026, 7, 3))
    assert _actions(again) == {"KEEP": 25}


def test_merge_null_changes_duplicates_and_missing_keys(spark):
    empty = spark.createDataFrame([], LOAD["dim_customer"])
    feed = spark.createDataFrame(
        [(1, "A", None, "x", "r"), (2, "B", "b@x", "x", "r"), (2, "B", "a@x", "x", "r"), (None, "C", None, "x", "r")],
        LOAD["stg_customers"])
    first = _merge(empty, feed, T1)
    assert {r["customer_id"]: r["email"] for r in first.collect()} == {1: None, 2: "a@x"}
    assert dropped_duplicates(feed, "customer_id").first()[0] == 1
    assert rows_without_key(feed, "customer_id").count() == 1
    change = spark.createDataFrame([(1, "A", "a@x", "x", "r"), (2, "B", None, "x", "r")], LOAD["stg_customers"])
    assert _actions(_merge(first.drop("action"), change, T2)) == {"UPDATE": 2}


def test_soft_delete(spark, day1):
    feed = _feed(spark, 1).where("customer_id > 3")
    snapshot = _merge(day1.drop("action"), feed, T2, soft_delete=True)
    assert _actions(snapshot) == {"DEACTIVATE": 3, "KEEP": 17}
    assert snapshot.where("NOT is_active").count() == 3
    assert _actions(_merge(snapshot.drop("action"), feed, T2, soft_delete=True)) == {"KEEP": 20}


def test_fact_load_is_idempotent_and_routed(spark, day1, sales):
    unknown = sales.limit(1).withColumn("customer_id", F.lit(99)).withColumn("order_id", F.lit(1000))
    matched, rejects = surrogate_lookup(sales.unionByName(unknown), day1, "customer_id", "customer_key")
    assert [r["order_id"] for r in rejects.collect()] == [1000]
    batch = route(matched.drop("customer_id"), "order_date", DECLARED)
    path = scratch_path(spark, "fact")
    insert_if_absent(spark, batch, path, ["order_id", "order_date"])
    fact = insert_if_absent(spark, batch, path, ["order_id", "order_date"])
    assert {r["order_month"]: r["row_count"] for r in partition_audit(fact, "amount").collect()} == {
        "2026-07": 95, "2026-08": 102, "2026-09": 95, "2026-10": 103, "default": 5}
    september = fact_scan(fact, "order_date", "2026-09-01", "2026-10-01", DECLARED)
    assert september.count() == 95
    wide = fact_scan(fact, "order_date", "2026-10-01", "2027-02-01", DECLARED)
    assert wide.count() == 108


def test_first_row_of_a_key_wins(spark):
    schema = "k int, day date, v int, order_month string"
    day = dt.date(2026, 7, 1)
    path = scratch_path(spark, "wins")
    first = insert_if_absent(spark, spark.createDataFrame([(1, day, 5, "2026-07"), (1, day, 7, "2026-07")], schema), path,
                             ["k", "day"])
    assert [r["v"] for r in first.collect()] == [5]
    second = insert_if_absent(spark, spark.createDataFrame([(1, day, 1, "2026-07"), (2, day, 2, "2026-07")], schema), path,
                              ["k", "day"])
    assert sorted((r["k"], r["v"]) for r in second.collect()) == [(1, 5), (2, 2)]


def test_snapshots_switch_versions(spark):
    from pyspark.sql.types import StructType

    table = SnapshotTable(spark, scratch_path(spark, "snap"), StructType.fromDDL("a int"))
    assert table.read().count() == 0 and table.state() == (0, -1)
    table.replace(spark.createDataFrame([(1,)], "a int"), batch=0)
    old = table.read()
    table.replace(table.read().unionByName(spark.createDataFrame([(2,)], "a int")), batch=1)
    assert sorted(r[0] for r in table.read().collect()) == [1, 2] and table.state() == (2, 1)
    assert [r[0] for r in old.collect()] == [1]


def test_updates_and_deletes_leave_unknown_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, x string")
    changed = conditional_update(df, F.col("x") == "a", {"x": F.lit("z")})
    assert {r["id"]: r["x"] for r in changed.collect()} == {1: "z", 2: None, 3: "b"}
    assert sorted(r["id"] for r in delete_where(df, F.col("x") == "a").collect()) == [2, 3]


def test_delete_follows_the_links(shop):
    tables = {name: shop[name] for name in SHOP}
    gone = shop["customers"].where("customer_id = 9")
    after, forbidding = propagate_delete(tables, SHOP_LINKS, "customers", "customer_id", gone)
    assert after["customers"].count() == 9
    assert forbidding["orders.customer_id"].count() == 0
    busy = shop["customers"].where("customer_id = 1")
    after, forbidding = propagate_delete(tables, SHOP_LINKS, "customers", "customer_id", busy)
    assert forbidding["orders.customer_id"].count() == 4
    assert {r["customer_id"] for r in after["customers"].where("referred_by IS NULL").collect()} >= {3, 4}
    assert after["reviews"].count() == 11
    orders, _ = propagate_delete(tables, SHOP_LINKS, "orders", "order_id", shop["orders"].where("order_id = 1"))
    assert (orders["order_items"].count(), orders["payments"].count()) == (34, 19)
    left, _ = propagate_delete(tables, SHOP_LINKS, "suppliers", "supplier_id", shop["suppliers"].where("supplier_id = 2"))
    assert left["products"].where("supplier_id IS NULL").count() == 3


def test_defaults_apply_only_to_omitted_columns(spark):
    df = spark.createDataFrame([(1, None)], "product_id bigint, supplier_id bigint")
    defaults = {"stock_qty": F.lit(0), "is_active": F.lit(True), "supplier_id": F.lit(7)}
    row = apply_defaults(df, SHOP["products"], defaults).first()
    assert (row["stock_qty"], row["is_active"], row["supplier_id"], row["price"]) == (0, True, None, None)


def test_schema_evolution_and_reset(spark, shop):
    wider = evolve_schema(shop["customers"], {"points": F.lit(0)}, {"city": "varchar(80)"}, ["phone"])
    assert "points" in wider.columns and "phone" not in wider.columns
    path = scratch_path(spark, "log")
    assert reset_table(shop["categories"], path).count() == 0
    assert (next_key(3, truncated=False), next_key(3, truncated=True)) == (4, 1)


def test_statistics(spark, shop):
    spark.sql("DROP TABLE IF EXISTS stats_demo")
    shop["categories"].write.saveAsTable("stats_demo")
    refresh_statistics(spark, "stats_demo")
    described = {r[0]: r[1] for r in spark.sql("DESCRIBE EXTENDED stats_demo").collect()}
    assert "6 rows" in described["Statistics"]
    spark.sql("DROP TABLE stats_demo")


def test_whole_load_and_day_two(spark, sales):
    from abacarium.api import run_load

    target = scratch_path(spark, "warehouse")
    products = spark.createDataFrame([(i, f"P{i}", "C", i) for i in range(1, 9)],
                                     "product_id int, product_name string, category string, unit_price int")

    def land(day):
        source = scratch_path(spark, "source")
        sink_csv(_feed(spark, day), f"{source}/customers")
        sink_csv(products, f"{source}/products")
        sink_csv(sales, f"{source}/sales")
        return source

    first = run_load(spark, land(1), target, T1, DECLARED)
    assert first.actions == {"INSERT": 20} and first.fact.count() == 400 and first.rejects.count() == 0
    second = run_load(spark, land(2), target, T2, DECLARED)
    assert second.actions == {"INSERT": 5, "UPDATE": 8, "KEEP": 12}
    assert (second.customers.count(), second.fact.count(), second.products.count()) == (25, 400, 8)
    top = (
        second.fact.where("status = 'COMPLETED'").join(second.customers, "customer_key").join(second.products, "product_id")
        .groupBy("city", "category").agg(F.sum("amount").alias("revenue"), F.count("*").alias("orders"))
        .orderBy(F.desc("revenue"), "city").limit(10)
    )
    assert top.count() == 5
    assert run_load(spark, land(2), target, T2, DECLARED).actions == {"KEEP": 25}
