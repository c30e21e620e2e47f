"""Loads, merges, keys, mutations and generated tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

from abacarium.functions import amount, from_cents, to_double
from abacarium.operators.facts import (
    fact_scan, insert_if_absent, new_facts, partition_audit as audit, refresh_statistics, route, surrogate_lookup,
)
from abacarium.operators.merge import assign_keys, dimension_stats, merge_dimension, merge_stats
from abacarium.operators.mutations import (
    Link, apply_defaults, conditional_update, delete_where, evolve_schema, next_key, propagate_delete, reset_table,
)
from abacarium.operators.windows import dedupe_latest as latest_rows
from abacarium.plans.catalog import query
from abacarium.plans.checks import LEDGER, LINES, dbl
from abacarium.plans.tables import DECLARED, SCHEMAS, Tables
from abacarium.plans.totals import PAYMENTS, payments
from abacarium.schemas import LEDGER_CSV
from abacarium.session import scratch_path, stored
from abacarium.sources import files
from abacarium.sources.generators import date_dimension, numbers, sales_facts

_MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
_LINE_ORDER = ("l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, "
               "l_shipdate")
_MONTH = ("CASE WHEN strftime(l_shipdate, '%Y-%m') BETWEEN '1996-01' AND '1996-12' "
          "THEN strftime(l_shipdate, '%Y-%m') ELSE 'default' END")


# ---- scans and sinks -------------------------------------------------------------------------------------------

@query("scan_csv_ledger", f"WITH {LEDGER} SELECT ts, account_id, type, CAST(amount AS DOUBLE) AS amount, seq FROM led")
def scan_csv_ledger(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "ledger-csv")
    recorded = t.ledger.select(
        F.col("ts").alias("timestamp"), "account_id", "type", "amount", F.lit(None).cast("decimal(12,2)").alias("balance_after"),
        "seq")
    files.sink_csv(recorded, path, _MICROS)
    back = files.scan_csv(t.spark, path, LEDGER_CSV, _MICROS)
    return back.orderBy("timestamp", "seq").select(
        F.col("timestamp").alias("ts"), F.col("account_id").cast("long"), "type", F.col("amount").cast("double"), "seq")


_ROUND_TRIP = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


@query("bulk_load_staging", _ROUND_TRIP)
def bulk_load_staging(t: Tables) -> DataFrame:
    landed, staging = scratch_path(t.spark, "landed"), scratch_path(t.spark, "staging")
    files.sink_csv(t.customer, landed)
    for _ in range(2):  # loading again replaces the staging table
        staged = files.bulk_load(t.spark, landed, t.customer.schema, staging)
    return staged


@query("sink_csv", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def sink_csv(t: Tables) -> DataFrame:
    path = files.sink_csv(t.supplier, scratch_path(t.spark, "sink") + "/new/folder")
    return files.scan_csv(t.spark, path, t.supplier.schema)


@query("table_counts", " UNION ALL ".join(
    f"SELECT '{name}' AS tbl, COUNT(*) AS rows FROM {name}" for name in SCHEMAS))
def table_counts(t: Tables) -> DataFrame:
    return files.table_counts({name: getattr(t, name) for name in SCHEMAS})


# ---- generated tables ------------------------------------------------------------------------------------------

@query("dim_date", """
SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, CAST(d AS DATE) AS full_date, day(d) AS day_of_month,
       dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend, month(d) AS month_num, monthname(d) AS month_name,
       quarter(d) AS quarter_num, year(d) AS year_num, strftime(d, '%Y-%m') AS yr_month
FROM (SELECT unnest(generate_series(MIN(o_orderdate), MAX(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)""")
def dim_date(t: Tables) -> DataFrame:
    return date_dimension(order_days(t))


def order_days(t: Tables) -> DataFrame:
    return t.orders.agg(
        F.to_date(F.min("o_orderdate")).alias("first_day"), F.to_date(F.max("o_orderdate")).alias("last_day"))


@query("gen_fact_sales", """
WITH n AS (SELECT unnest(generate_series(1, (SELECT COUNT(*) FROM lineitem))) AS i),
b AS (SELECT i, DATE '1995-01-01' + CAST(i * 101 % 2404 AS INT) AS d, 1 + i * 29 % (SELECT COUNT(*) FROM customer) AS ck,
             1 + i * 17 % (SELECT COUNT(*) FROM part) AS pk, 1 + (i + i // 9) % (SELECT COUNT(*) FROM supplier) AS sk,
             1 + i * 5 % 8 AS qty, i % 6 * 3 AS disc FROM n),
g AS (SELECT b.*, CAST(p_retailprice AS DECIMAL(10,2)) AS price, CAST(p_retailprice AS DECIMAL(10,2)) * qty AS gross
      FROM b JOIN part ON p_partkey + 1 = pk WHERE d <= (SELECT CAST(MAX(o_orderdate) AS DATE) FROM orders))
SELECT i AS sales_key, CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, ck AS customer_key, pk AS product_key,
       sk AS store_key, 'ORD-' || CASE WHEN i < 1000000 THEN lpad(CAST(i AS VARCHAR), 6, '0') ELSE CAST(i AS VARCHAR) END
         AS order_id, qty AS quantity, CAST(price AS DOUBLE) AS unit_price, CAST(disc AS DOUBLE) AS discount_pct,
       CAST(gross AS DOUBLE) AS gross_amount, CAST(ROUND(gross * disc * 0.01, 2) AS DOUBLE) AS discount_amount,
       CAST(ROUND(gross * (100 - disc) * 0.01, 2) AS DOUBLE) AS net_amount FROM g""")
def gen_fact_sales(t: Tables) -> DataFrame:
    products = t.part.select((F.col("p_partkey") + 1).alias("product_key"),
                             amount("p_retailprice", 10).alias("unit_price"))
    facts = sales_facts(
        numbers(t.spark, t.lineitem.count()), products, date_dimension(order_days(t)), dt.date(1995, 1, 1), 2404,
        *[table.agg(F.count(F.lit(1))).scalar() for table in (t.customer, t.part, t.supplier)])
    money = ["unit_price", "discount_pct", "gross_amount", "discount_amount", "net_amount"]
    return facts.withColumns({c: F.col(c).cast("double") for c in money})


# ---- facts -----------------------------------------------------------------------------------------------------

@query("fact_partition_route", f"SELECT l_orderkey, l_linenumber, l_extendedprice, {_MONTH} AS order_month FROM lineitem")
def fact_partition_route(t: Tables) -> DataFrame:
    return route(t.lineitem, "l_shipdate", DECLARED).select("l_orderkey", "l_linenumber", "l_extendedprice", "order_month")


def _fact_table(t: Tables) -> DataFrame:
    """The lines as a table partitioned by declared month."""
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_shipdate"]
    rows = route(t.lines.select(*columns, from_cents("gross_cents").alias("amount")), "l_shipdate", DECLARED)
    path = scratch_path(t.spark, "fact")
    rows.hint("rebalance", "order_month").write.partitionBy("order_month").parquet(path)
    return t.spark.read.schema(rows.schema).parquet(path)


@query("pruned_month_sum", f"""
WITH {LINES} SELECT COUNT(*) AS rows, {dbl("SUM(gross)")} AS revenue FROM li
WHERE l_shipdate >= TIMESTAMP '1996-09-01' AND l_shipdate < TIMESTAMP '1996-10-01'""")
def pruned_month_sum(t: Tables) -> DataFrame:
    month = fact_scan(_fact_table(t), "l_shipdate", "1996-09-01", "1996-10-01", DECLARED)
    return month.agg(F.count(F.lit(1)).alias("rows"), to_double(F.sum("amount")).alias("revenue"))


@query("partition_audit", f"""
WITH {LINES} SELECT {_MONTH} AS order_month, COUNT(*) AS row_count, {dbl("SUM(gross)")} AS revenue FROM li GROUP BY 1""")
def partition_audit(t: Tables) -> DataFrame:
    return audit(_fact_table(t), "amount").withColumn("revenue", to_double("revenue"))


_DIM = "dim AS (SELECT ROW_NUMBER() OVER (ORDER BY c_name) AS customer_key, c_custkey FROM customer WHERE c_acctbal >= 0)"


def _known_customers(t: Tables) -> DataFrame:
    """Customers with a balance that is not negative, as a dimension with surrogate keys."""
    solvent = t.customer.where("c_acctbal >= 0").select("c_name", "c_custkey")
    return assign_keys(solvent, ["c_name"], "customer_key").select("customer_key", F.col("c_custkey").alias("o_custkey"))


@query("fact_key_lookup", f"""
WITH {_DIM}
SELECT o_orderkey, o_custkey, customer_key, CASE WHEN customer_key IS NULL THEN 'reject' ELSE 'load' END AS outcome
FROM orders LEFT JOIN dim ON c_custkey = o_custkey""")
def fact_key_lookup(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey")
    matched, rejects = surrogate_lookup(orders, _known_customers(t), "o_custkey", "customer_key")
    return matched.withColumn("outcome", F.lit("load")).unionByName(
        rejects.withColumns({"customer_key": F.lit(None).cast("long"), "outcome": F.lit("reject")}))


@query("load_fact", f"""
WITH {_DIM}, {LINES}, loaded AS (
  SELECT {_MONTH} AS order_month, gross, ROW_NUMBER() OVER (
    PARTITION BY l_orderkey, l_linenumber, l_shipdate ORDER BY customer_key, gross) AS rn
  FROM li JOIN orders ON o_orderkey = l_orderkey JOIN dim ON c_custkey = o_custkey)
SELECT order_month, COUNT(*) AS row_count, {dbl("SUM(gross)")} AS revenue FROM loaded WHERE rn = 1 GROUP BY 1""")
def load_fact(t: Tables) -> DataFrame:
    staging = t.lines.select("l_orderkey", "l_linenumber", "l_shipdate", from_cents("gross_cents").alias("amount")).join(
        t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    matched, _ = surrogate_lookup(staging, _known_customers(t), "o_custkey", "customer_key")
    # Staged once: a load looks at its batch more than once.
    batch = stored(route(
        matched.select("l_orderkey", "l_linenumber", "l_shipdate", "customer_key", "amount"), "l_shipdate", DECLARED),
        "staged")
    path, keys = scratch_path(t.spark, "load"), ["l_orderkey", "l_linenumber", "l_shipdate"]
    fact = insert_if_absent(t.spark, batch, path, keys)
    return audit(fact, "amount").withColumn("revenue", to_double("revenue"))


@query("fact_statistics", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(MIN({c}) AS VARCHAR) AS low, CAST(MAX({c}) AS VARCHAR) AS high, "
    f"CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS num_nulls FROM lineitem" for c in ("l_orderkey", "l_linenumber")))
def fact_statistics(t: Tables) -> DataFrame:
    """The optimizer's column statistics after a load, as the catalogue holds them."""
    path, name = scratch_path(t.spark, "loaded"), f"loaded_{uuid.uuid4().hex}"
    t.lineitem.select("l_orderkey", "l_linenumber").write.parquet(path)
    t.spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    try:
        refresh_statistics(t.spark, name)
        rows = []
        for column in ("l_orderkey", "l_linenumber"):
            found = {r["info_name"]: r["info_value"] for r in t.spark.sql(f"DESCRIBE EXTENDED {name} {column}").collect()}
            rows.append((column, found["min"], found["max"], int(found["num_nulls"])))
    finally:
        t.spark.sql(f"DROP TABLE {name}")
    return t.spark.createDataFrame(rows, "column_name string, low string, high string, num_nulls bigint")


@query("insert_if_absent", f"""
WITH b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) AS rn
           FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01')
SELECT * EXCLUDE (rn) FROM b WHERE rn = 1 AND NOT EXISTS (
  SELECT 1 FROM lineitem e WHERE e.l_shipdate < TIMESTAMP '1999-01-01' AND e.l_orderkey = b.l_orderkey
  AND e.l_linenumber = b.l_linenumber)""")
def insert_absent(t: Tables) -> DataFrame:
    turn = F.lit("1999-01-01").cast("timestamp_ntz")
    batch, existing = t.lineitem.where(F.col("l_shipdate") >= turn), t.lineitem.where(F.col("l_shipdate") < turn)
    return new_facts(batch, existing, ["l_orderkey", "l_linenumber"]).select(*t.lineitem.columns)


@query("dedupe_latest", f"""
WITH r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, {_LINE_ORDER})
           AS rn FROM lineitem) SELECT * EXCLUDE (rn) FROM r WHERE rn = 1""")
def dedupelatest_sql(t: Tables) -> DataFrame:
    return latest_rows(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


# ---- dimension merge -------------------------------------------------------------------------------------------

TRACKED = ["o_orderpriority", "o_orderstatus"]
_DIMENSION = (
    "customer_key bigint, o_custkey bigint, o_orderpriority string, o_orderstatus string, is_active boolean, "
    "created_at timestamp_ntz, updated_at timestamp_ntz")


def day(text: str):
    return F.lit(text).cast("timestamp_ntz")


def feed(t: Tables, start: str | None, end: str | None) -> DataFrame:
    """The orders of a period as a feed of customers with their priority and status; many rows per customer."""
    rows = t.orders
    if start:
        rows = rows.where(F.col("o_orderdate") >= day(start))
    if end:
        rows = rows.where(F.col("o_orderdate") < day(end))
    return rows.select("o_custkey", *TRACKED, "o_orderdate", "o_orderkey")


def _merged(t: Tables, target: DataFrame | None, start: str | None, end: str | None, as_of: str) -> DataFrame:
    if target is None:
        target = t.spark.createDataFrame([], _DIMENSION)
    return merge_dimension(
        target, feed(t, start, end), "o_custkey", TRACKED, day(as_of), latest=["o_orderdate", "o_orderkey"],
        surrogate="customer_key")


def latest_sql(name: str, where: str) -> str:
    return f"""{name} AS (SELECT * FROM (
  SELECT o_custkey AS k, o_orderpriority AS p, o_orderstatus AS s, ROW_NUMBER() OVER (
    PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders WHERE {where}) WHERE rn = 1)"""


_DAY1 = f"""{latest_sql("f1", "o_orderdate < TIMESTAMP '1996-01-01'")}, {latest_sql("f2", "o_orderdate >= TIMESTAMP '1996-01-01'")},
d1 AS (SELECT ROW_NUMBER() OVER (ORDER BY k) AS ck, k, p, s FROM f1),
m AS (SELECT d1.ck, COALESCE(d1.k, f2.k) AS k, COALESCE(f2.p, d1.p) AS p, COALESCE(f2.s, d1.s) AS s, d1.p AS old_p,
             d1.s AS old_s,
             CASE WHEN d1.k IS NULL THEN 'INSERT' WHEN f2.k IS NULL OR (d1.p = f2.p AND d1.s = f2.s) THEN 'KEEP'
                  ELSE 'UPDATE' END AS action FROM d1 FULL JOIN f2 ON f2.k = d1.k)"""
_SNAPSHOT = _DAY1 + """, snap AS (
SELECT COALESCE(ck, (SELECT MAX(ck) FROM d1) + ROW_NUMBER() OVER (PARTITION BY ck IS NULL ORDER BY k)) AS customer_key,
       k AS o_custkey, p AS o_orderpriority, s AS o_orderstatus, TRUE AS is_active,
       CASE WHEN action = 'INSERT' THEN TIMESTAMP '2002-01-01' ELSE TIMESTAMP '1996-01-01' END AS created_at,
       CASE WHEN action = 'KEEP' THEN TIMESTAMP '1996-01-01' ELSE TIMESTAMP '2002-01-01' END AS updated_at, action
FROM m)"""


def _two_days(t: Tables) -> DataFrame:
    day1 = _merged(t, None, None, "1996-01-01", "1996-01-01").drop("action")
    return _merged(t, day1, "1996-01-01", None, "2002-01-01")


@query("merge_dim", f"WITH {_SNAPSHOT} SELECT * FROM snap")
def merge_dim(t: Tables) -> DataFrame:
    return _two_days(t)


@query("merge_stats", f"WITH {_DAY1} SELECT action, COUNT(*) AS rows FROM m GROUP BY action")
def merge_counts(t: Tables) -> DataFrame:
    return merge_stats(_two_days(t))


@query("dimension_stats", f"""
WITH {_SNAPSHOT} SELECT COUNT(*) AS dim_rows, COUNT(*) FILTER (WHERE updated_at > created_at) AS updated_rows FROM snap""")
def dim_stats(t: Tables) -> DataFrame:
    return dimension_stats(_two_days(t))


@query("merge_day2", f"""
WITH {_SNAPSHOT} SELECT o_custkey, o_orderpriority, o_orderstatus, updated_at > created_at AS was_updated, action
FROM snap WHERE action <> 'KEEP'""")
def merge_day2(t: Tables) -> DataFrame:
    changed = _two_days(t).where("action <> 'KEEP'")
    return changed.select("o_custkey", *TRACKED, (F.col("updated_at") > F.col("created_at")).alias("was_updated"), "action")


@query("assign_keys", "SELECT ROW_NUMBER() OVER (ORDER BY c_name) AS customer_key, c_custkey, c_name FROM customer")
def keys(t: Tables) -> DataFrame:
    return assign_keys(t.customer.select("c_custkey", "c_name"), ["c_name"], "customer_key")


# ---- mutations -------------------------------------------------------------------------------------------------

@query("conditional_update", f"""
WITH {PAYMENTS}
SELECT o_orderkey, CASE WHEN payment_status = 'Refunded' THEN 'Cash on Delivery' ELSE payment_method END AS payment_method,
       {dbl("amount")} AS amount,
       CASE WHEN payment_status = 'Refunded' THEN 'Pending' ELSE payment_status END AS payment_status FROM pay""")
def update(t: Tables) -> DataFrame:
    changes = {"payment_method": F.lit("Cash on Delivery"), "payment_status": F.lit("Pending")}
    paid = payments(t).drop("payment_date").withColumn("amount", to_double("amount"))
    return conditional_update(paid, F.col("payment_status") == "Refunded", changes)


@query("delete_where", """
SELECT o_orderkey, o_orderpriority FROM orders
WHERE NOT COALESCE(NULLIF(o_orderpriority, '5-LOW') < '3', FALSE)""")
def delete(t: Tables) -> DataFrame:
    urgent = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")) < "3"
    return delete_where(t.orders.select("o_orderkey", "o_orderpriority"), urgent)


@query("propagate_delete", """
WITH gone AS (SELECT c_custkey FROM customer WHERE c_acctbal < 0),
o AS (SELECT * FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM gone)),
l AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o)),
c AS (SELECT c_custkey, CASE WHEN r IN (SELECT c_custkey FROM gone) THEN NULL ELSE r END AS r FROM (
        SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_custkey // 2 END AS r FROM customer)
      WHERE c_custkey NOT IN (SELECT c_custkey FROM gone))
SELECT 'customer' AS tbl, COUNT(*) AS rows, CAST(SUM(c_custkey) AS BIGINT) AS key_sum, CAST(SUM(r) AS BIGINT) AS link_sum
FROM c
UNION ALL SELECT 'orders', COUNT(*), CAST(SUM(o_orderkey) AS BIGINT), CAST(SUM(o_custkey) AS BIGINT) FROM o
UNION ALL SELECT 'lineitem', COUNT(*), CAST(SUM(l_partkey) AS BIGINT), CAST(SUM(l_orderkey) AS BIGINT) FROM l""")
def cascade(t: Tables) -> DataFrame:
    referrer = F.when(F.col("c_custkey") % 3 == 0, F.expr("c_custkey div 2")).alias("referrer")
    customers = t.customer.select("c_custkey", referrer)
    doomed = t.customer.where("c_acctbal < 0").select("c_custkey", referrer)
    links = [
        Link("customer", "referrer", "customer", "c_custkey", "set null"),
        Link("orders", "o_custkey", "customer", "c_custkey", "cascade"),
        Link("lineitem", "l_orderkey", "orders", "o_orderkey", "cascade"),
    ]
    tables = {"customer": customers, "orders": t.orders, "lineitem": t.lineitem}
    after, _ = propagate_delete(tables, links, "customer", "c_custkey", doomed)
    sums = {"customer": ("c_custkey", "referrer"), "orders": ("o_orderkey", "o_custkey"),
            "lineitem": ("l_partkey", "l_orderkey")}
    parts = [
        after[name].agg(F.count(F.lit(1)).alias("rows"), F.sum(key).alias("key_sum"), F.sum(link).alias("link_sum"))
        .select(F.lit(name).alias("tbl"), "rows", "key_sum", "link_sum") for name, (key, link) in sums.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("apply_defaults", """
SELECT c_custkey, c_name, 'India' AS country, 0 AS stock_qty, TRUE AS is_active, CAST(NULL AS VARCHAR) AS phone
FROM customer""")
def defaults(t: Tables) -> DataFrame:
    schema = StructType([
        StructField("c_custkey", LongType()), StructField("c_name", StringType()), StructField("country", StringType()),
        StructField("stock_qty", IntegerType()), StructField("is_active", BooleanType()), StructField("phone", StringType())])
    given = {"country": F.lit("India"), "stock_qty": F.lit(0), "is_active": F.lit(True)}
    return apply_defaults(t.customer.select("c_custkey", "c_name"), schema, given)


@query("evolve_schema", """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment, 0 AS loyalty_points FROM customer""")
def evolve(t: Tables) -> DataFrame:
    return evolve_schema(t.customer, {"loyalty_points": F.lit(0)}, {"c_nationkey": "bigint"}, ["c_acctbal"])


@query("reset_table", """
SELECT COUNT(*) AS rows_before, 0 AS rows_after, MAX(s_suppkey) + 1 AS key_after_delete, 1 AS key_after_truncate
FROM supplier""")
def reset(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "reset")
    t.supplier.write.parquet(path)
    before = t.spark.read.schema(t.supplier.schema).parquet(path).agg(
        F.count(F.lit(1)).alias("n"), F.max("s_suppkey").alias("k")).first()
    emptied = reset_table(t.supplier, path)
    return emptied.agg(
        F.lit(before["n"]).alias("rows_before"), F.count(F.lit(1)).alias("rows_after"),
        F.lit(next_key(before["k"], truncated=False)).alias("key_after_delete"),
        F.lit(next_key(before["k"], truncated=True)).alias("key_after_truncate"))
