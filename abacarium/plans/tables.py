"""The driver tables in the roles of the reports.

``nation`` and ``region`` are the geography (state, region), ``part`` the products
(``p_type`` is the category), ``supplier`` the stores, ``lineitem`` the order lines
or facts, ``events`` the ledger. A valid sale has status F or O, P is a lost order,
a line with flag R was returned. Money is cast to decimal before it is summed.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from abacarium.functions import cents, from_cents, round_whole, sum_whole
from abacarium.operators.facts import MonthRange
from abacarium.operators.ledger import default_accounts
from abacarium.operators.reports import order_summary, per_month

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

VALID_STATUS = ("F", "O")
LOST_STATUS = ("P",)
LEDGER_IN = ("signup", "purchase")
LEDGER_OUT = ("click", "error")
DECLARED = MonthRange("1996-01", "1996-12")


class Tables:
    """The tables below one folder; nothing is read before it is used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, str(folder).rstrip("/")

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    region = cached_property(lambda self: self._read("region"))
    nation = cached_property(lambda self: self._read("nation"))
    customer = cached_property(lambda self: self._read("customer"))
    supplier = cached_property(lambda self: self._read("supplier"))
    part = cached_property(lambda self: self._read("part"))
    orders = cached_property(lambda self: self._read("orders"))
    lineitem = cached_property(lambda self: self._read("lineitem"))
    events = cached_property(lambda self: self._read("events"))

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines with amounts in whole numbers, see ``gross_total``, ``net_total`` and ``revenue_total``."""
        return self.lineitem.withColumns({
            "gross_cents": cents("l_extendedprice"),
            "net_parts": line_net(),
            "net_cents": round_whole(line_net(), 100),
            "units": F.col("l_quantity").cast("long"),
        })

    @cached_property
    def summary(self) -> DataFrame:
        """One row per order with its gross and net amount."""
        orders = self.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
        return order_summary(orders, self.lines, "o_orderkey", "l_orderkey", gross=gross_total(), net=net_total())

    @cached_property
    def sales(self) -> DataFrame:
        """The order summary of valid sales."""
        return self.summary.where(valid_sale())

    @cached_property
    def valid_lines(self) -> DataFrame:
        """Lines of valid sales, with the order's customer and date."""
        orders = self.orders.where(valid_sale()).select("o_orderkey", "o_custkey", "o_orderdate")
        return self.lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    @cached_property
    def geography(self) -> DataFrame:
        """Nations with their region."""
        return self.nation.join(self.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            "n_nationkey", "n_name", "r_name"
        )

    @cached_property
    def months(self) -> DataFrame:
        """Revenue per ship month over all lines."""
        return per_month(self.lines, "l_shipdate", "ym", revenue_total().alias("revenue"))

    @cached_property
    def ledger(self) -> DataFrame:
        """The events as ledger entries."""
        return self.events.select(
            F.col("user_id").alias("account_id"), "ts", F.col("event_id").alias("seq"),
            F.col("event_type").alias("type"), from_cents(cents("value")).alias("amount"),
        )

    @cached_property
    def accounts(self) -> DataFrame:
        """Every account of the ledger with a kind and its default limits."""
        kinds = self.events.select(F.col("user_id").alias("account_id")).distinct().withColumn(
            "kind", F.element_at(F.array(F.lit("base"), F.lit("savings"), F.lit("current")),
                                 (F.col("account_id") % 3 + 1).cast("int")))
        return default_accounts(kinds)


def line_net() -> Column:
    """The amount of a line after its discount, in ten-thousandths."""
    return cents("l_extendedprice") * (100 - cents("l_discount"))


def gross_total() -> Column:
    """The sum of the undiscounted amounts of lines."""
    return sum_whole("gross_cents")


def net_total() -> Column:
    """The sum of the discounted amounts of lines, before rounding."""
    return sum_whole("net_parts", 4)


def revenue_total() -> Column:
    """The sum of the discounted amounts of lines, each rounded to cents."""
    return sum_whole("net_cents")


def valid_sale() -> Column:
    return F.col("o_orderstatus").isin(*VALID_STATUS)
