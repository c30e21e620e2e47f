"""One load of the sales warehouse: staging, dimension, fact, in this order."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from abacarium.operators.facts import MonthRange, insert_if_absent, route, surrogate_lookup
from abacarium.operators.merge import merge_dimension, merge_stats
from abacarium.schemas import LOAD
from abacarium.session import stored
from abacarium.sources.files import bulk_load
from abacarium.sources.snapshots import SnapshotTable

_TRACKED = ["full_name", "email", "city", "segment"]
_FACT_KEY = ["order_id", "order_date"]


@dataclass(frozen=True)
class LoadResult:
    """What a load left behind; ``rejects`` are sales of unknown customers."""

    customers: DataFrame
    products: DataFrame
    fact: DataFrame
    rejects: DataFrame
    actions: dict[str, int]


def run_load(
    spark: SparkSession, source: str, target: str, as_of: dt.datetime, declared: MonthRange
) -> LoadResult:
    """Load ``customers``, ``products`` and ``sales`` CSV files below ``source`` into the warehouse at ``target``.

    Running the same files again changes nothing.
    """
    staged = {
        name: bulk_load(spark, f"{source}/{name}", schema, f"{target}/staging/{name}")
        for name, schema in (("customers", LOAD["stg_customers"]), ("sales", LOAD["stg_sales"]),
                             ("products", LOAD["dim_product"]))
    }
    dimension = SnapshotTable(spark, f"{target}/dim_customer", _nullable(LOAD["dim_customer"]))
    snapshot = merge_dimension(
        dimension.read(), staged["customers"], "customer_id", _TRACKED, as_of, surrogate="customer_key")
    actions = {row["action"]: row["rows"] for row in merge_stats(snapshot).collect()}
    if set(actions) - {"KEEP"}:
        dimension.replace(snapshot)
    customers = dimension.read()

    matched, rejects = surrogate_lookup(staged["sales"], customers, "customer_id", "customer_key")
    # Staged once: the insert looks at its batch more than once.
    batch = stored(route(matched.drop("customer_id"), "order_date", declared), "batch")
    fact = insert_if_absent(spark, batch, f"{target}/fact_sales", _FACT_KEY)
    return LoadResult(customers, staged["products"], fact, rejects, actions)


def _nullable(schema: StructType) -> StructType:
    # Parquet columns are read back as nullable.
    return StructType.fromJson({**schema.jsonValue(), "fields": [
        {**f, "nullable": True} for f in schema.jsonValue()["fields"]]})
