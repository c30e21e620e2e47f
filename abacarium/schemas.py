"""Schemas of the tables that loads and ledgers read."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DateType, DecimalType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType,
    TimestampType,
)

_TYPES = {
    "long": LongType(), "int": IntegerType(), "string": StringType(), "date": DateType(), "bool": BooleanType(),
    "price": DecimalType(10, 2), "pct": DecimalType(5, 2), "money": DecimalType(12, 2), "time": TimestampType(),
    "time_ntz": TimestampNTZType(),
}


def table(spec: str) -> StructType:
    """A schema from ``name type`` pairs; ``?`` after the type allows NULL."""
    fields = []
    for part in spec.split(","):
        name, kind = part.split()
        fields.append(StructField(name, _TYPES[kind.rstrip("?")], kind.endswith("?")))
    return StructType(fields)


LOAD = {
    "stg_customers": table("customer_id int?, full_name string?, email string?, city string?, segment string?"),
    "stg_sales": table(
        "order_id int?, order_date date?, customer_id int?, product_id int?, quantity int?, amount money?, "
        "status string?"),
    "dim_product": table("product_id int, product_name string, category string, unit_price price"),
    "dim_customer": table(
        "customer_key long, customer_id int, full_name string, email string?, city string?, segment string?, "
        "is_active bool, created_at time, updated_at time"),
}

LEDGER_CSV = table(
    "timestamp time_ntz?, account_id string?, type string?, amount money?, balance_after money?, seq long?")
