"""The small star: 5,000 generated facts over 638 days.

Fixed values: products with prices, the states of customers and stores.
"""

from __future__ import annotations

import datetime as dt

from declared import STAR
from abacarium.sources.generators import Steps, calendar, numbers, sales_facts

FIRST, LAST = dt.date(2025, 1, 1), dt.date(2026, 9, 30)
PRODUCTS = [
    ("Noise-Cancelling Headphones", "Electronics", 7999), ("Bluetooth Speaker", "Electronics", 2999),
    ("Smart Watch", "Electronics", 5499), ("Wireless Mouse", "Electronics", 899),
    ("Ergonomic Office Chair", "Furniture", 12999), ("Standing Desk", "Furniture", 18999),
    ("Bookshelf", "Furniture", 6499), ("A4 Paper Ream (500)", "Stationery", 349),
    ("Gel Pen Pack (10)", "Stationery", 199), ("Desk Organizer", "Stationery", 799),
    ("Cotton T-Shirt", "Clothing", 699), ("Running Shoes", "Clothing", 3499),
]
# How the expected totals were generated.
STEPS = Steps(day=37, customer=13, product=11, store_run=7, quantity=3, most=5, discounts=4, discount=5)
CUSTOMER_REGIONS = "North South West South North South North West East West North South East North South East West South West East"
STORES = [("Online Store", "South", "Online"), ("Delhi Flagship", "North", "Retail"), ("Mumbai Central", "West", "Retail"),
          ("Chennai Mall", "South", "Retail"), ("Kolkata Hub", "East", "Retail")]


def tables(spark) -> dict:
    products = [(i, f"SKU-{i}", name, category, category, "Brand", price)
                for i, (name, category, price) in enumerate(PRODUCTS, 1)]
    product_rows = spark.createDataFrame(
        products, "product_key int, sku string, product_name string, category string, subcategory string, "
                  "brand string, unit_price int")
    product_rows = product_rows.withColumn("unit_price", product_rows.unit_price.cast("decimal(10,2)"))
    customers = [(i, f"C{i:03d}", f"Customer {i}", "Consumer", "City", f"State {i}", region)
                 for i, region in enumerate(CUSTOMER_REGIONS.split(), 1)]
    stores = [(i, name, "City", "State", region, channel) for i, (name, region, channel) in enumerate(STORES, 1)]
    dates = calendar(spark, FIRST, LAST)
    return {
        "dim_date": dates,
        "dim_product": product_rows,
        "dim_customer": spark.createDataFrame(customers, STAR["dim_customer"]),
        "dim_store": spark.createDataFrame(stores, STAR["dim_store"]),
        "fact_sales": sales_facts(numbers(spark, 5000), product_rows, dates, FIRST, 638, 20, 12, 5, STEPS),
    }
