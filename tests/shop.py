"""The small shop: ten customers, fifteen products, twenty orders.

Fixed values: the rows decide the expected results of the tests.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from abacarium.functions import amount
from abacarium.operators.mutations import conditional_update
from abacarium.operators.reports import order_summary
from declared import SHOP

CUSTOMERS = {  # id: city, state, has a phone, referrer
    1: ("Bengaluru", "Karnataka", True, None), 2: ("Mumbai", "Maharashtra", False, None),
    3: ("Chennai", "Tamil Nadu", True, 1), 4: ("Hyderabad", "Telangana", True, 1),
    5: ("Delhi", "Delhi", False, None), 6: ("Kochi", "Kerala", True, None),
    7: ("Bengaluru", "Karnataka", True, 3), 8: ("Pune", "Maharashtra", True, None),
    9: ("Ahmedabad", "Gujarat", True, None), 10: ("Jaipur", "Rajasthan", False, 5),
}
SIGNUPS = "2025-01-10 2025-01-15 2025-02-01 2025-02-12 2025-03-05 2025-03-20 2025-04-02 2025-04-18 2025-05-09 2025-05-25"
CATEGORIES = ["Electronics", "Books", "Clothing", "Home & Kitchen", "Sports", "Toys"]
PRODUCTS = {  # id: name, category, supplier, price, cost, stock
    1: ("Wireless Earbuds", 1, 1, 2499, 1400, 120), 2: ("Smartphone X1", 1, 1, 18999, 14500, 40),
    3: ("Laptop Pro 14", 1, 1, 54999, 46000, 15), 4: ("Bluetooth Speaker", 1, 1, 3499, 2100, 0),
    5: ("SQL Mastery (Book)", 2, 2, 599, 300, 200), 6: ("Data Science Handbook", 2, 2, 899, 450, 150),
    7: ("Cotton T-Shirt", 3, 3, 499, 220, 300), 8: ("Denim Jeans", 3, 3, 1799, 900, 100),
    9: ("Running Shoes", 5, 3, 2999, 1700, 80), 10: ("Non-stick Pan Set", 4, 4, 1999, 1100, 60),
    11: ("Air Fryer", 4, 4, 5999, 3900, 25), 12: ("Yoga Mat", 5, 3, 799, 350, 90),
    13: ("Badminton Racket", 5, 3, 2199, 1200, 70), 14: ("Coffee Maker", 4, 4, 3999, 2500, 30),
    15: ("USB-C Cable", 1, None, 299, 90, 500),
}
ORDERS = """
1 1 06-01 Delivered 0 | 2 1 06-20 Delivered 10 | 3 2 06-05 Delivered 0 | 4 3 06-12 Delivered 0
5 4 06-15 Cancelled 0 | 6 5 07-02 Delivered 5 | 7 6 07-10 Shipped 0 | 8 7 07-18 Delivered 0
9 8 07-25 Pending 0 | 10 1 08-03 Delivered 0 | 11 2 08-09 Delivered 15 | 12 3 08-14 Returned 0
13 4 08-22 Delivered 0 | 14 5 09-01 Delivered 0 | 15 6 09-07 Delivered 0 | 16 7 09-15 Delivered 10
17 8 09-21 Delivered 0 | 18 1 10-02 Delivered 0 | 19 2 10-11 Shipped 0 | 20 3 10-19 Delivered 0
"""  # order, customer, day in 2025, status, discount in percent
BASKETS = {  # order: (product, quantity) at list price
    1: [(1, 1), (5, 2)], 2: [(2, 1), (15, 2)], 3: [(7, 3), (8, 1)], 4: [(5, 1), (6, 1)], 5: [(9, 1)],
    6: [(11, 1), (10, 1)], 7: [(12, 2), (13, 1)], 8: [(3, 1)], 9: [(1, 2)], 10: [(6, 2), (15, 3)],
    11: [(2, 1), (1, 1)], 12: [(8, 2)], 13: [(9, 1), (12, 1)], 14: [(10, 1), (5, 1)], 15: [(13, 1), (7, 2)],
    16: [(11, 1), (1, 1)], 17: [(7, 1), (9, 1)], 18: [(4, 1), (1, 1)], 19: [(6, 1), (5, 1)], 20: [(15, 5), (7, 2)],
}
REVIEWS = "1:1:5 1:2:4 2:1:5 3:7:4 5:1:5 5:3:4 6:3:3 7:6:4 8:3:1 9:8:4 10:5:2 11:7:5 12:4:3 13:6:5 15:1:4"


def _money(value) -> Decimal:
    return Decimal(value).quantize(Decimal("0.01"))


def tables(spark) -> dict:
    days = [dt.date.fromisoformat(day) for day in SIGNUPS.split()]
    customers = [
        (i, f"First{i}", f"Last{i}", f"c{i}@example.com", f"98765{i:05d}" if phone else None, city, state, day, ref)
        for (i, (city, state, phone, ref)), day in zip(CUSTOMERS.items(), days, strict=True)
    ]
    orders = []
    for part in ORDERS.replace("\n", "|").split("|"):
        if part.strip():
            number, who, day, status, discount = part.split()
            city = None if number == "4" else CUSTOMERS[int(who)][0]
            orders.append((int(number), int(who), dt.date.fromisoformat(f"2025-{day}"), status, city, _money(discount)))
    items = [(order, product, quantity) for order, basket in BASKETS.items() for product, quantity in basket]
    reviews = [tuple(int(x) for x in r.split(":")) for r in REVIEWS.split()]
    rows = {
        "customers": customers,
        "categories": [(i, name, None if name == "Toys" else f"All {name}") for i, name in enumerate(CATEGORIES, 1)],
        "suppliers": [(i, f"Supplier {i}", None if i == 3 else f"s{i}@example.com", "China" if i == 5 else "India")
                      for i in range(1, 6)],
        "products": [(i, name, cat, sup, _money(price), _money(cost), stock, True, dt.datetime(2025, 1, 1))
                     for i, (name, cat, sup, price, cost, stock) in PRODUCTS.items()],
        "orders": orders,
        "order_items": [(i, o, p, q, _money(PRODUCTS[p][3])) for i, (o, p, q) in enumerate(items, 1)],
        "reviews": [(i, p, c, stars, None, dt.date(2025, 10, 1)) for i, (p, c, stars) in enumerate(reviews, 1)],
    }
    out = {name: spark.createDataFrame(data, SHOP[name]) for name, data in rows.items()}
    out["summary"] = order_summary(
        out["orders"], out["order_items"], "order_id", "order_id",
        gross=F.sum(F.col("quantity") * F.col("unit_price")), discount_pct=F.col("discount_pct"))
    out["payments"] = _payments(out["summary"])
    return out


def _payments(summary):
    methods = F.array(*[F.lit(m) for m in ("UPI", "Credit Card", "Debit Card", "Net Banking")])
    paid = summary.select(
        F.col("order_id").alias("payment_id"), "order_id",
        F.element_at(methods, (F.col("order_id") % 4 + 1).cast("int")).alias("payment_method"),
        amount("net_amount").alias("amount"), F.col("order_date").alias("payment_date"),
        F.lit("Completed").alias("payment_status"))
    paid = conditional_update(paid, F.col("order_id") == 5, {"payment_status": F.lit("Failed")})
    paid = conditional_update(paid, F.col("order_id") == 12, {"payment_status": F.lit("Refunded")})
    return conditional_update(paid, F.col("order_id").isin(9, 19), {
        "payment_status": F.lit("Pending"), "payment_date": F.lit(None), "payment_method": F.lit("Cash on Delivery")})
