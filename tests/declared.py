"""The declared columns, rules and links of the small fixtures."""

from __future__ import annotations

from pyspark.sql.types import LongType, StringType, StructField, StructType

from abacarium.operators.mutations import Link
from abacarium.operators.quality import Check, Domain, ForeignKey, NotNull, Unique
from abacarium.schemas import table

SHOP = {
    "customers": table(
        "customer_id long, first_name string, last_name string, email string, phone string?, city string, "
        "state string, signup_date date, referred_by long?"),
    "categories": table("category_id long, category_name string, description string?"),
    "suppliers": table("supplier_id long, supplier_name string, contact_email string?, country string"),
    "products": table(
        "product_id long, product_name string, category_id long, supplier_id long?, price price, cost price, "
        "stock_qty int, is_active bool, created_at time"),
    "orders": table(
        "order_id long, customer_id long, order_date date, status string, shipping_city string?, discount_pct pct"),
    "order_items": table("order_item_id long, order_id long, product_id long, quantity int, unit_price price"),
    "payments": table(
        "payment_id long, order_id long, payment_method string, amount money, payment_date date?, "
        "payment_status string"),
    "reviews": table(
        "review_id long, product_id long, customer_id long, rating int, review_text string?, review_date date"),
}

STAR = {
    "dim_date": table(
        "date_key int, full_date date, day_of_month int, day_name string, is_weekend bool, month_num int, "
        "month_name string, quarter_num int, year_num int, yr_month string"),
    "dim_customer": table(
        "customer_key int, customer_id string, customer_name string, segment string, city string, state string, "
        "region string"),
    "dim_product": table(
        "product_key int, sku string, product_name string, category string, subcategory string, brand string, "
        "unit_price price"),
    "dim_store": table(
        "store_key int, store_name string, city string, state string, region string, channel string"),
    "fact_sales": table(
        "sales_key long, date_key int, customer_key int, product_key int, store_key int, order_id string, "
        "quantity int, unit_price price, discount_pct pct, gross_amount money, discount_amount money, "
        "net_amount money"),
}

REPOSITORY = StructType([
    StructField("id", LongType()), StructField("name", StringType()), StructField("full_name", StringType()),
    StructField("owner", StructType([StructField("login", StringType())])), StructField("html_url", StringType()),
    StructField("description", StringType()), StructField("language", StringType()),
    StructField("stargazers_count", LongType()), StructField("forks_count", LongType()),
    StructField("open_issues_count", LongType()), StructField("created_at", StringType()),
    StructField("updated_at", StringType()),
])

# The domains of the shop's enumerated columns.
ORDER_STATUS = ("Pending", "Shipped", "Delivered", "Cancelled", "Returned")
VALID_SALE = ("Shipped", "Delivered")
LOST_ORDER = ("Cancelled", "Returned")
PAYMENT_METHOD = ("UPI", "Credit Card", "Debit Card", "Net Banking", "Cash on Delivery")
PAYMENT_STATUS = ("Pending", "Completed", "Failed", "Refunded")

SHOP_KEYS = {
    "customers": ["customer_id"], "categories": ["category_id"], "suppliers": ["supplier_id"],
    "products": ["product_id"], "orders": ["order_id"], "order_items": ["order_item_id"],
    "payments": ["payment_id"], "reviews": ["review_id"],
}


def _not_null() -> list[NotNull]:
    return [
        NotNull(f"{name}.{f.name} present", name, f.name)
        for name, schema in SHOP.items() for f in schema.fields if not f.nullable
    ]


SHOP_RULES = [
    *_not_null(),
    *[Unique(f"{name} primary key", name, tuple(key)) for name, key in SHOP_KEYS.items()],
    Unique("one customer per email", "customers", ("email",), ignore_case=True),
    Unique("one category per name", "categories", ("category_name",), ignore_case=True),
    Unique("one supplier per email", "suppliers", ("contact_email",), ignore_case=True),
    Unique("one line per product", "order_items", ("order_id", "product_id")),
    Unique("one payment per order", "payments", ("order_id",)),
    Unique("one review per customer", "reviews", ("product_id", "customer_id")),
    Check("email form", "customers", "email LIKE '%_@_%._%'"),
    Check("phone form", "customers", "phone RLIKE '^[0-9]{10}$'"),
    Check("price positive", "products", "price > 0"),
    Check("cost not negative", "products", "cost >= 0"),
    Check("cost within price", "products", "cost <= price"),
    Check("stock not negative", "products", "stock_qty >= 0"),
    Check("discount 0..50", "orders", "discount_pct BETWEEN 0 AND 50"),
    Check("quantity positive", "order_items", "quantity > 0"),
    Check("unit price positive", "order_items", "unit_price > 0"),
    Check("amount not negative", "payments", "amount >= 0"),
    Check("rating 1..5", "reviews", "rating BETWEEN 1 AND 5"),
    Domain("order status", "orders", "status", ORDER_STATUS),
    Domain("payment method", "payments", "payment_method", PAYMENT_METHOD),
    Domain("payment status", "payments", "payment_status", PAYMENT_STATUS),
    ForeignKey("customer referrer", "customers", ("referred_by",), "customers", ("customer_id",)),
    ForeignKey("product category", "products", ("category_id",), "categories", ("category_id",)),
    ForeignKey("product supplier", "products", ("supplier_id",), "suppliers", ("supplier_id",)),
    ForeignKey("order customer", "orders", ("customer_id",), "customers", ("customer_id",)),
    ForeignKey("line order", "order_items", ("order_id",), "orders", ("order_id",)),
    ForeignKey("line product", "order_items", ("product_id",), "products", ("product_id",)),
    ForeignKey("payment order", "payments", ("order_id",), "orders", ("order_id",)),
    ForeignKey("review product", "reviews", ("product_id",), "products", ("product_id",)),
    ForeignKey("review customer", "reviews", ("customer_id",), "customers", ("customer_id",)),
]

SHOP_LINKS = [
    Link("products", "category_id", "categories", "category_id", "restrict"),
    Link("products", "supplier_id", "suppliers", "supplier_id", "set null"),
    Link("customers", "referred_by", "customers", "customer_id", "set null"),
    Link("orders", "customer_id", "customers", "customer_id", "restrict"),
    Link("order_items", "order_id", "orders", "order_id", "cascade"),
    Link("order_items", "product_id", "products", "product_id", "restrict"),
    Link("payments", "order_id", "orders", "order_id", "cascade"),
    Link("reviews", "product_id", "products", "product_id", "cascade"),
    Link("reviews", "customer_id", "customers", "customer_id", "cascade"),
]
