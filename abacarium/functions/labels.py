"""Texts that reports show. Readers of the reports rely on them."""

STOCK_OUT = "OUT OF STOCK - reorder now"
STOCK_LOW = "Low stock - reorder soon"
NO_PURCHASES = "No purchases"
LOWEST_SEGMENT = "Bronze"
TREND_UNKNOWN, TREND_UP, TREND_DOWN, TREND_FLAT = "n/a", "UP", "DOWN", "FLAT"
BEST, WORST = "Best", "Worst"
ALL_YEARS, ALL_QUARTERS, ALL_CATEGORIES = "ALL YEARS", "All Quarters", "All Categories"
GRAND_TOTAL, REGION_SUBTOTAL = "GRAND TOTAL", "Region subtotal"
ALL_CHANNELS, CHANNEL_SUBTOTAL = "ALL CHANNELS", "Channel subtotal"
NO_SUPPLIER, NO_SUPPLIER_SHORT = "No supplier assigned", "-"
NO_REVIEWS = "No reviews"
NO_PAYMENT = "No payment row"
ORGANIC = "Organic signup"
NOT_PROVIDED = "Not provided"
