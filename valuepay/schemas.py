"""Source registry and typed staging schemas (one StructType per source table)."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)

ORDERS = T.StructType([
    T.StructField("order_id", T.StringType(), False),
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("order_status", T.StringType(), False),
    T.StructField("order_purchase_timestamp", T.TimestampNTZType(), True),
    T.StructField("order_approved_at", T.TimestampNTZType(), True),
    T.StructField("order_delivered_carrier_date", T.TimestampNTZType(), True),
    T.StructField("order_delivered_customer_date", T.TimestampNTZType(), True),
    T.StructField("order_estimated_delivery_date", T.TimestampNTZType(), True),
])

ORDER_PAYMENTS = T.StructType([
    T.StructField("order_id", T.StringType(), False),
    T.StructField("payment_sequential", T.IntegerType(), False),   # unsigned 16 bit
    T.StructField("payment_type", T.StringType(), False),
    T.StructField("payment_installments", T.ShortType(), False),   # unsigned 8 bit
    T.StructField("payment_value", MONEY, False),
])

ORDER_ITEMS = T.StructType([
    T.StructField("order_id", T.StringType(), False),
    T.StructField("order_item_id", T.IntegerType(), False),        # unsigned 16 bit
    T.StructField("product_id", T.StringType(), False),
    T.StructField("seller_id", T.StringType(), False),
    T.StructField("shipping_limit_date", T.TimestampNTZType(), True),
    T.StructField("price", MONEY, False),
    T.StructField("freight_value", MONEY, False),
])

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("customer_unique_id", T.StringType(), False),
    T.StructField("customer_zip_code_prefix", T.StringType(), False),
    T.StructField("customer_city", T.StringType(), False),
    T.StructField("customer_state", T.StringType(), False),
])

GEOLOCATION = T.StructType([
    T.StructField("geolocation_zip_code_prefix", T.StringType(), False),
    T.StructField("geolocation_lat", T.DoubleType(), False),
    T.StructField("geolocation_lng", T.DoubleType(), False),
    T.StructField("geolocation_city", T.StringType(), False),
    T.StructField("geolocation_state", T.StringType(), False),
])

ORDER_REVIEWS = T.StructType([
    T.StructField("review_id", T.StringType(), False),
    T.StructField("order_id", T.StringType(), False),
    T.StructField("review_score", T.ShortType(), False),           # unsigned 8 bit
    T.StructField("review_comment_title", T.StringType(), True),
    T.StructField("review_comment_message", T.StringType(), True),
    T.StructField("review_creation_date", T.TimestampNTZType(), True),
    T.StructField("review_answer_timestamp", T.TimestampNTZType(), True),
])

CATEGORY_TRANSLATION = T.StructType([
    T.StructField("product_category_name", T.StringType(), True),
    T.StructField("product_category_name_english", T.StringType(), True),
])

# Source registry: table name -> staging schema; the file is "<name>.csv".
SOURCES: dict[str, T.StructType] = {
    "orders": ORDERS,
    "order_payments": ORDER_PAYMENTS,
    "order_items": ORDER_ITEMS,
    "customers": CUSTOMERS,
    "geolocation": GEOLOCATION,
    "order_reviews": ORDER_REVIEWS,
}

# Unsigned columns and their largest values; the signed Spark types above are wider.
UNSIGNED_MAX: dict[str, int] = {
    "payment_sequential": 65535,
    "order_item_id": 65535,
    "payment_installments": 255,
    "review_score": 255,
}

# Tables whose text columns may hold quoted line breaks (free-text review comments).
# Only these are read record by record (see sources/csv_records.py).
MULTILINE_TABLES = frozenset({"order_reviews"})

# Sort (clustering) key of each staging table, used when writing it.
SORT_KEYS: dict[str, tuple[str, ...]] = {
    "orders": ("order_id",),
    "order_payments": ("order_id", "payment_sequential"),
    "order_items": ("order_id", "order_item_id"),
    "customers": ("customer_id",),
    "geolocation": ("geolocation_zip_code_prefix",),
    "order_reviews": ("order_id",),
}

# Fixed values that must equal the reference's.
# Date-time columns, recognised by exact name:
DATETIME_COLUMNS = frozenset({
    "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date",
    "order_estimated_delivery_date", "shipping_limit_date",
    "review_creation_date", "review_answer_timestamp",
})
# Minimum accepted rows per staging table (staging quality gate):
MIN_ROWS: dict[str, int] = {
    "orders": 50_000,
    "order_payments": 50_000,
    "order_items": 50_000,
    "customers": 50_000,
    "geolocation": 500_000,
    "order_reviews": 50_000,
}
# Value-segment labels, highest first, and the payment types with their own value column:
SEGMENT_WHALE = "Top 5% Whale"
SEGMENT_HIGH = "High Value"
SEGMENT_MID = "Mid Value"
SEGMENT_STANDARD = "Standard"
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card")
# HVC share band of the mart gate (inclusive) and uplift adoption rate:
HVC_SHARE_BAND = (0.05, 0.15)
UPLIFT_ADOPTION = 0.30
# Order status excluded everywhere, and the payment method whose orders without
# instalments are "addressable" by the uplift model:
CANCELLED_STATUS = "canceled"
ADDRESSABLE_METHOD = "credit_card"
