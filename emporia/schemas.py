"""Table contracts of every layer (explicit schemas, never inferred)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

STR = T.StringType()
LONG = T.LongType()
TS = T.TimestampNTZType()
DATE = T.DateType()


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, STR, True) for n in names])


# ---- source feeds: every column is text (the feed contract) ----------------
SOURCE_COLUMNS: dict[str, tuple[str, ...]] = {
    "customers": (
        "customer_id", "customer_unique_id", "customer_zip_code_prefix",
        "customer_city", "customer_state",
    ),
    "orders": (
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date",
    ),
    "order_items": (
        "order_id", "order_item_id", "product_id", "seller_id",
        "shipping_limit_date", "price", "freight_value",
    ),
    # "lenght" (sic) is part of the feed contract; silver renames it.
    "products": (
        "product_id", "product_category_name", "product_name_lenght",
        "product_description_lenght", "product_photos_qty", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm",
    ),
    "payments": (
        "order_id", "payment_sequential", "payment_type",
        "payment_installments", "payment_value",
    ),
}

#: What a feed's text columns hold, where it is not text.
SOURCE_KINDS: dict[str, dict[str, str]] = {
    "customers": {"customer_zip_code_prefix": "int"},
    "orders": {c: "time" for c in SOURCE_COLUMNS["orders"][3:]},
    "order_items": {"order_item_id": "int", "shipping_limit_date": "time", "price": "decimal", "freight_value": "decimal"},
    "products": {**{c: "int" for c in SOURCE_COLUMNS["products"][2:5]}, **{c: "decimal" for c in SOURCE_COLUMNS["products"][5:]}},
    "payments": {"payment_sequential": "int", "payment_installments": "int", "payment_value": "decimal"},
}

SOURCE_SCHEMAS = {name: _text(*cols) for name, cols in SOURCE_COLUMNS.items()}

# Business keys as used by the bronze NOT EXISTS guard.
BRONZE_KEYS: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id",),
    "orders": ("order_id",),
    "order_items": ("order_id", "order_item_id"),
    "products": ("product_id",),
    "payments": ("order_id", "payment_sequential"),
}

# ---- Fixed values: these must equal the reference's words exactly. ----------
DEFAULT_SOURCE_SYSTEM = "olist_csv"
STATUS_DELIVERED = "DELIVERED"
STATUS_SHIPPED = "SHIPPED"
STATUS_CANCELED = "CANCELED"
STATUS_UNAVAILABLE = "UNAVAILABLE"
PAYMENT_NOT_DEFINED = "not_defined"
PAYMENT_UNKNOWN = "unknown"
FREE_SHIPPING_TEXTS = ("0", "0.0")
CUSTOMER_REPEAT = "Repeat"
CUSTOMER_ONE_TIME = "One-Time"
LOAD_SNAPSHOT = "snapshot"
LOAD_INCREMENTAL = "incremental"
RUN_MAIN = "MAIN_PIPELINE"
RUN_SOURCE = "load_source"
RUN_BRONZE = "load_bronze"
RUN_SILVER = "load_silver"
RUN_GOLD = "load_gold"

FEEDS = tuple(SOURCE_COLUMNS)


@dataclass(frozen=True)
class SilverSpec:
    """How one silver table is merged: key, updated columns, inserted columns."""

    name: str
    keys: tuple[str, ...]
    columns: tuple[str, ...]
    update_columns: tuple[str, ...]
    watermark: str = field(default="")


SILVER_SPECS: dict[str, SilverSpec] = {
    "customers": SilverSpec(
        "customers_clean", ("customer_id",),
        ("customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"),
        ("customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"),
        "silver_customers",
    ),
    "orders": SilverSpec(
        "orders_clean", ("order_id",),
        (
            "order_id", "customer_id", "order_status", "order_purchase_timestamp",
            "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date",
            "is_delivery_inconsistent", "is_shipped_missing", "is_canceled_in_transit",
            "is_canceled_but_reached", "is_invalid_date_sequence", "is_late_delivery",
        ),
        (
            "customer_id", "order_status", "order_purchase_timestamp",
            "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date",
            "is_delivery_inconsistent", "is_shipped_missing", "is_canceled_in_transit",
            "is_canceled_but_reached", "is_invalid_date_sequence", "is_late_delivery",
        ),
        "silver_orders",
    ),
    # Items update only the money columns; product/seller/date are frozen after insert.
    "order_items": SilverSpec(
        "order_items_clean", ("order_id", "order_item_id"),
        (
            "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
            "price", "freight_value", "total_item_value", "is_free_shipping",
        ),
        ("price", "freight_value", "total_item_value", "is_free_shipping"),
        "silver_order_items",
    ),
    "products": SilverSpec(
        "products_clean", ("product_id",),
        (
            "product_id", "product_category_name", "product_name_length",
            "product_description_length", "product_photos_qty", "product_weight_g",
            "product_length_cm", "product_height_cm", "product_width_cm",
            "product_volume_cm3", "is_missing_category", "is_missing_dimensions",
        ),
        (
            "product_category_name", "product_name_length", "product_description_length",
            "product_photos_qty", "product_weight_g", "product_length_cm",
            "product_height_cm", "product_width_cm", "product_volume_cm3",
            "is_missing_category", "is_missing_dimensions",
        ),
        "silver_products",
    ),
    "payments": SilverSpec(
        "payments_clean", ("order_id", "payment_sequential"),
        (
            "order_id", "payment_sequential", "payment_type", "payment_installments",
            "payment_value", "is_not_defined", "is_zero_value",
        ),
        ("payment_type", "payment_installments", "payment_value", "is_not_defined", "is_zero_value"),
        "silver_payments",
    ),
}

# Watermark names seeded by the reference setup script (fixed values).
WATERMARK_NAMES = (
    "bronze_customers", "bronze_orders", "bronze_order_items", "bronze_products", "bronze_payments",
    "silver_customers", "silver_orders", "silver_order_items", "silver_products", "silver_payments",
    "gold_dim_customers", "gold_dim_products", "gold_fact_sales", "gold_fact_orders",
)

PIPELINE_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", STR, False),
    T.StructField("log_id", STR, False),
    T.StructField("pipeline_name", STR, False),
    T.StructField("layer", STR, True),
    T.StructField("load_type", STR, True),
    T.StructField("status", STR, True),
    T.StructField("rows_processed", LONG, True),
    T.StructField("start_time", TS, True),
    T.StructField("end_time", TS, True),
    T.StructField("duration_seconds", LONG, True),
    T.StructField("error_message", STR, True),
    T.StructField("event_time", TS, True),
])

WATERMARK_SCHEMA = T.StructType([
    T.StructField("pipeline_name", STR, False),
    T.StructField("last_load_time", TS, True),
    T.StructField("updated_at", TS, True),
])
