"""Silver layer: trim, type, flag and de-duplicate bronze rows (OP-V01..V05, V08).

Each cleaner filters bronze rows, keeps the newest raw row per cleaned
business key (``dedup_latest``), then types and flags the survivors with one
projection of built-in Column expressions.  The
``row_number() == 1`` filter plans as a partial ``WindowGroupLimit`` before
the shuffle, so repeated keys (even a hot key holding a large share of the
rows) are collapsed map-side before they are exchanged.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporia.functions import flags as Q
from emporia.functions.text import clean_text, first_upper, parse_dmy, to_dec, to_int
from emporia.schemas import SILVER_SPECS, SOURCE_COLUMNS

_RN = "_rn"


def incremental_filter(bronze: DataFrame, watermark: dt.datetime | None) -> DataFrame:
    """Rows landed strictly after the watermark (all rows when there is none)."""
    if watermark is None:
        return bronze
    return bronze.where(F.col("ingestion_timestamp") > F.lit(watermark).cast("timestamp_ntz"))


def since_date(bronze: DataFrame, watermark: dt.datetime | None, partition: str = "ingestion_date") -> DataFrame:
    """Stored bronze from the watermark's date on: whole partitions before it are not read (the exact test is above)."""
    return bronze if watermark is None else bronze.where(F.col(partition) >= F.lit(watermark.date()))


def dedup_latest(df: DataFrame, keys: list[str], raw_columns: tuple[str, ...]) -> DataFrame:
    """Newest row per key; ties (one load stamps one time) broken by the raw text, ascending.

    The reference leaves in-batch ties arbitrary; a total order makes the
    pick deterministic, so a recomputed partition yields the same row.
    """
    order = [F.col("ingestion_timestamp").desc_nulls_last()] + [
        F.col(c).asc_nulls_first() for c in raw_columns
    ]
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def _dedup_raw(src: DataFrame, name: str, keys: list[Column], key_raw: tuple[str, ...]) -> DataFrame:
    """Newest raw row per cleaned key.

    Only the raw text (plus the key and timestamp) crosses the shuffle;
    parsing and flagging run after the dedup, on the surviving rows only.
    Tie-break: raw non-key text in feed order.  Rows that tie there differ in the spelling of
    their key alone, which no cleaner reads after this: the raw keys neither cross the shuffle nor are sorted by.

    The keys are tested for NULL here, whoever reads the result: a later join would have Spark infer
    that test and push it under the shuffle for that reader alone, and readers whose shuffles differ
    by it cannot share one.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    for k in keys:
        src = src.where(k.isNotNull())
    text = tuple(c for c in SOURCE_COLUMNS[name] if c not in key_raw)
    keyed = src.select(*[k.alias(n) for k, n in zip(keys, names)], "ingestion_timestamp", *text)
    return dedup_latest(keyed, names, text)


def clean_customers(bronze: DataFrame, watermark: dt.datetime | None = None) -> DataFrame:
    src = incremental_filter(bronze, watermark).where(
        F.col("customer_id").isNotNull() & F.col("customer_unique_id").isNotNull()
    )
    d = _dedup_raw(src, "customers", [F.trim("customer_id")], ("customer_id",))
    return d.select(
        F.col("_k0").alias("customer_id"),
        F.trim("customer_unique_id").alias("customer_unique_id"),
        to_int("customer_zip_code_prefix").alias("customer_zip_code_prefix"),
        first_upper("customer_city").alias("customer_city"),
        F.upper(F.trim("customer_state")).alias("customer_state"),
    )


def clean_orders(bronze: DataFrame, watermark: dt.datetime | None = None) -> DataFrame:
    src = incremental_filter(bronze, watermark).where(
        F.col("order_id").isNotNull()
        & F.col("customer_id").isNotNull()
        & parse_dmy("order_purchase_timestamp").isNotNull()
    )
    d = _dedup_raw(src, "orders", [F.trim("order_id")], ("order_id",))
    dates = Q.order_dates()
    status = Q.order_status("order_status")
    carrier_txt, customer_txt = "order_delivered_carrier_date", "order_delivered_customer_date"
    parsed = d.select(
        F.col("_k0").alias("order_id"),
        F.trim("customer_id").alias("customer_id"),
        status.alias("order_status"),
        *[c.alias(n) for n, c in dates.items()],
        Q.delivery_inconsistent(status, customer_txt).alias("is_delivery_inconsistent"),
        Q.shipped_missing(status, carrier_txt).alias("is_shipped_missing"),
        Q.canceled_in_transit(status, carrier_txt, customer_txt).alias("is_canceled_in_transit"),
        Q.canceled_but_reached(status, carrier_txt, customer_txt).alias("is_canceled_but_reached"),
    )
    # Sequence / lateness compare the parsed dates (parsed once above, reused here).
    return parsed.withColumn(
        "is_invalid_date_sequence",
        Q.invalid_date_sequence(F.col("order_purchase_timestamp"), F.col("order_approved_at"),
                                F.col("order_delivered_carrier_date"), F.col("order_delivered_customer_date")),
    ).withColumn(
        "is_late_delivery",
        Q.late_delivery(F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")),
    ).select(*SILVER_SPECS["orders"].columns)


def clean_order_items(bronze: DataFrame, watermark: dt.datetime | None = None) -> DataFrame:
    src = incremental_filter(bronze, watermark).where(
        F.col("order_id").isNotNull() & to_int("order_item_id").isNotNull() & to_dec("price").isNotNull()
    )
    # Deduplicated on the typed key ('1' and '01' are one item), as the merge matches on it.
    d = _dedup_raw(src, "order_items", [F.trim("order_id"), to_int("order_item_id")],
                   ("order_id", "order_item_id"))
    price = to_dec("price")
    freight = F.coalesce(to_dec("freight_value"), F.lit(0).cast("decimal(10,2)"))
    return d.select(
        F.col("_k0").alias("order_id"),
        F.col("_k1").alias("order_item_id"),
        F.trim("product_id").alias("product_id"),
        F.trim("seller_id").alias("seller_id"),
        parse_dmy("shipping_limit_date").alias("shipping_limit_date"),
        price.alias("price"),
        freight.alias("freight_value"),
        (price + freight).cast("decimal(10,2)").alias("total_item_value"),
        Q.free_shipping("freight_value").alias("is_free_shipping"),
    )


def clean_products(bronze: DataFrame, watermark: dt.datetime | None = None) -> DataFrame:
    src = incremental_filter(bronze, watermark).where(F.col("product_id").isNotNull())
    d = _dedup_raw(src, "products", [F.trim("product_id")], ("product_id",))
    length, height, width = to_dec("product_length_cm"), to_dec("product_height_cm"), to_dec("product_width_cm")
    return d.select(
        F.col("_k0").alias("product_id"),
        clean_text("product_category_name").alias("product_category_name"),
        to_int("product_name_lenght").alias("product_name_length"),
        to_int("product_description_lenght").alias("product_description_length"),
        to_int("product_photos_qty").alias("product_photos_qty"),
        to_dec("product_weight_g").alias("product_weight_g"),
        length.alias("product_length_cm"),
        height.alias("product_height_cm"),
        width.alias("product_width_cm"),
        (length * height * width).cast("decimal(12,2)").alias("product_volume_cm3"),
        Q.missing_category("product_category_name").alias("is_missing_category"),
        Q.missing_dimensions("product_weight_g").alias("is_missing_dimensions"),
    )


def clean_payments(bronze: DataFrame, watermark: dt.datetime | None = None) -> DataFrame:
    src = incremental_filter(bronze, watermark).where(
        F.col("order_id").isNotNull()
        & F.col("payment_sequential").isNotNull()
        & to_int("payment_sequential").isNotNull()
    )
    d = _dedup_raw(src, "payments", [F.trim("order_id"), to_int("payment_sequential")],
                   ("order_id", "payment_sequential"))
    return d.select(
        F.col("_k0").alias("order_id"),
        F.col("_k1").alias("payment_sequential"),
        F.lower(F.trim("payment_type")).alias("payment_type"),
        F.coalesce(to_int("payment_installments"), F.lit(1)).alias("payment_installments"),
        F.coalesce(to_dec("payment_value"), F.lit(0).cast("decimal(10,2)")).alias("payment_value"),
        Q.payment_not_defined("payment_type").alias("is_not_defined"),
        Q.payment_zero_value("payment_value").alias("is_zero_value"),
    )


CLEANERS = {
    "customers": clean_customers,
    "orders": clean_orders,
    "order_items": clean_order_items,
    "products": clean_products,
    "payments": clean_payments,
}
