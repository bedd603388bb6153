"""Gold layer: dimensions, calendar and facts (OP-G01..G11).

Join plan (at scale):
* items, orders, first payment and the per-order totals are all keyed by
  ``order_id``; the aggregates come out hash-partitioned on it, so the
  fact joins on ``order_id`` reuse that partitioning;
* dimension look-ups are left joins on the business id; Spark/AQE turns
  them into broadcast joins when the runtime size of the dimension side is
  under the broadcast threshold, else sort-merge (with AQE skew splitting
  for a hot product);
* the calendar is broadcast explicitly: its size is fixed by its date range.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.functions.calendar import date_key, day_name, is_weekend, month_name, week_of_year
from emporia.operators.merge import ACTION, insert_all, merge, null_safe_differs
from emporia.operators.ordinals import stored_row_keys, surrogate_keys
from emporia.schemas import PAYMENT_UNKNOWN

DEFAULT_CALENDAR = (dt.date(2016, 1, 1), dt.date(2020, 12, 31))

DIM_CUSTOMER_COLUMNS = [
    "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state",
]
DIM_PRODUCT_COLUMNS = [
    "product_id", "product_category_name", "product_name_length", "product_description_length",
    "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm",
    "product_width_cm", "product_volume_cm3", "is_missing_category", "is_missing_dimensions",
]


# ---- OP-G07 ---------------------------------------------------------------
def changed_since(df: DataFrame, watermark: dt.datetime | None) -> DataFrame:
    """Rows inserted or updated after the watermark (all rows without one)."""
    if watermark is None:
        return df
    wm = F.lit(watermark).cast("timestamp_ntz")
    return df.where(F.coalesce(F.col("updated_at"), F.col("created_at")) > wm)


# ---- OP-G03 ---------------------------------------------------------------
def dim_date(spark: SparkSession, start: dt.date = DEFAULT_CALENDAR[0],
             end: dt.date = DEFAULT_CALENDAR[1]) -> DataFrame:
    """One row per day in [start, end] (1,827 rows for the default 2016-2020).

    Python dates span the years 1 to 9999, so any calendar has at most 3,652,059 rows
    (one INT column of it is broadcast: under 100 MB in a join's hash table).
    """
    days = (end - start).days + 1
    if days <= 0:
        raise ValueError(f"calendar ends ({end}) before it starts ({start})")
    d = F.date_add(F.to_date(F.lit(start.isoformat())), F.col("id").cast("int"))
    return spark.range(days).select(d.alias("full_date")).select(
        date_key(F.col("full_date")).alias("date_key"),
        "full_date",
        F.year("full_date").alias("year"),
        F.quarter("full_date").alias("quarter"),
        F.month("full_date").alias("month"),
        month_name(F.col("full_date")).alias("month_name"),
        week_of_year(F.col("full_date")).alias("week_of_year"),
        F.dayofweek("full_date").alias("day_of_week"),
        day_name(F.col("full_date")).alias("day_name"),
        is_weekend(F.col("full_date")).alias("is_weekend"),
    )


def calendar_range_for(df: DataFrame, ts_col: str) -> tuple[dt.date, dt.date]:
    """Whole calendar years covering the dates of ``ts_col`` (one aggregate row to the driver)."""
    row = df.agg(F.min(ts_col).alias("lo"), F.max(ts_col).alias("hi")).first()
    if row["lo"] is None:
        return DEFAULT_CALENDAR
    return dt.date(row["lo"].year, 1, 1), dt.date(row["hi"].year, 12, 31)


# ---- OP-G01 / G02 / G06 ---------------------------------------------------
def _with_new_keys(rows: DataFrame, id_col: str, key_name: str, start: int) -> DataFrame:
    return surrogate_keys(rows, [id_col], key_name, start=start)


def build_dim(silver: DataFrame, columns: list[str], id_col: str, key_name: str,
              batch_ts: dt.datetime, start_key: int = 0) -> DataFrame:
    """Dimension loaded into an empty table: every silver row inserted with a new key."""
    rows = insert_all(silver, columns, batch_ts)
    keyed = _with_new_keys(rows, id_col, key_name, start_key)
    return keyed.select(key_name, *columns, "created_at", "updated_at", ACTION)


def merge_dim(existing: DataFrame, silver_changes: DataFrame, columns: list[str], id_col: str,
              key_name: str, update_columns: list[str], compare_defaults: dict[str, object],
              batch_ts: dt.datetime, max_key: int) -> DataFrame:
    """Type-1 upsert: update ``update_columns`` only when one of them really differs.

    New rows get keys ``max_key + 1 ..``; existing keys never change.  Only the ids that
    the dimension lacks are numbered, so the table itself takes part in one full outer join.
    """
    cond = null_safe_differs(update_columns, compare_defaults)
    new_ids = silver_changes.select(id_col).join(existing.select(id_col), id_col, "left_anti")
    new_keys = _with_new_keys(new_ids, id_col, key_name, max_key).select(F.col(id_col).alias("_new_id"), key_name)
    changes = silver_changes.join(new_keys, F.col(id_col).eqNullSafe(F.col("_new_id")), "left").drop("_new_id")
    merged = merge(existing, changes, [id_col], columns, update_columns, batch_ts,
                   matched_condition=cond, carried_columns=[key_name])
    return merged.select(key_name, *columns, "created_at", "updated_at", ACTION)


CUSTOMER_UPDATES = ["customer_zip_code_prefix", "customer_city", "customer_state"]
CUSTOMER_COMPARE = {"customer_city": "", "customer_state": "", "customer_zip_code_prefix": 0}
PRODUCT_UPDATES = ["product_category_name"]
PRODUCT_COMPARE = {"product_category_name": ""}


# ---- OP-G08 / G10 / G11 ---------------------------------------------------
def first_payment_per_order(payments: DataFrame) -> DataFrame:
    """The payment row with the lowest sequence of each order (decorrelated MIN subquery)."""
    first = F.min_by(F.struct("payment_value", "payment_type", "payment_installments"), F.col("payment_sequential"))
    return payments.groupBy("order_id").agg(first.alias("_p")).select(
        "order_id",
        F.col("_p.payment_value").alias("payment_value"),
        F.col("_p.payment_type").alias("payment_type"),
        F.col("_p.payment_installments").alias("payment_installments"),
    )


def order_item_totals(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.sum("total_item_value").alias("total_order_value"),
        F.count(F.lit(1)).cast("int").alias("item_count"),
    )


def order_payment_totals(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(F.sum("payment_value").alias("total_payment_value"))


def _date_parts(ts: str) -> list:
    return [
        F.to_date(F.col(ts)).alias("order_purchase_date"),
        F.year(ts).alias("order_year"),
        F.month(ts).alias("order_month"),
    ]


def _calendar_lookup(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Left join on the YYYYMMDD key; dates outside the calendar keep a NULL key."""
    cal = F.broadcast(calendar.select(F.col("date_key").alias("_cal_key")))
    probe = date_key(F.to_date(F.col("order_purchase_timestamp")))
    return df.join(cal, probe == F.col("_cal_key"), "left").withColumnRenamed("_cal_key", "date_key")


def _key_lookup(df: DataFrame, dim: DataFrame | None, which: str) -> DataFrame:
    return df if dim is None else df.join(dim.select(f"{which}_id", f"{which}_key"), f"{which}_id", "left")


def _looked_up(df: DataFrame) -> list[str]:
    return [k for k in ("customer_key", "product_key") if k in df.columns]


# ---- OP-G06 for facts -----------------------------------------------------
def with_fact_keys(rows: DataFrame, key_name: str, start: int, batch_ts: dt.datetime) -> DataFrame:
    """Identity key (``start + 1 ..``) and load time for newly inserted fact rows.

    ``rows`` is a stored table as read (not the fact joins themselves): its rows are numbered by file and place in
    it, so that they neither move nor are sorted.
    """
    keyed = stored_row_keys(rows, key_name, start)
    return keyed.select(key_name, *rows.columns, F.lit(batch_ts).cast("timestamp_ntz").alias("created_at"))


# ---- OP-G04 ---------------------------------------------------------------
FACT_SALES_COLUMNS = [
    "order_id", "order_item_id", "customer_key", "product_key", "date_key", "price", "freight_value",
    "total_item_value", "payment_value", "payment_type", "payment_installments", "order_status",
    "is_late_delivery", "is_free_shipping", "order_purchase_date", "order_year", "order_month",
    "order_quarter",
]


def fact_sales(items: DataFrame, orders: DataFrame, payments: DataFrame, dim_customers: DataFrame | None,
               dim_products: DataFrame | None, calendar: DataFrame, watermark: dt.datetime | None = None,
               existing: DataFrame | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Line-grain fact: items of known orders with first payment and dimension keys.

    Incremental: only orders changed since the watermark, and only lines not
    already in the fact (insert-only; a snapshot run repairs later changes); known lines leave before the wide joins.
    Customer keys are looked up per order and product keys on the bare items: the joined line rows move
    no more, and an order's lines come out together.
    A dimension given as None is not looked up, and the fact has no key of it; ``carry`` names business ids
    (product_id, customer_id) that the rows keep for a report that joins on them instead.
    """
    o = changed_since(orders, watermark).select(
        "order_id", "customer_id", "order_status", "is_late_delivery", "order_purchase_timestamp")
    it = items.select("order_id", "order_item_id", "product_id", "price", "freight_value",
                      "total_item_value", "is_free_shipping")
    if watermark is not None:
        # Only the items of changed orders take part (semi-join before the wide joins).
        ids = o.select("order_id")
        it = it.join(ids, "order_id", "left_semi")
        payments = payments.join(ids, "order_id", "left_semi")
        if existing is not None:
            existing = existing.join(ids, "order_id", "left_semi")
    if existing is not None:
        it = it.join(existing.select("order_id", "order_item_id"), ["order_id", "order_item_id"], "left_anti")
    pay = first_payment_per_order(payments)
    o, it = _key_lookup(o, dim_customers, "customer"), _key_lookup(it, dim_products, "product")
    df = it.join(o, "order_id", "inner").join(pay, "order_id", "left")
    df = _calendar_lookup(df, calendar)
    ts = "order_purchase_timestamp"
    return df.select(
        "order_id", "order_item_id", *carry, *_looked_up(df), "date_key",
        "price", "freight_value", "total_item_value",
        F.coalesce("payment_value", F.lit(0).cast("decimal(10,2)")).alias("payment_value"),
        F.coalesce("payment_type", F.lit(PAYMENT_UNKNOWN)).alias("payment_type"),
        F.coalesce("payment_installments", F.lit(1)).alias("payment_installments"),
        "order_status", "is_late_delivery", "is_free_shipping",
        *_date_parts(ts),
        F.quarter(ts).alias("order_quarter"),
    )


# ---- OP-G05 ---------------------------------------------------------------
FACT_ORDERS_COLUMNS = [
    "order_id", "customer_key", "date_key", "order_status", "total_order_value", "total_payment_value",
    "item_count", "is_late_delivery", "is_delivery_inconsistent", "is_canceled_in_transit",
    "is_canceled_but_reached", "is_invalid_date_sequence", "order_purchase_date", "order_year",
    "order_month",
]


def fact_orders(orders: DataFrame, items: DataFrame, payments: DataFrame, dim_customers: DataFrame | None,
                calendar: DataFrame, watermark: dt.datetime | None = None,
                existing: DataFrame | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Order-grain fact: order attributes + item and payment totals (pre-aggregated, no fan-out).

    ``dim_customers`` given as None is not looked up, and the fact has no key of it; ``carry`` as in ``fact_sales``.
    """
    o = changed_since(orders, watermark)
    it, pay = items, payments
    if watermark is not None:
        ids = o.select("order_id")
        it, pay = it.join(ids, "order_id", "left_semi"), pay.join(ids, "order_id", "left_semi")
        if existing is not None:
            existing = existing.join(ids, "order_id", "left_semi")
    df = o.join(order_item_totals(it), "order_id", "left").join(order_payment_totals(pay), "order_id", "left")
    df = _key_lookup(df, dim_customers, "customer")
    df = _calendar_lookup(df, calendar)
    if existing is not None:
        df = df.join(existing.select("order_id"), "order_id", "left_anti")
    return df.select(
        "order_id", *carry, *_looked_up(df), "date_key", "order_status",
        F.coalesce("total_order_value", F.lit(0)).cast("decimal(10,2)").alias("total_order_value"),
        F.coalesce("total_payment_value", F.lit(0)).cast("decimal(10,2)").alias("total_payment_value"),
        F.coalesce("item_count", F.lit(0)).cast("int").alias("item_count"),
        "is_late_delivery", "is_delivery_inconsistent", "is_canceled_in_transit",
        "is_canceled_but_reached", "is_invalid_date_sequence",
        *_date_parts("order_purchase_timestamp"),
    )
