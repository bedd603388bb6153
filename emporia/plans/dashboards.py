"""Dashboard page queries over the gold layer (OP-D01..D11).

The reference names the dashboard pages only; each page becomes one
aggregate over the star schema or over a report view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emporia.functions.measures import count_when, rate_pct, sum_money
from emporia.schemas import STATUS_CANCELED, STATUS_UNAVAILABLE

TOP_N = 10


def monthly_revenue(sales_summary: DataFrame) -> DataFrame:
    return sales_summary.select("year_month", "order_year", "order_month", "total_orders", "total_revenue")


def payment_split(fact_sales: DataFrame) -> DataFrame:
    """Orders, first-payment value and value share per payment type (order grain)."""
    per_order = fact_sales.select("order_id", "payment_type", "payment_value").distinct()
    by_type = per_order.groupBy("payment_type").agg(
        F.count(F.lit(1)).cast("long").alias("orders"),
        sum_money("payment_value").alias("payment_value"),
    )
    # The grand total is a window over the per-type rows (one row per payment type).
    cents = (F.col("payment_value") * 100).cast("long")
    total = F.sum(cents).over(Window.partitionBy())
    return by_type.withColumn("value_share_pct", rate_pct(cents, total))


def top_products(fact_sales: DataFrame, dim_products: DataFrame, n: int = TOP_N, key: str = "product_key") -> DataFrame:
    """The ``n`` products of most revenue with their rank; all ties at the cut are kept.

    Spark's top-n (each task keeps ``n`` rows) finds the ``n`` largest totals; these few numbers are
    the ranks, and one filter keeps every product that reaches the last of them.
    """
    per_product = fact_sales.where(F.col(key).isNotNull()).groupBy(key).agg(
        sum_money("total_item_value").alias("total_revenue"), F.count(F.lit(1)).cast("long").alias("units_sold"))
    known = per_product.join(dim_products.select(key), key, "left_semi")
    best = [r[0] for r in known.orderBy(F.col("total_revenue").desc_nulls_last()).limit(n).select("total_revenue").collect()]
    kept = [v for v in best if v is not None]
    full = len(best) == n
    reaches = F.col("total_revenue") >= F.lit(kept[-1]) if kept and full and len(kept) == n else F.lit(True)
    rank = F.lit(len(kept) + 1)  # products without a revenue come last
    for value in sorted(set(kept)):
        rank = F.when(F.col("total_revenue") == F.lit(value), F.lit(kept.index(value) + 1)).otherwise(rank)
    named = dim_products.select(*dict.fromkeys([key, "product_id", "product_category_name"]))
    return per_product.where(reaches).join(named, key).select(
        rank.cast("long").alias("revenue_rank"), "product_id", "product_category_name", "total_revenue", "units_sold")


def category_revenue(fact_sales: DataFrame, dim_products: DataFrame) -> DataFrame:
    per_product = fact_sales.groupBy("product_key").agg(
        F.sum("total_item_value").alias("revenue"), F.count(F.lit(1)).alias("units"))
    dp = dim_products.select("product_key", "product_category_name")
    return per_product.join(dp, "product_key", "inner").groupBy("product_category_name").agg(
        sum_money("revenue").alias("total_revenue"),
        F.sum("units").cast("long").alias("units_sold"),
        F.count(F.lit(1)).cast("long").alias("products"),
    )


def free_shipping(fact_sales: DataFrame) -> DataFrame:
    return fact_sales.groupBy("is_free_shipping").agg(
        F.count(F.lit(1)).cast("long").alias("items"),
        sum_money("total_item_value").alias("total_revenue"),
        sum_money("freight_value").alias("total_freight"),
    )


def customer_ltv(customer_revenue: DataFrame) -> DataFrame:
    return customer_revenue.select("customer_id", "customer_state", "total_orders", "lifetime_revenue",
                                   "avg_order_value", "customer_type")


def repeat_customers(customer_revenue: DataFrame) -> DataFrame:
    return customer_revenue.groupBy("customer_type").agg(
        F.count(F.lit(1)).cast("long").alias("customers"),
        F.sum("total_orders").cast("long").alias("orders"),
        sum_money("lifetime_revenue").alias("revenue"),
    )


def revenue_by_state(fact_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    per_customer = fact_orders.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_order_value").alias("revenue"))
    dc = dim_customers.select("customer_key", "customer_state")
    return per_customer.join(dc, "customer_key", "inner").groupBy("customer_state").agg(
        F.sum("orders").cast("long").alias("orders"),
        sum_money("revenue").alias("revenue"),
        F.count(F.lit(1)).cast("long").alias("customers"),
    )


def late_rate(delivery_quality: DataFrame) -> DataFrame:
    return delivery_quality.select("order_year", "order_month", "clean_delivered", "late_deliveries",
                                   "late_delivery_rate_pct")


DQ_FLAGS = ("delivery_inconsistent", "invalid_date_sequence", "canceled_in_transit", "canceled_but_reached",
            "late_deliveries")


def dq_by_month(delivery_quality: DataFrame) -> DataFrame:
    """One row per month and flag (unpivot of the monthly quality counts)."""
    return delivery_quality.unpivot(["order_year", "order_month"], list(DQ_FLAGS), "flag_name", "flag_count")


def cancellations(fact_orders: DataFrame) -> DataFrame:
    st = F.col("order_status")
    return fact_orders.groupBy("order_year", "order_month").agg(
        count_when(st == STATUS_CANCELED).alias("canceled"),
        count_when(st == STATUS_UNAVAILABLE).alias("unavailable"),
        count_when(F.col("is_canceled_in_transit") == 1).alias("canceled_in_transit"),
        count_when(F.col("is_canceled_but_reached") == 1).alias("canceled_but_reached"),
    )
